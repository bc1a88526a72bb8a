"""Shared pieces of the training-data operators: table access, shared scratch tables, numpy text kernels.

The numpy kernels work on one batch of texts at a time.  A batch is laid out as a single
UTF-8 byte array plus document offsets, so that tokenising and hashing cost a few vector
operations per byte and no Python call per word.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
MASK64 = 0xFFFFFFFFFFFFFFFF
#: Odd multiplier of the polynomial word hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Texts per numpy batch are bounded by bytes, not by rows: a batch never exceeds this many bytes
#: unless one text alone does.
BATCH_BYTES = 1 << 20
#: Rows of an Arrow batch while a scratch table is written.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local folder only where it is unset and driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"{tempfile.gettempdir()}/entres-scratch"
    return root.rstrip("/")


_LEFT: dict[str, Callable[[], object]] = {}


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage is cut and a lost executor costs nothing.

    What :func:`drop_scratch` has not deleted goes when the driver exits.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/entres-{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    _LEFT[path] = lambda: fs.delete(p, True)
    freed = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # the shuffles behind a written table are not needed again
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"  # a batch of whole texts stands in the JVM and in each worker
    before = {freed: spark.conf.get(freed, "false"), rows: spark.conf.get(rows)}
    spark.conf.set(freed, "true")
    if not 0 < int(before[rows]) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    out._entres_path = path
    return out


def drop_scratch(*tables: DataFrame) -> None:
    """Delete tables made by :func:`write_scratch` (only when no lazy plan still reads them)."""
    for df in tables:
        delete = _LEFT.pop(getattr(df, "_entres_path", None), None)
        if delete:
            delete()


@atexit.register
def _drop_left() -> None:
    for delete in _LEFT.values():
        with contextlib.suppress(Exception):  # the JVM may be gone
            delete()


def crc_mod(col, n: int):
    """crc32 of the id written as text, modulo n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into pieces of bounded size; yields each piece with its texts as UTF-8 (null: empty).

    At the end the worker, which waits for its next task, gives its free memory back.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
        lo = 0
        while lo < len(sizes):
            hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), limit, side="right")))
            part = batch.slice(lo, hi - lo)
            yield part, [b if b is not None else b"" for b in col.slice(lo, hi - lo).cast(pa.binary()).to_pylist()]
            lo = hi
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)
    pa.default_memory_pool().release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Map hashes to uniforms in (0, 1]."""
    return ((x >> U64(11)).astype(np.float64) + 1.0) * (1.0 / 9007199254740992.0)


_BYTE_CODE = mix64(np.arange(256, dtype=U64) + U64(0x51ED270B))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n, kept between calls."""
    if "f" not in _POWERS or len(_POWERS["f"]) < n:
        size = max(n, 1 << 20)
        for key, base in (("f", _BASE), ("b", _BASE_INV)):
            out = np.full(size, base, dtype=U64)
            out[0] = 1
            _POWERS[key] = np.multiply.accumulate(out)
    return _POWERS["f"][:n], _POWERS["b"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[j]-S[i] = sum of code(data[k]) * BASE**-k over i <= k < j, all modulo 2**64."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.multiply(_BYTE_CODE[data], _powers(len(data))[1], out=out[1:])
    np.cumsum(out[1:], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes give equal hashes wherever they stand."""
    fwd, _ = _powers(len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * fwd[starts] ^ (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))




class Words:
    """Words of a batch of UTF-8 texts: ``hash``, ``start``, ``end`` (byte positions in ``data``) and ``doc``.

    A word is a run of bytes other than ASCII white space; A-Z are lower-cased when ``lower``.
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8) if texts else np.zeros(0, np.uint8)
        self.data = raw + ((raw - np.uint8(65)) < 26).view(np.uint8) * np.uint8(32) if lower else raw
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = (raw != 32) & ((raw - np.uint8(9)) > 4)  # bytes below 9 wrap around
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        self.prefix = prefix_hash(self.data)
        self.hash = span_hash(self.prefix, self.start, self.end)
        self.doc = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))


def shingle_hash(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of all runs of k consecutive words; one hash of the whole when there are fewer than k words."""
    n = len(words)
    if n == 0:
        return np.zeros(0, U64)
    width = min(k, n)
    out = np.full(n - width + 1, width, dtype=U64)
    for i in range(width):
        out = mix64(out * U64(0x9E3779B97F4A7C15) + words[i : n - width + 1 + i])
    return out


def one_text(docs: DataFrame, *more: str) -> DataFrame:
    """One row an id of ``docs(doc_id, text, ...)``: of an id with several texts the least, whatever the order of rows."""
    return docs.groupBy("doc_id").agg(F.min("text").alias("text"), *[F.min(c).alias(c) for c in more])


def multiset(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts."""
    return np.unique(keys, return_counts=True)


def occurrences(keys: np.ndarray) -> np.ndarray:
    """Turn a multiset into a set: the j-th copy of a key gets its own hash, so |A & B| sums the lesser counts."""
    s = np.sort(keys)
    if not len(s):
        return s
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    rank = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    return np.where(rank == 0, s, mix64(s + rank.astype(U64) * U64(0xA0761D6478BD642F)))
