"""MinHash near-dedup with BagMinHash signatures of five-word shingle multisets.

BagMinHash.  The weight axis of a shingle is cut into levels that double: [0,1), [1,2), [2,4), ...
Each level has its own Poisson process of points (time, register, place on the axis) whose rate is the
level's width, seeded by shingle and level; a document of weight w takes the points below w.  The
lower levels are taken whole and the top one is thinned by place, so two weights share exactly the points below
the smaller.  A register keeps its earliest point; the chance that two documents agree in a register is
their weighted Jaccard similarity.  Points are made in order of time and only while they can still
matter, that is before the largest register.

Equal texts are collapsed by content first.  Bands of registers propose candidates (``cluster``) and
exact multiset overlap of the shingles decides them; classes are the components of the true links.

Words are runs without ASCII white space, A-Z lower-cased.  Defined cases: texts of fewer than five
words are one shingle; null, empty and blank texts are equal to each other and to nothing else;
null doc_id never leads a class unless no member has an id; an id on several texts is several
documents; repeated rows fall in one class; a text of any length is hashed whole; extra columns are ignored (kept
by the stage, whatever their names); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cluster
from .cluster import CELL
from .util import U64, Words, _powers, drop_scratch, mix64, multiset, occurrences, slices, table, unit, write_scratch

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 7
#: Bytes of text whose shingles are held at once.
SLICE = 1 << 18
#: At similarity 0.8 a pair misses all bands with probability (1 - 0.8**7)**32 = 0.0005.


def signature(keys: np.ndarray, weights: np.ndarray, m: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash registers (times of the earliest points) of a weighted set with integer weights."""
    reg = np.full(m, np.inf)
    if not len(keys):
        return reg
    top = np.frexp(weights)[1] - 1  # weights lie in [2**top, 2**(top + 1))
    node, rate, share = [mix64(keys)], [np.ones(len(keys))], [np.ones(len(keys))]
    for p in range(int(top.max()) + 1):
        width = float(1 << p)  # level [2**p, 2**(p+1))
        take = np.clip(weights - (1 << p), 0, 1 << p)
        some = np.flatnonzero(take)
        if len(some):
            node.append(mix64(keys[some] + U64((p + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)))
            rate.append(np.full(len(some), width))
            share.append(take[some] / width)
    node, rate, share = np.concatenate(node), np.concatenate(rate), np.concatenate(share)
    x, t = np.zeros(len(node)), 0
    while len(node):
        batch = int(min(64, max(1, np.ceil(m * 6.0 / rate.sum()))))
        step = np.arange(t + 1, t + batch + 1, dtype=U64) * U64(0xD1B54A32D192ED03)
        h = mix64(node[:, None] + step[None, :])
        gap = -np.log(unit(h))
        gap[:, 0] += x  # one running sum from the first point on, so times do not depend on the batches
        total = np.cumsum(gap, axis=1)
        time = total / rate[:, None]
        h2 = mix64(h ^ U64(0x6A09E667F3BCC909))
        at = ((h2 >> U64(40)) * U64(m)) >> U64(24)
        place = (h2 & U64(0xFFFFFFFFFF)).astype(np.float64) * (1.0 / (1 << 40))
        ok = place < share[:, None]
        np.minimum.at(reg, at[ok].astype(np.int64), time[ok])
        t += batch
        live = time[:, -1] < reg.max()
        node, rate, share, x = node[live], rate[live], share[live], total[live, -1]
    return reg


def band_keys(reg: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = reg.view(U64).reshape(bands, -1)
    h = np.arange(bands, dtype=U64) * U64(0x9E3779B97F4A7C15)
    for c in range(rows.shape[1]):
        h = mix64(h + rows[:, c])
    return h.view(np.int64)


class Shingles:
    """Five-word shingles of a batch of texts, per text."""

    def __init__(self, texts: list[bytes], k: int = SHINGLE):
        w = self.words = Words(texts)
        self.k = k
        n = len(w.hash)
        self.fwd, back = _powers(n + 1)
        self.total = np.zeros(n + 1, U64)  # differences, times a power, are hashes of runs of words
        np.cumsum(mix64(w.hash) * back[:n], out=self.total[1:])
        n = max(0, n - k + 1)
        run = mix64((self.total[k : k + n] - self.total[:n]) * self.fwd[:n] + U64(k))
        self.run = run

    def of(self, i: int) -> np.ndarray:
        a, n = self.words.first[i], self.words.count[i]
        if n >= self.k:
            return self.run[a : a + n - self.k + 1]
        if n == 0:
            return np.zeros(0, U64)
        h = np.full(1, n, dtype=U64)
        for j in range(n):
            h = mix64(h * U64(0x9E3779B97F4A7C15) + self.words.hash[a + j])
        return h

    def content(self, i: int) -> int:
        """Hash of the whole word sequence."""
        a, n = self.words.first[i], self.words.count[i]
        place = np.arange(1, n + 1, dtype=U64)
        return int(mix64(np.array([mix64(self.words.hash[a : a + n] * U64(0xD6E8FEB86659FD93) + place).sum(dtype=U64) + U64(n)]))[0].view(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches, limit=SLICE):
        s = Shingles(texts)
        keys, bands, size, seen = [], [], [], {}
        for i in range(len(texts)):
            key = s.content(i)
            if key not in seen:
                own = s.of(i)
                seen[key] = (len(own), band_keys(signature(*multiset(own))) if len(own) else None)
            keys.append(key)
            size.append(seen[key][0])
            bands.append(seen[key][1])
        yield pa.record_batch({"doc_id": part.column(0), "text_key": part.column(2), "key": pa.array(keys, pa.int64()), "size": pa.array(size, pa.int64()), "bands": pa.array(bands, pa.list_(pa.int64()))})


def _elements(sieve: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, limit=SLICE):
            s = Shingles(texts)
            keys = np.array([s.content(i) for i in range(len(texts))], np.int64)
            at = np.flatnonzero(sieve.value.has(keys))
            elems = [occurrences(s.of(i)).tobytes() for i in at]
            yield pa.record_batch({"lead": part.column(2).take(pa.array(at)), "key": pa.array(keys[at]), "elems": pa.array(elems, pa.binary())})

    return run


def classes(docs: DataFrame, threshold: float = THRESHOLD, cell: int = CELL) -> DataFrame:
    """``docs(doc_id, text)`` to one row a document: doc_id, text_key (xxhash64 of the text), class_id, class_text, class_size, n_shingles.

    The class is led by its smallest doc_id (null last), among equal ids by the smallest text_key (``class_text``).
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    sig = write_scratch(source.mapInArrow(_signatures, "doc_id long, text_key long, key long, size long, bands array<long>"), "sig")
    # one row per distinct word sequence; of the texts that have it, one gives the elements
    items = sig.groupBy("key").agg(F.min("text_key").alias("lead"), F.min_by("bands", "size").alias("bands"), F.min("size").alias("size"))
    items = write_scratch(items, "items")
    elems = lambda sieve: source.mapInArrow(_elements(sieve), "lead long, key long, elems binary")
    same = cluster.classes(items.select("key", F.explode("bands").alias("band")), elems, threshold, "near", cell, leads=items.select("key", "lead"), thin=True)
    member = sig.select("doc_id", "text_key", "key", "size").join(same, "key", "left").withColumn("class", F.coalesce("root", "key"))
    # a table of its own, so that the join below can split the rows of a large class
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    head = write_scratch(member.groupBy("class").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1"), "heads")
    out = member.join(head, "class", "left")
    led = F.col("n").isNotNull()
    out = out.select(
        "doc_id", "text_key", F.when(led, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(led, F.col("first.text_key")).otherwise(F.col("text_key")).alias("class_text"), F.coalesce("n", F.lit(1)).alias("class_size"), F.col("size").alias("n_shingles"),
    )
    out = write_scratch(out, "classes")
    drop_scratch(sig, items, same, head)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "n_shingles")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class the row with the smallest doc_id stays, once.  Columns of any name are kept.

    Of rows that repeat id and text, one stays; if other columns tell them apart, the one with the largest hash of all columns.
    """
    cols = docs.columns
    lead = classes(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("class_text")))
    kept = lead.groupBy(F.col("doc_id").alias("__kept_id"), F.col("text_key").alias("__kept_text")).agg(F.count(F.lit(1)).alias("__copies"))
    same = docs["doc_id"].cast("long").eqNullSafe(kept["__kept_id"]) & (F.xxhash64(docs["text"]) == kept["__kept_text"])
    out = docs.join(kept, same)
    once = out.where(kept["__copies"] == 1).select(*[docs[c] for c in cols])
    row = F.struct(*[docs[c] for c in cols])
    again = out.where(kept["__copies"] > 1).groupBy("__kept_id", "__kept_text").agg(F.max_by(row, F.xxhash64(*[docs[c] for c in cols])).alias("__row"))
    return once.unionByName(again.select(*[F.col("__row")[c].alias(c) for c in cols]))
