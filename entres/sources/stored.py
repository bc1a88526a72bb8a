"""Intermediate tables in the folder that driver and executors share: plans stay small, and a lost executor costs nothing."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame

_LEFT: dict[str, object] = {}
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING, _LOCK = [], threading.Lock()


@contextlib.contextmanager
def _freed(spark):
    """Shuffle files behind a written table go with its write, and not when the driver happens to collect its garbage; writes may run side by side."""
    with _LOCK:
        _WRITING.append(spark.conf.get(_FREED, "false") if not _WRITING else _WRITING[0])
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _LOCK:
            before = _WRITING.pop()
            if not _WRITING:
                spark.conf.set(_FREED, before)


def folder(spark) -> str:
    """``spark.checkpoint.dir``; a local folder only where that is unset and driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"{tempfile.gettempdir()}/entres-stored"
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again; deleted when the driver exits."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    _LEFT[path] = lambda: fs.delete(p, True)
    with _freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Estimated bytes of a table below which its rows are dealt to all cores before costly steps.
SMALL = 256 << 20
#: Estimated bytes from which on the estimate is none.
KNOWN = 1 << 40


def spread(df: DataFrame, like: DataFrame | None = None, *keys: str) -> DataFrame:
    """``df`` dealt to all cores if it, or ``like``, is small: small tables come in few partitions, whatever their rows cost.  Larger ones have partitions enough.

    With ``keys``, by which the next join needs the rows anyway, also larger tables are dealt: into a partition a MB of ``like``.
    """
    size = int(str((like or df)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    most = 2 * df.sparkSession.sparkContext.defaultParallelism
    if keys:
        return df.repartition(max(most, size >> 20), *keys) if size < KNOWN else df.repartition(*keys)
    return df.repartition(most) if size < SMALL else df


@atexit.register
def _delete() -> None:
    for delete in _LEFT.values():
        with contextlib.suppress(Exception):  # the JVM may be gone
            delete()
