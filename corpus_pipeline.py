"""The corpus pipeline: quality, near-dedup, substring dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and
read again as the next one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entres.llm import decontaminate, minhash, pieces, quality, substring
from entres.llm.util import drop_scratch, table, write_scratch

STAGES = [
    ("quality", quality.stage),
    ("near_dedup", minhash.stage),
    ("substring_dedup", substring.stage),
    ("decontaminate", decontaminate.stage),
    ("encode", pieces.stage),
]

#: The classifier and the hash-based stages have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, write_scratch(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_scratch(before)
    return STAGES[-1][1](spark, docs, sf_dir)
