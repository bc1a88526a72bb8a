"""Blocking of candidates that arrive as a stream, against the keys of a standing S1 table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entres.functions import text as T


def reference_keys(s1: DataFrame, cap: int = 30) -> DataFrame:
    """(country, key, s1) of clean S1 records: flat and sorted names that at most ``cap`` S1 have."""
    k = _keys(s1, "s1")
    n = k.groupBy("country", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= cap).select("country", "key")
    return k.join(n, ["country", "key"])


def _keys(records: DataFrame, out: str) -> DataFrame:
    words = T.key_words(T.words("name_core"))
    keys = F.array_distinct(F.array(F.concat(F.lit("f:"), T.joined(words, "")), F.concat(F.lit("s:"), T.joined(F.array_sort(F.array_distinct(words))))))
    return records.where(F.size(words) > 0).select(F.col("country_clean").alias("country"), F.explode(keys).alias("key"), F.col("entity_id").alias(out))


def matches(arrivals: DataFrame, reference: DataFrame) -> DataFrame:
    """(country, s1, cand, key) as clean candidates arrive: a stream-static join, without state."""
    return _keys(arrivals, "cand").join(reference, ["country", "key"])
