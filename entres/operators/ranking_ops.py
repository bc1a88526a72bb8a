"""Ranks, leads, gaps and budgets over groups, as functions on DataFrames; every tie is broken by an id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def rank_lead(df: DataFrame, group: list[str], value: str, tie: str, rank: str = "rank", lead: str = "lead") -> DataFrame:
    """Add the rank in the group by descending value (0 is best) and the value minus the best other value.

    A null value has no rank and no lead; a value alone in its group, or among nulls, has no lead.
    """
    v = F.col(value)
    me = W.partitionBy(*group).orderBy(v.desc_nulls_last(), tie)
    whole = me.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    r = F.row_number().over(me)
    other = F.when(r == 1, F.nth_value(v, 2).over(whole)).otherwise(F.first(v).over(whole))
    return df.withColumns({rank: F.when(v.isNotNull(), (r - 1).cast("double")), lead: v - other})


def gap(value: str, group: str) -> Column:
    """Value minus the best of the group."""
    return F.col(value) - F.max(value).over(W.partitionBy(group))


def best_other(df: DataFrame, group: str, value: str, member: str, out: str) -> DataFrame:
    """Add the best other member of the group by value; null if there is none."""
    me = W.partitionBy(group).orderBy(F.col(value).desc_nulls_last(), member)
    whole = me.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumn(out, F.when(F.row_number().over(me) == 1, F.nth_value(member, 2).over(whole)).otherwise(F.first(member).over(whole)))


def top_k(df: DataFrame, group: str, value: str, tie: str, k: Column | int) -> DataFrame:
    """The k best rows of each group; ``k`` may be a column, as where some groups may keep more."""
    me = W.partitionBy(group).orderBy(F.col(value).desc(), tie)
    return df.withColumn("__r", F.row_number().over(me)).where(F.col("__r") <= k).drop("__r")


def top_share(df: DataFrame, group: str, value: str, ties: list[str], keep: DataFrame, bins: int = 4096) -> DataFrame:
    """The ``n`` highest rows of each group, ``keep(group, n)``, without ordering any group in one task.

    Values in [0, 1] are counted in bins; bins above the one in which the n-th row falls are kept whole, and only that one is ordered.
    """
    b = F.floor(F.least(F.greatest(F.col(value), F.lit(0.0)), F.lit(1.0)) * bins).cast("int")
    x = df.withColumn("__b", b)
    run = F.sum("__n").over(W.partitionBy(group).orderBy(F.col("__b").desc()).rowsBetween(W.unboundedPreceding, -1))
    h = x.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__n")).withColumn("__above", F.coalesce(run, F.lit(0)))
    h = h.join(F.broadcast(keep.select(group, F.col("n").alias("__keep"))), group).where(F.col("__above") < F.col("__keep"))
    x = x.join(F.broadcast(h), [group, "__b"])
    whole = F.col("__above") + F.col("__n") <= F.col("__keep")
    order = W.partitionBy(group, "__b").orderBy(F.col(value).desc(), *ties)
    edge = x.where(~whole).withColumn("__r", F.row_number().over(order)).where(F.col("__above") + F.col("__r") <= F.col("__keep"))
    return x.where(whole).select(*df.columns).unionByName(edge.select(*df.columns))


def running_count(df: DataFrame, group: str, value: str, ties: list[str], flag: str, out: str, bins: int = 4096) -> DataFrame:
    """Add how many flagged rows there are up to each row, by descending value; each bin of values is a window of its own."""
    b = F.floor(F.least(F.greatest(F.col(value), F.lit(0.0)), F.lit(1.0)) * bins).cast("int")
    x = df.withColumn("__b", b)
    before = F.sum("__f").over(W.partitionBy(group).orderBy(F.col("__b").desc()).rowsBetween(W.unboundedPreceding, -1))
    h = x.groupBy(group, "__b").agg(F.sum(flag).alias("__f")).select(group, "__b", F.coalesce(before, F.lit(0)).alias("__before"))
    inner = W.partitionBy(group, "__b").orderBy(F.col(value).desc(), *ties).rowsBetween(W.unboundedPreceding, 0)
    return x.join(F.broadcast(h), [group, "__b"]).withColumn(out, (F.col("__before") + F.sum(flag).over(inner)).cast("long")).drop("__b", "__before")


def auc(df: DataFrame, group: str, value: str, label: str, bins: int = 4096) -> DataFrame:
    """Area under the curve by average ranks, null values left out; ranks are offsets of bins plus ranks inside them."""
    g = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    edges = g.groupBy(group).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    g = g.join(F.broadcast(edges), group).withColumn("b", F.coalesce(F.floor((F.col(value) - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * bins), F.lit(0)).cast("int"))
    h = g.groupBy(group, "b").agg(F.sum("n").alias("m"))
    h = h.withColumn("before", F.coalesce(F.sum("m").over(W.partitionBy(group).orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("m")
    g = g.join(F.broadcast(h), [group, "b"]).withColumn("upto", F.col("before") + F.sum("n").over(W.partitionBy(group, "b").orderBy(value).rowsBetween(W.unboundedPreceding, 0)))
    a = g.groupBy(group).agg(F.sum(F.col("pos") * (F.col("upto") - F.col("n") + (F.col("n") + 1) / 2)).alias("s"), F.sum("pos").alias("p"), F.sum("n").alias("n"))
    return a.select(group, F.try_divide(F.col("s") - F.col("p") * (F.col("p") + 1) / 2, F.nullif(F.col("p") * (F.col("n") - F.col("p")), F.lit(0))).alias("auc"))


def hash_sample(df: DataFrame, share: float, *keys: str) -> DataFrame:
    """About ``share`` of the rows, by hash of their keys: no order, and the same rows on every run."""
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1_000_000)) < int(share * 1_000_000))
