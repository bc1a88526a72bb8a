"""File sources and sinks of the linkage job: entity tables, ground truth, pair tables and result lists.

Tab-separated files have a header, every column is read as text, and only the empty field is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY = "entity_id string, business_name string, business_address string, country string"
TRUTH = "source1_entity_id string, matched_entity_ids string"


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """No quoting, no trimming; a schema is given, so nothing is inferred by a second scan."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, quote="", escape="", nullValue="", emptyValue="", encoding="UTF-8")


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Entities with the source that their id begins with."""
    return read_tsv(spark, path, ENTITY).withColumn("source", F.split_part("entity_id", F.lit("-"), F.lit(1)))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """One row per true pair: ``s1``, ``cand``; an S1 without matches has one row with a null ``cand``."""
    lists = read_tsv(spark, path, TRUTH)
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), F.trim), lambda x: x != "")
    return lists.select(F.col("source1_entity_id").alias("s1"), F.explode_outer(ids).alias("cand")).distinct()


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Text columns only; an existing target is an error unless ``mode`` says otherwise; a tab or line break inside a field becomes a space, so that every row stays one line."""
    clean = [F.regexp_replace(F.col(c).cast("string"), "[\t\r\n]+", " ").alias(c) for c in df.columns]
    df.select(*clean).write.mode(mode).csv(path, sep="\t", header=True, quote="", escape="", nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def result_lists(universe: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """For each S1 of ``universe(s1)`` the comma list of ``pairs(s1, cand, p)``, best first; empty where it has none."""
    ranked = F.array_sort(F.collect_set(F.struct((-F.col("p")).alias("q"), F.col("cand").cast("string").alias("cand"))))
    lists = pairs.groupBy("s1").agg(F.array_join(F.transform(ranked, lambda x: x["cand"]), ",").alias(column))
    return universe.select("s1").distinct().join(lists, "s1", "left").select(F.col("s1").alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column))


def write_results(universe: DataFrame, matches: DataFrame, candidates: DataFrame, folder: str) -> None:
    """The two result tables of a run: matches that the rule keeps, and all candidates; those of an earlier run are replaced."""
    write_tsv(result_lists(universe, matches, "matched_entity_ids"), f"{folder}/matching_results.tsv", "overwrite")
    write_tsv(result_lists(universe, candidates, "candidate_entity_ids"), f"{folder}/candidate_pairs.tsv", "overwrite")


def with_optional(df: DataFrame, columns: list[str], kind: str = "string") -> DataFrame:
    """``df`` with exactly the columns wanted; those that it lacks are null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c in columns])


def read_clean(spark: SparkSession, path: str, columns: list[str] | None = None, country: str | None = None) -> DataFrame:
    """A clean table (Parquet, or CSV with a header), its wanted columns and one country; both reach the scan."""
    df = spark.read.csv(path, header=True, escape='"', multiLine=True) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)
    if country is not None:
        df = df.where(F.trim("country_clean") == country) if path.rstrip("/").endswith(".csv") else df.where(F.col("country_clean") == country)
    return df if columns is None else with_optional(df, columns)


def read_records(spark: SparkSession, paths: list[str], columns: list[str], country: str | None = None) -> DataFrame:
    """Several clean tables as one, one row an id: that of the first table, then the least by content."""
    parts = [read_clean(spark, p, None, country).transform(with_optional, ["entity_id", *[c for c in columns if c != "entity_id"]]).withColumn("src", F.lit(i)) for i, p in enumerate(paths)]
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p)
    rest = [c for c in all_.columns if c != "entity_id"]
    first = F.min_by(F.struct(*rest), F.struct("src", F.xxhash64(*rest)))
    return all_.groupBy("entity_id").agg(first.alias("r")).select("entity_id", "r.*")


PAIR_TYPES = {"score": "double", "n_keys": "long", "evidence_mask": "long", "n_evidence": "long", "cand_rank": "long", "p_block": "double", "label": "int"}


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Candidate pairs: ids and whatever blocking columns there are, cast where possible (null otherwise); label 0 where unknown."""
    df = spark.read.csv(path, sep="\t", header=True, quote="")
    cols = [F.col(c).try_cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in PAIR_TYPES.items()]
    return df.select(F.col("source1_entity_id").alias("s1"), F.col("candidate_entity_id").alias("cand"), *cols).fillna(0, ["label"])


def write_pairs(df: DataFrame, path: str, mode: str = "error") -> None:
    """Candidate pairs as tab-separated files, one folder a country, each in order of S1 and falling score."""
    df.repartition("country").sortWithinPartitions("country", "source1_entity_id", F.desc("p_block")).write.mode(mode).partitionBy("country").csv(path, sep="\t", header=True, quote="", nullValue="")


def write_features(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def feature_names(spark: SparkSession, path: str) -> list[str]:
    """Columns of a feature file, from its footer."""
    return spark.read.parquet(path).schema.names


def read_features(spark: SparkSession, path: str, features: list[str]) -> DataFrame:
    """Ids, country and the wanted features; others are not read, absent ones are null."""
    have = feature_names(spark, path)
    ids = [c for c in ("country", "s1", "cand", "fold", "label") if c in have]
    return spark.read.parquet(path).transform(with_optional, [*ids, *features], "double")


def read_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="entity_id string, split string")


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"')


def stale(spark: SparkSession, outputs: list[str], inputs: list[str], rebuild: bool = False) -> bool:
    """Whether an output is missing or older than an input, or a rebuild is asked for; in any file system that Spark reads."""

    def times(path: str) -> list[int]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        return [s.getModificationTime() for s in ([fs.getFileStatus(p)] if fs.exists(p) else [])]

    made = [times(p) for p in outputs]
    return rebuild or any(not t for t in made) or max((x for p in inputs for x in times(p)), default=0) > min(x for t in made for x in t)
