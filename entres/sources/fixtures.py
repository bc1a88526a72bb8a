"""Tables and fixture views, in Spark SQL and in DuckDB SQL.

``recs`` are records from documents, ``pairs`` a scored bipartite graph from lineitem and orders,
``addrs`` addresses from part, ``webs`` hosts from pages, ``tok`` the distinct name tokens of records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_PAIRS = """SELECT s1, cand, substr(o_orderpriority,1,1) AS country, (v % 9973)/cast(9973.0 as double) AS p, label
FROM (SELECT l_orderkey AS s1, l_partkey AS cand, min(cast(round(l_extendedprice*100) AS bigint)) AS v,
 max(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS label FROM lineitem GROUP BY l_orderkey, l_partkey) t JOIN orders ON o_orderkey = s1"""
_ADDRS = """SELECT p_partkey AS rid, concat('#', cast(p_size AS string), ' ', p_name, ' Road, ', p_brand, ', 00', cast(p_partkey AS string),
 'th ', p_type, ' Street ', cast(10000+p_partkey AS string)) AS business_address FROM part"""

SPARK = {
    "recs": r"""SELECT concat('S', cast(1 + doc_id % 3 AS string), '-', cast(doc_id AS string)) AS entity_id, concat('S', cast(1 + doc_id % 3 AS string)) AS source,
 lang AS country, array_join(slice(w,1,4),' ') AS business_name, array_join(slice(w,5,10),' ') AS business_address
FROM (SELECT doc_id, lang, split(trim(regexp_replace(text,'[ \\t\\r\\n]+',' ')),' ') AS w FROM documents)""",
    "pairs": _PAIRS,
    "addrs": _ADDRS,
    "webs": r"SELECT page_id AS rid, regexp_extract(lower(url),'https?://(?:www\\.)?([a-z0-9.-]+)',1) AS host FROM pages",
    "tok": "SELECT country, source, entity_id, explode(array_distinct(filter(split(lower(business_name),' '), x -> x <> ''))) AS token FROM recs",
    "atok": "SELECT country, source, entity_id, explode(array_distinct(filter(split(lower(business_address),' '), x -> x <> ''))) AS token FROM recs",
    "gram": "SELECT country, source, entity_id, explode(array_distinct(transform(sequence(1, greatest(length(n) - 3, 1)), i -> substr(n, i, 4)))) AS token FROM (SELECT *, replace(lower(business_name), ' ', '') AS n FROM recs)",
}
DUCK = {
    "recs": r"""SELECT concat('S', cast(1 + doc_id % 3 AS varchar), '-', cast(doc_id AS varchar)) AS entity_id, concat('S', cast(1 + doc_id % 3 AS varchar)) AS source,
 lang AS country, array_to_string(w[1:4],' ') AS business_name, array_to_string(w[5:14],' ') AS business_address
FROM (SELECT doc_id, lang, string_split(trim(regexp_replace(text,'[ \t\r\n]+',' ','g')),' ') AS w FROM documents)""",
    "pairs": _PAIRS,
    "addrs": _ADDRS,
    "webs": r"SELECT page_id AS rid, regexp_extract(lower(url),'https?://(?:www\.)?([a-z0-9.-]+)',1) AS host FROM pages",
    "tok": "SELECT country, source, entity_id, unnest(list_distinct(list_filter(string_split(lower(business_name),' '), lambda x: x <> ''))) AS token FROM recs",
    "atok": "SELECT country, source, entity_id, unnest(list_distinct(list_filter(string_split(lower(business_address),' '), lambda x: x <> ''))) AS token FROM recs",
    "gram": "SELECT country, source, entity_id, unnest(list_distinct(list_transform(range(1, greatest(length(n) - 3, 1) + 1), lambda i: substr(n, cast(i as integer), 4)))) AS token FROM (SELECT *, replace(lower(business_name), ' ', '') AS n FROM recs)",
}
_NEEDS = {"tok": ("recs",), "atok": ("recs",), "gram": ("recs",)}


def names(sql: str, views: dict[str, str]) -> list[str]:
    """Fixture views that a statement uses, in an order in which each may use the ones before it."""
    import re

    used = [v for v in views if re.search(rf"\b{v}\b", sql)]
    return list(dict.fromkeys([d for v in used for d in (*_NEEDS.get(v, ()), v)]))


def with_views(sql: str, views: dict[str, str]) -> str:
    ctes = [f"{v} AS ({views[v]})" for v in names(sql, views)]
    body = sql.strip()
    if not ctes:
        return body
    return f"WITH {', '.join(ctes)}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {', '.join(ctes)} {body}"


def register(spark: SparkSession, sf_dir: str, sql: str) -> None:
    for t in TABLES:
        if t in sql:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    full = with_views(sql, SPARK)
    register(spark, sf_dir, full)
    return spark.sql(full)
