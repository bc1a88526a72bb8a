"""All queries of the library and the SQL that must give the same rows."""

from __future__ import annotations

from functools import partial

from entres.operators import aggregates, blocking, decision, ranking, text, tokens
from entres.plans import linkage
from entres.sources import fixtures


def _same(sql: str):
    return partial(_run, sql=sql)


def _run(spark, sf_dir, sql):
    return fixtures.run(spark, sf_dir, sql)


QUERIES: dict = {}
ORACLE_SQL: dict = {}
for module in (ranking, aggregates, decision, blocking, text, tokens):
    for name, sql in module.SQL.items():
        QUERIES[name] = _same(sql)
        ORACLE_SQL[name] = fixtures.with_views(sql, fixtures.DUCK)
    for name, (spark_sql, duck_sql) in getattr(module, "TWO", {}).items():
        QUERIES[name] = _same(spark_sql)
        ORACLE_SQL[name] = fixtures.with_views(duck_sql, fixtures.DUCK)
    for name, (query, duck_sql) in getattr(module, "FUNCTIONS", {}).items():
        QUERIES[name] = query
        if duck_sql:
            ORACLE_SQL[name] = fixtures.with_views(duck_sql, fixtures.DUCK)
QUERIES |= linkage.QUERIES
ORACLE_SQL |= {name: fixtures.with_views(sql, fixtures.DUCK) for name, sql in linkage.ORACLES.items()}
