"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import duckdb
import pytest

from entres.functions import strings
from entres.plans import registry
from entres.sources import fixtures
from entres.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def text(v):
    return "null" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(registry.ORACLE_SQL[name])
    names = list(rel.columns)
    assert sorted(names) == cols
    want = sorted(tuple(text(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == want


def test_similarities():
    assert abs(strings.winkler("martha", "marhta") - 0.961111) < 1e-5
    assert strings.winkler("", "") == 1.0
    assert strings.token_set("new york mets", "mets of new york") == 1.0
    assert strings.token_sort("b a", "a b") == 1.0
    assert strings.partial("abc", "xxabcxx") == 1.0
    for f in (strings.winkler, strings.token_sort, strings.token_set, strings.partial):
        assert 0.0 <= f("laxmi stores", "lakshmi store") <= 1.0


def test_name_classes_lose_no_pair(spark):
    """Class pairs and membership expand to all record pairs of a country whose names share their first word."""
    recs = [r for r in fixtures.run(spark, SF, "SELECT * FROM recs").collect() if r.country is not None and r.business_name]
    want = {}
    for a in recs:
        for b in recs:
            if a.source == "S1" != b.source and a.country == b.country and a.business_name.split(" ")[0] == b.business_name.split(" ")[0]:
                x, y = ({w for w in r.business_name.lower().split(" ") if w} for r in (a, b))
                want[a.entity_id, b.entity_id] = round(len(x & y) / len(x | y), 6)
    members = {}
    for r in registry.QUERIES["m6_name_classes"](spark, SF).collect():
        members.setdefault(r.rep, []).append(r.entity_id)
    got = {}
    for r in registry.QUERIES["m7_jaccard"](spark, SF).collect():
        assert (len(members[r.s1]), len(members[r.cand])) == (r.s1_members, r.cand_members)
        got |= {(a, b): round(r.jaccard, 6) for a in members[r.s1] for b in members[r.cand]}
    assert want and got == want
