"""Similarities of whole batches against the ones of a pair, and what the pair features write and deal out."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entres.functions import batches, strings
from entres.operators import cleaning, features, index, scoring
from entres.plans import linkage
from entres.sources import stored as store

LISTS = pa.list_(pa.struct([("token", pa.string()), ("w", pa.float64())]))


def _texts(rng, n):
    for _ in range(n):
        letters = rng.choice(["ab", "abcdefgh", "aéü 網", "ab c "])
        word = lambda k, al=letters: "".join(rng.choice(al) for _ in range(rng.randint(0, k)))
        a = word(rng.choice([3, 8, 30, 90]))
        cut = rng.randint(0, len(a))
        yield a, rng.choice([word(30), word(90), a[:cut] + word(2) + a[cut:], " ".join(reversed(a.split()))])


@pytest.mark.parametrize("name", ["indel_ratio", "winkler", "partial", "token_sort", "token_set"])
def test_batches_equal_pairs(name):
    rng = random.Random(name)
    pairs = [("", ""), ("a", "a"), ("", "abc"), ("a" * 64, "a" * 63 + "b"), ("é" * 65, "é" * 64), *_texts(rng, 1500)]
    got = getattr(batches, name)([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [getattr(strings, name)(a, b) for a, b in pairs]


def _lists(rng, n):
    words = ["alpha", "alpa", "beta", "betta", "gamma", "12", "a1", "x", "delta co", "네트"]
    return [[(w, rng.choice([0.2, 0.5, 0.9])) for w in rng.sample(words, rng.randint(0, 9))] for _ in range(n)]


def _arrow(rows):
    return pa.array([[{"token": t, "w": w} for t, w in r] for r in rows], type=LISTS)


@pytest.mark.parametrize("only", [None, "^[^0-9]{2,}$"])
def test_soft_batch(only):
    rng = random.Random(5)
    a, b = _lists(rng, 400), _lists(rng, 400)
    noise = [[t for t, _ in r if rng.random() < 0.2] for r in b]
    cut = lambda r: [(t, np.float64(w)) for t, w in r if not only or re.search(only, t)][:5]
    want = [features.soft(cut(x), cut(y), set(n), strings.winkler) for x, y, n in zip(a, b, noise, strict=True)]
    # of a slice, as Arrow hands them on
    got = features.soft_batch(_arrow([[], *a]).slice(1), _arrow([[], *b]).slice(1), pa.array([[], *noise], type=pa.list_(pa.string())).slice(1), 5, only)
    assert [tuple(None if np.isnan(v) else v for v in row) for row in zip(*got, strict=True)] == want


def test_overlap_batch():
    rng = random.Random(6)
    a, b = _lists(rng, 300), _lists(rng, 300)
    got = list(zip(*features.overlap_batch(_arrow(a), _arrow(b)), strict=True))
    for x, y, row in zip(a, b, got, strict=True):
        mine, theirs = dict(x), dict(y)
        shared = [w for t, w in x if t in theirs]
        norm = sum(w * w for w in mine.values()) ** 0.5 * sum(w * w for w in theirs.values()) ** 0.5
        cos = sum(w * theirs[t] for t, w in x if t in theirs) / norm if norm else 0.0
        want = (cos, len(shared), sum(shared), max(shared, default=0), max((w for t, w in x if t not in theirs), default=0), max((w for t, w in y if t not in mine), default=0))
        assert np.allclose(row, want, rtol=0, atol=1e-12)
    empty = _arrow([[], []])
    assert features.overlap_batch(empty, empty)[0].tolist() == [0.0, 0.0]


@pytest.fixture(scope="module")
def made(spark):
    rows = [(f"S{1 + i % 3}-{i}", "us", f"{'north alpha beta gamma delta'.split()[i % 5]} wind trading {i % 4}", f"{i} main street town {i % 7}") for i in range(60)]
    r = features.feature_records(cleaning.clean_records(spark.createDataFrame(rows, "entity_id string, country string, business_name string, business_address string")))
    pairs = [("us", f"S1-{3 * i}", f"S{2 + j % 2}-{3 * ((i + j) % 20) + 1 + j % 2}", 1.0, 2, 3, 2, None if (i + j) % 5 == 4 else (i * j % 7) / 7) for i in range(20) for j in range(6)]
    return r, spark.createDataFrame(pairs, "country string, s1 string, cand string, score double, n_keys long, evidence_mask long, n_evidence long, p_block double")


def _kept(monkeypatch):
    seen = []
    monkeypatch.setattr(features, "stored", lambda df, name: seen.append((name, df.columns)) or df)
    return seen


SIB = [f for f in features.FEATURES if f.startswith("sib_")]


def test_siblings_read_no_combined_score(spark, made, monkeypatch):
    """without a null p_block the siblings need no similarity of pairs; with one they do, and are the same as among all features."""
    r, pairs = made
    known = pairs.fillna(0.4, ["p_block"])
    key = lambda x: (x.s1, x.cand)
    for p, words in ((known, False), (pairs, True)):
        every = {key(x): x for x in features.pair_features(p, r).collect()}
        seen = _kept(monkeypatch)
        got = features.pair_features(p, r, SIB).collect()
        assert len(got) == 120 and all([x[n] for n in SIB] == [every[key(x)][n] for n in SIB] for x in got)
        assert seen[0][0] == "pairs-features" and ("name_soft_tfidf" in seen[0][1]) == words and "__s1_name" not in seen[0][1]
        monkeypatch.undo()


def test_context_deals_rows_twice(spark, made, monkeypatch):
    """all windows over an S1, then all over a candidate."""
    r, pairs = made
    names = features.FEATURES[features.FEATURES.index("s1_n_cand") : features.FEATURES.index("sib_anchor_pb")]
    values = spark.createDataFrame([("s", "c", *[0.5] * 5)], "s1 string, cand string, blk_p_block double, cand_src double, name_soft_tfidf double, addr_soft_tfidf double, name_char_tfidf_cos double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made_ = [n for n in names if n in features.CONTEXT_FEATURES]
        plan = features.with_context(values.repartition(3)).select("s1", "cand", *made_)._jdf.queryExecution().executedPlan().toString()
        assert len(made_) > 20 and plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_name_features_write_nothing(spark, made, monkeypatch):
    """pairs with the words of both records are neither written nor dealt again."""
    r, pairs = made
    seen = _kept(monkeypatch)
    df = features.pair_features(pairs, r, ["name_lev", "name_partial_compact", "name_char_tfidf_cos", "phon_soft_tfidf"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert not seen and "RoundRobinPartitioning" not in plan


def test_stored_frees_shuffles(spark):
    """the shuffle files behind a stored table go with its write; the session's setting comes back."""
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    shuffles = lambda: {str(f.getName()) for f in (files().apply(i) for i in range(files().size())) if f.getName().startswith("shuffle_")}
    was, before = spark.conf.get(store._FREED, "false"), shuffles()
    out = store.stored(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "freed")
    assert out.count() == 7 and spark.conf.get(store._FREED) == was
    left = {n for n in shuffles() - before if n.endswith(".data")}
    assert len(left) <= 8  # those of the count above


def test_scored_is_the_pool(spark, monkeypatch):
    """the pool of the pair features, made without the ranker's other columns, has the rows and probabilities of the whole one."""
    sf = "/root/testdata/sf0.001/"
    lean, key = [], lambda x: (x.s1, x.cand)
    monkeypatch.setattr(linkage, "stored", lambda df, name: lean.append((name, len(df.columns))) or store.stored(df, name))
    monkeypatch.setattr(linkage, "_MADE", {})
    got = {key(x): (x.score, x.evidence_mask, x.p_block) for x in linkage.scored(spark, sf).collect()}
    want = {key(x): (x.score, x.evidence_mask, x.p) for x in linkage.ranked(spark, sf).collect()}
    assert got == want and len(got) > 100
    sizes = dict(lean)
    assert sizes["fixture-scored"] == 8 and sizes["fixture-scored-pre"] < 10 < len(scoring.PRE_FEATURES) < sizes["fixture-pool"]


def test_keys_are_counted_once(spark, monkeypatch):
    """the index is a stored table, and not counted again for each side of the pairs."""
    seen = []
    keys = spark.createDataFrame([("us", side, f"{side}{i}", 0, f"k{i % 3}") for i in range(9) for side in "sc"], "country string, side string, id string, family int, key string")
    records = spark.createDataFrame([("us", s) for s in ("S1", "S2") * 9], "country_clean string, source string")
    monkeypatch.setattr(index, "family_keys", lambda records, begun=None: keys)
    monkeypatch.setattr(index, "stored", lambda df, name: seen.append(name) or store.stored(df, name))
    got = {(x.s1, x.cand): x.n_keys for x in index.generate(records).collect()}
    assert seen == ["keys", "index"] and got == {(f"s{i}", f"c{j}"): 1 for i in range(9) for j in range(9) if i % 3 == j % 3}
