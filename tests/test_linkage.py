"""Linkage operators on small frames: against plain Python, planted matches, round trips."""

import math
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from entres.functions import strings
from entres.operators import cleaning, decide, features, index, learn, ranking_ops, scoring
from entres.plans import linkage
from entres.sources import files
from entres.streaming import arrivals

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = {}
    for _ in range(600):
        s, c = rng.randrange(60), rng.randrange(90)
        p = round(rng.random(), 2)
        rows[s, c] = (str(s % 2), s, c, p if rng.random() > 0.05 else None, int(rng.random() < (p or 0)))
    return spark.createDataFrame(list(rows.values()), "country string, s1 long, cand long, p double, label int")


def grouped(rows, k):
    out = defaultdict(list)
    for r in rows:
        out[r[k]].append(r)
    return out


def test_rank_lead(scored):
    got = {(r.s1, r.cand): r for r in ranking_ops.rank_lead(scored, ["s1"], "p", "cand").collect()}
    for g in grouped(scored.collect(), "s1").values():
        order = sorted(g, key=lambda r: (r.p is None, -(r.p or 0), r.cand))
        for i, r in enumerate(order):
            other = [x.p for x in g if x is not r and x.p is not None]
            rank, lead = (None, None) if r.p is None else (i, r.p - max(other) if other else None)
            x = got[r.s1, r.cand]
            assert x.rank == rank and (x.lead == lead or abs(x.lead - lead) < 1e-12)


def test_top_share_running_auc(scored):
    x = scored.where("p is not null")
    rows = sorted(x.collect(), key=lambda r: (-r.p, r.s1, r.cand))
    keep = scored.sparkSession.createDataFrame([("0", 37), ("1", 111)], "country string, n long")
    for bins in (7, 4096):
        got = {(r.s1, r.cand) for r in ranking_ops.top_share(x, "country", "p", ["s1", "cand"], keep, bins).collect()}
        assert got == {(r.s1, r.cand) for c, n in (("0", 37), ("1", 111)) for r in [r for r in rows if r.country == c][:n]}
        run = {(r.s1, r.cand): r.hits for r in ranking_ops.running_count(x, "country", "p", ["s1", "cand"], "label", "hits", bins).collect()}
        auc = {r.country: r.auc for r in ranking_ops.auc(scored, "country", "p", "label", bins).collect()}
        for c in "01":
            mine, total = [r for r in rows if r.country == c], 0
            for r in mine:
                total += r.label
                assert run[r.s1, r.cand] == total
            pos, neg = [r.p for r in mine if r.label], [r.p for r in mine if not r.label]
            want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
            assert abs(auc[c] - want) < 1e-12


def test_affordable(spark):
    rng = random.Random(2)
    rows = [("x", f, str(k), rng.randint(1, 9), rng.randint(1, 40)) for f in range(3) for k in range(50)]
    df = spark.createDataFrame(rows, "country string, family int, key string, kn1 long, kn2 long")
    got = {(r.family, r.key) for r in index.affordable(df, 2500).collect()}
    order, total = sorted(rows, key=lambda r: (r[3] * r[4], r[1], r[2])), 0
    want = set()
    for r in order:
        total += r[3] * r[4]
        if total <= 2500:
            want.add((r[1], r[2]))
    assert got == want


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        ("S1-1", "Golden Harbor Trading Company Ltd", "12 Main Street, Springfield 12345"), ("S2-1", "golden harbor trading", "12 main st springfield 12345"), ("S3-1", "Golden Harbr Trading", ""),
        ("S1-2", "Lucky Hair Studio", "7 Oak Avenue, Shelbyville 54321"), ("S2-2", "LHS", "7 Oak Ave Shelbyville 54321"), ("S1-3", "Laxmi Ventures Pvt Ltd", "Plot 9 Sector 4, Delhi 110063"),
        ("S3-3", "lakshmi ventures", "plot 9 sector 4 delhi 110063"), ("S1-4", "Acme DBA Zenith Foods", "1 Rue Rivoli, Paris 75001"), ("S2-4", "Zenith Foods", "1 rue rivoli paris"), ("S2-9", None, None), ("S3-9", "", "null"),
    ]
    return cleaning.clean_records(spark.createDataFrame([(*r, " x  y ") for r in rows], "entity_id string, business_name string, business_address string, country string")).cache()


TRUE = {("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2"), ("S1-3", "S3-3"), ("S1-4", "S2-4")}


def test_clean_columns(records):
    assert len(records.columns) == 50 and records.first().country_clean == "x y"


def test_families(records):
    bit = {f: 1 << i for i, f in enumerate(index.FAMILY)}
    got = {(r.s1, r.cand): r for r in index.generate(records).collect()}
    assert TRUE <= set(got)
    assert got["S1-1", "S2-1"].evidence_mask & (bit["nmF_FF"] | bit["ad_full"] | bit["nm_set"] | bit["nm_pfx"]) == bit["nmF_FF"] | bit["ad_full"] | bit["nm_set"] | bit["nm_pfx"]
    assert got["S1-1", "S3-1"].evidence_mask & bit["nm_char"] and not got["S1-1", "S2-1"].evidence_mask & bit["nm_char"]  # only where the address is low
    assert got["S1-3", "S3-3"].evidence_mask & bit["skF_FF"] and not got["S1-3", "S3-3"].evidence_mask & bit["nmF_FF"]
    assert got["S1-4", "S2-4"].evidence_mask & bit["nmF_FF"]  # by the alias half
    assert all(r.n_evidence == bin(r.evidence_mask).count("1") and r.n_keys >= r.n_evidence for r in got.values())


def test_blockers(spark, records):
    truth = spark.createDataFrame(sorted(TRUE), "s1 string, cand string")
    got = {r.blocker: r for r in index.blocker_report(records, truth).collect()}
    assert got["name_exact"].found == 1 and got["skel2_exact"].found >= 2 and got["addr_pin"].found == 3 and got["addr_sorted"].found == 3
    assert {r.s1 for r in index.missed(records, truth, ["addr_pin"]).collect()} == {"S1-1", "S1-4"}


def test_pair_features(spark, records):
    pairs = spark.createDataFrame([("x y", *t, 1.0, 0.9) for t in sorted(TRUE)] + [("x y", "S1-2", "S2-1", 0.2, 0.1), ("x y", "S1-1", "S2-9", 0.1, None)], "country string, s1 string, cand string, score double, p_block double")
    out = features.pair_features(pairs, features.feature_records(records))
    assert out.columns == ["country", "s1", "cand", *features.FEATURES] and len(features.FEATURES) == 158
    f = {(r.s1, r.cand): r for r in out.collect()}
    a = f["S1-1", "S2-1"]
    assert a.name_lev == 1.0 and a.name_set_eq == 1.0 and abs(a.name_word_tfidf_cos - 1) < 1e-9 and a.addr_exact_eq == 1.0 and a.pin_eq == 1.0 and a.f_house_eq == 1.0 and a.lf_cand == 0.0 and a.lf_s1 == 1.0
    assert f["S1-2", "S2-2"].name_abbrev == 1.0 and f["S1-3", "S3-3"].name_phon_lev == 1.0
    assert f["S1-4", "S2-4"].alias_exact == 1.0 and f["S1-4", "S2-4"].alias_any == 1.0 and a.alias_best_tset is None
    b = f["S1-1", "S3-1"]
    assert b.addr_missing_cand == 1.0 and b.addr_jaccard is None and 0.9 < b.noaddr_name_soft <= 1.0 and b.sib_anchor_pb == 0.9 and b.pb_rank_s1 is not None
    e = f["S1-1", "S2-9"]
    assert e.name_lev is None and e.name_soft_tfidf is None and e.pb_rank_s1 is None and e.blk_n_keys is None


def test_some_features(spark, records, monkeypatch):
    """A few features are those of all features, and nothing is made that they do not read."""
    pairs = spark.createDataFrame([("x y", *t, 1.0, 0.9) for t in sorted(TRUE)] + [("x y", "S1-2", "S2-1", 0.2, 0.1), ("x y", "S1-1", "S2-9", 0.1, None)], "country string, s1 string, cand string, score double, p_block double")
    r = features.feature_records(records)
    key = lambda x: (x.s1, x.cand)
    every = {key(x): x for x in features.pair_features(pairs, r).collect()}
    made = []
    monkeypatch.setattr(features, "stored", lambda df, name: made.append(name) or df)
    for starts in [("lf_", "fld_"), ("alias_",), ("x_",), ("name_num", "pin_"), ("s1_n_cand", "cand_n_s1"), ("s1_name_dup", "cand_fw"), *[(s,) for s in features.CONTEXT_READS]]:
        names = [n for n in features.FEATURES if n.startswith(starts)]
        got = features.pair_features(pairs, r, names)
        assert names and got.columns == ["country", "s1", "cand", *names]
        assert {key(x): tuple(x[n] for n in names) for x in got.collect()} == {k: tuple(x[n] for n in names) for k, x in every.items()}
    made.clear()
    names = [n for n in features.FEATURES if n.startswith(("blk_", "evb_"))]
    got = features.pair_features(pairs, features.record_ids(records), names)
    assert made == []
    assert {key(x): tuple(x[n] for n in names) for x in got.collect()} == {k: tuple(x[n] for n in names) for k, x in every.items()}


def test_candidates(records):
    out = scoring.candidates(records).collect()
    assert TRUE <= {(r.source1_entity_id, r.candidate_entity_id) for r in out}


def test_rule_and_score(spark, scored):
    pairs = scored.where("p is not null")
    universe = pairs.groupBy("s1").agg(F.sum("label").alias("n_true")).union(spark.createDataFrame([(900, 0), (901, 2)], "s1 long, n_true long"))
    rows = {(r.opc_r, r.thr): r for r in decide.sweep(universe, pairs, (1.0, 0.9), (0.5, 0.7)).collect()}
    for (opc, thr), r in rows.items():
        s = decide.score(decide.per_s1(universe, decide.decide(pairs, {"default": {"thr": thr, "opc_r": opc}}))).first()
        assert abs(s.f05 - r.f05) < 1e-12 and s.n_pred == r.n_pred
    best = decide.search(universe, pairs, 2, (1.0, 0.0), (0.3, 0.5, 0.7, 0.9))
    s = decide.score(decide.per_s1(universe, decide.decide(pairs, best))).first()
    assert abs(s.f05 - best["f05"]) < 1e-12 and s.f05 >= max(r.f05 for r in decide.sweep(universe, pairs, (1.0, 0.0), (0.3, 0.5, 0.7, 0.9)).collect()) - decide.SLACK - 1e-12
    report = {r.bucket: r for r in decide.loss_report(decide.per_s1(universe, decide.decide(pairs, best))).collect()}
    assert abs(report["ALL"].total / report["ALL"].s1s - (1 - s.f05)) < 1e-9 and report["no candidates"].s1s == 2


def test_learning(spark, records, tmp_path):
    rng = random.Random(8)
    rows = []
    for s in range(120):
        for c in range(4):
            y = int(c == s % 4)
            rows.append(("x", s, s * 4 + c + rng.randrange(3), y, y + rng.gauss(0, 0.4) if rng.random() > 0.1 else None, rng.random(), 1.0))
    df = learn.with_folds(spark.createDataFrame(rows, "country string, s1 long, cand long, label int, good double, noise double, flat double").dropDuplicates(["s1", "cand"])).cache()
    names = ["good", "noise", "flat"]
    est = learn.gbt(trees=4, depth=3)
    models, oof = learn.kfold(df, names, est, 2)
    assert oof.count() == df.where("fold < 2").count() and learn.top_features(models, names, 1) == ["good"]
    assert learn.auc(oof.withColumn("g", F.lit(1)), "g", "p", "label").first().auc > 0.85
    assert learn.validation(df.select("country", "s1").distinct()).groupBy("s1").count().where("count > 1").count() == 0
    learn.save(f"{tmp_path}/m", spark, models, {"features": names})
    back, meta = learn.load(f"{tmp_path}/m", spark, names)
    a = learn.mean_probability(models, df, names).agg(F.sum("p")).first()[0]
    assert abs(a - learn.mean_probability(back, df, names).agg(F.sum("p")).first()[0]) < 1e-9
    with pytest.raises(ValueError):
        learn.load(f"{tmp_path}/m", spark, ["other"])
    universe = df.groupBy("s1").agg(F.sum("label").alias("n_true"))
    keep, gone = learn.select_features(df.withColumn("quick", F.lit(True)), universe, df, names, est)
    assert "good" in keep and gone["flat"] == "empty or constant"
    text = df.select("country", F.concat(F.lit("S1-"), "s1").alias("s1"), F.concat(F.lit("S2-"), "cand").alias("cand"), "label", "good", "noise")
    out = learn.predict(text, records, models, names, [], {"default": {"thr": 0.5, "opc_r": 0.9}})
    hits = out.where("pred").agg(F.avg("label")).first()[0]
    assert hits > 0.8 and out.count() == text.count()


def test_partial_passes(monkeypatch):
    """The windows of :func:`strings.partial` one by one, and how few of them are looked at."""
    calls, rng = [], random.Random(5)
    common = strings.common
    monkeypatch.setattr(strings, "common", lambda a, b: calls.append(1) or common(a, b))
    for _ in range(500):
        a, b = ("".join(rng.choices("abcd", k=rng.randrange(12))) for _ in "ab")
        s, t = sorted((a, b), key=len)
        n = len(s)
        whole = [(s, t[i : i + n]) for i in range(len(t) - n + 1)] + [(s, w) for i in range(1, n) for w in (t[:i], t[-i:])]
        whole += [(t, w) for i in range(1, n) for w in (s[:i], s[-i:])] if len(s) == len(t) else []
        want = max(2.0 * common(x, y) / (len(x) + len(y)) for x, y in whole) if n else float(not t)
        assert strings.partial(a, b) == want
    calls.clear()
    assert strings.partial("northwind trading", "alpha beta gamma delta northwind trading") == 1.0 and len(calls) < 25  # 57 windows


def test_weighted_columns(spark, records):
    r = spark.createDataFrame([("x", 1, ["a", "b", "a"], ["a"]), ("x", 2, ["b"], None), ("y", 3, ["b"], ["c", "b"])], "country string, id int, u array<string>, v array<string>")
    got = {x.id: x for x in features._weighted(r, {"u": "uw", "v": "vw"}).collect()}
    idf = lambda df, n: (math.log((1 + n) / (1 + df)) + 1) / (math.log(1 + n) + 1)
    text = lambda v: [(t.token, round(t.w, 9)) for t in v]
    want = lambda *v: [(t, round(idf(df, n), 9)) for t, df, n in v]
    assert [text(got[i].uw) for i in (1, 2, 3)] == [want(("a", 1, 2), ("b", 2, 2)), want(("b", 2, 2)), want(("b", 1, 1))]
    assert [text(got[i].vw) for i in (1, 2, 3)] == [want(("a", 1, 2)), [], want(("b", 1, 1), ("c", 1, 1))]
    begun = index.ready(records)
    keys = lambda k: sorted(tuple(x) for x in k.collect())
    assert keys(index.family_keys(records, begun)) == keys(index.family_keys(records))
    block = lambda b: sorted((x.id, sorted(x.R), round(x.A_sum, 9), x.low, x.name_amb) for x in b.collect())
    assert block(scoring.block_records(records, begun)) == block(scoring.block_records(records))


def test_sums_of_any_order(spark):
    """Scores and rarity sums are the same to the last digit however the rows are dealt."""
    rng = random.Random(6)
    index_ = spark.createDataFrame([("x", f, f"k{i}", 1, 1, rng.random()) for f in range(4) for i in range(9)], "country string, family int, key string, kn1 long, kn2 long, w double")
    rows = [("x", side, f"{side}{n}", f, f"k{i}") for side in "sc" for n in range(12) for f in range(4) for i in range(9)]
    found = []
    for parts in (1, 5, 9):
        rng.shuffle(rows)
        keys = spark.createDataFrame(rows, "country string, side string, id string, family int, key string").repartition(parts)
        got = index.pairs(keys, index_.repartition(parts)).collect()
        assert len(got) == 144 and len({r.score for r in got}) == 1
        found.append(got[0].score)
    assert len(set(found)) == 1 and abs(found[0] - sum(r.w for r in index_.collect())) < 1e-9
    words = [f"w{i}" for i in range(30)]
    side = [("x", "s", i, rng.sample(words, 20)) for i in range(40)]
    sums = set()
    for parts in (1, 5, 9):
        for_all = [("x", "c", i, rng.sample(words, 30)) for i in range(40)]
        r = spark.createDataFrame([*side, *for_all], "country string, side string, id int, raw array<string>").repartition(parts)
        sums |= {x.R_sum for x in scoring._rarity(r, {"raw": "R"}).where("side = 'c'").collect()}
    assert len(sums) == 1


def test_made_once(spark):
    made = []
    table = linkage._once("test", lambda s, d: made.append(d) or time.sleep(0.5) or s.range(1), write=False)
    linkage._at_once(spark, "/none", table, table, table)
    assert made == ["/none"] and table(spark, "/none").count() == 1


def test_graph_rounds(spark, records, scored):
    text = scored.where("p is not null").select("country", F.concat(F.lit("S1-"), "s1").alias("s1"), F.concat(F.lit("S2-"), "cand").alias("cand"), "p", "label")
    x = learn.with_folds(text, 2).withColumn("raw1", F.col("p") * 2)
    rounds, train, valid = learn.graph_rounds(x.where("fold = 0 or fold = 1"), x.limit(20).withColumn("s1", F.concat("s1", F.lit("v"))), records, ["raw1"], 1, learn.gbt(trees=2, depth=2), 2)
    assert train.count() == x.count() and valid.count() == 20 and train.where("p < 0 or p > 1").count() == 0
    assert set(rounds[0]["features"]) <= set(decide.level2(x.withColumn("l1", F.col("p")), records, [], ["raw1"]).columns)


def test_pre_score_fit(spark):
    x = linkage.pre(spark, SF).withColumn("label", F.col("eq_raw").cast("int"))
    fitted = learn.fit_pre_score(x)
    z = scoring.pre_score(x.drop("pre"), **fitted)
    assert learn.auc(z.withColumn("g", F.lit(1)), "g", "pre", "label").first().auc > 0.95


def test_sources(spark, tmp_path, records):
    files.write_features(records, f"{tmp_path}/c")
    got = files.read_records(spark, [f"{tmp_path}/c", f"{tmp_path}/c"], ["name_core", "not_there"], "x y")
    assert got.count() == records.count() and got.columns == ["entity_id", "name_core", "not_there", "src"] and got.where("src = 0").count() == got.count()
    assert "PushedFilters: [IsNotNull(country_clean)" in files.read_clean(spark, f"{tmp_path}/c", ["entity_id"], "x y")._jdf.queryExecution().toString()
    pairs = spark.createDataFrame([("x", "S1-1", "S2-1", 1.5, 0.5), ("y", "S1-2", "S2-2", 0.5, 0.25)], "country string, source1_entity_id string, candidate_entity_id string, score double, p_block double")
    files.write_pairs(pairs, f"{tmp_path}/p")
    assert sorted((r.s1, r.score, r.label, r.n_keys) for r in files.read_pairs(spark, f"{tmp_path}/p").collect()) == [("S1-1", 1.5, 0, None), ("S1-2", 0.5, 0, None)]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        files.write_features(records, f"{tmp_path}/c")
    assert files.read_features(spark, f"{tmp_path}/c", ["name_char_len", "zz"]).columns == ["country", "name_char_len", "zz"]
    assert files.stale(spark, [f"{tmp_path}/none"], [f"{tmp_path}/c"]) and not files.stale(spark, [f"{tmp_path}/p"], [f"{tmp_path}/c"]) and files.stale(spark, [f"{tmp_path}/p"], [f"{tmp_path}/c"], True)
    files.write_csv(spark.createDataFrame([("S1-1", "val")], "entity_id string, split string"), f"{tmp_path}/s")
    assert files.read_split(spark, f"{tmp_path}/s").first().split == "val"


def test_arrivals(spark, tmp_path, records):
    reference = arrivals.reference_keys(records.where("source = 'S1'"))
    records.where("source <> 'S1'").select("entity_id", "country_clean", "name_core").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("entity_id string, country_clean string, name_core string").parquet(f"{tmp_path}/in")
    q = arrivals.matches(stream, reference).writeStream.format("memory").queryName("arrived").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {(r.s1, r.cand) for r in spark.table("arrived").collect()} == {("S1-1", "S2-1")}


@pytest.mark.parametrize("name", sorted(set(linkage.QUERIES) - set(linkage.ORACLES)))
def test_query_runs(spark, name):
    df = linkage.QUERIES[name](spark, SF)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)
