"""Graph features of scored pairs, the decision rule and its search, the macro F0.5 and where it is lost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from entres.functions import text as T

from .ranking_ops import best_other, rank_lead

ANCHOR, LIKELY, SHARED = 0.9, 0.5, (2, 50)
CAND_FIELDS = ["name_compact", "name_skeleton", "name_first_token", "address_core", "address_pin", "house_number", "street_name"]
S1_FIELDS = ["name_compact", "name_skeleton", "address_core", "address_pin", "house_number"]
OPC, THRESHOLDS, MIN_PRECISION, SLACK = (1.0, 0.97, 0.9, 0.0), tuple(round(0.30 + 0.01 * i, 2) for i in range(66)), 0.996, 0.0003


def level2(pairs: DataFrame, records: DataFrame, extras: list[str] = (), raw: list[str] = ()) -> DataFrame:
    """``pairs(s1, cand, p, ...)`` with the features of a pair's group; ``records`` are clean rows.

    ``extras`` are other probabilities, ``raw`` pair features that are handed on.
    """
    p = F.col("p")
    x = pairs
    x = rank_lead(x, ["s1"], "p", "cand", "s1_rank", "s1_lead")
    x = rank_lead(x, ["cand"], "p", "s1", "c_rank", "c_lead")
    s, c = W.partitionBy("s1"), W.partitionBy("cand")
    n50 = lambda w: F.count_if(p >= LIKELY).over(w).cast("double")
    n90 = lambda w: F.count_if(p >= ANCHOR).over(w).cast("double")
    x = x.select(
        "*", (p / F.greatest(F.max(p).over(s), F.lit(1e-6))).alias("p_div_s1max"), F.sum(p).over(s).alias("s1_sum"), n50(s).alias("s1_n50"), n90(s).alias("s1_n90"), F.count(F.lit(1)).over(s).cast("double").alias("s1_npairs"), (F.col("s1_rank") - n50(s)).alias("rank_minus_n50"),
        (p / F.greatest(F.max(p).over(c), F.lit(1e-6))).alias("p_div_cmax"), F.sum(p).over(c).alias("c_sum"), n50(c).alias("c_n50"), n90(c).alias("c_n90"), F.count(F.lit(1)).over(c).cast("double").alias("c_npairs"), (p - F.col("c_lead")).alias("other_s1_p"),
        (n90(s) - (p >= ANCHOR).cast("double")).alias("anchor_n_other"),
    )
    fields = records.select(F.col("entity_id").alias("cand"), *[T.not_empty(F.trim(f)).alias(f"__f_{f}") for f in CAND_FIELDS]).dropDuplicates(["cand"])
    x = x.join(fields, "cand", "left")
    for f in CAND_FIELDS:
        v = F.col(f"__f_{f}")
        known = (p >= ANCHOR) & v.isNotNull()
        like = F.count_if(known).over(W.partitionBy("s1", v)) - known.cast("long")
        x = x.withColumn(f"anchor_share_{f}", F.when(v.isNotNull(), T.ratio(like, F.col("anchor_n_other"))))
    x = x.withColumn("anchor_share_max", F.greatest(*[F.col(f"anchor_share_{f}") for f in CAND_FIELDS])).drop(*[f"__f_{f}" for f in CAND_FIELDS])
    x = best_other(x, "cand", "p", "s1", "other_s1")
    x = shared_likely(x)
    mine = records.select(F.col("entity_id").alias("s1"), *[T.not_empty(F.trim(f)).alias(f"__a_{f}") for f in S1_FIELDS], T.words("name_tokens_sorted").alias("__a_nt"), T.words("address_tokens_sorted").alias("__a_at")).dropDuplicates(["s1"])
    theirs = mine.select(*[F.col(k).alias("other_s1" if k == "s1" else k.replace("__a_", "__b_")) for k in mine.columns])
    x = x.join(mine, "s1", "left").join(theirs, "other_s1", "left")
    jac = lambda a, b: T.ratio(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))
    eq = [(F.col(f"__a_{f}") == F.col(f"__b_{f}")).cast("double").alias(f"other_s1_same_{f}") for f in S1_FIELDS]
    std = []
    if len(extras) >= 2:
        mean = reduce(lambda a, b: a + b, [F.col(e) for e in extras]) / len(extras)
        std = [F.sqrt(reduce(lambda a, b: a + b, [(F.col(e) - mean) ** 2 for e in extras]) / len(extras)).alias("x_std")]
    return x.select("*", *eq, jac("__a_nt", "__b_nt").alias("other_s1_jacc_name"), jac("__a_at", "__b_at").alias("other_s1_jacc_addr"), *[F.col(e).alias(f"x_{e}") for e in extras], *std, *[F.col(f).alias(f"raw_{f}") for f in raw]).drop(*[k for k in x.columns if k.startswith("__")])


def shared_likely(x: DataFrame) -> DataFrame:
    """Add how many likely candidates an S1 shares with the candidate's best other S1, as a share of its own, and the most with any S1.

    Candidates that more than ``SHARED[1]`` S1 are likely to have are left out, so the self-join is bounded by a candidate's partners.
    """
    like = x.where(F.col("p") >= LIKELY).select("s1", "cand")
    like = like.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("cand"))).where(F.col("n").between(*SHARED)).select("s1", "cand")
    both = like.join(like.select(F.col("s1").alias("o"), "cand"), "cand").where("s1 <> o").groupBy("s1", "o").agg(F.count(F.lit(1)).cast("double").alias("shared"))
    most = both.groupBy("s1").agg(F.max("shared").alias("s1_dup_shared_max"))
    x = x.join(both.withColumnRenamed("o", "other_s1").withColumnRenamed("shared", "__sh"), ["s1", "other_s1"], "left").join(most, "s1", "left")
    has = F.col("other_s1").isNotNull()
    shared = F.when(has, F.coalesce("__sh", F.lit(0.0)))
    return x.withColumns({"other_s1_shared": shared, "other_s1_shared_frac": shared / F.greatest("s1_n50", F.lit(1.0)), "s1_dup_shared_max": F.coalesce("s1_dup_shared_max", F.lit(0.0))}).drop("__sh")


# ---------------------------------------------------------------- rule
def decide(pairs: DataFrame, rule: dict, out: str = "pred") -> DataFrame:
    """Add whether a pair is a match.

    ``rule`` is ``{"default": {"thr", "opc_r", "thr_ranks": [(k, t)]}, "by_country": {country: ...}}``: p of at least ``opc_r`` times the
    candidate's best, and at least ``thr``, or at least t for the k-th of the S1's pairs that pass the first test.
    """
    x = pairs.withColumn("__best", F.max("p").over(W.partitionBy("cand")))
    rules = {None: rule["default"], **(rule.get("by_country") or {})}
    pick = lambda f: reduce(lambda e, c: F.when(F.col("country") == c, f(rules[c])).otherwise(e), [c for c in rules if c is not None], f(rules[None]))
    x = x.withColumn("__base", F.col("p") >= pick(lambda r: F.lit(float(r.get("opc_r", 1.0)))) * F.col("__best") - 1e-12)
    x = x.withColumn("__rank", F.row_number().over(W.partitionBy("s1").orderBy(F.col("__base").desc(), F.col("p").desc(), "cand")) - 1)

    def bar(r: dict) -> Column:
        e = F.lit(float(r["thr"]))
        for k, t in r.get("thr_ranks") or []:
            if t < r["thr"]:
                e = F.when(F.col("__rank") == k, F.lit(float(t))).otherwise(e)
        return e

    return x.withColumn(out, F.col("__base") & (F.col("p") >= pick(bar))).drop("__best", "__base", "__rank")


def per_s1(universe: DataFrame, pairs: DataFrame, pred: str = "pred") -> DataFrame:
    """One row for each S1 of ``universe(s1, n_true)``: predicted, hits, found by blocking, F0.5.

    F0.5 of an S1 without true matches is 1 if nothing is predicted; S1 without candidates are in the universe too.
    """
    y = F.col(pred).cast("int")
    g = pairs.groupBy("s1").agg(F.sum(y).alias("n_pred"), F.sum(y * F.col("label")).alias("tp"), F.sum("label").alias("n_found"), F.lit(True).alias("has"))
    x = universe.select("s1", "n_true", *[c for c in universe.columns if c not in ("s1", "n_true")]).join(g, "s1", "left").fillna(0, ["n_pred", "tp", "n_found"]).withColumn("has", F.coalesce("has", F.lit(False)))
    precision, recall = F.col("tp") / F.col("n_pred"), F.col("tp") / F.col("n_true")
    f = F.when(F.col("n_true") == 0, (F.col("n_pred") == 0).cast("double")).when(F.col("tp") == 0, 0.0).otherwise(1.25 * precision * recall / (0.25 * precision + recall))
    return x.withColumn("f05", f)


def score(s1: DataFrame) -> DataFrame:
    """Macro F0.5, precision and recall, F0.5 of S1 with matches, share of singletons that are right, and counts."""
    many, lone = F.col("n_true") > 0, F.col("n_true") == 0
    return s1.agg(
        F.avg("f05").alias("f05"), F.try_divide(F.sum("tp"), F.sum("n_pred")).alias("precision"), F.try_divide(F.sum("tp"), F.sum("n_true")).alias("recall"), F.avg(F.when(many, F.col("f05"))).alias("f05_matched"), F.avg(F.when(lone, F.col("f05"))).alias("singleton_acc"),
        F.sum("n_pred").alias("n_pred"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("n_s1"),
    )


def sweep(universe: DataFrame, pairs: DataFrame, opc: tuple[float, ...] = OPC, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """Score of every rule (opc_r, thr): one pass per S1 with a column for each rule, no grid is joined."""
    x = pairs.withColumn("__best", F.max("p").over(W.partitionBy("cand")))
    grid = [(r, t) for r in opc for t in thresholds]
    yes = lambda r, t: (F.col("p") >= r * F.col("__best") - 1e-12) & (F.col("p") >= t)
    g = x.groupBy("s1").agg(F.array(*[F.struct(F.count_if(yes(r, t)).alias("n"), F.count_if(yes(r, t) & (F.col("label") == 1)).alias("tp")) for r, t in grid]).alias("v"))
    u = universe.select("s1", "n_true").join(g, "s1", "left")
    at = lambda i: F.get("v", F.lit(i))

    def f05(i: int) -> Column:
        n, tp = F.coalesce(at(i).n, F.lit(0)), F.coalesce(at(i).tp, F.lit(0))
        pr, rc = tp / n, tp / F.col("n_true")
        return F.when(F.col("n_true") == 0, (n == 0).cast("double")).when(tp == 0, 0.0).otherwise(1.25 * pr * rc / (0.25 * pr + rc))

    out = u.agg(F.sum("n_true").alias("true"), *[e for i in range(len(grid)) for e in (F.avg(f05(i)).alias(f"f{i}"), F.sum(at(i).n).alias(f"n{i}"), F.sum(at(i).tp).alias(f"t{i}"))])
    rows = [F.struct(F.lit(r).alias("opc_r"), F.lit(t).alias("thr"), F.col(f"f{i}").alias("f05"), F.try_divide(F.col(f"t{i}"), F.col(f"n{i}")).alias("precision"), F.try_divide(F.col(f"t{i}"), F.col("true")).alias("recall"), F.col(f"n{i}").alias("n_pred")) for i, (r, t) in enumerate(grid)]
    return out.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def search(universe: DataFrame, pairs: DataFrame, ranks: int = 4, opc: tuple[float, ...] = OPC, thresholds: tuple[float, ...] = THRESHOLDS) -> dict:
    """The best rule: thresholds with a precision floor unless that costs too much, then lower bars for an S1's first pairs, one by one.

    The driver sees one row for each rule of the grid.
    """
    rows = sweep(universe, pairs, opc, thresholds).collect()
    best_any = max(rows, key=lambda r: r.f05)
    exact = [r for r in rows if (r.precision or 0) >= MIN_PRECISION]
    best = max(exact, key=lambda r: r.f05, default=best_any)
    best = best if best.f05 >= best_any.f05 - SLACK else best_any
    rule = {"thr": best.thr, "opc_r": best.opc_r, "thr_ranks": []}
    f05, floor = best.f05, min(MIN_PRECISION, best.precision or 0)
    for k in range(ranks):
        tried = []
        for t in [t for t in thresholds[::8] if t < rule["thr"]]:
            r = {**rule, "thr_ranks": [*rule["thr_ranks"], (k, t)]}
            s = score(per_s1(universe, decide(pairs, {"default": r}))).first()
            if s.f05 > f05 + 1e-6 and (s.precision or 0) >= floor:
                tried.append((s.f05, t))
        if tried:
            f05, t = max(tried)
            rule["thr_ranks"].append((k, t))
    return {"default": rule, "by_country": {}, "f05": f05}


def search_by_country(universe: DataFrame, pairs: DataFrame, **grid) -> dict:
    """The best rule, with rules of single countries where that raises the score; ``universe`` has a column country."""
    whole = search(universe, pairs, **grid)
    names = [r[0] for r in pairs.select("country").distinct().limit(1000).collect()]
    own = {c: search(universe.where(F.col("country") == c), pairs.where(F.col("country") == c), **grid)["default"] for c in names}
    mixed = {"default": whole["default"], "by_country": own}
    s = score(per_s1(universe, decide(pairs, mixed))).first()
    return mixed | {"f05": s.f05} if s.f05 > whole["f05"] + 1e-6 else whole


# ---------------------------------------------------------------- reports
def loss_report(s1: DataFrame) -> DataFrame:
    """F0.5 points lost, by how many true matches an S1 has and what went wrong; with rows for S1 without candidates and all."""
    n, npred, tp, found = (F.col(c) for c in ("n_true", "n_pred", "tp", "n_found"))
    kind = F.when((n == 0) & (npred > 0), "singleton predicted").when((npred > tp) & (found > tp), "wrong + missed").when(npred > tp, "wrong pairs").when(found > tp, "missed pairs").when(n > found, "blocking miss only").otherwise("perfect")
    bucket = F.when(~F.col("has"), "no candidates").when(n == 0, "0").when(n == 1, "1").when(n == 2, "2").when(n <= 5, "3-5").when(n <= 10, "6-10").otherwise("11+")
    kinds = ["singleton predicted", "wrong + missed", "wrong pairs", "missed pairs", "blocking miss only"]
    x = s1.select(bucket.alias("bucket"), kind.alias("kind"), (1 - F.col("f05")).alias("loss"))
    cols = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("loss"))), F.lit(0.0)).alias(k.replace(" + ", "_").replace(" ", "_")) for k in kinds]
    return x.rollup("bucket").agg(F.count(F.lit(1)).alias("s1s"), *cols, F.sum("loss").alias("total")).withColumn("bucket", F.coalesce("bucket", F.lit("ALL")))


def miss_breakdown(pairs: DataFrame, pred: str = "pred") -> DataFrame:
    """Missed true pairs by probability band, rank in the S1, whether the candidate prefers another S1, and whether that pair is true too."""
    x = rank_lead(pairs, ["s1"], "p", "cand", "__r", "__l")
    x = x.withColumn("__best", F.max("p").over(W.partitionBy("cand")))
    x = best_other(x, "cand", "p", "s1", "__o")
    true = pairs.where("label = 1").select(F.col("s1").alias("__o"), "cand", F.lit(True).alias("__t"))
    x = x.where((F.col("label") == 1) & ~F.col(pred)).join(true, ["__o", "cand"], "left")
    band = F.when(F.col("p") <= 0.05, "0-0.05").when(F.col("p") <= 0.2, "0.05-0.2").when(F.col("p") <= 0.4, "0.2-0.4").when(F.col("p") <= 0.6, "0.4-0.6").when(F.col("p") <= 0.8, "0.6-0.8").otherwise("0.8-1")
    prefers = F.col("p") < F.col("__best") - 1e-12
    return x.groupBy(band.alias("band"), F.least("__r", F.lit(5)).cast("int").alias("rank"), prefers.alias("prefers_other"), (prefers & F.coalesce("__t", F.lit(False))).alias("other_also_true")).agg(F.count(F.lit(1)).alias("n"))


def leaderboard(universe: DataFrame, scored: dict[str, DataFrame], rules: dict[str, dict]) -> DataFrame:
    """The score of each model's rule, best first."""
    rows = [score(per_s1(universe, decide(df, rules[name]))).select(F.lit(name).alias("model"), "*") for name, df in scored.items()]
    return reduce(DataFrame.unionByName, rows).orderBy(F.col("f05").desc(), "model")
