"""From generated pairs to candidate pairs: pre-score, pool, 82 pool features, context, budget and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from entres.functions import text as T
from entres.sources.stored import stored

from . import index as I
from .ranking_ops import gap, running_count, top_share
from .steps import step

POOL, POOL_LOW, POOL_STRONG = 20, 100, 40
KEEP, KEEP_LOW, FLOOR = 30, 60, 0.0002
RECALL, SLACK, PRECISION, MOST, CAP_S1, DEFAULT_BUDGET = 0.999, 0.0001, 0.50, 12.0, 100, 6.0
GRID = [round(3.0 + 0.1 * i, 1) for i in range(91)]
PRE_FEATURES = ["score", "lnk", "rel"] + [f"{a}{t}" for t in "NKA" for a in ("j", "j2_", "g", "cc", "cs")] + ["lfx", "lfi", "eq_raw", "eq_sk", "eq_s2", "eq_set", "eq_addr", "pin", "low_jN", "low_jK", "low_rel", "low_eq", "lamb", "low_lamb"]
#: Hand weights of the pre-score, for where none has been fitted.
PRE_WEIGHTS = {"score": 1.0, "rel": 1.0, "jN": 2.0, "jK": 1.0, "jA": 1.5, "eq_raw": 2.0, "eq_sk": 1.0, "eq_set": 1.0, "eq_addr": 1.0}
POOL_FEATURES = (
    ["score", "log_nkeys", "n_fam", "rank_c", "rel_c", "log_nopt", "weak", "low", "ad_sum_c"] + [f"has_{f}" for f in I.FAMILY]
    + ["nr_w", "nr_cc", "nr_cs", "nk_w", "nk_cc", "nk_cs", "nr_nc", "nr_ns", "nk_n", "eq_raw", "eq_sk", "eq_pfx", "eq_s2", "eq_set", "seg_c", "name_amb", "name_lf_amb", "lfx", "lfi", "lf_c", "lf_s"]
    + ["ad_w", "ad_cc", "ad_cs", "ad_n", "ad_nc", "ad_ns", "eq_addr", "addr_amb", "num_c", "num_ex", "num_var", "pin"] + [f"{a}{t}" for t in "NKA" for a in ("j", "cc", "cs")] + [f"gap_{v}" for v in ("nk_cc", "nr_w", "ad_cc", "ad_w", "jN", "jK", "jA")]
)
CONTEXT = ["lp", "rank_c", "n_c", "lp_best_c", "lp_2nd_c", "gap_c", "share_c", "sum_c", "near_c", "rank_s", "n_s", "lp_best_s", "gap_s", "share_s", "sum_s", "other_s", "nbest_s", "low", "weak", "lamb", "eq_raw"]


def _rarity(r: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add an array for each array of ``columns``: its distinct tokens with their rarity among S1, and its sum.  One count and one join serve all of them."""
    t = I.labelled_tokens(r, I.ME, list(columns)).distinct()
    d = t.groupBy("country", "kind", "token").agg(F.count_if(F.col("side") == "s").alias("df_s"))
    d = d.join(F.broadcast(I.sizes(r)), "country").select("country", "kind", "token", I.idf_block(F.col("df_s"), F.col("n1")).alias("w"))
    mine = lambda k, v: F.when(F.col("kind") == k, v)
    # in the order of tokens, and summed in it: sums do not depend on how rows were dealt
    x = t.join(d, ["country", "kind", "token"]).groupBy(*I.ME).agg(*[F.array_sort(F.collect_list(mine(k, F.struct("token", "w")))).alias(out) for k, out in enumerate(columns.values())])
    empty = F.array().cast("array<struct<token:string,w:double>>")
    r = r.join(x, I.ME, "left").withColumns({out: F.coalesce(out, empty) for out in columns.values()})
    return r.withColumns({f"{out}_sum": F.aggregate(out, F.lit(0.0), lambda s, v: s + v.w) for out in columns.values()})


def block_records(records: DataFrame, begun: DataFrame | None = None) -> DataFrame:
    """What pool features need of each clean record.  ``begun`` is the stored ``index.ready`` table, where there is one."""
    r = stored(I.ready(records), "block-low") if begun is None else begun
    r = stored(step(r, sk=T.skeleton_words(F.col("raw")), q=T.skeleton_words(F.col("raw"), coarse=True)), "block-words")
    r = stored(_rarity(r, {"raw": "R", "sk": "K", "aw": "A"}), "block-rarity")
    flat, skf = T.joined("raw", ""), T.joined("sk", "")
    sl = lambda c: F.slice(c, 1, I.WORDS)
    n = F.col("num")
    cut = lambda least, f: F.transform(F.filter(n, lambda t: F.length(t) >= least), f)
    plain = lambda t: F.regexp_replace(t, "^0+(?=[0-9])", "")
    variants = F.array_distinct(F.concat(n, cut(4, lambda t: plain(F.right(t, F.lit(3)))), cut(3, lambda t: plain(F.right(t, F.lit(2)))), cut(3, lambda t: F.substr(t, F.lit(1), F.length(t) - 1))))
    r = step(
        r, sigN=T.signature(flat), sigK=T.signature(skf), sigA=F.col("aw"), raw_full=T.joined(sl("raw"), ""), sk_full=T.joined(sl("sk"), ""), s2_full=T.joined(sl("q"), ""), bag=T.joined(F.array_sort(F.array_distinct(sl("raw")))),
        addr=T.joined(F.array_sort("aw")), pfx=F.when(F.length(flat) > 10, F.substr(flat, F.lit(1), F.lit(10))).otherwise(""), num_var=variants,
    )
    same = lambda *k: F.count(F.when(F.col("side") == "s", 1)).over(W.partitionBy("country", *k)).cast("double")
    return stored(r.select("*", same("raw_full").alias("name_amb"), same("raw_full", "lfi").alias("name_lf_amb"), same("addr").alias("addr_amb")), "block-records")


def _sides(pairs: DataFrame, r: DataFrame) -> DataFrame:
    part = lambda k, me, side: r.where(F.col("side") == side).select(F.col("country"), F.col("id").alias(me), *[F.col(c).alias(f"{k}_{c}") for c in r.columns if c not in I.ME])
    return pairs.join(part("a", "s1", "s"), ["country", "s1"]).join(part("b", "cand", "c"), ["country", "cand"])


def _eq(c: str) -> Column:
    return ((F.col(f"a_{c}") != "") & (F.col(f"a_{c}") == F.col(f"b_{c}"))).cast("double")


def _pin() -> Column:
    a, b = F.col("a_pin"), F.col("b_pin")
    return F.when(a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).otherwise(-1.0)


def _overlaps() -> dict[str, Column]:
    out = {}
    for t in "NKA":
        a, b = F.col(f"a_sig{t}"), F.col(f"b_sig{t}")
        n, one = F.size(F.array_intersect(a, b)), F.lit(1)
        out |= {f"j{t}": n / F.greatest(F.size(a) + F.size(b) - n, one), f"cc{t}": n / F.greatest(F.size(b), one), f"cs{t}": n / F.greatest(F.size(a), one)}
    return out


def pre_features(pairs: DataFrame, r: DataFrame) -> DataFrame:
    """Generated pairs with the 32 features that rank a candidate's pool; ``r`` are ``block_records``."""
    x = _sides(pairs, r)
    low = F.col("b_low").cast("double")
    x = x.select(
        *pairs.columns, low.alias("__low"), F.col("b_weak").alias("__weak"), F.ln(1 + F.col("n_keys")).alias("lnk"), *[v.alias(k) for k, v in _overlaps().items()], T.legal_agreement(F.col("a_lfx"), F.col("b_lfx")).alias("lfx"), T.legal_agreement(F.col("a_lfi"), F.col("b_lfi")).alias("lfi"),
        _eq("raw_full").alias("eq_raw"), _eq("sk_full").alias("eq_sk"), _eq("s2_full").alias("eq_s2"), _eq("bag").alias("eq_set"), _eq("addr").alias("eq_addr"), _pin().alias("pin"), F.ln(1 + F.when(F.col("a_raw_full") != "", F.col("a_name_amb")).otherwise(0.0)).alias("lamb"),
    )
    best = F.max("score").over(W.partitionBy("country", "cand"))
    x = x.withColumn("rel", F.col("score") / F.greatest(best, F.lit(1e-6)))
    x = x.select("*", *[(F.col(f"j{t}") * F.col(f"j{t}")).alias(f"j2_{t}") for t in "NKA"], *[gap(f"j{t}", "cand").alias(f"g{t}") for t in "NKA"])
    lw = F.col("__low")
    return x.withColumns({"low_jN": lw * F.col("jN"), "low_jK": lw * F.col("jK"), "low_rel": lw * F.col("rel"), "low_eq": lw * F.col("eq_raw"), "low_lamb": lw * F.col("lamb")})


def pre_score(x: DataFrame, weights: dict[str, float] = PRE_WEIGHTS, bits: list[float] | None = None, per_family: float = 0.1, intercept: float = 0.0) -> DataFrame:
    """Add ``pre``, a linear score of the pre-score features, the families of the evidence and their number."""
    z = F.lit(intercept) + per_family * F.col("n_evidence")
    for name, w in weights.items():
        z = z + w * F.col(name)
    for i, w in enumerate(bits or []):
        z = z + w * F.expr(f"getbit(evidence_mask, {i})")
    return x.withColumn("pre", z)


def pool(x: DataFrame) -> DataFrame:
    """Each candidate's best pairs by ``pre``: more where its address is low, and strong evidence a little further down."""
    x = x.withColumn("pre_rank", F.row_number().over(W.partitionBy("country", "cand").orderBy(F.col("pre").desc(), "s1")) - 1)
    x = x.withColumn("n_options", F.count(F.lit(1)).over(W.partitionBy("country", "cand")))
    most = F.when(F.col("__low") == 1, POOL_LOW).otherwise(POOL)
    strong = (F.col("evidence_mask").bitwiseAND(F.lit(I.STRONG)) != 0) & (F.col("pre_rank") < POOL_STRONG)
    return x.where((F.col("pre_rank") < most) | strong)


def pool_features(p: DataFrame, r: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Pool pairs with the 82 features of the ranker, or with those of ``names`` only."""
    ids = ["country", "s1", "cand"]
    base = p.select(*ids, "score", "n_keys", "evidence_mask", "n_evidence", "pre_rank", "n_options")
    x = _sides(base, r)
    c, one = F.col, F.lit(1e-6)
    inside = lambda v, words: F.filter(v, lambda t: F.array_contains(words, t.token))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, t: s + t.w)
    best = F.max("score").over(W.partitionBy("country", "cand"))
    shared = {"rs": ("nr_", inside(c("b_R"), c("a_raw"))), "ks": ("nk_", inside(c("b_K"), c("a_sk"))), "as_": ("ad_", inside(c("b_A"), c("a_akeys")))}
    wanted = POOL_FEATURES if names is None else names
    x = step(x, **{k: v for k, (start, v) in shared.items() if any(n.removeprefix("gap_").startswith(start) for n in wanted)})
    rw, kw, aw = total(c("rs")), total(c("ks")), total(c("as_"))
    f = {
        "score": c("score"), "log_nkeys": F.ln(1 + c("n_keys")), "n_fam": c("n_evidence"), "rank_c": F.least(c("pre_rank"), F.lit(30)), "rel_c": c("score") / F.greatest(best, one), "log_nopt": F.ln(1 + c("n_options")), "weak": c("b_weak").cast("double"), "low": c("b_low").cast("double"), "ad_sum_c": c("b_ad_sum"),
        **{f"has_{n}": F.expr(f"cast(getbit(evidence_mask, {i}) as double)") for i, n in enumerate(I.FAMILY)},
        "nr_w": rw, "nr_cc": rw / F.greatest(c("b_R_sum"), one), "nr_cs": rw / F.greatest(c("a_R_sum"), one), "nk_w": kw, "nk_cc": kw / F.greatest(c("b_K_sum"), one), "nk_cs": kw / F.greatest(c("a_K_sum"), one), "nr_nc": F.size("b_R"), "nr_ns": F.size("a_R"), "nk_n": F.size("ks"),
        "eq_raw": _eq("raw_full"), "eq_sk": _eq("sk_full"), "eq_pfx": _eq("pfx"), "eq_s2": _eq("s2_full"), "eq_set": _eq("bag"), "seg_c": F.lit(0.0), "name_amb": F.ln(1 + c("a_name_amb")), "name_lf_amb": F.ln(1 + c("a_name_lf_amb")),
        "lfx": T.legal_agreement(c("a_lfx"), c("b_lfx")), "lfi": T.legal_agreement(c("a_lfi"), c("b_lfi")), "lf_c": (c("b_lfi") != "").cast("double"), "lf_s": (c("a_lfi") != "").cast("double"),
        "ad_w": aw, "ad_cc": aw / F.greatest(c("b_A_sum"), one), "ad_cs": aw / F.greatest(c("a_A_sum"), one), "ad_n": F.size("as_"), "ad_nc": c("b_ad_n"), "ad_ns": c("a_ad_n"), "eq_addr": _eq("addr"), "addr_amb": F.ln(1 + c("a_addr_amb")),
        "num_c": F.size("b_num"), "num_ex": F.size(F.array_intersect("b_num", "a_num")), "num_var": F.size(F.array_intersect("b_num", "a_num_var")), "pin": _pin(), **_overlaps(),
    }
    gaps = [v for v in ("nk_cc", "nr_w", "ad_cc", "ad_w", "jN", "jK", "jA") if f"gap_{v}" in wanted]
    f = {k: v for k, v in f.items() if names is None or k in [*names, *gaps]}
    x = x.select(*ids, "n_keys", "evidence_mask", "n_evidence", *[v.cast("double").alias(k) for k, v in f.items()])
    return x.select(*ids, "n_keys", "evidence_mask", "n_evidence", *[F.col(k) for k in f], *[gap(v, "cand").alias(f"gap_{v}") for v in gaps])


#: The pool features that ``fallback_p`` reads.
FALLBACK = ["rel_c", "nk_cc", "ad_cc", "jN"]


def fallback_p() -> Column:
    """A probability without a ranker, from the pool features."""
    clip = lambda c: F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0))
    return 0.3 * F.col("rel_c") + 0.2 * clip("nk_cc") + 0.2 * clip("ad_cc") + 0.3 * F.col("jN")


def shortlist(x: DataFrame, p: str = "p") -> DataFrame:
    """The best pairs of each candidate above the floor, and its best whatever it is."""
    me = W.partitionBy("country", "cand").orderBy(F.col(p).desc(), "s1")
    x = x.withColumn("__r", F.row_number().over(me))
    return x.where((F.col("__r") <= F.when(F.col("low") == 1, KEEP_LOW).otherwise(KEEP)) & ((F.col(p) >= FLOOR) | (F.col("__r") == 1))).drop("__r")


def context(x: DataFrame, p: str = "p") -> DataFrame:
    """Add the 21 features of a pair among its competitors; ``low, weak, lamb, eq_raw`` are taken over or null."""
    v = F.col(p)
    wc, ws = W.partitionBy("cand"), W.partitionBy("s1")
    rc = F.row_number().over(wc.orderBy(v.desc(), "s1")) - 1
    rs = F.row_number().over(ws.orderBy(v.desc(), "cand")) - 1
    x = x.select("*", rc.alias("__rc"), rs.alias("__rs"), F.max(v).over(wc).alias("__bc"), F.max(v).over(ws).alias("__bs"), F.sum(v).over(wc).alias("__sc"), F.sum(v).over(ws).alias("__ss"))
    second = F.coalesce(F.max(F.when(F.col("__rc") == 1, v)).over(wc), F.lit(1e-6))
    own = [c for c in x.columns if not c.startswith("__") and c not in CONTEXT]
    keep = lambda c: (F.col(c) if c in x.columns else F.lit(None)).cast("double")
    f = {
        "lp": T.logit(v), "rank_c": F.least("__rc", F.lit(50)), "n_c": F.count(F.lit(1)).over(wc), "lp_best_c": T.logit(F.col("__bc")), "lp_2nd_c": T.logit(second), "gap_c": T.logit(v) - T.logit(F.col("__bc")), "share_c": v / F.greatest("__sc", F.lit(1e-6)), "sum_c": F.col("__sc"),
        "near_c": F.count_if(v >= 0.5 * F.col("__bc")).over(wc), "rank_s": F.least("__rs", F.lit(50)), "n_s": F.count(F.lit(1)).over(ws), "lp_best_s": T.logit(F.col("__bs")), "gap_s": T.logit(v) - T.logit(F.col("__bs")), "share_s": v / F.greatest("__ss", F.lit(1e-6)), "sum_s": F.col("__ss"),
        "other_s": F.col("__ss") - v, "nbest_s": F.count_if(F.col("__rc") == 0).over(ws), **{c: keep(c) for c in ("low", "weak", "lamb", "eq_raw")},
    }
    return x.select(*own, *[e.cast("double").alias(k) for k, e in f.items()])


def budget_curve(x: DataFrame, n: DataFrame, grid: list[float] = GRID, p: str = "p", label: str = "label") -> DataFrame:
    """(country, budget, pairs, hits) if the budget were that many pairs an S1; the grid is columns, not a join."""
    r = running_count(x.withColumn("__one", F.lit(1)), "country", p, ["s1", "cand"], "__one", "__rank").join(F.broadcast(n), "country")
    agg = r.groupBy("country").agg(*[f for i, b in enumerate(grid) for inside in [F.col("__rank") <= F.floor(F.lit(b) * F.col("n1"))] for f in (F.count_if(inside).alias(f"n{i}"), F.sum(F.when(inside, F.col(label)).otherwise(0)).alias(f"h{i}"))])
    return agg.select("country", F.explode(F.array(*[F.struct(F.lit(b).alias("budget"), F.col(f"n{i}").alias("pairs"), F.col(f"h{i}").alias("hits")) for i, b in enumerate(grid)])).alias("x")).select("country", "x.*")


def automatic_budget(curve: DataFrame, total: DataFrame) -> DataFrame:
    """(country, budget): the smallest that reaches the recall, unless precision is too low; then the largest that keeps it.

    ``total(country, true_pairs, shortlisted)``.
    """
    need = F.least(RECALL * F.col("true_pairs"), F.col("shortlisted") - SLACK * F.col("true_pairs"))
    x = curve.where((F.col("budget") <= MOST) & (F.col("pairs") > 0)).join(F.broadcast(total), "country").withColumn("ok", F.col("hits") >= PRECISION * F.col("pairs")).withColumn("reached", F.col("hits") >= need)
    a = x.groupBy("country").agg(F.min(F.when(F.col("reached"), F.struct("budget", "ok"))).alias("first"), F.min("budget").alias("least"), F.max(F.when(F.col("ok"), F.col("budget"))).alias("floor"))
    below = x.join(a.select("country", F.col("first.budget").alias("at")), "country").where("ok and (at is null or budget <= at)").groupBy("country").agg(F.max("budget").alias("under"))
    return a.join(below, "country", "left").select("country", F.when(F.col("first.ok"), F.col("first.budget")).otherwise(F.coalesce("under", "least")).alias("budget"))


def within_budget(x: DataFrame, budget: DataFrame, n: DataFrame, p: str = "p") -> DataFrame:
    """The highest pairs of each country, ``budget`` an S1, and of an S1 no more than its cap."""
    keep = n.join(budget, "country", "left").select("country", F.floor(F.coalesce("budget", F.lit(DEFAULT_BUDGET)) * F.col("n1")).alias("n"))
    y = top_share(x, "country", p, ["s1", "cand"], keep)
    return y.withColumn("__r", F.row_number().over(W.partitionBy("s1").orderBy(F.col(p).desc(), "cand"))).where(F.col("__r") <= CAP_S1).drop("__r")


def output_rows(x: DataFrame, p: str = "p", label: str | None = None) -> DataFrame:
    """Candidate pairs as they are handed on."""
    rank = F.row_number().over(W.partitionBy("cand").orderBy(F.col(p).desc(), "s1")) - 1
    return x.select(
        F.col("s1").alias("source1_entity_id"), F.col("cand").alias("candidate_entity_id"), F.round("score", 3).alias("score"), "n_keys", "evidence_mask", F.bit_count("evidence_mask").cast("long").alias("n_evidence"), rank.cast("long").alias("cand_rank"),
        F.round(p, 4).alias("p_block"), *([F.col(label).alias("label")] if label else []),
    )


def stage_table(stages: dict[str, DataFrame], truth: DataFrame, n_s1: int) -> DataFrame:
    """Recall, precision, pairs and pairs an S1 after each stage."""
    total = truth.select("s1", "cand").distinct().agg(F.count(F.lit(1)).alias("true_pairs"))
    out = None
    for i, (name, df) in enumerate(stages.items()):
        hit = df.select("s1", "cand").join(truth.select("s1", "cand", F.lit(1).alias("hit")).distinct(), ["s1", "cand"], "left")
        row = hit.agg(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.count(F.lit(1)).alias("pairs"), F.count("hit").alias("found"))
        out = row if out is None else out.unionByName(row)
    return out.crossJoin(F.broadcast(total)).select("step", "stage", "pairs", "found", T.ratio(F.col("found"), F.col("true_pairs")).alias("recall"), T.ratio(F.col("found"), F.col("pairs")).alias("precision"), (F.col("pairs") / n_s1).alias("per_s1"))


def pool_sweep(ranked: DataFrame, truth: DataFrame, ks: tuple[int, ...] = (1, 2, 3, 5, 10, 15, 20, 30, 40)) -> DataFrame:
    """Recall if the pool were each candidate's K best; ``ranked(s1, cand, pre_rank)``."""
    t = truth.select("s1", "cand").distinct().join(ranked.select("s1", "cand", "pre_rank"), ["s1", "cand"], "left")
    a = t.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("pre_rank") < k).alias(f"k{k}") for k in ks], F.count("pre_rank").alias("all"))
    return a.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), T.ratio(F.col(f"k{k}"), F.col("n")).alias("recall")) for k in ks], F.struct(F.lit(0).alias("k"), T.ratio(F.col("all"), F.col("n")).alias("recall")))).alias("x")).select("x.*")


def misses(truth: DataFrame, stages: dict[str, DataFrame], r: DataFrame) -> DataFrame:
    """True pairs by the stage that lost them, why, and how many S1 could be meant: country, stage, category, tie, n."""
    left = truth.select("s1", "cand").distinct()
    lost = None
    for name, df in stages.items():
        gone = left.join(df.select("s1", "cand"), ["s1", "cand"], "left_anti").withColumn("stage", F.lit(name))
        lost = gone if lost is None else lost.unionByName(gone)
        left = left.join(df.select("s1", "cand"), ["s1", "cand"], "left_semi")
    x = _sides(lost.join(r.where("side = 's'").select(F.col("id").alias("s1"), "country"), "s1"), r)
    weak, same = F.col("b_weak"), (F.col("a_raw_full") != "") & (F.col("a_raw_full") == F.col("b_raw_full"))
    unlike = (F.size(F.array_intersect("a_raw", "b_raw")) == 0) & (F.size(F.array_intersect("a_sk", "b_sk")) == 0)
    why = F.when(weak & same & (F.col("a_name_amb") >= 2), "ambiguous").when(weak, "no address").when(unlike, "name unrelated").otherwise("other")
    tie = F.when(same, F.col("a_name_amb")).otherwise(0)
    band = F.when(tie <= 1, "1").when(tie <= 5, "2-5").when(tie <= 30, "6-30").when(tie <= 300, "31-300").otherwise(">300")
    return x.groupBy("country", "stage", why.alias("category"), band.alias("tie")).agg(F.count(F.lit(1)).alias("n"))


def candidates(records: DataFrame, p: Column | None = None) -> DataFrame:
    """All of blocking without a fitted model: pairs, pre-score, pool, features, probability, shortlist, context, budget."""
    r = block_records(records)
    x = pool(pre_score(pre_features(stored(I.generate(records), "generated"), r)))
    x = stored(pool_features(x, r).withColumn("p", fallback_p() if p is None else p), "pool")
    n = I.sizes(r.select(*I.ME)).select("country", "n1")
    none = n.select("country", F.lit(DEFAULT_BUDGET).alias("budget"))
    return output_rows(within_budget(shortlist(x), none, n))
