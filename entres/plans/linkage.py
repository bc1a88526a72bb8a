"""Queries of the linkage operators on the fixtures: raw records from ``documents``, scored pairs from ``lineitem``, addresses from ``part``.

Tables that several queries read are written once a session.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from entres.functions import strings as S
from entres.functions import text as T
from entres.functions import unicode as U
from entres.operators import cleaning, decide, features, index, learn, ranking_ops, scoring
from entres.sources import fixtures
from entres.sources.stored import spread, stored

_MADE: dict[tuple, DataFrame] = {}
_MAKING: defaultdict[tuple, threading.RLock] = defaultdict(threading.RLock)


def _once(name: str, make, write: bool = True):
    """``make`` runs once a session, also where several threads ask; without ``write`` it returns a stored table itself."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, name)
        with _MAKING[key]:
            if key not in _MADE:
                df = make(spark, sf_dir)
                _MADE[key] = stored(df, f"fixture-{name}") if write else df
            return _MADE[key]

    return run


def _at_once(spark: SparkSession, sf_dir: str, *tables) -> None:
    """Tables that do not read each other, made side by side: their many short jobs leave most cores idle one after another."""
    with ThreadPoolExecutor(len(tables)) as pool:
        for made in [pool.submit(inheritable_thread_target(spark)(t), spark, sf_dir) for t in tables]:
            made.result()


def _view(name: str):
    return lambda spark, sf_dir: fixtures.run(spark, sf_dir, f"SELECT * FROM {name}")


def _pre(spark: SparkSession, sf_dir: str) -> DataFrame:
    begun(spark, sf_dir)
    _at_once(spark, sf_dir, generated, block)
    return scoring.pre_score(scoring.pre_features(generated(spark, sf_dir), block(spark, sf_dir)))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of the pool as the pair features read them; from ``ranked`` where a query has made that, else without what neither the pool nor ``p`` reads."""
    own = ["country", "s1", "cand", "score", "n_keys", "evidence_mask", "n_evidence"]
    if (spark.sparkContext.applicationId, sf_dir, "pool") in _MADE:
        x = ranked(spark, sf_dir)
    else:
        x = stored(_pre(spark, sf_dir).select(*own, "__low", "pre"), "fixture-scored-pre")
        x = scoring.pool_features(scoring.pool(x), block(spark, sf_dir), ["score", *scoring.FALLBACK]).withColumn("p", scoring.fallback_p())
    return x.select(*own, F.col("p").alias("p_block"))


clean = _once("clean", lambda spark, d: cleaning.clean_records(spread(_view("recs")(spark, d).drop("source"))))
begun = _once("begun", lambda spark, d: index.ready(clean(spark, d)))
generated = _once("generated", lambda spark, d: index.generate(clean(spark, d), begun(spark, d)))
block = _once("block", lambda spark, d: scoring.block_records(clean(spark, d), begun(spark, d)), write=False)
pre = _once("pre", _pre)
ranked = _once("pool", lambda spark, d: scoring.pool_features(scoring.pool(pre(spark, d)), block(spark, d)).withColumn("p", scoring.fallback_p()))
scored = _once("scored", lambda spark, d: _scored(spark, d))
records = _once("records", lambda spark, d: features.feature_records(clean(spark, d)), write=False)
pairs = _once("pairs", _view("pairs"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 and candidates of one language with the same ten-word address."""
    r = clean(spark, sf_dir).where("business_address <> ''")
    side = lambda k, s: r.where(s).select(F.col("country_clean").alias("c"), F.col("business_address").alias("a"), F.col("entity_id").alias(k))
    return side("s1", "source = 'S1'").join(side("cand", "source <> 'S1'"), ["c", "a"]).select("s1", "cand").distinct()


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = scoring.context(scoring.shortlist(ranked(spark, sf_dir)))
    rank = F.row_number().over(scoring.W.partitionBy("cand").orderBy(F.col("p").desc(), "s1")) - 1
    return x.select("country", "s1", "cand", "p", "label" if "label" in x.columns else F.lit(0).alias("label"), rank.alias("cand_rank"))


def featured(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """The named features of the pairs of the pool; those of the blocking stage alone need no words of the records."""
    alone = all(n.startswith(("blk_", "evb_")) for n in names)
    clean(spark, sf_dir)
    _at_once(spark, sf_dir, scored, *[] if alone else [records])
    p = scored(spark, sf_dir)
    return features.pair_features(p, features.record_ids(clean(spark, sf_dir)) if alone else records(spark, sf_dir), names)


def labelled(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    t = truth(spark, sf_dir).withColumn("label", F.lit(1))
    return learn.with_folds(featured(spark, sf_dir, names).join(t, ["s1", "cand"], "left").fillna(0, ["label"]))


def _universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 of the scored pairs with their true matches, and one S1 in a hundred more that no pair has."""
    p = pairs(spark, sf_dir)
    own = p.groupBy("s1").agg(F.sum("label").alias("n_true"), F.min("country").alias("country"))
    return own.unionByName(own.where("s1 % 100 = 1").select((-F.col("s1")).alias("s1"), (F.col("s1") % 3).alias("n_true"), "country"))


RULE = {"default": {"thr": 0.67, "opc_r": 0.9, "thr_ranks": [(0, 0.5), (1, 0.6)]}, "by_country": {"1": {"thr": 0.8, "opc_r": 1.0, "thr_ranks": []}}}


def _decided(spark, d):
    return decide.decide(pairs(spark, d), RULE)


def _words(df: DataFrame, *cols) -> DataFrame:
    return df.select("entity_id", *cols)


def _token_query(fn, name: str):
    return lambda spark, d: fixtures.run(spark, d, "SELECT DISTINCT token FROM tok").select("token", fn(F.col("token")).alias(name))


def _report(name: str):
    return lambda spark, d: index.blocker_report(clean(spark, d), truth(spark, d), [name])


def _family(bit: int):
    return lambda spark, d: index.family_counters(generated(spark, d)).where(F.col("family") == bit)


def _group(names: list[str]):
    return lambda spark, d: featured(spark, d, names).select("s1", "cand", *[F.round(n, 6).alias(n) for n in names])


_F = features.FEATURES
_REPORTED = ["name_lev", "name_soft_tfidf", "combo", "blk_score"]
_SOFT = ["name_soft_tfidf", "name_me_s1", "name_softcov_s1", "name_unm_s1"]
_PICK = lambda *starts: [f for f in _F if f.startswith(starts)]

QUERIES = {
    "n1_mojibake": lambda s, d: _words(_view("recs")(s, d), U.mojibake(F.col("business_name")).alias("name")),
    "n2_nfkc": lambda s, d: _words(_view("recs")(s, d), U.nfkc(F.col("business_name")).alias("name")),
    "n3_romanised": lambda s, d: _words(_view("recs")(s, d), U.romanised(F.col("business_name")).alias("name")),
    "n4_non_latin": lambda s, d: _words(_view("recs")(s, d), T.non_latin("business_name").alias("non_latin")),
    "n5_apostrophes": lambda s, d: _words(_view("recs")(s, d), T.apostrophes("business_name").alias("name")),
    "n6_skeleton0": _token_query(T.skeleton, "skeleton"),
    "n7_legal_forms": _token_query(T.legal_word, "word"),
    "n9_typo_of_legal": _token_query(T.typo_of_legal, "is_typo"),
    "n10_case_lookalikes": lambda s, d: _words(_view("recs")(s, d), T.case_lookalikes("business_name").alias("name")),
    "n11_web_hosts": lambda s, d: _view("webs")(s, d).select("rid", T.web_names("host").alias("name")),
    "n12_digit_lookalikes": _token_query(T.digit_lookalikes, "word"),
    "n13_alias": lambda s, d: clean(s, d).select("entity_id", "has_alias", "name_primary", "name_alias"),
    "n14_tokens": lambda s, d: clean(s, d).select("entity_id", "name_translit"),
    "n15_core": lambda s, d: clean(s, d).select("entity_id", "name_core", "has_legal_suffix"),
    "n16_shape": lambda s, d: clean(s, d).select("entity_id", "name_token_count", "name_compact", "name_char_len", "name_first_token", "name_last_token", "name_initials", "name_has_digit", "name_numeric_tokens", "name_alnum_tokens"),
    "n17_clean_names": lambda s, d: clean(s, d).select("entity_id", *cleaning.NAME_COLUMNS),
    "n19_scripts": lambda s, d: cleaning.script_counts(_view("recs")(s, d), "business_name"),
    "d2_regions": lambda s, d: cleaning.clean_addresses(_view("addrs")(s, d)).select("rid", "has_state_token"),
    "d3_postal": lambda s, d: _view("addrs")(s, d).select("rid", T.postal_code("business_address").alias("pin")),
    "d4_masks": lambda s, d: _view("addrs")(s, d).select("rid", F.array_join(T.masked_numbers("business_address"), " ").alias("masks")),
    "d5_address_text": lambda s, d: _view("addrs")(s, d).select("rid", F.trim(F.regexp_replace(T.address_text(F.replace("business_address", F.lit("#"), F.lit(" "))), " +", " ")).alias("address")),
    "d7_components": lambda s, d: cleaning.clean_addresses(_view("addrs")(s, d)).select("rid", *cleaning.COMPONENTS),
    "d8_clean_addresses": lambda s, d: cleaning.clean_addresses(_view("addrs")(s, d)).select("rid", *cleaning.ADDRESS_COLUMNS),
    "d9_address_flags": lambda s, d: clean(s, d).select("entity_id", "is_missing_address", *[c for c in clean(s, d).columns if c.startswith("has_") and c not in ("has_alias", "has_legal_suffix")]),
    "d10_address_words": lambda s, d: _view("addrs")(s, d).select("rid", T.joined(T.address_words(F.lower("business_address"))).alias("address")),
    "d11_blocking_words": lambda s, d: _view("addrs")(s, d).select("rid", T.joined(F.transform(T.words(F.lower("business_address")), T.blocking_address_word)).alias("address")),
    "d12_slot": lambda s, d: _view("addrs")(s, d).select("rid", T.slot(F.split_part("business_address", F.lit(" "), F.lit(1))).alias("slot")),
    "d13_first_numeric_word": lambda s, d: _view("addrs")(s, d).select("rid", T.first_number(F.replace("business_address", F.lit("#"), F.lit(""))).alias("first_num")),
    "d14_pin_digits": lambda s, d: _view("addrs")(s, d).select("rid", T.pin_digits(T.postal_code("business_address")).alias("pin")),
    "x1_key_word": _token_query(lambda t: T.key_word(F.regexp_replace(t, "[^a-z0-9]", "")), "word"),
    "x2_skeleton1": _token_query(lambda t: T.skeleton_word(F.regexp_replace(t, "[^a-z0-9]", "")), "skeleton"),
    "x3_skeleton2": _token_query(lambda t: T.skeleton_word(F.regexp_replace(t, "[^a-z0-9]", ""), coarse=True), "skeleton"),
    "x5_name_words": lambda s, d: clean(s, d).select("entity_id", T.joined(T.key_words(T.words("name_core"))).alias("words")),
    "x8_legal_initials": lambda s, d: clean(s, d).select("entity_id", T.stripped_initials("name_translit", "name_core").alias("initials")),
    "x10_feature_name": lambda s, d: clean(s, d).select("entity_id", T.feature_name("name_core", F.col("business_name").rlike(features.WEB)).alias("name")),
    "x11_phon": _token_query(T.phonetic, "phon"),
    "x12_legal_words": lambda s, d: clean(s, d).select("entity_id", T.joined(T.legal_words("name_translit", "name_core")).alias("legal")),
    "x14_signature": lambda s, d: clean(s, d).select("entity_id", F.size(T.signature(F.col("name_compact"))).cast("long").alias("n")),
    "x16_word_trigrams": lambda s, d: clean(s, d).select("entity_id", F.size(T.word_trigrams(T.words("name_core"))).cast("long").alias("n")),
    "pf4_country_report": lambda s, d: index.country_report(clean(s, d), truth(s, d)),
    **{f"k{i}_{b}_recall": _report(b) for i, b in enumerate(index.BLOCKERS, 1)},
    "k_all_misses": lambda s, d: index.missed(clean(s, d), truth(s, d)),
    **{f"b{i}_{f}": _family(i - 1) for i, f in enumerate(index.FAMILY, 1)},
    "b27_all_families": lambda s, d: generated(s, d).select("s1", "cand", F.round("score", 6).alias("score"), "n_keys", "evidence_mask", "n_evidence"),
    "b28_affordable_keys": lambda s, d: index.affordable(index.capped(index.family_keys(clean(s, d))), 2000).groupBy("family").agg(F.count(F.lit(1)).alias("keys")),
    "b30_noise": lambda s, d: index.noise_words(index.frequencies(_tokens(s, d)), index.sizes(_sided(s, d))),
    "w8_collapsed": lambda s, d: _view("recs")(s, d).select("entity_id", T.joined(T.collapsed(T.words(F.lower("business_address")))).alias("words")),
    "b34_legal_vocabulary": lambda s, d: index.legal_vocabulary(clean(s, d), 1),
    "c1_pre_features": lambda s, d: pre(s, d).select("s1", "cand", *[F.round(f, 6).alias(f) for f in scoring.PRE_FEATURES]),
    "c3_pre_score": lambda s, d: pre(s, d).select("s1", "cand", F.round("pre", 6).alias("pre")),
    "c4_pool": lambda s, d: scoring.pool(pre(s, d)).select("s1", "cand", "pre_rank", "n_options"),
    "c5_pool_features": lambda s, d: ranked(s, d).select("s1", "cand", *[F.round(f, 6).alias(f) for f in scoring.POOL_FEATURES]),
    "c8_fallback": lambda s, d: ranked(s, d).select("s1", "cand", F.round("p", 6).alias("p")),
    "c9_context_features": lambda s, d: scoring.context(pairs(s, d)).select("s1", "cand", *[F.round(f, 6).alias(f) for f in scoring.CONTEXT[:17]]),
    "c11_budget": lambda s, d: scoring.automatic_budget(scoring.budget_curve(pairs(s, d), _n1(s, d)), pairs(s, d).groupBy("country").agg(F.sum("label").alias("true_pairs"), F.sum("label").alias("shortlisted"))),
    "c12_budget_curve": lambda s, d: scoring.budget_curve(pairs(s, d), _n1(s, d), [0.5, 1.0, 1.5, 2.0, 3.0]),
    "c12_within_budget": lambda s, d: scoring.within_budget(pairs(s, d), _n1(s, d).select("country", F.lit(1.5).alias("budget")), _n1(s, d)).select("s1", "cand"),
    "c13_output_rows": lambda s, d: scoring.output_rows(ranked(s, d)),
    "c14_stages": lambda s, d: scoring.stage_table({"generated": generated(s, d), "pool": ranked(s, d), "shortlist": scoring.shortlist(ranked(s, d))}, truth(s, d), 100),
    "c15_pool_sweep": lambda s, d: scoring.pool_sweep(scoring.pool(pre(s, d)), truth(s, d)),
    "c16_misses": lambda s, d: scoring.misses(truth(s, d), {"generated": generated(s, d), "pool": ranked(s, d), "shortlist": scoring.shortlist(ranked(s, d))}, block(s, d)),
    "f1_name_features": _group([f for f in _PICK("name_", "phon_") if not f.startswith(("name_gap", "name_idf_shared_sum", "name_rarity_cand", "name_num", "name_abbrev", "name_cd"))]),
    "f2_name_more": _group(["name_idf_shared_sum", "name_rarity_cand", "name_num_eq", "name_num_one_side", "name_abbrev"]),
    "f3_alias_features": _group(_PICK("alias_")),
    "f4_legal_features": _group(_PICK("lf_")),
    "f5_address_features": _group([f for f in _PICK("addr_", "pin_") if f not in ("addr_exact_eq", "addr_idf_shared_sum") and not f.startswith("addr_gap")]),
    "f6_field_features": _group(["addr_exact_eq", "addr_idf_shared_sum", *_PICK("f_", "fld_")]),
    "f7_cross_features": _group(_PICK("x_")),
    "f8_no_address": _group(_PICK("noaddr_")),
    "f9_context_features": _group(features.FEATURES[features.FEATURES.index("s1_n_cand") : features.FEATURES.index("sib_anchor_pb")]),
    "f10_sibling_features": _group(_PICK("sib_")),
    "f11_blocking_features": _group(_PICK("blk_", "evb_")),
    "f12_noise": lambda s, d: features.noise_words(records(s, d), 2, 1.0).select("country", F.size("noise").cast("long").alias("n")),
    "f14_feature_report": lambda s, d: learn.feature_report(labelled(s, d, _REPORTED), _REPORTED),
    "l1_split": lambda s, d: learn.validation(pairs(s, d).select("country", "s1").distinct()),
    "l2_fold_flags": lambda s, d: learn.with_folds(pairs(s, d)).select("s1", "fold", "quick", "early").distinct(),
    "l10_level2": lambda s, d: decide.level2(candidates(s, d), clean(s, d)).select("s1", "cand", *[F.round(f, 6).alias(f) for f in learn.level2_names([], [])]),
    "l12_rule_by_country": lambda s, d: _decided(s, d).where("pred").select("s1", "cand"),
    "l13_rule_sweep": lambda s, d: decide.sweep(_universe(s, d), pairs(s, d), (1.0, 0.9, 0.0), (0.3, 0.5, 0.67, 0.8, 0.9)).select("opc_r", "thr", F.round("f05", 9).alias("f05"), F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"), "n_pred"),
    "l14_macro_f05_universe": lambda s, d: decide.score(decide.per_s1(_universe(s, d), _decided(s, d))).select(*[F.round(c, 9).alias(c) for c in ("f05", "precision", "recall", "f05_matched", "singleton_acc")], "n_pred", "tp", "n_s1"),
    "l16_losses": lambda s, d: decide.loss_report(decide.per_s1(_universe(s, d), _decided(s, d))),
    "l17_leaderboard": lambda s, d: decide.leaderboard(_universe(s, d), {"p": pairs(s, d), "root": pairs(s, d).withColumn("p", F.sqrt("p"))}, {"p": RULE, "root": RULE}),
    "l18_misses": lambda s, d: decide.miss_breakdown(_decided(s, d)),
    "t3_budget_bins": lambda s, d: ranking_ops.top_share(pairs(s, d), "country", "p", ["s1", "cand"], _n1(s, d).select("country", F.floor(1.5 * F.col("n1")).alias("n"))).select("s1", "cand", "country", "p"),
    "a13_auc_bins": lambda s, d: ranking_ops.auc(pairs(s, d), "country", "p", "label").select("country", F.round("auc", 9).alias("auc")),
    "a17_running_bins": lambda s, d: ranking_ops.running_count(pairs(s, d), "country", "p", ["s1", "cand"], "label", "hits").select("country", "s1", "cand", "hits"),
    "m3_sorted_words": lambda s, d: _names(s, d).select("s1", "cand", F.round(S.token_sort_udf("na", "nb"), 9).alias("sim")),
    "m9_soft": _group(_SOFT),
}


def _sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _view("recs")(spark, sf_dir)
    return r.select("country", F.when(F.col("source") == "S1", "s").otherwise("c").alias("side"), F.col("entity_id").alias("id"), F.lower("business_name").alias("name"))


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sided(spark, sf_dir).select(*index.ME, F.explode(T.words("name")).alias("token"))


def _n1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).groupBy("country").agg(F.countDistinct("s1").alias("n1"))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = clean(spark, sf_dir)
    g = generated(spark, sf_dir).select("s1", "cand")
    return g.join(r.select(F.col("entity_id").alias("s1"), F.col("name_core").alias("na")), "s1").join(r.select(F.col("entity_id").alias("cand"), F.col("name_core").alias("nb")), "cand")


#: DuckDB SQL for the same rows, written from the definitions and not from the expressions above.
_BAR = "CASE WHEN country = '1' THEN 0.8 WHEN rk = 0 THEN 0.5 WHEN rk = 1 THEN 0.6 ELSE 0.67 END"
_DECIDED = f"""b AS (SELECT *, max(p) OVER (PARTITION BY cand) AS best FROM pairs), k AS (SELECT *, p >= (CASE WHEN country = '1' THEN 1.0 ELSE 0.9 END) * best - 1e-12 AS ok FROM b),
 r AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY ok DESC, p DESC, cand) - 1 AS rk FROM k), pred AS (SELECT *, ok AND p >= {_BAR} AS y FROM r)"""
_UNIVERSE = """u0 AS (SELECT s1, sum(label) AS n_true, min(country) AS country FROM pairs GROUP BY s1), u AS (SELECT * FROM u0 UNION ALL SELECT -s1, s1 % 3, country FROM u0 WHERE s1 % 100 = 1)"""
_SCORED = """g AS (SELECT s1, count_if(y) AS np, sum(CASE WHEN y THEN label ELSE 0 END) AS tp, sum(label) AS nf FROM pred GROUP BY s1),
 per AS (SELECT u.s1, n_true, coalesce(np, 0) AS np, coalesce(tp, 0) AS tp, coalesce(nf, 0) AS nf, g.s1 IS NOT NULL AS has FROM u LEFT JOIN g ON u.s1 = g.s1),
 f AS (SELECT *, CASE WHEN n_true = 0 THEN CASE WHEN np = 0 THEN 1.0 ELSE 0.0 END WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp/np) * (tp/n_true) / (0.25 * tp/np + tp/n_true) END AS f05 FROM per)"""
_SK = "regexp_replace(translate(regexp_replace(token, '[aeiouhy]', '', 'g'), 'bvwpfcszjxtdkgqmnrl', 'bbbbbsssssddkkkmnrl'), '[^bsdkmnrl0-9]', '', 'g')"
_LEGAL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in T.LEGAL_FORMS.items())
#: One step of the feature phonetics after another; what looks ahead in Spark takes the next letter along here, twice where two can touch.
_PHON_STEPS = [("[^a-z]", ""), ("ph", "f"), ("([b-df-hj-np-tv-z])h+", "\\1"), ("c([eiy])", "s\\1"), ("x", "ks")]
_ph = "token"
for _a, _b in _PHON_STEPS:
    _ph = f"regexp_replace({_ph}, '{_a}', '{_b}', 'g')"
_ph = f"translate({_ph}, 'cqzwy', 'kksvi')"
for _ in range(2):
    _ph = f"regexp_replace({_ph}, 'm([cdfghjklnqrstwxyz])', 'n\\1', 'g')"
_PHON_SQL = f"WITH a AS (SELECT DISTINCT token FROM tok), b AS (SELECT token, {_ph} AS x FROM a), c AS (SELECT token, concat(regexp_replace(substr(x, 1, 1), '[aeiou]', 'a'), regexp_replace(substr(x, 2), '[aeiou]', '', 'g')) AS x FROM b) SELECT token, {{}} AS phon FROM c"
_dd = "x"
for _c in "abcdefghijklmnopqrstuvwxyz":
    _dd = f"regexp_replace({_dd}, '{_c}+', '{_c}', 'g')"
_CTX = """q AS (SELECT s1, cand, p, ln(greatest(least(p, 1 - 1e-6), 1e-6) / (1 - greatest(least(p, 1 - 1e-6), 1e-6))) AS lp FROM pairs),
 r AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) - 1 AS rc, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) - 1 AS rs FROM q),
 t AS (SELECT *, max(p) OVER (PARTITION BY cand) AS bc, max(lp) OVER (PARTITION BY cand) AS lbc, max(lp) OVER (PARTITION BY s1) AS lbs, sum(p) OVER (PARTITION BY cand) AS sc, sum(p) OVER (PARTITION BY s1) AS ss, max(CASE WHEN rc = 1 THEN lp END) OVER (PARTITION BY cand) AS l2 FROM r)"""
ORACLES = {
    "n4_non_latin": r"SELECT entity_id, regexp_matches(business_name, '[\x{0370}-\x{10FFFF}]') AND regexp_matches(regexp_replace(business_name, '[\x00-\x{036F}]', '', 'g'), '\pL') AS non_latin FROM recs",
    "n6_skeleton0": f"SELECT DISTINCT token, {_SK} AS skeleton FROM tok",
    "n7_legal_forms": f"SELECT DISTINCT token, CASE token {_LEGAL} ELSE token END AS word FROM tok",
    "n12_digit_lookalikes": "SELECT DISTINCT token, CASE WHEN regexp_matches(token, '[0-9]') AND NOT regexp_matches(token, '^[0-9]+$') AND length(regexp_replace(token, '[0-9]', '', 'g')) >= 3 AND length(regexp_replace(token, '[^0-9]', '', 'g')) <= 2 AND NOT regexp_matches(token, '[0-9][0-9]') AND NOT regexp_matches(token, '^[0-9]+(st|nd|rd|th)$') THEN translate(token, '013456789', 'oleasgtbg') ELSE token END AS word FROM tok",
    "d14_pin_digits": "SELECT rid, nullif(regexp_extract(business_address, '[A-Za-z].* ([0-9]{5,6})$', 1), '') AS pin FROM addrs",
    "d3_postal": "SELECT rid, regexp_extract(business_address, '[A-Za-z].* ([0-9]{5,6})$', 1) AS pin FROM addrs",
    "d4_masks": "SELECT rid, '' AS masks FROM addrs",
    "d12_slot": "SELECT rid, regexp_replace(lower(regexp_replace(split_part(business_address, ' ', 1), '[^A-Za-z0-9]', '', 'g')), '^0+([0-9])', '\\1') AS slot FROM addrs",
    "d13_first_numeric_word": "SELECT rid, list_filter(string_split(replace(business_address, '#', ''), ' '), lambda t: regexp_matches(t, '^[0-9]+$'))[1] AS first_num FROM addrs",
    "x11_phon": _PHON_SQL.format(_dd),
    "c9_context_features": f"""WITH {_CTX} SELECT s1, cand, round(lp, 6) AS lp, least(rc, 50)::double AS rank_c, (count(*) OVER (PARTITION BY cand))::double AS n_c, round(lbc, 6) AS lp_best_c, round(coalesce(l2, ln(1e-6/(1-1e-6))), 6) AS lp_2nd_c, round(lp - lbc, 6) AS gap_c,
 round(p/greatest(sc, 1e-6), 6) AS share_c, round(sc, 6) AS sum_c, (sum(CASE WHEN p >= 0.5*bc THEN 1 ELSE 0 END) OVER (PARTITION BY cand))::double AS near_c, least(rs, 50)::double AS rank_s, (count(*) OVER (PARTITION BY s1))::double AS n_s, round(lbs, 6) AS lp_best_s, round(lp - lbs, 6) AS gap_s,
 round(p/greatest(ss, 1e-6), 6) AS share_s, round(ss, 6) AS sum_s, round(ss - p, 6) AS other_s, (sum(CASE WHEN rc = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY s1))::double AS nbest_s FROM t""",
    "c12_budget_curve": """WITH n AS (SELECT country, count(DISTINCT s1) AS n1 FROM pairs GROUP BY country), r AS (SELECT country, label, row_number() OVER (PARTITION BY country ORDER BY p DESC, s1, cand) AS rk FROM pairs), g AS (SELECT unnest([0.5, 1.0, 1.5, 2.0, 3.0])::double AS budget)
 SELECT r.country, budget, sum(CASE WHEN rk <= floor(budget*n1) THEN 1 ELSE 0 END)::bigint AS pairs, sum(CASE WHEN rk <= floor(budget*n1) THEN label ELSE 0 END)::bigint AS hits FROM r JOIN n ON r.country = n.country CROSS JOIN g GROUP BY r.country, budget""",
    "c12_within_budget": """WITH n AS (SELECT country, count(DISTINCT s1) AS n1 FROM pairs GROUP BY country), r AS (SELECT s1, cand, p, country, row_number() OVER (PARTITION BY country ORDER BY p DESC, s1, cand) AS rk FROM pairs), k AS (SELECT s1, cand, p FROM r JOIN n ON r.country = n.country WHERE rk <= floor(1.5*n1)),
 c AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS a FROM k) SELECT s1, cand FROM c WHERE a <= 100""",
    "l12_rule_by_country": f"WITH {_DECIDED} SELECT s1, cand FROM pred WHERE y",
    "l14_macro_f05_universe": f"""WITH {_DECIDED}, {_UNIVERSE}, {_SCORED} SELECT round(avg(f05), 9) AS f05, round(sum(tp)/sum(np), 9) AS precision, round(sum(tp)/sum(n_true), 9) AS recall, round(avg(CASE WHEN n_true > 0 THEN f05 END), 9) AS f05_matched, round(avg(CASE WHEN n_true = 0 THEN f05 END), 9) AS singleton_acc,
 sum(np)::bigint AS n_pred, sum(tp)::bigint AS tp, count(*) AS n_s1 FROM f""",
    "l18_misses": f"""WITH {_DECIDED}, m AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) - 1 AS rr, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) AS rc FROM pred), t2 AS (SELECT cand, max(CASE WHEN rc = 1 THEN s1 END) AS o1, max(CASE WHEN rc = 2 THEN s1 END) AS o2 FROM m WHERE rc <= 2 GROUP BY cand),
 x AS (SELECT m.*, CASE WHEN rc = 1 THEN o2 ELSE o1 END AS o FROM m JOIN t2 ON m.cand = t2.cand), z AS (SELECT x.*, w.label = 1 AS also FROM x LEFT JOIN pairs w ON w.s1 = x.o AND w.cand = x.cand WHERE x.label = 1 AND NOT y)
 SELECT CASE WHEN p <= 0.05 THEN '0-0.05' WHEN p <= 0.2 THEN '0.05-0.2' WHEN p <= 0.4 THEN '0.2-0.4' WHEN p <= 0.6 THEN '0.4-0.6' WHEN p <= 0.8 THEN '0.6-0.8' ELSE '0.8-1' END AS band, least(rr, 5)::int AS rank, p < best - 1e-12 AS prefers_other, p < best - 1e-12 AND coalesce(also, false) AS other_also_true, count(*) AS n FROM z GROUP BY 1, 2, 3, 4""",
    "b30_noise": """WITH n AS (SELECT country, count(CASE WHEN source='S1' THEN 1 END) AS n1, count(CASE WHEN source<>'S1' THEN 1 END) AS n2 FROM recs GROUP BY country), d AS (SELECT country, token, count(CASE WHEN source='S1' THEN 1 END) AS ds, count(CASE WHEN source<>'S1' THEN 1 END) AS dc FROM tok GROUP BY country, token)
 SELECT d.country, token FROM d JOIN n ON d.country = n.country WHERE length(token) <= 3 AND dc >= 100 AND dc*n1 >= 10*(ds+1)*n2""",
    "t3_budget_bins": """WITH n AS (SELECT country, count(DISTINCT s1) AS n1 FROM pairs GROUP BY country), r AS (SELECT s1, cand, country, p, row_number() OVER (PARTITION BY country ORDER BY p DESC, s1, cand) AS rk FROM pairs) SELECT s1, cand, r.country, p FROM r JOIN n ON r.country = n.country WHERE rk <= floor(1.5*n1)""",
    "a13_auc_bins": """WITH r AS (SELECT country, label, rank() OVER (PARTITION BY country ORDER BY p) + (count(*) OVER (PARTITION BY country, p) - 1)/2.0 AS rk FROM pairs) SELECT country, round((sum(CASE WHEN label = 1 THEN rk END) - sum(label)*(sum(label)+1)/2.0) / (sum(label)*(count(*) - sum(label))), 9) AS auc FROM r GROUP BY country""",
    "a17_running_bins": "SELECT country, s1, cand, (sum(label) OVER (PARTITION BY country ORDER BY p DESC, s1, cand ROWS UNBOUNDED PRECEDING))::bigint AS hits FROM pairs",
}
