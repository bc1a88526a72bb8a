"""Blocking: keys of 24 families, the capped key index, pair generation, and 17 diagnostic blockers with recall.

Records are clean rows (``cleaning.clean_records``): ``entity_id, source, country_clean`` and the cleaned columns.  ``S1`` is
the reference side, any other source the candidate side.  Keys meet on (country, family, key) only if both sides
have them and they are under the family's caps, so a frequent key costs nothing; all joins and counts of the index share one
partitioning by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from entres.functions import text as T
from entres.sources.stored import spread, stored

from .steps import step

#: (name, S1 cap, candidate cap, weight); the place is the bit of the evidence mask.
FAMILIES = [
    ("nmF_FF", 30, 3000, 2.0), ("nmF_SF", 20, 3000, 1.3), ("nmF_F1", 20, 3000, 1.3), ("nmF_11", 12, 1500, 0.9), ("skF_FF", 40, 3000, 1.6), ("skF_SF", 20, 3000, 1.1), ("skF_11", 12, 1500, 0.8), ("nm_set", 30, 3000, 1.5),
    ("nm_pfx", 25, 3000, 1.0), ("nm_char", 15, 1500, 1.0), ("nm_tok", 15, 1500, 0.8), ("nm_addr", 40, 400, 1.0), ("fl_addr", 30, 1000, 1.5), ("rw_addr", 30, 1000, 1.4), ("s2F_FF", 40, 3000, 1.3), ("ad_full", 20, 1000, 2.0),
    ("ad_pair", 50, 400, 1.0), ("ad_numx", 30, 1000, 1.0), ("lw_name", 300, 5000, 1.0), ("lw_skel", 300, 5000, 0.9), ("lw_pfx3", 300, 5000, 0.8), ("fz_addr", 30, 800, 1.2), ("ad_numw", 30, 600, 1.0), ("ad_skpair", 40, 600, 0.9),
]
FAMILY = [f[0] for f in FAMILIES]
STRONG = sum(1 << FAMILY.index(f) for f in ("nmF_FF", "skF_FF", "nm_set", "ad_full"))
LOW_ADDRESS, WORDS, BOOST = 0.8, 6, 10
#: Candidate-only noise words: letters at most, candidates at least, times as frequent as in S1.
NOISE = (3, 100, 10.0)
#: Keys (block cap, k rarest, n-gram df cap, budget) of the diagnostic blockers.
BLOCKERS = {
    "name_exact": (50000, None, None, None), "name_sorted": (50000, None, None, None), "name_flat": (50000, None, None, None), "name_token": (80000, 12, None, 700), "name_ngram": (60000, 24, 50000, 900),
    "skel_exact": (50000, None, None, None), "skel2_exact": (50000, None, None, None), "skel_token": (80000, 12, None, 400), "skel2_token": (80000, 12, None, 400), "skel_ngram": (60000, 24, 50000, 700),
    "addr_sorted": (50000, None, None, None), "addr_pin": (50000, None, None, None), "addr_token": (60000, 12, None, 900), "addr_num": (30000, 8, None, 300), "addr_alnum": (30000, 8, None, 300),
    "anchor": (50000, None, None, None), "anchor2": (50000, None, None, None),
}
#: Weights of keys are summed as whole numbers of such parts: a sum of fractions would depend on the order of rows, and ranks of equal pairs with it.
STEPS = float(1 << 40)
ME = ["country", "side", "id"]


# ---------------------------------------------------------------- token tables
def frequencies(tokens: DataFrame) -> DataFrame:
    """``tokens(country, side, id, token)`` to records with each token on either side: country, token, df_s, df_c."""
    t = tokens.select(*ME, "token").distinct()
    return t.groupBy("country", "token").agg(F.count_if(F.col("side") == "s").alias("df_s"), F.count_if(F.col("side") == "c").alias("df_c"))


def sizes(records: DataFrame) -> DataFrame:
    return records.groupBy("country").agg(F.count_if(F.col("side") == "s").alias("n1"), F.count_if(F.col("side") == "c").alias("n2"))


def idf_block(df: Column, n: Column) -> Column:
    """Rarity among S1 between 0 and 1; 0 for a word that no S1 has."""
    return F.when(df == 0, 0.0).otherwise(F.ln((n + 1) / (df + 1)) / F.ln(n + 1))


def idf_feat(df: Column, n: Column) -> Column:
    return (F.ln((1 + n) / (1 + df)) + 1) / (F.ln(1 + n) + 1)


def rarest(tokens: DataFrame, df: DataFrame, k: int, out: str, order: str = "df_s") -> DataFrame:
    """The k rarest tokens that both sides have, per record: country, side, id and an array, rarest first."""
    t = tokens.select(*ME, "token").distinct().join(df.where("df_s > 0 and df_c > 0"), ["country", "token"])
    t = t.withColumn("r", F.row_number().over(W.partitionBy(*ME).orderBy(order, "token"))).where(F.col("r") <= k)
    return t.groupBy(*ME).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "token"))), lambda x: x.token).alias(out))


def noise_words(df: DataFrame, n: DataFrame) -> DataFrame:
    """Short words that are frequent in candidate names and all but absent from S1 names: country, token."""
    letters, least, times = NOISE
    d = df.join(n, "country")
    return d.where((F.length("token") <= letters) & (F.col("df_c") >= least) & (F.col("df_c") * F.col("n1") >= times * (F.col("df_s") + 1) * F.col("n2"))).select("country", "token")


def legal_vocabulary(records: DataFrame, least: int = 20) -> DataFrame:
    """Words of full S1 names that no S1 core has, in ``least`` names and more; with their number: country, token, df."""
    s = records.where("source = 'S1'")
    full = s.select(F.col("country_clean").alias("country"), "entity_id", F.explode(F.array_distinct(T.words("name_translit"))).alias("token")).where(F.length("token") >= 2)
    inner = s.select(F.col("country_clean").alias("country"), F.explode(T.words("name_core")).alias("token"))
    return full.join(inner, ["country", "token"], "left_anti").groupBy("country", "token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= least)


# ---------------------------------------------------------------- variants and crossings of keys
def minus_one(w: Column, least: int = 2, most: int = 6) -> Column:
    """Names without one word, written without spaces; of names of ``least`` to ``most`` words."""
    drop = F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: T.joined(F.filter(w, lambda x, j: j != i), ""))
    return F.when(F.size(w).between(least, most), F.array_distinct(drop)).otherwise(F.array().cast("array<string>"))


def _pairs(n: Column) -> Column:
    """(i, j) with i < j below n, as i * 100 + j."""
    return F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(F.sequence(i + 1, n - 1), lambda j: i * 100 + j)))


def minus_two(w: Column, least: int = 4, most: int = 5) -> Column:
    drop = F.transform(_pairs(F.size(w)), lambda p: T.joined(F.filter(w, lambda x, j: (j != F.floor(p / 100)) & (j != p % 100)), ""))
    return F.when(F.size(w).between(least, most), F.array_distinct(drop)).otherwise(F.array().cast("array<string>"))


def one_letter_less(flat: Column, least: int = 4, most: int = 22) -> Column:
    """The name and all names with one letter less: two names that share one are within a typo."""
    less = F.transform(F.sequence(F.lit(1), F.length(flat)), lambda i: F.concat(F.substr(flat, F.lit(1), i - 1), F.substr(flat, i + 1)))
    return F.when(F.length(flat).between(least, most), F.array_distinct(F.concat(F.array(flat), less))).otherwise(F.array().cast("array<string>"))


def crossed(a: Column, b: Column) -> Column:
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat(x, F.lit("|"), y))))


def paired(w: Column) -> Column:
    """Unordered pairs of the words."""
    both = F.transform(_pairs(F.size(w)), lambda p: T.joined(F.array_sort(F.array(F.get(w, F.floor(p / 100).cast("int")), F.get(w, (p % 100).cast("int")))), "|"))
    return F.when(F.size(w) >= 2, both).otherwise(F.array().cast("array<string>"))


def one(c: Column) -> Column:
    """An array of a key, empty without one."""
    return F.when(F.coalesce(c, F.lit("")) != "", F.array(c)).otherwise(F.array().cast("array<string>"))


# ---------------------------------------------------------------- records for keys
def prepared(records: DataFrame) -> DataFrame:
    """What each record contributes to keys."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    r = records.select(
        F.col("country_clean").alias("country"), F.when(F.col("source") == "S1", "s").otherwise("c").alias("side"), F.col("entity_id").alias("id"), T.key_words(T.words("name_core")).alias("raw"),
        T.joined(T.key_words(T.words(c("name_primary"))), "").alias("half1"), T.joined(T.key_words(T.words(c("name_alias"))), "").alias("half2"),
        F.array_distinct(F.transform(T.words(c("address_clean")), T.blocking_address_word)).alias("aw"), T.pin_digits("address_pin").alias("pin"),
        T.joined(F.array_sort(F.array_distinct(T.legal_words("name_translit", "name_core")))).alias("lfx"), T.stripped_initials("name_translit", "name_core").alias("lfi"),
    )
    r = step(r)
    masked = F.transform(F.filter("aw", lambda t: T.is_digits(t) & (F.length(t) >= 3)), lambda t: F.concat(F.lit("xx"), F.substr(t, F.lit(3))))
    r = step(r, akeys=F.when(F.col("side") == "s", F.array_union("aw", masked)).otherwise(F.col("aw")), askw=F.filter(F.array_distinct(T.skeleton_words(F.col("aw"))), lambda t: (F.length(t) >= 3) & ~t.rlike("[0-9]")))
    return step(r, num=F.array_distinct(F.transform(T.numbers(F.col("aw")), lambda t: F.regexp_replace(t, "^0+(?=[0-9])", ""))))


def explode_tokens(r: DataFrame, column: str) -> DataFrame:
    return r.select(*ME, F.explode(column).alias("token"))


def _kind(k: int):
    return lambda x: F.struct(F.lit(k).alias("kind"), x.alias("token"))


def labelled_tokens(r: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """The distinct tokens of each row's arrays, with the place of the array: ids, kind, token."""
    empty = F.array().cast("array<string>")
    rows = F.concat(*[F.transform(F.array_distinct(F.coalesce(F.col(c), empty)), _kind(k)) for k, c in enumerate(columns)])
    return r.select(*ids, F.explode(rows).alias("t")).select(*ids, "t.kind", "t.token")


def with_low(r: DataFrame) -> DataFrame:
    """Add ``weak`` (no address word that an S1 has) and ``low`` (the address cannot tell S1 apart), and ``ad_sum``."""
    tokens = explode_tokens(r, "akeys")
    d = frequencies(tokens).join(sizes(r), "country").withColumn("w", idf_block(F.col("df_s"), F.col("n1")))
    s = tokens.distinct().join(d.where("df_s > 0").select("country", "token", "w"), ["country", "token"]).groupBy(*ME).agg(F.sum("w").alias("ad_sum"), F.count(F.lit(1)).alias("ad_n"))
    r = r.join(s, ME, "left").withColumn("ad_sum", F.coalesce("ad_sum", F.lit(0.0))).withColumn("ad_n", F.coalesce("ad_n", F.lit(0)))
    return r.withColumn("weak", F.col("ad_n") == 0).withColumn("low", (F.col("ad_n") == 0) | (F.col("ad_sum") < LOW_ADDRESS))


def denoised(r: DataFrame) -> DataFrame:
    """Candidate names without noise words, unless nothing would be left.  The noise words of a country are few: three letters at most."""
    d = noise_words(frequencies(explode_tokens(r, "raw")), sizes(r)).groupBy("country").agg(F.collect_list("token").alias("noise"))
    r = r.join(d, "country", "left")
    kept = F.filter("raw", lambda t: ~F.array_contains("noise", t))
    clean = (F.col("side") == "c") & F.col("noise").isNotNull() & (F.size(kept) > 0)
    return r.withColumn("raw", F.when(clean, kept).otherwise(F.col("raw"))).drop("noise")


def ready(records: DataFrame) -> DataFrame:
    """``prepared`` records with ``weak``, ``low`` and ``ad_sum``: what the keys and the block records both begin with."""
    return with_low(stored(prepared(spread(records)), "prepared"))


def family_keys(records: DataFrame, begun: DataFrame | None = None) -> DataFrame:
    """Distinct keys of all families: country, side, id, family, key.  ``begun`` is the stored ``ready`` table, where there is one."""
    r = denoised(stored(ready(records), "low") if begun is None else begun)
    r = step(r, sk=T.skeleton_words(F.col("raw")), q=T.skeleton_words(F.col("raw"), coarse=True))
    r = stored(r, "words")
    f_r, f_k, f_a, f_p, f_n = (frequencies(explode_tokens(r, c)) for c in ("raw", "sk", "akeys", "askw", "num"))
    words_only = explode_tokens(r, "akeys").where("not token rlike '^[0-9]+$'")
    short = explode_tokens(r, "num").where("length(token) <= 6")
    parts = [rarest(explode_tokens(r, "raw"), f_r, 2, "rare_raw"), rarest(explode_tokens(r, "sk"), f_k, 2, "rare_sk"), rarest(explode_tokens(r, "akeys"), f_a, 16, "ad"), rarest(words_only, f_a, 12, "ada"), rarest(explode_tokens(r, "askw"), f_p, 8, "ska"), rarest(short, f_n, 3, "nv")]
    r = reduce(lambda a, b: a.join(b, ME, "left"), parts, r)
    empty = F.array().cast("array<string>")
    for c in ("rare_raw", "rare_sk", "ad", "ada", "ska", "nv"):
        r = r.withColumn(c, F.coalesce(c, empty))
    raw, sk = F.slice("raw", 1, WORDS), F.slice("sk", 1, WORDS)
    r = r.select(
        *ME, "low", "raw", "sk", "half1", "half2", "aw", "rare_raw", "rare_sk", "ad", "ada", "ska", "nv", "num", T.joined(raw, "").alias("raw_full"), T.joined(sk, "").alias("sk_full"), T.joined(F.slice("q", 1, WORDS), "").alias("q_full"),
        F.when(F.size("raw") <= WORDS, minus_one(raw)).otherwise(empty).alias("raw1"), F.when(F.size("raw") <= WORDS, minus_two(raw)).otherwise(empty).alias("raw2"),
        F.when(F.size("sk") <= WORDS, minus_one(sk)).otherwise(empty).alias("sk1"), F.when(F.size("sk") <= WORDS, minus_two(sk)).otherwise(empty).alias("sk2"), T.joined("raw", "").alias("flat"),
    )
    r = spread(stored(r, "key-words"))
    s, col = F.col("side") == "s", F.col
    by = lambda a, b: F.when(s, a).otherwise(b)
    low = lambda x: F.when(s | col("low"), x).otherwise(empty)
    first_k = lambda c, a, b: F.when(s, F.slice(c, 1, a)).otherwise(F.slice(c, 1, b))
    halves = F.filter(F.array("half1", "half2"), lambda x: (x != "") & (x != col("raw_full")))
    bag = F.array_sort(F.array_distinct(F.slice("raw", 1, WORDS)))
    set_less = F.concat(
        F.when(F.size(bag) >= 3, F.transform(F.sequence(F.lit(0), F.size(bag) - 1), lambda i: T.joined(F.filter(bag, lambda x, j: j != i)))).otherwise(empty),
        F.when(F.size(bag) >= 4, F.transform(_pairs(F.size(bag)), lambda p: T.joined(F.filter(bag, lambda x, j: (j != F.floor(p / 100)) & (j != p % 100))))).otherwise(empty),
    )
    cut = lambda k: T.truncated(F.slice("raw", 2, 4), k)
    p3 = T.truncated(F.slice("raw", 1, WORDS), 3)
    first = F.get("raw", F.lit(0))
    initials = [F.when(F.size("raw") >= 2, F.concat(F.lit(f"{k}:"), T.joined(F.concat(F.array(first), cut(k))))) for k in (1, 2)]
    pc2 = F.when((F.size("raw") >= 2) & (F.length(first) >= 3), F.concat(first, F.lit(" "), F.substr(F.get("raw", F.lit(1)), F.lit(1), F.lit(1))))
    sk1 = F.when(F.length(F.get("sk", F.lit(0))) >= 2, F.concat(F.lit("~"), F.get("sk", F.lit(0))))
    small_sk, small_raw = F.size("sk") <= 5, F.size("raw") <= 5
    fl = F.concat(one(col("sk_full")), one(F.when(col("q_full") != col("sk_full"), col("q_full"))), F.when(small_sk, col("sk1")).otherwise(empty), F.when(small_sk & ~s, col("sk2")).otherwise(empty))
    rw = F.concat(one(col("raw_full")), F.when(small_raw, col("raw1")).otherwise(empty))
    nx = F.array_distinct(F.transform(F.filter("num", lambda t: F.length(t) >= 3), lambda t: F.substr(t, F.lit(1), F.length(t) - 1)))
    keys = [
        F.concat(one(col("raw_full")), halves), by(F.concat(col("raw1"), col("raw2")), one(col("raw_full"))), by(one(col("raw_full")), F.concat(col("raw1"), col("raw2"))), col("raw1"),
        one(col("sk_full")), by(F.concat(col("sk1"), col("sk2")), one(col("sk_full"))), col("sk1"), by(F.concat(one(T.joined(bag)), set_less), one(T.joined(bag))),
        one(F.when(F.length("flat") > 10, F.substr("flat", F.lit(1), F.lit(10)))), low(one_letter_less(col("flat"))),
        F.concat(F.transform(by(col("raw"), col("rare_raw")), lambda x: F.concat(F.lit("r:"), x)), F.transform(by(col("sk"), F.slice("rare_sk", 1, 1)), lambda x: F.concat(F.lit("k:"), x))),
        crossed(first_k("rare_sk", 2, 1), first_k("ad", 12, 5)), crossed(fl, first_k("ad", 16, 5)), crossed(rw, first_k("ad", 16, 5)), one(col("q_full")), one(T.joined(F.array_sort("aw"))),
        paired(first_k("ad", 10, 5)), crossed(nx, first_k("ad", 8, 4)), low(F.concat(one(col("raw_full")), col("raw1"), col("raw2"), halves)), low(F.concat(one(col("sk_full")), col("sk1"), col("sk2"))),
        low(F.concat(one(T.joined(p3, "")), minus_one(p3), one(initials[0]), one(initials[1]))), F.concat(crossed(one(pc2), first_k("ad", 12, 5)), crossed(one(sk1), first_k("ska", 8, 4))),
        crossed(F.concat(col("nv"), paired(col("nv"))), first_k("ada", 12, 5)), paired(first_k("ska", 6, 3)),
    ]
    tagged = [_tagged(k, b, empty) for b, k in enumerate(keys)]
    return r.select(*ME, F.explode(F.concat(*tagged)).alias("k")).select(*ME, "k.family", "k.key").where("key <> ''")


def _tagged(keys: Column, family: int, empty: Column) -> Column:
    return F.transform(F.array_distinct(F.coalesce(keys, empty)), lambda x: F.struct(F.lit(family).alias("family"), x.alias("key")))


# ---------------------------------------------------------------- the index
def capped(keys: DataFrame, families: list[tuple[str, int, int, float]] = FAMILIES) -> DataFrame:
    """Keys that both sides have under their family's caps: country, family, key, kn1, kn2.

    A key of few S1 may have up to ``BOOST`` times as many candidates, as each brings few pairs.
    """
    caps = F.create_map(*[x for b, (_, s, c, _) in enumerate(families) for x in (F.lit(b), F.array(F.lit(s), F.lit(c)))])
    k = keys.groupBy("country", "family", "key").agg(F.count_if(F.col("side") == "s").alias("kn1"), F.count_if(F.col("side") == "c").alias("kn2"))
    cap_s, cap_c = F.get(caps[F.col("family")], F.lit(0)), F.get(caps[F.col("family")], F.lit(1))
    most = F.greatest(cap_c, F.least(cap_c * BOOST, F.floor(cap_c * cap_s / F.greatest("kn1", F.lit(1)))))
    return k.where((F.col("kn1") >= 1) & (F.col("kn2") >= 1) & (F.col("kn1") <= cap_s) & (F.col("kn2") <= most))


def weighed(index: DataFrame, n: DataFrame, families: list[tuple[str, int, int, float]] = FAMILIES) -> DataFrame:
    """Add ``w``: how surprising it is that a random S1 has the key, times the family's weight."""
    weight = F.create_map(*[x for b, f in enumerate(families) for x in (F.lit(b), F.lit(f[3]))])
    eff = F.greatest(F.col("kn1").cast("double"), F.col("kn2") * F.col("n1") / F.col("n2"), F.lit(1.0))
    rare = F.greatest(1 - F.ln(eff) / F.ln(F.greatest("n1", F.lit(3))), F.lit(0.0))
    return index.join(F.broadcast(n), "country").withColumn("w", rare * weight[F.col("family")]).drop("n1", "n2")


def affordable(index: DataFrame, most: int = 3_000_000_000) -> DataFrame:
    """The cheapest keys of each country whose postings sum to no more than ``most``.

    No sort of all keys: costs are summed by powers of 2 ** (1 / 4), and only the power that the sum passes in is ordered key by key.
    """
    k = index.withColumn("cost", F.col("kn1") * F.col("kn2")).withColumn("bin", F.floor(F.log2("cost") * 4).cast("int"))
    bins = k.groupBy("country", "bin").agg(F.sum("cost").alias("sum"))
    run = F.sum("sum").over(W.partitionBy("country").orderBy("bin").rowsBetween(W.unboundedPreceding, -1))
    bins = bins.select("country", "bin", F.coalesce(run, F.lit(0)).alias("before"), "sum").where(F.col("before") < most)
    k = k.join(F.broadcast(bins), ["country", "bin"])
    whole = k.where(F.col("before") + F.col("sum") <= most)
    edge = k.where(F.col("before") + F.col("sum") > most)
    order = W.partitionBy("country", "bin").orderBy("cost", "family", "key").rowsBetween(W.unboundedPreceding, 0)
    edge = edge.withColumn("run", F.sum("cost").over(order)).where(F.col("before") + F.col("run") <= most)
    return whole.select(*index.columns).unionByName(edge.select(*index.columns))


def pairs(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs that share a key of the weighed index: country, s1, cand, score, n_keys, evidence_mask, n_evidence."""
    on = ["country", "family", "key"]
    live = keys.join(index.select(*on, "w"), on)
    s = live.where("side = 's'").select(*on, F.col("id").alias("s1"), "w")
    c = live.where("side = 'c'").select(*on, F.col("id").alias("cand"))
    bit = F.expr("shiftleft(1L, family)")
    out = s.join(c, on).groupBy("country", "s1", "cand").agg((F.sum(F.round(F.col("w") * STEPS).cast("long")) / STEPS).alias("score"), F.count(F.lit(1)).alias("n_keys"), F.bit_or(bit).alias("evidence_mask"))
    return out.withColumn("n_evidence", F.bit_count("evidence_mask").cast("long"))


def generate(records: DataFrame, begun: DataFrame | None = None) -> DataFrame:
    """All candidate pairs of clean records.  The keys under their caps are stored, so that they are counted once and the files of the count are gone before the sides meet."""
    keys = stored(family_keys(records, begun), "keys")
    n = sizes(records.select(F.col("country_clean").alias("country"), F.when(F.col("source") == "S1", "s").otherwise("c").alias("side")))
    return pairs(keys, stored(affordable(weighed(capped(keys), n)), "index"))


def family_counters(pairs_: DataFrame) -> DataFrame:
    """Pairs that carry each family, and that carry it alone; one pass, no grid."""
    m = F.col("evidence_mask")
    cols = [F.struct(F.lit(b).alias("family"), F.lit(f).alias("name"), F.count_if(m.bitwiseAND(F.lit(1 << b)) != 0).alias("carrying"), F.count_if(m == (1 << b)).alias("alone")) for b, f in enumerate(FAMILY)]
    return pairs_.agg(F.array(*cols).alias("x")).select(F.explode("x").alias("x")).select("x.*")


# ---------------------------------------------------------------- diagnostic blockers
def blocker_keys(records: DataFrame, blockers: list[str] | None = None) -> DataFrame:
    """Distinct keys of the diagnostic blockers: blocker, country, side, id, key; the rarest k of each S1 record."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    r = records.select(F.col("country_clean").alias("country"), F.when(F.col("source") == "S1", "s").otherwise("c").alias("side"), F.col("entity_id").alias("id"), c("name_core").alias("name"), c("name_tokens_sorted").alias("sorted"), c("address_tokens_sorted").alias("addr"), c("address_pin").alias("pin"))
    w, aw = T.words("name"), T.words("addr")
    skel = F.filter(F.transform(w, T.skeleton), lambda x: x != "")
    head = F.substr(F.replace(F.col("sorted"), F.lit(" "), F.lit("")), F.lit(1), F.lit(4))
    flat2 = F.regexp_replace(T.joined(T.skeleton_words(T.key_words(w)), ""), r"(.)\1+", "$1")
    keys = {
        "name_exact": one(F.col("name")), "name_sorted": one(F.col("sorted")), "name_flat": one(T.joined(T.key_words(w), "")), "name_token": w, "name_ngram": T.ngrams("name", 4), "skel_exact": one(T.joined(skel, "")),
        "skel2_exact": one(flat2), "skel_token": F.filter(skel, lambda x: F.length(x) >= 4), "skel2_token": F.filter(T.skeleton_words(T.key_words(w)), lambda x: F.length(x) >= 3), "skel_ngram": T.ngrams(T.joined(skel), 5),
        "addr_sorted": one(F.col("addr")), "addr_pin": one(F.col("pin")), "addr_token": aw, "addr_num": F.filter(aw, lambda x: T.is_digits(x) & F.length(x).between(3, 6)),
        "addr_alnum": F.filter(aw, lambda x: x.rlike("[0-9]") & x.rlike("[^0-9]") & (F.length(x) >= 2)), "anchor": one(F.when((F.length(head) == 4) & (F.length("pin") >= 3), F.concat(head, F.lit("|"), F.substr("pin", F.lit(1), F.lit(3))))),
    }
    wanted = blockers or list(BLOCKERS)
    none = F.array().cast("array<struct<blocker:string,key:string>>")
    rows = r.select(*ME, F.explode(F.concat(none, *[F.transform(F.array_distinct(k), _named(b)) for b, k in keys.items() if b in wanted])).alias("k")).select("k.blocker", *ME, "k.key")
    if "anchor2" in wanted:
        rare = []
        for out, arr in (("sk", skel), ("ad", aw)):
            t = r.select(*ME, F.explode(F.array_distinct(arr)).alias("token"))
            rare.append(t.join(frequencies(t), ["country", "token"]).groupBy(*ME).agg(F.min_by("token", F.struct("df_c", "token")).alias(out)))
        two = rare[0].join(rare[1], ME).select(F.lit("anchor2").alias("blocker"), *ME, F.concat("sk", F.lit("|"), "ad").alias("key"))
        rows = rows.unionByName(two)
    return rows


def _named(blocker: str):
    return lambda x: F.struct(F.lit(blocker).alias("blocker"), x.alias("key"))


def blocked(keys: DataFrame) -> DataFrame:
    """Keys left by the blockers' caps: both sides, block cap, df cap, k rarest per S1, and the running budget before the key."""
    limit = F.create_map(*[x for b, v in BLOCKERS.items() for x in (F.lit(b), F.array(*[F.lit(n).cast("long") for n in v]))])
    cap = lambda i: F.get(limit[F.col("blocker")], F.lit(i))
    on = ["blocker", "country", "key"]
    n = keys.groupBy(*on).agg(F.count_if(F.col("side") == "s").alias("n1"), F.count_if(F.col("side") == "c").alias("n2"))
    live = n.where((F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n2") <= F.least(cap(0), F.coalesce(cap(2), cap(0)))))
    rows = keys.join(live, on)
    mine = W.partitionBy("blocker", "country", "id").orderBy("n2", "key")
    s = rows.where("side = 's'").withColumn("r", F.row_number().over(mine)).withColumn("before", F.coalesce(F.sum("n2").over(mine.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    s = s.where((F.col("r") <= F.coalesce(cap(1), F.lit(1 << 40))) & (F.col("before") < F.coalesce(cap(3), F.lit(1 << 60))))
    return s.drop("r", "before").unionByName(rows.where("side = 'c'"))


def blocker_report(records: DataFrame, truth: DataFrame, blockers: list[str] | None = None) -> DataFrame:
    """Per blocker and country: keys, postings, pairs, pairs per S1, found, recall, precision.  ``truth(s1, cand)``; no pairs are built."""
    keys = blocked(blocker_keys(records, blockers))
    s, c = keys.where("side = 's'"), keys.where("side = 'c'")
    stats = s.groupBy("blocker", "country").agg(F.countDistinct("key").alias("keys"), F.count(F.lit(1)).alias("s1_postings"), F.sum("n2").alias("pairs"))
    found = found_by(truth, s, c).groupBy("blocker", "country").agg(F.count(F.lit(1)).alias("found"))
    place = records.select(F.col("entity_id").alias("s1"), F.col("country_clean").alias("country"))
    total = truth.join(place, "s1").groupBy("country").agg(F.count(F.lit(1)).alias("true_pairs"))
    n = records.where("source = 'S1'").groupBy(F.col("country_clean").alias("country")).agg(F.count(F.lit(1)).alias("n1"))
    out = stats.join(found, ["blocker", "country"], "left").join(total, "country", "left").join(n, "country")
    hits = F.coalesce("found", F.lit(0))
    return out.select("blocker", "country", "keys", "s1_postings", "pairs", (F.col("pairs") / F.col("n1")).alias("pairs_per_s1"), hits.alias("found"), T.ratio(hits, F.col("true_pairs")).alias("recall"), T.ratio(hits, F.col("pairs")).alias("precision"))


def found_by(truth: DataFrame, s: DataFrame, c: DataFrame) -> DataFrame:
    """(blocker, country, s1, cand) of true pairs that share a key: the truth is joined with keys, pairs are never built."""
    a = truth.join(s.select("blocker", "country", F.col("id").alias("s1"), "key"), "s1")
    return a.join(c.select("blocker", "country", F.col("id").alias("cand"), "key"), ["blocker", "country", "cand", "key"]).select("blocker", "country", "s1", "cand").distinct()


def missed(records: DataFrame, truth: DataFrame, blockers: list[str] | None = None) -> DataFrame:
    """True pairs that no blocker finds, with why: the candidate's name is not ASCII, an empty name, an empty address, or other."""
    keys = blocked(blocker_keys(records, blockers))
    left = truth.join(found_by(truth, keys.where("side = 's'"), keys.where("side = 'c'")).select("s1", "cand").distinct(), ["s1", "cand"], "left_anti")
    side = lambda k: records.select(F.col("entity_id").alias(k), *[F.coalesce(F.col(x), F.lit("")).alias(f"{k}_{x}") for x in ("business_name", "name_core", "address_tokens_sorted")])
    out = left.join(side("s1"), "s1").join(side("cand"), "cand")
    odd, name = T.non_ascii("cand_business_name"), (F.col("s1_name_core") == "") | (F.col("cand_name_core") == "")
    address = (F.col("s1_address_tokens_sorted") == "") | (F.col("cand_address_tokens_sorted") == "")
    return out.select("s1", "cand", odd.alias("non_latin"), name.alias("empty_name"), address.alias("empty_address"), (~odd & ~name & ~address).alias("other"))


def country_report(records: DataFrame, truth: DataFrame) -> DataFrame:
    """What the country filter keeps: S1, candidates, true pairs, pairs of one country, recall and space, with a row for all."""
    n = records.groupBy(F.col("country_clean").alias("country")).agg(F.count_if(F.col("source") == "S1").alias("n1"), F.count_if(F.col("source") != "S1").alias("n2"))
    place = lambda k: records.select(F.col("entity_id").alias(k), F.col("country_clean").alias(f"{k}_country"))
    t = truth.join(place("s1"), "s1").join(place("cand"), "cand", "left")
    t = t.groupBy(F.col("s1_country").alias("country")).agg(F.count(F.lit(1)).alias("true_pairs"), F.count_if(F.col("s1_country") == F.col("cand_country")).alias("kept"))
    x = n.join(t, "country", "left").withColumn("space", F.col("n1") * F.col("n2"))
    x = x.groupBy(F.coalesce("country", F.lit("")).alias("country")).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n1", "n2", "true_pairs", "kept", "space")])
    x = x.unionByName(x.agg(F.lit("ALL").alias("country"), *[F.sum(c).alias(c) for c in ("n1", "n2", "true_pairs", "kept", "space")]))
    return x.withColumn("recall", T.ratio(F.col("kept"), F.col("true_pairs")))
