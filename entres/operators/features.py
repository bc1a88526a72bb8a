"""Pair features: 158 columns in groups, for pairs (country, s1, cand) of clean records.

A record carries its words with their rarity as short arrays, so a pair is scored from two rows and no words are joined pair by
pair.  Missing is null, never 0.  Similarities that Spark lacks run in Arrow batches, each distinct pair of values once.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from entres.functions import batches as B
from entres.functions import strings as S
from entres.functions import text as T
from entres.sources.stored import spread, stored

from .index import FAMILY, idf_feat, labelled_tokens
from .ranking_ops import gap, rank_lead
from .steps import step

THETA, NAME_WORDS, ADDRESS_WORDS, NUMBERS = 0.90, 6, 5, 4
SLOTS = ["house_number", "unit_number", "floor_number", "plot_number", "sector", "phase", "block"]
SUBLOC = ["plot_number", "sector", "phase", "block"]
WEB = r"(?i)(?:www\.|\.(?:com|net|org|info|biz|io|co|in|fr|us|uk)\b|^\s*[#@])"


def _weighted(r: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add an array for each array of ``columns``: its distinct tokens with their rarity, rarest first.  One count and one join serve all of them."""
    t = labelled_tokens(r, ["country", "id"], list(columns))
    n = r.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    df = t.groupBy("country", "kind", "token").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(n), "country").select("country", "kind", "token", idf_feat(F.col("df"), F.col("n")).alias("w"))
    mine = lambda k: F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct((-F.col("w")).alias("o"), "token"))))
    back = t.join(df, ["country", "kind", "token"]).groupBy("country", "id").agg(*[mine(k).alias(out) for k, out in enumerate(columns.values())])
    empty = F.array().cast("array<struct<token:string,w:double>>")
    back = back.select("country", "id", *[F.transform(out, lambda x: F.struct(x.token.alias("token"), (-x.o).alias("w"))).alias(out) for out in columns.values()])
    return r.join(back, ["country", "id"], "left").withColumns({out: F.coalesce(out, empty) for out in columns.values()})


def feature_records(records: DataFrame) -> DataFrame:
    """What each clean record brings to its pairs, one row an id (the first source wins)."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    r = records.withColumn("__r", F.row_number().over(W.partitionBy("entity_id").orderBy("source"))).where("__r = 1")
    raw = c("business_name")
    name = F.coalesce(T.not_empty(F.trim(c("name_core"))), T.not_empty(F.trim(c("name_translit"))), F.lower(F.trim(raw)))
    web = raw.rlike(WEB)
    r = r.select(
        F.col("country_clean").alias("country"), F.col("entity_id").alias("id"), (F.col("source") == "S1").alias("is_s1"), F.when(F.col("source") == "S3", 1).otherwise(0).alias("src"), T.feature_name(name, web).alias("name"),
        T.joined(T.address_words("address_clean")).alias("addr"), (c("address_clean") == "").alias("no_addr"), T.not_empty(F.regexp_replace(c("address_pin"), "[^0-9]", "")).alias("pin"), T.non_ascii(raw).alias("odd"), web.alias("web"),
        T.legal_words(c("name_translit"), c("name_core")).alias("legal"), *[T.not_empty(F.lower(F.trim(c(x)))).alias(x) for x in ("name_primary", "name_alias", "street_name", "landmark")], *[T.not_empty(T.slot(x)).alias(x) for x in SLOTS],
    )
    r = stored(r, "feature-text")
    w, a = T.words("name"), T.words("addr")
    r = step(r, nw=w, pw=T.phonetic_words("name"), aw=a, compact=F.replace(F.col("name"), F.lit(" "), F.lit("")))
    r = step(
        r, no_addr=F.col("no_addr") | (F.col("addr") == ""), grams=T.word_trigrams(F.col("nw")), nums=F.array_distinct(F.filter("aw", T.is_digits)), first_num=T.not_empty(T.first_number("addr")),
        phon=T.joined("pw", ""), name_nums=T.not_empty(T.joined(F.array_sort(F.array_distinct(F.filter("nw", T.is_digits))))), first=T.not_empty(F.coalesce(F.get("nw", F.lit(0)), F.lit(""))),
        initials=F.when(F.size("nw") >= 2, T.joined(F.transform("nw", lambda x: F.substr(x, F.lit(1), F.lit(1))), "")).otherwise(""), addr_sorted=T.joined(F.array_sort(F.array_distinct("aw"))),
    )
    r = stored(r, "feature-words")
    r = stored(_weighted(r, {"nw": "nv", "pw": "pv", "aw": "av", "grams": "gv", "nums": "mv"}), "feature-weighted")
    counts = F.transform("gv", lambda x: F.struct(x.token.alias("token"), (x.w * (1 + F.ln(F.size(F.filter("grams", lambda g: g == x.token)).cast("double")))).alias("w")))
    r = step(r, gv=counts)
    char = lambda t, i: F.ascii(F.substr(t, F.lit(i), F.lit(1))).cast("long")
    # three characters of 21 bits each are one number, a third of the bytes of their text in an array
    r = r.withColumn("gv", F.transform("gv", lambda x: F.struct(F.shiftleft(char(x.token, 1), 42).bitwiseOR(F.shiftleft(char(x.token, 2), 21)).bitwiseOR(char(x.token, 3)).alias("token"), x.w.alias("w"))))
    noise = noise_words(r)
    r = r.join(F.broadcast(noise), "country", "left").withColumn("noise", F.coalesce("noise", F.array().cast("array<string>")))
    r = r.withColumn("noise", F.array_intersect("noise", "nw"))
    same = lambda key, name, side: F.count(F.when(side, 1)).over(W.partitionBy("country", key)).alias(name)
    s1, cand = F.col("is_s1"), ~F.col("is_s1")
    r = r.select("*", same("name", "s1_same_name", s1), same("name", "cand_same_name", cand), same("first", "s1_same_first", s1), same("addr", "s1_same_addr", s1 & ~F.col("no_addr")))
    return stored(r.drop("grams"), "feature-records")


def noise_words(r: DataFrame, least: int = 50, times: float = 3.0) -> DataFrame:
    """Words far more frequent in candidate names than in S1 names, per country as an array: country, noise."""
    n = r.groupBy("country").agg(F.greatest(F.count_if(F.col("is_s1")), F.lit(1)).alias("n1"), F.greatest(F.count_if(~F.col("is_s1")), F.lit(1)).alias("n2"))
    d = r.select("country", "is_s1", F.explode(F.array_distinct("nw")).alias("token")).groupBy("country", "token").agg(F.count_if(F.col("is_s1")).alias("ds"), F.count_if(~F.col("is_s1")).alias("dc"))
    d = d.join(n, "country").where((F.col("dc") >= least) & (F.col("dc") / F.col("n2") >= times * (F.col("ds") + 1) / F.col("n1")))
    return d.groupBy("country").agg(F.collect_list("token").alias("noise"))


# ---------------------------------------------------------------- soft matching
_SOFT = ["soft", "me_a", "me_b", "cov_a", "cov_b", "unm_a", "unm_b", "noise_b", "idf_a", "idf_b"]


def soft(a: list, b: list, noise: set, jw) -> tuple:
    """Soft TF-IDF, Monge-Elkan, coverage and unmatched words of two lists of (word, weight); words match from ``THETA`` on."""
    if not len(a) or not len(b):
        return (None,) * len(_SOFT)
    exact_a, exact_b = {x for x, _ in a}, {y for y, _ in b}
    sim = [[1.0 if x == y else 0.0 if x in exact_b and y in exact_a else jw(x, y) for y, _ in b] for x, _ in a]
    norm_a, norm_b = (sum(w * w for _, w in side) ** 0.5 or 1.0 for side in (a, b))
    best_a, best_b = [max(row) for row in sim], [max(col) for col in zip(*sim, strict=True)]
    one = sum(w / norm_a * max((b[j][1] / norm_b * s for j, s in enumerate(sim[i]) if s >= THETA), default=0.0) for i, (_, w) in enumerate(a))
    two = sum(w / norm_b * max((a[i][1] / norm_a * sim[i][j] for i in range(len(a)) if sim[i][j] >= THETA), default=0.0) for j, (_, w) in enumerate(b))
    cover = lambda side, best: sum(w * s for (_, w), s in zip(side, best, strict=True) if s >= THETA) / sum(w for _, w in side)
    left_a = [w for (_, w), s in zip(a, best_a, strict=True) if s < THETA]
    left_b = [(x, w) for (x, w), s in zip(b, best_b, strict=True) if s < THETA]
    real = [w for x, w in left_b if x not in noise]
    return min((one + two) / 2, 1.0), sum(best_a) / len(a), sum(best_b) / len(b), cover(a, best_a), cover(b, best_b), float(len(left_a)), float(len(real)), float(len(left_b) - len(real)), max(left_a, default=0.0), max(real, default=0.0)


def _total(v: np.ndarray, exact: bool = False) -> np.ndarray:
    """Sums of rows from left to right; ``exact`` carries the error of each step along, as Python's ``sum`` does for its own floats and not for NumPy's.

    Ranks of equal pairs follow the last digits, so both are those of :func:`soft`, whose weights are NumPy's.
    """
    s, lost = np.zeros(len(v)), np.zeros(len(v))
    for x in v.T:
        t = s + x
        if exact:
            lost += np.where(np.abs(s) >= np.abs(x), (s - t) + x, (x - t) + s)
        s = t
    return s + lost


class _Lists:
    """Lists of (token, w) with the same tokens as the same numbers: the row, the number and the weight of each element."""

    def __init__(self, *columns: pa.Array):
        values = [c.flatten() for c in columns]
        tokens = pa.concat_arrays([pc.struct_field(v, "token") for v in values]).dictionary_encode()
        self.words, code = tokens.dictionary.to_pylist(), tokens.indices.to_numpy()
        self.n, self.size = len(columns[0]), max(len(self.words), 1)
        self.code = np.split(code.astype(np.int64), np.cumsum([len(v) for v in values])[:-1])
        self.w = [pc.struct_field(v, "w").to_numpy(zero_copy_only=False) for v in values]
        self.row = [np.repeat(np.arange(self.n), pc.fill_null(pc.list_value_length(c), 0).to_numpy()) for c in columns]

    def first(self, side: int, k: int, only: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The numbers and weights of the first k elements of each row that match ``only``; -1 and 0 behind them."""
        row, code, w = self.row[side], self.code[side], self.w[side]
        if only:
            ok = np.array([re.search(only, t) is not None for t in self.words], dtype=bool)[code]
            row, code, w = row[ok], code[ok], w[ok]
        place = np.arange(len(row)) - np.searchsorted(row, np.arange(self.n))[row]
        ok = place < k
        codes, weights = np.full((self.n, k), -1, dtype=np.int64), np.zeros((self.n, k))
        codes[row[ok], place[ok]], weights[row[ok], place[ok]] = code[ok], w[ok]
        return codes, weights


def soft_batch(ta: pa.Array, tb: pa.Array, noise: pa.Array | None, k: int, only: str | None = None) -> list[np.ndarray]:
    """:func:`soft` of the first k words of each row that match ``only``: the columns of ``_SOFT``, NaN where it has none.  Each pair of words is compared once."""
    lists = _Lists(ta, tb)
    (a, wa), (b, wb) = lists.first(0, k, only), lists.first(1, k, only)
    has_a, has_b = a >= 0, b >= 0
    both = has_a[:, :, None] & has_b[:, None, :]
    same = both & (a[:, :, None] == b[:, None, :])
    far = both & ~same & ~(same.any(2)[:, :, None] & same.any(1)[:, None, :])
    sim = same.astype(np.float64)
    which, pairs = pd.factorize((a[:, :, None] * lists.size + b[:, None, :])[far])
    if len(pairs):
        sim[far] = B.winkler([lists.words[i] for i in pairs // lists.size], [lists.words[i] for i in pairs % lists.size])[which]
    na, nb = has_a.sum(1), has_b.sum(1)
    norm = lambda w: np.array([x**0.5 or 1.0 for x in _total(w * w)])[:, None]
    ua, ub = wa / norm(wa), wb / norm(wb)
    near = both & (sim >= THETA)
    most = lambda v, where, axis: np.where(where, v, -np.inf).max(axis)
    else0 = lambda v: np.where(np.isinf(v), 0.0, v)
    one = _total(ua * else0(most(ub[:, None, :] * sim, near, 2)))
    two = _total(ub * else0(most(ua[:, :, None] * sim, near, 1)))
    best_a, best_b = else0(most(sim, both, 2)), else0(most(sim, both, 1))
    left_a, left_b = has_a & (best_a < THETA), has_b & (best_b < THETA)
    real = left_b.copy()
    if noise is not None and len(noise.flatten()):
        known = {t: i for i, t in enumerate(lists.words)}
        for i, words in enumerate(noise.to_pylist()):
            if words:
                real[i] &= ~np.isin(b[i], [known.get(t, -2) for t in words])
    with np.errstate(divide="ignore", invalid="ignore"):
        cover = lambda w, best: _total(np.where(best >= THETA, w * best, 0.0)) / _total(w)
        out = [
            np.minimum((one + two) / 2, 1.0), _total(best_a, True) / na, _total(best_b, True) / nb, cover(wa, best_a), cover(wb, best_b), left_a.sum(1).astype(np.float64), real.sum(1).astype(np.float64), (left_b & ~real).sum(1).astype(np.float64),
            else0(most(wa, left_a, 1)), else0(most(wb, real, 1)),
        ]
    none = (na == 0) | (nb == 0)
    return [np.where(none, np.nan, v) for v in out]


def _struct(columns: list[np.ndarray], names: list[str]) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(v, type=pa.float64(), from_pandas=True) for v in columns], names=names)


def soft_columns(side: str, k: int, only: str | None = None, noise: Column | None = None) -> Column:
    """:func:`soft_batch` of a side's arrays; without ``only`` no more than k words of each leave the JVM."""

    @arrow_udf(StructType([StructField(n, DoubleType()) for n in _SOFT]))
    def match(ta: pa.Array, tb: pa.Array, quiet: pa.Array) -> pa.Array:
        return _struct(soft_batch(ta, tb, quiet, k, only), _SOFT)

    cut = lambda c: F.col(c) if only else F.slice(c, 1, k)
    return match(cut(f"a_{side}"), cut(f"b_{side}"), F.array().cast("array<string>") if noise is None else noise)


_OVERLAP = ["cos", "n", "sum", "most", "left_a", "left_b"]


def overlap_batch(a: pa.Array, b: pa.Array) -> list[np.ndarray]:
    """Of two lists of distinct (token, w): their cosine; number, sum and greatest weight of a's tokens that b has; the greatest weights of a's and of b's other tokens."""
    x = _Lists(a, b)
    n, (ra, rb), (wa, wb) = x.n, x.row, x.w
    ka, kb = (r * x.size + c for r, c in zip(x.row, x.code, strict=True))
    order = np.argsort(kb, kind="stable")
    at = order[np.minimum(np.searchsorted(kb[order], ka), max(len(kb) - 1, 0))] if len(kb) else np.zeros(len(ka), dtype=np.int64)
    hit = kb[at] == ka if len(kb) else np.zeros(len(ka), dtype=bool)
    found = np.zeros(len(kb), dtype=bool)
    found[at[hit]] = True
    add = lambda r, w: np.bincount(r, weights=w, minlength=n)

    def most(r: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.full(n, -np.inf)
        np.maximum.at(out, r, w)
        return np.where(np.isinf(out), 0.0, out)

    dot, norm = add(ra[hit], wa[hit] * wb[at[hit]]), np.sqrt(add(ra, wa * wa)) * np.sqrt(add(rb, wb * wb))
    cos = np.where(norm > 0, dot / np.where(norm > 0, norm, 1.0), 0.0)
    return [cos, add(ra[hit], np.ones(int(hit.sum()))), add(ra[hit], wa[hit]), most(ra[hit], wa[hit]), most(ra[~hit], wa[~hit]), most(rb[~found], wb[~found])]


@arrow_udf(StructType([StructField(n, DoubleType()) for n in _OVERLAP]))
def overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    return _struct(overlap_batch(a, b), _OVERLAP)


# ---------------------------------------------------------------- small pieces
def _names(v: Column) -> Column:
    return v.getField("token")


def _sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x.w)


def _lev(a: Column, b: Column) -> Column:
    return F.when((F.length(a) == 0) & (F.length(b) == 0), 1.0).otherwise(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def _eq(a: Column, b: Column) -> Column:
    return (a == b).cast("double")


def _flag(c: Column) -> Column:
    return c.cast("double")


def _number_close(a: Column, b: Column) -> tuple[Column, Column]:
    """Best Levenshtein similarity and best closeness over all pairs of numbers."""
    val = lambda x: F.substr(x, F.greatest(F.length(x) - 8, F.lit(1))).cast("double")
    lev = F.array_max(F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: _lev(x, y)))))
    near = F.array_max(F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.when(x == y, 1.0).otherwise(1 - F.abs(val(x) - val(y)) / F.greatest(val(x), val(y), F.lit(1.0)))))))
    return lev, near


def _read(columns: list[Column], pool) -> list[str]:
    """Which columns of ``pool`` the expressions read; one named too many costs a column, one too few is an error of Spark's."""
    text = " ".join(str(c) for c in columns)
    return [c for c in pool if re.search(rf"(?<!\w){re.escape(c)}(?!\w)", text)]


def record_ids(records: DataFrame) -> DataFrame:
    """country and id of ``feature_records``, for features that read nothing else of the records."""
    r = records.groupBy("entity_id").agg(F.min(F.struct("source", "country_clean")).alias("first"))
    return r.select(F.col("first.country_clean").alias("country"), F.col("entity_id").alias("id"))


def pair_features(pairs: DataFrame, records: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``pairs(country, s1, cand, score, n_keys, evidence_mask, n_evidence, cand_rank, p_block)`` with the 158 features.

    ``records`` are ``feature_records``; columns of the blocking stage that are absent are null.  With ``names`` there are only those
    features, for the same pairs, and similarities, windows and columns of records that none of them reads are not made.
    """
    names = FEATURES if names is None else list(names)
    block = {"score": "double", "n_keys": "long", "evidence_mask": "long", "n_evidence": "long", "cand_rank": "long", "p_block": "double"}
    p = pairs.select("country", "s1", "cand", *[(F.col(c).try_cast(t) if c in pairs.columns else F.lit(None).cast(t)).alias(c) for c, t in block.items()])
    reads = CONTEXT_READS
    if not any(n in CONTEXT_FEATURES for n in names if not n.startswith("sib_")) and any(n.startswith("sib_") for n in names) and p.where("p_block IS NULL").isEmpty():
        reads = reads | {"sib_": tuple(d for d in reads["sib_"] if d not in _COMBO)}  # the combined score stands in for a p_block that is null, and none is
    want = {*names, *(d for n in names for start, ds in reads.items() if n.startswith(start) for d in ds)}
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    sort = lambda c: S.token_sort_udf(a(c), b(c))
    forms = ("name", "name_primary", "name_alias")
    each = [T.not_empty(k(c)) for k in (a, b) for c in forms]
    similar = {
        "ns": soft_columns("nv", NAME_WORDS, noise=b("noise")), "ps": soft_columns("pv", NAME_WORDS), "as_": soft_columns("av", ADDRESS_WORDS, "^[^0-9]{2,}$"),
        "jw": S.jaro_winkler_udf(a("name"), b("name")), "tsort": sort("name"), "tset": S.token_set_udf(a("name"), b("name")), "part": S.partial_udf(a("compact"), b("compact")),
        "atset": S.token_set_udf(a("addr"), b("addr")), "stset": S.token_set_udf(a("street_name"), b("street_name")), "sjw": S.jaro_winkler_udf(a("street_name"), b("street_name")), "lset": S.token_set_udf(a("landmark"), b("landmark")),
        "n_o": overlap(a("nv"), b("nv")), "p_o": overlap(a("pv"), b("pv")), "a_o": overlap(a("av"), b("av")), "g_o": overlap(a("gv"), b("gv")), "alias_t": S.best_udf("token_set")(*each), "alias_j": S.best_udf("winkler")(*each),
    }
    col = F.col
    ok, ok_a = (F.length(a("compact")) > 0) & (F.length(b("compact")) > 0), ~a("no_addr") & ~b("no_addr")
    ok_p = (a("phon") != "") & (b("phon") != "")
    name, addr, phon = (lambda v: F.when(ok, v)), (lambda v: F.when(ok_a, v)), (lambda v: F.when(ok_p, v))
    shared = {"m_n": F.size(F.array_intersect("a_nums", "b_nums"))}
    na, nb, ni = F.size("a_nv"), F.size("b_nv"), col("n_o.n")
    aa, ab, ai = F.size("a_av"), F.size("b_av"), col("a_o.n")
    ma, mb, mi = F.size("a_nums"), F.size("b_nums"), col("m_n")
    pa_, pb = F.size("a_pv"), F.size("b_pv")
    has_num = (ma > 0) & (mb > 0)
    tops = lambda c: F.slice(_names(col(c)), 1, NUMBERS)
    num_lev, num_close = _number_close(tops("a_mv"), tops("b_mv"))
    first = a("first_num").isNotNull() & b("first_num").isNotNull()
    h_lev, h_close = _number_close(F.array(a("first_num")), F.array(b("first_num")))
    la, lb = F.size("a_legal") > 0, F.size("b_legal") > 0
    alias = a("name_alias").isNotNull() | b("name_alias").isNotNull()
    every = lambda k: F.filter(F.array(*[T.not_empty(F.col(f"{k}_{c}")) for c in forms]), lambda t: t.isNotNull())
    both = {c: a(c).isNotNull() & b(c).isNotNull() for c in SLOTS}
    count = lambda cs, f: sum((F.coalesce(f(c).cast("int"), F.lit(0)) for c in cs), F.lit(0)).cast("double")
    same_slot = lambda c: both[c] & (a(c) == b(c))
    wa, wb = _sum(col("a_nv")), _sum(col("b_nv"))
    inside = lambda v, words: _sum(F.filter(v, lambda t: F.array_contains(words, t.token)))
    single = ((na == 1) & (nb >= 2)) | ((nb == 1) & (na >= 2))
    f = {
        "name_lev": name(_lev(a("name"), b("name"))), "name_jw": name(col("jw")), "name_token_sort": name(col("tsort")), "name_token_set": name(col("tset")), "name_partial_compact": name(col("part")), "name_compact_lev": name(_lev(a("compact"), b("compact"))),
        "name_char_tfidf_cos": name(col("g_o.cos")), "name_word_tfidf_cos": name(col("n_o.cos")), "name_jaccard": name(T.ratio(ni, na + nb - ni)), "name_overlap": name(T.ratio(ni, F.least(na, nb))),
        "name_idf_shared_max": name(col("n_o.most")), "name_idf_unshared_s1": name(col("n_o.left_a")), "name_idf_unshared_cand": name(col("n_o.left_b")), "name_phon_lev": phon(name(_lev(a("phon"), b("phon")))), "name_phon_jaccard": phon(name(T.ratio(col("p_o.n"), pa_ + pb - col("p_o.n")))),
        "name_first_tok_eq": name(_eq(a("first"), b("first"))), "name_len_ratio": name(T.ratio(F.least(F.length(a("compact")), F.length(b("compact"))), F.greatest(F.length(a("compact")), F.length(b("compact"))))), "name_script_mismatch": _flag(a("odd") != b("odd")), "name_is_web": _flag(a("web") | b("web")),
        "name_soft_tfidf": name(col("ns.soft")), "name_me_s1": name(col("ns.me_a")), "name_me_cand": name(col("ns.me_b")), "name_softcov_s1": name(col("ns.cov_a")), "name_softcov_cand": name(col("ns.cov_b")), "name_unm_s1": name(col("ns.unm_a")), "name_unm_cand_real": name(col("ns.unm_b")),
        "name_unm_cand_noise": name(col("ns.noise_b")), "name_unm_idf_s1": name(col("ns.idf_a")), "name_unm_idf_cand": name(col("ns.idf_b")), "name_set_eq": name(_flag((ni == na) & (na == nb))), "name_denoised_eq": name(_flag((col("ns.unm_a") == 0) & (col("ns.unm_b") == 0))),
        "name_rarity_s1": T.ratio(wa, na), "name_ntok_s1": na.cast("double"), "name_ntok_cand": nb.cast("double"), "phon_soft_tfidf": phon(col("ps.soft")), "phon_softcov_s1": phon(col("ps.cov_a")), "phon_softcov_cand": phon(col("ps.cov_b")),
        "name_idf_shared_sum": name(col("n_o.sum")), "name_rarity_cand": T.ratio(wb, nb), "name_num_eq": _eq(a("name_nums"), b("name_nums")), "name_num_one_side": name(_flag(a("name_nums").isNull() != b("name_nums").isNull())),
        "name_abbrev": name(_flag(single & (T.abbreviates(a("compact"), b("initials")) | T.abbreviates(b("compact"), a("initials"))))),
        "alias_any": _flag(alias), "alias_best_tset": F.when(alias, col("alias_t")), "alias_best_jw": F.when(alias, col("alias_j")), "alias_exact": F.when(alias, _flag(F.arrays_overlap(every("a"), every("b")))), "alias_gain": F.when(alias, col("alias_t") - name(col("tset"))),
        "lf_s1": _flag(la), "lf_cand": _flag(lb), "lf_eq": F.when(la & lb, _eq(a("legal"), b("legal"))), "lf_jacc": F.when(la & lb, F.size(F.array_intersect("a_legal", "b_legal")) / F.size(F.array_union("a_legal", "b_legal"))),
        "addr_missing_s1": _flag(a("no_addr")), "addr_missing_cand": _flag(b("no_addr")), "addr_token_set": addr(col("atset")), "addr_sorted_lev": addr(_lev(a("addr_sorted"), b("addr_sorted"))), "addr_word_tfidf_cos": addr(col("a_o.cos")), "addr_jaccard": addr(T.ratio(ai, aa + ab - ai)),
        "addr_overlap": addr(T.ratio(ai, F.least(aa, ab))), "addr_idf_shared_max": addr(col("a_o.most")), "addr_idf_unshared_cand": addr(col("a_o.left_b")), "addr_len_ratio": addr(T.ratio(F.least(aa, ab), F.greatest(aa, ab))), "addr_num_jaccard": addr(F.when(has_num, T.ratio(mi, ma + mb - mi))),
        "addr_num_overlap": addr(F.when(has_num, T.ratio(mi, F.least(ma, mb)))), "addr_first_num_eq": addr(_eq(a("first_num"), b("first_num"))), "pin_eq": _eq(a("pin"), b("pin")), "pin_prefix_eq": _eq(F.substr(a("pin"), F.lit(1), F.lit(3)), F.substr(b("pin"), F.lit(1), F.lit(3))),
        "addr_soft_tfidf": addr(col("as_.soft")), "addr_softcov_s1": addr(col("as_.cov_a")), "addr_softcov_cand": addr(col("as_.cov_b")), "addr_me_cand": addr(col("as_.me_b")), "addr_unm_idf_cand": addr(col("as_.idf_b")), "addr_num_best_lev": addr(num_lev), "addr_num_best_close": addr(num_close),
        "addr_hnum_lev": addr(F.when(first, h_lev)), "addr_hnum_close": addr(F.when(first, h_close)), "addr_street_same_num_diff": addr(F.when(first & col("as_.cov_b").isNotNull(), _flag((col("as_.cov_b") >= 0.8) & (a("first_num") != b("first_num"))))), "pin_lev": F.when(a("pin").isNotNull() & b("pin").isNotNull(), _lev(a("pin"), b("pin"))),
        "addr_exact_eq": addr(_eq(a("addr"), b("addr"))), "addr_idf_shared_sum": addr(col("a_o.sum")), "f_house_eq": _eq(a("house_number"), b("house_number")), "f_unit_eq": _eq(a("unit_number"), b("unit_number")), "f_subloc_eq": T.ratio(count(SUBLOC, same_slot), count(SUBLOC, lambda c: both[c])),
        "fld_n_both": count(SLOTS, lambda c: both[c]), "fld_n_eq": count(SLOTS, same_slot), "fld_n_conflict": count(SLOTS, lambda c: both[c]) - count(SLOTS, same_slot), "f_street_tset": col("stset"), "f_street_jw": col("sjw"), "f_landmark_tset": col("lset"),
        "x_s1name_in_candaddr": F.when(ok & ~b("no_addr"), T.ratio(inside(col("a_nv"), b("aw")), wa)), "x_candname_in_s1addr": F.when(ok & ~a("no_addr"), T.ratio(inside(col("b_nv"), a("aw")), wb)),
        "noaddr_name_soft": F.when(b("no_addr"), name(col("ns.soft"))), "noaddr_name_eq": F.when(b("no_addr") & ok, _eq(a("name"), b("name"))),
        "s1_name_dup": name(a("s1_same_name").cast("double")), "cand_name_ambig": name(b("s1_same_name").cast("double")), "cand_fw_s1df": name(F.when(b("first").isNotNull(), b("s1_same_first").cast("double"))), "name_cd_cnt_cand": name(b("cand_same_name").cast("double")),
        "cand_addr_s1_cnt": F.when(~b("no_addr"), b("s1_same_addr").cast("double")), "s1_addr_dup": F.when(~a("no_addr"), a("s1_same_addr").cast("double")), "cand_src": b("src").cast("double"),
        "blk_score": col("score"), "blk_n_keys": col("n_keys").cast("double"), "blk_n_evidence": col("n_evidence").cast("double"), "blk_cand_rank": col("cand_rank").cast("double"), "blk_p_block": col("p_block"),
        **{f"evb_{n}": F.expr(f"cast(getbit(evidence_mask, {i}) as double)") for i, n in enumerate(FAMILY)},
    }
    context = [n for n in names if n not in f]
    f = {n: v for n, v in f.items() if n in want}
    keep = {"__addr": F.when(~b("no_addr"), b("addr")), "__name": b("name"), "__s1_name": a("name"), "__pin": b("pin"), "__ok": ok}
    out = [*[v.alias(n) for n, v in keep.items() if n in want], *[v.alias(n) for n, v in f.items()]]
    shared = {n: shared[n] for n in _read(out, shared)}
    similar = {n: similar[n] for n in _read([*out, *shared.values()], similar)}
    read = _read([*out, *shared.values(), *similar.values()], [f"{k}_{c}" for k in "ab" for c in records.columns])
    side = lambda k, me: records.select("country", F.col("id").alias(me), *[F.col(c).alias(f"{k}_{c}") for c in records.columns if f"{k}_{c}" in read])
    x = p.join(side("a", "s1"), ["country", "s1"])
    x = (spread(x, pairs, "country", "cand") if similar else x).join(side("b", "cand"), ["country", "cand"])
    if similar:
        used = [*p.columns, *_read([*out, *shared.values()], read)]
        x = step(x.select(*used, *[v.alias(n) for n, v in similar.items()]))
    x = (step(x, **shared) if shared else x).select("country", "s1", "cand", *out)
    return (with_context(stored(x, "pairs-features")) if context else x).select("country", "s1", "cand", *names)


#: What the features of ``with_context`` read of the others, by the start of their names.
_COMBO = ("name_soft_tfidf", "addr_soft_tfidf")
CONTEXT_READS = {
    "name_gap": ("name_char_tfidf_cos",), "addr_gap": ("addr_word_tfidf_cos",), "pb_": ("blk_p_block", "cand_src"), "s1_pb": ("blk_p_block",), "s1_n_strong": ("blk_p_block",), "cand_pb": ("blk_p_block",), "mutual_best_pb": ("blk_p_block",),
    "nsoft": ("name_soft_tfidf",), "asoft": ("addr_soft_tfidf",), "combo": _COMBO, "mutual_best_combo": _COMBO, "sib_": ("blk_p_block", *_COMBO, "__addr", "__name", "__pin"), "s1_n_cand_same_name": ("__name", "__ok"), "cand_n_s1_same_name": ("__s1_name", "__ok"),
}


def with_context(x: DataFrame) -> DataFrame:
    """Add the features of a pair among its competitors, and of the S1's best other candidate.

    A feature that ``CONTEXT_READS`` names and ``x`` has not is one that no wanted feature reads: Spark leaves out what is made of it.
    """
    s, c, n = ["s1"], ["cand"], F.col
    kinds = {"__ok": "boolean", "__addr": "string", "__name": "string", "__s1_name": "string", "__pin": "string"}
    x = x.select("*", *[F.lit(None).cast(kinds.get(m, "double")).alias(m) for m in dict.fromkeys(m for r in CONTEXT_READS.values() for m in r) if m not in x.columns])
    x = x.withColumn("combo", F.coalesce((n("name_soft_tfidf") + n("addr_soft_tfidf")) / 2, "name_soft_tfidf", "addr_soft_tfidf"))
    w = lambda *g: W.partitionBy(*g)
    p0, one = F.coalesce("blk_p_block", F.lit(0.0)), F.count(F.lit(1))

    def ranked(x: DataFrame, g: list[str], k: str, tie: str) -> DataFrame:
        for v, name in (("name_soft_tfidf", "ns"), ("addr_soft_tfidf", "as"), ("combo", "co"), ("blk_p_block", "pb")):
            x = rank_lead(x, g, v, tie, f"{name}{k}_rank", f"{name}{k}_lead")
        return x

    # all windows over an S1 first, then all over a candidate: rows are dealt twice
    x = rank_lead(ranked(x, s, "s", "cand"), ["s1", "cand_src"], "blk_p_block", "cand", "src_rank", "src_lead")
    # the S1's best other candidate by p_block, or by the combined score where that is unknown
    v = F.coalesce("blk_p_block", "combo", F.lit(-1.0))
    me = W.partitionBy("s1").orderBy(v.desc(), "cand")
    whole = me.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    row = F.struct(v.alias("v"), "__name", "__addr", "__pin")
    x = x.withColumn("__r", F.row_number().over(me)).withColumn("__two", F.array(F.first(row).over(whole), F.nth_value(row, 2).over(whole)))
    x = x.withColumn("__o", F.when(n("__r") == 1, F.get("__two", F.lit(1))).otherwise(F.get("__two", F.lit(0))))
    x = x.withColumn("sib_anchor_pb", F.when(n("__o.v") >= 0, n("__o.v"))).withColumn("sib_name_tset", S.token_set_udf(F.col("__name"), F.col("__o.__name"))).withColumn("sib_addr_tset", S.token_set_udf(F.col("__addr"), F.col("__o.__addr"))).withColumn("sib_pin_eq", _eq(n("__pin"), n("__o.__pin")))
    x = x.select(
        "*", one.over(w("s1")).cast("double").alias("s1_n_cand"), *[gap(v, "s1").alias(f"{o}_gap_s1") for v, o in (("name_char_tfidf_cos", "name"), ("addr_word_tfidf_cos", "addr"))],
        F.sum(p0).over(w("s1")).alias("s1_pb_sum"), F.count_if(p0 >= 0.5).over(w("s1")).cast("double").alias("s1_n_strong"), F.when(n("__ok"), one.over(w("s1", "__name")) - 1.0).alias("s1_n_cand_same_name"),
    )
    x = ranked(x, c, "c", "s1")
    best = lambda a, b, v: F.when(n(v).isNotNull(), ((n(a) == 0) & (n(b) == 0)).cast("double"))
    return x.select(
        "*", one.over(w("cand")).cast("double").alias("cand_n_s1"), *[gap(v, "cand").alias(f"{o}_gap_cand") for v, o in (("name_char_tfidf_cos", "name"), ("addr_word_tfidf_cos", "addr"))], F.sum(p0).over(w("cand")).alias("cand_pb_sum"),
        F.when(n("__ok"), one.over(w("cand", "__s1_name")) - 1.0).alias("cand_n_s1_same_name"), n("pbs_rank").alias("pb_rank_s1"), n("pbs_lead").alias("pb_vs_other_s1"), n("pbc_lead").alias("pb_vs_other_cand"),
        n("nss_rank").alias("nsoft_rank_s1"), n("nss_lead").alias("nsoft_vs_other_s1"), n("nsc_lead").alias("nsoft_vs_other_cand"), n("ass_lead").alias("asoft_vs_other_s1"), n("asc_lead").alias("asoft_vs_other_cand"), best("pbs_rank", "pbc_rank", "blk_p_block").alias("mutual_best_pb"),
        n("cos_rank").alias("combo_rank_s1"), n("cos_lead").alias("combo_vs_other_s1"), n("coc_lead").alias("combo_vs_other_cand"), best("cos_rank", "coc_rank", "combo").alias("mutual_best_combo"), n("src_rank").alias("pb_rank_s1_src"),
    )


FEATURES = (
    "name_lev name_jw name_token_sort name_token_set name_partial_compact name_compact_lev name_char_tfidf_cos name_word_tfidf_cos name_jaccard name_overlap name_idf_shared_max name_idf_unshared_s1 name_idf_unshared_cand name_phon_lev name_phon_jaccard name_first_tok_eq name_len_ratio "
    "name_script_mismatch name_is_web name_soft_tfidf name_me_s1 name_me_cand name_softcov_s1 name_softcov_cand name_unm_s1 name_unm_cand_real name_unm_cand_noise name_unm_idf_s1 name_unm_idf_cand name_set_eq name_denoised_eq name_rarity_s1 name_ntok_s1 name_ntok_cand phon_soft_tfidf "
    "phon_softcov_s1 phon_softcov_cand name_idf_shared_sum name_rarity_cand name_num_eq name_num_one_side name_abbrev alias_any alias_best_tset alias_best_jw alias_exact alias_gain lf_s1 lf_cand lf_eq lf_jacc addr_missing_s1 addr_missing_cand addr_token_set addr_sorted_lev addr_word_tfidf_cos "
    "addr_jaccard addr_overlap addr_idf_shared_max addr_idf_unshared_cand addr_len_ratio addr_num_jaccard addr_num_overlap addr_first_num_eq pin_eq pin_prefix_eq addr_soft_tfidf addr_softcov_s1 addr_softcov_cand addr_me_cand addr_unm_idf_cand addr_num_best_lev addr_num_best_close addr_hnum_lev "
    "addr_hnum_close addr_street_same_num_diff pin_lev addr_exact_eq addr_idf_shared_sum f_house_eq f_unit_eq f_subloc_eq fld_n_both fld_n_eq fld_n_conflict f_street_tset f_street_jw f_landmark_tset x_s1name_in_candaddr x_candname_in_s1addr noaddr_name_soft noaddr_name_eq s1_n_cand cand_n_s1 "
    "name_gap_cand addr_gap_cand name_gap_s1 addr_gap_s1 s1_name_dup cand_name_ambig pb_rank_s1 pb_vs_other_s1 pb_vs_other_cand s1_pb_sum s1_n_strong cand_pb_sum nsoft_rank_s1 nsoft_vs_other_s1 nsoft_vs_other_cand asoft_vs_other_s1 asoft_vs_other_cand mutual_best_pb combo combo_rank_s1 "
    "combo_vs_other_s1 combo_vs_other_cand mutual_best_combo s1_n_cand_same_name cand_n_s1_same_name cand_fw_s1df name_cd_cnt_cand cand_addr_s1_cnt s1_addr_dup cand_src pb_rank_s1_src sib_anchor_pb sib_name_tset sib_addr_tset sib_pin_eq blk_score blk_n_keys blk_n_evidence blk_cand_rank blk_p_block"
).split() + [f"evb_{f}" for f in FAMILY]
#: Features that ``with_context`` makes.
CONTEXT_FEATURES = {
    *FEATURES[FEATURES.index("s1_n_cand") : FEATURES.index("sib_anchor_pb")], *[f for f in FEATURES if f.startswith("sib_")],
} - {"s1_name_dup", "cand_name_ambig", "cand_fw_s1df", "name_cd_cnt_cand", "cand_addr_s1_cnt", "s1_addr_dup", "cand_src"}
