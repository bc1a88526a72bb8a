"""Cleaning, phonetics, and similarity of names and addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from entres.functions import strings
from entres.sources import fixtures

#: Record pairs in the same country whose names share their first word.
_CAND = "SELECT a.entity_id AS s1, b.entity_id AS cand, regexp_replace(lower(a.business_name), '[^a-z0-9 ]', ''@G) AS na, regexp_replace(lower(b.business_name), '[^a-z0-9 ]', ''@G) AS nb, regexp_replace(lower(a.business_address), '[^a-z0-9 ]', ''@G) AS aa, regexp_replace(lower(b.business_address), '[^a-z0-9 ]', ''@G) AS ab FROM recs a JOIN recs b ON a.country=b.country AND split_part(a.business_name,' ',1) = split_part(b.business_name,' ',1) WHERE a.source='S1' AND b.source<>'S1'"


def _g(sql: str) -> tuple[str, str]:
    """The two dialects of a statement: @G marks where DuckDB needs the flag for all matches."""
    return sql.replace("@G", ""), sql.replace("@G", ", 'g'")


TWO = {
    "x6_truncate": _g("SELECT DISTINCT token, substr(token, 1, 3) AS cut FROM tok"),
    "x15_ngrams": _g("SELECT entity_id, count(*) AS n FROM gram GROUP BY entity_id"),
}
SQL = {}
TWO |= {
    "m1_levenshtein": _g(f"WITH c AS ({_CAND}) SELECT s1, cand, round(1 - levenshtein(na, nb)/cast(greatest(length(na), length(nb), 1) AS double), 9) AS sim FROM c"),
}

#: Records of one country and name are a class on either side; its smallest id stands for it, and ``m6_name_classes`` has the members.
#: Pairs are all classes of a country with the same first word, as for ``_CAND``; words are counted over all records.
_CLASSES = """cls AS (SELECT country, business_name, CASE WHEN source='S1' THEN 1 ELSE 0 END AS side, min(entity_id) AS rep, count(*) AS members FROM recs GROUP BY country, business_name, CASE WHEN source='S1' THEN 1 ELSE 0 END)"""
_SHARED = f"""k AS (SELECT country, token, count(*) AS df FROM tok GROUP BY country, token), {_CLASSES},
 ct AS (SELECT cls.country, rep, side, members, split_part(business_name,' ',1) AS head, token FROM cls JOIN tok ON entity_id=rep AND tok.country=cls.country),
 sh AS (SELECT a.country, a.rep AS s1, b.rep AS cand, a.members AS s1_members, b.members AS cand_members, a.token FROM ct a JOIN ct b ON a.country=b.country AND a.head=b.head AND a.token=b.token WHERE a.side=1 AND b.side=0)"""
_IDF = """n AS (SELECT country, count(*) AS n FROM recs GROUP BY country),
 d AS (SELECT k.country, token, (ln((1+n)/cast(1+df AS double))+1)/(ln(1+n)+1) AS w FROM k JOIN n ON n.country=k.country)"""

SQL |= {
    "m6_name_classes": f"WITH {_CLASSES} SELECT entity_id, rep, members FROM recs JOIN cls ON cls.country=recs.country AND cls.business_name=recs.business_name AND side=CASE WHEN source='S1' THEN 1 ELSE 0 END",
    "m7_jaccard": f"""WITH {_SHARED}, l AS (SELECT rep, count(*) AS n FROM ct GROUP BY rep), i AS (SELECT s1, cand, max(s1_members) AS s1_members, max(cand_members) AS cand_members, count(*) AS shared FROM sh GROUP BY s1, cand)
 SELECT s1, cand, s1_members, cand_members, round(shared/cast(x.n+y.n-shared AS double), 9) AS jaccard, round(shared/cast(least(x.n, y.n) AS double), 9) AS overlap FROM i JOIN l x ON x.rep=s1 JOIN l y ON y.rep=cand""",
    "m6_tfidf_cosine": f"""WITH {_SHARED}, {_IDF}, l AS (SELECT rep, sqrt(sum(w*w)) AS len FROM ct JOIN d ON ct.country=d.country AND ct.token=d.token GROUP BY rep),
 dot AS (SELECT s1, cand, max(s1_members) AS s1_members, max(cand_members) AS cand_members, sum(w*w) AS dot FROM sh JOIN d ON d.country=sh.country AND d.token=sh.token GROUP BY s1, cand)
 SELECT s1, cand, s1_members, cand_members, round(dot/(x.len*y.len), 7) AS cosine FROM dot JOIN l x ON x.rep=s1 JOIN l y ON y.rep=cand""",
    "m8_shared_idf": f"""WITH {_SHARED}, {_IDF} SELECT s1, cand, max(s1_members) AS s1_members, max(cand_members) AS cand_members, round(max(w), 9) AS shared_max, round(sum(w), 9) AS shared_sum FROM sh JOIN d ON d.country=sh.country AND d.token=sh.token GROUP BY s1, cand""",
}


def _similarity(column, udf):
    def query(spark, sf_dir):
        pairs = fixtures.run(spark, sf_dir, _g(f"WITH c AS ({_CAND}) SELECT s1, cand, na, nb FROM c")[0])
        return pairs.select("s1", "cand", F.round(udf("na", "nb"), 6).alias(column))

    return query


FUNCTIONS = {
    "m2_jaro_winkler": (_similarity("jw", strings.jaro_winkler_udf), _g(f"WITH c AS ({_CAND}) SELECT s1, cand, round(jaro_winkler_similarity(na, nb), 6) AS jw FROM c")[1]),
    "m3_token_sort": (_similarity("sim", strings.token_sort_udf), None),
    "m4_token_set": (_similarity("sim", strings.token_set_udf), None),
    "m5_partial": (_similarity("sim", strings.partial_udf), None),
}
