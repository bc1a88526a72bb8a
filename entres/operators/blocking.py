"""The capped key index and pair generation on raw words, as SQL that both engines read; ``index`` has the whole operator.

Keys are kept when both sides have
them and their candidate side is no larger than the block cap; a capped key never reaches the pair
join, which is what bounds the join on skewed keys.
"""

_NAME = "lower(business_name)"
_ADDR = "lower(business_address)"
_FLAT = f"replace({_NAME}, ' ', '')"
#: Families of the pair index: (bit, S1 cap, candidate cap, weight, key rows).
_FAMILIES = [
    (0, 30, 3000, 2.0, f"SELECT country, source, entity_id, {_FLAT} AS key FROM recs WHERE {_FLAT} <> ''"),
    (1, 25, 3000, 1.0, f"SELECT country, source, entity_id, substr({_FLAT}, 1, 10) AS key FROM recs WHERE length({_FLAT}) > 10"),
    (2, 15, 1500, 0.8, "SELECT country, source, entity_id, token AS key FROM tok WHERE length(token) >= 3"),
    (3, 20, 1000, 2.0, f"SELECT country, source, entity_id, {_ADDR} AS key FROM recs WHERE {_ADDR} <> ''"),
    (4, 40, 400, 1.0, "SELECT t.country, t.source, t.entity_id, concat(t.token, '|', a.token) AS key FROM tok t JOIN atok a ON t.entity_id = a.entity_id WHERE length(t.token) >= 6 AND length(a.token) >= 6"),
]
_INDEX = "post AS (" + " UNION ALL ".join(f"SELECT DISTINCT {b} AS family, {s} AS cap_s, {c} AS cap_c, cast({w} AS double) AS fw, country, source, entity_id, key FROM ({q}) q{b}" for b, s, c, w, q in _FAMILIES) + """),
 sizes AS (SELECT country, sum(CASE WHEN source='S1' THEN 1 ELSE 0 END) AS n1, sum(CASE WHEN source<>'S1' THEN 1 ELSE 0 END) AS n2 FROM recs GROUP BY country),
 counted AS (SELECT family, country, key, max(cap_s) AS cap_s, max(cap_c) AS cap_c, max(fw) AS fw, sum(CASE WHEN source='S1' THEN 1 ELSE 0 END) AS kn1, sum(CASE WHEN source<>'S1' THEN 1 ELSE 0 END) AS kn2 FROM post GROUP BY family, country, key),
 kept AS (SELECT * FROM counted WHERE kn1 >= 1 AND kn2 >= 1 AND kn1 <= cap_s AND kn2 <= greatest(cap_c, least(10*cap_c, floor(cap_c*cap_s/greatest(kn1,1))))),
 weighed AS (SELECT k.*, greatest(1 - ln(greatest(greatest(kn1, kn2*n1/cast(n2 AS double)), 1))/ln(greatest(n1, 3)), 0) * fw AS w FROM kept k JOIN sizes s ON k.country = s.country)"""
_PAIRGEN = _INDEX + """, gen AS (SELECT a.entity_id AS s1, b.entity_id AS cand, sum(w) AS score, count(*) AS n_keys, bit_or(cast(1 AS bigint) << a.family) AS mask
 FROM weighed k JOIN post a ON a.family=k.family AND a.country=k.country AND a.key=k.key AND a.source='S1' JOIN post b ON b.family=k.family AND b.country=k.country AND b.key=k.key AND b.source<>'S1' GROUP BY a.entity_id, b.entity_id)"""

SQL = {
    "b25_key_caps": f"WITH {_INDEX} SELECT family, country, count(*) AS keys, cast(sum(kn1*kn2) AS bigint) AS cost FROM kept GROUP BY family, country",
    "b26_key_weight": f"WITH {_INDEX} SELECT family, country, key, round(w, 9) AS w FROM weighed",
    "b27_pair_generation": f"WITH {_PAIRGEN} SELECT s1, cand, round(score, 6) AS score, n_keys, cast(mask AS bigint) AS evidence_mask, cast(bit_count(cast(mask AS bigint)) AS bigint) AS n_evidence FROM gen",
    "b33_family_counters": f"WITH {_PAIRGEN}, f AS (SELECT 0 AS b UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) SELECT b AS family, cast(sum(CASE WHEN (mask & (cast(1 AS bigint) << b)) <> 0 THEN 1 ELSE 0 END) AS bigint) AS carrying, cast(sum(CASE WHEN mask = (cast(1 AS bigint) << b) THEN 1 ELSE 0 END) AS bigint) AS alone FROM gen CROSS JOIN f GROUP BY b",
    "c13_output_row": f"WITH {_PAIRGEN} SELECT s1, cand, round(score, 3) AS score, n_keys, cast(row_number() OVER (PARTITION BY cand ORDER BY round(score, 6) DESC, s1) - 1 AS bigint) AS cand_rank FROM gen",
    "b31_idf_block": """WITH n AS (SELECT country, count(*) AS n FROM recs WHERE source='S1' GROUP BY country), d AS (SELECT country, token, count(*) AS df FROM tok WHERE source='S1' GROUP BY country, token)
 SELECT d.country, token, round(ln((n+1)/cast(df+1 AS double))/ln(n+1), 9) AS idf FROM d JOIN n ON d.country=n.country""",
    "f13_idf_feat": """WITH n AS (SELECT country, count(*) AS n FROM recs GROUP BY country), d AS (SELECT country, token, count(*) AS df FROM tok GROUP BY country, token)
 SELECT d.country, token, round((ln((1+n)/cast(1+df AS double))+1)/(ln(1+n)+1), 9) AS idf FROM d JOIN n ON d.country=n.country""",
}
