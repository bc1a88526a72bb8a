"""Aggregations, set operations and joins of the record-linkage pipeline."""

SQL = {
    "a1_group_count": "SELECT s1, count(*) AS n FROM pairs GROUP BY s1",
    "a2_group_sum": "SELECT cand, round(sum(p), 9) AS total FROM pairs GROUP BY cand",
    "a3_group_max": "SELECT cand, max(p) AS best FROM pairs GROUP BY cand",
    "a4_document_frequency": "SELECT country, token, cast(sum(CASE WHEN source='S1' THEN 1 ELSE 0 END) AS bigint) AS df_s, cast(sum(CASE WHEN source<>'S1' THEN 1 ELSE 0 END) AS bigint) AS df_c FROM tok GROUP BY country, token",
    "a5_evidence_mask": """WITH e AS (SELECT s1, cand, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END | CASE WHEN label = 1 THEN 2 ELSE 0 END | CASE WHEN cand % 2 = 0 THEN 4 ELSE 0 END AS m FROM pairs)
 SELECT s1, cast(bit_or(m) AS bigint) AS mask, cast(bit_count(cast(bit_or(m) AS bigint)) AS bigint) AS n_evidence FROM e GROUP BY s1""",
    "a9_pivot": "SELECT country, cast(sum(CASE WHEN label=0 THEN 1 ELSE 0 END) AS bigint) AS n0, cast(sum(CASE WHEN label=1 THEN 1 ELSE 0 END) AS bigint) AS n1 FROM pairs GROUP BY country",
    "a10_conditional": "SELECT country, count(DISTINCT s1) AS n_s1, cast(sum(CASE WHEN p>=0.5 THEN 1 ELSE 0 END) AS bigint) AS strong, round(avg(cast(label AS double)), 9) AS rate FROM pairs GROUP BY country",
    "a11_bands": "WITH n AS (SELECT s1, count(*) AS n FROM pairs GROUP BY s1) SELECT CASE WHEN n=1 THEN '1' WHEN n<=5 THEN '2-5' WHEN n<=30 THEN '6-30' WHEN n<=300 THEN '31-300' ELSE '>300' END AS band, count(*) AS groups FROM n GROUP BY 1",
    "a12_weighted_mean": "WITH n AS (SELECT country, count(DISTINCT s1) AS n, avg(p) AS b FROM pairs GROUP BY country) SELECT round(sum(b*n)/sum(n), 9) AS mean FROM n",
    "a13_auc": """WITH g AS (SELECT country, p, count(*) AS n, sum(label) AS pos FROM pairs GROUP BY country, p),
 c AS (SELECT *, sum(n) OVER (PARTITION BY country ORDER BY p ROWS UNBOUNDED PRECEDING) AS upto FROM g), a AS (SELECT country, sum(pos * (upto - n + (n + 1) / 2.0)) AS s, sum(pos) AS np, sum(n) AS nn FROM c GROUP BY country)
 SELECT country, round((s - np * (np + 1) / 2.0) / nullif(np * (nn - np), 0), 9) AS auc FROM a""",
    "a14_correlation": "SELECT country, round(corr(p, label), 9) AS r FROM pairs GROUP BY country",
    "a15_class_means": "SELECT country, round(avg(CASE WHEN label=1 THEN p END), 9) AS mean1, round(avg(CASE WHEN label=0 THEN p END), 9) AS mean0, round(count(nullif(p, 0))/count(*), 9) AS coverage FROM pairs GROUP BY country",
    "a16_confusion": "SELECT s1, cast(sum(CASE WHEN p>=0.67 THEN 1 ELSE 0 END) AS bigint) AS n_pred, cast(sum(CASE WHEN p>=0.67 THEN label ELSE 0 END) AS bigint) AS tp, cast(sum(label) AS bigint) AS n_true FROM pairs GROUP BY s1",
    "a17_cumulative": "SELECT country, s1, cand, cast(sum(label) OVER (PARTITION BY country ORDER BY p DESC, s1, cand ROWS UNBOUNDED PRECEDING) AS bigint) AS hits FROM pairs",
    "a20_margin": "SELECT coalesce(country, 'ALL') AS country, count(*) AS n, cast(sum(label) AS bigint) AS pos FROM pairs GROUP BY ROLLUP (country)",
    "j1_lookup": "SELECT p.s1, p.cand, coalesce(p_brand, 'none') AS brand FROM pairs p LEFT JOIN part ON p_partkey = p.cand",
    "j2_truth_join": "SELECT a.entity_id AS s1, b.entity_id AS cand FROM recs a JOIN recs b ON a.country=b.country AND a.business_name=b.business_name AND a.business_address=b.business_address WHERE a.source='S1' AND b.source<>'S1'",
    "j3_capped_join": """WITH k AS (SELECT country, token, sum(CASE WHEN source='S1' THEN 1 ELSE 0 END) AS cs, sum(CASE WHEN source<>'S1' THEN 1 ELSE 0 END) AS cc FROM tok GROUP BY country, token),
 ok AS (SELECT country, token FROM k WHERE cs BETWEEN 1 AND 15 AND cc BETWEEN 1 AND 1500)
 SELECT a.entity_id AS s1, b.entity_id AS cand, count(*) AS n_keys FROM ok JOIN tok a ON a.country=ok.country AND a.token=ok.token AND a.source='S1' JOIN tok b ON b.country=ok.country AND b.token=ok.token AND b.source<>'S1' GROUP BY a.entity_id, b.entity_id""",
    "j5_shared_candidates": """WITH l AS (SELECT s1, cand FROM (SELECT *, count(*) OVER (PARTITION BY cand) AS n FROM pairs WHERE p >= 0.5) t WHERE n BETWEEN 2 AND 50)
 SELECT x.s1 AS sx, y.s1 AS sy, count(*) AS shared FROM l x JOIN l y ON x.cand = y.cand AND x.s1 < y.s1 GROUP BY x.s1, y.s1 HAVING count(*) >= 2""",
    "j6_token_overlap": """WITH df AS (SELECT country, token, count(*) AS df FROM tok GROUP BY country, token HAVING count(*) <= 20)
 SELECT a.entity_id AS s1, b.entity_id AS cand, round(sum(cast(1 AS double) / df), 9) AS w FROM df JOIN tok a ON a.country=df.country AND a.token=df.token AND a.source='S1' JOIN tok b ON b.country=df.country AND b.token=df.token AND b.source<>'S1' GROUP BY a.entity_id, b.entity_id""",
    "j7_distractors": "SELECT b.entity_id FROM recs b WHERE b.source<>'S1' AND NOT EXISTS (SELECT 1 FROM recs a WHERE a.source='S1' AND a.country=b.country AND a.business_name=b.business_name)",
    "s1_union_all": "SELECT entity_id, source FROM recs WHERE source='S2' UNION ALL SELECT entity_id, source FROM recs WHERE source='S3'",
    "s2_union_blockers": "SELECT s1, cand FROM pairs WHERE p >= 0.9 UNION SELECT s1, cand FROM pairs WHERE label = 1",
    "s3_key_intersection": "SELECT country, token FROM tok WHERE source='S1' INTERSECT SELECT country, token FROM tok WHERE source<>'S1'",
    "s4_difference": "SELECT s1, cand FROM pairs WHERE p >= 0.3 EXCEPT SELECT s1, cand FROM pairs WHERE p >= 0.6",
    "pf1_source": "SELECT entity_id, split_part(entity_id, '-', 1) AS source FROM recs",
    "pf4_country_space": "SELECT country, cast(sum(CASE WHEN source='S1' THEN 1 ELSE 0 END) AS bigint) AS n1, cast(sum(CASE WHEN source<>'S1' THEN 1 ELSE 0 END) AS bigint) AS n2, cast(sum(CASE WHEN source='S1' THEN 1 ELSE 0 END) * sum(CASE WHEN source<>'S1' THEN 1 ELSE 0 END) AS bigint) AS space FROM recs GROUP BY country",
    "pf7_floor_or_best": "WITH b AS (SELECT *, max(p) OVER (PARTITION BY cand) AS best FROM pairs) SELECT s1, cand FROM b WHERE p >= 0.5 OR p = best",
    "pf9_drop_duplicates": "WITH r AS (SELECT l_orderkey AS s1, l_partkey AS cand, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber) AS rk FROM lineitem) SELECT s1, cand, l_linenumber FROM r WHERE rk = 1",
}
