"""Ranks, windows, top-k and budgets over scored pairs; every tie is broken by id."""

# name -> SQL that Spark and DuckDB read alike; fixture views are added by the registry
SQL = {
    "w1_rank_lead": """WITH r AS (SELECT s1, cand, p, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS rk FROM pairs),
 t AS (SELECT *, max(CASE WHEN rk=1 THEN p END) OVER (PARTITION BY s1) AS b1, max(CASE WHEN rk=2 THEN p END) OVER (PARTITION BY s1) AS b2 FROM r)
 SELECT s1, cand, cast(rk-1 AS bigint) AS rank, round(p - CASE WHEN rk=1 THEN b2 ELSE b1 END, 9) AS lead FROM t""",
    "w2_rank_desc": """SELECT s1, cand, cast(row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) - 1 AS bigint) AS rank, max(p) OVER (PARTITION BY cand) AS best FROM pairs""",
    "w3_gap": """SELECT s1, cand, round(p - max(p) OVER (PARTITION BY s1), 9) AS gap_s1, round(p - max(p) OVER (PARTITION BY cand), 9) AS gap_cand FROM pairs""",
    "w4_best_other": """WITH r AS (SELECT s1, cand, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) AS rk FROM pairs),
 t AS (SELECT cand, max(CASE WHEN rk=1 THEN s1 END) AS o1, max(CASE WHEN rk=2 THEN s1 END) AS o2 FROM r WHERE rk <= 2 GROUP BY cand)
 SELECT r.s1, r.cand, coalesce(CASE WHEN rk=1 THEN o2 ELSE o1 END, -1) AS best_other FROM r JOIN t ON r.cand = t.cand""",
    "w5_rarest_k": """WITH df AS (SELECT country, token, count(*) AS df FROM tok GROUP BY country, token),
 r AS (SELECT tok.entity_id, tok.token, df.df, row_number() OVER (PARTITION BY tok.entity_id ORDER BY df.df, tok.token) AS rk FROM tok JOIN df ON tok.country=df.country AND tok.token=df.token)
 SELECT entity_id, token, df, cast(rk AS bigint) AS rk FROM r WHERE rk <= 2""",
    "w6_budget_prefix": """WITH df AS (SELECT country, token, count(*) AS df FROM tok GROUP BY country, token),
 r AS (SELECT tok.entity_id, tok.token, df.df, sum(df.df) OVER (PARTITION BY tok.entity_id ORDER BY df.df, tok.token ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM tok JOIN df ON tok.country=df.country AND tok.token=df.token)
 SELECT entity_id, token, df, cast(coalesce(before, 0) AS bigint) AS before FROM r WHERE coalesce(before, 0) < 40""",
    "w8_first_of_group": """SELECT s1, cand, CASE WHEN lag(s1) OVER (PARTITION BY s1 ORDER BY cand) IS NULL THEN 1 ELSE 0 END AS is_first FROM pairs""",
    "w9_share": """SELECT s1, cand, round(p / nullif(sum(p) OVER (PARTITION BY s1), 0), 9) AS share, round(p / nullif(max(p) OVER (PARTITION BY s1), 0), 9) AS of_max FROM pairs""",
    "w10_other_totals": """SELECT s1, cand, round(sum(p) OVER (PARTITION BY s1) - p, 9) AS other_sum, count(*) OVER (PARTITION BY s1) - 1 AS other_n FROM pairs""",
    "w11_counts": """WITH b AS (SELECT *, max(p) OVER (PARTITION BY cand) AS best FROM pairs)
 SELECT s1, cand, cast(sum(CASE WHEN p >= 0.5*best THEN 1 ELSE 0 END) OVER (PARTITION BY cand) AS bigint) AS near, cast(sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY cand) AS bigint) AS n50,
 cast(sum(CASE WHEN p >= 0.9 THEN 1 ELSE 0 END) OVER (PARTITION BY cand) AS bigint) AS n90 FROM b""",
    "w12_mutual_best": """WITH r AS (SELECT s1, cand, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS a, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) AS b FROM pairs) SELECT s1, cand FROM r WHERE a = 1 AND b = 1""",
    "w13_rank_in_source": """SELECT s1, cand, cand % 2 AS src, cast(row_number() OVER (PARTITION BY s1, cand % 2 ORDER BY p DESC, cand) - 1 AS bigint) AS rank FROM pairs""",
    "t1_pool_topk": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) AS rk FROM pairs) SELECT s1, cand, cast(rk - 1 AS bigint) AS rank FROM r WHERE rk <= CASE WHEN cand % 10 = 0 THEN 100 ELSE 20 END""",
    "t2_shortlist": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) AS rk FROM pairs) SELECT s1, cand, p FROM r WHERE rk <= CASE WHEN cand % 10 = 0 THEN 60 ELSE 30 END AND (p >= 0.0002 OR rk = 1)""",
    "t3_budget": """WITH n AS (SELECT country, count(DISTINCT s1) AS n1 FROM pairs GROUP BY country), r AS (SELECT s1, cand, country, p, row_number() OVER (PARTITION BY country ORDER BY p DESC, s1, cand) AS rk FROM pairs)
 SELECT s1, cand, r.country, p FROM r JOIN n ON r.country = n.country WHERE rk <= floor(1.5 * n1)""",
    "t4_s1_cap": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS rk FROM pairs) SELECT s1, cand FROM r WHERE rk <= 3""",
    "t5_expensive_keys": """WITH k AS (SELECT country, token, sum(CASE WHEN source='S1' THEN 1 ELSE 0 END) * sum(CASE WHEN source<>'S1' THEN 1 ELSE 0 END) AS cost FROM tok GROUP BY country, token),
 c AS (SELECT *, sum(cost) OVER (PARTITION BY country ORDER BY cost, token ROWS UNBOUNDED PRECEDING) AS run FROM k WHERE cost > 0) SELECT country, token, cast(cost AS bigint) AS cost, cast(run AS bigint) AS run FROM c WHERE run <= 3000""",
    "t8_hash_sample": """WITH r AS (SELECT s1, cand, country, row_number() OVER (PARTITION BY country ORDER BY md5(concat(cast(s1 AS string), '-', cast(cand AS string)))) AS rk FROM pairs) SELECT s1, cand, country FROM r WHERE rk <= 100""",
}
