"""Graph features of pairs, decision rules, and the macro F0.5 metric."""

_RULE = """b AS (SELECT *, max(p) OVER (PARTITION BY cand) AS cmax FROM pairs), d AS (SELECT *, p >= 0.9*cmax - 1e-12 AS base FROM b),
 pred AS (SELECT s1, cand, country, p, label, CASE WHEN base AND p >= 0.67 THEN 1 ELSE 0 END AS y FROM d)"""
_PER_S1 = "per AS (SELECT s1, min(country) AS country, sum(y) AS np, sum(y*label) AS tp, sum(label) AS nt FROM pred GROUP BY s1)"
_F = "CASE WHEN nt = 0 THEN CASE WHEN np = 0 THEN 1.0 ELSE 0.0 END WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp/cast(np AS double)) * (tp/cast(nt AS double)) / (0.25 * tp/cast(np AS double) + tp/cast(nt AS double)) END"

#: A number from the first four hex digits of a hash h, in both dialects.
_HEX4 = " + ".join(f"{16**i} * instr('0123456789abcdef', substr(h, {i + 1}, 1))" for i in range(4))

SQL = {
    "l1_validation_split": "WITH s AS (SELECT DISTINCT country, s1 FROM pairs), r AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY md5(cast(s1 AS string)), s1) AS rk, count(*) OVER (PARTITION BY country) AS n FROM s) SELECT country, s1, CASE WHEN n >= 4 AND rk <= greatest(1, round(0.15*n)) THEN 'val' ELSE 'train' END AS split FROM r",
    "l2_folds": f"WITH s AS (SELECT DISTINCT s1, md5(cast(s1 AS string)) AS h FROM pairs) SELECT s1, cast(({_HEX4}) % 3 AS bigint) AS fold FROM s",
    "l10a_s1_side": """WITH r AS (SELECT s1, cand, p, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS rk, max(p) OVER (PARTITION BY s1) AS best, sum(p) OVER (PARTITION BY s1) AS total, count(*) OVER (PARTITION BY s1) AS n,
 sum(CASE WHEN p>=0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY s1) AS n50, sum(CASE WHEN p>=0.9 THEN 1 ELSE 0 END) OVER (PARTITION BY s1) AS n90 FROM pairs)
 SELECT s1, cand, cast(rk-1 AS bigint) AS s1_rank, round(p/nullif(best,0), 9) AS p_div_s1max, round(total, 9) AS s1_sum, cast(n50 AS bigint) AS s1_n50, cast(n90 AS bigint) AS s1_n90, n AS s1_npairs, cast(rk-1-n50 AS bigint) AS rank_minus_n50 FROM r""",
    "l10b_candidate_side": """WITH r AS (SELECT s1, cand, p, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) AS rk, max(p) OVER (PARTITION BY cand) AS best FROM pairs),
 t AS (SELECT *, max(CASE WHEN rk=2 THEN p END) OVER (PARTITION BY cand) AS second FROM r)
 SELECT s1, cand, cast(rk-1 AS bigint) AS c_rank, round(p - CASE WHEN rk=1 THEN second ELSE best END, 9) AS c_lead, round(p/nullif(best,0), 9) AS p_div_cmax, CASE WHEN rk=1 THEN second ELSE best END AS other_s1_p FROM t""",
    "l10c_anchor_share": """WITH x AS (SELECT s1, cand, p, cand % 7 AS f, CASE WHEN p>=0.9 THEN 1 ELSE 0 END AS a FROM pairs),
 y AS (SELECT *, sum(a) OVER (PARTITION BY s1) - a AS n_other, sum(a) OVER (PARTITION BY s1, f) - a AS same FROM x)
 SELECT s1, cand, cast(n_other AS bigint) AS n_other, round(same / nullif(cast(n_other AS double), 0), 9) AS share FROM y""",
    "l10d_duplicate_s1": """WITH l AS (SELECT s1, cand FROM (SELECT *, count(*) OVER (PARTITION BY cand) AS n FROM pairs WHERE p >= 0.5) t WHERE n BETWEEN 2 AND 50),
 sh AS (SELECT x.s1 AS sx, y.s1 AS sy, count(*) AS c FROM l x JOIN l y ON x.cand = y.cand AND x.s1 <> y.s1 GROUP BY x.s1, y.s1) SELECT sx AS s1, max(c) AS shared_max FROM sh GROUP BY sx""",
    "l12_rule": f"WITH {_RULE} SELECT s1, cand, p, label FROM pred WHERE y = 1",
    "l13_rule_grid": """WITH g AS (SELECT 0.3 AS thr UNION ALL SELECT 0.5 UNION ALL SELECT 0.67 UNION ALL SELECT 0.8 UNION ALL SELECT 0.9), b AS (SELECT *, max(p) OVER (PARTITION BY cand) AS cmax FROM pairs)
 SELECT cast(thr AS double) AS thr, cast(sum(CASE WHEN p >= 0.9*cmax - 1e-12 AND p >= thr THEN 1 ELSE 0 END) AS bigint) AS n_pred, cast(sum(CASE WHEN p >= 0.9*cmax - 1e-12 AND p >= thr THEN label ELSE 0 END) AS bigint) AS tp FROM b CROSS JOIN g GROUP BY thr""",
    "l14_macro_f05": f"WITH {_RULE}, {_PER_S1} SELECT round(avg({_F}), 9) AS f05, cast(sum(np) AS bigint) AS n_pred, cast(sum(tp) AS bigint) AS tp, count(*) AS n_s1 FROM per",
    "l14_f05_by_country": f"WITH {_RULE}, {_PER_S1} SELECT country, round(avg({_F}), 9) AS f05 FROM per GROUP BY country",
    "l16_loss_report": f"""WITH {_RULE}, {_PER_S1} SELECT coalesce(bucket, 'ALL') AS bucket, count(*) AS n, round(sum(loss), 6) AS loss FROM (SELECT CASE WHEN nt=0 THEN '0' WHEN nt=1 THEN '1' WHEN nt<=3 THEN '2-3' ELSE '4+' END AS bucket, 1 - {_F} AS loss FROM per) t GROUP BY ROLLUP (bucket)""",
    "l18_miss_breakdown": f"""WITH {_RULE}, r AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) - 1 AS rk, max(p) OVER (PARTITION BY cand) AS best FROM pred)
 SELECT CASE WHEN p < 0.1 THEN 'a' WHEN p < 0.3 THEN 'b' WHEN p < 0.5 THEN 'c' WHEN p < 0.67 THEN 'd' ELSE 'e' END AS band, CASE WHEN rk >= 2 THEN 1 ELSE 0 END AS third_or_lower, CASE WHEN p < best THEN 1 ELSE 0 END AS prefers_other, count(*) AS n FROM r WHERE label = 1 AND y = 0 GROUP BY 1, 2, 3""",
    "c9_context": """WITH q AS (SELECT *, least(greatest(p, 1e-6), 1 - 1e-6) AS pc FROM pairs), l AS (SELECT *, ln(pc/(1-pc)) AS lp FROM q),
 r AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) - 1 AS rc, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) - 1 AS rs, max(lp) OVER (PARTITION BY cand) AS bc, max(lp) OVER (PARTITION BY s1) AS bs, sum(p) OVER (PARTITION BY cand) AS sc, sum(p) OVER (PARTITION BY s1) AS ss FROM l)
 SELECT s1, cand, round(lp, 7) AS lp, cast(least(rc, 50) AS bigint) AS rank_c, cast(least(rs, 50) AS bigint) AS rank_s, round(lp - bc, 7) AS gap_c, round(lp - bs, 7) AS gap_s, round(p / nullif(sc, 0), 7) AS share_c, round(ss - p, 7) AS other_s, cast(sum(CASE WHEN rc = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY s1) AS bigint) AS nbest_s FROM r""",
    "c11_auto_budget": """WITH n AS (SELECT country, count(DISTINCT s1) AS n1, sum(label) AS t FROM pairs GROUP BY country), r AS (SELECT country, row_number() OVER (PARTITION BY country ORDER BY p DESC, s1, cand) AS rk, sum(label) OVER (PARTITION BY country ORDER BY p DESC, s1, cand ROWS UNBOUNDED PRECEDING) AS hits FROM pairs)
 SELECT r.country, min(ceil(10.0 * rk / n1) / 10.0) AS budget FROM r JOIN n ON r.country = n.country WHERE hits >= 0.9 * t GROUP BY r.country""",
}
