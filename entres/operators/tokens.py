"""Token sets and positions, result lists, other-S1 features and the rule sweep."""

from .decision import _F
from .text import _CAND, _g

_WORDS_SPARK = "filter(split(lower(business_name), ' '), x -> x <> '')"
_WORDS_DUCK = "list_filter(string_split(lower(business_name), ' '), lambda x: x <> '')"

#: Pairs that the decision rule keeps, and the S1 universe they are listed for.
_KEPT = "b AS (SELECT *, max(p) OVER (PARTITION BY cand) AS cmax FROM pairs), kept AS (SELECT s1, cand, p FROM b WHERE p >= 0.9*cmax - 1e-12 AND p >= 0.67), uni AS (SELECT DISTINCT s1 FROM pairs)"
_LIST_SPARK = "lst AS (SELECT s1, array_join(transform(array_sort(collect_list(struct(-p AS q, cand))), x -> cast(x.cand AS string)), ',') AS ids FROM kept GROUP BY s1)"
_LIST_DUCK = "lst AS (SELECT s1, string_agg(cast(cand AS varchar), ',' ORDER BY p DESC, cand) AS ids FROM kept GROUP BY s1)"
_LISTED = "SELECT uni.s1, coalesce(ids, '') AS matched FROM uni LEFT JOIN lst ON lst.s1 = uni.s1"


def _set_keys(key: str) -> str:
    return f"""WITH w AS (SELECT country, source, {key} AS set_key FROM recs) SELECT country, set_key, cast(sum(CASE WHEN source='S1' THEN 1 ELSE 0 END) AS bigint) AS n_s1,
 cast(sum(CASE WHEN source<>'S1' THEN 1 ELSE 0 END) AS bigint) AS n_cand FROM w GROUP BY country, set_key"""


def _sets(both: str, either: str, left: str, right: str) -> str:
    return f"SELECT s1, cand, cast({both} AS bigint) AS shared, cast({either} AS bigint) AS either, cast({left} AS bigint) AS only_s1, cast({right} AS bigint) AS only_cand FROM w"


TWO = {
    "a6_set_key": (_set_keys(f"array_join(array_sort(array_distinct({_WORDS_SPARK})), ' ')"), _set_keys(f"array_to_string(list_sort(list_distinct({_WORDS_DUCK})), ' ')")),
    "a7_result_lists": (f"WITH {_KEPT}, {_LIST_SPARK} {_LISTED}", f"WITH {_KEPT}, {_LIST_DUCK} {_LISTED}"),
    "a8_explode_lists": (
        f"WITH {_KEPT}, {_LIST_SPARK} SELECT s1, explode(transform(split(ids, ','), x -> cast(x AS bigint))) AS cand FROM lst",
        f"WITH {_KEPT}, {_LIST_DUCK} SELECT s1, cast(unnest(string_split(ids, ',')) AS bigint) AS cand FROM lst",
    ),
    "w7_token_position": (
        f"SELECT entity_id, cast(pos AS bigint) AS pos, token FROM recs LATERAL VIEW posexplode({_WORDS_SPARK}) t AS pos, token",
        f"SELECT entity_id, cast(unnest(range(0, len({_WORDS_DUCK}))) AS bigint) AS pos, unnest({_WORDS_DUCK}) AS token FROM recs",
    ),
    "s5_token_sets": (
        f"WITH c AS ({_g(_CAND)[0]}), w AS (SELECT s1, cand, array_distinct(split(na, ' ')) AS x, array_distinct(split(nb, ' ')) AS y FROM c) "
        + _sets("size(array_intersect(x, y))", "size(array_union(x, y))", "size(array_except(x, y))", "size(array_except(y, x))"),
        f"WITH c AS ({_g(_CAND)[1]}), w AS (SELECT s1, cand, list_distinct(string_split(na, ' ')) AS x, list_distinct(string_split(nb, ' ')) AS y FROM c) "
        + _sets("len(list_intersect(x, y))", "len(list_distinct(list_concat(x, y)))", "len(x) - len(list_intersect(x, y))", "len(y) - len(list_intersect(x, y))"),
    ),
}

SQL = {
    "l10e_other_s1_equality": """WITH r AS (SELECT s1, cand, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) AS rk FROM pairs),
 t AS (SELECT cand, max(CASE WHEN rk=1 THEN s1 END) AS o1, max(CASE WHEN rk=2 THEN s1 END) AS o2 FROM r WHERE rk <= 2 GROUP BY cand),
 o AS (SELECT r.s1, r.cand, CASE WHEN rk=1 THEN o2 ELSE o1 END AS other FROM r JOIN t ON r.cand = t.cand)
 SELECT o.s1, o.cand, CASE WHEN x.o_orderstatus = y.o_orderstatus THEN 1 WHEN y.o_orderkey IS NOT NULL THEN 0 END AS same_status,
 CASE WHEN x.o_orderpriority = y.o_orderpriority THEN 1 WHEN y.o_orderkey IS NOT NULL THEN 0 END AS same_priority,
 CASE WHEN x.o_custkey = y.o_custkey THEN 1 WHEN y.o_orderkey IS NOT NULL THEN 0 END AS same_customer
 FROM o JOIN orders x ON x.o_orderkey = o.s1 LEFT JOIN orders y ON y.o_orderkey = o.other""",
    "l15_sweep": f"""WITH g AS (SELECT cast(one AS int) AS one, cast(thr AS double) AS thr FROM (VALUES (0, 0.5), (0, 0.6), (0, 0.7), (0, 0.8), (0, 0.9), (1, 0.5), (1, 0.6), (1, 0.7), (1, 0.8), (1, 0.9)) v(one, thr)),
 b AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY p DESC, s1) AS rk FROM pairs),
 per AS (SELECT one, thr, s1, sum(CASE WHEN p >= thr AND (one = 0 OR rk = 1) THEN 1 ELSE 0 END) AS np, sum(CASE WHEN p >= thr AND (one = 0 OR rk = 1) THEN label ELSE 0 END) AS tp, sum(label) AS nt FROM b CROSS JOIN g GROUP BY one, thr, s1)
 SELECT one, thr, round(avg({_F}), 9) AS f05, cast(sum(np) AS bigint) AS n_pred, cast(sum(tp) AS bigint) AS tp FROM per GROUP BY one, thr""",
}
