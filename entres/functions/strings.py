"""String similarities that Spark lacks, as Arrow-batched UDFs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType


def jaro(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [c for c, t in zip(b, taken, strict=True) if t]
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def winkler(a: str, b: str, weight: float = 0.1) -> float:
    s = jaro(a, b)
    same = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        same += 1
    return s + same * weight * (1 - s) if s > 0.7 else s


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence; all positions of ``a`` are bits of one number, so a character of ``b`` is one step."""
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    open_ = every
    for c in b:
        hit = open_ & place.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & every
    return len(a) - open_.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """1 - (insertions and deletions) / (total length)."""
    return 2.0 * common(a, b) / (len(a) + len(b)) if a or b else 1.0


def token_sort(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    both, only_a, only_b = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_a or not only_b):
        return 1.0
    long_a, long_b = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    return max(indel_ratio(long_a, long_b), indel_ratio(both, long_a) if both else 0.0, indel_ratio(both, long_b) if both else 0.0)


def common_with_starts(a: str, b: str) -> list[int]:
    """:func:`common` of ``a`` with each start of ``b``, the empty one first: one pass of ``b`` has them all."""
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    open_, out = every, [0]
    for c in b:
        hit = open_ & place.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & every
        out.append(len(a) - open_.bit_count())
    return out


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter text against windows of the longer one, shorter windows at its two ends included.

    One pass from either end has all shorter windows.  A window shares at most one character more than the one before it,
    so windows that cannot pass the best one yet are not looked at.
    """
    s, t = sorted((a, b), key=len)
    if not s:
        return 1.0 if not t else 0.0
    n = len(s)

    def ends(x: str, y: str) -> float:
        starts, tails = common_with_starts(x, y[: n - 1]), common_with_starts(x[::-1], y[::-1][: n - 1])
        return max((2.0 * max(starts[i], tails[i]) / (n + i) for i in range(1, n)), default=0.0)

    most, at = 0, 0
    while at <= len(t) - n and most < n:
        here = common(s, t[at : at + n])
        most = max(most, here)
        at += most - here + 1
    best = max(2.0 * most / (n + n), ends(s, t))
    return max(best, ends(t, s)) if len(t) == n else best


def _all(name: str, pairs: list[tuple[str, str]]) -> list[float]:
    from . import batches  # it begins with this module

    return getattr(batches, name)([x for x, _ in pairs], [y for _, y in pairs]).tolist() if pairs else []


def _udf(name: str):
    """Each distinct pair of a batch is computed once; NULL if either side is missing."""

    @arrow_udf(DoubleType())
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        rows = list(zip(a.to_pylist(), b.to_pylist(), strict=True))
        pairs = list(dict.fromkeys(r for r in rows if r[0] is not None and r[1] is not None))
        known = dict(zip(pairs, _all(name, pairs), strict=True))
        return pa.array([known.get(r) for r in rows], type=pa.float64())

    return run


jaro_winkler_udf, token_sort_udf, token_set_udf, partial_udf = (_udf(f) for f in ("winkler", "token_sort", "token_set", "partial"))


def best_udf(name: str):
    """The best similarity over all combinations of three left and three right texts; nulls are left out, null if a side has none."""

    @arrow_udf(DoubleType())
    def run(a: pa.Array, b: pa.Array, c: pa.Array, x: pa.Array, y: pa.Array, z: pa.Array) -> pa.Array:
        sides = [[{t for t in row if t is not None} for row in zip(*(v.to_pylist() for v in side), strict=True)] for side in ((a, b, c), (x, y, z))]
        rows = [[(p, q) for p in left for q in right] for left, right in zip(*sides, strict=True)]
        pairs = list(dict.fromkeys(r for row in rows for r in row))
        known = dict(zip(pairs, _all(name, pairs), strict=True))
        return pa.array([max((known[r] for r in row), default=None) for row in rows], type=pa.float64())

    return run
