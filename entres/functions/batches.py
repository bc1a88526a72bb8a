"""The similarities of ``strings`` for many pairs at once, as arrays: the same values, without a Python step a character.

Characters of the left text are bits of one 64-bit number; pairs with a longer text go through ``strings``.
"""

from __future__ import annotations

import numpy as np

from . import strings as S

BITS = 64


def _codes(texts: list[str], width: int, pad: int) -> np.ndarray:
    """Rows of code points, padded with a number that is no code point."""
    out = np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width)
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.where(np.arange(width) < n[:, None], out, np.uint32(pad))


class _Pairs:
    """Pairs of texts of at most ``BITS`` characters as padded rows."""

    def __init__(self, a: list[str], b: list[str]):
        self.la, self.lb = (np.fromiter(map(len, t), np.int64, len(t)) for t in (a, b))
        most = int(max(self.la.max(initial=1), self.lb.max(initial=1)))
        self.width = next(w for w in (8, 16, 32, BITS) if most <= w)
        a_, b_ = _codes(a, self.width, 0x1FFFFE), _codes(b, self.width, 0x1FFFFF)
        if max(a_[a_ < 0x1FFFFE].max(initial=0), b_[b_ < 0x1FFFFE].max(initial=0)) < 254:  # a byte each: pads become 254 and 255
            a_, b_ = a_.astype(np.uint8), b_.astype(np.uint8)
        self.a, self.b = np.ascontiguousarray(a_), np.ascontiguousarray(b_)


def _bits(rows: np.ndarray) -> np.ndarray:
    """Rows of flags as numbers."""
    return np.packbits(rows.ravel(), bitorder="little").view(f"<u{rows.shape[1] // 8}").astype(np.uint64)


def _low(n: np.ndarray) -> np.ndarray:
    """Numbers whose lowest n bits are set."""
    return np.where(n >= BITS, ~np.uint64(0), (np.uint64(1) << np.minimum(n, BITS - 1).astype(np.uint64)) - np.uint64(1))


def _common(a: np.ndarray, la: np.ndarray, b: np.ndarray, steps: int, each=None) -> np.ndarray:
    """Longest common subsequences of rows; ``each(j, lengths)`` sees them after each character of ``b``."""
    every = _low(la)
    open_ = every.copy()
    for j in range(steps):
        hit = open_ & _bits(a == b[:, j : j + 1])
        open_ = ((open_ + hit) | (open_ - hit)) & every
        if each is not None:
            each(j, la - np.bitwise_count(open_))
    return la - np.bitwise_count(open_)


def _indel(p: _Pairs) -> np.ndarray:
    total = p.la + p.lb
    return np.where(total == 0, 1.0, 2.0 * _common(p.a, p.la, p.b, int(p.lb.max(initial=0))) / np.maximum(total, 1))


def _winkler(p: _Pairs) -> np.ndarray:
    n, one = len(p.la), np.uint64(1)
    reach = np.maximum(p.la, p.lb) // 2 - 1
    free, left = _low(p.lb), np.zeros(p.a.shape, dtype=bool)
    for i in range(int(p.la.max(initial=0))):
        window = _low(np.clip(i + reach + 1, 0, BITS)) & ~_low(np.clip(i - reach, 0, BITS))
        hit = _bits(p.b == p.a[:, i : i + 1]) & window & free
        first = hit & (~hit + one)
        free &= ~first
        left[:, i] = first != 0
    taken = _low(p.lb) & ~free
    right = ((taken[:, None] >> np.arange(p.width, dtype=np.uint64)) & one).astype(bool)
    m = left.sum(1)
    apart = np.bincount(np.nonzero(left)[0], weights=p.a[left] != p.b[right], minlength=n).astype(np.int64)
    swaps, found = apart // 2, np.maximum(m, 1)
    s = (found / np.maximum(p.la, 1) + found / np.maximum(p.lb, 1) + (found - swaps) / found) / 3
    s = np.where((p.la == 0) & (p.lb == 0), 1.0, np.where(m == 0, 0.0, s))
    same = np.logical_and.accumulate(p.a[:, :4] == p.b[:, :4], axis=1).sum(1)
    return np.where(s > 0.7, s + same * 0.1 * (1 - s), s)


def _reversed(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows with their first n characters turned round; what follows is of no use."""
    return np.take_along_axis(x, np.clip(n[:, None] - 1 - np.arange(x.shape[1]), 0, None), axis=1)


def _partial(p: _Pairs) -> np.ndarray:
    """See ``strings.partial``: full windows first, from which windows that cannot be better are skipped, then shorter ones at both ends."""
    swap = p.la > p.lb
    s, t = np.where(swap[:, None], p.b, p.a), np.where(swap[:, None], p.a, p.b)
    n, m = np.minimum(p.la, p.lb), np.maximum(p.la, p.lb)
    pad_s, pad_t = (254, 255) if s.dtype == np.uint8 else (0x1FFFFE, 0x1FFFFF)
    cols = np.arange(p.width)
    cut = lambda x, k, pad: np.where(cols < k[:, None], x, x.dtype.type(pad))
    s, t = cut(s, n, pad_s), cut(t, m, pad_t)
    most, at = np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.int64)
    live = np.nonzero(n > 0)[0]
    while len(live):
        k = n[live]
        window = cut(np.take_along_axis(t[live], np.minimum(at[live][:, None] + cols, p.width - 1), axis=1), k, pad_t)
        here = _common(s[live], k, window, int(k.max()))
        most[live] = np.maximum(most[live], here)
        at[live] += most[live] - here + 1
        live = live[(at[live] <= m[live] - n[live]) & (most[live] < n[live])]
    best = np.where(n > 0, 2.0 * most / np.maximum(n + n, 1), np.where(m > 0, 0.0, 1.0))

    def ends(x: np.ndarray, y: np.ndarray, ny: np.ndarray, k: np.ndarray) -> np.ndarray:
        out = np.zeros(len(k))

        def each(j: int, got: np.ndarray) -> None:
            np.maximum(out, np.where(j + 1 < k, 2.0 * got / np.maximum(k + j + 1, 1), 0.0), out=out)

        _common(x, k, y, int(k.max(initial=1)) - 1, each)
        _common(cut(_reversed(x, k), k, pad_s), k, cut(_reversed(y, ny), ny, pad_t), int(k.max(initial=1)) - 1, each)
        return out

    best = np.maximum(best, ends(s, t, m, n))
    same = np.nonzero((m == n) & (n > 0))[0]
    if len(same):
        best[same] = np.maximum(best[same], ends(cut(t[same], n[same], pad_s), cut(s[same], n[same], pad_t), n[same], n[same]))
    return best


def _each(fast, slow):
    def run(a: list[str], b: list[str]) -> np.ndarray:
        most = np.fromiter((max(len(x), len(y)) for x, y in zip(a, b, strict=True)), np.int64, len(a))
        out, low = np.empty(len(a)), -1
        for width in (8, 16, 32, BITS):
            i = np.nonzero((most > low) & (most <= width))[0]
            low = width
            if len(i):
                out[i] = fast(_Pairs([a[k] for k in i], [b[k] for k in i]))
        for k in np.nonzero(most > BITS)[0]:
            out[k] = slow(a[k], b[k])
        return out

    return run


indel_ratio, winkler, partial = _each(_indel, S.indel_ratio), _each(_winkler, S.winkler), _each(_partial, S.partial)


def token_sort(a: list[str], b: list[str]) -> np.ndarray:
    known = {t: " ".join(sorted(t.split())) for t in {*a, *b}}
    return indel_ratio([known[t] for t in a], [known[t] for t in b])


def token_set(a: list[str], b: list[str]) -> np.ndarray:
    """The words that both have begin both long texts, so a ratio with them alone needs no comparison."""
    known = {t: frozenset(t.split()) for t in {*a, *b}}
    out = np.ones(len(a))
    left, right, shared, at = [], [], [], []
    for k, (t, u) in enumerate(zip(a, b, strict=True)):
        x, y = known[t], known[u]
        both, only_a, only_b = x & y, x - y, y - x
        if both and (not only_a or not only_b):
            continue
        head = " ".join(sorted(both))
        left.append(f"{head} {' '.join(sorted(only_a))}".strip())
        right.append(f"{head} {' '.join(sorted(only_b))}".strip())
        shared.append(len(head))
        at.append(k)
    if at:
        n, la, lb = (np.array(v, dtype=np.float64) for v in (shared, [len(t) for t in left], [len(t) for t in right]))
        alone = np.where(n > 0, 2.0 * n / np.maximum(n + np.minimum(la, lb), 1), 0.0)
        out[at] = np.maximum(indel_ratio(left, right), alone)
    return out
