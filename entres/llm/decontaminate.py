"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

An item of m characters that occurs in a text with at most k edits shares at least
t = m + 1 - q - q*k of its q-grams with the text, and they lie on diagonals (text position minus item
position) no more than k apart.  Shared q-grams are counted in diagonal bands that overlap by half, so
that every run of k + 1 diagonals lies in one band whole; bands that reach t are joined with their
neighbours and verified by banded alignment of the whole item.  k is ``EDIT_RATE`` of the item's length, less
for short items so that t stays positive; items shorter than q must occur as they are.

Both sides are compared in lower case with runs of white space as one space.  Whole texts are
searched; positions refer to the original text, in characters.

Scale.  Documents are never shuffled.  The benchmark is read in blocks of at most ``BLOCK_CHARS``
characters; each block is broadcast (the bound is its size) and scans the documents once, so a
benchmark of any size has a way, and the index of one block fits every executor.  The driver reads one block at a time; what
is broadcast stays until the lazy result has been computed.

Defined cases: null and empty texts and items match nothing; items with equal text are each
reported; repeated rows are reported each; a text of any length is searched whole; extra columns are ignored (kept by the
stage, whatever their names); empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .util import U64, mix64, slices, table

Q = 8
EDIT_RATE = 0.1
BLOCK_CHARS = 2_000_000

_FOLD = np.arange(0x10000, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[0xC0:0xDF] += 32
_FOLD[0xD7] = 0xD7
_FOLD[[9, 10, 11, 12, 13, 0xA0]] = 32
#: Between two texts; no character has this number.
_APART = 0x110000
#: Shared q-grams that a task holds at once.
HITS = 4_000_000
_CODE = mix64(np.arange(0x10000, dtype=U64) + U64(0x2545F491))


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of a batch, where each came from (position in its own text), and each text's bounds.

    Texts are separated by a character that occurs in none, so no q-gram of one text reaches another unseen.
    """
    raw = np.frombuffer("\n".join(texts).encode("utf-32-le"), "<u4") if texts else np.zeros(0, np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate(([0], np.cumsum(size + 1)))[: len(texts)]
    x = np.where(raw < 0x10000, _FOLD[raw & 0xFFFF], raw)
    ends = first[1:] - 1
    x[ends] = _APART
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    kept = np.flatnonzero(keep)
    bound = np.searchsorted(kept, np.append(first, len(raw) + 1))
    at = kept - np.repeat(first, np.diff(bound)) if len(texts) else kept
    return x[kept], at, bound


def qgrams(x: np.ndarray, q: int = Q) -> np.ndarray:
    n = max(0, len(x) - q + 1)
    h, code = np.zeros(n, U64), _CODE[x & 0xFFFF]
    for i in range(q):
        h = h * U64(0x9E3779B97F4A7C15) + code[i : i + n]
    return h ^ (h >> U64(29))


def budget(m: int, q: int = Q, rate: float = EDIT_RATE) -> tuple[int, int]:
    """Edits allowed for an item of m >= q characters, and the shared q-grams that they leave."""
    k = min(int(rate * m), (m - q) // q)
    return k, m + 1 - q - q * k


class Index:
    """q-grams of a block of items: a bit table for a first look, then sorted postings (item, position)."""

    BITS = 20

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.text, key, who, at = [], [], [], [], []
        self.short: list[int] = []
        for item_id, text in items:
            x, _, _ = fold([text])
            x = x[1:] if len(x) and x[0] == 32 else x
            x = x[:-1] if len(x) and x[-1] == 32 else x
            if not len(x):
                continue
            n = len(self.ids)
            self.ids.append(item_id)
            self.text.append(x)
            if len(x) < Q:
                self.short.append(n)
                continue
            g = qgrams(x)
            key.append(g)
            who.append(np.full(len(g), n))
            at.append(np.arange(len(g)))
        cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        key, who, at = cat(key, U64), cat(who, np.int64), cat(at, np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.first = np.unique(key[order], return_index=True)
        self.first = np.append(self.first, len(key))
        self.who, self.at = who[order], at[order]
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[(self.keys & U64((1 << self.BITS) - 1)).astype(np.int64)] = True
        k = [budget(len(x)) if len(x) >= Q else (0, 1) for x in self.text]
        self.k, self.t = np.array([a for a, _ in k], np.int64), np.array([b for _, b in k], np.int64)


def align(item: np.ndarray, text: np.ndarray, lo: int, hi: int, k: int) -> tuple[int, int, int] | None:
    """Best occurrence of the whole item in the text whose path keeps to diagonals lo..hi, with at most k edits.

    Returns (edits, start, end); among equals the first end, and the longest start for it.
    """
    width, m, n = hi - lo + 1, len(item), len(text)
    diag = np.arange(lo, hi + 1)
    big = m + n + 1
    ramp = np.arange(width)
    cost = np.where((diag >= 0) & (diag <= n), 0, big)
    start = np.where(cost == 0, diag, -1)
    padded = np.full(m + n + width + abs(lo) + abs(hi) + 2, 0xFFFFFFFF, np.uint32)
    base = max(0, -lo) + 1
    padded[base : base + n] = text
    for i in range(1, m + 1):
        j = i + diag  # text characters read after this row
        char = padded[base + i - 1 + lo : base + i - 1 + lo + width]
        sub = cost + (char != item[i - 1])
        drop = np.append(cost[1:], big) + 1  # an item character without a text character
        best = np.where(sub <= drop, sub, drop)
        from_ = np.where(sub <= drop, start, np.append(start[1:], -1))
        best = np.where((j >= 0) & (j <= n), best, big)
        # text characters without an item character: a running minimum along the row
        run = best - ramp
        low = np.minimum.accumulate(run)
        source = np.maximum.accumulate(np.where(run == low, ramp, 0))
        cost, start = np.minimum(low + ramp, big), from_[source]
        if cost.min() > k:
            return None
    at = int(np.argmin(cost))
    return (int(cost[at]), int(start[at]), int(m + diag[at])) if cost[at] <= k else None


def search(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
    """(text, item, start, end, edits, shared q-grams) of every verified region; start and end in the original text."""
    x, origin, bound = fold(texts)
    found = []
    for n in index.short:
        item = index.text[n]
        ok = np.ones(max(0, len(x) - len(item) + 1), bool)
        for i, c in enumerate(item):
            ok &= x[i : i + len(ok)] == c
        for p in np.flatnonzero(ok):
            d = int(np.searchsorted(bound, p, side="right")) - 1
            found.append((d, n, int(p), int(p) + len(item), 0, 1))
    g = qgrams(x)
    place = np.flatnonzero(index.bits[(g & U64((1 << index.BITS) - 1)).astype(np.int64)])
    if len(place) and len(index.keys):
        slot = np.minimum(np.searchsorted(index.keys, g[place]), len(index.keys) - 1)
        same = index.keys[slot] == g[place]
        place, slot = place[same], slot[same]
        many = index.first[slot + 1] - index.first[slot]
        span = np.int64(len(x)) + 4096
        u, c, lo = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while lo < len(place):  # a frequent q-gram of many items makes many hits: a bounded number at a time
            hi = lo + max(1, int(np.searchsorted(np.cumsum(many[lo:]), HITS, side="right")))
            n = many[lo:hi]
            post = np.repeat(index.first[slot[lo:hi]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item, diag = index.who[post], np.repeat(place[lo:hi], n) - index.at[post]
            # bands of 2 * step diagonals that overlap by half; one that opens before its first hit holds no more than the next
            u2, c2 = np.unique(item * (2 * span) + diag // (index.k[item] + 1) + span, return_counts=True)
            u, back = np.unique(np.concatenate((u, u2)), return_inverse=True)
            c = np.bincount(back, weights=np.concatenate((c, c2)), minlength=len(u)).astype(np.int64)
            lo = hi
        nxt = np.searchsorted(u, u + 1)
        follow = np.where((nxt < len(u)) & (u[np.minimum(nxt, len(u) - 1)] == u + 1), c[np.minimum(nxt, len(u) - 1)], 0)
        opens = np.flatnonzero(np.maximum(c + follow, c) >= index.t[u // (2 * span)])
        regions: list[list[int]] = []
        for r in opens:
            n, b = int(u[r] // (2 * span)), int(u[r] % (2 * span) - span)
            s = int(index.k[n]) + 1
            lo, hi, shared = b * s, (b + 2) * s - 1, int(c[r] + follow[r])
            if regions and regions[-1][0] == n and lo <= regions[-1][2] + s:
                regions[-1][2], regions[-1][3] = hi, max(shared, regions[-1][3])
            else:
                regions.append([n, lo, hi, shared])
        for n, lo, hi, shared in regions:
            k, target = int(index.k[n]), index.text[n]
            lo, hi = lo - k, hi + k
            d0, d1 = (int(np.searchsorted(bound, min(max(p, 0), len(x) - 1), side="right")) - 1 for p in (lo, hi + len(target) + k))
            for d in range(d0, d1 + 1):
                left, a, b = lo, max(int(bound[d]), lo), min(int(bound[d + 1]), hi + len(target) + k)
                while b - a >= len(target) - k:
                    hit = align(target, x[a:b], left - a, hi - a, k)
                    if hit is None:
                        break
                    found.append((d, n, a + hit[1], a + hit[2], hit[0], shared))
                    left = a = a + hit[2]  # wide regions may hold the item again
                    if left > hi:
                        break
    out = []
    for d, n, s, e, edits, shared in found:
        out.append((d, index.ids[n], int(origin[s]), int(origin[e - 1]) + 1, edits, shared))
    return sorted(set(out))


COLUMNS = "doc_id long, item_id long, start long, end long, edits int, shared_qgrams int"


def _items(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Blocks of items of bounded size, read one after the other."""
    sized = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    for b in range(blocks):
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        if rows:
            yield sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every occurrence of an item of ``benchmark(item_id, text)`` in ``docs(doc_id, text)`` within the edit budget."""
    out = None
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for items in _items(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        part = source.mapInArrow(_finder(shared), COLUMNS)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], COLUMNS)


def _finder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        for part, raw in slices(batches, limit=1 << 20):
            ids = part.column(0).to_pylist()
            rows = [{"doc_id": ids[d], "item_id": n, "start": s, "end": e, "edits": k, "shared_qgrams": g} for d, n, s, e, k, g in search(index, [t.decode("utf-8") for t in raw])]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("shared_qgrams", pa.int32())]))

    return run


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay.  Narrow: the test runs inside the scan."""
    out = docs
    for items in _items(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for part, raw in slices(batches, limit=1 << 20):
                keep = np.ones(len(raw), bool)
                keep[[r[0] for r in search(index, [t.decode("utf-8") for t in raw])]] = False
                yield part.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark passage go."""
    return clean(docs, table(spark, sf_dir, "benchmark"))
