"""Substring dedup by MinHash banding of overlapping paragraphs.

A paragraph is a run of ``MIN_WORDS`` words.  Its start is chosen by winnowing words: of every ``WINNOW`` consecutive
words the sentence start with the least first-shingle hash, or the word with the least where no sentence starts.
Sentences end at ``. ! ?`` or a line break and may have any length.  So the choice depends on the words of a
passage alone (but for its first word, which may start a sentence in one place only): every run of
``WINNOW + MIN_WORDS`` = 51 words holds a paragraph that is cut alike wherever the run is pasted.  Of a longer passage
paragraphs alone (``repeats``) leave up to ``WINNOW`` words at either end, and ``WINNOW - MIN_WORDS`` between two paragraphs.
``passages`` looks at these words too, at every position: from each paragraph that occurs in several documents it goes on to the
left and to the right for as long as an earlier document with the same paragraph has the same words there, up to ``WINNOW`` words,
and no more can be left of a run before or after its paragraphs.  So a run of 51 words and more is cut to its last word.
Where all occurrences of a paragraph have the same words up to the next paragraph, they are cut without a comparison: what lies
beyond is looked at from there.  The words of the others are compared, those of a document's equal surroundings once.
Paragraphs collide when a band of
their MinHash registers is equal, collisions are decided by exact Jaccard similarity of the sets of
five-word shingles (``cluster``), and removals are clustered by components: a component's text stays in the
first document that has any of it, and goes everywhere else.  Overlapping removals of
a document are joined into spans.

Paragraphs of 16 different shingles that are similar and not equal share 15 of 17 (0.88, a change at one end): six bands of
seven registers miss such a pair with probability (1 - 0.882**7)**6 = 4 %, and a longer passage holds several paragraphs.
Paragraphs with a change inside are at 0.52 and rarely meet, which keeps bands small in families of near copies.  Equal paragraphs need no verification and are merged by their hash within each
batch, so a passage that fills a third of all rows sends a row or so a batch.  The texts are read three times: for bands, for the paragraphs that share
a band or occur again, and for the occurrences of those that go.

Words are runs without ASCII white space, A-Z lower-cased.  Defined cases: a document is an id and a text, so
repeated rows (same id and text) count as one document and texts without id are documents of their own; documents
are ordered by id, null first, then by hash of the text; null, empty and short texts
have no paragraphs; a text of any length is cut whole; extra columns are ignored (kept by the stage, whatever their names); an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cluster
from .minhash import Shingles
from .util import U64, drop_scratch, mix64, slices, table, write_scratch

MIN_WORDS = 20
WINNOW = 31
BANDS, ROWS = 6, 7
THRESHOLD = 0.8
#: Bytes of text whose paragraphs are held at once.
SLICE = 1 << 19
NO_ID = -(1 << 63)
#: Elements of one verification task.
CELL = 400_000
#: Surroundings of paragraphs that one task compares; those of a paragraph with more than twice as many go by hashes of the words.
PLACES = 16_000
_SALT = (mix64(np.arange(1, BANDS * ROWS + 1, dtype=U64)) >> U64(32)).astype(np.uint32)
_ODD = mix64(np.arange(101, ROWS + 101, dtype=U64)) | U64(1)


def sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """The least or greatest (``pick``) of every ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


class Paragraphs:
    """The chosen paragraphs of a batch: ``doc``, ``first`` and ``last`` word (last excluded) and content ``key``."""

    def __init__(self, texts: list[bytes]):
        self.shingles = s = Shingles(texts)
        w = s.words
        n = len(w.hash)
        self.doc = self.first = self.last = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.int64)
        if not n:
            return
        final = w.data[w.end - 1]
        lines = np.concatenate(([0], np.cumsum(w.data == 10)))
        begin = np.ones(n, bool)
        begin[1:] = (w.doc[1:] != w.doc[:-1]) | np.isin(final[:-1], (33, 46, 63)) | (lines[w.start[1:]] > lines[w.end[:-1]])
        able = np.flatnonzero(np.arange(n) + MIN_WORDS <= w.first[w.doc + 1])
        if not len(able):
            return
        doc = w.doc[able]
        mark = s.run[able] >> U64(1) | np.where(begin[able], U64(0), U64(1 << 63))
        chosen = np.zeros(len(able), bool)
        if len(able) >= WINNOW:
            least = sliding(np.minimum, mark, WINNOW)
            least[doc[: len(least)] != doc[WINNOW - 1 :]] = 0
            edge = np.zeros(WINNOW - 1, U64)
            chosen = mark == sliding(np.maximum, np.concatenate((edge, least, edge)), WINNOW)
        head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        size = np.diff(np.append(head, len(doc)))
        chosen |= np.repeat(size < WINNOW, size) & (mark == np.repeat(np.minimum.reduceat(mark, head), size))
        self.first, self.last, self.doc = able[chosen], able[chosen] + MIN_WORDS, doc[chosen]
        total, fwd = s.total, s.fwd
        self.key = mix64((total[self.last] - total[self.first]) * fwd[self.first] ^ (self.last - self.first).astype(U64)).view(np.int64)

    def bands(self, at: np.ndarray) -> np.ndarray:
        """Band keys, one row a paragraph of ``at``, which ascends."""
        run, out = self.shingles.run, np.empty((len(at), BANDS), np.int64)
        # 32 bits of a shingle are enough for a register: what they confuse is a candidate more, never a link
        run, width = run.view(np.uint32)[::2].copy(), MIN_WORDS - self.shingles.k + 1
        for b in range(BANDS if len(at) else 0):
            h = np.full(len(at), (b + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, U64)
            for salt, odd in zip(_SALT[b * ROWS : (b + 1) * ROWS], _ODD, strict=True):
                h += sliding(np.minimum, (run ^ salt) * (salt | np.uint32(1)), width)[self.first[at]] * odd
            out[:, b] = (mix64(h) & ~U64(7) | U64(b)).view(np.int64)  # the band's number stands in the last bits
        return out

    def elements(self, at: np.ndarray) -> pa.Array:
        """Shingles of paragraphs as they stand; the verifying task takes their set."""
        return _binary(self.shingles.run[self.first[at][:, None] + np.arange(MIN_WORDS - self.shingles.k + 1)])

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each paragraph the first word of the one before it and the last (excluded) of the one after it, or the text's; hashes (32 bits)
        of the words from there up to the paragraph and from its end on, and of which of both it is."""
        total, fwd = self.shingles.total, self.shingles.fwd
        first, near = self.shingles.words.first, self.doc[1:] == self.doc[:-1]
        before, after = np.append(False, near), np.append(near, False)
        left = np.where(before, np.roll(self.first, 1), first[self.doc])
        right = np.where(after, np.roll(self.last, -1), first[self.doc + 1])
        short = lambda a, b, kind: (mix64((total[b] - total[a]) * fwd[a] ^ ((b - a) * 2 + kind).astype(U64)) >> U64(32)).astype(np.uint32).view(np.int32)
        return left, right, short(left, self.first, before), short(self.last, right, after)

    def chars(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters before each byte, and those before the text of each paragraph."""
        w = self.shingles.words
        chars = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))
        return chars, chars[w.offsets[self.doc]]

    def around(self, at: np.ndarray, side: int, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each paragraph in ``at``, the ``WINNOW`` words before it (side 0), nearest first, or after it: their hashes (32 bits), and how many
        characters it is from the paragraph to their start or end, -1 for words that the text has not."""
        w = self.shingles.words
        doc = self.doc[at]
        step = np.arange(WINNOW)
        word = self.last[at][:, None] + step if side else self.first[at][:, None] - 1 - step
        have = (word >= w.first[doc][:, None]) & (word < w.first[doc + 1][:, None])
        word = np.where(have, word, 0)
        if side:
            far = chars[w.end[word]] - chars[w.end[self.last[at] - 1]][:, None]
        else:
            far = chars[w.start[self.first[at]]][:, None] - chars[w.start[word]]
        return np.where(have, w.hash[word] >> U64(32), 0).astype(np.uint32), np.where(have, far, -1).astype(np.int32)


def _binary(rows: np.ndarray) -> pa.Array:
    """The bytes of each row of a matrix."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _matrix(col: pa.ChunkedArray | pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, width)


def _lists(values: np.ndarray, heads: np.ndarray) -> pa.Array:
    """Lists of int that begin at ``heads`` of ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.append(heads, len(values)).astype(np.int32)), pa.array(values.astype(np.int32)))


def _new(*cols: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    out = np.ones(len(cols[0]), bool)
    out[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return out


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in slices(batches, limit=SLICE):
        p = Paragraphs(texts)
        _, at = np.unique(p.key, return_index=True)
        at.sort()
        bands = p.bands(at)
        yield pa.record_batch({"key": np.repeat(p.key[at], BANDS), "band": bands.ravel()})


_FACTS = "key long, elems binary, doc_lo long, text_lo long, doc_hi long, text_hi long, n long, l_lo int, l_hi int, r_lo int, r_hi int"
_FOUND = "key long, side int, doc_id long, text_key long, spans array<int>, wide array<int>, words binary, far binary"
_SPAN = "doc_id long, text_key long, spans array<int>, kept_in long"


def _batch(schema: str, *cols) -> pa.RecordBatch:
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=[c.split()[0] for c in schema.split(", ")])


def _facts(sieve: Broadcast, again: Broadcast):
    """A row for each paragraph of a batch that ``again`` has or several of the batch's documents have: its first and last document, the number of occurrences
    that differ, the range of the hashes of the stretches beside it, and its elements where ``sieve`` has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, limit=SLICE):
            p = Paragraphs(texts)
            if not len(p.key):
                continue
            ids, text = (part.column(c).to_numpy() for c in (0, 1))
            by = np.lexsort((text, ids))
            place = np.empty(len(ids), np.int64)
            place[by] = np.cumsum(_new(ids[by], text[by]))  # of documents, in their order
            _, _, left, right = p.stretches()
            order = np.lexsort((right, left, place[p.doc], p.key))
            key, doc, left, right = p.key[order], p.doc[order], left[order], right[order]
            rank = place[doc]
            head = np.flatnonzero(_new(key))
            tail = np.append(head[1:], len(key)) - 1
            some = np.flatnonzero(again.value.has(key[head]) | (rank[head] < rank[tail]))
            if not len(some):
                continue
            n = np.add.reduceat(_new(key, rank, left, right).astype(np.int64), head)[some]
            bounds = [pick.reduceat(x, head)[some] for x in (left, right) for pick in (np.minimum, np.maximum)]
            head, tail = head[some], tail[some]
            elems = p.elements(order[head]).take(pa.array(np.arange(len(head)), mask=~sieve.value.has(key[head])))
            yield _batch(_FACTS, key[head], elems, ids[doc[head]], text[doc[head]], ids[doc[tail]], text[doc[tail]], n, *bounds)

    return run


def _joined_spans(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """A list of starts and ends for each group (``group``: where one begins) with those that overlap joined; starts and ends ascend."""
    new = group.copy()
    new[1:] |= start[1:] > end[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return _lists(np.column_stack((start[first], end[last])).ravel(), 2 * np.flatnonzero(group[first]))


def _occurrences(wanted: Broadcast, mixed: tuple[Broadcast, Broadcast] | None):
    """Rows of two kinds.  Side 2: the spans of a paragraph in a document, as they are, and with the stretches at either side that all its occurrences share (``wide``).
    Sides 0 and 1, of paragraphs whose stretches there differ (``mixed``): different surroundings of a paragraph in a document, and where they begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, limit=SLICE):
            p = Paragraphs(texts)
            at = np.flatnonzero(wanted.value.has(p.key))
            if not len(at):
                continue
            w = p.shingles.words
            chars, base = p.chars()
            start, end = chars[w.start[p.first]] - base, chars[w.end[p.last - 1]] - base
            ids = lambda rows: [part.column(c).take(pa.array(p.doc[rows])) for c in (0, 1)]
            at = at[np.lexsort((p.first[at], p.key[at], p.doc[at]))]
            group = _new(p.doc[at], p.key[at])
            head = at[group]
            none, no_list = pa.nulls(len(head), pa.binary()), pa.nulls(len(head), pa.list_(pa.int32()))
            spans = _joined_spans(group, start[at], end[at])
            if mixed is None:
                yield _batch(_FOUND, p.key[head], np.full(len(head), 2, np.int32), *ids(head), spans, no_list, none, none)
                continue
            left, right, _, _ = p.stretches()
            differ = [m.value.has(p.key) for m in mixed]
            from_ = np.where(differ[0], start, chars[w.start[left]] - base)
            to = np.where(differ[1], end, chars[w.end[right - 1]] - base)
            yield _batch(_FOUND, p.key[head], np.full(len(head), 2, np.int32), *ids(head), spans, _joined_spans(group, from_[at], to[at]), none, none)
            for side in (0, 1):
                some = at[differ[side][at]]
                if not len(some):
                    continue
                words, far = p.around(some, side, chars)
                h = mix64(p.key[some].view(U64) + mix64(p.doc[some].astype(U64)))
                for d in range(WINNOW):
                    h = mix64(h * U64(0x9E3779B97F4A7C15) + (words[:, d].astype(U64) << U64(32) | far[:, d].astype(np.uint32)))
                order = np.argsort(h, kind="stable")
                begin = np.flatnonzero(_new(h[order]))
                one, head = order[begin], some[order[begin]]
                planes = far[one].view(np.uint8).reshape(-1, WINNOW, 4).transpose(0, 2, 1).reshape(-1, 4 * WINNOW)  # bytes that are mostly zero stand together
                edge = _lists((end if side else start)[some[order]], begin)
                yield _batch(_FOUND, p.key[head], np.full(len(head), side, np.int32), *ids(head), edge, pa.nulls(len(head), pa.list_(pa.int32())), _binary(words[one]), _binary(planes))

    return run


def _table(t: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Key, side, document, words, distances, and the numbers and places of the edges of surroundings."""
    words, planes = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8) for c in ("words", "far"))
    far = planes.reshape(-1, 4, WINNOW).transpose(0, 2, 1).copy().view(np.int32)[:, :, 0]
    edges = t.column("spans").combine_chunks() if isinstance(t, pa.Table) else t.column("spans")
    return *(t.column(c).to_numpy() for c in ("key", "side", "doc_id", "text_key")), words.view(np.uint32).reshape(-1, WINNOW), far, edges.value_lengths().to_numpy(), edges.flatten().to_numpy()


def _reached(rows: np.ndarray, far: np.ndarray, side: np.ndarray, count: np.ndarray, edge: np.ndarray) -> pa.Array:
    """Spans from all edges of ``rows`` on, ``far`` characters to their side."""
    begin = np.cumsum(count) - count
    n = count[rows]
    first = np.cumsum(n) - n
    spot = edge[np.repeat(begin[rows] - first, n) + np.arange(n.sum())]
    far, side = np.repeat(far, n), np.repeat(side[rows], n)
    return _lists(np.column_stack((np.where(side == 0, spot - far, spot), np.where(side == 0, spot, spot + far))).ravel(), 2 * first)


def _extended(t: pa.Table) -> pa.Table:
    """What goes before and after paragraphs, as far as an earlier document has the same words around the same paragraph."""
    t = t.take(pa.array(np.lexsort((t.column("text_key").to_numpy(), t.column("doc_id").to_numpy()))))
    key, side, doc, text, words, far, count, edge = _table(t)
    rank = np.cumsum(_new(doc, text))
    depth, kept = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    live, group = np.arange(len(doc)), np.unique(mix64(key.view(U64)) + side.astype(U64), return_inverse=True)[1]
    for d in range(WINNOW):
        some = far[live, d] >= 0
        live, group = live[some], group[some]
        if not len(live):
            break
        _, head, group = np.unique(group.astype(U64) << U64(32) | words[live, d], return_index=True, return_inverse=True)
        first = live[head][group]  # rows are in order of documents
        later = rank[live] > rank[first]
        depth[live[later]], kept[live[later]] = d + 1, doc[first[later]]
        on = np.bincount(group, weights=later)[group] > 0
        live, group = live[on], group[on]
    go = np.flatnonzero(depth)
    return pa.table({"doc_id": doc[go], "text_key": text[go], "spans": _reached(go, far[go, depth[go] - 1], side, count, edge), "kept_in": kept[go]})


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each number of words before or after a paragraph: a hash of paragraph, side and these words, and the spans up to there."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2_000):
            key, side, doc, text, words, far, count, edge = _table(batch.slice(lo, 2_000))
            h, head = mix64(key.view(U64) + side.astype(U64)), np.empty((len(key), WINNOW), U64)
            for d in range(WINNOW):
                h = head[:, d] = mix64(h * U64(0x9E3779B97F4A7C15) + words[:, d].astype(U64) + U64(1))
            row, d = np.nonzero(far >= 0)
            yield pa.record_batch({"head": head[row, d].view(np.int64), "doc_id": doc[row], "text_key": text[row], "spans": _reached(row, far[row, d], side, count, edge)})


def _extensions(around: DataFrame, gone: DataFrame, many: int, bins: int) -> DataFrame:
    """Spans that go on from paragraphs whose surroundings differ, ``around`` of :func:`_occurrences`; ``gone(k, n)`` counts them.

    A task compares all surroundings of some paragraphs word by word.  Of a paragraph with more than 2 ``many``, each number of words is a row,
    and the first document of equal rows is an aggregate: no task has all of them.
    """
    often = np.sort(gone.where(F.col("n") > 2 * many).select("k").toArrow().column(0).to_numpy())  # one in 2 ``many`` rows at most
    common = around.sparkSession.sparkContext.broadcast(often)

    def split(large: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(np.isin(b.column(0).to_numpy(), common.value) == large))

        return run

    around = around.where("side < 2").drop("wide")
    schema = ", ".join(c for c in _FOUND.split(", ") if not c.startswith("wide"))
    near = around.mapInArrow(split(False), schema) if len(often) else around
    spans = near.withColumn("home", F.pmod(F.xxhash64("key", "side"), F.lit(bins))).groupBy("home").applyInArrow(_extended, _SPAN)
    if not len(often):
        return spans
    heads = write_scratch(around.mapInArrow(split(True), schema).mapInArrow(_heads, "head long, doc_id long, text_key long, spans array<int>"), "heads")
    document = F.struct("doc_id", "text_key")
    # a table of its own, so that the join can split the rows of a common head
    least = write_scratch(heads.groupBy("head").agg(F.min(document).alias("lo"), F.max(document).alias("hi")).where("lo < hi").select(F.col("head").alias("h"), "lo"), "least")
    later = heads.join(least, heads["head"] == least["h"]).where(document > F.col("lo"))
    return spans.union(later.select("doc_id", "text_key", "spans", F.col("lo.doc_id").alias("kept_in")))


def _joined(t: pa.Table) -> pa.Table:
    """Join the overlapping spans of each document; a span names the smallest document that keeps its text."""
    doc, text, kept = (t.column(c).to_numpy() for c in ("doc_id", "text_key", "kept_in"))
    lists = t.column("spans").combine_chunks()
    n = lists.value_lengths().to_numpy() // 2
    start, end = lists.flatten().to_numpy().astype(np.int64).reshape(-1, 2).T
    doc, text, kept = np.repeat(doc, n), np.repeat(text, n), np.repeat(kept, n)
    order = np.lexsort((start, text, doc))
    doc, text, kept, start, end = doc[order], text[order], kept[order], start[order], end[order]
    group = _new(doc, text)
    step = np.cumsum(group) << 32  # a text has fewer characters than that
    reach = np.maximum.accumulate(end + step)
    new = group.copy()
    new[1:] |= start[1:] + step[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    spans = pa.StructArray.from_arrays([pa.array(x) for x in (start[first].astype(np.int32), (reach - step)[last].astype(np.int32), np.minimum.reduceat(kept, first) if len(first) else kept)], ["start", "end", "kept_in"])
    heads = np.flatnonzero(group[first])
    return pa.table({"doc_id": doc[group], "text_key": text[group], "spans": pa.ListArray.from_arrays(pa.array(np.append(heads, len(first)).astype(np.int32)), spans)})


def repeats(docs: DataFrame, threshold: float = THRESHOLD, cell: int = CELL) -> DataFrame:
    """Spans of repeated paragraphs: doc_id, text_key (xxhash64 of the text), spans array<struct<start, end, kept_in>>."""
    return _found(docs, threshold, cell)


def passages(docs: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, many: int = PLACES) -> DataFrame:
    """Spans to remove, as :func:`repeats` but whole: with the words around paragraphs that an earlier document has as well."""
    return _found(docs, threshold, cell, many)


def _found(docs: DataFrame, threshold: float, cell: int, many: int | None = None) -> DataFrame:
    source = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    send = docs.sparkSession.sparkContext.broadcast
    bands = source.select("text").mapInArrow(_bands, "key long, band long")
    facts = []

    def elems(sieve: Broadcast, again: Broadcast) -> DataFrame:
        facts.append(write_scratch(source.mapInArrow(_facts(sieve, again), _FACTS), "facts"))
        return facts[0].where("elems is not null").select("key", "elems")

    # a paragraph that two batches have meets itself in all its bands; one is enough to know it
    same = cluster.classes(bands, elems, threshold, "same", cell, repeated=F.col("band").bitwiseAND(F.lit(7)) == 0)
    lo, hi = F.min(F.struct("doc_lo", "text_lo")).alias("lo"), F.max(F.struct("doc_hi", "text_hi")).alias("hi")
    ends = facts[0].groupBy("key").agg(lo, hi, F.sum("n").alias("n"), (F.min("l_lo") < F.max("l_hi")).alias("left"), (F.min("r_lo") < F.max("r_hi")).alias("right"))
    ends = write_scratch(ends.join(same, "key", "left").where("lo < hi or root is not null").withColumn("class", F.coalesce("root", "key")), "ends")
    heads = ends.groupBy("class").agg(F.min("lo").alias("kept"), F.max("hi").alias("top")).where("kept < top")
    several = F.col("lo") < F.col("hi")
    gone = ends.join(heads, "class").select(F.col("key").alias("k"), "kept", "lo", F.when(several, F.col("n")).otherwise(0).alias("n"), *[(F.col(c) & several).alias(c) for c in ("left", "right")])
    gone = write_scratch(gone, "gone")
    total = gone.agg(F.sum("n")).first()[0] or 0
    bins = max(1, -(-total // (many or PLACES)))
    keys = lambda rows: send(cluster.Sieve(rows.select(F.col("k").alias("key"))))
    mixed = (keys(gone.where("left")), keys(gone.where("right"))) if many else None
    found = write_scratch(source.mapInArrow(_occurrences(keys(gone), mixed), _FOUND), "found")
    hits = found.where("side = 2").join(gone, F.col("key") == F.col("k"))
    later = (F.struct("doc_id", "text_key") > F.col("lo")) if many else F.lit(False)
    spans = F.when(later, F.col("wide")).when(F.struct("doc_id", "text_key") > F.col("kept"), F.col("spans")).alias("spans")
    hits = hits.select("doc_id", "text_key", spans, F.col("kept.doc_lo").alias("kept_in")).where("spans is not null")
    if many:
        hits = hits.union(_extensions(found, gone, many, bins))
    hits = hits.distinct().withColumn("home", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(bins)))
    spans = write_scratch(hits.groupBy("home").applyInArrow(_joined, "doc_id long, text_key long, spans array<struct<start:int,end:int,kept_in:long>>"), "spans")
    drop_scratch(same, ends, gone, found, *facts)
    return spans


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of their texts; ``n_chars``, where there is one, follows the text."""
    cols = docs.columns
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans"))
    both = docs.join(spans, (F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == spans["__id"]) & (F.xxhash64(docs["text"]) == spans["__key"]), "left")
    kept = F.expr(
        "aggregate(__spans, struct('' as done, 0 as at), (a, s) -> struct(concat(a.done, substr(text, a.at + 1, s.start - a.at)) as done, s.end as at),"
        " a -> concat(a.done, substr(text, a.at + 1)))"
    )
    whole = F.col("__spans").isNull()
    out = both.withColumn("text", F.when(whole, F.col("text")).otherwise(kept))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))
    return out.select(*cols)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages(table(spark, sf_dir, "documents")).select("doc_id", F.explode("spans").alias("s"))
    return found.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.kept_in").alias("kept_in"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages are cut from all documents but one."""
    return cut(docs, passages(docs))
