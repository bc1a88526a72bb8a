"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The agenda of a unit (a run of spaces and the word after it) holds every adjacent pair of pieces
whose join is a piece; the best-ranked, leftmost candidate is merged next.  A candidate is the span
triple (left start, boundary, right end) of an occurrence; it is skipped for good when a hash keyed by
(seed, doc_id, position of the unit, span) falls below ``dropout``.  So every occurrence of a word draws its own
segmentation, which any run reproduces.  No piece of the vocabulary crosses a space or a
line break (checked on load), so units are segmented on their own and the result is the same as one
agenda over the whole text.

What does not depend on the draw is shared: ``Agendas`` holds, for each distinct unit, the states its agenda can come
to, found as they are first needed.  A state knows its next candidate, the state after merging it and the
state after skipping it.  All occurrences of a batch walk these states together, one candidate a step,
each by its own hashes.  ``agenda`` is the plain heap version, used for very long units and in tests.

Spaces become U+2581, a leading one is added and dropped again on decoding; characters outside the
vocabulary, and U+2581 itself, become byte pieces, so every text decodes to itself.

Defined cases: null text counts as empty; the empty text has no pieces; null doc_id draws as 0;
repeated rows get equal pieces; a text of any length is encoded whole, a unit of more than ``LONG_UNIT``
symbols by the heap; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import U64, _powers, mix64, slices, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED, DROPOUT = 20240501, 0.1
LONG_UNIT = 40
#: Bytes of agenda states that one task keeps; beyond it they are found anew.
STATE_BYTES = 96 << 20
SPACE = "▁"
_NONE = np.int32(1 << 30)
_A, _B, _C = 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


class Vocabulary:
    """Pieces of a BPE model: joins of two pieces, byte pieces, and the bytes that each piece stands for."""

    def __init__(self, proto: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.size = n = sp.get_piece_size()
        self.kind = np.int16 if n < 1 << 15 else np.int32
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int32)
        self.raw: list[bytes] = []
        self.ids: dict[str, int] = {}
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            elif special[i]:
                self.raw.append(b"")
            else:
                if SPACE in p.lstrip(SPACE) or "\n" in p:
                    raise ValueError("a piece crosses a space or a line break")
                self.ids[p] = i
                self.raw.append(p.replace(SPACE, " ").encode())
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size
        self.raw_flat = np.frombuffer(b"".join(self.raw), np.uint8)
        score = [sp.get_score(i) for i in range(n)]
        rank = np.empty(n, np.int32)
        rank[np.argsort([-s for s in score], kind="stable")] = np.arange(n)
        self.rank, self.by_rank = rank, np.argsort(rank).astype(np.int32)
        keys, joined = [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    keys.append((a << 20) | b)
                    joined.append(i)
        order = np.argsort(keys)
        self.keys, self.joined = np.array(keys, np.int64)[order], np.array(joined, np.int32)[order]
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1 and p != SPACE:
                self.char[ord(p)] = i
        self.char[32] = self.ids[SPACE]
        self.pair = dict(zip(self.keys.tolist(), self.joined.tolist(), strict=True))

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the joined piece, or -1."""
        key = (a.astype(np.int64) << 20) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.joined[at], np.int32(-1))

    def symbols(self, unit: str) -> list[int]:
        """Start symbols of a unit: one a character, or one a byte for characters without a piece."""
        out = []
        for c in unit:
            i = int(self.char[ord(c)])
            out.extend([i] if i >= 0 else [int(self.byte_ids[b]) for b in c.encode()])
        return out

    def decode(self, ids) -> bytes:
        """The text of piece ids, the added leading space dropped."""
        return b"".join(map(self.raw.__getitem__, ids))[1:]

    def decode_all(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of many pieces in a row, and where each piece ends."""
        size = self.raw_size[ids]
        end = np.cumsum(size)
        at = np.repeat((self.raw_first[ids] - (end - size)).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        return self.raw_flat[at].tobytes(), end


def unit_keys(doc: int, n: int, seed: int) -> np.ndarray:
    """Keys of the first n units of a document."""
    base = np.array([(doc * 0x9E3779B97F4A7C15 ^ seed) & _MASK], U64)
    return mix64(mix64(base) + np.arange(n, dtype=U64) * U64(0xD1B54A32D192ED03))


def limit(dropout: float) -> int:
    """A candidate is skipped when its hash, of 64 bits, is below this."""
    return min(_MASK, round(dropout * 2.0**64))


def skipped(key: int, i: int, j: int, k: int, below: int) -> bool:
    """Whether the candidate with span (i, j, k) is skipped under a unit's key."""
    x = (key + i * _A + j * _B + k * _C) & _MASK
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & _MASK
    return (x ^ x >> 31) < below


def agenda(v: Vocabulary, unit: str, key: int, dropout: float) -> list[int]:
    """Segment one unit with a priority queue."""
    below = limit(dropout)
    sym = v.symbols(unit)
    n = len(sym)
    start, prev, nxt = list(range(n)), list(range(-1, n - 1)), [*range(1, n), -1]
    end, heap = list(range(1, n + 1)), []

    def offer(a: int) -> None:
        b = nxt[a]
        if b < 0:
            return
        joined = v.pair.get((sym[a] << 20) | sym[b])
        if joined is not None:
            heapq.heappush(heap, (int(v.rank[joined]), start[a], a, b, sym[a], sym[b], joined))

    for a in range(n - 1):
        offer(a)
    while heap:
        _, _, a, b, sa, sb, joined = heapq.heappop(heap)
        if sym[a] != sa or sym[b] != sb or nxt[a] != b:
            continue
        if skipped(key, start[a], start[b], end[b], below):
            continue
        sym[a], sym[b], end[a] = joined, -1, end[b]
        nxt[a] = nxt[b]
        if nxt[a] >= 0:
            prev[nxt[a]] = a
        if prev[a] >= 0:
            offer(prev[a])
        offer(a)
    return [s for s in sym if s >= 0]


class _States:
    """Agenda states of units of up to ``width`` symbols, as rows of growing arrays."""

    def __init__(self, v: Vocabulary, width: int):
        self.v, self.width, self.n = v, width, 0
        self.sym, self.rank, self.off = (np.zeros((0, w), k) for w, k in ((width + 1, v.kind), (width + 1, np.int32), (width + 2, np.uint8)))
        self.best, self.step = np.zeros(0, np.int32), np.zeros(0, U64)  # column of the next candidate (-1: none), its part of the hash
        self.after = np.zeros((0, 2), np.int32)  # the state after merging and after skipping it, -1 while unknown
        self.piece, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)  # of states without a candidate: where their pieces are
        self.pieces, self.filled = np.zeros(1024, np.int32), 0

    def bytes(self) -> int:
        return len(self.best) * (7 * self.width + 60) + self.pieces.nbytes

    def _room(self, more: int) -> None:
        need = self.n + more
        if need > len(self.best):
            cap = max(1024, need, len(self.best) * 3 // 2)
            for name in ("sym", "rank", "off", "best", "step", "after", "piece", "size"):
                old = getattr(self, name)
                new = np.empty((cap, *old.shape[1:]), old.dtype)
                new[: self.n] = old[: self.n]
                setattr(self, name, new)

    def _rate(self, sym: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Rank of the join of two neighbours, or _NONE."""
        a, b = sym[rows, cols].astype(np.int32), sym[rows, cols + 1].astype(np.int32)
        out = np.full(len(a), _NONE, np.int32)
        ok = np.flatnonzero((a >= 0) & (b >= 0))
        j = self.v.join(a[ok], b[ok])
        out[ok] = np.where(j >= 0, self.v.rank[j], _NONE)
        return out

    def add(self, sym: np.ndarray, rank: np.ndarray | None, off: np.ndarray) -> np.ndarray:
        """New states; their numbers."""
        n, hi = len(sym), self.width
        if rank is None:
            rr, cc = np.divmod(np.arange(n * hi), hi)
            rank = np.concatenate((self._rate(sym, rr, cc).reshape(n, hi), np.full((n, 1), _NONE, np.int32)), axis=1)
        self._room(n)
        at = np.arange(self.n, self.n + n)
        self.n += n
        rows = np.arange(n)
        best = rank.argmin(axis=1)
        done = rank[rows, best] >= _NONE
        self.sym[at], self.rank[at], self.off[at] = sym, rank, off
        i, j, k = (off[rows, best + d].astype(U64) for d in (0, 1, 2 - (best == hi)))
        self.step[at] = i * U64(_A) + j * U64(_B) + k * U64(_C)
        self.best[at] = np.where(done, -1, best)
        self.after[at] = -1
        x = sym[done]
        size = (x >= 0).sum(axis=1)
        flat = x[x >= 0]
        if self.filled + len(flat) > len(self.pieces):
            self.pieces = np.resize(self.pieces, max(self.filled + len(flat), 2 * len(self.pieces)))
        self.pieces[self.filled : self.filled + len(flat)] = flat
        self.size[at[done]] = size
        self.piece[at[done]] = self.filled + np.cumsum(size) - size
        self.filled += len(flat)
        return at

    def expand(self, state: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """The states that follow ``state`` when its candidate is skipped or merged."""
        hi, rows, cols = self.width, np.arange(len(state)), np.arange(self.width + 1)
        sym, rank, off, best = self.sym[state], self.rank[state], self.off[state], self.best[state].astype(np.int64)
        joined = self.v.by_rank[rank[rows, best]]
        rank[rows[skip], best[skip]] = _NONE
        m = np.flatnonzero(~skip)
        if len(m):
            s, r, o, b, row = sym[m], rank[m], off[m], best[m], np.arange(len(m))
            after = cols[None, :hi] > b[:, None]  # everything right of the merged pair moves one place to the left
            s[:, :hi] = np.where(after, s[:, 1:], s[:, :hi])
            r[:, :hi] = np.where(after, r[:, 1:], r[:, :hi])
            s[:, hi], r[:, hi] = -1, _NONE
            o[:, :-1] = np.where(cols[None, :] > b[:, None], o[:, 1:], o[:, :-1])
            s[row, b] = joined[m]
            r[row, b] = self._rate(s, row, b)
            left = np.flatnonzero(b > 0)
            r[left, b[left] - 1] = self._rate(s, left, b[left] - 1)
            sym[m], rank[m], off[m] = s, r, o
        return self.add(sym, rank, off)

    def walk(self, state: np.ndarray, key: np.ndarray, below: int) -> np.ndarray:
        """The last state of each occurrence that begins in ``state`` and draws by ``key``."""
        state, live = state.copy(), np.flatnonzero(self.best[state] >= 0)
        while len(live):
            now = state[live]
            skip = mix64(key[live] + self.step[now]) < U64(below) if below else np.zeros(len(live), bool)
            nxt = self.after[now, skip.astype(np.int8)]
            new = np.flatnonzero(nxt < 0)
            if len(new):
                pair, back = np.unique(now[new] * 2 + skip[new], return_inverse=True)
                made = self.expand(pair >> 1, (pair & 1).astype(bool))
                self.after[pair >> 1, pair & 1] = made
                nxt[new] = made[back]
            state[live] = nxt
            live = live[self.best[nxt] >= 0]
        return state


class Agendas:
    """Segments occurrences of units; keeps what its units' agendas have in common up to ``STATE_BYTES``."""

    WIDTHS = (6, 10, 16, 24, LONG_UNIT)

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT):
        self.v, self.dropout, self.below = vocabulary, dropout, limit(dropout)
        self.clear()

    def clear(self) -> None:
        self.pools = [_States(self.v, w) for w in self.WIDTHS]
        self.known: dict[int, int] = {}  # unit's hash: its first state, times the number of pools, plus its pool; -1: too long

    def _learn(self, chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """First states of new units."""
        size, code = end - start, np.empty(len(start), np.int64)
        row = np.repeat(np.arange(len(start)), size)
        at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        flat = chars[start[row] + at]
        ids = self.v.char[flat]
        odd = ids < 0
        if odd.any():  # characters without a piece are spelt in bytes
            c = flat[odd].astype(np.int64)
            more = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            many = np.ones(len(flat), np.int64)
            many[odd] = more
            spelt = np.frombuffer("".join(map(chr, c.tolist())).encode("utf-8", "surrogatepass"), np.uint8)
            row, ids = np.repeat(row, many), np.repeat(ids, many)
            ids[ids < 0] = self.v.byte_ids[spelt]
            size = np.bincount(row, minlength=len(start))
            at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        lo = 0
        for p, hi in enumerate(self.WIDTHS):
            chosen = np.flatnonzero((size > lo) & (size <= hi))
            lo = hi
            if not len(chosen):
                continue
            sym = np.full((len(chosen), hi + 1), -1, self.v.kind)
            mine = np.flatnonzero(np.isin(row, chosen)) if len(chosen) < len(size) else np.arange(len(row))
            sym[np.searchsorted(chosen, row[mine]), at[mine]] = ids[mine]
            off = np.minimum(np.arange(hi + 2)[None, :], size[chosen][:, None]).astype(np.uint8)
            code[chosen] = self.pools[p].add(sym, None, off) * len(self.pools) + p
        code[size > LONG_UNIT] = -1
        return code

    def segment(self, chars: np.ndarray, start: np.ndarray, end: np.ndarray, name: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all units in a row, and where each unit's end; ``name`` is a hash of its characters."""
        if sum(p.bytes() for p in self.pools) > STATE_BYTES:
            self.clear()
        names, first, back = np.unique(name, return_index=True, return_inverse=True)
        code = np.fromiter((self.known.get(x, -2) for x in names.tolist()), np.int64, len(names))
        new = np.flatnonzero(code == -2)
        if len(new):
            code[new] = self._learn(chars, start[first[new]], end[first[new]])
            self.known.update(zip(names[new].tolist(), code[new].tolist(), strict=True))
        code = code[back]
        size, parts = np.zeros(len(name), np.int64), []
        for p, pool in enumerate(self.pools):
            mine = np.flatnonzero((code >= 0) & (code % len(self.pools) == p))
            if len(mine):
                last = pool.walk(code[mine] // len(self.pools), key[mine], self.below)
                size[mine] = pool.size[last]
                parts.append((mine, pool, pool.piece[last]))
        odd = {}
        for i in np.flatnonzero(code == -1).tolist():
            unit = chars[start[i] : end[i]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            odd[i] = np.array(agenda(self.v, unit, int(key[i]), self.dropout), np.int32)
            size[i] = len(odd[i])
        bound = np.concatenate(([0], np.cumsum(size)))
        out = np.empty(bound[-1], np.int32)
        for mine, pool, at in parts:
            n = size[mine]
            run = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(bound[mine], n) + run] = pool.pieces[np.repeat(at, n) + run]
        for i, x in odd.items():
            out[bound[i] : bound[i + 1]] = x
        return out, bound


_CODE = mix64(np.arange(1 << 16, dtype=U64) + U64(0x2545F491))


class Encoder:
    """Encodes batches of texts."""

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED, dropout: float = DROPOUT):
        self.v, self.seed, self.agendas = vocabulary, seed, Agendas(vocabulary, dropout)

    def encode_flat(self, texts: list[str], ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and their bounds."""
        some = [" " + t if t else "" for t in texts]
        chars = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4")
        size = np.array([len(t) for t in some], np.int64)
        edge = np.concatenate(([0], np.cumsum(size)))
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        # a unit begins with a run of spaces, at a line break, after one, and with each text
        space, line = chars == 32, chars == 10
        begin = np.ones(len(chars), bool)
        begin[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        begin[edge[:-1][size > 0]] = True
        start = np.flatnonzero(begin)
        end = np.append(start[1:], len(chars))
        doc = np.searchsorted(edge, start, side="right") - 1
        count = np.bincount(doc, minlength=len(texts))
        key = np.concatenate([unit_keys(d, int(n), self.seed) for d, n in zip(ids, count, strict=True)])
        # polynomial hash of the characters of each unit
        fwd, back = _powers(len(chars) + 1)
        code = _CODE[chars & 0xFFFF] + (chars >> 16).astype(U64) * U64(0x9E3779B97F4A7C15)
        total = np.zeros(len(chars) + 1, U64)
        np.cumsum(code * back[: len(chars)], out=total[1:])
        name = mix64((total[end] - total[start]) * fwd[start] ^ (end - start).astype(U64) * U64(_C))
        flat, bound = self.agendas.segment(chars, start, end, name, key)
        return flat, bound[np.concatenate(([0], np.cumsum(count)))]

    def encode(self, texts: list[str], ids: list[int]) -> list[np.ndarray]:
        """Piece ids of each text."""
        flat, bound = self.encode_flat(texts, ids)
        return [flat[a:b] for a, b in zip(bound[:-1], bound[1:], strict=True)]


_VOCABULARIES: dict[int, Vocabulary] = {}


def _vocabulary(proto: bytes) -> Vocabulary:
    """The tables of a vocabulary file, made once in each Python worker; states of agendas last for one task only."""
    key = hash(proto)
    if key not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[key] = Vocabulary(proto)
    return _VOCABULARIES[key]


def encode(docs: DataFrame, model: str = MODEL, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and decode again: doc_id, n_chars, n_pieces, pieces and whether the text came back."""
    with open(model, "rb") as f:
        proto = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary file, of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(_vocabulary(proto.value), seed, dropout)
        for part, raw in slices(batches, limit=1 << 20):
            texts = [t.decode("utf-8") for t in raw]
            every, edges = enc.encode_flat(texts, [i or 0 for i in part.column(0).to_pylist()])
            data, end = enc.v.decode_all(every)
            bound = np.concatenate(([0], end))[edges].tolist()
            back = [data[a + 1 : b] == t for a, b, t in zip(bound[:-1], bound[1:], raw, strict=True)]
            flat = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(every))
            yield pa.record_batch({"doc_id": part.column(0), "n_chars": pa.array([len(t) for t in texts], pa.int64()), "n_pieces": pa.array(np.diff(edges)), "pieces": flat, "lossless": back})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_chars long, n_pieces long, pieces array<int>, lossless boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded(doc_id, pieces)`` back to ``(doc_id, text)``."""
    with open(model, "rb") as f:
        proto = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(proto.value)
        for b in batches:
            yield pa.record_batch({"doc_id": b.column(0), "text": pa.array([v.decode(x or []).decode("utf-8") for x in b.column(1).to_pylist()], pa.string())})

    return encoded.select("doc_id", "pieces").mapInArrow(run, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the pieces of every document that is left."""
    return encode(docs)
