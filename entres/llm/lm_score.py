"""LM scoring with a weighted backoff automaton.

Training n-grams become arcs and contexts become states.  A state h has an arc for every word seen
after it, with weight log10 P(w|h), and one failure arc to the state of its shortened context with
weight log10(kappa / (c(h) + kappa)); P is Dirichlet-smoothed,

    P(w|h) = (c(hw) + kappa * P(w|h')) / (c(h) + kappa),      P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)),

so a word without an arc costs exactly the failure weight plus its weight in the shorter state.  A text
is scored by one traversal from left to right that carries the state: it takes the arc of the word, or failure arcs until
a state has one, and goes to the longest known suffix.  ``kappa`` of each order is the one of ``GRID`` under which the training
tokens are likeliest when each is left out of the counts it is scored with.

Scale.  No table of n-grams is ever collected or broadcast.  Texts are dealt into blocks of about
``block_bytes``; a block sends the sorted hashes and training counts of its own distinct n-grams to
hash-range shards (so each n-gram is pre-aggregated per block and a hot word adds one entry per
block), the shards add up the counts and return the totals in the order they were sent, and each
block builds the part of the automaton that its texts can reach and walks it.  A block sends a shard one row, and only if it has
an n-gram for it, so rows never exceed distinct n-grams and blocks, however large the input; a row packs all n-grams of its
block and shard, about five bytes each.  Hashes are cut to ``hash_bits``, 20 bits beyond the number of tokens, so that an n-gram
meets another's count with a probability under one in a million.  A task holds one block or one shard.  Rows that repeat id and text are
folded into one with a number before they are dealt, so copies of one row do not pile up in one block.

Defined cases: null or empty text is the lone end token; null doc_id hashes as the empty text;
repeated rows are counted and returned each time; a text of any length is scored whole, in pieces that begin in the state
that the words before them lead to; extra columns are ignored; an empty table gives
no rows.  With no training text N = V = 0 and the base probability is 0.1 / 0.1 = 1.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import U64, Words, crc_mod, mix64, slices, table, write_scratch

END = 0x0E0D5EED0E0D5EED
START = 0x57A7757A7757A775
ORDER = 3
#: Values of kappa that are tried for bigrams, and for longer n-grams.
GRID = ((50.0, 200.0, 800.0), (1.0, 4.0, 16.0))
BLOCK_BYTES = 4 << 20
SMOOTH = 0.1
#: Longest piece of a text that is walked at once; longer texts are walked in several pieces side by side.
PIECE = 192


def pack(counts: np.ndarray) -> bytes:
    """Counts in one byte each; those of 255 and more follow in eight."""
    big = counts[counts >= 255]
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + big.astype("<u8").tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8", offset=n).astype(np.int64)
    return out


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted values, where one of each stands, and the place of every value among them; ``np.unique`` sorts stably for this, which is slower."""
    order = np.argsort(x)
    y = x[order]
    new = np.ones(len(y), bool)
    new[1:] = y[1:] != y[:-1]
    inverse = np.empty(len(y), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return y[new], order[new].astype(np.int32), inverse


def log10(x: np.ndarray) -> np.ndarray:
    """By the natural logarithm, which numpy has as vector code."""
    return np.log(x) * (1 / math.log(10))


class Grams:
    """Tokens of a block and its distinct n-grams, level by level, each with an index into its own level."""

    def __init__(self, texts: list[bytes], order: int, bits: int = 64):
        w = Words(texts)
        n = len(texts)
        self.n_tokens = w.count + 1
        self.last = np.cumsum(self.n_tokens) - 1
        self.doc = np.repeat(np.arange(n, dtype=np.int32), self.n_tokens)
        tok = np.empty(len(self.doc), U64)
        is_end = np.zeros(len(tok), bool)
        is_end[self.last] = True
        tok[is_end] = END
        tok[~is_end] = w.hash
        place = np.arange(len(tok)) - np.repeat(np.concatenate(([0], self.last[:-1] + 1)) if n else [], self.n_tokens).astype(np.int32)
        self.order = order
        # at[k][i]: hash of the k tokens that end at i, START filling in before the text
        at = {1: tok}
        for k in range(2, order + 1):
            before = np.empty_like(tok)
            before[1:] = at[k - 1][:-1]
            before[place == 0] = self.start_hash(k - 1)
            at[k] = mix64(before * U64(0x9E3779B97F4A7C15) + tok + U64(k))
        self.place = place
        self.keys, self.first, self.inverse = {}, {}, {}
        for k in at:
            self.keys[k], self.first[k], self.inverse[k] = distinct(at[k] >> U64(64 - bits))

    @staticmethod
    def start_hash(k: int) -> np.uint64:
        h = np.array([START], U64)
        for j in range(2, k + 1):
            h = mix64(h * U64(0x9E3779B97F4A7C15) + U64(START) + U64(j))
        return h[0]

    def counts(self, k: int, times: np.ndarray) -> np.ndarray:
        """Occurrences of each distinct k-gram, those of a document taken the given number of times."""
        return np.bincount(self.inverse[k], weights=times[self.doc], minlength=len(self.keys[k])).astype(np.int64)


def cuts(keys: np.ndarray, shards: int, bits: int = 64) -> np.ndarray:
    """Where the hash-range shards begin and end in sorted keys."""
    edges = np.array([(i << bits) // shards for i in range(shards)], dtype=U64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys: their low four bytes each, after the number of keys of each value of the rest."""
    high = (keys >> U64(32)).astype(np.int64)
    if not len(keys):
        return b""
    lo, n = int(high[0]), int(high[-1] - high[0]) + 1
    if n > 8 * len(keys):
        return b"\x01" + keys.astype("<u8").tobytes()
    head = pack(np.bincount(high - lo, minlength=n))
    return b"\x00" + np.array([lo, n, len(head)], "<i8").tobytes() + head + (keys & U64(0xFFFFFFFF)).astype("<u4").tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, U64)
    if data[0] == 1:
        return np.frombuffer(data, "<u8", offset=1).astype(U64)
    lo, n, size = np.frombuffer(data, "<i8", 3, offset=1).tolist()
    high = np.repeat(np.arange(lo, lo + n, dtype=U64), unpack(data[25 : 25 + size], n))
    return high << U64(32) | np.frombuffer(data, "<u4", offset=25 + size).astype(U64)


def _texts(t: pa.Table) -> list[bytes]:
    return [b if b is not None else b"" for b in t.column("text").cast(pa.binary()).to_pylist()]


_SENT = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("texts", pa.int64()), ("keys", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary()))])
_BACK = pa.schema([("block", pa.int64()), ("shard", pa.int64()), ("totals", pa.list_(pa.binary())), ("tokens", pa.int64()), ("words", pa.int64()), ("texts", pa.int64())])


def _times(t: pa.Table) -> np.ndarray:
    """How often each row counts in training."""
    return np.where(np.asarray(t.column("held_out")), 0, t.column("copies").to_numpy())


def _count(shards: int, order: int, bits: int):
    def run(t: pa.Table) -> pa.Table:
        g = Grams(_texts(t), order, bits)
        times, block = _times(t), t.column("block")[0].as_py()
        edge = {k: cuts(g.keys[k], shards, bits) for k in g.keys}
        count = {k: g.counts(k, times) for k in g.keys}
        some = [s for s in range(shards) if s == 0 or any(e[s] < e[s + 1] for e in edge.values())]
        rows = {"shard": some, "block": [block] * len(some), "texts": [int(times.sum()) if s == 0 else 0 for s in some]}
        rows["keys"] = [[pack_keys(g.keys[k][edge[k][s] : edge[k][s + 1]]) for k in edge] for s in some]
        rows["counts"] = [[pack(count[k][edge[k][s] : edge[k][s + 1]]) for k in edge] for s in some]
        return pa.table(rows, schema=_SENT)

    return run


def _merge(order: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        out: list[list] = [[] for _ in range(t.num_rows)]
        tokens = words = 0
        for k in range(order):
            keys = [unpack_keys(x[k].as_py()) for x in t.column("keys")]
            sizes = [len(x) for x in keys]
            counts = np.concatenate([unpack(x[k].as_py(), n) for x, n in zip(t.column("counts"), sizes, strict=True)])
            _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            del keys
            total = np.bincount(inverse, weights=counts).astype(np.int64) if len(counts) else counts
            if k == 0:
                tokens, words = int(total.sum()), int((total > 0).sum())
            at = 0
            for i, n in enumerate(sizes):
                out[i].append(pack(total[inverse[at : at + n]]))
                at += n
        n = t.num_rows
        return pa.table({"block": t.column("block"), "shard": t.column("shard"), "totals": out, "tokens": [tokens] * n, "words": [words] * n, "texts": [sum(t.column("texts").to_pylist())] * n}, schema=_BACK)

    return run


class Automaton:
    """The part of the backoff automaton that one block's texts can reach.

    State 0 is the empty context; state 1 + base[k] + i is the i-th distinct k-word context of the block's n-grams, and
    the last states are the runs of start marks.  Arcs are the block's n-grams with a training count; those of a state and word are
    found by binary search in ``arc_key``.
    """

    def __init__(self, g: Grams, total: dict[int, np.ndarray], tokens: int, words: int, texts: int):
        self.g, self.total, self.tokens, self.words = g, total, tokens, words
        self.memo: dict[tuple[float, ...], tuple] = {}
        order, n = g.order, len(g.doc)
        # states: the k-grams of the block, 0 < k < order, then the start contexts of each length
        base, at = {}, 1
        for k in range(1, order):
            base[k], at = at, at + len(g.keys[k])
        self.start = {k: at + k - 1 for k in range(1, order)}
        states = at + order - 1
        self.context = np.zeros(states, np.int64)  # c(h)
        self.fail = np.zeros(states, np.int32)
        self.depth = np.zeros(states, np.int8)
        for k in range(1, order):
            own = slice(base[k], base[k] + len(g.keys[k]))
            self.context[own], self.depth[own] = total[k], k
            self.fail[own] = base[k - 1] + g.inverse[k - 1][g.first[k]] if k > 1 else 0
            self.context[self.start[k]], self.depth[self.start[k]] = texts, k
            self.fail[self.start[k]] = self.start[k - 1] if k > 1 else 0
        # the state of the last k tokens before a token
        def before(k: int, i: np.ndarray) -> np.ndarray:
            if k == 0:
                return np.zeros(len(i), np.int64)
            return np.where(g.place[i] > 0, base[k] + g.inverse[k][i - 1], self.start[k])

        # arcs, level by level: state, word, count, and the arc of the same word in the state's failure state
        state, word, count, lower, level, target, offset = [], [], [], [], [], [], {}
        size = 0
        for k in range(1, order + 1):
            i = g.first[k]
            offset[k], size = size, size + len(i)
            state.append(before(k - 1, i).astype(np.int32))
            word.append(g.inverse[1][i])
            count.append(total[k])
            lower.append((offset[k - 1] + g.inverse[k - 1][i] if k > 1 else np.full(len(i), -1)).astype(np.int32))
            level.append(np.full(len(i), k, np.int8))
            target.append((base[min(k, order - 1)] + g.inverse[min(k, order - 1)][i] if order > 1 else np.zeros(len(i))).astype(np.int32))
        self.state, self.word, self.count, self.lower, self.level, self.target = (np.concatenate(x) for x in (state, word, count, lower, level, target))
        # only n-grams seen in training are arcs; at the root every word has one (a word never seen has the weight of count 0)
        arc = np.flatnonzero((self.count > 0) | (self.level == 1))
        key = self.state[arc] * np.int64(len(g.keys[1]) + 1) + self.word[arc]
        turn = np.argsort(key)  # no two are equal
        self.arc_key, self.arc = key[turn], arc[turn].astype(np.int32)
        # a state that was never seen in training is the state of its longest suffix that was
        self.known = np.arange(states, dtype=np.int32)
        for k in range(1, order):
            own = np.append(np.arange(base[k], base[k] + len(g.keys[k])), self.start[k])
            unseen = own[self.context[own] == 0]
            self.known[unseen] = self.known[self.fail[unseen]]

    def traverse(self) -> tuple[np.ndarray, np.ndarray]:
        """Walk all texts from left to right.  For each token the arc taken and the state in which the walk stood before it.

        Pieces of up to ``PIECE`` tokens go side by side.  A piece inside a text begins order - 1 tokens early, by which
        its state is that of the whole text, since a state is a suffix of order - 1 words.
        """
        g = self.g
        n, early = len(g.doc), g.order - 1
        begin = np.flatnonzero(g.place % PIECE == 0)
        end = np.append(begin[1:], n)
        whole = g.place[begin] == 0
        at = np.where(whole, begin, begin - early)
        now = np.where(whole, self.known[self.start[early]] if early else 0, 0)
        word, width = g.inverse[1], np.int64(len(g.keys[1]) + 1)
        taken, stood = np.empty(n, np.int32), np.empty(n, np.int32)
        order = np.argsort(at - end, kind="stable")  # longest first, so that those at work are a prefix
        at, end, begin, now = at[order], end[order], begin[order], now[order]
        length = end - at
        for t in range(int(length.max()) if len(length) else 0):
            live = int(np.searchsorted(-length, -t, side="left"))
            i = at[:live] + t
            stood[i] = now[:live]
            s, w = now[:live].astype(np.int64), word[i]
            found = np.empty(live, np.int64)
            todo = np.arange(live)
            while len(todo):
                key = s[todo] * width + w[todo]
                p = np.minimum(np.searchsorted(self.arc_key, key), len(self.arc_key) - 1)
                hit = self.arc_key[p] == key
                found[todo[hit]] = self.arc[p[hit]]
                todo = todo[~hit]
                s[todo] = self.known[self.fail[s[todo]]]
            taken[i] = found
            now[:live] = self.known[self.target[found]]
        return taken, stood

    def weights(self, kappa: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Weight of every arc, and of the failure arcs from every state down to the root.

        A level depends on the kappas up to its own alone: what kappas with the same beginning share is made once.
        """
        low, low_down = self._level(kappa)
        return np.concatenate([self._level(kappa[:k])[0][1] for k in range(len(kappa))] + [low[1]]), low_down

    def _level(self, kappa: tuple[float, ...]) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Probability and weight of the arcs of level 1 + len(kappa), and the weights of the failure arcs of all states up to that depth."""
        if kappa in self.memo:
            return self.memo[kappa]
        k = len(kappa) + 1
        lo, hi = np.searchsorted(self.level, (k, k + 1))
        c = self.count[lo:hi]
        if k == 1:
            p, down = (c + SMOOTH) / (self.tokens + SMOOTH * (self.words + 1)), np.zeros(len(self.fail))
        else:
            (before, _), down = self._level(kappa[:-1])
            x, h = kappa[-1], self.context[self.state[lo:hi]]
            low = before[self.lower[lo:hi] - (lo - len(before))]
            p = np.where(h > 0, (c + x * low) / (h + x), low)
            own = np.flatnonzero(self.depth == k - 1)
            down = down.copy()
            down[own] = np.where(self.context[own] > 0, log10(x / (self.context[own] + x)), 0.0) + down[self.fail[own]]
        out = (p, log10(p)), down
        if k < self.g.order:  # the last level is of one kappa only
            self.memo[kappa] = out
        return out

    def left_out(self, times: np.ndarray, grid: list[tuple[float, ...]]) -> np.ndarray:
        """Log10 probability of the training tokens, each left out of the counts it is scored with, for each kappa of the grid."""
        g = self.g
        use = times[g.doc] > 0
        often = times[g.doc][use]
        c = self.total[1][g.inverse[1][use]]
        root = (np.maximum(c - 1, 0) + SMOOTH) / (max(self.tokens - 1, 0) + SMOOTH * (self.words + 1))
        levels = []
        for k in range(2, g.order + 1):
            h = np.empty(len(g.doc), np.int64)
            h[1:] = self.total[k - 1][g.inverse[k - 1][:-1]]
            h[g.place == 0] = self.context[self.start[k - 1]]
            levels.append((self.total[k][g.inverse[k][use]] - 1, h[use] - 1))
        out, memo = [], {(): root}
        for kappa in grid:
            for k in range(1, len(kappa) + 1):
                if kappa[:k] not in memo:
                    arc, h = levels[k - 1]
                    memo[kappa[:k]] = np.where(h > 0, (np.maximum(arc, 0) + kappa[k - 1] * memo[kappa[: k - 1]]) / (np.maximum(h, 0) + kappa[k - 1]), memo[kappa[: k - 1]])
            out.append(float((log10(memo[kappa]) * often).sum()))
        return np.array(out)


def _grid(order: int) -> list[tuple[float, ...]]:
    return list(itertools.product(*[GRID[k > 0] for k in range(order - 1)]))


def _score(shards: int, order: int, bits: int, kappa: tuple[float, ...] | None):
    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        g = Grams(_texts(docs), order, bits)
        back = back.sort_by("shard")
        edge = {k: cuts(g.keys[k], shards, bits) for k in g.keys}
        total = {k: np.zeros(len(g.keys[k]), np.int64) for k in g.keys}
        for s, x in zip(back.column("shard").to_pylist(), back.column("totals"), strict=True):
            for k in g.keys:
                total[k][edge[k][s] : edge[k][s + 1]] = unpack(x[k - 1].as_py(), edge[k][s + 1] - edge[k][s])
        stats = back.slice(0, 1).to_pylist()[0]  # of shard 0: the sums over all shards are made outside
        m = Automaton(g, total, stats["all_tokens"], stats["all_words"], stats["all_texts"])
        taken, stood = m.traverse()
        n = docs.num_rows
        add = lambda x: np.bincount(g.doc, weights=x, minlength=n)
        grid = [kappa] if kappa else _grid(order)
        fell = np.flatnonzero(stood != m.state[taken])  # only these took failure arcs
        above, below = stood[fell], m.state[taken[fell]]
        root = g.inverse[1]  # arcs of level 1 come first, in the order of the words
        scores = []
        for x in grid:
            weight, down = m.weights(x)
            if not scores:
                base = add(weight[root])
            x = weight[taken]
            x[fell] += down[above] - down[below]
            scores.append(add(x))
        return pa.table(
            {
                "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "copies": docs.column("copies"), "n_tokens": g.n_tokens, "n_known": add((total[1][g.inverse[1]] > 0).astype(float)).astype(np.int64),
                "train_tokens": np.full(n, stats["all_tokens"]), "base_score": base, "scores": pa.array(list(np.stack(scores, axis=1)), pa.list_(pa.float64())),
                "left_out": pa.array([m.left_out(_times(docs), grid).tolist(), *[None] * (n - 1)], pa.list_(pa.float64())),
            },
        )

    return run


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that repeat id and text become one with their number, within each piece of a batch."""
    for part, _ in slices(batches, limit=4 << 20):
        t = pa.table({"doc_id": part.column(0), "text": pc.fill_null(part.column(1), "")}).append_column("n", pa.array(np.ones(part.num_rows, np.int64)))
        t = t.group_by(["doc_id", "text"], use_threads=False).aggregate([("n", "sum")]).select(["doc_id", "text", "n_sum"])
        yield from t.rename_columns(["doc_id", "text", "copies"]).combine_chunks().to_batches()


SCORED = "doc_id long, held_out boolean, copies long, n_tokens long, n_known long, train_tokens long, base_score double, scores array<double>, left_out array<double>"


def score_texts(docs: DataFrame, held_out: Callable[[str], Column], order: int = ORDER, kappa: tuple[float, ...] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every text of ``docs(doc_id, text)``; ``held_out("doc_id")`` is true for rows that are not learnt from.

    ``kappa`` has a value for each order from 2 on; without it they are chosen from ``GRID``.
    """
    size, rows = docs.select(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    size = size or 0
    blocks = max(1, -(-size // block_bytes))
    bits = min(64, max(40, (order * (size + rows)).bit_length() + 18))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fold, "doc_id long, text string, copies long")
    dealt = source.withColumn("held_out", held_out("doc_id")).withColumn("block", F.pmod(F.xxhash64("doc_id", "text", "copies"), F.lit(blocks)))
    sent = dealt.groupBy("block").applyInArrow(_count(blocks, order, bits), "shard long, block long, texts long, keys array<binary>, counts array<binary>")
    back = sent.groupBy("shard").applyInArrow(_merge(order), "block long, shard long, totals array<binary>, tokens long, words long, texts long")
    back = write_scratch(back, "totals")
    sums = back.groupBy("shard").agg(F.max("tokens").alias("tokens"), F.max("words").alias("words"), F.max("texts").alias("texts")).agg(F.sum("tokens"), F.sum("words"), F.sum("texts")).first()
    back = back.select("block", "shard", "totals", *[F.lit(x or 0).cast("long").alias(f"all_{n}") for n, x in zip(("tokens", "words", "texts"), sums, strict=True)])
    scored = write_scratch(dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_score(blocks, order, bits, kappa), SCORED), "scores")
    grid = [kappa] if kappa else _grid(order)
    total = scored.where("left_out is not null").agg(*[F.sum(F.col("left_out")[i]).alias(f"g{i}") for i in range(len(grid))]).first()
    best = max(range(len(grid)), key=lambda i: (total[i] if total[i] is not None else 0.0, -i))
    again = scored.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return again.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", F.col("scores")[best].alias("score"), F.array(*[F.lit(float(x)) for x in grid[best]]).alias("kappa"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, lambda c: crc_mod(c, 10) == 0)
