"""Links and connected components of near-duplicate items, without pair explosion.

An item is (key long, bands); its elements, a set of 64-bit hashes, come from a second scan.  Only pairs
that share a band are ever compared, and their Jaccard similarity is exact.

1. *Stars.*  One of a band's items is its centre (see ``groups``), and every item is compared with the
   centres of its bands: as many comparisons as band rows, however large a group is.  Items that are
   not similar to their centre form the band's next group, for ``ROUNDS`` rounds.  Items of many bands need not meet all their centres:
   see ``thin``.
2. *The rest.*  Jaccard distance is a metric: if a is within 1 - t of a centre and r is not within
   2 (1 - t) of it, then a and r cannot be linked.  So what stars leave open are items between those
   distances, against the items near that centre, and groups that are still there after the last
   round.  Of these only pairs whose components differ are looked at, in tasks of bounded size.

The components of all links found are those of all similar pairs that share a band.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .util import U64, drop_scratch, mix64, write_scratch

#: Elements that one verification task takes from each side.
CELL = 400_000
#: Rounds of stars before what is left of a band's items is compared in cells.
ROUNDS = 2
#: Pairs of postings that a task holds at once.
PAIRS = 4_000_000


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)`` as (key, root); nodes without edges are absent.

    Rounds of contraction: every node points to its smallest neighbour or itself, pointers are
    followed twice, and the edges between different pointers make the next, smaller graph.  Keys are
    hashes, so a round removes a share of the nodes whatever the shape (a star or a clique takes one round) and
    the tables shrink geometrically; they are written to the shared folder, and the driver sees only
    whether edges are left.  At the end the pointers are composed from the last round to the first.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).where("u != v")
    both = write_scratch(both.distinct(), f"{name}-edges")
    steps = []
    while True:
        low = write_scratch(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), f"{name}-low")
        follow = low.select(F.col("u").alias("p"), F.col("p").alias("q"))
        point = write_scratch(low.join(follow, "p").select("u", F.col("q").alias("p")), f"{name}-point")
        steps.append(point)
        to = point.select(F.col("u").alias("v"), F.col("p").alias("q"))
        nxt = both.join(point, "u").join(to, "v").select(F.col("p").alias("u"), F.col("q").alias("v")).where("u != v").distinct()
        nxt = write_scratch(nxt, f"{name}-edges")
        drop_scratch(both, low)
        both = nxt
        if both.isEmpty():
            break
    root = steps[-1]
    for point in reversed(steps[:-1]):
        up = root.select(F.col("u").alias("p"), F.col("p").alias("q"))
        root = point.join(up, "p", "left").select("u", F.coalesce("q", "p").alias("p"))
    out = write_scratch(root.select(F.col("u").alias("key"), F.col("p").alias("root")), f"{name}-roots")
    drop_scratch(both, *steps)
    return out


def groups(bands: DataFrame, central: bool = False, repeated: Column | None = None) -> DataFrame:
    """``bands(key, band)`` to (band, key, centre), for bands of two and more items; the centre is the smallest key.

    One exchange by band serves the minimum, the join and the distinct rows.  With ``central`` the centre is the item whose
    bands have the most items in all, then the smallest key: in a family of near copies that is the text they come from, the same in nearly all
    bands and similar to every copy, while a copy is often too far from the others.  With ``repeated``, a condition on bands, items that occur more
    than once and are alone in such a band come too, without a centre.
    """
    dealt = bands.where("band is not null and key is not null").repartition("band")
    centre = dealt.groupBy("band").agg(F.min("key").alias("centre"), F.max("key").alias("top"), F.count(F.lit(1)).alias("n"))
    if repeated is not None:
        centre = centre.where((F.col("centre") < F.col("top")) | (F.col("n") > 1) & repeated).withColumn("centre", F.when(F.col("centre") < F.col("top"), F.col("centre")))
    else:
        centre = centre.where("centre < top")
    if not central:
        # few of many bands are left: a table of them spares sorting all rows
        return dealt.join(centre.select("band", "centre").hint("shuffle_hash"), "band").select("band", "key", "centre").distinct()
    shared = dealt.join(centre.select("band", "n"), "band").select("band", "key", "n").distinct()
    shared = shared.withColumn("often", F.sum("n").over(W.partitionBy("key"))).select("band", "key", "often").repartition("band")
    centre = shared.groupBy("band").agg(F.min(F.struct(-F.col("often"), "key")).getField("key").alias("centre"))
    return shared.join(centre, "band").select("band", "key", "centre")


def _sets(elems: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All elements in one array, each set sorted and without repeats, and the bounds of the sets."""
    flat = np.frombuffer(b"".join(elems), U64)
    row = np.repeat(np.arange(len(elems)), [len(e) // 8 for e in elems])
    order = np.lexsort((flat, row))
    flat, row = flat[order], row[order]
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (row[1:] != row[:-1])
    flat, row = flat[new], row[new]
    return flat, np.searchsorted(row, np.arange(len(elems) + 1))


def _distinct(t: pa.Table, *names: str) -> pa.Table:
    """One row for each value of the named long columns."""
    cols = [t.column(n).to_numpy() for n in names]
    order = np.lexsort(cols)
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in cols], axis=0)
    return t.take(pa.array(order[new]))


def _judge(t: pa.Table) -> pa.Table:
    """Exact similarity of each member of a star with its centre; rows (star, key, elems), the centre's key is the star's."""
    t = _distinct(t, "star", "key")
    star, key = t.column("star").to_numpy(), t.column("key").to_numpy()
    flat, edge = _sets(t.column("elems").to_pylist())
    size = np.diff(edge)
    tag = np.repeat(mix64(star.view(U64)), size)
    tagged = mix64(flat ^ tag) + tag  # an element within its star
    middle = star == key
    centre = np.sort(tagged[np.repeat(middle, size)])
    found = np.zeros(len(flat) + 1, np.int64)
    if len(centre):
        at = np.minimum(np.searchsorted(centre, tagged), len(centre) - 1)
        np.cumsum(centre[at] == tagged, out=found[1:])
    over = found[edge[1:]] - found[edge[:-1]]
    order = np.flatnonzero(middle)[np.argsort(star[middle])]
    mine = order[np.minimum(np.searchsorted(star[order], star), max(0, len(order) - 1))] if len(order) else np.zeros(len(star), np.int64)
    # a star whose centre sits in another part of it has been dealt a copy of the centre; without one nothing is said
    ok = ~middle & (star[mine] == star) if len(order) else np.zeros(len(star), bool)
    j = over / np.maximum(size + size[mine] - over, 1)
    return pa.table({"a": key[ok], "b": star[ok], "j": j[ok]})


def judged(edges: DataFrame, elems: DataFrame, name: str, cell: int) -> DataFrame:
    """``edges(a, b)`` with the exact similarity ``j``; b is the centre of a star of a's.

    Small stars share a task up to ``cell`` elements, a larger one is dealt to several, each with a copy of its centre.
    """
    sized = edges.join(elems.select(F.col("key").alias("a"), "size"), "a")
    total = sized.agg(F.sum("size")).first()[0] or 0
    bins = max(1, -(-2 * total // cell))
    # only stars that need splitting, as a table of its own: the join can then split the rows of a large one
    large = write_scratch(sized.groupBy("b").agg(F.ceil(F.sum("size") / F.lit(cell)).cast("int").alias("parts")).where("parts > 1"), f"{name}-large")
    parts = F.coalesce("parts", F.lit(1)).alias("parts")
    home = F.when(F.col("parts") > 1, F.col("star")).otherwise(F.pmod(F.xxhash64("star"), F.lit(bins))).alias("home")
    members = edges.join(large, "b", "left").select("a", F.col("b").alias("star"), parts)
    members = members.select(F.col("a").alias("key"), "star", home, F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    centres = edges.select("b").distinct().join(large, "b", "left").select(F.col("b").alias("star"), parts)
    centres = centres.select(F.col("star").alias("key"), "star", home, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = elems.join(members.union(centres).hint("merge"), "key").select("home", "part", "star", "key", "elems")
    out = write_scratch(met.groupBy("home", "part").applyInArrow(_judge, "a long, b long, j double"), f"{name}-judged")
    drop_scratch(large)
    return out


def links(flat: np.ndarray, edge: np.ndarray, side: np.ndarray, root: np.ndarray, threshold: float, bands: list[list[int]]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets with similarity of at least ``threshold`` whose roots differ
    and that share one of ``bands``.

    Where ``side`` has two values only pairs across them are looked at.  Overlaps of one item with all
    earlier ones are counted over the postings of its elements; items of the commonest root come first
    and are not compared with each other.
    """
    n, size = len(edge) - 1, np.diff(edge)
    _, label, often = np.unique(root, return_inverse=True, return_counts=True)
    place = np.lexsort((label, -often[label]))  # the rank-th item
    rank = np.empty(n, np.int64)
    rank[place] = np.arange(n)
    first_label = label[place[0]] if n else -1
    who = rank[np.repeat(np.arange(n), size)]
    order = np.lexsort((who, flat))
    post = who[order]
    _, slot, df = np.unique(flat, return_inverse=True, return_counts=True)
    first = np.cumsum(df) - df
    seen = np.empty(len(flat), np.int64)  # how many postings of each element precede this item
    seen[order] = np.arange(len(flat)) - np.repeat(first, df)
    across = len(np.unique(side)) > 1
    parent = np.arange(n)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i in place:
        if label[i] == first_label:
            continue
        s, c = slot[edge[i] : edge[i + 1]], seen[edge[i] : edge[i + 1]]
        s, c = s[c > 0], c[c > 0]
        if not len(s) or len(s) < threshold * size[i]:
            continue
        at = np.repeat(first[s] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        over = np.bincount(post[at], minlength=1)
        r = np.flatnonzero(over)
        j = place[r]
        ok = (over[r] >= threshold * (size[i] + size[j] - over[r]) - 1e-9) & (label[j] != label[i])
        if across:
            ok &= side[j] != side[i]
        for k in j[ok]:
            a, b = find(int(i)), find(int(k))
            if a != b and not set(bands[i]).isdisjoint(bands[k]):
                parent[max(a, b)] = min(a, b)
                out.append((int(i), int(k)))
    return out


def links_within(flat: np.ndarray, edge: np.ndarray, home: np.ndarray, side: np.ndarray, root: np.ndarray, threshold: float, bands: list[list[int]]) -> list[tuple[int, int]]:
    """As :func:`links` for many homes at once; pairs of one home only.  A home whose postings make more than ``PAIRS`` pairs goes to :func:`links`."""
    size = np.diff(edge)
    row = np.repeat(np.arange(len(home)), size)
    order = np.lexsort((row, flat, home[row]))
    row, value, at = row[order], flat[order], home[row[order]]
    new = np.ones(len(row), bool)
    new[1:] = (at[1:] != at[:-1]) | (value[1:] != value[:-1])
    begin = np.flatnonzero(new)
    back = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))  # earlier postings of the element
    heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
    cost = np.add.reduceat(back, heads) if len(heads) else heads
    bound = np.append(heads, len(row))
    parent: dict[int, int] = {}

    def find(i: int) -> int:
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    out, lo = [], 0
    while lo < len(heads):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(cost[lo:]), PAIRS, side="right")))
        if cost[lo] > PAIRS:
            rows = np.flatnonzero(home == at[heads[lo]])
            some = np.concatenate([flat[edge[i] : edge[i + 1]] for i in rows])
            cut = np.concatenate(([0], np.cumsum(size[rows])))
            out += [(int(rows[i]), int(rows[j])) for i, j in links(some, cut, side[rows], root[rows], threshold, [bands[i] for i in rows])]
            lo += 1
            continue
        part = slice(bound[lo], bound[hi])
        lo = hi
        c = back[part]
        j = np.repeat(row[part], c)
        i = row[np.repeat(np.arange(part.start, part.stop) - c - (np.cumsum(c) - c), c) + np.arange(c.sum())]
        open_ = root[i] != root[j]
        open_ &= (side[i] != side[j]) | (side[i] == 2)
        code, over = np.unique(i[open_].astype(np.int64) << 32 | j[open_], return_counts=True)
        i, j = code >> 32, code & 0xFFFFFFFF
        ok = over >= threshold * (size[i] + size[j] - over) - 1e-9
        for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
            a, b = find(x), find(y)
            if a != b and not set(bands[x]).isdisjoint(bands[y]):
                parent[max(a, b)] = min(a, b)
                out.append((x, y))
    return out


def _compare(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        t = _distinct(t, "key", "side", "home")
        key, side, root, home = (t.column(c).to_numpy() for c in ("key", "side", "root", "home"))
        flat, edge = _sets(t.column("elems").to_pylist())
        pairs = links_within(flat, edge, home, side, root, threshold, t.column("bands").to_pylist())
        return pa.table({"a": pa.array([int(key[i]) for i, _ in pairs], pa.int64()), "b": pa.array([int(key[j]) for _, j in pairs], pa.int64())})

    return run


def compared(cells: DataFrame, elems: DataFrame, threshold: float, cell: int) -> DataFrame:
    """Links between the items of each home of ``cells(home, side, key, root, bands)`` whose roots differ and that share a band.

    Side 0 meets side 1, and side 2 meets itself.  Small homes share a task.  A side larger than ``cell`` is dealt into
    blocks, and each pair of blocks that have to meet is a task.
    """
    sized = cells.join(elems.select("key", "size"), "key")
    n = sized.groupBy("home").pivot("side", [0, 1, 2]).agg(F.ceil(F.sum("size") / F.lit(cell)))
    n = n.select("home", *[F.coalesce(F.col(str(s)), F.lit(1)).cast("int").alias(f"n{s}") for s in (0, 1, 2)]).where("n0 + n1 + n2 > 3")
    bins = max(1, -(-2 * (sized.agg(F.sum("size")).first()[0] or 0) // cell))
    one = [F.coalesce(f"n{s}", F.lit(1)).alias(f"n{s}") for s in (0, 1, 2)]
    placed = sized.join(write_scratch(n, "blocks"), "home", "left").select("home", "side", "key", "root", "bands", F.col("n0").isNull().alias("small"), *one)
    block = lambda count: F.pmod(F.xxhash64("key"), F.col(count)).cast("int")
    every = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    mine = F.when(F.col("side") == 0, block("n0")).when(F.col("side") == 1, block("n1")).otherwise(block("n2"))
    placed = placed.withColumn("mine", mine)
    placed = placed.withColumn("other", F.explode(F.when(F.col("side") == 0, every("n1")).when(F.col("side") == 1, every("n0")).otherwise(every("n2"))))
    i = F.when(F.col("side") == 0, F.col("mine")).when(F.col("side") == 1, F.col("other")).otherwise(F.least("mine", "other"))
    j = F.when(F.col("side") == 0, F.col("other")).when(F.col("side") == 1, F.col("mine")).otherwise(F.greatest("mine", "other"))
    # blocks of side 2 that meet another block are two sides; a block that meets itself is one
    side = F.when((F.col("side") < 2) | (F.col("mine") == F.col("other")), F.col("side")).otherwise(F.col("mine") + 3)
    task = F.when(F.col("small"), F.pmod(F.xxhash64("home"), F.lit(bins))).otherwise(F.col("home")).alias("task")
    wanted = placed.select(task, "home", "small", i.alias("i"), j.alias("j"), side.cast("long").alias("side"), "root", "key", "bands")
    met = elems.join(wanted.hint("merge"), "key").select("task", "home", "small", "i", "j", "side", "root", "key", "bands", "elems")
    return met.groupBy("task", "small", "i", "j").applyInArrow(_compare(threshold), "a long, b long")


class Sieve:
    """A bit for each value of the leading bits of a key: sifts out most items that no band shares, at a fixed size."""

    BITS = 26

    def __init__(self, keys: DataFrame):
        at = F.shiftrightunsigned("key", 64 - self.BITS)
        words = keys.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - self.BITS}) & 63 as int))").alias("bit"))
        rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # 2 ** BITS / 64 rows at most
        bits = np.zeros(1 << (self.BITS - 6), np.int64)
        bits[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
        self.bits = bits.view(U64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(U64) >> U64(64 - self.BITS)
        return (self.bits[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) == 1


def classes(bands: DataFrame, elements: Callable[..., DataFrame], threshold: float, name: str, cell: int = CELL, rounds: int = ROUNDS, leads: DataFrame | None = None, thin: bool = False, repeated: Column | None = None) -> DataFrame:
    """(key, root) of the components of all pairs that share a band and have at least ``threshold`` similarity.

    ``bands(key, band)``; ``elements`` makes rows (key, elems), with the elements as bytes of 64-bit hashes, at least of the
    keys that a broadcast :class:`Sieve` has; items without a link are absent.
    Where rows of one key differ, ``leads(key, lead)`` says which is meant by their column ``lead``.
    With ``thin``, for items of many bands, centres are central items, those of half of the bands go first, and an item is compared with those of the other half only
    where the links found by then do not join them already.  With ``repeated`` (see :func:`groups`) ``elements`` gets a second sieve, of these items and those that share a band.
    """
    scratch, links_found, open_ends = [], None, []
    keep = lambda df, what: scratch.append(write_scratch(df, f"{name}-{what}")) or scratch[-1]
    members = keep(groups(bands, thin, repeated), "members")
    send, sieves = bands.sparkSession.sparkContext.broadcast, []
    if repeated is not None:
        sieves = [send(Sieve(members.select("key")))]
        members = members.where("centre is not null")
    # the elements of the items that share a band at all, once
    wanted = members.select("key").distinct()
    elems = elements(send(Sieve(wanted)), *sieves)
    own = elems.join(wanted.join(leads, "key"), ["key", "lead"]) if leads else elems.join(wanted, "key")
    elems = keep(own.groupBy("key").agg(F.min("elems").alias("elems")).withColumn("size", F.floor(F.octet_length("elems") / 8)), "elements")
    for _ in range(rounds):
        edges = members.where("key != centre").select("band", F.col("key").alias("a"), F.col("centre").alias("b"))
        if thin:
            half = F.pmod("band", F.lit(2)) == 0
            first = judged(edges.where(half).select("a", "b").distinct(), elems, name, cell)
            near = first.where(F.col("j") >= threshold).select("a", "b")
            joined = components(near if links_found is None else links_found.union(near), f"{name}-first")
            root = lambda c: joined.select(F.col("key").alias(c), F.col("root").alias(f"{c}_root"))
            apart = edges.where(~half).select("a", "b").distinct().join(root("a"), "a", "left").join(root("b"), "b", "left").where("coalesce(a_root, a) != coalesce(b_root, b)").select("a", "b")
            second = judged(apart.join(first.select("a", "b"), ["a", "b"], "left_anti"), elems, name, cell)
            seen = keep(first.union(second), "seen")
            drop_scratch(first, second, joined)
        else:
            seen = judged(edges.select("a", "b").distinct(), elems, name, cell)
            scratch.append(seen)
        near = seen.where(F.col("j") >= threshold).select("a", "b")
        links_found = near if links_found is None else links_found.union(near)
        far = members.join(seen.where(F.col("j") < threshold), (F.col("key") == F.col("a")) & (F.col("centre") == F.col("b")))
        far = keep(far.select("band", "key", "centre", "j"), "far")
        skipped = None
        if thin:  # joined to their centre by other links, at an unknown distance
            skipped = members.where("key != centre").join(seen.select(F.col("a").alias("key"), F.col("b").alias("centre")), ["key", "centre"], "left_anti")
            skipped = keep(skipped.select("band", "centre", "key"), "skipped")
        open_ends.append((members, seen, far, skipped))
        members = keep(groups(far.select("key", "band"), thin), "members")
        if members.isEmpty():
            break
    found = components(links_found, f"{name}-stars")
    scratch.append(found)
    named = lambda df, col, out: df.join(found.select(F.col("key").alias(col), F.col("root").alias(out)), col, "left").withColumn(out, F.coalesce(out, col))
    # what rounds of stars left: side 2 of the band's own home
    rest = named(members.select("band", "key"), "key", "root")
    several = rest.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("band")
    cells = rest.join(several, "band").select(F.col("band").alias("home"), F.lit(2).alias("side"), "key", "root", F.array("band").alias("bands"))
    # an item that is open against a centre in many bands stands in the centre's home once, with these bands
    once = lambda df, n, side: df.groupBy(F.xxhash64("centre", F.lit(n)).alias("home"), F.lit(side).alias("side"), "key", "root").agg(F.collect_set("band").alias("bands"))
    for n, (mine, seen, far, skipped) in enumerate(open_ends):
        within = far.where(F.col("j") >= 2 * threshold - 1 - 1e-9)
        if skipped:
            within = within.union(far.where(F.col("j") < 2 * threshold - 1 - 1e-9).join(skipped.select("band", "centre").distinct(), ["band", "centre"], "left_semi").select(*far.columns))
        between = named(named(within, "key", "root"), "centre", "centre_root").where("root != centre_root")
        between = keep(between.select("band", "centre", "key", "root"), "between")
        if between.isEmpty():
            continue
        cells = cells.union(once(between, n, 1))
        ends = between.select("band", "centre").distinct()
        close = mine.join(ends, ["band", "centre"]).join(seen.where(F.col("j") >= threshold), (F.col("key") == F.col("a")) & (F.col("centre") == F.col("b")))
        close = close.select("band", "centre", "key")
        if skipped:
            close = close.union(skipped.join(ends, ["band", "centre"], "left_semi").select("band", "centre", "key"))
        close = named(close.union(ends.select("band", "centre", F.col("centre").alias("key"))), "key", "root")
        cells = cells.union(once(close, n, 0))
    cells = keep(cells, "cells")
    out = found
    if not cells.isEmpty():
        more = keep(compared(cells, elems, threshold, cell), "more")
        if not more.isEmpty():
            out = components(links_found.union(more), f"{name}-all")
    drop_scratch(*(t for t in scratch if t is not out))
    return out
