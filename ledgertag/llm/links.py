"""Links between similar sets, and the components that they make.

Every set has some keys, of which similar sets share one. Sets that share a key are
a cell. In a cell a signature tree prunes what can't be similar: its nodes hold OR-combined
bitmaps and size ranges, and two nodes are opened only if the largest
overlap that their bitmaps and sizes allow is enough. Of the pairs that are left a spanning
forest is verified from the texts. Where a pair of a cell fails, the texts of its members
are brought to the cell, which verifies forest after forest of what is still apart
until no pair is left. So no link that a cell holds is lost, and every step passes on
no more pairs than it has members.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import SLICE, mixed, settled, slices, tasks, utf8, written
from ledgertag.llm.hubs import join_hubs

DEALT = "part int, payload binary"
#: Cells of more members are cut into blocks of so many, in order of size.
BLOCK = 512
LEAF = 16
FILTER_BITS = 23
#: Pairs of a row with itself or another of its cell that are looked at at a time, so that their arrays stay small.
PAIRS = 1 << 21
#: Bytes of text whose tokens are made at a time; temporary arrays take some 60 times as much.
WORK = SLICE >> 2

_KEY = np.dtype([("key", "<u8"), ("id", "<i8"), ("whole", "<u8"), ("n", "<i4")])
#: Half of the key, for sets whose id is all that is told of them.
_BARE = np.dtype([("key", "<u4"), ("id", "<i8")])
_ROW = np.uint64(0xD6E8FEB86659FD93)

Tokens = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def distinct_sorted(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's hashes sorted and without repeats, and the new bounds. Sorts ``hashes`` in place."""
    for x, z in zip(bounds, bounds[1:], strict=False):
        hashes[x:z].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    counts = np.concatenate([[0], np.cumsum(new)])
    return hashes[new], counts[bounds]


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Nine times the least overlap of sets of sizes n and m whose Jaccard similarity is 0.8."""
    return 4 * (n + m)


def bitmap(hashes: np.ndarray, width: int) -> bytes:
    """A bitmap of ``width`` to twice as many bits per member, of a power of two of bits."""
    size = 1 << max(6, (width * len(hashes) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(hashes & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def whole_hash(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each row's sorted hashes."""
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + _ROW * (place + np.uint64(1))), dtype=np.uint64)])
    return mixed(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def dealt(ids: np.ndarray, whole: np.ndarray, n: np.ndarray, keys: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """The keys (64-bit hashes) of some sets, packed for the partitions in which equal keys meet.

    ``whole`` are hashes of the sets; of equal ones only the least id goes on. ``n`` are their sizes, or 0.
    """
    order = np.lexsort((ids, whole))
    order = order[np.diff(whole[order], prepend=~whole[order[:1]]) != 0]
    count = np.array([len(keys[k]) for k in order], np.int64)
    r = np.empty(int(count.sum()), _KEY)
    if len(r):
        r["key"] = np.concatenate([keys[k] for k in order])
    for c, v in (("id", ids), ("whole", whole), ("n", n)):
        r[c] = np.repeat(v[order], count)
    return _packed(mixed(r["key"].copy()), lambda order: r[order], parts)


def dealt_bare(ids: np.ndarray, keys: np.ndarray, parts: int) -> pa.RecordBatch:
    """Like ``dealt``, for sets whose ids, once each, are hashes of them and whose sizes aren't told; ``keys`` has a row for each.

    The upper half of a key tells the partition, and only the lower half goes on. Keys that are equal by chance
    make a cell of sets that needn't be similar.
    """

    def rows(order):
        r = np.empty(len(order), _BARE)
        r["key"] = keys.reshape(-1).astype(np.uint32)[order]
        r["id"] = ids[order // keys.shape[1]]
        return r

    return _packed(keys.reshape(-1) >> np.uint64(32), rows, parts)


def _packed(of: np.ndarray, rows: Callable[[np.ndarray], np.ndarray], parts: int) -> pa.RecordBatch:
    """``rows`` (in an order that they are asked for) by the partition that ``of`` tells."""
    to = (of % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.int64)
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(parts + 1))
    r = rows(order)
    some = [(k, r[x:z].tobytes()) for k, (x, z) in enumerate(zip(cuts, cuts[1:], strict=False)) if z > x]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in some], pa.int32()), pa.array([p for _, p in some], pa.binary())], ["part", "payload"]
    )


def _repeated(r: np.ndarray) -> np.ndarray:
    """The ``_BARE`` rows whose key comes several times, as ``_KEY`` rows."""
    # Keys and places as one number each, which sorts faster than places by key.
    at = r["key"].astype(np.uint64) << np.uint64(32)
    at |= np.arange(len(r), dtype=np.uint64)
    at.sort()
    key = at >> np.uint64(32)
    twice = key[1:] == key[:-1]
    often = np.concatenate([twice, [False]]) | np.concatenate([[False], twice])
    at = at[often]
    out = np.zeros(len(at), _KEY)
    out["key"], out["id"] = at >> np.uint64(32), r["id"][(at & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    out["whole"] = out["id"].view(np.uint64)
    return out


def _cells(payloads: DataFrame, parts: int, block: int, merged: bool = False, bare: bool = False) -> DataFrame:
    """``cell, id, side``: the members of every cell that holds two different sets.

    A large cell becomes cells of pairs of blocks, whose first block has side 0 and second
    block side 1; pairs of blocks whose sizes are too far apart are left out. ``merged`` cells are named by a hash of their
    members, so that those who meet under several keys make one cell. ``bare`` payloads are those of ``dealt_bare``.
    """

    def meet(batches):
        parts_ = [np.frombuffer(p, _BARE if bare else _KEY) for b in batches for p in b.column("payload").to_pylist()]
        if not parts_:
            return
        r = np.concatenate(parts_)
        if bare:
            r = _repeated(r)
        else:
            order = np.argsort(r["key"])
            twice = np.diff(r["key"][order]) == 0
            often = np.concatenate([twice, [False]]) | np.concatenate([[False], twice])
            r = r[order[often]]  # most keys occur once
        if not len(r):
            return
        r = r[np.lexsort((r["id"], r["whole"], r["key"]))]
        same = r["key"][1:] == r["key"][:-1]
        r = r[np.concatenate([[True], ~(same & (r["whole"][1:] == r["whole"][:-1]))])]
        start = np.flatnonzero(np.concatenate([[True], r["key"][1:] != r["key"][:-1]]))
        size = np.diff(np.append(start, len(r)))
        size, start = size[size > 1], start[size > 1]
        few = size <= block
        rows = np.repeat(start[few] - np.cumsum(size[few]) + size[few], size[few]) + np.arange(size[few].sum())
        ids = r["id"][rows]
        if len(ids):
            names = np.repeat(_named(ids, np.cumsum(size[few]) - size[few]), size[few]) if merged else r["key"][rows]
            yield _members(names, ids, 0)
        for x, m in zip(start[size > block], size[size > block], strict=True):
            g = r[x : x + m]
            g = g[np.lexsort((g["id"], g["n"]))]
            cut = np.arange(0, m, block)
            blocks, names = [g[k : k + block] for k in cut], _named(g["id"], cut)
            for i, p in enumerate(blocks):
                for j in range(i, len(blocks)):
                    q = blocks[j]
                    if 10 * int(p["n"][-1]) < 8 * int(q["n"][0]):
                        break
                    if not merged:
                        cell = mixed(p["key"][:1] + _ROW * np.uint64(i + 1) + mixed(np.array([j + 1], np.uint64)))
                    else:
                        cell = names[i : i + 1] if j == i else mixed(names[i : i + 1] * _ROW + names[j : j + 1])
                    yield _members(np.repeat(cell, len(p)), p["id"], 0)
                    if j > i:
                        yield _members(np.repeat(cell, len(q)), q["id"], 1)

    cells = payloads.repartitionById(parts, "part").mapInArrow(meet, "cell long, id long, side int")
    return cells.distinct() if merged else cells


def _named(ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of each run of ids, whatever their order; all runs have members."""
    sums = np.add.reduceat(mixed(ids.view(np.uint64) + _ROW), start)
    return mixed(sums + _ROW * np.diff(start, append=len(ids)).astype(np.uint64))


def _members(cell: np.ndarray, ids: np.ndarray, side: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cell.astype(np.uint64).view(np.int64)), pa.array(ids), pa.array(np.full(len(ids), side, np.int32))],
        ["cell", "id", "side"],
    )


class Signatures:
    """Sizes and bitmaps of some sets, the bitmaps as matrices by their width."""

    def __init__(self, n: np.ndarray, raw: np.ndarray, bounds: np.ndarray):
        self.n = n.astype(np.int64)
        self.width = np.diff(bounds) // 8
        self.place = np.zeros(len(n), np.int64)
        self.own: dict[int, np.ndarray] = {}
        #: Bitmaps folded to the width below, and how many bits are set in a row's own bitmap and in the folded one.
        self.folded: dict[int, np.ndarray] = {}
        self.held = np.zeros((2, len(n)), np.int64)
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.place[rows] = np.arange(len(rows))
            own = raw[bounds[rows][:, None] + np.arange(w * 8)].view(np.uint64)
            self.own[w], self.held[0, rows] = own, np.bitwise_count(own).sum(axis=1, dtype=np.int64)
            if w > 1:
                self.folded[w // 2] = half = own[:, : w // 2] | own[:, w // 2 :]
                self.held[1, rows] = np.bitwise_count(half).sum(axis=1, dtype=np.int64)

    def bits(self, rows: np.ndarray, w: int) -> np.ndarray:
        """Bitmaps of rows whose width is ``w`` or twice that, folded to ``w``."""
        same = self.width[rows] == w
        if same.all():
            return self.own[w][self.place[rows]] if len(rows) else np.empty((0, w), np.uint64)
        out = np.empty((len(rows), w), np.uint64)
        out[same] = self.own[w][self.place[rows[same]]] if same.any() else 0
        out[~same] = self.folded[w][self.place[rows[~same]]]
        return out

    def may_link(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether sizes and bitmaps allow similarity, for pairs of rows."""
        n, m = self.n[i], self.n[j]
        fits = 10 * np.minimum(n, m) >= 8 * np.maximum(n, m)
        at = np.flatnonzero(fits)
        narrow = np.minimum(self.width[i[at]], self.width[j[at]])
        for w in np.unique(narrow):
            some = at[narrow == w]
            step = max(64, (1 << 20) // int(w))
            for k in range(0, len(some), step):
                p = some[k : k + step]
                common = self.bits(i[p], int(w))
                common &= self.bits(j[p], int(w))
                spare = [self.n[x[p]] - self.held[(self.width[x[p]] != w).astype(np.int64), x[p]] for x in (i, j)]
                overlap = np.bitwise_count(common).sum(axis=1, dtype=np.int64) + np.minimum(*spare)
                fits[p] = 9 * overlap >= needed(n[p], m[p])
        return fits


class _Level:
    """Nodes of a signature tree over ``rows``, ``LEAF`` of the level below in each."""

    def __init__(self, bits: np.ndarray, low: np.ndarray, high: np.ndarray, spare: np.ndarray):
        cut = np.arange(0, len(bits), LEAF)
        self.bits = np.bitwise_or.reduceat(bits, cut, axis=0)
        self.low, self.high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
        self.spare = np.maximum.reduceat(spare, cut)


def _meet(a: _Level, b: _Level, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of nodes can hold a similar pair, by their largest possible overlap."""
    fits = (10 * a.high[i] >= 8 * b.low[j]) & (10 * b.high[j] >= 8 * a.low[i])
    at = np.flatnonzero(fits)
    for k in range(0, len(at), 1 << 13):
        p = at[k : k + (1 << 13)]
        common = np.bitwise_count(a.bits[i[p]] & b.bits[j[p]]).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(common + np.minimum(a.spare[i[p]], b.spare[j[p]]), np.minimum(a.high[i[p]], b.high[j[p]]))
        fits[p] = 9 * overlap >= needed(a.low[i[p]], b.low[j[p]])
    return fits


def dual_traversal(s: Signatures, a: np.ndarray, b: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row of ``a`` and a row of ``b`` that may link; their bitmaps are folded to ``w``."""
    if not len(a) or not len(b):
        return a[:0], b[:0]
    trees = []
    for rows in (a, b):
        bits = s.bits(rows, w)
        spare = s.n[rows] - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        levels = [_Level(bits, s.n[rows], s.n[rows], spare)]
        for _ in range(1):
            below = levels[-1]
            levels.append(_Level(below.bits, below.low, below.high, below.spare))
        trees.append(levels)
    x, y = (len(t[-1].bits) for t in trees)
    i, j = np.divmod(np.arange(x * y), y)
    for level in (1, 0):
        fits = _meet(trees[0][level], trees[1][level], i, j)
        i, j = i[fits], j[fits]
        sizes = [len(trees[k][level - 1].bits) if level else len(r) for k, r in enumerate((a, b))]
        i = (i[:, None] * LEAF + np.repeat(np.arange(LEAF), LEAF)).reshape(-1)
        j = (j[:, None] * LEAF + np.tile(np.arange(LEAF), LEAF)).reshape(-1)
        inside = (i < sizes[0]) & (j < sizes[1])
        i, j = i[inside], j[inside]
    return a[i], b[j]


def candidates(cell: np.ndarray, side: np.ndarray, s: Signatures) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows in one cell that may link. Rows must be sorted by cell."""
    if not len(cell):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    size = np.diff(np.append(start, len(cell)))
    two_sided = np.repeat(np.add.reduceat(side, start) > 0, size)  # only pairs across count
    out = []

    def keep(i, j):
        apart = (i != j) & ~(two_sided[i] & (side[i] == side[j]))
        i, j = i[apart], j[apart]
        fits = s.may_link(i, j)
        i, j = i[fits], j[fits]
        out.append(np.minimum(i, j) * len(cell) + np.maximum(i, j))

    for m in np.unique(size[(size > 1) & (size <= 4 * LEAF)]):
        x, y = np.triu_indices(m, 1)
        base = start[size == m]
        for k in range(0, len(base), max(1, (1 << 18) // len(x))):
            p = base[k : k + max(1, (1 << 18) // len(x))]
            keep((p[:, None] + x).reshape(-1), (p[:, None] + y).reshape(-1))
    for x, m in zip(start[size > 4 * LEAF], size[size > 4 * LEAF], strict=True):
        rows = np.arange(x, x + m)
        rows = rows[np.lexsort((s.n[rows], s.width[rows]))]
        first, second = rows[side[rows] == 0], rows[side[rows] == 1]
        for w in np.unique(s.width[rows]):
            for a, b in ((first, second),) if len(second) else ((first, first),):
                equal = (a[s.width[a] == w], b[s.width[b] == w])
                keep(*dual_traversal(s, *equal, int(w)))
                keep(*dual_traversal(s, equal[0], b[s.width[b] == 2 * w], int(w)))
                if len(second):
                    keep(*dual_traversal(s, a[s.width[a] == 2 * w], equal[1], int(w)))
    pairs = np.concatenate([np.empty(0, np.int64), *out])
    pairs.sort()
    return np.divmod(pairs[np.diff(pairs, prepend=-1) != 0], len(cell))


def spanning_forest(i: np.ndarray, j: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Numbers of pairs that connect whatever all the pairs connect, and make no ring.

    ``label`` (0 and up) tells which rows are connected from the start.
    """
    rows, chosen = int(label.max(initial=-1)) + 1, []
    while True:
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        open_ = np.flatnonzero(low != high)
        if not len(open_):
            return np.concatenate(chosen) if chosen else np.empty(0, np.int64)
        order = open_[np.lexsort((low[open_], high[open_]))]
        pick = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
        chosen.append(pick)
        parent = np.arange(rows)
        parent[high[pick]] = low[pick]
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


def _whole_cells(batches, most: int):
    """Tables of whole cells of at most about ``most`` bytes and ``PAIRS`` pairs, from batches sorted by cell."""

    def runs(t):
        cell = t["cell"].to_numpy()
        ends = np.append(np.flatnonzero(np.diff(cell, append=cell[-1:])) + 1, len(cell))
        starts = np.concatenate([[0], ends])
        for x, z in slices(np.concatenate([[0], np.cumsum(np.diff(starts) ** 2)]), PAIRS):
            yield t.slice(starts[x], starts[z] - starts[x])

    held: list[pa.Table] = []
    for b in batches:
        held.append(pa.Table.from_batches([b]))
        if sum(x.nbytes for x in held) >= most:
            t = pa.concat_tables(held).combine_chunks()
            cell = t["cell"].to_numpy()
            cut = int(np.searchsorted(cell, cell[-1]))
            if cut:
                yield from runs(t.slice(0, cut))
            held = [t.slice(cut)]
    if held and any(x.num_rows for x in held):
        yield from runs(pa.concat_tables(held).combine_chunks())


def _forests(members: DataFrame) -> DataFrame:
    """``cell, a, b, complete``: a spanning forest per cell of the pairs that may link, or all of them if they aren't more than the members.

    ``complete`` tells whether they are all. Members come sorted by cell.
    """

    def run(batches):
        for t in _whole_cells(batches, 1 << 22):
            ids, cell = t["id"].to_numpy(), t["cell"].to_numpy()
            s = Signatures(t["n"].to_numpy(), *utf8(t["bits"]))
            i, j = candidates(cell, t["side"].to_numpy(), s)
            number = np.cumsum(np.diff(cell, prepend=cell[:1]) != 0)
            complete = (np.bincount(number[i], minlength=len(ids)) <= np.bincount(number, minlength=len(ids)))[number[i]]
            chosen = complete.copy()
            more = np.flatnonzero(~complete)
            chosen[more[spanning_forest(i[more], j[more], np.arange(len(ids)))]] = True
            i, j = i[chosen], j[chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[i]), pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])), pa.array(complete[chosen])],
                ["cell", "a", "b", "complete"],
            )

    return members.mapInArrow(run, "cell long, a long, b long, complete boolean")


def _exact(members: DataFrame, tokens: Tokens) -> DataFrame:
    """``a, b``: links that connect all members of a cell that are similar, but not by ``label`` already.

    Members come sorted by cell, with their texts.
    """

    def run(batches):
        for t in _whole_cells(batches, 4 * SLICE):
            ids, cell, label = (t[c].to_numpy() for c in ("id", "cell", "label"))
            # Sets that are in several cells are made once.
            _, once, at = np.unique(ids, return_index=True, return_inverse=True)
            h, bounds = _all_tokens(t["text"].take(pa.array(once)), tokens)
            first, last = bounds[:-1][at], bounds[1:][at]
            bits = [bitmap(h[p:q], 8) for p, q in zip(bounds, bounds[1:], strict=False)]
            ends = np.concatenate([[0], np.cumsum([len(bits[k]) for k in at])])
            s = Signatures(last - first, np.frombuffer(b"".join([bits[k] for k in at]), np.uint8), ends)
            i, j = candidates(cell, t["side"].to_numpy(), s)
            # A label that spans cells doesn't tie them together here.
            _, own = np.unique(np.stack([cell, label]), axis=1, return_inverse=True)
            own, found = own.reshape(-1), []
            for rest in (False, False, True):  # forests first, as they connect most; then whatever is still apart
                apart = own[i] != own[j]
                i, j = i[apart], j[apart]
                pick = np.arange(len(i)) if rest else spanning_forest(i, j, own)
                for x, y in zip(i[pick].tolist(), j[pick].tolist(), strict=True):
                    if own[x] != own[y] and _similar(h[first[x] : last[x]], h[first[y] : last[y]]):
                        found.append((ids[x], ids[y]))
                        low, high = sorted((own[x], own[y]))
                        own[own == high] = low
                i, j = np.delete(i, pick), np.delete(j, pick)
            a, b = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (ids[:0], ids[:0])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return members.mapInArrow(run, "a long, b long")


def _all_tokens(texts, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    raw, bounds = utf8(texts)
    parts = [tokens(raw[bounds[x] : bounds[z]], bounds[x : z + 1] - bounds[x]) for x, z in slices(bounds, WORK)]
    return np.concatenate([h for h, _ in parts]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(e) for _, e in parts]))])


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether sorted distinct hashes have a Jaccard similarity of 0.8 or more."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return False
    at = np.searchsorted(y, x)
    overlap = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 9 * overlap >= needed(len(x), len(y))


def _places(ids: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return [(mixed(ids.view(np.uint64) ^ salt) & mask).astype(np.int64) for salt in (np.uint64(0), _ROW)]


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of a column of longs: 2**FILTER_BITS bits, whatever their number."""
    words = (1 << FILTER_BITS) // 64

    def fill(batches):
        bits = np.zeros(words, np.uint64)
        for b in batches:
            for p in _places(b.column(0).to_numpy(zero_copy_only=False)):
                np.bitwise_or.at(bits, p >> 6, np.uint64(1) << (p & 63).astype(np.uint64))
        some = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(bits[some].view(np.int64))], ["word", "bits"])

    filled = ids.mapInArrow(fill, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = filled.toArrow()  # one row per word at most
    out = np.zeros(words, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def may_hold(filter_: np.ndarray, ids: np.ndarray) -> np.ndarray:
    held = [(filter_[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) for p in _places(ids)]
    return (held[0] & held[1]).astype(bool)


def signatures(items: DataFrame, tokens: Tokens, width: int) -> DataFrame:
    """``id, n, bits``: size and bitmap of the set of every text."""

    def run(batches):
        for b in batches:
            raw, bounds = utf8(b.column("text"))
            for x, z in slices(bounds, WORK):
                h, own = tokens(raw[bounds[x] : bounds[z]], bounds[x : z + 1] - bounds[x])
                bits = [bitmap(h[p:q], width) for p, q in zip(own, own[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(x, z - x), pa.array(np.diff(own).astype(np.int32)), pa.array(bits, pa.binary())],
                    ["id", "n", "bits"],
                )

    return items.mapInArrow(run, "id long, n int, bits binary")


def verify(pairs: DataFrame, items: DataFrame, tokens: Tokens) -> DataFrame:
    """``a, b, linked`` for distinct pairs of ids, from the texts of ``items`` (id, text)."""

    def run(batches):
        for b in batches:
            raw_a, bounds_a = utf8(b.column("text_a"))
            raw_b, bounds_b = utf8(b.column("text_b"))
            for x, z in slices(bounds_a + bounds_b, WORK):
                sets = []
                for raw, bounds in ((raw_a, bounds_a), (raw_b, bounds_b)):
                    own = bounds[x : z + 1] - bounds[x]
                    sets.append(tokens(raw[bounds[x] : bounds[z]], own))
                (h, p), (g, q) = sets
                linked = [_similar(h[p[k] : p[k + 1]], g[q[k] : q[k + 1]]) for k in range(z - x)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("a").slice(x, z - x), b.column("b").slice(x, z - x), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
                )

    first = items.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = items.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    with_texts = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return with_texts.mapInArrow(run, "a long, b long, linked boolean")


def components(links: DataFrame) -> DataFrame:
    """``id, root``: the smallest id of each component of the links (a, b), for ids that have links.

    Large-star and small-star steps: each joins neighbours to the least neighbour of
    a node; both are grouped minima, which are combined before they are shuffled, and nodes with very many
    neighbours are met by broadcast. Ends when the links, by number and hash, don't change any more.
    """
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    state = None
    while True:
        both = settled(edges.select(F.inline(ways)))
        now = both.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return both.filter("u > v").select(F.col("u").alias("id"), F.col("v").alias("root"))
        state, total = now, now[0]
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = join_hubs(both, least, "u", total, "inner").filter("v > u")
        large = settled(large.select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        # Each neighbour but the least is joined to it, and so is the node itself.
        ends = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = join_hubs(large, least, "u", total // 2, "inner").select(ends.alias("u"), F.col("m").alias("v"))
        edges = small.distinct()


def met(payloads: DataFrame, block: int = BLOCK, merged: bool = False, bare: bool = False) -> DataFrame:
    """The cells that ``linked`` takes, as a table.

    ``payloads`` are what ``dealt`` (or, if ``bare``, ``dealt_bare``) makes of the sets' keys, for as many parts as the session has
    shuffle partitions; sizes of 0 keep large cells from being cut by size. Cells of more than ``block`` sets are cut
    into pairs of blocks. Where most sets that meet do so under several keys, cells of equal
    members should be ``merged``, at the price of one more shuffle of ids.
    """
    return written(_cells(payloads, tasks(payloads.sparkSession), block, merged, bare), "cells")


def linked(cells: DataFrame, texts: DataFrame, tokens: Tokens, width: int = 2) -> DataFrame:
    """``id, root`` for every set that is linked with a different one; ``root`` is the least id.

    ``cells`` are of ``met``; ``texts`` has ``id, text`` of at least the sets in them. ``tokens`` makes sets of texts: sorted
    distinct hashes and bounds. Bitmaps have ``width`` to twice as many bits per member.
    """
    parts = tasks(cells.sparkSession)
    items = written(texts.join(cells.select("id").distinct(), "id", "left_semi"), "items")

    def by_cell(members: DataFrame) -> DataFrame:
        return members.repartition(parts, "cell").sortWithinPartitions("cell")

    members = cells.join(signatures(items, tokens, width), "id").select("cell", "id", "side", "n", "bits")
    found = written(_forests(by_cell(members)), "pairs")
    checked = written(verify(found.select("a", "b").distinct(), items, tokens), "checked")
    links = checked.filter("linked").select("a", "b")
    # Who shares the least partner is connected; that is enough to leave out most pairs.
    partner = links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    partner = partner.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    # Where all pairs of a cell are checked, no text can tell more.
    failed = found.filter("NOT complete").join(checked.filter("NOT linked"), ["a", "b"], "left_semi")
    members = cells.join(failed.select("cell").distinct(), "cell", "left_semi").join(partner, "id", "left")
    members = members.join(items, "id").withColumn("label", F.coalesce("label", "id"))
    more = _exact(by_cell(members.select("cell", "id", "side", "label", "text")), tokens)
    return components(written(links.unionAll(more), "links"))


def linked_components(
    payloads: DataFrame, fetch: Callable[[np.ndarray], DataFrame], tokens: Tokens, block: int = BLOCK, width: int = 2
) -> DataFrame:
    """``linked`` of ``met``; ``fetch`` gets a Bloom filter of ids and returns ``id, text`` of at least those."""
    cells = met(payloads, block)
    return linked(cells, fetch(id_filter(cells.select("id").distinct())), tokens, width)
