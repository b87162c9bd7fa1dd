"""Near duplicates by SimHash, found with pigeonring filtering.

A fingerprint is cut into a ring of ``SEGMENTS`` segments. If two fingerprints differ in at most
``BITS`` bits, some segment starts a chain in which the first k segments together differ
in at most k / ``SEGMENTS`` of ``BITS``, for every k at once. With four segments of 16 bits and three bits
the budgets of a chain are 0, 1, 2 and 3: its first segment agrees, so fingerprints meet in cells
of (segment, value), one per segment. In a cell the fingerprints are sorted from the chain's start on; a
chain is followed segment by segment, as ranges of the sorted fingerprints, and ends where no
fingerprint is left within the budget. The full Hamming distance decides last.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import SLICE, tasks, text_of, utf8, written
from ledgertag.llm.hubs import join_hubs
from ledgertag.llm.links import components, spanning_forest

WORDS, SEED = 3, 42
WIDTH, SEGMENTS, BITS = 64, 4, 3
SEGMENT = WIDTH // SEGMENTS
#: How much the first k + 1 segments of a chain may differ.
BUDGETS = [BITS * (k + 1) // SEGMENTS for k in range(SEGMENTS)]
#: Rows of whole cells that are worked on at a time, and pairs that are listed at a time.
ROWS, PAIRS = 1 << 16, 1 << 19

_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_REST = WIDTH - SEGMENT
_LOW = np.uint64((1 << _REST) - 1)
#: Masks of a segment with at most so many bits, fewest bits first, and their numbers of bits.
_MASKS = sorted((m for m in range(1 << SEGMENT) if m.bit_count() <= BITS), key=int.bit_count)
_MASK = np.array(_MASKS, np.uint64)
_WEIGHT = np.array([m.bit_count() for m in _MASKS], np.int64)
_WITHIN = [int((_WEIGHT <= b).sum()) for b in range(BITS + 1)]


def shingle_hashes(text: bytes, step: int = SLICE) -> Iterator[np.ndarray]:
    """XXH64 of the three-word shingles of a text, repeats included, some at a time."""
    held: list[bytes] = []
    at, some = 0, False
    while at < len(text):
        blank = _BLANK.search(text, min(at + step, len(text)))
        end = blank.start() if blank else len(text)
        words = held + text[at:end].lower().split()
        at = end
        if len(words) >= WORDS:
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            first = np.concatenate([[0], ends[: len(words) - WORDS]]).tolist()
            last = (ends[WORDS - 1 :] - 1).tolist()
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(line[x:z], SEED) for x, z in zip(first, last, strict=True)], np.uint64)
            some = True
        held = words[1 - WORDS :]
    if held and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes) -> int:
    """The bits that more than half of the shingles' hashes have; 0 without words."""
    n, ones = 0, np.zeros(WIDTH, np.int64)
    for h in shingle_hashes(text):
        for k in range(0, len(h), 1 << 16):
            some = h[k : k + (1 << 16)]
            bits = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def chains(cell: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one cell whose fingerprints differ in at most ``BITS`` bits, some at a time.

    ``cell`` numbers the cells from 0; ``prints`` are distinct, turned to the chain's start and sorted within a cell,
    whose members agree on the first segment. A row asks for at most as many ranges as there are chains
    within the budgets (11,473), however many rows are alike.
    """
    keys = (cell.astype(np.uint64) << np.uint64(_REST)) | (prints & _LOW)
    front = [(np.arange(len(keys)), np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.int64))]
    for level in range(1, SEGMENTS):
        shift = np.uint64(_REST - SEGMENT * level)
        ahead = []
        for row, change, spent in front:
            for left in range(BUDGETS[level] + 1):
                mine = np.flatnonzero(BUDGETS[level] - spent == left)
                n = _WITHIN[left]
                step = max(1, PAIRS // n)
                for k in range(0, len(mine), step):
                    p = mine[k : k + step]
                    r = np.repeat(row[p], n)
                    c = (change[p][:, None] | (_MASK[:n] << shift)).reshape(-1)
                    from_ = (keys[r] ^ c) >> shift << shift
                    upto = from_ | ((np.uint64(1) << shift) - np.uint64(1))
                    # Each pair is found from its first row.
                    low = np.maximum(np.searchsorted(keys, from_), r + 1)
                    high = np.searchsorted(keys, upto, "right")
                    some = high > low
                    # Ranges that are shorter than the next step's list of chains are listed.
                    short = some & (high - low <= 2 * _WITHIN[BUDGETS[min(level + 1, SEGMENTS - 1)]])
                    yield from _within(prints, r[short], low[short], high[short])
                    deep = some & ~short
                    if deep.any():
                        used = (spent[p][:, None] + _WEIGHT[:n]).reshape(-1)
                        ahead.append((r[deep], c[deep], used[deep]))
        front = ahead


def _within(prints: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Pairs of ``row`` and the rows from ``low`` up to ``high`` that are near enough."""
    count = np.cumsum(high - low)
    k = 0
    while k < len(row):
        to = max(k + 1, int(np.searchsorted(count, (count[k - 1] if k else 0) + PAIRS, "right")))
        n = high[k:to] - low[k:to]
        i = np.repeat(row[k:to], n)
        j = np.repeat(low[k:to], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        near = np.bitwise_count(prints[i] ^ prints[j]) <= BITS
        yield i[near], j[near]
        k = to


def _forest(cell: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links of some cells connect: fewer than rows."""
    rows = np.arange(len(prints))
    i = j = rows[:0]
    more: list[tuple[np.ndarray, np.ndarray]] = []
    for pair in chains(cell, prints):
        more.append(pair)
        if sum(len(x) for x, _ in more) >= PAIRS:
            i, j, more = *_thinned(i, j, more, rows), []
    return _thinned(i, j, more, rows)


def _thinned(i, j, more, rows):
    i, j = (np.concatenate([x, *[m[k] for m in more]]) for k, x in ((0, i), (1, j)))
    pick = spanning_forest(i, j, rows)
    return i[pick], j[pick]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, print``: the SimHash of every row's text as a signed long. A null text is empty; nulls stay nulls in ``id``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def run(batches):
        for b in batches:
            raw, bounds = utf8(b.column("text"))
            found = [fingerprint(raw[x:z].tobytes()) for x, z in zip(bounds, bounds[1:], strict=False)]
            prints = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(prints)], ["id", "print"])

    return rows.mapInArrow(run, "id long, print long")


def near_prints(reps: DataFrame, rows: int) -> DataFrame:
    """``a, b``: links that connect all rows of ``reps`` (id, print; distinct prints) that are linked at all.

    ``rows`` is how many there are. A cell that holds more than a task's even share is cut
    by the chain's second segment: within its budget of one bit one of its halves agrees, so each member
    goes to two smaller cells. There are fewer such cells than tasks.
    """
    parts = tasks(reps.sparkSession)
    half = SEGMENT // 2

    def place(segment: int) -> Column:
        by = SEGMENT * segment
        bits = F.col("print")
        if by:
            bits = F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, WIDTH - by))
        # A cell is named by its segment's number and value.
        name = F.shiftrightunsigned(bits, _REST).bitwiseOR(F.lit(segment << SEGMENT))
        return F.struct(name.alias("cell"), bits.alias("turned"))

    placed = reps.select("id", F.inline(F.array(*[place(s) for s in range(SEGMENTS)])))
    full = placed.groupBy("cell").count().filter(F.col("count") * parts > F.lit(SEGMENTS * rows))
    second = F.shiftrightunsigned("turned", _REST - SEGMENT).bitwiseAND(F.lit((1 << SEGMENT) - 1))
    halves = F.array(
        F.shiftrightunsigned(second, half), second.bitwiseAND(F.lit((1 << half) - 1)) + F.lit(1 << half)
    )
    whole = F.array(F.lit(-1).cast("long"))
    cut = placed.join(F.broadcast(full.select("cell", F.lit(True).alias("full"))), "cell", "left")
    members = cut.select("cell", F.explode(F.when(F.col("full"), halves).otherwise(whole)).alias("half"), "turned", "id")
    # Unsigned order of the bits, so that a chain's continuations are ranges.
    sorted_ = members.repartition(parts, "cell", "half").sortWithinPartitions(
        "cell", "half", F.col("turned").bitwiseXOR(F.lit(-(2**63)))
    )

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= ROWS:
                t = pa.Table.from_batches(held).combine_chunks()
                cell, part = t["cell"].to_numpy(), t["half"].to_numpy()
                old = np.flatnonzero((cell != cell[-1]) | (part != part[-1]))
                cut = int(old[-1]) + 1 if len(old) else 0
                if cut:
                    yield from links_of(t.slice(0, cut))
                held = t.slice(cut).to_batches()
        if any(x.num_rows for x in held):
            yield from links_of(pa.Table.from_batches(held).combine_chunks())

    def links_of(t: pa.Table):
        cell, part, ids = (t[c].to_numpy() for c in ("cell", "half", "id"))
        prints = t["turned"].to_numpy().view(np.uint64)
        new = (np.diff(cell, prepend=cell[:1]) != 0) | (np.diff(part, prepend=part[:1]) != 0)
        number = np.cumsum(new)
        most = 1 << SEGMENT  # a cell's number takes the place of the segment on which it agrees
        starts = np.searchsorted(number, np.arange(0, number[-1] + 1, most))
        for x, z in zip(starts, [*starts[1:], len(number)], strict=True):
            i, j = _forest(number[x:z] - number[x], prints[x:z])
            a, b = ids[x:z][i], ids[x:z][j]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return sorted_.mapInArrow(run, "a long, b long")


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Rows link when their fingerprints differ in at most three bits; a component's id is the least id that is
    reachable. Null and empty texts and texts without words have fingerprint 0, which links like any other. A row without
    an id has a fingerprint, links with nothing and has a null component. Rows that repeat an id are placed by their own
    fingerprints; fingerprints that have that id for their least one are linked. An empty table gives an
    empty result; other columns are ignored.
    """
    printed = written(fingerprints(docs, id_col, text_col), "prints")
    # Equal fingerprints are one from here on: the row with the least id stands for them.
    reps = printed.filter("id IS NOT NULL").groupBy("print").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    reps = written(reps, "reps")
    roots = components(near_prints(reps.select("id", "print"), reps.count()))
    named = reps.join(roots, "id", "left").select("print", "n", F.coalesce("root", "id").alias("component_id"))
    found = join_hubs(printed, written(named, "named"), "print", printed.count())
    component = F.when(F.col("id").isNotNull(), F.col("component_id"))
    return found.select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        component.alias("component_id"),
    )
