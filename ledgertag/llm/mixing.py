"""Mixing sources to target weights by Pfair scheduling.

A source's rows are cut into blocks. Block j of a source with weight w is released in slot
floor(j / w) and due by slot ceil((j + 1) / w); of the released blocks the one
that is due first gets the slot. So after any number of slots each source has
had its weight's share of them to within less than one block. Weights are whole shares of a period, so the
schedule repeats, and a row finds its slot from its own number. When a
source runs out, the weights of the others are scaled up and a new phase begins;
there are at most as many phases as sources, and no row is left out or repeated.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import positions, settled, tasks, text_of

#: There are as many phases as sources, so the number of sources is bounded.
MOST_SOURCES = 256
#: Slots are worked out on the driver, one per block, so blocks grow with the rows: their number is bounded.
MOST_BLOCKS = 1 << 20


def exact(weights: dict[str, float]) -> dict[str, int]:
    """The least whole numbers in the very proportion of the weights."""
    ratios = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in ratios.values()))
    whole = {s: int(x * scale) for s, x in ratios.items()}
    common = math.gcd(*whole.values())
    return {s: x // common for s, x in whole.items()}


def shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole shares of a period, at least 1 each, that sum up to it (largest remainders)."""
    total = sum(weights.values())
    wanted = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in wanted.items()}
    by_need = sorted(wanted, key=lambda s: (out[s] - wanted[s], s))
    while (left := period - sum(out.values())) > 0:
        for s in by_need[:left]:
            out[s] += 1
    while sum(out.values()) > period:
        s = max((s for s in out if out[s] > 1), key=lambda s: (out[s] - wanted[s], s))
        out[s] -= 1
    return out


def schedule(parts: dict[str, int], blocks: dict[str, int] | None = None) -> list[str]:
    """The sources of one period's slots: released blocks by earliest deadline, then by name.

    With ``blocks``, it ends before the first slot whose source has none left.
    """
    period = sum(parts.values())
    waiting: list[tuple[int, str, int]] = []  # by release
    due: list[tuple[int, str, int]] = []  # by deadline
    for s in parts:
        heapq.heappush(waiting, (0, s, 0))
    slots: list[str] = []
    while len(slots) < period:
        while waiting and waiting[0][0] <= len(slots):
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(due, (-(-(j + 1) * period // parts[s]), s, j))
        _, s, j = heapq.heappop(due)
        if blocks is not None and j >= blocks[s]:
            break
        slots.append(s)
        if j + 1 < parts[s]:
            heapq.heappush(waiting, ((j + 1) * period // parts[s], s, j + 1))
    return slots


@dataclass
class Phase:
    """A stretch of slots with the same sources: first slot, slots, shares, and per source the
    first block and the places of its blocks in a period, or in the phase if that is shorter."""

    start: int
    slots: int
    parts: dict[str, int]
    first: dict[str, int]
    places: dict[str, np.ndarray]


def phases(blocks: dict[str, int], weights: dict[str, float], period: int | None = None) -> list[Phase]:
    """The phases in which sources with so many blocks run out.

    With a ``period``, weights are rounded to whole shares of it.
    """
    left, out, start = {s: n for s, n in blocks.items() if n}, [], 0
    while left:
        some = {s: weights[s] for s in left}
        parts = shares(some, max(period, len(left))) if period else exact(some)
        order = schedule(parts, left)
        number = {s: k for k, s in enumerate(left)}
        codes = np.fromiter((number[s] for s in order), np.int16, len(order))
        bounds = np.cumsum(np.bincount(codes, minlength=len(left)))[:-1]
        places = dict(zip(left, np.split(np.argsort(codes, kind="stable"), bounds), strict=True))
        # The phase ends at the first slot whose source has no block left.
        whole, extra = 0, len(order)
        if len(order) == sum(parts.values()):
            whole = min(left[s] // parts[s] for s in left)
            rest = {s: left[s] - whole * parts[s] for s in left}
            extra = min((int(places[s][rest[s]]) for s in left if rest[s] < parts[s]), default=0)
        slots = whole * len(order) + extra
        first = {s: blocks[s] - left[s] for s in left}
        out.append(Phase(start, slots, parts, first, places))
        start += slots
        for s in list(left):
            left[s] -= whole * parts[s] + int((places[s] < extra).sum())
            if not left[s]:
                del left[s]
    return out


def place_rows(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_rows: int = 32,
    temperature: float = 0.5,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """Id, ``source``, ``block``, ``slot``, ``place`` (in the block), ``phase`` and ``share`` of every row.

    ``weights`` are by source and must be positive; sources that it lacks raise an error. Without it, a source's weight is
    its number of rows to the power ``temperature``. Rows of a source come in order of
    id (nulls first, then a hash of the text), which also numbers its blocks of ``block_rows`` rows, or so many that there are
    no more than ``most_blocks`` full ones; the last one may be smaller. A null source counts
    as the source named "". ``share`` is the source's weight as a part of the weights of its phase. Repeated rows are rows like any other. An
    empty table gives an empty result; other columns are ignored. More than ``MOST_SOURCES`` sources raise an error.
    """
    if block_rows < 1:
        raise ValueError("block_rows must be positive")
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text_of(text_col)).alias("_tie"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"),
    )
    ranked = settled(positions(rows, ["_id", "_tie"], group="_source"))
    found = ranked.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).limit(MOST_SOURCES + 1).collect()
    counts = {r["_source"]: r["n"] for r in found}
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"there are more than {MOST_SOURCES} sources")
    if weights is None:
        weights = {s: n**temperature for s, n in counts.items()}
    if bad := [s for s in counts if not weights.get(s, 0) > 0]:
        raise ValueError(f"sources without a positive weight: {sorted(bad)}")
    block_rows = max(block_rows, -(-sum(counts.values()) // most_blocks))
    plan = phases({s: -(-n // block_rows) for s, n in counts.items()}, weights)
    periods = [sum(p.parts.values()) for p in plan]
    by_source = {
        s: [
            # Parts and periods beyond any number of blocks are never gone through a second time.
            (k, p.first[s], p.start, min(period, 1 << 62), min(p.parts[s], 1 << 62), p.places[s], p.parts[s] / period)
            for k, (p, period) in enumerate(zip(plan, periods, strict=True))
            if s in p.parts
        ]
        for s in counts
    }

    def assign(batches):
        for b in batches:
            if not b.num_rows:
                continue
            source = b.column("_source").dictionary_encode()
            code = source.indices.to_numpy(zero_copy_only=False)
            row = b.column("row").to_numpy(zero_copy_only=False)
            block, place = np.divmod(row, block_rows)
            slot, phase, share = np.empty(len(row), np.int64), np.empty(len(row), np.int32), np.empty(len(row))
            for c, name in enumerate(source.dictionary.to_pylist()):
                mine = np.flatnonzero(code == c)
                stretches = by_source[name]
                firsts = np.array([x[1] for x in stretches])
                k = np.searchsorted(firsts, block[mine], "right") - 1
                for i in np.unique(k):
                    number, first, start, period, part, places, ratio = stretches[i]
                    some = mine[k == i]
                    turn, step = np.divmod(block[some] - first, part)
                    slot[some] = start + turn * period + places[step]
                    phase[some], share[some] = number, ratio
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_tie"), b.column("_source"), pa.array(block), pa.array(slot),
                 pa.array(place), pa.array(phase), pa.array(share)],
                ["_id", "_tie", "source", "block", "slot", "place", "phase", "share"],
            )

    kind = ranked.schema["_id"].dataType.simpleString()
    return ranked.mapInArrow(
        assign,
        f"_id {kind}, _tie long, source string, block long, slot long, place long, phase int, share double",
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """As ``place_rows``, without the hash of the text."""
    return place_rows(docs, id_col=id_col, **how).drop("_tie").withColumnRenamed("_id", id_col)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` in the order of the mix: partition after partition, and sorted within each.

    So written files, in order of their names, hold the mix. Partitions are equal runs of slots.
    Rows that are equal in id and text stand together, at the first of their places.
    """
    n = tasks(docs.sparkSession)
    placed = settled(place_rows(docs, id_col=id_col, text_col=text_col, **how).select("_id", "_tie", "slot", "place"))
    total = (placed.agg(F.max("slot")).first()[0] or 0) + 1
    first = placed.groupBy("_id", "_tie").agg(F.min(F.struct("slot", "place")).alias("_mix_at"))
    first = first.select(F.col("_id").alias("_mix_id"), F.col("_tie").alias("_mix_tie"), "_mix_at")
    # The row is one column here, so that no name of its columns clashes.
    row = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), F.xxhash64(text_of(text_col)).alias("_hash"))
    same = F.col("_doc").eqNullSafe(F.col("_mix_id")) & (F.col("_hash") == F.col("_mix_tie"))
    joined = row.join(first, same).withColumn("_mix_part", F.expr(f"cast(_mix_at.slot * {n} div {total} as int)"))
    ordered = joined.repartitionById(n, F.col("_mix_part")).sortWithinPartitions("_mix_at")
    return ordered.select("_row.*")
