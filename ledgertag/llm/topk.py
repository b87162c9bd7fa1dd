"""Exact top-k inner products on a bit-sliced index.

Every attribute (vector component) of a block of rows is stored as bit slices: one
bitmap per binary digit, with one bit per row. A query adds the slices of all
attributes, each as often as the signed binary digits of its weight say, with carry-save
adders on whole bitmaps; negative digits add the complement. The sums' slices are
then read from the most significant one down, which keeps the rows that may still
be among the best. Low digits whose whole weight can't bring many rows back are left out of a sum;
the rows that are kept are multiplied out, so that the result is exact.
"""

from __future__ import annotations

import heapq
import itertools
import math
from fractions import Fraction
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgertag.llm.common import tasks

#: Vectors with a quantised component of 2**LIMIT_BITS or more aren't sliced, as sums must fit in 64 bits: their products are
#: added as whole numbers of any size.
LIMIT_BITS = 24
#: Components of the rows that a task holds, about, and queries and pairs that make a task of their own.
HELD, ASKED, PAIRS = 1 << 23, 1 << 15, 1 << 22
#: An index that few queries meet is dealt out so many times at most.
COPIES = 8
_LEAST, _MOST = -(2**63), 2**63 - 1


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``_id``, ``_v`` (array of double, whole numbers) and, for large ones, ``_x`` (as it was) of the rows that take part."""
    whole = F.col(vector_col).isNotNull() & F.forall(
        vector_col,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )

    def floor(x):
        scaled = x.cast("double") * float(scale)
        # From 2**53 on all doubles are whole numbers.
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    rows = vectors.filter(F.col(id_col).isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.col(id_col).cast("long").alias("_id"),
        F.transform(vector_col, floor).alias("_v"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("_x"),
    )
    large = F.exists("_v", lambda x: F.abs(x) >= 2.0**LIMIT_BITS)
    return rows.withColumn("_x", F.when(large, F.col("_x")))


def whole_numbers(values, scale: int) -> list[int]:
    """floor(scale * x) of finite doubles, however large."""
    return [math.floor(Fraction(x) * scale) if abs(x) * scale == math.inf else math.floor(x * scale) for x in values]


def held_values(slices: np.ndarray, low: np.ndarray, n: int) -> np.ndarray:
    """The values of a sliced block, row by row."""
    out = np.repeat(low.astype(np.int32)[:, None], n, axis=1)
    for s in range(slices.shape[1]):
        bits = np.unpackbits(np.ascontiguousarray(slices[:, s]).view(np.uint8), axis=1, count=n, bitorder="little")
        out += bits.astype(np.int32) << s
    return np.ascontiguousarray(out.T)


def best_products(rows: list[list[int]], ids: np.ndarray, weights: list[int], own: int, k: int) -> list[tuple[int, int]]:
    """The ``k`` best of some rows by products of any size: (id, product)."""
    found = [(-sum(map(mul, row, weights)), i) for row, i in zip(rows, ids.tolist(), strict=True) if i != own]
    return [(i, -s) for s, i in heapq.nsmallest(k, found)]


def beyond(score: int) -> str:
    """Orders scores that 64 bits don't hold, as text, beside "m" for those that they do."""
    if _LEAST <= score <= _MOST:
        return "m"
    digits = str(abs(score))
    if score > 0:
        return f"p{len(digits):05d}{digits}"
    return f"a{99_999 - len(digits):05d}" + "".join(str(9 - int(c)) for c in digits)


def build_slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices (attribute, binary digit, word of 64 rows) of ``values`` less the lowest of each attribute."""
    n, d = values.shape
    low = values.min(axis=0)
    above = (values - low).T
    digits = max(1, int(above.max(initial=0)).bit_length())
    words = -(-n // 64)
    out = np.zeros((d, digits, words * 8), np.uint8)
    for s in range(digits):
        packed = np.packbits((above >> s) & 1, axis=1, bitorder="little")
        out[:, s, : packed.shape[1]] = packed
    return out.view(np.uint64), low


def addition(weights: np.ndarray, digits: int, cut: int) -> dict:
    """How to add slices for ``weights``, each as often as its signed binary digits say, from 2**``cut`` up.

    ``rounds`` name the maps that each round of carry-save adders takes (three of a level, and those left over),
    ``levels`` those that are left at last. What is below 2**``cut`` adds ``slack`` to a sum at most.
    """
    size = np.abs(weights)
    half, three = size >> 1, size + (size >> 1)
    plus, minus = three & (half ^ three), half & (half ^ three)  # no two digits beside each other
    powers = np.arange(int(size.max(initial=0)).bit_length() + 1)
    dims, power = np.nonzero(((plus | minus)[:, None] >> powers) & 1)
    taken = ((minus[dims] >> power) & 1) ^ (weights[dims] < 0)  # those add the complement
    level = power[:, None] + np.arange(digits)
    rows = ((taken * len(weights) + dims) * digits)[:, None] + np.arange(digits)
    maps, level, below = rows[level >= cut], level[level >= cut], level[level < cut]
    slack = sum(n << p for p, n in enumerate(np.bincount(below).tolist()))
    out = {"cut": cut, "slack": slack, "less": int((taken << power).sum()) * ((1 << digits) - 1), "rounds": []}
    while True:
        order = np.argsort(level, kind="stable")
        level, maps = level[order], maps[order]
        count = np.bincount(level - cut) if len(level) else np.zeros(0, np.int64)
        at = np.arange(len(level)) - np.repeat(np.cumsum(count) - count, count)
        third = np.repeat(count // 3, count)
        if (count // 3).sum() < 4:
            break
        a, b, c = (np.flatnonzero((at >= x * third) & (at < (x + 1) * third)) for x in range(3))
        rest = np.flatnonzero(at >= 3 * third)
        out["rounds"].append((maps[a], maps[b], maps[c], maps[rest]))
        level = np.concatenate([level[a], level[a] + 1, level[rest]])
        maps = np.arange(len(level))
    out["levels"] = np.split(maps, np.cumsum(count)[:-1]) if len(level) else []
    return out


class Adder:
    """Carry-save adders; their arrays are used again, as fresh ones cost more than the sums."""

    def __init__(self) -> None:
        self.held: list[np.ndarray] = [np.empty(0, np.uint64)] * 6

    def array(self, which: int, n: int, words: int) -> np.ndarray:
        if len(self.held[which]) < n * words:
            self.held[which] = np.empty(n * words * 5 // 4, np.uint64)
        return self.held[which][: n * words].reshape(n, words)

    def add(self, slices: np.ndarray, how: dict) -> list[np.ndarray]:
        """Slices of the weighted sums from 2**cut up, lowest first; ``slices`` has all maps and their complements."""
        maps, words = slices, slices.shape[1]
        for turn, (*three, rest) in enumerate(how["rounds"]):
            n = len(three[0])
            a, b, c = (np.take(maps, x, axis=0, out=self.array(i, n, words), mode="clip") for i, x in enumerate(three))
            ab = np.bitwise_xor(a, b, out=self.array(3, n, words))
            after = self.array(4 + turn % 2, 2 * n + len(rest), words)
            np.bitwise_xor(ab, c, out=after[:n])
            a &= b
            ab &= c
            np.bitwise_or(a, ab, out=after[n : 2 * n])
            np.take(maps, rest, axis=0, out=after[2 * n :], mode="clip")
            maps = after
        levels = [[maps[x] for x in level] for level in how["levels"]]
        return added(levels, words)


def added(levels: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """One map per level of what a few maps per level add up to."""
    sums: list[np.ndarray] = []
    carries: list[np.ndarray] = []
    levels = list(levels)
    while levels or carries:
        due, carries = (levels.pop(0) if levels else []) + carries, []
        while len(due) > 1:
            a, b, ab = due[0], due[1], due[0] ^ due[1]
            if len(due) == 2:
                due, carry = [ab], a & b
            else:
                due, carry = [*due[3:], ab ^ due[2]], (a & b) | (ab & due[2])
            carries.append(carry)
        sums.append(due[0] if due else np.zeros(words, np.uint64))
    return sums or [np.zeros(words, np.uint64)]


def at_least(sums: list[np.ndarray], least: int) -> np.ndarray:
    """The rows whose sums are no less than ``least``."""
    if least >> len(sums) > 0:
        return np.zeros_like(sums[0])
    above, level = np.zeros_like(sums[0]), np.full_like(sums[0], ~np.uint64(0))
    if least <= 0:
        return level
    for s in range(len(sums) - 1, -1, -1):
        if (least >> s) & 1:
            level = level & sums[s]
        else:
            above |= level & sums[s]
            level = level & ~sums[s]
    return above | level


def best_rows(sums: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the ``k`` largest sums; of those level with the last, the first rows."""
    sure, level = np.zeros_like(allowed), allowed.copy()
    for bits in sums[::-1]:
        both = level & bits
        n = int(np.bitwise_count(sure | both).sum())
        if n > k:
            level = both
        else:
            sure, level = sure | both, level & ~bits
            if n == k:
                level = np.zeros_like(level)
                break
    rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    even = np.flatnonzero(np.unpackbits(level.view(np.uint8), bitorder="little"))
    return np.concatenate([rows, even[: max(0, k - len(rows))]])


class Block:
    """Rows of the index, sorted by id, as a task holds them."""

    def __init__(self, dims: int, digits: int, ids: bytes, low: bytes, raw: bytes) -> None:
        self.dims, self.digits, self.ids = dims, digits, np.frombuffer(ids, np.int64)
        if digits:
            self.low = np.frombuffer(low, np.int64)
            slices = np.frombuffer(raw, np.uint64).reshape(dims, digits, -(-len(self.ids) // 64))
            self.values = held_values(slices, self.low, len(self.ids))
            self.maps = np.concatenate([slices, ~slices]).reshape(-1, slices.shape[2])
        else:
            self.values = np.frombuffer(raw, np.float64).reshape(len(self.ids), dims)

    def whole(self, scale: int) -> list[list[int]]:
        """The rows' components as whole numbers of any size."""
        if self.digits:
            return self.values.tolist()
        return [whole_numbers(v, scale) for v in self.values.tolist()]

    def best(self, weights: np.ndarray, how: dict, own: int, held: list[tuple[int, int]], k: int, adder: Adder) -> tuple[list, int]:
        """``held``, the best so far as (-score, id), with this block's rows, and how many were multiplied out."""

        def scores(rows: np.ndarray) -> np.ndarray:
            return self.values[rows].astype(np.int64) @ weights

        sums = adder.add(self.maps, how)
        mask = np.zeros(len(sums[0]) * 64, np.uint8)
        mask[: len(self.ids)] = self.ids != own
        allowed = np.packbits(mask, bitorder="little").view(np.uint64)
        if len(held) == k:
            last = -held[-1][0]
        else:
            first = scores(best_rows(sums, allowed, k))
            last = int(first.min()) if len(first) == k else None
        if last is not None:
            most = int((weights * self.low).sum()) - how["less"] + how["slack"]
            allowed &= at_least(sums, -((most - last) >> how["cut"]))
        rows = np.flatnonzero(np.unpackbits(allowed.view(np.uint8), bitorder="little"))
        n = len(rows)
        if n:
            found, ids = scores(rows), self.ids[rows]
            if n > k:
                order = np.lexsort((ids, -found))[:k]
                found, ids = found[order], ids[order]
            held = sorted(held + list(zip((-found).tolist(), ids.tolist(), strict=True)))[:k]
        return held, n


class Search:
    """The best rows of a task's blocks for its queries."""

    def __init__(self, k: int, scale: int) -> None:
        self.k, self.scale = k, scale
        self.blocks: dict[int, list[Block]] = {}
        #: By length, the power of two from which on digits are added.
        self.cuts: dict[int, int] = {}
        self.adder = Adder()

    def hold(self, block: Block) -> None:
        self.blocks.setdefault(block.dims, []).append(block)

    def sliced(self, own: int, weights: np.ndarray) -> list[tuple[int, int]]:
        """The best rows of the sliced blocks as (-score, id)."""
        d, held, ways, met, kept = len(weights), [], {}, 0, 0
        if self.k < 1:
            return held
        cut = self.cuts.get(d, 0)
        for block in self.blocks.get(d, ()):
            if not block.digits:
                continue
            if block.digits not in ways:
                ways[block.digits] = addition(weights, block.digits, cut)
            held, n = block.best(weights, ways[block.digits], own, held, self.k, self.adder)
            met, kept = met + len(block.ids), kept + max(0, n - self.k)
        # Fewer digits while few rows are multiplied out, more when they are many.
        if kept * 256 < met:
            self.cuts[d] = min(cut + 1, min(ways) + int(np.abs(weights).max(initial=0)).bit_length())
        elif kept * 32 > met:
            self.cuts[d] = max(0, cut - 1)
        return held

    def __call__(self, asked: list[tuple[int, np.ndarray | None, list | None]]) -> list[tuple[int, int, int, str]]:
        """Of queries (id, weights or, for large ones, the vector): id, row, score, and where scores go beyond 64 bits."""
        found = [self.sliced(i, w) if w is not None else [] for i, w, _ in asked]
        whole = [whole_numbers(x, self.scale) if w is None else None for _, w, x in asked]
        for d in {len(w) if w is not None else len(x) for _, w, x in asked}:
            for block in self.blocks.get(d, ()):
                due = [
                    j
                    for j, (_, w, x) in enumerate(asked)
                    if (w is None or not block.digits) and len(w if w is not None else x) == d
                ]
                rows = block.whole(self.scale) if due else []
                for j in due:
                    i, w, _ = asked[j]
                    best = best_products(rows, block.ids, w.tolist() if w is not None else whole[j], i, self.k)
                    found[j] = sorted(found[j] + [(-s, row) for row, s in best])[: self.k]
        return [
            (i, row, min(max(-s, _LEAST), _MOST), beyond(-s))
            for (i, _, _), held in zip(asked, found, strict=True)
            for s, row in held
        ]


def dealt(rows: int, components: int, n: int, parts: int) -> tuple[int, int]:
    """Into how many buckets the rows and into how many groups ``n`` queries go.

    A task has a bucket and a group: each row is sent once per group, each query once per bucket.
    """
    buckets = max(1, -(-components // HELD))
    tasks_ = min(parts, rows * n // PAIRS)
    return buckets, max(1, -(-n // ASKED), min(COPIES, -(-tasks_ // buckets)))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = 8192,
    query_rows: int = 256,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best other rows, exactly.

    Components are floor(``scale`` * x), however large; a score that 64 bits don't hold is ranked by its true value
    and returned as the nearest 64-bit one. Rows with a null id, a null vector, or a
    null or non-finite component take no part; a query meets the rows whose
    vectors have its length. A query leaves out the rows that have its own id; of
    queries with the same id the one with the smallest vector counts. Repeated
    rows are separate candidates. Ties go to the smaller id. Fewer rows than
    ``k`` are all returned; empty tables give an empty result; other columns are ignored.

    Rows are indexed where they are read, in blocks of at most ``block_rows``, and dealt out to buckets; queries
    are dealt out to groups. A task holds the blocks of one bucket and answers the queries of one group, ``query_rows``
    at a time. It passes on ``k`` rows per query, whatever the number of blocks.
    """
    spark = vectors.sparkSession
    size = F.greatest(F.coalesce(F.size(vector_col), F.lit(0)), F.lit(0)).cast("long")
    rows, components = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets, groups = dealt(rows, components, queries.count(), tasks(spark))

    def index(batches):
        held: dict[tuple[int, bool], list] = {}
        made = itertools.count()

        def block(key):
            d, large = key
            ids, values = (np.concatenate(x) for x in zip(*held.pop(key), strict=True))
            order = np.argsort(ids, kind="stable")
            ids, values = ids[order], values[order]
            # Large vectors are kept as they are, without digits.
            slices, low = (values[:, :0, None], values[0]) if large else build_slices(values.astype(np.int64))
            return pa.RecordBatch.from_pydict(
                {
                    "_nth": pa.array([next(made)], pa.int32()),
                    "_dims": pa.array([d], pa.int32()),
                    "_digits": pa.array([slices.shape[1]], pa.int32()),
                    "_ids": pa.array([ids.tobytes()]),
                    "_low": pa.array([low.tobytes()]),
                    "_slices": pa.array([(values if large else slices).tobytes()]),
                }
            )

        for b in batches:
            lengths = b.column("_v").value_lengths().to_numpy(zero_copy_only=False)
            ids = b.column("_id").to_numpy(zero_copy_only=False)
            large = b.column("_x").is_valid().to_numpy(zero_copy_only=False)
            for wide, column in ((False, "_v"), (True, "_x")):
                rows_ = np.flatnonzero(large == wide)
                flat = b.column(column).take(pa.array(rows_)).flatten().to_numpy(zero_copy_only=False)
                own = lengths[rows_]
                starts = np.cumsum(own) - own
                for d in np.unique(own):
                    rows = np.flatnonzero(own == d)
                    for at in range(0, len(rows), block_rows):
                        some = rows[at : at + block_rows]
                        values = flat[starts[some][:, None] + np.arange(d)[None, :]]
                        held.setdefault((int(d), wide), []).append((ids[rows_[some]], values))
                        if sum(len(x[0]) for x in held[int(d), wide]) >= block_rows:
                            yield block((int(d), wide))
        for key in list(held):
            yield block(key)

    blocks = quantised(vectors, id_col, vector_col, scale).mapInArrow(
        index, "_nth int, _dims int, _digits int, _ids binary, _low binary, _slices binary"
    )
    bucket = F.pmod(F.spark_partition_id() + F.col("_nth"), F.lit(buckets))
    blocks = blocks.withColumn("_bucket", bucket).drop("_nth")
    blocks = blocks.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # A fixed number of partitions, as few rows become many below.
    asked = quantised(queries, id_col, vector_col, scale).repartition(tasks(spark), "_id")
    asked = asked.groupBy("_id").agg(F.min(F.struct("_v", "_x")).alias("_q")).select("_id", "_q.*")
    asked = asked.select(
        "_id",
        F.when(F.col("_x").isNull(), F.col("_v").cast("array<int>")).alias("_w"),
        "_x",
        F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int").alias("_group"),
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_bucket"),
    )
    met = blocks.unionByName(asked, allowMissingColumns=True)
    met = met.withColumn("_task", F.col("_bucket") * groups + F.col("_group")).drop("_bucket", "_group")
    met = met.withColumn("_is_query", F.col("_id").isNotNull())
    met = met.repartition(2 * buckets * groups, "_task").sortWithinPartitions("_task", "_is_query")

    def search(batches):
        task, here = None, Search(k, scale)
        for b in batches:
            of = b.column("_task").to_numpy(zero_copy_only=False)
            is_query = b.column("_is_query").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(of) != 0) | np.diff(is_query)) + 1
            for at, to in zip([0, *edges], [*edges, b.num_rows], strict=True):
                if at == to:
                    continue
                if task != of[at]:
                    task, here = of[at], Search(k, scale)
                if not is_query[at]:
                    for r in range(at, to):
                        dims, digits = b.column("_dims")[r].as_py(), b.column("_digits")[r].as_py()
                        here.hold(Block(dims, digits, *(b.column(c)[r].as_py() for c in ("_ids", "_low", "_slices"))))
                    continue
                for start in range(at, to, query_rows):
                    some = b.slice(start, min(query_rows, to - start))
                    ids, weights, large = (some.column(c) for c in ("_id", "_w", "_x"))
                    out = here(
                        [
                            (i, w.values.to_numpy(zero_copy_only=False).astype(np.int64) if w.is_valid else None, x.as_py())
                            for i, w, x in zip(ids.to_pylist(), weights, large, strict=True)
                        ]
                    )
                    if out:
                        cols = list(zip(*out, strict=True))
                        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                            ["query_id", "vec_id", "score", "_beyond"],
                        )

    found = met.mapInArrow(search, "query_id long, vec_id long, score long, _beyond string")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("_beyond"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
