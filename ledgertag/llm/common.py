"""Helpers that several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag.operators.settle import settle, shared_folder


#: Bytes of text that are worked on at a time, so that temporary arrays stay small.
SLICE = 1 << 20


def tasks(spark: SparkSession) -> int:
    """The number of partitions that the session deals shuffled rows out to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settled(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint: same partitions and order, no lineage."""
    return settle(df)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: smaller than a checkpoint."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the bounds of each value in them.

    A null is an empty value. The bytes are a view of the column where that is possible.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows that together hold about ``most`` bytes, at least one row each."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x *= _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    x ^= x >> np.uint64(33)
    return x


def text_of(text_col: str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def positions(
    df: DataFrame, order: list[str], group: str | None = None, size: str | None = None
) -> DataFrame:
    """Row numbers from 0 in a global order, and running sums of ``size``, without one big task.

    Rows are range-partitioned and sorted by ``group`` and ``order``; each
    partition's totals are summed up, and every row adds what it has seen in its
    own partition. Repeated rows get different numbers; which of them comes first
    does not matter, as they are equal. Adds ``row`` (from 0 within ``group``) and, with
    ``size``, ``before`` (the sum over the rows that come earlier within ``group``).
    What is broadcast has one row per partition and group boundary.
    """
    spark = df.sparkSession
    keys = ([group] if group else []) + order
    narrow = settled(df).withColumn("_pos_tie", F.monotonically_increasing_id())
    ranged = settled(
        narrow.repartitionByRange(tasks(spark), *keys, "_pos_tie")
        .sortWithinPartitions(*keys, "_pos_tie")
        .drop("_pos_tie")
        .withColumn("_pos_part", F.spark_partition_id())
    )
    parts = ["_pos_part"] + ([group] if group else [])
    sums = [F.count(F.lit(1)).alias("_n")] + ([F.sum(size).alias("_s")] if size else [])
    from pyspark.sql import Window

    earlier = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy("_pos_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*parts).agg(*sums)
    totals = totals.select(
        *[F.col(p).alias(f"{p}_of") for p in parts],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        *([F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s0")] if size else []),
    )
    on = F.col("_pos_part") == F.col("_pos_part_of")
    if group:
        on = on & F.col(group).eqNullSafe(F.col(f"{group}_of"))
    joined = ranged.join(F.broadcast(totals), on).drop("_pos_part", *[f"{p}_of" for p in parts])
    fields = [f for f in joined.schema.fields if f.name not in ("_n0", "_s0")]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", `row` bigint"
    out += ", `before` bigint" if size else ""

    def number(batches):
        last, n, s = object(), 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            starts = [0]
            if group:
                g = b.column(group)
                # Rows of a group are adjacent, so only changes matter.
                a = g.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                starts = [0, *(np.flatnonzero(np.diff(a)) + 1).tolist()]
            rows, sums_ = [], []
            for at, to in zip(starts, [*starts[1:], b.num_rows], strict=True):
                key = g[at].as_py() if group else None
                if key != last:
                    last, n, s = key, b.column("_n0")[at].as_py(), 0
                    s = b.column("_s0")[at].as_py() if size else 0
                rows.append(np.arange(n, n + to - at, dtype=np.int64))
                n += to - at
                if size:
                    v = b.column(size).slice(at, to - at).to_numpy(zero_copy_only=False)
                    c = np.cumsum(v.astype(np.int64))
                    sums_.append(s + c - v)
                    s += int(c[-1])
            columns = [b.column(f.name) for f in fields] + [pa.array(np.concatenate(rows))]
            columns += [pa.array(np.concatenate(sums_).astype(np.int64))] if size else []
            names = [f.name for f in fields] + ["row"] + (["before"] if size else [])
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(number, out)
