"""Rows next to the rows beside them in a global order, without one big task."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import settled, tasks

OWN, EARLIER, LATER = 0, -1, 1


def in_runs(
    rows: DataFrame,
    keys: list[str],
    tie: Column,
    f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    wrap: bool = False,
) -> DataFrame:
    """``f`` over runs of ``rows`` in order of ``keys`` (nulls first, then ``tie``), with the rows at their borders.

    The order is cut into one run per shuffle partition; the cuts come from the
    keys alone, and the first and last key of each run (two rows per partition)
    go to the driver. A run also gets copies of the rows with the last key of the
    run before it and with the first key of the run after it (``wrap``: the first run
    follows the last). ``f`` gets the rows in order with a column ``_side``: -1 for
    copies that come before the run, 0 for its own rows, 1 for those after it. A row
    is shuffled once, and a copy goes only to the runs beside its own. A run is streamed.
    """
    spark = rows.sparkSession
    narrow = settled(rows.select(*keys))
    ranged = narrow.repartitionByRange(tasks(spark), *keys).groupBy(F.spark_partition_id().alias("p"))
    edges = ranged.agg(F.min(F.struct(*keys)).alias("a"), F.max(F.struct(*keys)).alias("z")).collect()

    def order(key) -> tuple:
        return tuple((x is not None, x) if x is not None else (False, 0) for x in key)

    runs = sorted((order(e["a"]), order(e["z"])) for e in edges)
    starts, ends = [a for a, _ in runs], [z for _, z in runs]
    n = len(runs)

    def deal(batches):
        for b in batches:
            if not b.num_rows:
                continue
            values = [order(k) for k in zip(*(b.column(c).to_pylist() for c in keys), strict=True)]
            take, run, side = [], [], []
            for i, k in enumerate(values):
                r = bisect_right(starts, k) - 1
                take.append(i), run.append(r), side.append(OWN)
                if k == starts[r] and (r or wrap):
                    take.append(i), run.append((r - 1) % n), side.append(LATER)
                if k == ends[r] and (r + 1 < n or wrap):
                    take.append(i), run.append((r + 1) % n), side.append(EARLIER)
            out = b.take(pa.array(take))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(run, pa.int32()), pa.array(side, pa.int32())],
                [*out.schema.names, "_run", "_side"],
            )

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema.fields)
    dealt = rows.mapInArrow(deal, f"{fields}, _run int, _side int")
    placed = dealt.repartitionById(max(1, n), F.col("_run"))
    return placed.sortWithinPartitions("_side", *keys, tie).mapInArrow(f, schema)
