"""Joins with one row per key, where a few keys may hold most rows of the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import tasks


def join_hubs(
    rows: DataFrame, by_key: DataFrame, on: str | list[str], total: int, how: str = "left", count: str = "n"
) -> DataFrame:
    """``rows`` joined with ``by_key`` (one row per key), without a task that holds all rows of a key.

    ``by_key`` has in ``count`` how many of the ``total`` rows have its key; the column is dropped. Keys with more than an even
    share of a task are hubs: there are fewer of them than tasks, so they are broadcast, and
    their rows stay where they are. All other rows are shuffled. ``rows`` is read twice, so it should be a table.
    """
    hub = F.col(count) * tasks(rows.sparkSession) > F.lit(total)
    hubs = F.broadcast(by_key.filter(hub).drop(count))
    met = rows.join(hubs, on, "inner")
    cold = rows.join(hubs.select(on), on, "left_anti")
    return met.unionByName(cold.join(by_key.filter(~hub).drop(count), on, how))
