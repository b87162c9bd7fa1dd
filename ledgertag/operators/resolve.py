"""One tag per transaction id and side, then both sides on one row.

The fast form keeps the two winners of an id in one aggregate: ``min`` over a
struct whose fields are the order of preference. It is combined on the map side,
so an id that holds a large part of all rows reaches its reducer as one row per
map task, and there is one exchange in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout, Side
from ledgertag.functions.tags import preference


def resolve_side(
    tagged: DataFrame, side: Side, layout: Layout = DEFAULT
) -> DataFrame:
    """Keep the first tag of one side per id, as whole rows.

    Spark plans this with a group limit before the exchange, so each task passes
    on at most one row per id.
    """
    first = Window.partitionBy(layout.key).orderBy(
        *[c.asc_nulls_first() for c in order_of(side, layout)]
    )
    return (
        tagged.filter(F.col(side.item).isNotNull())
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def order_of(side: Side, layout: Layout = DEFAULT) -> list[Column]:
    items = F.col(side.item), F.col(layout.other(side).item)
    return preference(F.col("rid"), *items, layout)


def best(side: Side, layout: Layout = DEFAULT) -> Column:
    """The tag of one row on ``side`` in comparable form, null without a tag."""
    return F.when(F.col(side.item).isNotNull(), F.struct(*order_of(side, layout)))


def merge_ids(candidates: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Per id the least ``dt_best`` and ``kt_best`` of all candidate rows."""
    return candidates.groupBy(layout.key).agg(
        F.min("dt_best").alias("dt_best"), F.min("kt_best").alias("kt_best")
    )


def candidates(tagged: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    dt, kt = layout.sides
    return tagged.filter(
        F.col(dt.item).isNotNull() | F.col(kt.item).isNotNull()
    ).select(
        layout.key,
        best(dt, layout).alias("dt_best"),
        best(kt, layout).alias("kt_best"),
    )


def resolve_union(tagged: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """The winners of both sides, one row per id and side."""
    merged = merge_ids(candidates(tagged, layout), layout)

    def winner(side: Side) -> Column:
        w = F.col(f"{side.name}_best")
        items = {side.item: w["item"], layout.other(side).item: w["other"]}
        return F.when(
            w.isNotNull(),
            F.struct(
                F.lit(side.name).alias("side"),
                w["loaded"].alias(layout.loaded),
                w["posted"].alias(layout.posted),
                w["rid"].alias("rid"),
                *[items[s.item].alias(s.item) for s in layout.sides],
            ),
        )

    both = F.array_compact(F.array(*[winner(s) for s in layout.sides]))
    return merged.select(layout.key, F.inline(both))


def report(winners: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Winners with the result's column names."""
    return winners.select(
        layout.key,
        F.to_date(layout.loaded).alias(layout.loaded),
        *[F.col(s.item).alias(s.result) for s in layout.sides],
        layout.posted,
    )


def consolidate_items(reported: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Greatest item per id and side; items are compared as strings."""
    return reported.groupBy(layout.key).agg(
        *[F.max(s.result).alias(s.result) for s in layout.sides]
    )


def consolidate(merged: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Result rows from the two winners of each id.

    A winner may carry an item for the other side as well, and the greater of
    the two stands on every row of the id. An id has two rows only when its
    winners differ in date.
    """
    dt, kt = F.col("dt_best"), F.col("kt_best")

    def dates(w: Column) -> Column:
        return F.when(
            w.isNotNull(),
            F.struct(
                F.to_date(w["loaded"]).alias(layout.loaded),
                w["posted"].alias(layout.posted),
            ),
        )

    return merged.select(
        layout.key,
        F.inline(F.array_distinct(F.array_compact(F.array(dates(dt), dates(kt))))),
        F.greatest(dt["item"], kt["other"]).alias(layout.debit.result),
        F.greatest(kt["item"], dt["other"]).alias(layout.credit.result),
    )
