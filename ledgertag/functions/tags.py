"""Expressions over tags: who may get one, what counts as none, which comes first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout


def taggable(account: Column, layout: Layout = DEFAULT) -> Column:
    return account.like(layout.taggable)


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def forced(item: Column, layout: Layout = DEFAULT) -> Column:
    """Items that need no agreement with the classifier and win over others."""
    return item.isin(*layout.forced_items)


def priority(item: Column, layout: Layout = DEFAULT) -> Column:
    """1 for forced items, 2 for all others and for none."""
    return F.when(forced(item, layout), 1).otherwise(2)


def preference(
    rid: Column, item: Column, other: Column, layout: Layout = DEFAULT
) -> list[Column]:
    """Which tag of a side comes first. Total over all columns used later."""
    return [
        priority(item, layout).alias("prio"),
        rid.alias("rid"),
        F.col(layout.posted).alias("posted"),
        item.alias("item"),
        other.alias("other"),
        F.col(layout.loaded).alias("loaded"),
    ]
