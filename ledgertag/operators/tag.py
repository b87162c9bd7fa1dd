"""Tags: the items a match gives to the two sides of a transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout
from ledgertag.functions.tags import blank_to_null, priority, taggable


def tag_sides(matches: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Replace the rule's items by tags: only sides with a taggable account get one."""
    tags = {
        side.item: F.when(
            taggable(F.col(side.account), layout), F.col(f"{side.name}_item")
        )
        for side in layout.sides
    }
    return matches.withColumns(tags).drop("dt_item", "kt_item")


def blank_tags(tagged: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Blank tags as null."""
    return tagged.withColumns(
        {s.item: blank_to_null(F.col(s.item)) for s in layout.sides}
    )


def with_priorities(tagged: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    return tagged.withColumns(
        {f"{s.name}_prio": priority(F.col(s.item), layout) for s in layout.sides}
    )
