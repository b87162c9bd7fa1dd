"""Writing and keeping results."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ledgertag.config import DEFAULT, Layout

# Replaces the load dates that the result has, and leaves all others as they are.
REFRESH = "refresh"
# Sizes of a Bloom filter, each half of the one before, that a row group can choose from: 1 MB down to 512 bytes.
FILTER_SIZES = 12


def write_result(
    result: DataFrame,
    path: str,
    mode: str = "errorifexists",
    layout: Layout = DEFAULT,
) -> None:
    """Parquet, one directory per load date.

    Rows are rebalanced by load date first, so that each date gets few files.
    Unlike a plain repartition this splits a date that holds most of the rows
    over several tasks. Files are sorted by id and have Bloom filters of the ids, so that :func:`lookup` reads few
    row groups. ``mode`` is one of Spark's, or ``refresh``: a run for dates that were written
    before replaces those, and only those.
    """
    writer = (
        result.hint("rebalance", layout.loaded)
        .sortWithinPartitions(layout.loaded, layout.key)
        .write.partitionBy(layout.loaded)
        .option(f"parquet.bloom.filter.enabled#{layout.key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option(f"parquet.bloom.filter.candidates.number#{layout.key}", str(FILTER_SIZES))
    )
    if mode == REFRESH:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    writer.parquet(path)


def materialise(df: DataFrame) -> int:
    """Keep ``df`` for several reads and return its number of rows."""
    return df.persist(StorageLevel.MEMORY_AND_DISK).count()


def lookup(df: DataFrame, key: str, layout: Layout = DEFAULT) -> DataFrame:
    """Rows of one transaction id.

    In a written result only row groups are read whose range of ids holds the id and whose Bloom filter doesn't refuse it.
    """
    return df.filter(df[layout.key] == key)
