"""Scans. Newline-delimited JSON by default; any other Spark format by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ledgertag.schemas import CLASSIFIER_SCHEMA, RULE_SCHEMA, TX_SCHEMA

# Holds the text of a line that can't be read, null for all others.
BROKEN = "_broken_line"
# Formats whose lines may be broken.
LINES = ("json", "csv")


def read_transactions(spark: SparkSession, path: str, source: str = "json", broken: bool = False) -> DataFrame:
    return _scan(spark, path, source, TX_SCHEMA, broken)


def read_rules(spark: SparkSession, path: str, source: str = "json", broken: bool = False) -> DataFrame:
    return _scan(spark, path, source, RULE_SCHEMA, broken)


def read_classifier(spark: SparkSession, path: str, source: str = "json", broken: bool = False) -> DataFrame:
    return _scan(spark, path, source, CLASSIFIER_SCHEMA, broken)


def _scan(
    spark: SparkSession, path: str, source: str, schema: StructType, broken: bool
) -> DataFrame:
    """Rows of the declared schema.

    A line that can't be read becomes a row of nulls, as does a value that isn't of its type. With ``broken``, and a
    format that has lines, such lines stand in the column ``BROKEN``.
    """
    reader = spark.read
    if broken and source in LINES:
        schema = StructType([*schema.fields]).add(BROKEN, StringType())
        reader = reader.option("columnNameOfCorruptRecord", BROKEN)
    if source == "json":
        # One record per line, so a large file is read by many tasks.
        reader = reader.option("multiLine", False)
    return reader.schema(schema).format(source).load(path)


def _broken(read: DataFrame, columns: Sequence[str] | None) -> Column:
    # Only columns that are asked for are looked at; a hash asks for them, and refuses none.
    asked = F.xxhash64(*(columns or [c for c in read.columns if c != BROKEN])) >= -(2**63)
    return F.col(BROKEN).isNotNull() & asked


def broken_lines(read: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``file, line`` of the lines of a scan with ``broken`` of which the columns (all) can't be read, wholly or in part."""
    return read.filter(_broken(read, columns)).select(
        F.col("_metadata.file_path").alias("file"), F.col(BROKEN).alias("line")
    )


def sound_rows(read: DataFrame, columns: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
    """The rows of a scan with ``broken`` of which the columns (all) could be read.

    With a ``key`` instead those of which the key could be read, or whose line is sound; what could not be read is null there.
    """
    if BROKEN not in read.columns:
        return read
    if key:
        return read.filter(F.col(BROKEN).isNull() | F.col(key).isNotNull()).drop(BROKEN)
    return read.filter(~_broken(read, columns)).drop(BROKEN)
