"""Contiguous shards of near-equal size, cut from global prefix sums.

Documents are put in order of id (nulls first, ties by size and checksum). Each
partition's bytes are totalled, the totals are summed up to prefix sums, and a row
falls into the shard in which the middle of its bytes lies on the line from 0 to
the total. So every shard is a run of that order, and its size differs from the
target by no more than its two border documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import positions, settled, tasks, text_of


def shard_documents(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard``, ``slot``.

    ``size`` is the UTF-8 length plus 1, so that empty texts count too; a null
    text is empty. ``slot`` is the place within the shard, without gaps from 0.
    Only ids, sizes and checksums are shuffled, never texts. Null and repeated
    ids are rows like any other; an empty table gives an empty result; other
    columns are ignored.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = settled(positions(rows, [id_col, "size", "text_crc32"], size="size"))
    total = placed.agg(F.sum("size")).first()[0] or 1
    cut = placed.withColumn(
        "shard",
        F.expr(f"least({shards - 1}, (2 * before + size) * {shards} div {2 * total})").cast("int"),
    )
    starts = cut.groupBy(F.col("shard").alias("_shard")).agg(F.min("row").alias("_first"))
    return cut.join(F.broadcast(starts), F.col("shard") == F.col("_shard")).select(
        id_col, "size", "text_crc32", "shard", (F.col("row") - F.col("_first")).alias("slot")
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write ``docs`` as Parquet, one folder per shard, rows in order of their slot.

    Ids must be unique here, as they tie the rows to their places.
    """
    places = shard_documents(docs, shards, id_col, text_col).select(
        F.col(id_col).alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot")
    )
    rows = docs.join(places, F.col(id_col).eqNullSafe(F.col("_id"))).drop("_id")
    rows = rows.repartitionByRange(tasks(docs.sparkSession), "_shard", "_slot")
    rows = rows.sortWithinPartitions("_shard", "_slot").withColumnRenamed("_shard", "shard")
    rows.drop("_slot").write.partitionBy("shard").parquet(path)
