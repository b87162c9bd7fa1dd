"""From raw documents to packed training sequences.

Each stage gets the documents that the one before it kept, as a table read from Parquet, and returns
documents with the same columns; the last one returns the pieces of the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag.llm.common import written
from ledgertag.llm.jaccard import similar_documents
from ledgertag.llm.lines import dedup_lines
from ledgertag.llm.mixing import mixed_documents
from ledgertag.llm.packing import pack_documents
from ledgertag.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; blank ones aren't."""
    return keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that come, more or less alike, before; those that lose all their lines go.

    ``n_chars`` is brought up to date.
    """
    cut = dedup_lines(docs).filter("n_lines = 0 OR n_removed < n_lines")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.char_length("text").cast(kind))
    return cut.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id.

    Documents without an id stay; rows with equal ids stay or go together.
    """
    later = similar_documents(docs).filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.alias("d").join(later.alias("l"), F.col("d.doc_id") == F.col("l.doc_id"), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mix of the sources by the root of their sizes.

    The order is that of the written files' names and of the rows in them.
    """
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences; seeds are taken in the order of the mix.

    Documents that aren't read from files have no such order and are taken by id.
    """
    import public_tokenizers

    try:
        docs = docs.withColumn("_mix_order", F.struct("_metadata.file_name", "_metadata.row_index"))
        order = "_mix_order"
    except AnalysisException:
        order = "doc_id"
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), order_col=order)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

#: SQL can't express the classifier, the hashes of lines or the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
