"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag.llm import sql
from ledgertag.llm.alignment import align_tokenizers
from ledgertag.llm.extraction import extract_pages
from ledgertag.llm.fingerprints import fingerprint_edits
from ledgertag.llm.infill import fill_in_middle, restore_documents
from ledgertag.llm.jaccard import similar_documents
from ledgertag.llm.lines import dedup_lines
from ledgertag.llm.mixing import mix_sources
from ledgertag.llm.packing import pack_documents
from ledgertag.llm.quality import classify_quality
from ledgertag.llm.repeats import remove_repeats
from ledgertag.llm.sharding import shard_documents
from ledgertag.llm.simhash import simhash_duplicates
from ledgertag.llm.topk import top_k

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = dict(sql.ORACLES)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[f.__name__] = f
    return f


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"), shards=16).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


@query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10, scale=1024)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, and which of them to keep."""
    return classify_quality(table(spark, sf_dir, "documents"))


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op10_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    found = extract_pages(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that repeated strings of 100 bytes cover."""
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return similar_documents(table(spark, sf_dir, "documents"))


@query
def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that come, more or less alike, before."""
    cut = dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all documents in a mix of their sources by the root of their sizes."""
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), window=1024, end=0)


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of two tokenizers over every document."""
    docs = table(spark, sf_dir, "documents")
    return align_tokenizers(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))[0]


@query
def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their middle at the end, and the texts restored from that."""
    arranged = fill_in_middle(table(spark, sf_dir, "documents")).drop("pieces")
    return restore_documents(arranged).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )


@query
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash of every document and its component of near fingerprints."""
    return simhash_duplicates(table(spark, sf_dir, "documents"))
