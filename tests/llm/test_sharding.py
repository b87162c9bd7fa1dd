import zlib
from pathlib import Path

from pyspark.sql import functions as F

from ledgertag.llm.sharding import shard_documents, write_shards

SCHEMA = "doc_id long, text string, shard string, row int, before string"


def brute(rows, shards):
    keyed = []
    for i, text in rows:
        raw = (text or "").encode()
        keyed.append((i is not None, i or 0, len(raw) + 1, zlib.crc32(raw), i))
    keyed.sort()
    total = sum(k[2] for k in keyed)
    out, before, slots = [], 0, [0] * shards
    for _, _, size, crc, i in keyed:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        out.append((i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return out


def test_like_brute_force(spark):
    rows = [(i * 7 % 101, "é" * (i * i % 97)) for i in range(300)]
    rows += [(None, None), (None, "x"), (5, ""), (5, ""), (200, "long " * 4000)]
    df = spark.createDataFrame([(i, t, "s", 1, "b") for i, t in rows], SCHEMA).repartition(7)
    for shards in (1, 4, 16):
        got = shard_documents(df, shards).select("doc_id", "size", "text_crc32", "shard", "slot")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows, shards), key=str)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert shard_documents(empty).collect() == []
    one = shard_documents(spark.createDataFrame([(1, None)], "doc_id long, text string"))
    assert [(r.size, r.slot) for r in one.select("size", "slot").collect()] == [(1, 0)]


def test_written_shards_hold_every_row_once(spark, tmp_path: Path):
    df = spark.range(500).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 13).cast("int")).alias("text")
    )
    write_shards(df, str(tmp_path / "out"), shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == back.select("doc_id").distinct().count() == 500
    sizes = [r[0] for r in back.groupBy("shard").agg(F.sum(F.length("text") + 1)).select(F.col("sum((length(text) + 1))")).collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 2 * 25
