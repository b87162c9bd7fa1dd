import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgertag.llm.mixing import mix_sources, mixed_documents
from ledgertag.llm.quality import classify_quality
from tests.llm import brute
from tests.llm.test_lines import plain
from tests.llm.test_packing import check

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The input of each stage and of none, as the stages leave it."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(staged):
    assert all(df.columns == COLUMNS for df in staged[:-1])


def test_quality_keeps_what_it_accepts(staged):
    kept = {r["doc_id"] for r in classify_quality(staged[0]).filter("keep").collect()}
    assert texts(staged[1]) == {i: t for i, t in texts(staged[0]).items() if i in kept}
    assert 0.6 < len(kept) / staged[0].count() < 1


def test_lines_like_brute_force(staged):
    want = plain(list(texts(staged[1]).items()))
    want = {i: t for i, (t, gone) in want.items() if not gone or t.strip()}
    got = texts(staged[2])
    assert sum(got.get(i) != want.get(i) for i in {*got, *want}) <= len(want) // 100
    assert all(r["n_chars"] == len(r["text"]) for r in staged[2].collect())


def test_one_document_of_each_group_stays(staged):
    before = texts(staged[2])
    group = brute.similar_documents(before.items())
    assert texts(staged[3]) == {i: t for i, t in before.items() if group[i][1] == i}


def test_mix_is_the_order_of_the_files(staged):
    place = {r["doc_id"]: (r["slot"], r["place"]) for r in mix_sources(staged[3]).collect()}
    order = [r["doc_id"] for r in staged[4].orderBy("_metadata.file_name", "_metadata.row_index").collect()]
    assert order == sorted(place, key=place.get) and texts(staged[4]) == texts(staged[3])


def test_packing_is_a_round_trip(staged):
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    ids = {i: [*encode(t, add_special_tokens=False).ids, 0] for i, t in texts(staged[4]).items()}
    check(staged[5].collect(), ids, 1024)


def test_prefixes_of_the_sequences_keep_the_weights(spark, tmp_path):
    """A prefix that ends with the seed at place p of the mix holds of each source its share of p documents, less one
    block, and beyond it no more than the neighbours that were taken early."""
    words = {"a": "alpha apple arrow", "b": "beta berry basin", "c": "gamma grape gravel"}
    rng = random.Random(6)
    rows = [(i, rng.choice("aaaaaabbbc")) for i in range(1500)]
    rows = [(i, " ".join(rng.choice(words[s].split()) for _ in range(rng.randrange(1, 900))), "en", s, 1) for i, s in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    how = {"block_rows": 2, "temperature": 0.5}
    mixed_documents(docs, **how).write.parquet(str(tmp_path / "mix"))
    pieces = corpus_pipeline.packing(spark, spark.read.parquet(str(tmp_path / "mix")), DATA).collect()
    placed = mix_sources(docs, **how).collect()
    rank = {r["doc_id"]: k for k, r in enumerate(sorted(placed, key=lambda r: (r["slot"], r["place"])))}
    source, share = {r["doc_id"]: r["source"] for r in placed}, {r["source"]: r["share"] for r in placed if not r["phase"]}
    ends = sum(not r["phase"] for r in placed)
    last, seeds = {}, {}
    for r in pieces:
        last[r["doc_id"]] = max(last.get(r["doc_id"], 0), r["sequence_id"])
        if not r["offset"]:
            seeds[r["sequence_id"]] = rank[r["doc_id"]]
    assert [seeds[k] for k in range(len(seeds))] == sorted(seeds.values())
    for k, p in seeds.items():
        if p < ends:
            whole = Counter(source[i] for i, at in last.items() if at <= k)
            early = sum(whole.values()) - p
            assert early >= 0
            assert all(-2 <= whole[s] - p * w <= 2 + early for s, w in share.items())


def test_run_is_the_stages(spark, staged):
    got = corpus_pipeline.run(spark, DATA)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, staged[5].select(key).collect()))


def test_odd_rows_pass_all_stages(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "  \n ", None, None, None), (3, "word " * 30000, "en", "a", 5)]
    rows += [(10 + i, f"The day was long and nobody knew why it was so {i}. They went home.", "en", "b", 1) for i in range(20)]
    rows += [rows[-1]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, DATA)
        assert (docs.count() > 0) == bool(some)
