import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgertag.llm.packing import Statistics, fill_windows, load_tokenizer, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start int, _order string, row string"


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def check(pieces, ids, window):
    """That the pieces are an exact round trip of the documents' ids; gives the sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for i, rs in by_doc.items():
        at = 0
        for r in sorted(rs, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids[i])
            own = np.array(ids[i][at : at + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(own.tobytes())
            at += r["length"]
        assert at == len(ids[i])
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return by_sequence


def test_ids_are_the_tokenizers(reference):
    rng = random.Random(1)
    encode, kind = load_tokenizer(PATH)
    texts = ["", " ", "a  b\n\n c\t\r\n", "it's we'll I'm", "x <|endoftext|> y", "é\U0001f600 １２ ٣", "a" * 5000, " " * 300 + "z"]
    texts += ["".join(rng.choice("ab1 .,'\n é中") for _ in range(200)) for _ in range(50)]
    for t in texts:
        assert encode(t).tolist() == reference.encode(t, add_special_tokens=False).ids
    assert kind == "<u2"


def test_whole_table(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ids = {r["doc_id"]: [*reference.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    sequences = check(pack_documents(docs, PATH).collect(), ids, 1024)
    total = sum(map(len, ids.values()))
    assert len(sequences) * 1024 < 1.02 * total


def test_odd_rows(spark, reference):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 30000), (1003, "x" * 62 + " y")]
    df = spark.createDataFrame([(i, t, 1, "o", "r") for i, t in rows], SCHEMA).repartition(4)
    ids = {i: [*reference.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    sequences = check(pack_documents(df, PATH, window=64, shard_items=32).collect(), ids, 64)
    assert len(sequences) <= sum(map(len, ids.values())) / 64 + 16
    assert pack_documents(df.limit(0), PATH).collect() == []


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c")], "doc_id long, text string")
    got = pack_documents(df, PATH).collect()
    assert Counter((r["doc_id"], r["start"], r["length"]) for r in got) == {(1, 0, 4): 2, (None, 0, 4): 1}
    assert len({r["sequence_id"] for r in got}) <= 2


def test_neighbours_are_the_best_unused_by_bm25():
    rng = np.random.default_rng(4)
    tails = [rng.integers(0, 40, rng.integers(5, 60)).astype("<u2") for _ in range(40)]
    df = Counter(t for x in tails for t in set(x.tolist()))
    mean = float(np.mean([len(x) for x in tails]))
    stats = Statistics(np.array(list(df)), np.array([df[t] for t in df], float), len(tails), mean)
    left, at = [len(x) for x in tails], [0] * len(tails)
    want = []
    for seed in range(len(tails)):
        while left[seed]:
            room, pieces = 64, []
            scores = {}
            for k, x in enumerate(tails):
                tf = Counter(x.tolist())
                scores[k] = sum(
                    np.log(1 + (len(tails) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(x) / mean))
                    for t in set(tails[seed].tolist()) & set(tf)
                )
            first = True
            while room and (first or any(left)):
                k = seed if first else max((k for k in range(len(tails)) if left[k]), key=lambda k: (round(scores[k], 9), -k))
                take = min(room, left[k])
                pieces.append((k, at[k], take))
                at[k] += take
                left[k] -= take
                room -= take
                first = False
            want.append(pieces)
    assert fill_windows(tails, stats, 64) == want


def test_sequences_are_numbered_in_order_of_their_seeds(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randrange(150)))) for i in range(600)]
    place = list(range(600))
    rng.shuffle(place)
    df = spark.createDataFrame([(i, t, place[i]) for i, t in rows], "doc_id long, text string, place int").repartition(5)
    got = pack_documents(df, PATH, window=64, shard_items=32, order_col="place").collect()
    seeds = {r["sequence_id"]: place[r["doc_id"]] for r in got if r["offset"] == 0}
    assert sorted(seeds) == list(range(len(seeds)))
    assert [seeds[k] for k in range(len(seeds))] == sorted(seeds.values())
    # Every prefix holds all documents before its last seed, whole.
    last = {}
    for r in got:
        last[place[r["doc_id"]]] = max(last.get(place[r["doc_id"]], 0), r["sequence_id"])
    for k, at in seeds.items():
        assert all(last[p] <= k for p in range(at))
