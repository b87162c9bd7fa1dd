import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertag.llm import links
from ledgertag.llm.common import utf8
from ledgertag.llm.jaccard import shingles, similar_documents
from tests.llm import brute

SCHEMA = "doc_id long, text string, id long, n int, label string, component_id int"


def run(spark, rows, parts=6, block=512):
    df = spark.createDataFrame([(i, t, 1, 2, "l", 3) for i, t in rows], SCHEMA).repartition(parts)
    return [(r["doc_id"], (r["n_shingles"], r["component_id"])) for r in similar_documents(df, block=block).collect()]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aB \té\n\x1c", max_size=40), min_size=1, max_size=6))
def test_shingles_like_their_definition(texts):
    found, bounds = shingles(*utf8(pa.array(texts)))
    plain = brute.word_sets(enumerate(texts))
    assert [len(plain[i]) for i in range(len(texts))] == np.diff(bounds).tolist()
    for i in range(len(texts)):
        for j in range(i):
            shared = set(found[bounds[i] : bounds[i + 1]]) & set(found[bounds[j] : bounds[j + 1]])
            assert len(shared) == len(plain[i] & plain[j])


def corpus(seed, groups, most):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    rows, i = [], 0
    passage = [rng.choice(words) for _ in range(60)]
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 20, 80, 300]))]
        if rng.random() < 0.5:
            base = passage + base
        for _ in range(rng.randrange(1, most)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((i * 3, " ".join(text)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows = corpus(seed, 80, 8)
    rows += [(10_000, None), (10_001, ""), (10_002, " \t "), (10_003, "long " * 9000 + "x"), (10_004, "one")]
    rows += [(10_005, "ONE"), (10_006, "a b c d"), (10_007, "A B\nC d")]
    got = run(spark, rows)
    assert dict(got) == brute.similar_documents(rows) and len(got) == len(rows)


def test_large_cells(spark):
    """Cells beyond a block, with near misses, are cut and still complete."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(2000)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(400):
        text = list(base)
        for _ in range(rng.randrange(0, 9)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    assert dict(run(spark, rows, block=40)) == brute.similar_documents(rows)


def test_null_and_repeated_ids_and_empty(spark):
    same = "one two three four five six seven"
    got = run(spark, [(None, same), (4, same), (4, same), (2, same), (9, "other")], 2)
    assert sorted(got, key=str) == sorted([(None, (3, None)), (4, (3, 2)), (4, (3, 2)), (2, (3, 2)), (9, (1, 9))], key=str)
    assert similar_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute.similar_documents([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_documents(docs).collect()}
    assert got == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    pairs = [(k, k + 1) for k in range(0, 60)] + [(100, 100 + k) for k in range(1, 80)]
    pairs += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(500, 500)]
    df = spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in pairs], "a long, b long")
    ids = {x for p in pairs for x in p}
    want = {i: r for i, r in brute.roots(ids, pairs).items() if i != r}
    assert {r["id"]: r["root"] for r in links.components(df).collect()} == want
