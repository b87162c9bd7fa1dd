import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertag.llm.common import utf8
from ledgertag.llm.fingerprints import (
    as_string,
    compare_fingerprints,
    fingerprint_documents,
    fingerprint_edits,
    likeness,
    next_level,
    samples,
)

SCHEMA = "doc_id long, text string, n_chars long, fingerprint string, _run int"


def one(text):
    return samples(*utf8(pa.array([text])))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é", max_size=60), min_size=1, max_size=8))
def test_a_text_parses_alike_alone_and_in_a_batch(texts):
    together = samples(*utf8(pa.array(texts)))
    for i, t in enumerate(texts):
        assert (together[i] == one(t)[0]).all()


def test_phrases_inside_a_shared_substring_are_shared():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij ") for _ in range(400))
    shared = word()
    names = []
    for before in ("", "x", word()[:137], word()):
        symbols, bounds = utf8(pa.array([before + shared + word()]))
        for _ in range(3):
            symbols, bounds = next_level(symbols, bounds)
        names.append(set(symbols.tolist()))
    assert all(len(names[0] & n) >= 12 for n in names[1:])


def reference(rows):
    """The edited texts, straight from their definition."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        n = len(text)
        out[i] = (n, text[: n - n // 2] + after[: n // 2], text, after)
    return out


def test_edits_like_their_definition(spark):
    rng = random.Random(7)
    rows = [(i * 3 - 50, "".join(rng.choice("abcé ü\U0001f600\n") for _ in range(rng.choice([0, 1, 2, 5, 90, 700])))) for i in range(120)]
    rows += [(1000, None), (1001, ""), (2000, "word " * 20000), (2001, "same"), (2002, "same")]
    df = spark.createDataFrame([(i, t, 1, "f", 2) for i, t in rows], SCHEMA).repartition(6)
    got = {r["doc_id"]: r for r in fingerprint_edits(df).collect()}
    want = reference(rows)
    assert set(got) == set(want) and len(got) == len(rows)
    for i, (n, edited, text, after) in want.items():
        r = got[i]
        assert r["n_chars"] == n
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == as_string(one(text)[0])
        assert r["edited_fingerprint"] == as_string(one(edited)[0])
        assert r["near_edited"] == compare_fingerprints(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == likeness(one(text), one(after))[0]
    assert got[2001]["fingerprint"] == got[2002]["fingerprint"] and got[2002]["near_next"] == 1.0


def test_few_rows_nulls_and_repeats(spark):
    assert fingerprint_edits(spark.createDataFrame([], SCHEMA)).collect() == []
    single = fingerprint_edits(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).collect()
    assert single[0]["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()
    rows = [(None, "nothing"), (None, "else"), (3, "abcd"), (3, "abcd"), (3, "wxyz")]
    got = fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["3", "3", "3", "None", "None"]


def test_likeness_tells_halves_from_strangers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = fingerprint_edits(docs).toPandas()
    long = got[got["n_chars"] >= 300]
    assert (long["near_edited"] > long["near_next"]).mean() > 0.99
    assert 0.35 < np.median(long["near_edited"]) < 0.7 and np.median(long["near_next"]) < 0.05
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprint_documents(docs).collect()}
    assert plain == dict(zip(got["doc_id"], got["fingerprint"]))
