import hashlib
import random

import pytest

from ledgertag.llm.repeats import LENGTH, remove_repeats

SCHEMA = "doc_id long, text string, n_bytes int, runs string, doc string"


def brute(rows):
    """Straight from the definition; equal rows count once."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - LENGTH + 1):
            window = raw[k : k + LENGTH]
            if window in seen:
                gone[k : k + LENGTH] = b"\1" * LENGTH
            seen.add(window)
        spans = [k for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1])]
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out[i] = (len(raw), len(spans), hashlib.sha256(kept).hexdigest())
    return out


def run(spark, rows, parts=5):
    df = spark.createDataFrame([(i, t, 1, "r", "d") for i, t in rows], SCHEMA).repartition(parts)
    return [
        (r["doc_id"], (r["n_bytes"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()))
        for r in remove_repeats(df).collect()
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_like_brute_force(spark, seed):
    rng = random.Random(seed)
    letters = "ab" if seed == 1 else "abcdefgh é\U0001f600"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(rng.choice([60, 99, 100, 101, 140, 400])) for _ in range(8)]
    rows = []
    for i in range(90):
        t = "".join(rng.choice([text(rng.randrange(150)), rng.choice(passages)]) for _ in range(rng.randrange(8)))
        rows.append((i * 3, t))
    rows += [(1000 + i, rows[i][1]) for i in range(0, 90, 7)]  # whole copies
    rows += [(2000, "a" * 350), (2001, "a" * 99), (2002, "ab" * 300), (2003, ""), (2004, None), (2005, "xyz" * 5000)]
    got = run(spark, rows)
    assert dict(got) == brute(rows) and len(got) == len(rows)


def test_repeated_rows_and_null_ids(spark):
    long = "".join(random.Random(i).choice("abcdefghij") for i in range(300))
    rows = [(None, long), (5, long), (5, long), (6, long + "tail"), (6, "zz" + long[:150])]
    got = run(spark, rows, 2)
    assert len(got) == 5
    by = {}
    for i, r in got:
        by.setdefault(i, set()).add(r[:2])
    assert by[None] == {(300, 0)} and by[5] == {(300, 1)} and by[6] == {(304, 1), (152, 1)}
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {
        r["doc_id"]: (r["n_bytes"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
        for r in remove_repeats(docs).collect()
    }
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
