import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertag.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, id long, units int, n_a string, block int, b int"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain_tokens(text):
    """Ids and byte ends of both tokenizers over a whole text, by decoded bytes alone; none if the bytes differ."""
    a, b = alignment.tokenizers_of(A, B)
    if not text:
        return None
    found = []
    for ids, names in ((a.own.encode(" " + text, add_special_tokens=False).ids, a.bytes), (b.own.encode(text), b.bytes)):
        if b"".join(names[i] for i in ids) != (" " + text).encode():
            return None
        found.append((ids, np.cumsum([len(names[i]) for i in ids]).tolist()))
    return found


def plain_version(rows):
    docs, counts = [], collections.Counter()
    for i, text in rows:
        tokens = plain_tokens(text)
        if not tokens:
            docs.append((i, 0, 0, 0, [], ""))
            continue
        (ids_a, ends_a), (ids_b, ends_b) = tokens
        at_a = {e: k for k, e in enumerate(ends_a)}
        links, groups, x, y = [], [], 0, 0
        for q, e in enumerate(ends_b):
            if e in at_a:
                p = at_a[e]
                links.append((ids_a[p], ids_b[q]))
                groups.append(",".join(map(str, ids_a[x : p + 1])) + "|" + ",".join(map(str, ids_b[y : q + 1])))
                x, y = p + 1, q + 1
        counts.update(links)
        docs.append((i, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (i, na, nb, ng, len(ln), sum(counts[x] == best[x[1]] for x in ln), sum(counts[x] for x in ln), h)
        for i, na, nb, ng, ln, h in docs
    ], counts


def run(spark, rows, parts=3, **limits):
    df = spark.createDataFrame([(i, t, 1, 2, "n", 3, 4) for i, t in rows], SCHEMA).repartition(parts)
    docs, totals = alignment.align_tokenizers(df, A, B, **limits)
    return [tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in docs.collect()], totals.collect()


def key(row):
    return tuple((x is None, x) for x in row)


TEXTS = [
    None, "", " ", "  two  blanks ", "plain words here", "naïve café — 日本語テキスト", "\U0001f600\U0001f601 smile", "tab\tand\r\nnewline \n",
    "a<|endoftext|>b </s> <unk> <0x41>", "▁ underline", "a▁b here", "x▁", "no break space　wide", "\x00\x01 control", "x" * 5000,
    "é combining  ́ alone", "﻿mark", "don't we'll I'm 'S", "1234567 89 3.14", "word " * 4000, "\x1c\x1d \x85 next", "a ▁b",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet=" a▁é日\n '1<>.", max_size=40)), max_size=6))
def test_units_like_whole_texts(texts):
    """Cutting into units changes no token."""
    block = alignment.Block(*alignment.tokenizers_of(A, B))
    for k, (text, own) in enumerate(zip(texts, block.units(texts), strict=True)):
        block.add(k, text, own)
    want, counts = plain_version(enumerate(texts))
    assert [d[:6] for d in block.docs] == [(i, na, nb, ng, nl, h) for i, na, nb, ng, nl, _, _, h in want]
    if texts:
        held = block.rows(0)
        codes, n = (np.frombuffer(held.column(c)[len(texts)].as_py(), np.int64) for c in ("codes", "counts"))
        assert {(int(c) >> 32, int(c) & 0xFFFFFFFF): int(x) for c, x in zip(codes, n, strict=True) if x} == dict(counts)


def test_spans_of_parts_of_characters():
    a, b = alignment.tokenizers_of(A, B)
    text = "日本 🤔x ﷽"
    for tokenizer, own, shift in ((a, " " + text, 0), (b, text, 1)):
        ids, spans = tokenizer.encode([own])
        sizes = tokenizer.sizes[ids[0]]
        if tokenizer is a:
            places = np.append(np.cumsum([0] + [len(c.encode()) for c in own])[:-1], len(own.encode()))
            spans = places[spans]
        assert alignment.byte_ends(spans + shift, sizes).tolist() == np.cumsum(sizes).tolist()
        assert (spans[:, 1] - spans[:, 0] != sizes).any()


@pytest.mark.parametrize("limits", [{}, {"block": (60, 10)}])
def test_like_the_plain_version(spark, limits):
    """In one block per task, and in many small ones."""
    rng = random.Random(3)
    words = ["alpha", "béta", "gamma,", "δelta", "(eps)", "zeta."]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(150)]
    rows += [(None, "no id"), (5, "alpha"), (5, "alpha"), (7, None)]
    got, totals = run(spark, rows, **limits)
    want, counts = plain_version(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {(r["a"], r["b"]): r["total"] for r in totals} == dict(counts)


def test_empty(spark):
    assert run(spark, []) == ([], [])
    assert run(spark, [(1, None)]) == ([(1, 0, 0, 0, 0, 0, 0, "")], [])


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, _ = plain_version([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = alignment.align_tokenizers(docs, A, B)[0]
    assert sorted(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got.collect()) == sorted(want)
