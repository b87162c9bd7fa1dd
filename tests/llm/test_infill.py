import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertag.llm.common import utf8
from ledgertag.llm.infill import PieceTable, fill_in_middle, restore_documents, token_starts

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")
SCHEMA = "doc_id long, text string, id long, n int, form string, output string, pieces int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_version(doc_id, text):
    """The contract, over strings."""
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(tokens)
    p, m = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:p]), "".join(tokens[p:m]), "".join(tokens[m:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(i, t, 1, 2, "f", "o", 3) for i, t in rows], SCHEMA).repartition(parts)
    return restore_documents(fill_in_middle(df)).collect()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aZ é\n<日\U0001f600", max_size=30), min_size=1, max_size=5))
def test_tokens_like_their_definition(texts):
    raw, bounds = utf8(pa.array(texts))
    _, places, at = token_starts(raw, bounds)
    for k, text in enumerate(texts):
        ends, found = 0, []
        for token in TOKEN.findall(text):
            found.append(ends + bounds[k])
            ends += len(token.encode())
        assert places[at[k] : at[k + 1]].tolist() == found


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<PSM>ab", max_size=20), st.data(), st.sampled_from(["psm", "spm", "plain"]))
def test_tables_restore(text, data, form):
    raw = text.encode()
    if form != "plain" and any(x in text for x in ("<P>", "<S>", "<M>")):
        form = "plain"
    a, b = sorted(data.draw(st.integers(0, len(raw))) for _ in range(2))
    table = PieceTable.whole(raw)
    table.cut(a)
    table.cut(b)
    assert table.joined() == raw
    out = table.arranged(form)
    assert out.restored(form).joined() == raw
    assert out.sha256() == hashlib.sha256(out.joined()).hexdigest()
    assert PieceTable.parsed(out.joined(), form).restored(form).joined() == raw


def test_a_cut_beyond_the_end():
    with pytest.raises(ValueError):
        PieceTable.whole(b"ab").cut(3)


def test_like_the_plain_version(spark):
    texts = [None, "", "x", "one two", "a<P>b", "<S", "S><M", "é" * 50, "日本語 text\n\twith 123 things", " ", "ab " * 70_000]
    rows = [(i, texts[i % len(texts)]) for i in range(220)] + [(None, "no id"), (7, "a b c"), (7, "a b c"), (-5, "minus five")]
    got = run(spark, rows)
    assert len(got) == len(rows)
    want = sorted((repr(i), *plain_version(i, t), t or "") for i, t in rows)
    found = sorted(
        (repr(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in got
    )
    assert found == want
    assert all(r["output_sha256"] == sha(r["output"]) and r["restored_sha256"] == sha(r["restored"]) for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    # The descriptors are the output.
    texts_of = {(repr(i), plain_version(i, t)[4]): (t or "").encode() for i, t in rows}
    for r in got:
        buffers = (texts_of[repr(r["doc_id"]), r["output"]], b"<P><S><M>")
        assert b"".join(buffers[p.buffer][p.start : p.start + p.length] for p in r["pieces"]).decode() == r["output"]


def test_empty_and_null_outputs(spark):
    assert run(spark, []) == []
    rows = spark.createDataFrame([(None, "psm", 1)], "output string, form string, restored int")
    r = restore_documents(rows).first()
    assert r["restored"] is None and r["restored_sha256"] is None


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted((r["doc_id"], *plain_version(r["doc_id"], r["text"])[:4], sha(plain_version(r["doc_id"], r["text"])[4]), sha(r["text"] or "")) for r in docs.collect())
    got = restore_documents(fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )
    assert sorted(tuple(r) for r in got.collect()) == want
