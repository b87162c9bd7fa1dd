"""The mask language."""

import random

import pytest
from pyspark.sql import functions as F

from ledgertag.functions import masks as m
from tests import model


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, []),
        ("", []),
        (",,,", []),
        ("a", ["a"]),
        ("a, b", ["a", "b"]),
        ("TEST/, SOME COMMA, b,", ["TEST, SOME COMMA", "b"]),
        ("a/,,", ["a,"]),
        (",a", ["", "a"]),
        ("a,,b", ["a", "", "b"]),
        ("a, ", ["a", ""]),
        (" ", [""]),
        ("\ta\r\n,\x01b\x1f", ["a", "b"]),
        ("11117%, 2?102", ["11117%", "2_102"]),
        ("a/b", ["a/b"]),
        ("//,", ["/,"]),
        (" a", [" a"]),
    ],
)
def test_lists(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(m.compile_masks(F.col("t"))).head()[0] == expected
    assert model.masks(text) == expected


def test_random_lists_agree_with_the_model(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab/,?% \n_", k=rng.randrange(12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, got in df.select("t", m.compile_masks(F.col("t"))).collect():
        assert got == model.masks(text), repr(text)


def random_lists(rng, n, most):
    def word(letters, size):
        return "".join(rng.choices(letters, k=rng.randrange(size)))

    return [
        (
            rng.choice([None, word("ab\nй", 6)]) if k % 9 == 0 else word("abй", 6),
            [word("abй%%_", 5) for _ in range(rng.randrange(1, most))],
        )
        for k in range(n)
    ] + [("a%b", ["a\\%b"]), ("a_b", ["a\\_%"]), ("axb", ["a\\_b"]), ("", [""]), (None, [""]), ("", ["%"]), (None, ["%"])]


def test_parsed_masks_agree_with_like(spark):
    rows = random_lists(random.Random(2), 4000, 4)
    df = spark.createDataFrame(rows, "v string, p array<string>").select(
        "v",
        "p",
        m.any_like(F.col("v"), F.col("p")).alias("slow"),
        m.any_mask(F.col("v"), m.parse_masks(F.col("p"))).alias("fast"),
    )
    for r in df.collect():
        assert r.slow == r.fast, r
        if not any("\\" in p for p in r.p):
            assert r.fast == model.any_like(r.v, r.p), r


@pytest.mark.parametrize("required", [True, False])
def test_framed_texts_let_all_pass_that_may(spark, required):
    """Where a form is exact it decides; else it only lets too much pass. Lists that exclude refuse null values."""
    rows = random_lists(random.Random(3), 3000, 5)
    df = spark.createDataFrame(rows, "v string, p array<string>")
    form = m.frames(m.parse_masks(F.col("p")), F.lit(required), F.lit(m.SLOTS))
    df = df.select("v", "p", m.framed(F.col("v")).alias("w"), m.any_like(F.col("v"), F.col("p")).alias("hit"), form.alias("f"))
    hit = F.array_contains("f.whole", F.col("w"))
    for k in range(m.SLOTS):
        size = F.get("f.sizes", F.lit(k))
        hit = hit | (F.contains("w", F.get("f.texts", F.lit(k))) & ((size < 0) | (F.char_length("w") == size + 2)))
    passes = hit if required else ~hit & (F.col("w") != "")
    found = df.select("v", "p", "hit", "f.exact", passes.alias("passes")).collect()
    for r in found:
        want = r.hit is True if required else r.hit is False
        assert r.passes == want if r.exact else r.passes >= want, r
    assert sum(r.exact for r in found) > 500 and sum(not r.exact for r in found) > 500


def test_what_is_looked_for(spark):
    e = "\ufffd"  # how the edge's byte is read back
    cases = {
        "abc": (f"{e}abc{e}", -1, True),
        "": (e + e, -1, True),
        "%": (e, -1, True),
        "ab%%": (e + "ab", -1, True),
        "ab__": (e + "ab", 4, True),
        "__ab": ("ab" + e, 4, True),
        "_": ("", 1, True),
        "%ab": ("ab" + e, -1, True),
        "%ab%": ("ab", -1, True),
        "a_%": (e + "a", -1, False),
        "a%bc": ("bc" + e, -1, False),
        "47423_____________37%": (e + "47423", -1, False),
        "%a_bcd_e%": ("bcd", -1, False),
        "a\\%": (e + "a", -1, False),
    }
    df = spark.createDataFrame([(list(cases),)], "p array<string>")
    got = df.select(F.inline(m.parse_masks(F.col("p")))).select("text", "length", "told").collect()
    assert [(bytes(r.text, "utf-8", "replace").decode(), r.length, r.told) for r in got] == list(cases.values())


def test_patterns_that_like_refuses_are_found(spark):
    cases = {"a": True, "a\\%": True, "a\\\\": True, "a\\": False, "a\\b": False}
    for pattern, valid in cases.items():
        df = spark.createDataFrame([([pattern],)], "p array<string>")
        assert df.select(m.all_valid(F.col("p"))).head()[0] is valid


def test_underscore_is_a_wildcard(spark):
    df = spark.createDataFrame([("AUTO-KNU", ["AUTO_KNU"])], "v string, p array<string>")
    assert df.select(m.any_mask(F.col("v"), m.parse_masks(F.col("p")))).head()[0]
