import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertag.llm.mixing import mix_sources, mixed_documents, phases, schedule, shares

SCHEMA = "doc_id long, text string, source string, slot int, block string"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.01, 50), min_size=1, max_size=12), st.integers(20, 400))
def test_every_prefix_is_within_one_block_of_the_shares(weights, period):
    parts = shares({f"s{i}": w for i, w in enumerate(weights)}, period)
    assert sum(parts.values()) == period and min(parts.values()) >= 1
    seen = Counter()
    for t, s in enumerate(schedule(parts), 1):
        seen[s] += 1
        assert all(abs(seen[x] * period - t * p) < period for x, p in parts.items())
    assert seen == parts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 90), st.floats(0.05, 9)), min_size=1, max_size=6))
def test_phases_like_walking_through_the_slots(sources):
    blocks = {f"s{i}": n for i, (n, _) in enumerate(sources)}
    weights = {f"s{i}": w for i, (_, w) in enumerate(sources)}
    got = {}
    for p in phases(blocks, weights, 30):
        period = sum(p.parts.values())
        order = schedule(p.parts)
        seen = Counter()
        for t in range(p.slots):
            s = order[t % period]
            got[p.start + t] = (s, p.first[s] + seen[s])
            assert p.places[s][seen[s] % p.parts[s]] == t % period
            seen[s] += 1
            assert all(abs(seen[x] * period - (t + 1) * q) < period for x, q in p.parts.items())
    assert sorted(got) == list(range(sum(blocks.values())))
    assert sorted(got.values()) == sorted((s, k) for s, n in blocks.items() for k in range(n))


@pytest.mark.parametrize("weights", [None, {"a": 1.0, "b": 3.0, "c": 0.5, "": 2.0}])
def test_rows(spark, weights):
    rng = random.Random(2)
    rows = [(i, f"t{i}", rng.choice(["a"] * 9 + ["b", "b", "c"])) for i in range(3000)]
    rows += [(None, None, None), (None, "x", None), (7, "same", "b"), (7, "same", "b")]
    df = spark.createDataFrame([(i, t, s, 1, "k") for i, t, s in rows], SCHEMA).repartition(9)
    got = mix_sources(df, weights=weights, block_rows=8).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((i, s or "") for i, _, s in rows)
    slots = {}
    for r in got:
        slots.setdefault(r["slot"], []).append(r)
    assert sorted(slots) == list(range(len(slots)))
    seen, phase, start = Counter(), None, 0
    share = {(r["phase"], r["source"]): r["share"] for r in got}
    for t in range(len(slots)):
        block = sorted(slots[t], key=lambda r: r["place"])
        assert len({(r["source"], r["block"], r["phase"]) for r in block}) == 1
        assert [r["place"] for r in block] == list(range(len(block))) and len(block) <= 8
        if block[0]["phase"] != phase:
            seen, phase, start = Counter(), block[0]["phase"], t
        seen[block[0]["source"]] += 1
        for (p, s), w in share.items():
            assert p != phase or abs(seen[s] - (t + 1 - start) * w) < 1
    for s in "abc":
        order = [(r["slot"], r["place"]) for r in sorted((r for r in got if r["source"] == s), key=lambda r: (r["doc_id"], r["block"], r["place"]))]
        assert order == sorted(order)


@pytest.mark.parametrize("rows", [250_000, 3_000_000])
def test_no_prefix_drifts_from_the_given_weights(rows):
    sizes = {f"s{i:02}": rows // 3 if not i else rows * 2 // 3 * i // 190 for i in range(20)}
    blocks = {s: -(-n // 32) for s, n in sizes.items()}
    weights = {s: n**0.5 for s, n in sizes.items()}
    plan = phases(blocks, weights)
    assert sum(p.slots for p in plan) == sum(blocks.values())
    for p in plan:
        total = sum(weights[s] for s in p.parts)
        t = np.arange(p.slots + 1)
        for s, places in p.places.items():
            period = min(sum(p.parts.values()), p.slots)
            seen = t // period * len(places) + np.searchsorted(places, t % period)
            assert np.abs(seen - t * (weights[s] / total)).max() < 1


def test_a_source_of_little_weight_gets_its_share(spark):
    rows = [(i, "t", "big" if i % 50 else "small", 1, "k") for i in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mix_sources(df, weights={"big": 1.0, "small": 0.0002}, block_rows=1).filter("phase = 0").collect()
    assert {r["source"]: r["share"] for r in got}["big"] == 1 / 1.0002
    assert sum(r["source"] == "small" for r in got) <= 1


def test_blocks_grow_with_the_rows(spark):
    """The driver works out a bounded number of slots; each source stays within one of the larger blocks."""
    rows = [(i, "t", "ab"[i % 3 == 0], 1, "k") for i in range(3000)]
    got = mix_sources(spark.createDataFrame(rows, SCHEMA), block_rows=2, most_blocks=100).collect()
    assert len({r["slot"] for r in got}) <= 102 and max(r["place"] for r in got) == 29
    seen = Counter()
    phase = [r for r in got if r["phase"] == 0]
    for t, r in enumerate(sorted((r for r in phase if r["place"] == 0), key=lambda r: r["slot"])):
        seen[r["source"]] += 1
        for s, share in {(r["source"], r["share"]) for r in phase}:
            assert abs(seen[s] - (t + 1) * share) < 1


def test_columns_of_any_name(spark):
    names = ["doc_id", "text", "source", "_row", "_mix_id", "_mix_at", "_mix_part", "_doc", "_hash"]
    df = spark.createDataFrame([(i, f"t {i}", "s", *[i] * 6) for i in range(20)], names)
    got = mixed_documents(df)
    assert got.columns == names and sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_documents_come_in_order_of_the_mix(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    places = {r["doc_id"]: (r["slot"], r["place"]) for r in mix_sources(docs, block_rows=4).collect()}
    mixed_documents(docs, block_rows=4).write.parquet(str(tmp_path / "mix"))
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert back.columns == docs.columns
    order = [r["doc_id"] for r in back.orderBy("_metadata.file_name", "_metadata.row_index").collect()]
    assert order == sorted(places, key=places.get)


def test_empty_and_bad_weights(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mix_sources(df).collect() == [] and mixed_documents(df).collect() == []
    one = spark.createDataFrame([(1, "t", "a", 1, "k")], SCHEMA)
    with pytest.raises(ValueError, match="positive weight"):
        mix_sources(one, weights={"b": 1.0})
