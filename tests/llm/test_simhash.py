import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertag.llm import simhash
from tests.llm import brute

SCHEMA = "doc_id long, text string, id long, print int, n int, component_id string"


def plain_print(text):
    w = brute.WORD.findall((text or "").translate(brute.LOWER))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0


def near(prints):
    a = np.array(prints, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 3):
            yield i, i + 1 + int(j)


def plain_version(rows):
    """Fingerprint and component of rows with distinct ids."""
    prints = [plain_print(t) for _, t in rows]
    roots = brute.roots([i for i, _ in rows], [(rows[x][0], rows[y][0]) for x, y in near(prints)])
    return {i: (f"{p:016x}", roots[i]) for (i, _), p in zip(rows, prints, strict=True)}


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(i, t, 1, 2, 3, "c") for i, t in rows], SCHEMA).repartition(parts)
    return [(r["doc_id"], (r["fingerprint"], r["component_id"])) for r in simhash.simhash_duplicates(df).collect()]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB \té\n\x1c", max_size=60), st.integers(1, 20))
def test_fingerprints_like_their_definition(text, step):
    assert simhash.fingerprint(text.encode()) == plain_print(text)
    pieces = [x for h in simhash.shingle_hashes(text.encode(), step) for x in h.tolist()]
    assert pieces == [x for h in simhash.shingle_hashes(text.encode()) for x in h.tolist()]


def flipped(rng, x, most):
    for k in rng.sample(range(64), rng.randrange(most + 1)):
        x ^= 1 << k
    return x


@pytest.mark.parametrize("seed, n, centres, most", [(1, 400, 20, 5), (2, 3000, 1, 6), (3, 2500, 2, 2), (4, 300, 300, 0)])
def test_chains_find_all_pairs(seed, n, centres, most):
    """Cells with few alike rows are listed, those with many are followed segment by segment."""
    rng = random.Random(seed)
    middles = [rng.getrandbits(64) for _ in range(centres)]
    prints = sorted({flipped(rng, rng.choice(middles), most) for _ in range(n)})
    want = {frozenset((prints[i], prints[j])) for i, j in near(prints)}
    found = set()
    for s in range(4):
        by = 16 * s
        turned = sorted((((x << by) | (x >> (64 - by))) & (2**64 - 1), x) for x in prints)
        cell = np.unique(np.array([t >> 48 for t, _ in turned]), return_inverse=True)[1]
        for i, j in simhash.chains(cell, np.array([t for t, _ in turned], np.uint64)):
            found |= {frozenset((turned[x][1], turned[y][1])) for x, y in zip(i.tolist(), j.tolist(), strict=True)}
    assert found == want


@pytest.mark.parametrize("hot", [False, True])
def test_links_of_prints(spark, hot):
    """Components of fingerprints alone; with one dense group its cells are cut."""
    rng = random.Random(5)
    middles = [rng.getrandbits(64) for _ in range(1 if hot else 150)]
    prints = sorted({flipped(rng, rng.choice(middles), 7 if hot else 4) for _ in range(1500)})
    ids = list(range(10, 10 + len(prints)))
    rng.shuffle(ids)
    signed = [x - 2**64 if x >> 63 else x for x in prints]
    reps = spark.createDataFrame(list(zip(ids, signed, strict=True)), "id long, print long").repartition(5)
    links = [(r["a"], r["b"]) for r in simhash.near_prints(reps, len(prints)).collect()]
    at = dict(zip(ids, prints, strict=True))
    assert all((at[a] ^ at[b]).bit_count() <= 3 for a, b in links)
    want = brute.roots(ids, [(ids[i], ids[j]) for i, j in near(prints)])
    assert brute.roots(ids, links) == want
    assert len(links) < 8 * len(prints)


def test_like_brute_force(spark):
    rng = random.Random(11)
    words = [f"W{k}" for k in range(900)]
    rows, i = [], 0
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 200, 400]))]
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((i * 7 - 40, rng.choice([" ", "\n", "  "]).join(text)))
            i += 1
    rows += [(9001, None), (9002, ""), (9003, "\t \n"), (9004, "wörd " * 30_000 + "end"), (9005, "x" * 2_000_000), (9006, "one")]
    rng.shuffle(rows)
    got = run(spark, rows)
    assert dict(got) == plain_version(rows) and len(got) == len(rows)
    assert len({c for _, (_, c) in got}) < len(rows) - 50


def test_null_and_repeated_ids_ties_and_empty(spark):
    same = "one two three four"
    p = f"{plain_print(same):016x}"
    other = f"{plain_print('other'):016x}"
    got = run(spark, [(None, same), (4, same), (4, same), (2, same), (9, "other"), (2, None), (None, None)], 2)
    zero = "0" * 16
    want = [(None, (p, None)), (4, (p, 2)), (4, (p, 2)), (2, (p, 2)), (9, (other, 9)), (2, (zero, 2)), (None, (zero, None))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert run(spark, []) == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_duplicates(docs).collect()}
    assert got == plain_version(rows)


def test_chain_budgets_miss_nothing():
    """Every difference of at most three bits starts a chain at some segment."""
    for bits in range(4):
        for places in combinations(range(0, 64, 5), bits):
            count = [sum(p // 16 == s for p in places) for s in range(4)]
            ok = any(all(sum((count * 2)[s : s + k + 1]) <= simhash.BUDGETS[k] for k in range(4)) for s in range(4))
            assert ok
