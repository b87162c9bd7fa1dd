import random
import time

import numpy as np
import pyarrow as pa

from ledgertag.llm.common import utf8
from ledgertag.llm.lines import CHARS, band_keys, dedup_lines, shingle_hashes, shingles, trimmed_lines
from ledgertag.llm.links import DEALT, _cells, _forests, bitmap, dealt, dealt_bare
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_lines string, doc string, tie int"


def plain(rows):
    """Texts after deduplication by all pairs of lines; and how many lines each loses."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    places = {}
    for i, t in order:
        for k, line in enumerate((t or "").split("\n")):
            line = line.strip(" \t\r\n\f\v")
            if line:
                places.setdefault(line, []).append((i, k))
    names = list(places)  # in order of first occurrence
    sets = {}
    for n, line in enumerate(names):
        sets[n] = frozenset(line[k : k + CHARS] for k in range(max(1, len(line) - CHARS + 1)))
    root = brute.roots(sets, brute.linked_pairs(sets))
    gone = {}
    for n, line in enumerate(names):
        for k, place in enumerate(places[line]):
            if k or root[n] != n:
                gone.setdefault(place[0], set()).add(place[1])
    out = {}
    for i, t in order:
        g = gone.get(i, set())
        out[i] = ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in g) if g else t, len(g))
    return out


def run(spark, rows, parts=5):
    df = spark.createDataFrame([(i, t, "n", "l", 1) for i, t in rows], SCHEMA).repartition(parts)
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "text", "doc", "tie", "n_lines", "n_removed"]
    return {r["doc_id"]: (r["text"], r["n_removed"]) for r in got.collect()}


def test_lines_and_their_names():
    texts = ["a\n\n b b \n", "", "\n\n", "é\r\nx", "a"]
    row, place, lines, name = trimmed_lines([t.encode() for t in texts])
    found = [(int(r), int(p), x.decode()) for r, p, x in zip(row, place, lines)]
    assert found == [(0, 0, "a"), (0, 2, "b b"), (3, 0, "é"), (3, 1, "x"), (4, 0, "a")]
    assert name[0] == name[4] and len(set(name.tolist())) == 4


def test_shingles_like_their_definition():
    rng = random.Random(1)
    lines = ["".join(rng.choice("ab é\U0001f600") for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    _, bounds = shingles(*utf8(pa.array(lines)))
    want = [len({x[k : k + CHARS] for k in range(max(1, len(x) - CHARS + 1))}) for x in lines]
    assert np.diff(bounds).tolist() == want


def test_like_brute_force(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnop qrstuvwxyzé"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n)).strip() or "x"
    bases = [text(rng.choice([5, 12, 60, 200])) for _ in range(30)]

    def line():
        if rng.random() < 0.4:
            return text(rng.randrange(1, 120))
        t = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            t[rng.randrange(len(t))] = rng.choice(letters)
        return "".join(t)

    rows = [(i * 2, "\n".join(line() if rng.random() < 0.95 else " " for _ in range(rng.randrange(1, 9)))) for i in range(200)]
    rows += [(9000, None), (9001, ""), (9002, "\n\n"), (9003, text(80000)), (9004, rows[0][1]), (None, rows[1][1])]
    got, want = run(spark, rows), plain(rows)
    wrong = [i for i in want if got[i] != want[i]]
    lost = sum(n for _, n in want.values())
    assert lost > 200 and len(wrong) <= 3  # bands miss few pairs
    assert got[9004][0] == "\n".join(x for x in rows[0][1].split("\n") if not x.strip()) and got[9000] == (None, 0)


def test_members_that_meet_under_several_keys_make_one_cell(spark):
    def cells(sets, block):
        """Sets of ids that are met in one cell, with their sides, from the keys of each id."""
        ids = np.array(sorted(sets), np.int64)
        keys = [np.array(sets[i], np.uint64) for i in ids.tolist()]
        packed = dealt(ids, ids.view(np.uint64), np.zeros(len(ids), np.int32), keys, 3)
        payloads = spark.createDataFrame(list(zip(*(c.to_pylist() for c in packed.columns), strict=True)), DEALT)
        found = {}
        for r in _cells(payloads, 3, block, merged=True).collect():
            found.setdefault(r.cell, []).append((r.id, r.side))
        return sorted(sorted(v) for v in found.values())

    pair, triple = [(1, 0), (2, 0)], [(1, 0), (2, 0), (3, 0)]
    sets = {1: [5, 6, 7, 8, 9], 2: [5, 6, 7, 8, 9], 3: [8, 9, 10], 4: [11]}
    assert cells(sets, 512) == [pair, triple]
    # Blocks of two of the triple, beside the pair, which is the first of them.
    assert cells(sets, 2) == [pair, [(1, 0), (2, 0), (3, 1)], [(3, 0)]]


def test_ids_and_halves_of_keys_meet_like_whole_rows(spark):
    rng = np.random.default_rng(3)
    ids = np.sort(rng.choice(1 << 60, 300, replace=False)).astype(np.int64)
    keys = rng.integers(0, 1 << 63, 150, dtype=np.uint64)[rng.integers(0, 150, (300, 4))]
    packed = dealt(ids, ids.view(np.uint64), np.zeros(300, np.int32), list(keys), 5), dealt_bare(ids, keys, 5)
    found = []
    for p, bare in zip(packed, (False, True), strict=True):
        payloads = spark.createDataFrame(list(zip(*(c.to_pylist() for c in p.columns), strict=True)), DEALT)
        found.append({tuple(r) for r in _cells(payloads, 5, 7, merged=True, bare=bare).collect()})
    assert found[0] == found[1] and len(found[0]) > 300
    sizes = [sum(len(x) for x in p.column("payload").to_pylist()) for p in packed]
    assert sizes == [1200 * 28, 1200 * 12]


def test_cells_of_few_pairs_are_checked_whole(spark):
    """Three sets have no more pairs than members; four have, and only a forest of theirs is checked first."""
    bits = [bitmap(np.arange(40, dtype=np.uint64) + np.uint64(k), 4) for k in range(4)]
    rows = [(c, 10 * c + k, 0, 40, bits[k]) for c, m in ((1, 2), (2, 3), (3, 4)) for k in range(m)]
    rows.append((4, 40, 0, 40, bits[0]))
    rows.append((4, 41, 0, 400, bitmap(np.arange(400, dtype=np.uint64), 4)))  # may not link
    members = spark.createDataFrame(rows, "cell long, id long, side int, n int, bits binary").coalesce(1).sortWithinPartitions("cell")
    found = {}
    for r in _forests(members).collect():
        found.setdefault((r.cell, r.complete), set()).add((r.a, r.b))
    assert found[1, True] == {(10, 11)} and found[2, True] == {(20, 21), (20, 22), (21, 22)}
    assert len(found[3, False]) == 3 and len(found) == 3


def test_a_group_of_most_lines(spark):
    """Half of all lines are alike, in some spellings; that group is joined where its rows are."""
    base = "the very same notice that stands below every page of this collection"
    notices = [base, base.replace("page", "leaf", 1), base.upper(), " " + base]
    rows = [(i, f"words of text {i * 7919} and {i * 104729}\n{notices[i % 4]}\n{i}") for i in range(120)]
    assert run(spark, rows) == plain(rows)


def test_repeated_rows_and_empty(spark):
    rows = [(3, "alpha beta gamma delta\nother words here"), (3, "alpha beta gamma delta\nother words here"), (4, "alpha beta gamma delta ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, dedup_lines(df).collect()))
    assert got == [(3, rows[0][1], 2, 0)] * 2 + [(4, "", 1, 1)]
    assert dedup_lines(df.limit(0)).collect() == []


def test_columns_of_any_name(spark):
    names = ["doc_id", "text", "_row", "_dl_gone", "_dl_doc", "_dl_tie", "line", "n_lines"]
    rows = [(i, f"one line of text\nline number {i}{i}{i}", *[i] * 6) for i in range(6)]
    got = sorted(map(tuple, dedup_lines(spark.createDataFrame(rows, names)).collect()))
    assert [r[:7] for r in got] == [(i, t if not i else t.split("\n")[1], *[i] * 5) for i, t, *_ in rows]


def test_short_lines_are_fast():
    """A megabyte of numbers, one a line."""
    digits = np.random.default_rng(1).integers(48, 58, 8 * 110_000).astype(np.uint8)
    begin = time.process_time()
    keys = band_keys(*shingle_hashes(digits, np.arange(110_001) * 8))
    assert keys.shape == (110_000, 14) and time.process_time() - begin < 5


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in dedup_lines(docs).collect()}
    assert sum(got[i] != want[i] for i in want) <= len(want) // 200


def test_rules_of_any_length_are_similar(spark):
    rules = [c * n for c in "-*=" for n in (6, 7, 8, 9, 10, 11, 12, 40)] + ["-=" * 4, "-=" * 5, "-=" * 6, "éééé", "é" * 9, "é" * 20]
    rows = [(i, f"line of its own, number {i * 7919}\n{r}") for i, r in enumerate(rules)]
    assert run(spark, rows) == plain(rows)
