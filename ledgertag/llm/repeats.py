"""Removal of every byte that an earlier equal string of a given length covers.

Suffixes are sampled: a place is sampled if the hash of the ``GRAM`` bytes from there is the least
in some window of ``LENGTH`` bytes, so every window holds a sampled suffix, at the
same place in equal windows. Sampled suffixes that begin alike meet in one task.
There they are sorted, with the common-prefix value of each and the one before it, and
the order of the suffixes that begin 1, 2, ... bytes further left is induced from
theirs: two of them are equal over ``LENGTH`` bytes if the bytes on the left are equal and the
common prefix of the sampled suffixes covers the rest. Sampled suffixes whose windows
are all equal are told by hash and only the earliest of them is sorted.

All sorting of unbounded data is done by Spark's shuffle, which spills to disk. Strings
are told apart by 64-bit hashes of what surrounds a 64-bit hash of the sampled
bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import SLICE, mixed, slices, tasks, text_of, utf8, written

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1  # grams in a string of LENGTH bytes

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of two adjoining strings' hashes."""
    x = a * _A
    x += b
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def grams_and_windows(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the GRAM bytes and of the LENGTH bytes that start at each place (as far as there are any)."""
    h = raw.astype(np.uint64) + np.uint64(1)
    for k in (1, 2, 4, 8, 16):
        h = _joined(h[:-k], h[k:])
    gram = h
    h = _joined(h[:-32], h[32:])
    return gram, _joined(h[: -(LENGTH - 64)], h[LENGTH - 64 :])


def anchors(raw: np.ndarray, bounds: np.ndarray):
    """Runs of windows that share a sampled suffix: its place, the first and the last window.

    And for each run the hash of the sampled bytes and the hash of all bytes of its windows.
    """
    n = len(raw)
    if n < LENGTH or not (np.diff(bounds) >= LENGTH).any():
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    gram, window = grams_and_windows(raw)
    least = gram
    for k in (1, 2, 4, 8, 16, 32):
        least = np.minimum(least[:-k], least[k:])
    least = np.minimum(least[: -(SPAN - 64)], least[SPAN - 64 :])  # one per window
    total = len(least)
    valid = np.zeros(total, bool)
    step = np.zeros(total + 1, np.int32)
    has = np.diff(bounds) >= LENGTH
    step[bounds[:-1][has]] += 1
    step[bounds[1:][has] - LENGTH + 1] -= 1
    valid = np.cumsum(step[:-1]) > 0
    leaves = gram[:total] == least
    ends = leaves.copy()
    ends[:-1] |= (least[1:] != least[:-1]) | ~valid[1:]
    ends[-1] = True
    ends &= valid
    last = np.flatnonzero(ends)
    starts = valid.copy()
    starts[1:] &= ends[:-1] | ~valid[:-1]
    first = np.flatnonzero(starts)
    anchor = last.copy()
    seek = np.flatnonzero(~leaves[last])
    for at in range(0, len(seek), 1 << 16):
        rows = last[seek[at : at + (1 << 16)]]
        hit = gram[rows[:, None] + np.arange(SPAN)] == least[rows][:, None]
        anchor[seek[at : at + (1 << 16)]] = rows + hit.argmax(axis=1)
    shape = ((last - first) * LENGTH + anchor - first).astype(np.uint64)
    around = mixed(_joined(window[first], window[last]) + shape)
    return anchor, first, last, gram[anchor], around


RECORD = np.dtype(
    [("key", "<u8"), ("around", "<u8"), ("doc", "<i8"), ("tie", "<i4"), ("a", "<u4"), ("l", "u1"), ("r", "u1")]
)
CONTEXT = np.dtype(
    [("key", "<u8"), ("doc", "<i8"), ("tie", "<i4"), ("a", "<u4"), ("l", "u1"), ("r", "u1"),
     ("left", "u1", SPAN - 1), ("right", "u1", LENGTH)]
)
FOUND = "dup boolean, doc long, tie int, a long, first long, last long, key long"


def _packed(records: np.ndarray) -> bytes:
    """Records byte by byte instead of one after the other, which compresses better."""
    return np.ascontiguousarray(records.view(np.uint8).reshape(len(records), -1).T).tobytes()


def _unpacked(payloads, kind: np.dtype) -> np.ndarray:
    parts = [np.frombuffer(p, np.uint8).reshape(kind.itemsize, -1).T for p in payloads]
    return np.ascontiguousarray(np.concatenate(parts)).view(kind).reshape(-1) if parts else np.empty(0, kind)


def _dealt(records: np.ndarray, parts: int) -> pa.RecordBatch:
    """A payload for each partition, by the records' keys."""
    to = (mixed(records["key"].copy()) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(parts + 1))
    rows = [(k, _packed(records[order[a:z]])) for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)) if z > a]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], ["part", "payload"]
    )


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _later(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted records, which of them come later than an equal one, and which are the first of their kind."""
    r = r[np.lexsort((r["a"], r["tie"], r["doc"], r["around"], r["key"]))]
    first = _changes(r["key"], r["around"])
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    later = (r["doc"] != r["doc"][head]) | (r["tie"] != r["tie"][head]) | (r["a"] != r["a"][head])
    return r, later, first


def _found(r: np.ndarray, dup: bool) -> pa.RecordBatch:
    a = r["a"].astype(np.int64)
    first = a - r["l"]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(r), dup)), pa.array(r["doc"]), pa.array(r["tie"]), pa.array(a), pa.array(first),
         pa.array(first + r["r"]), pa.array(r["key"].view(np.int64))],
        [x.split()[0] for x in FOUND.split(", ")],
    )


def sampled(docs: DataFrame, parts: int) -> DataFrame:
    """Payloads of sampled suffixes; of those with equal windows in a batch only the first, the rest is known."""

    def run(batches):
        for b in batches:
            raw, bounds = utf8(b.column("_text"))
            doc = b.column("_doc").to_numpy(zero_copy_only=False)
            tie = b.column("_tie").to_numpy(zero_copy_only=False)
            some = []
            for x, z in slices(bounds, SLICE):
                own = bounds[x : z + 1] - bounds[x]
                a, first, last, key, around = anchors(raw[bounds[x] : bounds[z]], own)
                r = np.empty(len(a), RECORD)
                row = np.searchsorted(own, first, "right") - 1
                r["key"], r["around"], r["doc"], r["tie"] = key, around, doc[x + row], tie[x + row]
                r["a"], r["l"], r["r"] = a - own[row], a - first, last - first
                some.append(r)
            r, later, _ = _later(np.concatenate(some)) if some else (np.empty(0, RECORD), np.empty(0, bool), None)
            # What is known to be repeated travels with a mark in place of its surroundings.
            r["around"][later] = 0
            yield _dealt(r, parts)

    return docs.mapInArrow(run, "part int, payload binary")


def matched(payloads: DataFrame) -> DataFrame:
    """Runs of windows that are repeated for sure, and runs that must be compared byte by byte.

    The latter are the earliest of each kind where several kinds begin alike.
    """

    def run(batches):
        r = _unpacked((p for b in batches for p in b.column("payload").to_pylist()), RECORD)
        known = r["around"] == 0
        yield _found(r[known], True)
        r, later, first = _later(r[~known])
        if len(r):
            yield _found(r[later], True)
            group = np.cumsum(_changes(r["key"])) - 1
            kinds = np.bincount(group, first)
            yield _found(r[first & (kinds[group] > 1)], False)

    return payloads.mapInArrow(run, FOUND)


def contexts(asked: DataFrame, parts: int) -> DataFrame:
    """Payloads of the bytes around the suffixes that ``asked`` (documents with lists) names."""

    def run(batches):
        for b in batches:
            raw, bounds = utf8(b.column("_text"))
            lists = b.column("asked")
            row = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            a, first, last, key = (
                flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)
            )
            for x in range(0, len(a), 1 << 16):
                k = slice(x, x + (1 << 16))
                c = np.zeros(len(a[k]), CONTEXT)
                doc = row[k]
                c["key"], c["a"], c["l"], c["r"] = key[k].view(np.uint64), a[k], a[k] - first[k], last[k] - first[k]
                c["doc"] = b.column("_doc").to_numpy(zero_copy_only=False)[doc]
                c["tie"] = b.column("_tie").to_numpy(zero_copy_only=False)[doc]
                at = (bounds[doc] + a[k])[:, None]
                left = at - np.arange(1, SPAN)  # nearest byte first
                right = at + np.arange(LENGTH)
                c["left"] = np.where(left >= bounds[doc][:, None], raw[np.maximum(left, 0)], 0)
                c["right"] = np.where(right < bounds[doc + 1][:, None], raw[np.minimum(right, len(raw) - 1)], 0)
                yield _dealt(c, parts)

    return asked.mapInArrow(run, "part int, payload binary")


def repeated_windows(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``c`` in order; its rows and windows (bytes left of the suffix) that an earlier row also has."""
    c = c[np.lexsort((c["a"], c["tie"], c["doc"]))]  # so that row numbers tell which is earlier
    text = np.concatenate([c["key"].astype(">u8").view(np.uint8).reshape(len(c), 8), c["right"]], axis=1)
    order = np.argsort(np.ascontiguousarray(text).view(f"S{8 + LENGTH}").reshape(-1), kind="stable")
    text = text[order]
    differ = text[1:] != text[:-1]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1) - 8, LENGTH)  # with the row before
    rank = np.empty(len(c), np.int64)
    rank[order] = np.arange(len(c))
    left = np.full(len(c), 7, np.uint64)
    lowest = c["l"].astype(np.int64) - c["r"]
    rows, windows = [], []
    for d in range(SPAN):
        if d:
            left = _joined(left, c["left"][:, d - 1].astype(np.uint64) + np.uint64(1))
        alike = np.concatenate([[0], np.cumsum(prefix < LENGTH - d)])[rank]
        some = np.flatnonzero((lowest <= d) & (d <= c["l"]))
        if not len(some):
            continue
        kind = mixed(left[some] + mixed(alike[some].astype(np.uint64) + np.uint64(1)))
        _, first, inverse = np.unique(kind, return_index=True, return_inverse=True)
        head = some[first[inverse]]
        same = (c["doc"][some] == c["doc"][head]) & (c["tie"][some] == c["tie"][head]) & (c["a"][some] == c["a"][head])
        rows.append(some[~same])
        windows.append(np.full(len(rows[-1]), d))
    return c, np.concatenate(rows), np.concatenate(windows)


def induced(payloads: DataFrame) -> DataFrame:
    """Runs of windows that are repeated, among the suffixes whose surroundings differ."""

    def run(batches):
        c = _unpacked((p for b in batches for p in b.column("payload").to_pylist()), CONTEXT)
        if not len(c):
            return
        c, row, d = repeated_windows(c)
        if not len(row):
            return
        order = np.lexsort((-d, row))
        row, d = row[order], d[order]
        at = np.flatnonzero(_changes(row, d + np.arange(len(d))))
        end = np.append(at[1:], len(row)) - 1
        a = c["a"].astype(np.int64)[row[at]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c["doc"][row[at]]), pa.array(c["tie"][row[at]]), pa.array(a - d[at]), pa.array(a - d[end])],
            ["doc", "tie", "first", "last"],
        )

    return payloads.mapInArrow(run, "doc long, tie int, first long, last long")


def _spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that windows from ``first`` to ``last`` cover."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + LENGTH)
    new = np.concatenate([[True], start[1:] > end[:-1]])[: len(start)]
    at = np.flatnonzero(new)
    return start[at], end[np.append(at[1:], len(start)) - 1] if len(start) else end


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_bytes``, ``spans`` (removed runs of bytes, from and to), ``kept`` (bytes).

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
    document with a smaller id, or further left in the same one; strings may
    overlap and are judged on the input. Matches end at a document's ends. A null
    text is empty; texts of fewer than ``LENGTH`` bytes stay whole. Null ids come
    first; documents with equal ids are ordered by a hash of their text, and
    rows that are equal in both count as one document, each returned with the same
    result. An empty table gives an empty result; other columns are ignored.
    """
    parts = tasks(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("_doc"),
        F.hash(text).alias("_tie"),
        text.alias("_text"),
    )
    found = written(
        matched(sampled(rows.select("_doc", "_tie", "_text"), parts).repartitionById(parts, "part")), "matched"
    )
    asked = found.filter("NOT dup").groupBy("doc", "tie").agg(
        F.collect_list(F.struct("a", "first", "last", "key")).alias("asked")
    )
    same = (F.col("_doc") == F.col("doc")) & (F.col("_tie") == F.col("tie"))
    around = contexts(rows.join(asked, same).select("_doc", "_tie", "_text", "asked"), parts)
    more = induced(around.repartitionById(parts, "part"))
    runs = found.filter("dup").select("doc", "tie", "first", "last").unionAll(more)
    by_doc = runs.groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            raw, bounds = utf8(b.column("_text"))
            lists = b.column("runs")
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = lists.flatten()
            first, last = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            ends = np.cumsum(sizes)
            kept, spans = [], []
            for i in range(b.num_rows):
                own = raw[bounds[i] : bounds[i + 1]]
                x, z = _spans(first[ends[i] - sizes[i] : ends[i]], last[ends[i] - sizes[i] : ends[i]])
                if len(x):
                    step = np.zeros(len(own) + 1, np.int32)
                    step[x] += 1
                    step[z] -= 1
                    own = own[np.cumsum(step[:-1]) == 0]
                kept.append(own.tobytes())
                spans.append([{"from": int(p), "to": int(q)} for p, q in zip(x, z, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(np.diff(bounds)),
                 pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                 pa.array(kept, pa.binary())],
                ["_id", "n_bytes", "spans", "kept"],
            )

    joined = rows.join(by_doc, same, "left").select("_id", "_text", "runs")
    out = joined.mapInArrow(cut, f"_id {id_type}, n_bytes long, spans array<struct<from:bigint,to:bigint>>, kept binary")
    return out.withColumnRenamed("_id", id_col)
