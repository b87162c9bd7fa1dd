"""Fuzzy line deduplication by MinHash.

Lines are sets of character shingles. A signature of ``BANDS`` times ``ROWS`` least
hashes (one permutation; empty slots borrow from full ones) is cut into bands, and lines that
agree on a band meet. Pairs are verified by exact Jaccard similarity, the
links are joined by distributed union-find, and of each component the line
that comes first in the corpus stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import SLICE, mixed, settled, slices, tasks, text_of, utf8, written
from ledgertag.llm.hubs import join_hubs
from ledgertag.llm.links import BLOCK, DEALT, dealt_bare, distinct_sorted, id_filter, linked, may_hold, met

CHARS = 8
#: At similarity 0.8 a pair shares no band with a chance of (1 - 0.8 ** 4) ** 14 = 0.0006.
BANDS, ROWS = 14, 4
#: Shorter lines (in bytes) are one shingle each, the line itself, so only equal ones are similar.
SHORTEST = CHARS
#: Lines whose keys are packed for the shuffle at a time.
DEAL = 1 << 15

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANKS = b" \t\r\n\f\v"
#: For each slot of a signature, all slots in an order of its own.
_ORDERS = np.argsort(
    mixed(np.arange(1, (BANDS * ROWS) ** 2 + 1, dtype=np.uint64) * _STEP).reshape(BANDS * ROWS, -1), axis=1
)


def trimmed_lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Text, place in the text, bytes and name (a 64-bit hash) of every line that isn't blank.

    ASCII white space at the ends of a line isn't part of it.
    """
    rows, places, lines, names = [], [], [], []
    for i, text in enumerate(texts):
        for k, line in enumerate(text.split(b"\n")):
            if line := line.strip(_BLANKS):
                rows.append(i)
                places.append(k)
                lines.append(line)
                names.append(xxhash.xxh3_64_intdigest(line))
    return np.array(rows, np.int64), np.array(places, np.int32), lines, np.array(names, np.uint64)


def shingle_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of each line, with repeats; a line that is shorter is one shingle."""
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    code, at = raw, bounds
    if raw.max() >= 128:
        starts = (raw & 0xC0) != 0x80
        decoded = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        if len(decoded) == starts.sum():  # else it isn't UTF-8, and bytes are characters
            code, at = decoded, np.concatenate([[0], np.cumsum(starts)])[bounds]
    n = np.diff(at)
    counts = np.where(n >= CHARS, n - CHARS + 1, np.minimum(n, 1))
    ends = np.concatenate([[0], np.cumsum(counts)])
    h = code.astype(np.uint64) + np.uint64(1)
    by = int(_STEP)
    for k in (1, 2, 4):  # a polynomial in _STEP of the characters
        if len(h) > k:
            x = h[:-k] * np.uint64(by)
            x += h[k:]
            h = x
        by = by * by % (1 << 64)
    inside = np.ones(len(h), bool)
    late = at[1:][n >= CHARS]
    for k in range(1, CHARS):  # shingles that would run into the next line
        inside[(late - k)[late - k < len(h)]] = False
    small = np.flatnonzero(n < CHARS)
    for i in small:
        inside[at[i] : at[i + 1]] = False
    out = np.zeros(ends[-1], np.uint64)
    if len(small):
        whole = np.repeat(n >= CHARS, counts)
        out[whole] = h[inside]
        for i in small[n[small] > 0]:
            line = code[at[i] : at[i + 1]].astype(np.uint64)
            out[ends[i]] = mixed(line + _STEP * np.arange(1, n[i] + 1, dtype=np.uint64)).sum()
    else:
        out = h[inside]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out, ends


def shingles(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return distinct_sorted(*shingle_hashes(raw, bounds))


def band_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The hashes of each line's bands: one row of ``BANDS`` per line."""
    slots, n = BANDS * ROWS, len(bounds) - 1
    empty = np.uint32(0xFFFFFFFF)
    wide = 1 << (slots - 1).bit_length()  # the upper bits of a hash name its slot, of which the first count
    least = np.full(n * wide, empty, np.uint32)
    halves = hashes.view("<u4")
    slot = (halves[1::2] >> np.uint32(33 - wide.bit_length())).astype(np.int64)
    slot += np.repeat(np.arange(n) * wide, np.diff(bounds))
    np.minimum.at(least, slot, halves[0::2] >> np.uint32(1))
    least = least.reshape(n, wide)[:, :slots].copy()
    full = least != empty
    full[~full.any(axis=1)] = True  # no shingles at all
    own = least.copy()
    lone = np.flatnonzero(full.sum(axis=1) == 1)
    least[lone] = own[lone, full[lone].argmax(axis=1)][:, None]
    open_ = ~full
    open_[lone] = False
    rows, cols = np.nonzero(open_)
    # An empty slot takes the value of the first full one in its own order of all slots.
    for k in range(slots if len(rows) else 0):
        pick = _ORDERS[cols, k]
        ok = full[rows, pick]
        least[rows[ok], cols[ok]] = own[rows[ok], pick[ok]]
        rows, cols = rows[~ok], cols[~ok]
        if not len(rows):
            break
    bands = least.reshape(n, BANDS, ROWS).astype(np.uint64)
    key = np.zeros((n, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * _STEP + bands[:, :, k])
    return key


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """``docs`` with ``text`` cut down to the lines that stay, plus ``n_lines`` and ``n_removed``.

    Two lines link when they are equal but for white space at their ends, or when the sets of their shingles of
    ``CHARS`` characters have a Jaccard similarity of 0.8 or more (and share a band).
    Of each component the first line stays, in order of document id (nulls first, ties
    by a hash of the text) and place in the text; the others go. Blank lines stay. A text that
    loses nothing is returned as it is; a null text stays null and has no lines; one that loses all its lines becomes empty.
    Rows that are equal in id and text count as one document, each returned with the same result. An empty table
    gives an empty result. Other columns are returned as they are; columns named
    ``n_lines`` or ``n_removed`` are replaced.
    """
    text, parts = text_of(text_col), tasks(docs.sparkSession)
    # The row is one column here, so that no name of its columns clashes.
    keyed_docs = docs.drop("n_lines", "n_removed").select(
        F.struct("*").alias("_row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("_dl_doc"),
        F.hash(text).alias("_dl_tie"),
    )
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("_dl_doc"), F.hash(text).alias("_dl_tie"), text.alias("text")
    )

    def each(batches):
        """Some rows and their lines' row, place, bytes and name, some text at a time."""
        for b in batches:
            raw, bounds = utf8(b.column("text"))
            for x, z in slices(bounds, SLICE >> 3):
                own = bounds[x : z + 1]
                texts = [raw[p:q].tobytes() for p, q in zip(own, own[1:], strict=False)]
                yield b.slice(x, z - x), *trimmed_lines(texts)

    def joined_bytes(lines):
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int64)
        return np.frombuffer(b"".join(lines), np.uint8), ends

    def sketch(batches):
        held, n = [], 0
        for _, _, _, lines, name in each(batches):
            _, once = np.unique(name, return_index=True)
            once = np.array([k for k in once if len(lines[k]) >= SHORTEST], np.int64)
            held.append((name[once], band_keys(*shingle_hashes(*joined_bytes([lines[k] for k in once])))))
            n += len(once)
            if n >= DEAL:
                yield deal(held)
                held, n = [], 0
        if n:
            yield deal(held)

    def deal(held):
        name, once = np.unique(np.concatenate([x for x, _ in held]), return_index=True)
        return dealt_bare(name.view(np.int64), np.concatenate([k for _, k in held])[once], parts)

    def occur(wanted):
        def some(batches):
            for b, row, place, lines, name in each(batches):
                ids, once = np.unique(name.view(np.int64), return_index=True)
                texts = [None] * len(lines)
                for k in once[may_hold(wanted, ids)].tolist():
                    texts[k] = lines[k]
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [b.column("_dl_doc").take(row), b.column("_dl_tie").take(row),
                     pa.array(place), pa.array(name.view(np.int64)), pa.array(texts, pa.binary())],
                    ["doc", "tie", "place", "line", "text"],
                )

        return some

    cells = met(rows.select("text").mapInArrow(sketch, DEALT), block, merged=True, bare=True)
    wanted = id_filter(cells.select("id").distinct())
    # Of the lines that share a band with others the text is there once or more, but not with each occurrence.
    table = rows.mapInArrow(occur(wanted), "doc long, tie int, place int, line long, text binary")
    occurrences = written(table, "lines")
    texts = occurrences.filter("text IS NOT NULL").select(F.col("line").alias("id"), "text").dropDuplicates(["id"])
    roots = linked(cells, texts, shingles, width=4)
    # The root of a component is no link's upper end, so it is named by itself.
    roots = settled(roots.unionAll(roots.select(F.col("root").alias("id"), "root")).distinct())
    repeated = occurrences.groupBy("line").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    named = repeated.join(roots, F.col("line") == F.col("id"), "full")
    named = named.select(F.coalesce("line", "id").alias("line"), F.coalesce("root", "line").alias("group"))
    # Most lines are neither repeated nor linked.
    alike = occurrences.join(named.hint("shuffle_hash"), "line").select("doc", "tie", "place", "group")
    alike = written(alike, "alike")
    stays = alike.groupBy("group").agg(F.min(F.struct("doc", "tie", "place")).alias("stays"), F.count(F.lit(1)).alias("n"))
    gone = join_hubs(alike, stays, "group", alike.count(), "inner").filter(F.struct("doc", "tie", "place") != F.col("stays"))
    gone = gone.groupBy(F.col("doc").alias("_dl_doc"), F.col("tie").alias("_dl_tie")).agg(
        F.collect_list("place").alias("_dl_gone")
    )
    # Hashing the places instead of sorting the texts.
    joined = keyed_docs.join(gone.hint("shuffle_hash"), ["_dl_doc", "_dl_tie"], "left").drop("_dl_doc", "_dl_tie")
    own = joined.schema["_row"].dataType
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)

    def cut(batches):
        for b in batches:
            texts, counts, removed = [], [], []
            row = b.column("_row")
            for t, gone_ in zip(row.field(text_col).to_pylist(), b.column("_dl_gone").to_pylist(), strict=True):
                lines = (t or "").split("\n")
                solid = [bool(x.strip(" \t\r\f\v")) for x in lines]
                out = set(gone_ or ())
                counts.append(sum(solid))
                removed.append(len(out))
                texts.append("\n".join(x for k, x in enumerate(lines) if k not in out) if out else t)
            names = own.names
            columns = [pa.array(texts, pa.string()) if c == text_col else row.field(c) for c in names]
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_removed"])

    return joined.mapInArrow(cut, f"{fields}, n_lines long, n_removed long")
