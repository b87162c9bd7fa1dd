"""Jaccard join of documents on word n-grams, with signature trees.

A document's set holds the distinct shingles of five words. Its keys are its shingles
with the least hashes: as many as a similar set must share one of (a fifth of the
set), but no more than ``MOST_KEYS``. Beyond that number a similar set lacks
all keys with a chance of 0.2 ** MOST_KEYS only (7e-12 per pair; hashes are
random), which is in the order of a collision of hashes. Documents that share a key meet in a
cell, where signature trees prune pairs by their largest possible overlap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import SLICE, mixed, slices, tasks, text_of, utf8, written
from ledgertag.llm.hubs import join_hubs
from ledgertag.llm.links import BLOCK, DEALT, dealt, distinct_sorted, linked_components, may_hold, whole_hash

WORDS = 5
MOST_KEYS = 16

_STEP = np.uint64(0x9E3779B97F4A7C15)
_WIDE = 64  # places in a word whose hashes are kept in a table
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = mixed(
    np.arange(256, dtype=np.uint64)[None, :] + _STEP * (np.arange(_WIDE, dtype=np.uint64)[:, None] + np.uint64(1))
)


def words_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, A-Z in lower case, and their bounds."""
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    solid = ~_BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    first = np.flatnonzero(starts)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    byte = np.flatnonzero(solid)
    word = np.cumsum(starts)[byte] - 1
    place = byte - first[word]
    low = _LOWER[raw[byte]]
    parts = _TABLE[np.minimum(place, _WIDE - 1), low]
    far = place >= _WIDE
    if far.any():
        parts[far] = mixed(low[far].astype(np.uint64) + _STEP * (place[far].astype(np.uint64) + np.uint64(1)))
    cuts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    hashes = mixed(np.add.reduceat(parts, cuts) + np.diff(np.append(cuts, len(byte))).astype(np.uint64))
    return hashes, np.searchsorted(first, bounds)


def shingles(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the shingles of each text, and their bounds.

    A text of fewer than five words has its whole sequence as one shingle; one
    without words has none.
    """
    words, at = words_of(raw, bounds)
    n = np.diff(at)
    full = np.flatnonzero(n >= WORDS)
    counts = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    ends = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(ends[-1], np.uint64)
    if len(full):
        h = words[: len(words) - WORDS + 1].copy()
        for k in range(1, WORDS):
            h *= _STEP
            h += words[k : len(words) - WORDS + 1 + k]
        h = mixed(h)
        of = np.repeat(full, counts[full])
        out[ends[of] + _ramp(counts[full])] = h[at[of] + _ramp(counts[full])]
    for i in np.flatnonzero((n > 0) & (n < WORDS)):
        h = np.full(1, n[i], np.uint64)
        for k in range(at[i], at[i + 1]):
            h = mixed(h * _STEP + words[k : k + 1])
        out[ends[i]] = h[0]
    return distinct_sorted(out, ends)


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def keys_of(hashes: np.ndarray) -> bytes:
    n = len(hashes)
    return hashes[: min(MOST_KEYS, n - -(-4 * n // 5) + 1) if n else 0].tobytes()


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id``.

    Documents link when the Jaccard similarity of their sets is 0.8 or more; a component's id
    is the least id in it. Null texts are empty; texts without words have no set and link with
    nothing. A row whose id is null takes no part in links and has a null
    component. Rows with equal ids and different texts share their links. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def sketch(batches):
        for b in batches:
            raw, bounds = utf8(b.column("text"))
            for x, z in slices(bounds, SLICE):
                h, own = shingles(raw[bounds[x] : bounds[z]], bounds[x : z + 1] - bounds[x])
                keys = [keys_of(h[p:q]) for p, q in zip(own, own[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("id").slice(x, z - x),
                        pa.array(whole_hash(h, own).view(np.int64)),
                        pa.array(np.diff(own).astype(np.int32)),
                        pa.array(keys, pa.binary()),
                    ],
                    ["id", "whole", "n", "keys"],
                )

    def fetch(wanted):
        def some(batches):
            for b in batches:
                ids = b.column("id").to_numpy(zero_copy_only=False)
                yield b.filter(pa.array(may_hold(wanted, ids)))

        return rows.filter("id IS NOT NULL").mapInArrow(some, "id long, text string")

    keyed = written(rows.mapInArrow(sketch, "id long, whole long, n int, keys binary"), "keyed")
    linked = keyed.filter("id IS NOT NULL AND n > 0")
    parts = tasks(docs.sparkSession)

    def deal(batches):
        for b in batches:
            ids, whole, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "whole", "n"))
            keys = [np.frombuffer(k, np.uint64) for k in b.column("keys").to_pylist()]
            yield dealt(ids, whole.view(np.uint64), n, keys, parts)

    roots = linked_components(linked.mapInArrow(deal, DEALT), fetch, shingles, block)
    # Equal sets are told by their hash and size; only the least id of each went on.
    equal = linked.groupBy("whole", "n").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("c"))
    equal = written(equal.filter("c > 1"), "equal")
    placed = join_hubs(keyed.select("id", "n", "whole"), equal, ["whole", "n"], keyed.count(), count="c")
    placed = placed.withColumn("least", F.when(F.col("id").isNotNull(), F.coalesce("least", "id")))
    roots = roots.select(F.col("id").alias("least"), "root")
    return placed.join(roots, "least", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("root", "least").alias("component_id"),
    )
