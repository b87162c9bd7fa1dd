"""Fingerprints of texts by locally consistent parsing.

A text is a string of bytes. At each level runs of equal symbols become one
symbol; then deterministic coin tossing labels each symbol by the lowest binary
digit in which it differs from the symbol before it, again and again, until labels
are tiny; phrases begin where a label is a local minimum. A phrase's name is a hash
of its symbols, and the names are the symbols of the next level. Where a phrase
begins depends on a few symbols around it only, so equal substrings get equal
phrases but for their borders, wherever they stand. The fingerprint holds a sample of the
names of each level; sampling is by slot (one permutation), so that samples of two texts
tell how many names they share.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import SLICE, mixed, slices, text_of, utf8
from ledgertag.llm.neighbours import OWN, in_runs

#: Levels whose names are sampled: phrases of some 9, 30 and 90 bytes.
LEVELS = (2, 3, 4)
SLOTS = 64
#: Slots that both texts must fill on a level before that level is believed.
ENOUGH = 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _tossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Twice the lowest binary digit in which ``a`` and ``b`` differ, plus that digit of ``a``."""
    differ = a ^ b
    digit = np.bitwise_count((differ & -differ) - differ.dtype.type(1))
    return (2 * digit + ((a >> digit.astype(a.dtype)) & a.dtype.type(1)).astype(np.uint8)).astype(np.uint8)


_SMALL = np.array(
    [[0 if a == b else 2 * (d := ((a ^ b) & -(a ^ b)).bit_length() - 1) + (a >> d & 1) for b in range(128)] for a in range(128)],
    np.uint8,
)


def next_level(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each string in ``symbols``; strings of one symbol stay as they are."""
    n = len(symbols)
    if not n:
        return symbols.astype(np.uint64), bounds
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    # Runs of equal symbols become one symbol.
    new = np.ones(n, bool)
    new[1:] = (symbols[1:] != symbols[:-1]) | first[1:n]
    at = np.flatnonzero(new)
    repeats = np.diff(np.append(at, n))
    x = symbols[at].astype(np.uint64)
    many = repeats > 1
    if many.any():
        x[many] = mixed(x[many] + _STEP * repeats[many].astype(np.uint64))
    bounds = np.searchsorted(at, bounds)
    n = len(x)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    first = first[:n]
    # Coin tossing; the first symbol of a string is compared with none.
    prior = np.empty_like(x)
    prior[0] = 0
    prior[1:] = x[:-1]
    prior[first] = ~x[first]
    label = _tossed(x, prior)
    for _ in range(2):
        before = np.empty_like(label)
        before[0] = 0
        before[1:] = label[:-1]
        before[first] = label[first] ^ 1
        label = _SMALL[label, before]
    # A phrase begins where a string does, and at each local minimum but a string's last symbol.
    start = first.copy()
    start[1:-1] |= (label[1:-1] < label[:-2]) & (label[1:-1] <= label[2:]) & ~first[2:]
    phrase = np.flatnonzero(start)
    place = np.arange(n) - np.repeat(phrase, np.diff(np.append(phrase, n)))
    names = np.add.reduceat(mixed(x + _STEP * (place.astype(np.uint64) + np.uint64(1))), phrase)
    lengths = np.diff(np.append(phrase, n))
    names = mixed(names + lengths.astype(np.uint64))
    names = np.where(lengths == 1, x[phrase], names)
    return names, np.searchsorted(phrase, bounds)


def samples(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text and level: ``SLOTS`` of 32 bits, 0 for an empty slot, and the number of names.

    Slot s holds the least hash among the names that fall to s.
    """
    n = len(bounds) - 1
    out = np.zeros((n, len(LEVELS), SLOTS + 1), np.uint32)
    symbols, at = raw, bounds
    for level in range(1, max(LEVELS) + 1):
        symbols, at = next_level(symbols, at)
        if level in LEVELS:
            h = mixed(symbols + np.uint64(level))
            owner = np.repeat(np.arange(n), np.diff(at))
            least = np.full(n * SLOTS, 0xFFFFFFFF, np.uint32)
            value = np.minimum(h >> np.uint64(32), np.uint64(0xFFFFFFFE)).astype(np.uint32) + np.uint32(1)
            np.minimum.at(least, owner * SLOTS + (h & np.uint64(SLOTS - 1)).astype(np.int64), value)
            k = LEVELS.index(level)
            out[:, k, :SLOTS] = np.where(least == 0xFFFFFFFF, 0, least).reshape(n, SLOTS)
            out[:, k, SLOTS] = np.diff(at)
    return out


def as_string(sample: np.ndarray) -> str:
    return sample.astype(">u4").tobytes().hex()


def from_string(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").reshape(len(LEVELS), SLOTS + 1).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Dice likeness of the names of pairs of samples, 0 to 1.

    Taken on the coarsest level on which both texts fill ``ENOUGH`` slots, else on the finest
    one. Two empty texts are alike, an empty and another one are not.
    """
    filled = [(x[:, :, :SLOTS] != 0).sum(axis=2) for x in (a, b)]
    counts = np.minimum(*filled)
    level = np.maximum(0, (counts >= ENOUGH).sum(axis=1) - 1)
    rows = np.arange(len(a))
    x, y = a[rows, level, :SLOTS], b[rows, level, :SLOTS]
    used = ((x != 0) | (y != 0)).sum(axis=1)
    equal = ((x == y) & (x != 0)).sum(axis=1)
    jaccard = equal / np.maximum(1, used)
    both_empty = (a[:, 0, SLOTS] == 0) & (b[:, 0, SLOTS] == 0)
    return np.where(both_empty, 1.0, 2 * jaccard / (1 + jaccard))


def compare_fingerprints(a: str, b: str) -> float:
    return float(likeness(from_string(a)[None], from_string(b)[None])[0])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``fingerprint`` of every text. Null texts are empty; equal texts have equal fingerprints."""
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))

    def run(batches):
        for b in batches:
            raw, bounds = utf8(b.column("_text"))
            for a, z in slices(bounds, SLICE):
                found = samples(raw[bounds[a] : bounds[z]], bounds[a : z + 1] - bounds[a])
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").slice(a, z - a), pa.array([as_string(s) for s in found])], ["_id", "fingerprint"]
                )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, fingerprint string").withColumnRenamed("_id", id_col)


def _edited(own: bytes, after: bytes) -> tuple[bytes, int]:
    """``own`` with its last half (in code points) replaced by as many of ``after``, and its code points."""
    text = own.decode("utf-8", "surrogatepass")
    n = len(text)
    if n == len(own):
        kept = own[: n - n // 2]
    else:
        kept = text[: n - n // 2].encode("utf-8", "surrogatepass")
    # No code point takes more than 4 bytes; a cut one at the end is left out of the slice below.
    head = after[: 4 * (n // 2)].decode("utf-8", "ignore")[: n // 2]
    return kept + head.encode("utf-8", "surrogatepass"), n


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the last half of the code points (rounded down) replaced
    by the first as many of the next document's. The next document is the one with the next
    smaller id, after the last one the first (a single document follows itself). Null texts are
    empty. Null ids come last; documents with equal ids follow each other by
    a hash of their text. An empty table gives an empty result; other columns are ignored.

    Columns: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. Texts are shuffled once.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    rows = rows.withColumns({"_last": F.col("_id").isNull(), "_down": F.bitwise_not("_id")})

    def run(batches):
        held = None  # the last own row: id, bytes, sample
        done = False
        for b in batches:
            side = b.column("_side").to_numpy(zero_copy_only=False)
            raw, bounds = utf8(b.column("_text"))
            keep = np.flatnonzero(side >= OWN)
            if done or not len(keep):
                continue
            late = np.flatnonzero(side > OWN)
            if len(late):  # only the first row after the run counts
                keep = keep[keep <= late[0]]
                done = True
            a = int(keep[0])
            ends = bounds[a : int(keep[-1]) + 2]
            for s, z in slices(ends, SLICE):
                part, own = raw[ends[s] : ends[z]], ends[s : z + 1] - ends[s]
                texts = [part[own[i] : own[i + 1]].tobytes() for i in range(z - s)]
                found = samples(part, own)
                ids = b.column("_id").slice(a + s, z - s).to_pylist()
                now = list(zip(ids, texts, found, strict=True))
                if held is not None:
                    now.insert(0, held)
                held = now[-1]
                pairs = list(zip(now, now[1:], strict=False))
                if not pairs:
                    continue
                edits = [_edited(x[1], y[1]) for x, y in pairs]
                sizes = np.cumsum([0, *(len(e) for e, _ in edits)])
                altered = samples(np.frombuffer(b"".join(e for e, _ in edits), np.uint8), sizes)
                mine, after = np.stack([x[2] for x, _ in pairs]), np.stack([y[2] for _, y in pairs])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x, _ in pairs], b.schema.field("_id").type),
                        pa.array([n for _, n in edits], pa.int64()),
                        pa.array([hashlib.sha256(e).hexdigest() for e, _ in edits]),
                        pa.array([as_string(s) for s in mine]),
                        pa.array([as_string(s) for s in altered]),
                        pa.array(likeness(mine, altered)),
                        pa.array(likeness(mine, after)),
                    ],
                    ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    out = in_runs(
        rows,
        ["_last", "_down"],
        F.xxhash64("_text"),
        run,
        f"_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
        wrap=True,
    )
    return out.withColumnRenamed("_id", id_col)
