"""Alignment of two tokenizers over the same bytes.

Byte ends of tokens come from the tokenizers' own spans: character offsets of ``tokenizers`` (A) and the spans in
sentencepiece's protobuf (B). They are coarse, as a token that holds a part of a character gets
the whole character; such tokens, and bytes by fallback, are refined by their decoded bytes.

Texts are cut into units, runs of characters between spaces at which neither tokenizer joins anything. A
block of documents encodes each of its distinct units once, and its documents are lists of unit numbers. How often
an id pair is linked corpus-wide is summed over the blocks' own counts; each block gets back the
counts of the pairs that it holds.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import text_of, written

#: A block ends when its texts have so many characters, or so many distinct units.
BLOCK_CHARS, BLOCK_UNITS = 1 << 24, 200_000
#: Units that are encoded as one text, and such texts that are encoded at a time.
RUN, RUNS = 1 << 9, 1 << 6

_SPACE = "▁"
# A space between two characters that are no white space, in the sense of either tokenizer.
_CUT = re.compile(rf"(?<=[^\s{_SPACE}]) (?=[^\s{_SPACE}])")
_EDGE = frozenset(_SPACE + "".join(chr(c) for c in range(0x3000 + 1) if chr(c).isspace()))
_HEX = re.compile(r"<0x([0-9A-F]{2})>")


@cache
def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it is visible, else from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary of ``tokenizers``."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True  # special tokens' strings in a text are plain text
        spec = json.loads(self.own.to_str())
        split = spec.get("pre_tokenizer") or {}
        #: Whether a space between words always starts a token of its own word.
        self.splits = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        letters = _byte_letters()
        self.bytes: dict[int, bytes] = {}
        for token, i in self.own.get_vocab().items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.sizes = np.array([len(self.bytes.get(i, b"")) for i in range(max(self.bytes) + 1)], np.int64)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Ids of each text, and the span of every token in characters of its text."""
        found = self.own.encode_batch(texts, add_special_tokens=False)
        flat = chain.from_iterable(chain.from_iterable(e.offsets) for e in found)
        return [e.ids for e in found], np.fromiter(flat, np.int64).reshape(-1, 2)


class Pieces:
    """Tokenizer B: a sentencepiece model with bytes for what its pieces lack."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.own = SentencePieceProcessor(model_file=path)
        names = [self.own.id_to_piece(i) for i in range(self.own.get_piece_size())]
        self.bytes = {i: self._decoded(p) for i, p in enumerate(names)}
        self.sizes = np.array([len(self.bytes[i]) for i in range(len(names))], np.int64)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        n = model.normalizer_spec
        plain = n.name == "identity" and n.add_dummy_prefix and not n.remove_extra_whitespaces
        #: Whether a space between words always starts a piece of its own.
        self.splits = plain and not any(_SPACE in p.lstrip(_SPACE) for p in names)

    @staticmethod
    def _decoded(piece: str) -> bytes:
        if byte := _HEX.fullmatch(piece):
            return bytes([int(byte[1], 16)])
        return piece.replace(_SPACE, " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Ids of each text, and the span of every piece in bytes of its text, which has no space in front."""
        found = [p.pieces for p in self.own.encode(texts, num_threads=1, return_type="proto")]
        ids = [[x.id for x in own] for own in found]
        ends = np.array([x.end for own in found for x in own], np.int64)
        begins = np.append(0, ends)[:-1]  # a piece begins where the one before it ends
        begins[np.cumsum([0, *map(len, ids)])[:-1][[bool(x) for x in ids]]] = 0
        return ids, np.stack([begins, ends], axis=1)


@cache
def tokenizers_of(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


def byte_ends(spans: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The byte at which each token ends, from coarse spans in bytes and the sizes of the decoded tokens.

    A span as long as its token's bytes is that token's place. Others hold parts of a character, or lack a space
    that the tokenizer added; these are placed by their bytes behind the last token before them that has a place.
    """
    sure = spans[:, 1] - spans[:, 0] == size
    total = np.cumsum(size)
    last = np.maximum.accumulate(np.where(sure, np.arange(len(size)), -1))
    known = last >= 0
    return np.where(known, spans[last, 1] + total - total[last], total) if len(size) else total


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and the bounds of each list in them."""
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    return np.fromiter(chain.from_iterable(ids), np.int64, int(bounds[-1])), bounds


class Units:
    """What is known of some units: numbers of tokens, groups and links, links as CSR of ``a << 32 | b``, and groups as text.

    ``runs`` are lists of units that are encoded together, as one text. A unit whose tokens don't join to its bytes has
    None for its groups.
    """

    def __init__(self, runs: list[list[str]], a: ByteLevel, b: Pieces):
        while True:
            inner = [" ".join(run) for run in runs]
            ids_a, spans_a = a.encode([" " + t for t in inner])
            ids_b, spans_b = b.encode(inner)
            raws = [b" " + t.encode() for t in inner]
            same = [
                b"".join([a.bytes[i] for i in x]) == raw and b"".join([b.bytes[i] for i in y]) == raw
                for x, y, raw in zip(ids_a, ids_b, raws, strict=True)
            ]
            if all(ok or len(run) == 1 for ok, run in zip(same, runs, strict=True)):
                break
            # A unit whose bytes differ is found by itself.
            runs = [part for ok, run in zip(same, runs, strict=True) for part in ([run] if ok else [[u] for u in run])]
        good = np.array(same, bool)
        spans_a = spans_a[np.repeat(good, [len(x) for x in ids_a])]
        spans_b = spans_b[np.repeat(good, [len(x) for x in ids_b])]
        for k in np.flatnonzero(~good):
            ids_a[k], ids_b[k], raws[k] = [], [], b""
        flat_a, bounds_a = _flat(ids_a)
        flat_b, bounds_b = _flat(ids_b)
        # All texts behind one another; tokens of both end where a unit ends.
        raw = np.frombuffer(b"".join(raws), np.uint8)
        base = np.concatenate([[0], np.cumsum([len(x) for x in raws])]).astype(np.int64)
        first = (raw & 0xC0) != 0x80
        places = np.append(np.flatnonzero(first), len(raw))
        chars = np.searchsorted(places, base)
        spans_a = places[spans_a + np.repeat(chars[:-1], np.diff(bounds_a))[:, None]]
        spans_b = spans_b + np.repeat(base[:-1] + 1, np.diff(bounds_b))[:, None]
        ends_a = byte_ends(spans_a, a.sizes[flat_a])
        ends_b = byte_ends(spans_b, b.sizes[flat_b])
        ends, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        self.links = flat_a[at_a] << 32 | flat_b[at_b]
        units = [len(u.encode()) + 1 if ok else 0 for ok, run in zip(same, runs, strict=True) for u in run]
        edges = np.concatenate([[0], np.cumsum(units)])
        self.held = np.searchsorted(ends, edges, "right")
        groups = np.diff(self.held)
        counts = [np.diff(np.searchsorted(e, edges, "right")) for e in (ends_a, ends_b)]
        self.sizes = np.stack([*counts, groups, groups], axis=1)
        named_a, named_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        pieces, x, y = [], 0, 0
        for p, q in zip((at_a + 1).tolist(), (at_b + 1).tolist(), strict=True):
            if p - x == q - y == 1:
                pieces.append(f"{named_a[x]}|{named_b[y]}")
            else:
                pieces.append(f"{','.join(named_a[x:p])}|{','.join(named_b[y:q])}")
            x, y = p, q
        cuts = self.held.tolist()
        self.groups = [";".join(pieces[p:q]) if n else None for p, q, n in zip(cuts, cuts[1:], units, strict=False)]


class Block:
    """Documents of one block as lists of distinct units, and what the units hold."""

    def __init__(self, a: ByteLevel, b: Pieces, most_chars: int = BLOCK_CHARS, most_units: int = BLOCK_UNITS):
        self.a, self.b = a, b
        self.most_chars, self.most_units = most_chars, most_units
        self.numbers: dict[str, int] = {}
        self.sizes = np.empty((0, 4), np.int64)
        self.groups: list[str | None] = []
        self.links: list[np.ndarray] = []
        self.held = np.zeros(1, np.int64)
        self.docs: list[tuple] = []
        self.chars = 0

    def units(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's units; new ones are encoded."""
        numbers, cut = self.numbers, self.a.splits and self.b.splits
        parts = [(_CUT.split(text) if cut else [text]) if text else [] for text in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(parts)) if p not in numbers]
        # Units with white space at an end are the only ones in front of or behind which it matters what stands there.
        plain = [p for p in new if cut and p[0] not in _EDGE and p[-1] not in _EDGE]
        for p in plain:
            numbers[p] = len(numbers)
        odd = [p for p in new if p not in numbers]
        for p in odd:
            numbers[p] = len(numbers)
        runs = [plain[k : k + RUN] for k in range(0, len(plain), RUN)] + [[p] for p in odd]
        for k in range(0, len(runs), RUNS):
            more = Units(runs[k : k + RUNS], self.a, self.b)
            self.sizes = np.concatenate([self.sizes, more.sizes])
            self.groups += more.groups
            self.links.append(more.links)
            self.held = np.concatenate([self.held, self.held[-1] + more.held[1:]])
        return [np.array([numbers[p] for p in own], np.int32) for own in parts]

    def add(self, key: int | None, text: str, own: np.ndarray) -> None:
        groups = [self.groups[n] for n in own.tolist()]
        if not groups or None in groups:  # no text, or bytes that differ
            self.docs.append((key, 0, 0, 0, 0, "", own[:0]))
        else:
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            self.docs.append((key, *self.sizes[own].sum(axis=0).tolist(), digest, own))
        self.chars += len(text)

    @property
    def full(self) -> bool:
        return self.chars >= self.most_chars or len(self.numbers) >= self.most_units

    def rows(self, number: int) -> pa.RecordBatch:
        """A row per document, and one with the links of the block's units and their counts."""
        held = self.held
        links = np.concatenate([np.empty(0, np.int64), *self.links])
        codes, at = np.unique(links, return_inverse=True)
        used = np.bincount(np.concatenate([d[6] for d in self.docs]), minlength=len(held) - 1)
        counts = np.bincount(at.reshape(-1), np.repeat(used, np.diff(held)), minlength=len(codes)).astype(np.int64)
        n = len(self.docs)
        columns = list(zip(*(d[:6] for d in self.docs), strict=True))
        longs = [pa.array([*c, None], pa.int64()) for c in columns[:5]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number] * (n + 1), pa.int64()),
                pa.array([True] * n + [False]),
                *longs,
                pa.array([*columns[5], None], pa.string()),
                pa.array([d[6].tobytes() for d in self.docs] + [None], pa.binary()),
                pa.array([None] * n + [codes.tobytes()], pa.binary()),
                pa.array([None] * n + [counts.tobytes()], pa.binary()),
                pa.array([None] * n + [held.astype(np.int64).tobytes()], pa.binary()),
                pa.array([None] * n + [at.reshape(-1).astype(np.int32).tobytes()], pa.binary()),
            ],
            [x.split()[0] for x in _ENCODED.split(", ")],
        )


_ENCODED = (
    "block long, is_doc boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "units binary, codes binary, counts binary, held binary, at binary"
)
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _blocks(path_a: str, path_b: str, limits: tuple[int, int], batches):
    a, b = tokenizers_of(path_a, path_b)
    number = TaskContext.get().partitionId() << 32
    block = Block(a, b, *limits)
    for batch in batches:
        keys, texts = batch.column("id").to_pylist(), batch.column("text")
        k = 0
        while k < batch.num_rows:
            # A few documents at a time, so that one call encodes many units.
            some, size = [], 0
            while k + len(some) < batch.num_rows and size < limits[0] >> 3:
                some.append(texts[k + len(some)].as_py())
                size += len(some[-1])
            for key, text, own in zip(keys[k : k + len(some)], some, block.units(some), strict=True):
                block.add(key, text, own)
            k += len(some)
            if block.full:
                yield block.rows(number)
                number, block = number + 1, Block(a, b, *limits)
    if block.docs:
        yield block.rows(number)


def _pair_rows(batches):
    for batch in batches:
        for number, codes, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "codes", "counts")), strict=True):
            pair, n = np.frombuffer(codes, np.int64), np.frombuffer(counts, np.int64)
            used = n > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(int(used.sum()), number)), pa.array(pair[used]), pa.array(n[used])], ["block", "pair", "n"]
            )


def _scored(key, docs: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of one block with the sums over their links."""
    units = docs.filter(pc.invert(docs["is_doc"]))
    docs = docs.filter(docs["is_doc"])
    codes, held, at = (
        np.frombuffer(units[c][0].as_py(), kind) for c, kind in (("codes", np.int64), ("held", np.int64), ("at", np.int32))
    )
    total, best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    place = np.searchsorted(codes, known["pair"].to_numpy())
    total[place] = known["total"].to_numpy()
    best[place] = known["best"].to_numpy()
    sums = []
    for values in (total, best):
        running = np.concatenate([[0], np.cumsum(values[at])])
        sums.append(running[held[1:]] - running[held[:-1]])  # per unit
    own = [np.frombuffer(u.as_py(), np.int32) for u in docs["units"]]
    count_sum, n_best = ([int(s[o].sum()) for o in own] for s in sums)
    kept = docs.select([x.split()[0] for x in _RESULT.split(", ") if x.split()[0] in docs.column_names])
    kept = kept.append_column("n_best", pa.array(n_best, pa.int64()))
    kept = kept.append_column("count_sum", pa.array(count_sum, pa.int64()))
    return kept.select([x.split()[0] for x in _RESULT.split(", ")])


def align_tokenizers(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: tuple[int, int] = (BLOCK_CHARS, BLOCK_UNITS),
) -> tuple[DataFrame, DataFrame]:
    """How two tokenizers cut the same texts: a row per row of ``docs``, and the counts of linked ids.

    A (``path_a``, byte-level, ``tokenizers``) encodes a space and the text, B (``path_b``, sentencepiece, which adds the
    space) the text, both without special tokens. Where tokens of both end, a group ends and the two tokens are linked.
    The first result has id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256``; the second ``a``, ``b``, ``total`` (links corpus-wide that hold the pair), ``is_best`` (the highest of its b).
    Null and empty texts, and texts that a tokenizer doesn't give back byte by byte, have zeros and an
    empty hash. Null ids stay null, repeated rows count as often as they come; an empty table gives empty results and
    other columns are ignored. ``block`` bounds the characters and distinct units that a task holds at a time.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    encoded = written(rows.mapInArrow(partial(_blocks, path_a, path_b, block), _ENCODED), "encoded")
    pairs = encoded.filter("NOT is_doc").select("block", "codes", "counts")
    pairs = pairs.mapInArrow(_pair_rows, "block long, pair long, n long")
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    totals = written(totals.withColumn("b", b), "totals")
    # One row per id of B's vocabulary at most.
    highest = F.broadcast(totals.groupBy("b").agg(F.max("total").alias("highest")))
    totals = totals.join(highest, "b").withColumn("is_best", F.col("total") == F.col("highest"))
    known = pairs.join(totals, "pair").select("block", "pair", "total", F.col("is_best").cast("long").alias("best"))
    scored = encoded.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_scored, _RESULT)
    a = F.shiftright("pair", 32)
    return scored.withColumnRenamed("doc_id", id_col), totals.select(a.alias("a"), "b", "total", "is_best")
