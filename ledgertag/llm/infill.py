"""Fill-in-the-middle transformation with piece tables.

A document is a table of descriptors ``(buffer, start, length)`` over two buffers that never change: its own bytes
and the bytes of the sentinels. Cutting splits a descriptor, an arrangement permutes descriptors and puts sentinels
between them, and the inverse permutation restores the document. Hashes run over the descriptors; only
the text that is returned is put together.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import SLICE, slices, text_of, utf8

# The sentinels, the forms and the arrangement of each: which part follows which sentinel.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SENTINELS = (PREFIX + SUFFIX + MIDDLE).encode()
#: Per form, the sentinels in order, each with the number of the part (0 prefix, 1 middle, 2 suffix) behind it.
ARRANGEMENTS = {PSM: [(PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)], SPM: [(SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)]}

TEXT, MARKS = 0, 1
PIECES = "array<struct<buffer:int,start:long,length:long>>"


@dataclass
class PieceTable:
    """Descriptors over a text and the sentinels."""

    text: memoryview | bytes
    pieces: list[tuple[int, int, int]] = field(default_factory=list)

    @classmethod
    def whole(cls, text: memoryview | bytes) -> PieceTable:
        return cls(text, [(TEXT, 0, len(text))])

    def cut(self, at: int) -> None:
        """Split the descriptor that covers byte ``at``; a cut at an end leaves an empty piece there."""
        for k, (buffer, start, length) in enumerate(self.pieces):
            if at <= length:
                self.pieces[k : k + 1] = [(buffer, start, at), (buffer, start + at, length - at)]
                return
            at -= length
        raise ValueError("a cut beyond the end")

    def arranged(self, form: str) -> PieceTable:
        """The three parts in the order of ``form``, each behind its sentinel."""
        if form == PLAIN:
            return PieceTable(self.text, list(self.pieces))
        out = []
        for mark, part in ARRANGEMENTS[form]:
            out += [(MARKS, SENTINELS.index(mark.encode()), len(mark)), self.pieces[part]]
        return PieceTable(self.text, out)

    def restored(self, form: str) -> PieceTable:
        """The parts of an arranged table in their first order, without sentinels."""
        if form == PLAIN:
            return PieceTable(self.text, list(self.pieces))
        parts = self.pieces[1::2]
        order = [part for _, part in ARRANGEMENTS[form]]
        return PieceTable(self.text, [parts[order.index(k)] for k in range(len(parts))])

    @classmethod
    def parsed(cls, output: bytes, form: str) -> PieceTable:
        """The table of an output text: its parts lie between the sentinels of the form."""
        if form == PLAIN:
            return cls.whole(output)
        pieces, at = [], 0
        places = []
        for mark, _ in ARRANGEMENTS[form]:
            at = output.index(mark.encode(), at)
            places.append(at)
            at += len(mark)
        for (mark, _), x, z in zip(ARRANGEMENTS[form], places, [*places[1:], len(output)], strict=True):
            pieces += [(TEXT, x, len(mark)), (TEXT, x + len(mark), z - x - len(mark))]
        return cls(output, pieces)

    def runs(self):
        """The bytes of each descriptor, as views."""
        buffers = (memoryview(self.text), memoryview(SENTINELS))
        for buffer, start, length in self.pieces:
            yield buffers[buffer][start : start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for run in self.runs():
            digest.update(run)
        return digest.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.runs())


def draws(key: str, salt: str) -> list[int]:
    """Four numbers below 2**32 from the id of a document."""
    digest = hashlib.sha256(f"{salt}:{key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def token_starts(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of characters as flags, starts of the tokens of each text as byte places, and the tokens' bounds.

    A token is a run of letters a to z in any case, or one other character.
    """
    first = (raw & 0xC0) != 0x80
    letter = ((raw | 0x20) >= ord("a")) & ((raw | 0x20) <= ord("z"))
    starts = first.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    edges = bounds[:-1][np.diff(bounds) > 0]
    starts[edges] = True
    places = np.flatnonzero(starts)
    return first, places, np.searchsorted(places, bounds)


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salt: str = "1",
    plain_from: int = 90,
    spm_below: int = 20,
) -> DataFrame:
    """Per row of ``docs``: id, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``, ``output_sha256``, ``pieces``.

    A text of n tokens is cut at two tokens and arranged as its id tells, by ``salt``: plain in
    100 - ``plain_from`` of a hundred cases, else suffix first (spm) in ``spm_below`` of a hundred, else prefix first (psm). ``pieces``
    are the descriptors of the output: buffer 0 is the text's UTF-8 bytes, buffer 1 is ``<P><S><M>``. Empty and null texts and
    texts with a sentinel in them are plain; a null text is empty. A null id counts as the empty text
    where numbers are drawn. Repeated rows get equal results, an empty table an empty one; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    schema = f"id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, pieces {PIECES}"

    def run(batches):
        for b in batches:
            ids = b.column("id").to_pylist()
            raw, bounds = utf8(b.column("text"))
            for x, z in slices(bounds, SLICE):
                yield _transformed(ids[x:z], raw[bounds[x] : bounds[z]], bounds[x : z + 1] - bounds[x])

    def _transformed(ids, raw, bounds):
        first, places, at = token_starts(raw, bounds)
        found = []
        for k, key in enumerate(ids):
            low, high = int(bounds[k]), int(bounds[k + 1])
            text, n = raw[low:high].tobytes(), int(at[k + 1] - at[k])
            h1, h2, h3, h4 = draws("" if key is None else str(key), salt)
            form = SPM if h4 % 100 < spm_below else PSM
            if not text or h3 % 100 >= plain_from or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
                form = PLAIN
            table, sizes = PieceTable.whole(text), (None, None)
            if form != PLAIN:
                # The place of a token, or the end.
                one, two = (
                    int(places[at[k] + c]) - low if c < n else high - low for c in sorted((h1 % (n + 1), h2 % (n + 1)))
                )
                table.cut(one)
                table.cut(two)
                sizes = int(first[low : low + one].sum()), int(first[low + one : low + two].sum())
            out = table.arranged(form)
            found.append((key, n, form, *sizes, out.joined(), out.sha256(), out.pieces))
        columns = list(zip(*found, strict=True))
        descriptors = [[{"buffer": p, "start": s, "length": m} for p, s, m in own] for own in columns[7]]
        arrays = [
            pa.array(columns[0], pa.int64()),
            pa.array(columns[1], pa.int64()),
            pa.array(columns[2], pa.string()),
            pa.array(columns[3], pa.int64()),
            pa.array(columns[4], pa.int64()),
            pa.array(columns[5], pa.binary()).cast(pa.string()),
            pa.array(columns[6], pa.string()),
            pa.array(descriptors, pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))),
        ]
        names = ["id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"]
        return pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def restore_documents(arranged: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``arranged`` with ``restored_sha256``, and the output put back into the text it was made of, as ``restored``.

    Takes outputs and forms alone. A null output stays null. Columns of the two new names are replaced.
    """
    kept = arranged.drop("restored", "restored_sha256")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches):
        for b in batches:
            texts, hashes = [], []
            for form, output in zip(b.column(form_col).to_pylist(), b.column(output_col), strict=True):
                if not output.is_valid:
                    texts.append(None)
                    hashes.append(None)
                    continue
                table = PieceTable.parsed(output.as_buffer().to_pybytes(), form).restored(form)
                texts.append(table.joined())
                hashes.append(table.sha256())
            new = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, "restored", "restored_sha256"])

    return kept.mapInArrow(run, f"{fields}, restored string, restored_sha256 string")
