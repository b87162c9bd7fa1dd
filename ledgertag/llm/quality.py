"""A quality classifier trained without gold labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. The
votes of the whole table are counted by pattern (their number is bounded by
4 ** labellers), and expectation maximisation on these counts estimates how often
each labeller is right and what share of documents is good. The posterior of a
document's pattern is its soft label. On a bounded sample of documents a linear
scorer learns these labels from hashed features; it then scores every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import SLICE, mixed, slices, text_of, utf8

GOOD, BAD, ABSTAIN, UNASKED = 1, 0, -1, -2

#: Marks that running prose hardly has. Fixed values.
MARKS = "#$%&*!|@^~<>{}[]\\_=+"


def measures(texts: list[str], raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """What the labellers look at, one row per text.

    Words; the shares of marks in characters and of capitals in letters; the share
    of distinct runs of five words; the shares of words that repeat the word before
    and that end a sentence; the share of distinct words, less strict for long
    texts; the share of letters and digits in characters that aren't blank. A byte from 128
    on that starts a character counts as a letter.
    """
    counts = []
    for kinds in (_CHARACTER, _MARK, _CAPITAL, _LETTER, _DIGIT, _BLANK):
        sums = np.concatenate([[0], np.cumsum(kinds[raw], dtype=np.int64)])
        counts.append(sums[bounds[1:]] - sums[bounds[:-1]])
    characters, marks, capitals, letters, digits, blanks = counts
    by_word = np.zeros((len(texts), 5))
    for i, text in enumerate(texts):
        words = text.split()
        n = len(words)
        if n:
            fives = set(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
            level = sum(map(str.__eq__, words, words[1:]))
            ends = sum(w[-1] in ".!?:" for w in words)
            runs = len(fives) / (n - 4) if n > 4 else 1.0
            distinct = min(1.0, len(set(words)) / n ** 0.8)  # new words get rarer as a text goes on
            by_word[i] = n, runs, level / max(1, n - 1), ends / n, distinct
    return np.column_stack(
        [
            by_word[:, 0],
            marks / np.maximum(1, characters),
            capitals / np.maximum(1, letters),
            by_word[:, 1:],
            (letters + digits) / np.maximum(1, characters - blanks),
        ]
    )


@dataclass(frozen=True)
class Labeller:
    """Votes on one measure: bad beyond ``bad``, good up to ``good``, else abstains.

    Texts of fewer than ``least`` words aren't put to it. ``sign`` -1 turns the scale round.
    """

    name: str
    measure: int
    good: float
    bad: float
    least: int = 1
    sign: int = 1

    def votes(self, m: np.ndarray) -> np.ndarray:
        x = self.sign * m[:, self.measure]
        v = np.where(x >= self.sign * self.bad, BAD, np.where(x <= self.sign * self.good, GOOD, ABSTAIN))
        return np.where(m[:, 0] >= self.least, v, UNASKED).astype(np.int8)


LABELLERS = (
    Labeller("marks", 1, good=0.005, bad=0.03),
    Labeller("capitals", 2, good=0.15, bad=0.6, least=3),
    Labeller("repeated runs", 3, good=0.95, bad=0.7, least=8, sign=-1),
    Labeller("repeated words", 4, good=0.03, bad=0.2, least=4),
    Labeller("distinct words", 6, good=0.6, bad=0.35, least=8, sign=-1),
    Labeller("sentences", 5, good=0.04, bad=0.01, least=60, sign=-1),
    Labeller("letters", 7, good=0.9, bad=0.75, least=8, sign=-1),
)


@dataclass
class LabelModel:
    """Share of good documents, and P(vote | class) of each labeller: [labeller, class, vote].

    To abstain is a vote of its own, as a labeller of one kind of junk says little
    about documents without it.
    """

    prior: float
    chances: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for k in range(votes.shape[1]):
            asked = votes[:, k] != UNASKED
            log[asked] += np.log(self.chances[k][:, votes[asked, k] + 1]).T
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))


#: Where estimation starts: votes of abstain, bad, good on bad and on good documents.
FIRST_CHANCES = ((0.4, 0.3, 0.3), (0.35, 0.05, 0.6))


def fit_labels(votes: np.ndarray, counts: np.ndarray, rounds: int = 500) -> LabelModel:
    """Expectation maximisation over vote patterns and how often each occurs.

    The start names the two classes; a pseudo-count keeps probabilities off 0 and 1.
    """
    start = np.array(FIRST_CHANCES)
    model = LabelModel(0.7, np.tile(start, (votes.shape[1], 1, 1)))
    for _ in range(rounds):
        p = model.posterior(votes)
        new = np.empty_like(model.chances)
        for c, w in enumerate((counts * (1 - p), counts * p)):
            for j in range(votes.shape[1]):
                asked = votes[:, j] != UNASKED
                by_vote = np.bincount(votes[asked, j] + 1, w[asked], minlength=3)
                new[j, c] = (by_vote + start[c]) / (by_vote.sum() + 1)
        prior = float(((counts * p).sum() + 0.7) / (counts.sum() + 1))
        done = abs(prior - model.prior) + np.abs(new - model.chances).max() < 1e-9
        model = LabelModel(prior, new)
        if done:
            break
    return model


@dataclass
class Scorer:
    """Weights of hashed features; the logit is their mean over a document's features."""

    weights: np.ndarray
    bias: float

    def __call__(self, hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[hashed])])
        return self.bias + (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(1, np.diff(bounds))


def features(raw: np.ndarray, bounds: np.ndarray, m: np.ndarray, bits: int):
    """Hashed features of texts: three-byte strings, and each measure's bin once per sixteen bytes.

    Letters count by case only and digits as one, so that features describe form
    and not words. Measures are repeated so that long texts don't drown them.
    """
    kind = _KINDS[raw].astype(np.uint64)
    n = len(bounds) - 1
    grams = np.zeros(len(raw), np.uint64)
    if len(raw) > 2:
        grams[:-2] = kind[:-2] | (kind[1:-1] << np.uint64(8)) | (kind[2:] << np.uint64(16))
    grams = (mixed(grams) >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.linspace(0, 1, 41)
    bins = np.stack(
        [np.minimum(40, np.log2(1 + m[:, 0]) * 2).astype(np.int64)]
        + [np.digitize(m[:, j], cuts) for j in range(1, m.shape[1])]
    )
    named = bins.astype(np.uint64) + (np.arange(len(bins), dtype=np.uint64)[:, None] + 1) * np.uint64(1 << 32)
    named = (mixed(named) >> np.uint64(64 - bits)).astype(np.int64).T
    again = 1 + np.diff(bounds) // 16
    sizes = np.diff(bounds) + again * named.shape[1]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(ends[-1], np.int64)
    for i in range(n):
        a, b = bounds[i], bounds[i + 1]
        out[ends[i] : ends[i] + b - a] = grams[a:b]
        out[ends[i] + b - a : ends[i + 1]] = np.tile(named[i], again[i])
    return out, ends


def _kinds() -> np.ndarray:
    kinds = np.arange(256, dtype=np.uint8)
    kinds[ord("a") : ord("z") + 1] = ord("a")
    kinds[ord("A") : ord("Z") + 1] = ord("A")
    kinds[ord("0") : ord("9") + 1] = ord("0")
    kinds[128:] = ord("a")
    return kinds


def _flags(chars: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in chars]).astype(np.uint8)


_KINDS = _kinds()
_CHARACTER = ((np.arange(256) & 0xC0) != 0x80).astype(np.uint8)
_MARK = _flags(MARKS)
_CAPITAL = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 0xC0).astype(np.uint8)
_DIGIT = _flags("0123456789")
_BLANK = _flags(" \t\n\r\v\f")


def fit_scorer(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int, steps: int = 150
) -> Scorer:
    """Logistic regression on soft labels by gradient descent with a step size per weight.

    ``rows`` has each document's feature numbers and their shares.
    """
    weights, seen, bias, bias_seen = np.zeros(1 << bits), np.full(1 << bits, 1e-12), 0.0, 1e-12
    if rows:
        index = np.concatenate([r[0] for r in rows])
        share = np.concatenate([r[1] for r in rows])
        row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        for _ in range(steps):
            logit = bias + np.bincount(row, share * weights[index], minlength=len(rows))
            error = 1 / (1 + np.exp(-np.clip(logit, -50, 50))) - labels
            slope = np.bincount(index, share * error[row], minlength=1 << bits) / len(rows)
            seen += slope**2
            weights -= 10.0 * slope / np.sqrt(seen)
            bias_seen += error.mean() ** 2
            bias -= 0.2 * error.mean() / np.sqrt(bias_seen)
    return Scorer(weights, float(bias))


def _walk(batches):
    """Some rows, the bytes of their texts, the texts' bounds and measures, a few MB of text at a time."""
    for b in batches:
        raw, bounds = utf8(b.column("_text"))
        for a, z in slices(bounds, SLICE):
            part, own = raw[bounds[a] : bounds[z]], bounds[a : z + 1] - bounds[a]
            some = b.slice(a, z - a)
            yield some, part, own, measures(some.column("_text").to_pylist(), part, own)


def cast_votes(m: np.ndarray, labellers: tuple[Labeller, ...]) -> np.ndarray:
    return np.stack([x.votes(m) for x in labellers], axis=1)


def fit_label_model(docs: DataFrame, labellers: tuple[Labeller, ...], text_col: str) -> tuple[LabelModel, int]:
    """The label model, from the votes of all documents that have words; and their number."""
    places = 4 ** np.arange(len(labellers))

    def count(batches):
        for _, _, _, m in _walk(batches):
            votes = cast_votes(m[m[:, 0] > 0], labellers).astype(np.int64)
            code, n = np.unique(((votes + 2) * places).sum(axis=1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    texts = docs.select(text_of(text_col).alias("_text"))
    counted = texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    found = counted.collect()  # at most 4 ** len(labellers) rows
    code = np.array([r["code"] for r in found], np.int64)
    n = np.array([r["n"] for r in found], np.float64)
    return fit_labels((code[:, None] // places % 4 - 2).astype(np.int8), n), int(n.sum())


def score_documents(
    docs: DataFrame,
    text_col: str = "text",
    labellers: tuple[Labeller, ...] = LABELLERS,
    sample_rows: int = 2000,
    bits: int = 16,
    threshold: float = 0.5,
) -> DataFrame:
    """``docs`` with ``weak_label`` (posterior), ``score`` (0 to 1) and ``keep``.

    The label model is fitted on the votes of all documents, the scorer on at most
    ``sample_rows`` documents, those with the smallest hashes of their text. A document
    is kept if its score reaches ``threshold``. A null or blank text gets no
    votes, score 0 and isn't kept. Equal texts get equal scores; null and
    repeated ids are rows like any other; an empty table gives an empty result.
    Other columns are returned as they are, but those with the names of the new ones are replaced.
    """
    model, _ = fit_label_model(docs, labellers, text_col)
    texts = docs.select(text_of(text_col).alias("_text")).filter(F.trim("_text") != "")
    hashes = texts.select(F.xxhash64("_text").alias("_hash")).distinct().orderBy("_hash").limit(sample_rows)
    last = hashes.agg(F.max("_hash")).first()[0]

    def sample(batches):
        for _, raw, bounds, m in _walk(batches):
            hashed, ends = features(raw, bounds, m, bits)
            labels = model.posterior(cast_votes(m, labellers))
            rows = [np.unique(hashed[a:z], return_counts=True) for a, z in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i.astype(np.int32).tobytes() for i, _ in rows], pa.binary()),
                    pa.array([(n / n.sum()).astype(np.float32).tobytes() for _, n in rows], pa.binary()),
                    pa.array(labels),
                ],
                ["i", "n", "label"],
            )

    chosen = texts.filter(F.xxhash64("_text") <= F.lit(last)).dropDuplicates(["_text"]).limit(sample_rows)
    taken = chosen.mapInArrow(sample, "i binary, n binary, label double").toArrow()
    scorer = fit_scorer(
        [
            (np.frombuffer(i, np.int32), np.frombuffer(n, np.float32))
            for i, n in zip(taken["i"].to_pylist(), taken["n"].to_pylist(), strict=True)
        ],
        taken["label"].to_numpy(),
        bits,
    )
    new = ("weak_label", "score", "keep")
    rows = docs.drop(*new).withColumn("_text", text_of(text_col))
    names = [c for c in rows.columns if c != "_text"]

    def score(batches):
        for some, raw, bounds, m in _walk(batches):
            hashed, ends = features(raw, bounds, m, bits)
            logit = np.clip(scorer(hashed, ends), -50, 50)
            blank = m[:, 0] == 0
            values = np.where(blank, 0.0, 1 / (1 + np.exp(-logit)))
            labels = np.where(blank, 0.0, model.posterior(cast_votes(m, labellers)))
            yield pa.RecordBatch.from_arrays(
                [*(some.column(c) for c in names), pa.array(labels), pa.array(values), pa.array(~blank & (values >= threshold))],
                [*names, *new],
            )

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(score, f"{fields}, weak_label double, score double, keep boolean")


def classify_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Id, ``weak_label``, ``score`` and ``keep`` of every document, as ``score_documents`` gives them."""
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_own"))
    scored = score_documents(narrow, "_own", **how)
    return scored.select(F.col("_id").alias(id_col), "weak_label", "score", "keep")


def keep_quality(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The documents that are kept, with their columns."""
    wrapped = docs.select(F.struct(*docs.columns).alias("_doc"), text_of(text_col).alias("_own"))
    return score_documents(wrapped, "_own", **how).filter("keep").select("_doc.*")
