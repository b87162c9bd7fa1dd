"""Packing of token sequences by lexical retrieval.

Documents are tokenised; their full windows are sequences by themselves, and what is
left of a document is an item to be packed. Items are dealt to index shards by their most
telling tokens (highest BM25 weight), so that related items share a shard. Each shard
is an inverted index with BM25 weights, whose document counts and lengths are those of the whole
corpus. The first unused item is a seed; its unused neighbours, best first, fill its
window, and the last one is cut where the window ends and stays in the index with its
rest. So only the last window of a shard is padded. Sequences are numbered over all shards in the order
of the documents that begin them, full windows included.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import positions, tasks, text_of, written

#: Fixed value: how byte-level BPE vocabularies of this kind cut text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
K1, B = 1.2, 0.75
PIECES = (
    "_id {id}, start long, length long, ids_crc32 long, doc_tokens long, offset long, "
    "_seed_order {order}, _seed_row long, _seed_start long"
)


@functools.cache
def load_tokenizer(path: str):
    """A function from text to token ids and the smallest type that holds them, for a byte-level BPE tokenizer file.

    The file's merges are in order of their ids, so the ids serve as ranks; special tokens are
    found in texts, as the file has them.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model["type"] != "BPE" or spec["normalizer"] or any(before.get(k) != v for k, v in plain.items()):
        raise ValueError(f"{path} isn't a plain byte-level BPE tokenizer")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    # Bytes that have no printable character of their own stand for the ones from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte = {chr(b): b for b in shown}
    byte.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
    ranks = {bytes(byte[c] for c in w): i for w, i in model["vocab"].items() if w not in special}
    merged = [ranks[bytes(byte[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in model["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"the ids in {path} aren't in order of its merges")
    engine = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    kind = "<u2" if max([*ranks.values(), *special.values()]) < 1 << 16 else "<u4"
    return lambda text: engine.encode_to_numpy(text, allowed_special="all"), kind


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(rows: DataFrame, tokenizer: str, window: int, end: int) -> DataFrame:
    """Per document (``_id``, ``_order``, ``_text``): its tokens' number, a checksum of each full window, the rest.

    ``row`` is unique and leaves room for the document's full windows.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        encode, kind = load_tokenizer(tokenizer)
        task = TaskContext.get()
        at = (task.partitionId() if task else 0) << 40
        for b in batches:
            # A few documents at a time, as their ids take more room than their texts.
            for x in range(0, b.num_rows, 256):
                some = b.slice(x, 256)
                n, crcs, tails, rows_ = [], [], [], []
                for text in some.column("_text").to_pylist():
                    ids = np.append(encode(text), np.uint32(end)).astype("<u4")
                    full = len(ids) // window
                    n.append(len(ids))
                    crcs.append([zlib.crc32(ids[k * window : (k + 1) * window].tobytes()) for k in range(full)])
                    tails.append(ids[full * window :].astype(kind).tobytes())
                    rows_.append(at)
                    at += full + 1
                yield pa.RecordBatch.from_arrays(
                    [some.column("_id"), some.column("_order"), pa.array(rows_, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.binary())],
                    ["_id", "_order", "row", "n", "crcs", "tail"],
                )

    return rows.mapInArrow(
        run, f"_id {kinds['_id']}, _order {kinds['_order']}, row long, n long, crcs array<bigint>, tail binary"
    )


def _ramps(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """first[0] ... end[0] - 1, first[1] ... end[1] - 1, and so on."""
    n = end - first
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


class Statistics:
    """What BM25 needs to know of all items: how many hold each token, and their mean length."""

    def __init__(self, tokens: np.ndarray, held: np.ndarray, items: int, mean: float):
        self.items, self.mean = items, mean
        df = np.zeros(int(tokens.max(initial=0)) + 1)
        df[tokens] = held
        self.idf = np.log1p((items - df + 0.5) / (df + 0.5))

    def weights(self, token: np.ndarray, times: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Weights of tokens that occur so often in items of ``n`` tokens."""
        norm = K1 * (1 - B + B * n / max(self.mean, 1e-9))
        return self.idf[token] * times * (K1 + 1) / (times + norm)


def statistics(items: DataFrame, kind: str) -> Statistics:
    """Over all items; the vocabulary bounds what comes to the driver."""

    def count(batches):
        held = np.zeros(1 << 16, np.int64)
        n, length = 0, 0
        for b in batches:
            for tail in b.column("tail").to_pylist():
                found = np.unique(np.frombuffer(tail, kind))
                if found[-1] >= len(held):
                    held = np.append(held, np.zeros(int(found[-1]) + 1 - len(held), np.int64))
                held[found] += 1
                n, length = n + 1, length + len(tail) // np.dtype(kind).itemsize
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*some.tolist(), -1, -2], pa.int64()), pa.array([*held[some].tolist(), n, length], pa.int64())],
            ["token", "held"],
        )

    counted = items.select("tail").mapInArrow(count, "token long, held long")
    sums = counted.groupBy("token").agg(F.sum("held").alias("held")).toArrow()
    token, held = sums["token"].to_numpy(), sums["held"].to_numpy()
    n, length = int(held[token == -1].sum()), int(held[token == -2].sum())
    return Statistics(token[token >= 0], held[token >= 0].astype(float), n, length / max(1, n))


def fill_windows(tails: list[np.ndarray], stats: Statistics, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, first token, tokens), seeds in the order given."""
    n = np.array([len(x) for x in tails], np.int64)
    pair, times = np.unique(
        np.repeat(np.arange(len(tails)), n) << 32 | np.concatenate(tails).astype(np.int64), return_counts=True
    )
    item, token = pair >> 32, pair & 0xFFFFFFFF
    weight = stats.weights(token, times, n[item])
    by_token = np.argsort(token, kind="stable")
    post_item, post_weight, post_token = item[by_token], weight[by_token], token[by_token]
    starts = np.searchsorted(item, np.arange(len(tails) + 1))
    low, high = np.searchsorted(post_token, token), np.searchsorted(post_token, token, "right")
    at, left = np.zeros(len(tails), np.int64), n.copy()
    out = []
    for seed in range(len(tails)):
        while left[seed]:
            take = min(window, int(left[seed]))
            pieces, room = [(seed, int(at[seed]), take)], window - take
            at[seed] += take
            left[seed] -= take
            if room and left.any():
                own = slice(starts[seed], starts[seed + 1])
                hits = _ramps(low[own], high[own])
                score = np.bincount(post_item[hits], post_weight[hits], minlength=len(tails))
                score[left == 0] = -1.0
                for k in np.argsort(-score, kind="stable"):
                    if not room or not left[k]:
                        break
                    take = min(room, int(left[k]))
                    pieces.append((int(k), int(at[k]), take))
                    at[k] += take
                    left[k] -= take
                    room -= take
            out.append(pieces)
    return out


def _place(value) -> tuple:
    """Something to sort by, nulls first; of a struct its fields."""
    return value is not None, tuple(value.values()) if isinstance(value, dict) else value


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    window: int = 1024,
    end: int = 0,
    shard_items: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
    order_col: str | None = None,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document's tokens are those of its text and one ``end``; ``start`` counts its tokens before the piece,
    ``offset`` the sequence's. A sequence has at most ``window`` tokens. ``tokenizer`` is the path of a byte-level BPE
    file that all executors have. Seeds are taken in order of ``order_col`` (the id, if there is none; nulls first) within a
    shard of at most ``shard_items`` items, and ``sequence_id`` counts all sequences from 0 in that order of the document that
    their first piece is of. So what comes up to a document's first piece as a seed holds all documents before it, whole,
    and of later ones only what was taken as neighbours. Null texts are empty, and have one token. Null, repeated
    and equal rows are packed like any other; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(order_col or id_col).alias("_order"), text_of(text_col).alias("_text")
    )
    table = written(tokenised(rows, tokenizer, window, end), "tokens")
    kind = table.schema["_id"].dataType.simpleString()
    items = table.filter(F.octet_length("tail") > 0).select("_id", "_order", "row", "n", "tail")
    id_kind = load_tokenizer(tokenizer)[1]
    stats = statistics(items, id_kind)

    def telling(batches):
        for b in batches:
            top = np.full((b.num_rows, 2), -1, np.int64)
            for i, tail in enumerate(b.column("tail").to_pylist()):
                ids = np.frombuffer(tail, id_kind)
                token, times = np.unique(ids, return_counts=True)
                best = np.argsort(-stats.weights(token, times, len(ids)), kind="stable")[:2]
                top[i, : len(best)] = token[best]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(top[:, 0].copy()), pa.array(top[:, 1].copy())], [*b.schema.names, "one", "two"]
            )

    order = items.schema["_order"].dataType.simpleString()
    keyed = items.mapInArrow(telling, f"_id {kind}, _order {order}, row long, n long, tail binary, one long, two long")
    parts = max(1, min(tasks(spark), stats.items // shard_items))
    near = keyed.repartitionByRange(parts, "one", "two", "row").sortWithinPartitions("one", "two", "row")

    def pack(batches):
        held: list[pa.RecordBatch] = []

        def shard(t: pa.Table):
            keys = list(zip(map(_place, t["_order"].to_pylist()), t["row"].to_pylist(), strict=True))
            t = t.take(pa.array(sorted(range(len(keys)), key=keys.__getitem__), pa.int64()))
            ids = [np.frombuffer(x, id_kind) for x in t["tail"].to_pylist()]
            n = t["n"].to_numpy()
            cols: list[list] = [[] for _ in range(8)]
            for pieces in fill_windows(ids, stats, window):
                offset, (seed, seed_first, _) = 0, pieces[0]
                for k, first, size in pieces:
                    begin = int(n[k]) - len(ids[k])
                    values = (k, begin + first, size, _crc(ids[k][first : first + size]), int(n[k]), offset, seed, int(n[seed]) - len(ids[seed]) + seed_first)
                    for c, v in zip(cols, values, strict=True):
                        c.append(v)
                    offset += size
            seeds = pa.array(cols[6], pa.int64())
            arrays = [t["_id"].combine_chunks().take(pa.array(cols[0]))] + [pa.array(c, pa.int64()) for c in cols[1:6]]
            arrays += [t[c].combine_chunks().take(seeds) for c in ("_order", "row")] + [pa.array(cols[7], pa.int64())]
            return pa.RecordBatch.from_arrays(
                arrays,
                ["_id", "start", "length", "ids_crc32", "doc_tokens", "offset", "_seed_order", "_seed_row", "_seed_start"],
            )

        for b in batches:
            held.append(b)
            while sum(x.num_rows for x in held) >= 2 * shard_items:
                t = pa.Table.from_batches(held)
                yield shard(t.slice(0, shard_items))
                held = t.slice(shard_items).to_batches()
        rest = [x for x in held if x.num_rows]
        if rest:
            t = pa.Table.from_batches(rest)
            # Up to two shards' worth, halved so that none is tiny.
            cut = t.num_rows if t.num_rows <= shard_items else -(-t.num_rows // 2)
            yield shard(t.slice(0, cut))
            if cut < t.num_rows:
                yield shard(t.slice(cut))

    packed = near.mapInArrow(pack, PIECES.format(id=kind, order=order))
    whole = table.select("_id", "_order", "row", F.col("n").alias("doc_tokens"), F.posexplode("crcs").alias("k", "ids_crc32"))
    start = (F.col("k") * window).cast("long")
    whole = whole.select(
        "_id",
        start.alias("start"),
        F.lit(window).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        F.lit(0).cast("long").alias("offset"),
        F.col("_order").alias("_seed_order"),
        F.col("row").alias("_seed_row"),
        start.alias("_seed_start"),
    )
    pieces = whole.unionByName(packed).withColumn("_first", F.when(F.col("offset") == 0, 1).otherwise(0).cast("long"))
    numbered = positions(pieces, ["_seed_order", "_seed_row", "_seed_start", "offset"], size="_first")
    return numbered.select(
        F.col("_id").alias(id_col),
        *["start", "length", "ids_crc32", "doc_tokens"],
        (F.col("before") + F.col("_first") - 1).alias("sequence_id"),
        "offset",
    )
