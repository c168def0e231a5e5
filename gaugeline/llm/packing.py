"""Packing documents into fixed-length sequences by shortest-pack-first over the length histogram.

Documents are tokenized once into pieces: full pieces of ``size`` tokens and one
remainder. The pieces are written to shared storage together with the number that
each has among its task's pieces of the same length, so ranks follow from counts
per (length, task) without sorting documents; a task's counts are one row. Only the histogram of at most
``size`` lengths reaches the driver, where the packing patterns are made;
patterns are joined back to pieces by rank.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, named, text_blocks
from .token_counts import byte_alphabet

BLOCK_CHARS = 1 << 20
MOST_BROADCAST = 1 << 26
#: The split pattern of byte-level BPE tokenizers (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[str, object] = {}


def encoder(path: str):
    """Function from a text to its ids, as the ``tokenizers`` library gives them without special tokens.

    A byte-level BPE file whose ids follow the order of its merges is run by tiktoken,
    which gives the same ids several times faster; any other file by ``tokenizers``.
    """
    if path not in _encoders:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model.get("merges", ())]
        back = {ch: b for b, ch in byte_alphabet().items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {t: i for t, i in model["vocab"].items() if t not in added}
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer") and len(ranks) == 256 + len(pairs)
        if plain and all(ranks.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs)):
            import tiktoken

            fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks={bytes(back[ch] for ch in t): i for t, i in ranks.items()}, special_tokens=added)
            _encoders[path] = lambda text: fast.encode_to_numpy(text, allowed_special="all")
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            _encoders[path] = lambda text: np.asarray(own.encode(text, add_special_tokens=False).ids, np.uint32)
    return _encoders[path]


PIECES = "doc_tokens long, start long, length long, ids binary, part int, nth long"


def pieces(df: DataFrame, tokenizer_path: str, size: int, end_id: int, key: str, text: str) -> DataFrame:
    """One row per piece: at most ``size`` ids, with the piece's number among those of its length in its task."""
    kind = df.select(named(key)).schema[0].dataType
    schema = f"key {kind.simpleString()}, {PIECES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            done = 0
            for texts in text_blocks(batch.column(1), BLOCK_CHARS):
                rows, tokens, start, length, ids, nth = [], [], [], [], [], []
                for i, text in enumerate(texts, done):
                    own = np.concatenate((encode(text), end))
                    for at in range(0, len(own), size):
                        cut = own[at : at + size]
                        rows.append(i)
                        tokens.append(len(own))
                        start.append(at)
                        length.append(len(cut))
                        ids.append(cut.astype("<u4").tobytes())
                        nth.append(seen[len(cut)])
                        seen[len(cut)] += 1
                done += len(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (tokens, start, length)), pa.array(ids, pa.binary()), pa.array([part] * len(rows), pa.int32()), pa.array(nth, pa.int64())], names=["key", "doc_tokens", "start", "length", "ids", "part", "nth"])

    return df.select(named(key).alias("key"), named(text).alias("text")).mapInArrow(run, schema)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of packs, [(length, how many of it)]) that hold each length as often as the histogram says.

    Lengths are placed longest first, each into the packs that are shortest so far; a
    group of equal packs is one pattern, split only where the pieces run out. The work
    depends on the number of different lengths, not on the number of pieces.
    """
    heap: list[tuple[int, int, int, list]] = []  # filled, order, packs, content
    order = 0
    done: list[tuple[int, list[tuple[int, int]]]] = []

    def put(filled: int, packs: int, content: list) -> None:
        nonlocal order
        if filled == size:
            done.append((packs, content))
        else:
            heapq.heappush(heap, (filled, order, packs, content))
            order += 1

    def add(content: list, length: int, times: int) -> list:
        if content and content[-1][0] == length:
            return [*content[:-1], (length, content[-1][1] + times)]
        return [*content, (length, times)]

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or heap[0][0] + length > size:  # nothing fits: open new packs
                most = size // length
                if left >= most:
                    put(most * length, left // most, [(length, most)])
                if left % most:
                    put(left % most * length, 1, [(length, left % most)])
                break
            filled, _, packs, content = heapq.heappop(heap)
            if left < packs:
                put(filled, packs - left, content)
                put(filled + length, left, add(content, length, 1))
                break
            level = min(heap[0][0] if heap else size, size - length)
            times = max(1, min(left // packs, (level - filled) // length, (size - filled) // length))
            put(filled + times * length, packs, add(content, length, times))
            left -= times * packs
    return done + [(packs, content) for _, _, packs, content in heap]


def slot_table(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For each length, consecutive rank ranges with the first sequence, the repeats in a pack and the offset."""
    rows, rank, base = [], {}, 0
    for packs, content in patterns:
        offset = 0
        for length, times in content:
            lo = rank.get(length, 0)
            rows.append((length, lo, base, times, offset))
            rank[length] = lo + packs * times
            offset += length * times
        base += packs
    rows.sort()
    return dict(zip(("length", "lo", "base", "times", "offset"), np.array(rows, np.int64).reshape(-1, 5).T.copy(), strict=True))


def pack(df: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack every document into sequences of at most ``size`` ids.

    Result, one row per piece: ``key`` (under its own name), ``doc_tokens`` (ids of the
    document with its end id), ``start`` (ids of the document before the piece),
    ``length``, ``ids`` (binary, little-endian unsigned 32-bit), ``sequence_id`` and
    ``offset`` (position in the sequence, gapless from 0). Null and empty texts are one
    piece that holds the end id alone. Repeated rows and null keys are packed like any
    other row; an empty table gives an empty result. Other columns are not carried.
    A document longer than ``size`` is cut into full pieces and one remainder.
    """
    cut = materialize(pieces(df, tokenizer_path, size, end_id, key, text), "pieces")
    by_task = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    by_task = materialize(by_task, "piece-counts")
    # at most `size` rows, whatever the input
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slot_table(shortest_pack_first(histogram, size))
    span = max(histogram.values(), default=0) + 1
    keys = slots["length"] * span + slots["lo"]

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, n * span + r, side="right") - 1
        inner = r - slots["lo"][at]
        times = slots["times"][at]
        return pa.StructArray.from_arrays([pa.array(slots["base"][at] + inner // times), pa.array(slots["offset"][at] + inner % times * n)], names=["sequence_id", "offset"])

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))

    def row_of(counts: pa.Table) -> pa.Table:
        own = np.zeros(size + 1, np.int64)
        own[counts["length"].to_numpy()] = counts["before"].to_numpy()
        return pa.table({"part": counts["part"][:1], "offsets": pa.array([own], pa.list_(pa.int64()))})

    offsets = by_task.select("length", "part", F.coalesce(before, F.lit(0)).alias("before")).groupBy("part").applyInArrow(row_of, "part int, offsets array<long>")
    # a row of 8 * size bytes for each task: broadcast while that is small, else joined by an exchange
    tasks = by_task.agg(F.max("part")).first()[0] or 0
    offsets = F.broadcast(offsets) if tasks * 8 * size <= MOST_BROADCAST else offsets.hint("merge")
    # rand() keeps Spark from moving this sum, and with it a whole array for each row, into the function's input
    rank = F.when(F.rand() >= 0, F.element_at("offsets", (F.col("length") + 1).cast("int")) + F.col("nth"))
    ranked = cut.join(offsets, "part").select("key", "doc_tokens", "start", "length", "ids", rank.alias("rank"))
    placed = ranked.withColumn("at", place("length", "rank"))
    return placed.select(F.col("key").alias(key), "doc_tokens", "start", "length", "ids", "at.sequence_id", "at.offset")
