"""Alignment of the tokens of two tokenizers by the bytes that they cover.

The tokens of a text cover its bytes without gaps, in both tokenizers. The ranges of the
B tokens are a static interval index: two sorted arrays, of starts and of ends. Every A token stabs it with its
own range by two bisections and gets the list of the B tokens that overlap it, which are consecutive. Where no
B token lies in the lists of two neighbouring A tokens, the gap between them is spanned by no token of either side; such
gaps are the boundaries of groups. All A and B tokens of a group are linked.

How many documents link a pair of ids is counted over the whole corpus. Documents carry their different
pairs with the number of links. Frequent pairs, at most ``FREQUENT`` of them whatever the corpus, are looked up in the tasks;
the links of all other pairs, each in few documents, meet their counts by an exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, named, text_blocks
from .token_counts import byte_alphabet

BLOCK_CHARS = 1 << 20
#: Pairs whose counts are sent to all tasks: 17 bytes each.
FREQUENT = 1 << 20
#: Links of a group that are expanded one by one; larger groups put equal ids together first.
SMALL_GROUP = 256
#: Pairs of one row between the steps.
ROW_PAIRS = 1 << 16
#: Pairs that a task adds up before it passes them on.
HELD_PAIRS = 1 << 21


# --- tokenizers -----------------------------------------------------------------------


class ByteLevel:
    """Ids and bytes of the tokens of a byte-level BPE file; special strings within texts are plain text."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        from .packing import encoder

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.quick = encoder(path)
        back = {ch: bytes([b]) for b, ch in byte_alphabet().items()}
        vocabulary = self.library.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = b"".join(back.get(ch, ch.encode()) for ch in token)

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, np.int64)
        return np.asarray(self.quick(text), np.int64)


class Pieces:
    """Ids and bytes of the tokens of a sentencepiece file, which adds the blank before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode(text, num_threads=1), np.int64)


class Aligner:
    """Aligns texts with two tokenizers; one for each Python worker."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.size_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.size_b = np.array([len(x) for x in self.b.bytes], np.int64)
        self.text_a = np.array([str(i) for i in range(len(self.a.bytes))], object)
        self.text_b = np.array([str(i) for i in range(len(self.b.bytes))], object)

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both sides, or None where a side's bytes aren't those of a blank and the text."""
        if not text:
            return None
        want = (" " + text).encode()
        a, b = self.a.encode(" " + text), self.b.encode(text)
        for ids, table in ((a, self.a.bytes), (b, self.b.bytes)):
            if b"".join(map(table.__getitem__, ids.tolist())) != want:
                return None
        return a, b

    def align(self, text: str) -> Alignment | None:
        found = self.tokens(text)
        return None if found is None else Alignment(*found, *groups(self.size_a[found[0]], self.size_b[found[1]]))


def overlaps(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A token the first and the last B token whose range overlaps its own."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    start_a, start_b = end_a - size_a, end_b - size_b
    return np.searchsorted(end_b, start_a, side="right"), np.searchsorted(start_b, end_a, side="left") - 1


def groups(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups begin, as positions in A and in B."""
    first, last = overlaps(size_a, size_b)
    cut = np.flatnonzero(last[:-1] < first[1:]) + 1
    at_a = np.concatenate(([0], cut))
    return at_a, first[at_a]


class Alignment:
    """The groups of one text."""

    def __init__(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray):
        self.a, self.b, self.at_a, self.at_b = a, b, at_a, at_b
        self.n_a, self.n_b = np.diff(np.append(at_a, len(a))), np.diff(np.append(at_b, len(b)))
        self.n_links = int((self.n_a * self.n_b).sum())

    def spelled(self, text_a: np.ndarray, text_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: each token is followed by the sign that stands after it."""
        after_a, after_b = np.full(len(self.a), ",", object), np.full(len(self.b), ",", object)
        after_a[self.at_a + self.n_a - 1] = "|"
        after_b[self.at_b + self.n_b - 1] = ";"
        out = np.empty(2 * (len(self.a) + len(self.b)), object)
        # B tokens of a group come after its A tokens
        place_a = np.arange(len(self.a)) + np.repeat(self.at_b, self.n_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.at_a + self.n_a, self.n_b)
        out[2 * place_a], out[2 * place_a + 1] = text_a[self.a], after_a
        out[2 * place_b], out[2 * place_b + 1] = text_b[self.b], after_b
        return "".join(out[:-1].tolist())

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The different linked pairs (A id << 32 | B id) and how many links each has.

        Small groups are expanded together; in others equal ids are put together first, so that a long
        group costs its different pairs and not its links.
        """
        links = self.n_a * self.n_b
        small = links <= SMALL_GROUP
        size, n_b = links[small], self.n_b[small]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        n_b = np.repeat(n_b, size)
        at_a, at_b = np.repeat(self.at_a[small], size) + inner // n_b, np.repeat(self.at_b[small], size) + inner % n_b
        keys, times = [self.a[at_a] << 32 | self.b[at_b]], [np.ones(len(at_a), np.int64)]
        held = len(at_a)
        for g in np.flatnonzero(~small).tolist():
            a, n = np.unique(self.a[self.at_a[g] : self.at_a[g] + self.n_a[g]], return_counts=True)
            b, m = np.unique(self.b[self.at_b[g] : self.at_b[g] + self.n_b[g]], return_counts=True)
            keys.append((a[:, None] << 32 | b[None, :]).reshape(-1))
            times.append((n[:, None] * m[None, :]).reshape(-1))
            held += len(keys[-1])
            if held > HELD_PAIRS:
                k, t = added(np.concatenate(keys), np.concatenate(times))
                keys, times, held = [k], [t], len(k) // 2
        return added(np.concatenate(keys), np.concatenate(times))


def added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, with their times added up."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.intp)
    return keys[starts], np.add.reduceat(times, starts) if len(starts) else times


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


# --- Spark jobs -----------------------------------------------------------------------

LINKS = "part int, nth long, n_a long, n_b long, n_groups long, n_links long, spelled string, pairs binary, times binary"


def aligned(df: DataFrame, path_a: str, path_b: str, key: str, text: str, digest: bool) -> DataFrame:
    """A row for each text with its groups and pairs; a text of more pairs has further rows that hold pairs alone."""
    kind = df.select(named(key)).schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, nth = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        names = ["key", *(c.split()[0] for c in LINKS.split(", "))]
        for batch in batches:
            done = 0
            for texts in text_blocks(batch.column(1), BLOCK_CHARS):
                rows, takes = [], []
                for i, one in enumerate(texts, done):
                    found = own.align(one)
                    if found is None:
                        rows.append((part, nth, 0, 0, 0, 0, "", b"", b""))
                        takes.append(i)
                    else:
                        spelled = found.spelled(own.text_a, own.text_b)
                        head = len(found.a), len(found.b), len(found.at_a), found.n_links, hashlib.sha256(spelled.encode()).hexdigest() if digest else spelled
                        keys, times = found.pairs()
                        for at in range(0, len(keys), ROW_PAIRS):
                            rows.append((part, nth, *head, keys[at : at + ROW_PAIRS].astype("<i8").tobytes(), times[at : at + ROW_PAIRS].astype("<i4" if found.n_links < 2**31 else "<i8").tobytes()))
                            takes.append(i)
                            head = None, None, None, None, None
                    nth += 1
                done += len(texts)
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(takes, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return df.select(named(key).alias("key"), named(text).alias("text")).mapInArrow(run, f"key {kind.simpleString()}, {LINKS}")


def link_arrays(keys: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(keys, "<i8")
    return keys, np.frombuffer(times, "<i4" if len(times) == 4 * len(keys) else "<i8").astype(np.int64)


def pair_counts(links: DataFrame) -> DataFrame:
    """How many texts link each pair: pair, n, and whether no other pair of its A id has more (``best``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(keys), ROW_PAIRS):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + ROW_PAIRS], pa.int64()), pa.array(n[at : at + ROW_PAIRS], pa.int64())], names=["pair", "n"])

        for batch in batches:
            for keys in batch.column(0):
                held.append(np.frombuffer(keys.as_buffer(), "<i8").copy())
                size += len(held[-1])
                if size > HELD_PAIRS:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    counts = materialize(links.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return materialize(counts.join(most, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best"), counts


def frequent_pairs(counts: DataFrame) -> tuple[int, DataFrame]:
    """The least count that at most FREQUENT pairs reach, and those pairs. The histogram has a row for each power of an eighth root of two."""
    level = F.floor(F.log2("n") * 8)
    histogram = sorted(((r["level"], r["k"]) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    total, least = 0, None
    for at, k in histogram:
        total += k
        if total > FREQUENT:
            break
        least = at
    return counts.filter(level >= least) if least is not None else counts.filter(F.lit(False)), counts.filter(level < least) if least is not None else counts


def align(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Align every text's tokens of a byte-level BPE file (A, of a blank and the text) and of a sentencepiece file (B, which adds the blank).

    Result, a row for each row of ``df``: ``key``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links`` (pairs of tokens that share a
    group), ``n_best`` (links whose pair of ids is one of the most frequent of its A id), ``count_sum`` (over all links, in how many
    rows of the corpus the pair of ids is linked) and ``groups`` (decimal ids, ``a1,a2|b1;a3|b2,b3``), or with ``digest`` its SHA-256 as
    ``groups_sha256``.

    Null and empty texts, and those whose tokens of a side don't spell a blank and the text, have no tokens: zeros and ''. Repeated
    rows and null keys are rows like others. An empty table gives an empty result. Other columns are not
    carried. Texts are read whole; memory is one text's tokens and different pairs. Special strings within texts are plain text.
    """
    links = materialize(aligned(df, path_a, path_b, key, text, digest), "links")
    counts, plain = pair_counts(links)
    frequent, rare = frequent_pairs(counts)
    top = frequent.toPandas().sort_values("pair")  # at most FREQUENT rows, whatever the input
    context = df.sparkSession.sparkContext
    known = context.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            sums, bests, rest, rest_times = [], [], [], []
            for keys, times in zip(batch.column(2), batch.column(3), strict=True):
                keys, times = link_arrays(keys.as_buffer(), times.as_buffer())
                at = np.searchsorted(pair, keys)
                at[at == len(pair)] = 0
                hit = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
                at = at[hit]
                sums.append(int((times[hit] * n[at]).sum()) if len(at) else 0)
                bests.append(int(times[hit][best[at]].sum()) if len(at) else 0)
                rest.append(keys[~hit])
                rest_times.append(times[~hit])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, pa.list_(pa.int64())), pa.array(rest_times, pa.list_(pa.int64()))], names=["part", "nth", "n_best", "count_sum", "rest", "times"])

    looked = links.select("part", "nth", "pairs", "times").mapInArrow(run, "part int, nth long, n_best long, count_sum long, rest array<long>, times array<long>")
    looked = materialize(looked, "links-counted")
    others = looked.filter(F.size("rest") > 0).select("part", "nth", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("part", "nth", F.col("x.rest").alias("pair"), F.col("x.times").alias("times"))
    others = others.join(rare, "pair").select("part", "nth", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    sums = looked.select("part", "nth", "n_best", "count_sum").unionByName(others).groupBy("part", "nth").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    heads = links.filter(F.col("n_a").isNotNull()).select("key", "part", "nth", "n_a", "n_b", "n_groups", "n_links", F.col("spelled").alias("groups_sha256" if digest else "groups"))
    out = materialize(heads.join(sums, ["part", "nth"]).drop("part", "nth").withColumnRenamed("key", key), "aligned")
    discard(links, plain, counts, looked)
    return out
