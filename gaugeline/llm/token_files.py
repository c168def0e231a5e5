"""Token ids in binary files: canonical, length-limited Huffman codes of global counts.

A corpus is written as a folder of files that hold the ids of its documents in ascending
order of their keys, every document followed by an end id. The ids are coded with
one code book, made from the counts of all ids by package-merge, so that no code
is longer than a limit and a table of that many bits decodes an id in one look.

A file (all numbers little-endian)::

    "GTOK0001"
    blocks    each: bit offsets of every LANE-th id as uint32, then the codes, most significant bit first
    footer    zlib of: code lengths by id as uint8, then for each block (byte offset, bytes, first id, ids, crc32) as int64
    trailer   number of code lengths, of blocks, of ids, bytes of the footer as int64, "GTOK0001"

Blocks are independent of each other: a reader takes the footer and the blocks that it needs. Within a
block all lanes are decoded together, one id of each lane at a time, from their own bit offsets.

Beside ``data/`` lie two Parquet tables: ``docs`` (key, file, position in the file, ids) and ``files`` (file,
position of its first id in the corpus, ids). A file is named anew by every attempt of a task and counts only
if ``docs`` names it, so lost executors and repeated tasks leave nothing wrong behind. Files
are opened by pyarrow, so the folder is one that pyarrow and Spark both reach.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import array_blocks, discard, materialize, named
from .token_counts import byte_alphabet

MAGIC = b"GTOK0001"
BLOCK = 1 << 17
LANE = 256
#: Ids of a document that one row carries between the steps.
CHUNK = 1 << 15
BLOCK_CHARS = 1 << 22
#: Different words that are encoded at once, at most.
MEMO_WORDS = 400_000
KINDS = ("<u2", "<u4")
OUT_BYTES = 1 << 23


# --- encoding texts -------------------------------------------------------------------


class WordEncoder:
    """Ids of whole texts as the ``tokenizers`` library gives them; words that are equal within a call are encoded once.

    Only for files whose pieces never span white space: then a text's ids are those of its parts between blanks. Other
    files take the library for the whole text. Words of visible ASCII and Latin letters are run by tiktoken with the file's
    merges, where ids follow their order; all others by the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.by_word = drops_blanks(path)
        self.quick = QuickWords(path) if self.by_word else None

    def library_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        flat, size = [], []
        for at in range(0, len(texts), 1024):
            for e in self.library.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False):
                ids = e.ids
                flat.append(np.asarray(ids, np.uint32))
                size.append(len(ids))
        return np.concatenate([np.empty(0, np.uint32), *flat]), np.asarray(size, np.int64)

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words, where those of each begin and how many they are."""
        flat, starts, sizes, n = [], np.empty(len(words), np.int64), np.empty(len(words), np.int64), 0
        for at in range(0, len(words), MEMO_WORDS):
            own = words.slice(at, MEMO_WORDS)
            quick = self.quick.taken(own) if self.quick.ready else np.zeros(len(own), bool)
            for mask, run in ((quick, self.quick.ids), (~quick, lambda x: self.library_ids(x.to_pylist()))):
                ids, size = run(own.filter(pa.array(mask)))
                place = at + np.flatnonzero(mask)
                sizes[place], starts[place] = size, n + np.cumsum(size) - size
                flat.append(ids)
                n += len(ids)
        return np.concatenate(flat), starts, sizes

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """The ids of each text; null is empty. Arrow splits the texts and tells which words are equal."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return []
        if not self.by_word:
            flat, size = self.library_ids(texts.to_pylist())
            return np.split(flat, np.cumsum(size)[:-1])
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        parts = pc.split_pattern(texts, " ")
        coded = parts.flatten().dictionary_encode()
        words, nth = coded.dictionary, coded.indices.to_numpy()
        flat, starts, sizes = self.word_ids(words)
        size = sizes[nth]
        ends = np.cumsum(size)
        ids = flat[np.repeat(starts[nth] - (ends - size), size) + np.arange(ends[-1])]
        last = np.cumsum(pc.list_value_length(parts).to_numpy())[:-1]
        return np.split(ids, ends[last - 1])


class QuickWords:
    """Ids of plain words by tiktoken: the end of a piece is a zero byte, which belongs to the token before it.

    ``ready`` is false for files whose ids don't follow the order of their merges.
    """

    #: Visible ASCII and Latin letters that no normalization changes but for their case.
    TAKEN = r"^[\x21-\x7eÀ-ÖØ-öø-ÿ]+$"
    #: The pieces of such words in lower case.
    PIECE = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+)"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {ch: bytes([b]) for b, ch in byte_alphabet().items()}
        end = spec["model"].get("end_of_word_suffix") or ""
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in added:
                body, tail = (token[: -len(end)], b"\0") if end and token.endswith(end) else (token, b"")
                ranks[b"".join(map(back.__getitem__, body)) + tail] = i
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"].get("merges", ())]
        vocabulary = spec["model"]["vocab"]
        self.special = list(added)
        self.ready = bool(end) and len(ranks) == 512 + len(pairs) == len(vocabulary) - len(set(added) & set(vocabulary)) and all(vocabulary.get(a + b) == 512 + i for i, (a, b) in enumerate(pairs))
        if self.ready:
            import tiktoken

            self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
            self.ends = np.zeros(max(ranks.values()) + 1, bool)
            self.ends[[i for t, i in ranks.items() if t.endswith(b"\0")]] = True

    def taken(self, words: pa.Array) -> np.ndarray:
        """Which of the words tiktoken can encode."""
        plain = pc.match_substring_regex(words, self.TAKEN)
        for special in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, special))
        return plain.to_numpy(zero_copy_only=False)

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and how many each has."""
        if not len(words):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        ended = pc.replace_substring_regex(pc.utf8_lower(words), self.PIECE, "\\1\0")
        upto = np.cumsum(pc.count_substring(ended, "\0").to_numpy())  # pieces of each word and those before it
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(ended)], pa.int32()), ended), "")[0].as_py()
        ids = self.encoding.encode_to_numpy(whole, allowed_special=set(), disallowed_special=())
        until = np.flatnonzero(self.ends[ids])[upto - 1] + 1
        return ids, np.diff(until, prepend=0)


def drops_blanks(path: str) -> bool:
    """Whether the file splits at white space and drops it, so that no piece and no added token reaches over a blank."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [spec.get("pre_tokenizer") or {}])
    first = steps[0]
    regex = (first.get("pattern") or {}).get("Regex", "") if first.get("type") == "Split" else ""
    # the parts of the pattern that words of this kind of file consist of; none of them matches white space
    words = first.get("invert") and first.get("behavior") == "Removed" and set(regex.split("|")) <= {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d", r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"}
    normal = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    plain = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n.get("pattern") == {"Regex": r"\s+"} for n in normal.get("normalizers", [normal]))
    own = all(not (set(t["content"]) & set(" \t\r\n")) and not t["lstrip"] and not t["rstrip"] and not t["single_word"] and not t["normalized"] for t in spec["added_tokens"])
    added = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex", True) for s in steps[1:])
    return bool(words and plain and own and added and spec["model"].get("type") == "BPE")


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# --- code book ------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of the best prefix code whose codes have at most ``limit`` bits (package-merge); 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} different ids have no code of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels = []  # for each level, from the longest codes on: whether the i-th cheapest item is a leaf
    packages = np.empty(0, np.int64)
    for _ in range(limit):
        items = np.concatenate((leaves, packages))
        by_cost = np.argsort(items, kind="stable")
        levels.append(by_cost < n)
        items = items[by_cost]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, depth = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        depth[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id): each is the one before plus one, shifted to its own length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    for length in np.unique(lengths[order]).tolist():
        own = order[lengths[order] == length]
        code <<= length - last
        codes[own] = code + np.arange(len(own))
        code, last = code + len(own), length
    return codes


class Codebook:
    """Encodes ids with given code lengths and decodes them with a table of the longest code's bits."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.codes = canonical_codes(lengths)
        self.bits = int(lengths.max(initial=0))
        self._table: tuple[np.ndarray, np.ndarray] | None = None

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """For each value of the next ``bits`` bits the id that they begin with and its length; 0 where no code fits."""
        if self._table is None:
            ids, sizes = np.zeros(1 << self.bits, np.uint32), np.zeros(1 << self.bits, np.int64)
            used = np.flatnonzero(self.lengths)
            used = used[np.lexsort((used, self.lengths[used]))]
            width = np.left_shift(1, self.bits - self.lengths[used].astype(np.int64))
            end = int(width.sum())
            ids[:end], sizes[:end] = np.repeat(used, width), np.repeat(self.lengths[used], width)
            self._table = ids, sizes
        return self._table

    def encode(self, ids: np.ndarray) -> bytes:
        """One block: the bit offsets of its lanes and its codes."""
        size = self.lengths[ids].astype(np.int64)
        if not size.all():
            raise ValueError("an id has no code in this code book")
        ends = np.cumsum(size)
        starts = ends - size
        # each code within the 64 bits from the word of 32 bits on in which it begins; a code begins in every word
        placed = self.codes[ids].astype(np.uint64) << (64 - (starts & 31) - size).astype(np.uint64)
        first = np.flatnonzero(np.diff(starts >> 5, prepend=-1))
        both = np.bitwise_or.reduceat(placed, first) if len(first) else placed
        words = np.zeros(len(both) + 1, np.uint64)
        words[:-1] = both >> np.uint64(32)
        words[1:] |= both & np.uint64(0xFFFFFFFF)
        codes = words.astype(">u4").tobytes()[: -(-int(size.sum()) // 8)]
        return starts[::LANE].astype("<u4").tobytes() + codes

    def decode(self, data: bytes, n: int) -> np.ndarray:
        """The ``n`` ids of a block, all its lanes together."""
        lanes = -(-n // LANE)
        at = np.frombuffer(data, "<u4", lanes).astype(np.int64)
        raw = np.frombuffer(data, np.uint8, offset=4 * lanes)
        raw = np.concatenate((raw, np.zeros(8, np.uint8))).astype(np.uint64)
        # the 32 bits that begin at each byte, so that a look needs no loop over bytes
        words = raw[:-4] << np.uint64(32) | raw[1:-3] << np.uint64(24) | raw[2:-2] << np.uint64(16) | raw[3:-1] << np.uint64(8) | raw[4:]
        ids, sizes = self.table()
        out = np.zeros((LANE, lanes), np.uint32)
        steps, last = min(n, LANE), n - (lanes - 1) * LANE
        down, mask, end = np.uint64(40 - self.bits), np.uint64((1 << self.bits) - 1), (len(raw) - 8) * 8
        if at.max(initial=0) > end:
            raise ValueError("damaged block: a lane begins behind its end")
        for i in range(steps):
            if i == last:  # the last lane is shorter
                at = at[:-1]
            look = (words[at >> 3] >> (down - (at & 7).astype(np.uint64)) & mask).astype(np.int64)
            out[i, : len(at)] = ids[look]
            size = sizes[look]
            at = at + size
            if not size.all() or at.max(initial=0) > end:
                raise ValueError("damaged block: no code or no end")
        return out.T.reshape(-1)[:n]


# --- files ----------------------------------------------------------------------------


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system and path of an address."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


class FileWriter:
    """Writes ids in blocks; memory is one block."""

    def __init__(self, address: str, book: Codebook, block: int = BLOCK):
        store, path = opened(address)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(path)
        self.out.write(MAGIC)
        self.book, self.size, self.waiting, self.held, self.blocks, self.offset, self.total = book, block, [], 0, [], len(MAGIC), 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.size:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // self.size * self.size
            for at in range(0, whole, self.size):
                self.block(ids[at : at + self.size])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def block(self, ids: np.ndarray) -> None:
        data = self.book.encode(ids)
        self.out.write(data)
        self.blocks.append((self.offset, len(data), self.total, len(ids), zlib.crc32(data)))
        self.offset += len(data)
        self.total += len(ids)

    def close(self) -> None:
        if self.held:
            self.block(np.concatenate(self.waiting))
        footer = zlib.compress(self.book.lengths.tobytes() + np.array(self.blocks, "<i8").tobytes())
        self.out.write(footer + np.array([len(self.book.lengths), len(self.blocks), self.total, len(footer)], "<i8").tobytes() + MAGIC)
        self.out.close()


class FileReader:
    """Reads ranges of ids of one file; the last block is kept."""

    def __init__(self, address: str, books: dict[bytes, Codebook]):
        store, path = opened(address)
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(32 + len(MAGIC), size - 32 - len(MAGIC))
        if tail[32:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{address} is no whole token file")
        n_lengths, n_blocks, self.total, n_footer = np.frombuffer(tail[:32], "<i8").tolist()
        footer = zlib.decompress(self.file.read_at(n_footer, size - 32 - len(MAGIC) - n_footer))
        self.index = np.frombuffer(footer, "<i8", n_blocks * 5, n_lengths).reshape(n_blocks, 5)
        lengths = footer[:n_lengths]
        if lengths not in books:
            books.clear()
            books[lengths] = Codebook(np.frombuffer(lengths, np.uint8))
        self.book, self.address, self.kept = books[lengths], address, (-1, np.empty(0, np.uint32))

    def block(self, i: int) -> np.ndarray:
        if self.kept[0] != i:
            offset, size, _, n, crc = self.index[i].tolist()
            data = self.file.read_at(size, offset)
            if zlib.crc32(data) != crc:
                raise ValueError(f"block {i} of {self.address} is damaged")
            self.kept = i, self.book.decode(data, n)
        return self.kept[1]

    def read(self, start: int, n: int) -> np.ndarray:
        """The ids from ``start`` on, from the blocks that hold them."""
        if n == 0:
            return np.empty(0, np.uint32)
        first = self.index[:, 2]
        a, b = np.searchsorted(first, [start, start + n - 1], side="right") - 1
        parts = [self.block(i)[max(0, start - first[i]) : start + n - first[i]] for i in range(a, b + 1)]
        return np.concatenate(parts)

    def close(self) -> None:
        self.file.close()


# --- Spark jobs -----------------------------------------------------------------------


def encoded(df: DataFrame, tokenizer_path: str, end_id: int, key: str, text: str) -> DataFrame:
    """Rows of at most CHUNK ids with the key, a hash of the text and the place of their row in its task. Ids take two bytes each where all of a row do (``wide`` is false), else four."""
    kind = df.select(named(key)).schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, nth = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        names = ["key", "tie", "part", "nth", "chunk", "wide", "ids"]
        for batch in batches:
            done = 0
            for texts in array_blocks(batch.column(2), BLOCK_CHARS):
                row, place, chunk, wide, ids = [], [], [], [], []
                for i, found in enumerate(own.encode(texts)):
                    found = np.concatenate((found, end))
                    for at in range(0, len(found), CHUNK):
                        row.append(done + i)
                        place.append(nth)
                        chunk.append(at // CHUNK)
                        cut = found[at : at + CHUNK]
                        wide.append(bool(cut.max() > 0xFFFF))
                        ids.append(cut.astype(KINDS[wide[-1]]).tobytes())
                    nth += 1
                done += len(texts)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array([part] * len(row), pa.int32()), pa.array(place, pa.int64()), pa.array(chunk, pa.int32()), pa.array(wide, pa.bool_()), pa.array(ids, pa.binary())], names=names)

    rows = df.select(named(key).alias("key"), F.xxhash64(named(text)).alias("tie"), named(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind.simpleString()}, tie long, part int, nth long, chunk int, wide boolean, ids binary")


def count_ids(rows: DataFrame) -> DataFrame:
    """How often each id occurs: id, n. Tasks add up their own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for wide, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.bincount(np.frombuffer(ids.as_buffer(), KINDS[wide]))
                if len(own) > len(total):
                    total = np.concatenate((total, np.zeros(len(own) - len(total), np.int64)))
                total[: len(own)] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return rows.select("wide", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text", tokens_per_file: int = 1 << 25) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending order of ``key`` to the new folder ``path``.

    Null keys come first; rows of one key are ordered by a hash of their text, and repeated rows are all written. Null and
    empty texts are the end id alone. An empty table gives a folder without data files. Other columns are not
    carried. Texts of any length are encoded whole; between the steps their ids move in bounded rows, and a
    document lies in one file. The driver sees the counts of the ids, as many numbers as the
    vocabulary has entries; everything else stays in the tasks. Files hold about ``tokens_per_file`` ids.
    """
    spark = df.sparkSession
    rows = materialize(encoded(df, tokenizer_path, end_id, key, text), "token-ids")
    counts = count_ids(rows).toPandas()  # a row for each id of the vocabulary at most
    total = int(counts["n"].sum())
    by_id = np.zeros(int(counts["id"].max()) + 1 if total else 0, np.int64)
    by_id[counts["id"].to_numpy()] = counts["n"].to_numpy()
    limit = max(15, len(counts).bit_length() + 1)
    lengths = code_lengths(by_id, limit)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"data/{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}.gtok"
        out = None
        open_doc: tuple[pa.Scalar, int, int] | None = None  # key, first id, ids so far

        def docs(done: list) -> pa.RecordBatch:
            keys, start, n = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([k.as_py() for k in keys], keys[0].type), pa.array([name] * len(done)), pa.array(start, pa.int64()), pa.array(n, pa.int64())], names=["key", "file", "at", "n_tokens"])

        at = 0
        for batch in batches:
            out = out or FileWriter(f"{path}/{name}", Codebook(lengths), BLOCK)
            done = []
            for key_, chunk, wide, raw in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                ids = np.frombuffer(raw.as_buffer(), KINDS[wide])
                if chunk == 0:
                    if open_doc:
                        done.append(open_doc)
                    open_doc = key_, at, 0
                out.add(ids.astype(np.uint32))
                at += len(ids)
                open_doc = *open_doc[:2], open_doc[2] + len(ids)
            if done:
                yield docs(done)
        if out:
            out.close()
            yield docs([open_doc])

    dealt = ["key", "tie", "part", "nth"]
    order = [F.col("key").asc_nulls_first(), *dealt[1:]]
    parts = max(1, -(-total // tokens_per_file))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "chunk").select("key", "chunk", "wide", "ids")
    placed.mapInArrow(run, f"key {kind}, file string, at long, n_tokens long").write.parquet(f"{path}/docs")
    docs = spark.read.parquet(f"{path}/docs")
    before = F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    # a row for each file; names of files sort like the ranges of keys that they hold
    files = docs.groupBy("file").agg(F.sum("n_tokens").alias("n_tokens"))
    files.select("file", F.coalesce(before, F.lit(0)).alias("first"), "n_tokens").write.parquet(f"{path}/files")
    discard(rows)


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", where: str | None = None) -> DataFrame:
    """The documents of a folder that ``write_tokens`` wrote, decoded from its files.

    Result: ``key``, ``start`` (ids of all documents before it), ``n_tokens`` (with the end id) and
    ``ids`` (binary, little-endian unsigned 32-bit). ``where`` is a condition on ``key``, ``n_tokens``, ``file`` and
    ``at`` of the table of documents; only the blocks of the documents that meet it are read. A file or
    block that is damaged or cut off is an error. No rows are moved to decode them.
    """
    docs = spark.read.parquet(f"{path}/docs")
    schema = f"key {docs.schema['key'].dataType.simpleString()}, file string, at long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[bytes, Codebook] = {}
        own: FileReader | None = None
        try:
            for batch in batches:
                names, at, n = (batch.column(i).to_pylist() for i in (1, 2, 3))
                a = 0
                while a < len(names):
                    b, size, ids = a, 0, []
                    while b < len(names) and (b == a or size + 4 * n[b] <= OUT_BYTES):
                        if own is None or own.name != names[b]:
                            if own:
                                own.close()
                            own = FileReader(f"{path}/{names[b]}", books)
                            own.name = names[b]
                        ids.append(own.read(at[b], n[b]).astype("<u4").tobytes())
                        size += 4 * n[b]
                        b += 1
                    yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(ids, pa.binary())], names=["key", "file", "at", "n_tokens", "ids"])
                    a = b
        finally:
            if own:
                own.close()

    if where:
        docs = docs.filter(where)
    found = docs.select("key", "file", "at", "n_tokens").mapInArrow(run, schema)
    files = spark.read.parquet(f"{path}/files").select("file", "first")
    return found.join(files, "file").select(F.col("key").alias(key), (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids")
