"""Near-duplicates by BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its five-word shingles. For each shingle, independent Poisson
processes run over the dyadic weight ranges (0, 1], (1, 2], (2, 4], ...; a shingle that
occurs ``n`` times uses the ranges up to ``n``, the last one thinned by the points'
weight marks. Every point falls into one register of the signature, which keeps its
earliest point, so two registers agree with the probability of the weighted Jaccard
similarity. Only points below a bound that fills all registers are made.

Exact copies (equal multisets) are one class from the start, and only classes are
compared. In every band bucket each class is compared with one pivot; after the
components of the verified links are known, the buckets that still hold
different components are compared across those, chunk against chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import give_back, materialize, named, slices, text_blocks
from .graph import components

SHINGLE = 5
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
BLOCK_CHARS, BLOCK_TEXTS, SEGMENT = 1 << 20, 4096, 1 << 19
DOC_BITS = 12
CHUNK, CHUNK_WORDS = 512, 1 << 19
#: Fixed odd multipliers (of SplitMix64, and one for polynomial hashes).
MIX_1, MIX_2, GOLDEN, BASE = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0x2545F4914F6CDD1D))


def mix(x: np.ndarray) -> np.ndarray:
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


INVERSE = pow(int(BASE), -1, 1 << 64)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_powers: list[np.ndarray] = []


def power_tables(n: int) -> list[np.ndarray]:
    """Powers of BASE and of its inverse; kept for parts of the usual size only."""
    if n > SEGMENT + 4096:
        return [powers(int(BASE), n), powers(INVERSE, n)]
    if not _powers:
        _powers[:] = [powers(int(BASE), SEGMENT + 4096), powers(INVERSE, SEGMENT + 4096)]
    return _powers


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of a text that begins and ends with white space, in parts of about SEGMENT bytes cut at white space."""
    starts, hashes, at = [], [], 0
    while at < len(data) - 1:
        end = min(len(data) - 1, at + SEGMENT)
        while not SPACES[data[end]]:
            blank = np.flatnonzero(SPACES[data[end : end + 4096]])
            end = end + int(blank[0]) if len(blank) else end + 4096
        part = data[at : end + 1]
        up, down = power_tables(len(part) + 1)
        blank = SPACES[part]
        start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        stop = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], dtype=np.uint64)))
        hashes.append(mix((sums[stop] - sums[start]) * down[start]))
        starts.append(start + at)
        at = end
    return np.concatenate(starts or [np.zeros(0, np.int64)]), np.concatenate(hashes or [np.zeros(0, np.uint64)])


def shingle_bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash of 52 bits, count) of at most BLOCK_TEXTS texts, sorted by the first two.

    Words are runs without ASCII white space, in lower case. A text of one to four words
    is a single shingle; a text without words has none.
    """
    raw = [(" " + t.lower() + " ").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    start, words = word_hashes(data)
    first = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    bounds = np.searchsorted(start, first)
    n_words = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), n_words)
    # a shingle starts at each word that has four more in its text, or at the first word of a short text
    left = np.repeat(bounds[1:], n_words) - np.arange(len(words))
    short = np.repeat(n_words < SHINGLE, n_words)
    is_first = np.arange(len(words)) == np.repeat(bounds[:-1], n_words)
    at = np.flatnonzero((left >= SHINGLE) | (short & is_first))
    h = np.zeros(len(at), np.uint64)
    padded = np.concatenate((words, np.zeros(SHINGLE, np.uint64)))
    for k in range(SHINGLE):
        part = padded[at + k]
        part = np.where(left[at] > k, part, np.uint64(0))
        h = mix(h * BASE + part)
    key = np.sort((owner[at] << np.uint64(64 - DOC_BITS)) | (h >> np.uint64(DOC_BITS)))
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    return (key[new] >> np.uint64(64 - DOC_BITS)).astype(np.int64), key[new] & np.uint64((1 << (64 - DOC_BITS)) - 1), count


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """Earliest points (n texts x registers); infinite for texts without shingles."""
    total = np.bincount(doc, weights=count, minlength=n)
    result = np.full((n, registers), np.inf)
    top = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)
    # one process for each shingle and dyadic range up to its count
    which = np.repeat(np.arange(len(doc)), top + 1)
    level = np.arange(len(which)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    span = np.where(level > 0, low, 1)
    of, seed = doc[which], mix(shingle[which] ^ (level.astype(np.uint64) << np.uint64(56)))
    need = (count[which] - low) / span  # marks up to this share belong to the count
    rate = registers * span.astype(float)
    with np.errstate(divide="ignore"):
        bound = (np.log(registers) + 3) / total
    todo = total > 0
    while todo.any():
        live = np.flatnonzero(todo[of])
        x, j = np.zeros(len(live)), 0
        flat = result.reshape(-1)
        while len(live):
            j += 1
            r = mix(seed[live] + np.uint64(j * int(BASE) & (1 << 64) - 1))
            x = x - np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate[live]
            ok = x <= bound[of[live]]
            live, x, r = live[ok], x[ok], mix(r[ok])
            hit = ((r >> np.uint64(32)).astype(float) * 2.0**-32) < need[live]
            spot = of[live[hit]] * registers + ((r[hit] & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(flat, spot, x[hit])
        done = result.max(axis=1) <= bound
        todo &= ~done
        bound = np.where(todo, bound * 1.6, bound)
    return result


def sketch(texts: list[str]) -> list[tuple]:
    """(class key 1, class key 2, shingles, bands, one byte of each register) of each text; nulls for texts without words."""
    doc, shingle, count = shingle_bags(texts)
    n = len(texts)
    sig = signatures(doc, shingle, count, n)
    bits = np.ascontiguousarray(sig).view(np.uint64)
    keys = np.zeros((2, n), np.uint64)
    for k in range(2):
        np.add.at(keys[k], doc, mix(mix(shingle + np.uint64(k)) ^ count.astype(np.uint64)))
    total = np.bincount(doc, weights=count, minlength=n).astype(np.int64)
    band = np.zeros((n, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        band = mix(band * BASE + bits[:, r::ROWS][:, :BANDS])
    small = (mix(bits) >> np.uint64(56)).astype(np.uint8)
    return [(int(a), int(b), int(t), list(map(int, row)), s.tobytes()) if t else (None, None, 0, [], b"") for a, b, t, row, s in zip(keys[0].view(np.int64), keys[1].view(np.int64), total, band.view(np.int64), small, strict=True)]


def add_sketch(df: DataFrame, text: str) -> DataFrame:
    @F.arrow_udf("struct<c1:long,c2:long,total:long,bands:array<long>,sig:binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("c1", pa.int64()), ("c2", pa.int64()), ("total", pa.int64()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])
        for batch in batches:
            rows = []
            for texts in text_blocks(batch, BLOCK_CHARS):
                for at in range(0, len(texts), BLOCK_TEXTS):
                    rows += sketch(texts[at : at + BLOCK_TEXTS])
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kind)], fields=list(kind))

    return df.withColumn("sketch", run(F.coalesce(F.col(text), F.lit("")))).select("*", "sketch.*").drop("sketch")


def overlaps(left: list[str], right: list[str]) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts: shared occurrences over all occurrences."""
    result = np.zeros(len(left))
    for lo, hi in slices([len(a) + len(b) for a, b in zip(left, right, strict=True)], BLOCK_CHARS // 2):
        for i in range(lo, hi, BLOCK_TEXTS // 2):
            j = min(i + BLOCK_TEXTS // 2, hi)
            m = j - i
            doc, shingle, count = shingle_bags(left[i:j] + right[i:j])
            pair = doc % m
            order = np.lexsort((shingle, pair))
            pair, shingle, count = pair[order], shingle[order], count[order]
            same = np.flatnonzero((pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1]))
            shared = np.bincount(pair[same], weights=np.minimum(count[same], count[same + 1]), minlength=m)
            everything = np.bincount(pair, weights=count, minlength=m)
            result[i:j] = shared / np.maximum(everything - shared, 1)
    return result


@F.arrow_udf(DoubleType())
def overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    sizes = sum(pc.fill_null(pc.binary_length(x), 0).to_numpy(zero_copy_only=False) for x in (left, right))
    parts = [overlaps(*([t or "" for t in x.slice(a, b - a).to_pylist()] for x in (left, right))) for a, b in slices(sizes.tolist(), BLOCK_CHARS)]
    give_back()
    return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())


@F.arrow_udf(DoubleType())
def agreement(left: pa.Array, right: pa.Array) -> pa.Array:
    """Share of equal registers."""
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, REGISTERS) for x in (left, right))
    return pa.array((a == b).mean(axis=1), pa.float64())


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, threshold: float, slack: float) -> DataFrame:
    """The pairs (a, b) of classes whose texts (uid, text) overlap by ``threshold`` or more.

    Pairs whose signatures agree by ``slack`` less than that (four standard errors) are
    not looked up; the others are joined with both texts and compared exactly.
    """
    sig = classes.select("uid", "sig")
    near = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
    near = materialize(near.filter(agreement("sig_a", "sig_b") >= threshold - slack).select("a", "b"), "near")
    both = near.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return materialize(both.filter(overlap("text_a", "text_b") >= threshold).select("a", "b"), "links")


def block_links(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links between different parts within buckets: members (band, n, words, uid, part) with their texts (uid, text).

    A bucket's members are dealt to chunks of about CHUNK texts and CHUNK_WORDS words, and each pair of chunks is compared
    exactly in one task that returns only links which join parts. So no pairs are emitted,
    and memory is bounded by two chunks whatever the size of the bucket.
    """
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("words") / CHUNK_WORDS)).cast("int")
    dealt = members.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("uid", "band"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.join(texts, "uid").withColumn("other", other)
    dealt = dealt.select("band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "uid", "part", "text")

    def compare(block: pa.Table) -> pa.Table:
        found = linked_parts(block["uid"].to_numpy(), block["part"].to_numpy(), [t or "" for t in block["text"].to_pylist()], threshold)
        give_back()
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt.groupBy("band", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def linked_parts(uid: np.ndarray, part: np.ndarray, texts: list[str], threshold: float) -> list[tuple[int, int]]:
    """Links of the threshold or more that join the parts of a block: a spanning forest of them."""
    order = np.argsort(uid, kind="stable")
    uid, part, texts = uid[order], part[order].copy(), [texts[i] for i in order]
    if len(set(part.tolist())) < 2:
        return []
    doc, feature = [], []
    for a, b in slices([max(len(t), BLOCK_CHARS // BLOCK_TEXTS) for t in texts], BLOCK_CHARS):
        d, s, c = shingle_bags(texts[a:b])
        # the n-th occurrence of a shingle is a feature of its own, so shared features count the multiset overlap
        level = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        doc.append(np.repeat(d + a, c))
        feature.append(mix(mix(np.repeat(s, c)) ^ level.astype(np.uint64)))
    doc, feature = np.concatenate(doc), np.concatenate(feature)
    n = len(texts)
    total = np.bincount(doc, minlength=n).astype(np.float32)
    _, column, times = np.unique(feature, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    doc, column = doc[shared], np.unique(column[shared], return_inverse=True)[1]
    sort = np.argsort(column, kind="stable")
    doc, column = doc[sort], column[sort]
    common = np.zeros((n, n), np.float32)
    for lo in range(0, int(column.max(initial=-1)) + 1, 4096):
        u, v = np.searchsorted(column, [lo, lo + 4096])
        piece = np.zeros((n, 4096), np.float32)
        piece[doc[u:v], column[u:v] - lo] = 1
        common += piece @ piece.T
    similarity = common / np.maximum(total[:, None] + total[None] - common, 1)
    a, b = np.nonzero(np.triu((similarity >= threshold - 1e-6) & (part[:, None] != part[None]), 1))
    found = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        both = total[x] + total[y] - common[x, y]
        if part[x] != part[y] and float(common[x, y]) >= threshold * float(both):
            found.append((int(uid[x]), int(uid[y])))
            part[part == part[y]] = part[x]
    return found


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, slack: float = 0.15, keep_columns: bool = False, class_col: str = "class_id", kept_col: str = "kept") -> DataFrame:
    """The class of every row: the smallest key among the rows that verified links connect.

    Result: ``key`` (under its own name) or, with ``keep_columns``, all columns of ``df`` but those named as
    results; and ``class_id``, ``kept``. ``kept`` is true for exactly one row of a class, one with the smallest key.
    Links join texts whose five-word multisets have a weighted Jaccard similarity of at
    least ``threshold``; pairs at the threshold share a band with probability 0.9999. Texts with
    equal multisets are one class whatever their number. Null texts and texts without words
    are linked with nothing: their class is their own key. Repeated rows form one class; null
    keys are treated as larger than others; an empty table gives an empty result.
    """
    shown = [c for c in df.columns if c not in (class_col, kept_col)] if keep_columns else [key]
    base = df.select(F.struct(*map(named, shown)).alias("row"), named(key).alias("key"), named(text).alias("text"), F.monotonically_increasing_id().alias("uid"))
    rows = add_sketch(base, "text")
    # kept columns hold the text already
    rows = materialize(rows.drop("text") if text in shown else rows, "sketches")
    whole = F.col("row").getField(text) if text in shown else F.col("text")
    one = F.struct(F.col("key").isNull().alias("late"), "key", "uid", "bands", "sig", "total")
    classes = rows.filter(F.col("total") > 0).groupBy("c1", "c2").agg(F.min(one).alias("one"))
    classes = materialize(classes.select("c1", "c2", "one.*"), "classes")

    spread = classes.select("uid", "total", F.explode("bands").alias("band"))
    buckets = spread.groupBy("band").agg(F.min("uid").alias("pivot"), F.count(F.lit(1)).alias("n"), F.sum("total").alias("words")).filter(F.col("n") > 1)
    members = materialize(spread.drop("total").join(buckets, "band"), "members")
    star = members.filter(F.col("uid") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("uid").alias("b")).distinct()
    # the only pass that moves whole texts: those of classes that share a bucket, a set that grows with the corpus
    asked = members.select("uid").distinct().hint("merge")
    texts = materialize(rows.select("uid", whole.alias("text")).join(asked, "uid", "left_semi"), "texts")
    links = verified(materialize(star, "pairs"), classes, texts, threshold, slack)
    parts = materialize(components(links), "parts")

    own = F.coalesce("c", F.col("uid")).alias("part")
    placed = materialize(members.join(parts.withColumnRenamed("v", "uid"), "uid", "left").select("band", "n", "words", "uid", own), "placed")
    # buckets of the same members (by two sums of hashes) need one comparison
    same = [F.sum(F.pmod(F.xxhash64(F.lit(k), "uid"), F.lit(1 << 40))).alias(f"s{k}") for k in (1, 2)]
    mixed = placed.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.first("n").alias("n"), *same).filter(F.col("lo") != F.col("hi"))
    mixed = mixed.groupBy("n", "s1", "s2").agg(F.min("band").alias("band")).select("band")
    rest = materialize(placed.join(mixed, "band"), "mixed")
    more = materialize(block_links(rest, texts, threshold), "links")
    if more.limit(1).count():
        parts = materialize(components(links.union(more)), "parts")

    grouped = materialize(classes.join(parts.withColumnRenamed("v", "uid"), "uid", "left").select("c1", "c2", own, F.struct("late", "key", "uid").alias("one")), "grouped")
    heads = grouped.groupBy("part").agg(F.min("one").alias("head"))
    heads = materialize(heads.select("part", F.col("head.key").alias("class_id"), F.col("head.uid").alias("head")), "heads")
    table = materialize(grouped.join(heads, "part").select("c1", "c2", "class_id", "head"), "class-table")
    out = rows.select("row", "key", "uid", "c1", "c2").join(table, ["c1", "c2"], "left")
    lone = F.col("head").isNull()
    return out.select("row.*", F.when(lone, F.col("key")).otherwise(F.col("class_id")).alias(class_col), (lone | (F.col("head") == F.col("uid"))).alias(kept_col))
