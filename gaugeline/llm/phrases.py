"""Phrase collocation mining: n-grams as rows, counts by hash aggregation, exact scores, maximal phrases.

Texts are cut at marks into pieces and these at blanks into words. The n-grams of 1 to
``max_words`` words become rows of a DataFrame and are counted per language by hash aggregation. Prefix and suffix
counts are joined to every cut of every candidate, scores are computed in Decimal, candidates that a one-word
extension covers are removed by an anti-join, and the best of each language are ranked by windows.

A phrase is never more frequent than its parts, so n-grams with a part that is too rare need no row. Three rounds tell:
words are counted first; then pairs of frequent words, as hashes (two hashes that collide only add up, so no frequent pair
is missed); then all phrases of two words or more whose pairs are frequent by their hashes, as texts. What is frequent is kept in a
bit field of fixed size (FIELD_BITS) that is sent to the tasks. A bit that is set by another
part only lets a row through that the aggregation then finds too rare. So the result is
the same whatever the field holds; on a corpus whose frequent parts fill it, all n-grams become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, named, slices

BLOCK_BYTES = 1 << 23
#: Words whose n-grams are counted together in a task.
WINDOW = 1 << 20
FIELD_BITS = 27
#: Rows of a language are ranked in so many parts first, so that no task orders all of its candidates.
RANK_PARTS = 64

# Kinds of bytes: part of a word, blank, mark. Marks end a piece. (Fixed values.)
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x09]] = 1
KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2

PHRASES, HASHES = "lang string, phrase string, n long", "h long, n long"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a block of texts, for each the number of its piece and of its text. Texts are no longer than 2 GB together."""
    texts = pc.ascii_lower(pc.fill_null(texts, ""))
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    total = int(sizes.sum())
    data = bytes_of(texts, total)
    kinds = KINDS[data]
    until = np.cumsum(sizes)
    new_text = np.zeros(total + 1, bool)
    new_text[until] = True
    inside = kinds == 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | new_text[1:-1]
    ends[:-1] &= ~inside[1:] | new_text[1:-1]
    starts = np.flatnonzero(begins)
    piece = np.searchsorted(np.flatnonzero((kinds == 2) | new_text[:-1]), starts, side="right")
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.flatnonzero(ends) + 1 - starts, out=offsets[1:])
    kept = data[inside].tobytes()
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(kept))
    return words, piece, np.searchsorted(until, starts, side="right")


def bytes_of(texts: pa.Array, total: int) -> np.ndarray:
    texts = texts if texts.offset == 0 else pa.concat_arrays([texts])
    first = np.frombuffer(texts.buffers()[1], np.int32, 1)[0] if len(texts) else 0
    return np.frombuffer(texts.buffers()[2], np.uint8, total, first) if total else np.empty(0, np.uint8)


def mixed(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A hash of a phrase and one more word."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + more
    return (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


class Field:
    """Which hashes may belong to a frequent part."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(64 * len(self.bits) - 1)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def hashed(phrases: DataFrame) -> DataFrame:
    """The hashes ``h`` of (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [digest([x.split(" ") for x in batch.column(1).to_pylist()], batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h).view(np.int64))], names=["h"])

    def digest(phrases: list[list[str]], langs: list[str]) -> np.ndarray:
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, langs), np.uint64, len(langs))
        for i in range(max(map(len, phrases), default=0)):
            some = np.array([len(p) > i for p in phrases])
            h[some] = mixed(h[some], np.fromiter((xxhash.xxh3_64_intdigest(p[i]) for p in phrases if len(p) > i), np.uint64, int(some.sum())))
        return h

    return phrases.select("lang", "phrase").mapInArrow(run, "h long")


def field_of(parts: DataFrame) -> Field:
    """The bit field of the hashes ``h``: its 64-bit words are put together by aggregation, at most 2 ** (FIELD_BITS - 6) rows reach the driver."""
    at = F.col("h").bitwiseAND(F.lit((1 << FIELD_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    rows = parts.groupBy(F.shiftright(at, 6).alias("i")).agg(F.bit_or(bit).alias("w")).toPandas()
    bits = np.zeros(1 << (FIELD_BITS - 6), np.uint64)
    bits[rows["i"].to_numpy(np.int64)] = rows["w"].to_numpy(np.int64).view(np.uint64)
    return Field(bits)


def ngrams(rows: DataFrame, sizes: range, fields: dict[int, Field], as_hashes: bool = False) -> DataFrame:
    """Rows of the n-grams of ``sizes`` words of (lang, text) as texts or as hashes, equal ones of a block added up.

    ``fields``: by number of words, the parts that may be frequent. An n-gram with a part of such a number of words
    that isn't among them has no row.
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast({n: f.bits for n, f in fields.items()})  # 2 ** (FIELD_BITS - 3) bytes each

    def count(words: pa.Array, piece: np.ndarray, lang: np.ndarray, langs: list[str], stop: int, known: dict[int, Field]) -> Iterator[pa.RecordBatch]:
        """N-grams that begin before ``stop``; the words after it only continue them."""
        coded = words.dictionary_encode()
        code, different = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        of_word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in different.to_pylist()), np.uint64, len(different))
        of_lang = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in langs), np.uint64, len(langs))
        h_word = of_word[code]
        base = max(len(different), 1)
        at = np.arange(stop)
        h, same, ends = mixed(of_lang[lang[:stop]], h_word[:stop]), lang[:stop] * base + code[:stop], at
        ok = known[1].has(mixed(of_lang[lang], h_word)) if 1 in known else None
        pair = None
        if 2 in known:
            h2 = mixed(mixed(of_lang[lang[:-1]], h_word[:-1]), h_word[1:])
            pair = known[2].has(h2)
        for n in range(1, sizes[-1] + 1):
            if n > 1:
                ends = at + (n - 1)
                fits = ends < len(code)
                fits[fits] = piece[ends[fits]] == piece[at[fits]]
                if ok is not None:
                    fits[fits] = ok[ends[fits]]
                    if n == 2:
                        fits[fits] = ok[at[fits]]
                if pair is not None:
                    fits[fits] = pair[ends[fits] - 1]
                at, same, h = at[fits], same[fits], h[fits]
                more = at + (n - 1)
                _, same = np.unique(same, return_inverse=True)
                same, h = same * base + code[more], mixed(h, h_word[more])
            if n in sizes and len(at) and as_hashes:
                own, times = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(times.astype(np.int64))], names=["h", "n"])
            elif n in sizes and len(at):
                _, first, times = np.unique(same, return_index=True, return_counts=True)
                heads = at[first]
                parts = [words.take(pa.array(heads + i)) for i in range(n)]
                phrase = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
                lang_of = pa.array(langs, pa.string()).take(pa.array(lang[heads]))
                yield pa.RecordBatch.from_arrays([lang_of, phrase, pa.array(times.astype(np.int64))], names=["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: Field(bits) for n, bits in shared.value.items()}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            langs, of_text = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            sizes_of = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for a, b in slices(sizes_of, BLOCK_BYTES):
                words, piece, owner = words_of(batch.column(1).slice(a, b - a))
                lang = of_text[a:b][owner]
                for start in range(0, len(words), WINDOW):
                    stop, last = min(start + WINDOW, len(words)), min(start + WINDOW + sizes[-1] - 1, len(words))
                    yield from count(words.slice(start, last - start), piece[start:last], lang[start:last], langs, stop - start, known)

    return rows.mapInArrow(run, HASHES if as_hashes else PHRASES)


def phrase_counts(df: DataFrame, max_words: int, least: int, text: str = "text", lang: str = "lang", unknown: str = "und") -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of 1 to ``max_words`` words that occur ``least`` times or more in their language, and the words of each language.

    First result: lang, phrase, n; second: lang, total.
    """
    rows = df.select(F.coalesce(named(lang).cast("string"), F.lit(unknown)).alias("lang"), named(text).alias("text"))
    n = F.sum("n").alias("n")
    single = materialize(ngrams(rows, range(1, 2), {}).groupBy("lang", "phrase").agg(n), "phrase-words")
    totals = materialize(single.groupBy("lang").agg(F.sum("n").alias("total")), "phrase-totals")
    words = materialize(single.filter(F.col("n") >= least), "phrase-frequent")
    discard(single)
    # hashes of frequent pairs: as numbers they move in less than half the bytes of their texts
    pairs = ngrams(rows, range(2, 3), {1: field_of(hashed(words))}, as_hashes=True).groupBy("h").agg(n).filter(F.col("n") >= least)
    longer = ngrams(rows, range(2, max_words + 1), {2: field_of(pairs)}).groupBy("lang", "phrase").agg(n).filter(F.col("n") >= least)
    counts = materialize(words.unionByName(longer), "phrase-counts")
    discard(words)
    return counts, totals


def cut_score(a: str, n: str, left: str, right: str) -> Column:
    """``floor(1000 * a * n / (left * right))`` in Decimal: products of counts below 10 ** 16, a whole quotient."""
    return F.expr(f"(cast({a} as decimal(16,0)) * cast(1000 as decimal(4,0)) * cast({n} as decimal(16,0))) div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))")


def collocations(df: DataFrame, max_words: int = 5, least: int = 100, first: int = 2000, covered: int = 100, text: str = "text", lang: str = "lang", unknown: str = "und") -> DataFrame:
    """The ``first`` best collocations of each language.

    Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and at blanks and tabs into words. A
    candidate is a phrase of 2 to ``max_words`` words of one piece with ``a >= least`` occurrences in its language.
    Its score is the least, over all cuts into two parts with ``l`` and ``r`` occurrences, of ``floor(1000 * a * n / (l * r))``
    with ``n`` words in the language; the first such cut counts. Candidates that lie in a longer one with at least
    ``covered`` percent of their occurrences are dropped: since counts never grow with more words, one-word extensions
    tell. Products are Decimals of 38 digits and quotients whole numbers, so nothing is rounded.

    Result: lang, rank (by score and a descending, then phrase by its bytes), phrase, a, l, r, n, score.
    A null language is ``unknown``; null and empty texts have no words; repeated rows count as often as they
    are there; texts of any length are read whole (one text has less than 2 GB). An empty table gives an empty result.
    Other columns are not carried.
    """
    if max_words < 2 or least < 1:
        raise ValueError("phrases have two words or more and occur at least once")
    counts, totals = phrase_counts(df, max_words, least, text, lang, unknown)
    candidates = counts.filter(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ", -1).alias("w"))

    def part(start: int | Column, size: Column) -> Column:
        return F.array_join(F.slice("w", start, size), " ")

    cut = F.explode(F.sequence(F.lit(1), F.size("w") - 1))
    cuts = candidates.select("lang", "phrase", "a", "w", cut.alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("left"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    of = counts.select("lang", "phrase", "n")
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(of.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals.withColumnRenamed("total", "n"), "lang")
    scored = cuts.select("lang", "phrase", "a", "n", F.struct(cut_score("a", "n", "l", "r").alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase").agg(F.min("cut").alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"))
    ends = F.explode(F.array(part(1, F.size("w") - 1), part(2, F.size("w") - 1)))
    inner = candidates.filter(F.size("w") > 2).select("lang", "a", ends.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    inner = inner.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of_phrase"), "longer")
    extended = (F.col("lang") == F.col("of_lang")) & (F.col("phrase") == F.col("of_phrase")) & (F.col("longer") * 100 >= F.col("a") * covered)
    whole = scored.join(inner, extended, "left_anti")
    best = materialize(whole.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")), "phrase-scores")
    discard(counts, totals)
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    place = F.row_number()
    some = best.withColumn("place", place.over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order))).filter(F.col("place") <= first)
    ranked = some.withColumn("rank", place.over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
