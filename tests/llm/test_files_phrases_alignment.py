import hashlib
import heapq
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gaugeline.llm import alignment, phrases, token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["'", "'s", "'RE", "l", " ", "  ", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "a", "É", "é", "5", "²", "!", "<|endoftext|>", "<|startoftext|>", "<|endoft", "日本", "😀", "\x00", "Ⅷ", "The", "ing", "İ", "ß", "ΟΣ", "̈", "Å", "▁", "<0x41>"]


def strange_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


# --- token files ----------------------------------------------------------------------


def test_memo_of_words_gives_the_ids_of_the_library(monkeypatch):
    library = Tokenizer.from_file(WORDS)
    texts = [*strange_texts(3000, 1), "a" * 500, "word " * 300, "日本語" * 100, ""]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    own = token_files.WordEncoder(WORDS)
    assert own.by_word
    assert [x.tolist() for x in own.encode(texts)] == want
    monkeypatch.setattr(token_files, "MEMO_WORDS", 10)
    assert [x.tolist() for t in texts[:200] for x in own.encode([t])] == want[:200]


def test_files_with_pieces_over_blanks_take_the_library():
    library = Tokenizer.from_file(BYTES)
    own = token_files.WordEncoder(BYTES)
    assert not own.by_word
    texts = strange_texts(50, 2)
    assert [x.tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def huffman_cost(counts):
    heap, cost = sorted(counts), 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


def best_limited_cost(counts, limit):
    """Least cost over all lengths that a prefix code may have (Kraft's sum at most 1), by trying."""
    counts = sorted(counts, reverse=True)
    best = None

    def put(i, low, room, cost):
        nonlocal best
        if best is not None and cost >= best:
            return
        if i == len(counts):
            best = cost
            return
        for length in range(low, limit + 1):
            part = 1 << (limit - length)
            if part * (len(counts) - i) >= 0 and part <= room:
                put(i + 1, length, room - part, cost + counts[i] * length)

    put(0, 1, 1 << limit, 0)
    return best


def test_code_lengths_are_the_best_within_the_limit():
    rng = np.random.default_rng(0)
    for _ in range(60):
        counts = rng.integers(1, 1000, rng.integers(2, 8)) ** 2
        for limit in (3, 4, 16):
            lengths = token_files.code_lengths(counts, limit).astype(int)
            assert lengths.max() <= limit and sum(2.0**-n for n in lengths) <= 1
            want = huffman_cost(counts.tolist()) if limit == 16 else best_limited_cost(counts.tolist(), limit)
            assert int((lengths * counts).sum()) == want
    assert token_files.code_lengths(np.array([0, 5, 0]), 15).tolist() == [0, 1, 0]
    assert token_files.code_lengths(np.zeros(4, int), 15).tolist() == [0] * 4
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9, int), 3)


def test_codes_are_canonical_and_prefix_free():
    rng = np.random.default_rng(1)
    counts = (rng.pareto(0.5, 500) * 10).astype(np.int64)
    lengths = token_files.code_lengths(counts, 12)
    codes = token_files.canonical_codes(lengths)
    words = sorted((format(codes[i], f"0{lengths[i]}b"), i) for i in np.flatnonzero(lengths))
    assert all(not b[0].startswith(a[0]) for a, b in zip(words, words[1:], strict=False))
    assert [i for _, i in words] == sorted((int(i) for i in np.flatnonzero(lengths)), key=lambda i: (lengths[i], i))


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 5000, 70_000])
def test_blocks_come_back(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.pareto(0.4, n) * 3, 40_000).astype(np.uint32)
    book = token_files.Codebook(token_files.code_lengths(np.bincount(ids), 17))
    data = book.encode(ids)
    assert (book.decode(data, n) == ids).all()
    with pytest.raises(ValueError):
        book.decode(data[: 4 * -(-n // token_files.LANE)], n)


def test_each_different_word_is_encoded_once(monkeypatch):
    """Texts come as Arrow gives them; of 6,000 words 4 are encoded."""
    library = Tokenizer.from_file(WORDS)
    own = token_files.WordEncoder(WORDS)
    seen = []
    monkeypatch.setattr(own.quick, "ids", lambda words, run=own.quick.ids: (seen.append(len(words)), run(words))[1])
    texts = ["Don't stop", "x", None, *["Don't stop\nSTRAßE 日本 42nd"] * 1500, ""]
    found = own.encode(pa.array(texts).slice(1))
    assert [x.tolist() for x in found] == [library.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]
    assert 0 < sum(seen) <= 5


@pytest.mark.parametrize("limit", [9, 15, 17, 32])
def test_codes_are_packed_as_written(limit):
    rng = np.random.default_rng(limit)
    counts = 2 ** np.minimum(np.arange(400), 40) if limit == 32 else rng.integers(1, 1000, 400)
    book = token_files.Codebook(token_files.code_lengths(counts, limit))
    for n in (0, 1, 3, 31, 700):
        ids = rng.integers(0, 400, n)
        bits = "".join(format(book.codes[i], f"0{book.lengths[i]}b") for i in ids)
        starts = np.cumsum([0, *book.lengths[ids].tolist()])[: -1 if n else 0][:: token_files.LANE]
        packed = bytes(int(bits[at : at + 8].ljust(8, "0"), 2) for at in range(0, len(bits), 8))
        assert book.encode(ids) == starts.astype("<u4").tobytes() + packed


def test_packing_holds_no_row_for_each_bit():
    n = 1 << 16
    ids = np.random.default_rng(0).integers(0, 1 << 14, n)
    book = token_files.Codebook(token_files.code_lengths(np.ones(1 << 14, np.int64), 17))
    tracemalloc.start()
    book.encode(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 * n


def plain_files(rows, end_id):
    """Ids in order of keys (nulls first); rows of one key in any order."""
    library = Tokenizer.from_file(WORDS)
    docs = sorted(((k is not None, k or 0), [*library.encode(t or "", add_special_tokens=False).ids, end_id]) for k, t in rows)
    return [k[1] if k[0] else None for k, _ in docs], [i for _, i in docs]


@pytest.mark.parametrize("per_file", [50, 2000, 10**9])
def test_written_files_hold_every_document_in_order(spark, tmp_path, monkeypatch, per_file):
    for name, value in (("BLOCK", 700), ("CHUNK", 90), ("OUT_BYTES", 500)):
        monkeypatch.setattr(token_files, name, value)
    texts = [*strange_texts(150, 3), "long words " * 2000, "", None]
    rows = [((i * 37) % len(texts) - 5, t) for i, t in enumerate(texts)] + [(None, "no key"), (7, "tie b"), (7, "tie a"), (7, "tie a")]
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in rows], "doc_id long, text string, ids string, file string").repartition(5)
    path = f"file://{tmp_path}/tokens"
    token_files.write_tokens(df, path, WORDS, 2, tokens_per_file=per_file)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    keys, want = plain_files(rows, 2)
    assert [r.doc_id for r in got] == keys
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]]).tolist()[:-1]
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in got]
    assert sorted(zip(map(str, keys), map(tuple, ids), strict=True)) == sorted(zip(map(str, keys), map(tuple, want), strict=True))
    assert all(len(i) == r.n_tokens and i[-1] == 2 for i, r in zip(ids, got, strict=True))
    some = token_files.read_tokens(spark, path, where="key between 3 and 6 and n_tokens > 1").collect()
    assert sorted(map(str, some)) == sorted(str(r) for r in got if r.doc_id is not None and 3 <= r.doc_id <= 6 and r.n_tokens > 1)
    # whole files, without the tables
    whole = []
    for p in sorted((tmp_path / "tokens" / "data").glob("*.gtok")):
        own = token_files.FileReader(str(p), {})
        whole += own.read(0, own.total).tolist()
        own.close()
    assert whole == [i for d in ids for i in d]


def test_damage_is_an_error(spark, tmp_path):
    path = f"file://{tmp_path}/tokens"
    df = spark.createDataFrame([(i, f"some words {i}") for i in range(50)], "doc_id long, text string")
    token_files.write_tokens(df, path, WORDS, 2)
    (file,) = (tmp_path / "tokens" / "data").glob("*.gtok")
    data = bytearray(file.read_bytes())
    data[40] ^= 1
    file.write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        token_files.read_tokens(spark, path).collect()
    file.write_bytes(data[:-5])
    with pytest.raises(Exception, match="no whole token file"):
        token_files.read_tokens(spark, path).collect()


def test_an_empty_table_gives_no_files(spark, tmp_path):
    path = f"file://{tmp_path}/tokens"
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, WORDS, 2)
    assert token_files.read_tokens(spark, path).count() == 0
    assert not list(tmp_path.glob("tokens/data/*"))


# --- phrases --------------------------------------------------------------------------


def plain_phrases(rows, max_words, least, first, covered):
    counts = {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for mark in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(mark, "\n")
        for piece in text.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            own = counts.setdefault(lang, Counter())
            own.update(tuple(w[i : i + n]) for n in range(1, max_words + 1) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        dropped = {long[i : i + s] for long, c in cand.items() for s in range(2, len(long)) for i in range(len(long) - s + 1) if 100 * c >= covered * cand[long[i : i + s]]}
        kept = []
        for g, a in cand.items():
            if g not in dropped:
                score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                kept.append((-score, -a, " ".join(g).encode(), a, f[g[:k]], f[g[k:]], n, score))
        out += [(lang, i, x[2].decode(), *x[3:]) for i, x in enumerate(sorted(kept)[:first], 1)]
    return sorted(out)


def some_rows(seed, n=300):
    rnd = random.Random(seed)
    words = ["a", "b", "New", "york", "É", "é", "city", "\x0b", "x.y", "of", "_", "日本", "İ"]
    return [(rnd.choice(["en", "de", None, "und"]), "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", "\n"]) for _ in range(rnd.randint(0, 30)))) for _ in range(n)] + [("en", None), ("en", ""), (None, "new york city of new york"), ("fr", ". . ,")] * 3


@pytest.mark.parametrize(("max_words", "least", "first", "covered"), [(5, 3, 2000, 100), (3, 2, 7, 60), (2, 1, 50, 100), (5, 4, 30, 1)])
def test_phrases_equal_a_plain_version(spark, monkeypatch, max_words, least, first, covered):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(phrases, "WINDOW", 57)
    rows = some_rows(max_words * 10 + least)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(3)
    got = phrases.collocations(df, max_words, least, first, covered)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, max_words, least, first, covered)


@pytest.mark.parametrize("bits", [6, 12])
def test_a_full_field_changes_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(phrases, "FIELD_BITS", bits)
    rows = some_rows(5)
    df = spark.createDataFrame(rows, "lang string, text string")
    field = phrases.Field(np.full(1 << (bits - 6), 2**64 - 1, np.uint64))
    if bits == 6:
        monkeypatch.setattr(phrases, "field_of", lambda parts: field)
    assert sorted(map(tuple, phrases.collocations(df, 4, 3).collect())) == plain_phrases(rows, 4, 3, 2000, 100)


def test_hashes_of_phrases_are_those_of_their_ngrams(spark):
    df = spark.createDataFrame([("en", "a b c a b"), ("de", "a b É")], "lang string, text string")
    for n in (1, 2, 3):
        plain = phrases.ngrams(df, range(n, n + 1), {})
        want = {r.h for r in phrases.hashed(plain).collect()}
        assert {r.h for r in phrases.ngrams(df, range(n, n + 1), {}, as_hashes=True).collect()} == want and len(want) == plain.count()


def test_scores_are_exact_beyond_64_bits(spark):
    cases = [(10**15 - 1, 10**15 + 7, 3, 7), (10**12 + 1, 10**13 + 3, 10**12 + 1, 10**13 - 1), (999_999_999_999, 10**15, 10**12, 10**13), (2**53 + 1, 10**12, 2**53 + 1, 1000)]
    df = spark.createDataFrame(cases, "a long, n long, l long, r long")
    got = df.select(phrases.cut_score("a", "n", "l", "r")).collect()
    want = [1000 * a * n // (left * r) for a, n, left, r in cases]
    assert [x[0] for x, w in zip(got, want, strict=True) if w < 2**63] == [w for w in want if w < 2**63]


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


# --- alignment ------------------------------------------------------------------------


def plain_alignment(texts):
    a_lib, b_lib = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_lib.encode_special_tokens = True
    back = {ch: b for b, ch in alignment.byte_alphabet().items()}
    docs, counts = [], Counter()
    for text in texts:
        groups, want = [], (" " + (text or "")).encode()
        if text:
            a = a_lib.encode(" " + text, add_special_tokens=False).ids
            b = b_lib.encode(text)
            bytes_a = [bytes(back[ch] for ch in a_lib.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_lib.id_to_piece(i)) for i in b)]
            if b"".join(bytes_a) == want == b"".join(bytes_b):
                ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
                i = j = 0
                for cut in sorted(set(ends_a) & set(ends_b)):
                    own_a = [a[x] for x in range(i, len(a)) if ends_a[x] <= cut]
                    own_b = [b[x] for x in range(j, len(b)) if ends_b[x] <= cut]
                    i, j = i + len(own_a), j + len(own_b)
                    groups.append((own_a, own_b))
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        counts.update(set(links))
        docs.append((groups, links))
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for groups, links in docs:
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == most[p[0]] for p in links)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), best, sum(counts[p] for p in links), spelled))
    return out


@pytest.mark.parametrize(("frequent", "row_pairs", "held"), [(1 << 20, 1 << 16, 1 << 21), (20, 5, 30), (0, 3, 4)])
def test_alignment_equals_a_plain_version(spark, monkeypatch, frequent, row_pairs, held):
    for name, value in (("FREQUENT", frequent), ("ROW_PAIRS", row_pairs), ("HELD_PAIRS", held)):
        monkeypatch.setattr(alignment, name, value)
    texts = [*strange_texts(200, 4), "Plain words, and tokenization of unbelievable lengths. " * 3, "=" * 301, "ab" * 400, "über größere Wörter", "a  b", " x", "", None]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 2), (None, "no key", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int").repartition(4)
    got = alignment.align(df, BYTES, PIECES).collect()
    want = [(r[0], *x) for r, x in zip(rows, plain_alignment([r[1] for r in rows]), strict=True)]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got))) == sorted(map(str, want))
    hashed = {(r.doc_id, r.groups_sha256) for r in alignment.align(df, BYTES, PIECES, digest=True).collect()}
    assert hashed == {(w[0], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in want}


def test_groups_are_cut_where_both_sides_end():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = rng.integers(1, 5, rng.integers(1, 12)), rng.integers(1, 5, 40)
        ends = np.cumsum(b)
        b = np.append(b[ends < a.sum()], a.sum() - ends[ends < a.sum()].max(initial=0))
        at_a, at_b = alignment.groups(a, b)
        want = sorted(set(np.cumsum(a).tolist()) & set(np.cumsum(b).tolist()))
        assert (np.cumsum(a) - a)[at_a].tolist() == [0, *want[:-1]] == (np.cumsum(b) - b)[at_b].tolist()
        first, last = alignment.overlaps(a, b)
        ends_a, ends_b = np.cumsum(a), np.cumsum(b)
        for i in range(len(a)):
            over = [j for j in range(len(b)) if ends_b[j] - b[j] < ends_a[i] and ends_b[j] > ends_a[i] - a[i]]
            assert over == list(range(first[i], last[i] + 1))


def test_long_groups_cost_their_different_pairs():
    n = 200_000
    found = alignment.Alignment(np.arange(n) % 7, np.arange(n) % 5, np.array([0]), np.array([0]))
    keys, times = found.pairs()
    assert found.n_links == n * n and len(keys) == 35 and times.sum() == n * n


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES).count() == 0
