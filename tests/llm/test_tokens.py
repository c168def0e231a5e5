import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeline.llm import packing, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'", "'s", "'re", "'v", "l", "'ll", " ", "  ", "\n", "\t", " ", "　", "a", "é", "5", "²", "!", "<|endoftext|>", "<|endoft", "日本", "😀", "'d", "'t x", "\x00", "\x1c", " ", "Ⅷ", "the", "ing", " '", "''", "é", "İ", "ß"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def strange_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_counts_equal_the_library(library):
    texts = [*strange_texts(3000, 1), "a" * 5000, " " * 5000, "ab" * 3000, "\n" * 999 + "x", ""]
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.TokenCounter(PATH).count(texts).tolist() == want


def test_bounded_state_gives_the_same_counts(monkeypatch):
    texts = strange_texts(800, 2)
    want = token_counts.TokenCounter(PATH).count(texts).tolist()
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "MEMO_PIECES", 20)
    monkeypatch.setattr(token_counts, "BLOCK_CHARS", 64)
    assert token_counts.TokenCounter(PATH).count(texts).tolist() == want


def test_chunk_maps_compose_like_one_pass():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, token_counts.N_CLASS, 1000).astype(np.uint8)
    codes[-1] = token_counts.END
    state, marks = token_counts.FRESH, np.zeros(1000, bool)
    for i, c in enumerate(codes):
        out = token_counts.OUT[c, state]
        marks[i] |= bool(out & token_counts.HERE)
        if out & token_counts.BEFORE:
            marks[i - 1] = True
        state = token_counts.GO[c, state]
    assert token_counts.piece_starts(codes).tolist() == np.flatnonzero(marks).tolist()


def test_count_tokens_keeps_rows_and_clashing_columns(spark):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (None, None, None), (2, "", "y"), (3, "é" * 600, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, token_counts.count_tokens(df, PATH).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str)
    assert got == sorted([(1, 11, 2, False), (1, 11, 2, False), (None, 0, 0, False), (2, 0, 0, False), (3, 1200, 600, True)], key=str)
    assert token_counts.count_tokens(df.limit(0), PATH).count() == 0


def test_packing_covers_every_id_once(spark, library):
    texts = [*strange_texts(60, 3), "word " * 5000, "", None]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(7, texts[7], "clash"), (None, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = packing.pack(df.repartition(5), PATH, size=64).collect()
    want = sorted((i if i is not None else -1, tuple([*library.encode(t or "", add_special_tokens=False).ids, 1])) for i, t, _ in rows)
    docs, at = [], {}
    for r in sorted(out, key=lambda r: (r.doc_id if r.doc_id is not None else -1, r.start)):
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= 64
        at.setdefault((r.doc_id if r.doc_id is not None else -1, r.doc_tokens), []).append((r.start, tuple(ids.tolist())))
        docs.append(zlib.crc32(r.ids))
    got = []
    for (doc, tokens), parts in at.items():
        copies = sum(s == 0 for s, _ in parts)
        for k in range(copies):
            own = parts[k::copies]
            assert [s for s, _ in own] == list(np.cumsum([0, *[len(p) for _, p in own[:-1]]]))
            got.append((doc, sum((p for _, p in own), ())))
            assert len(got[-1][1]) == tokens
    assert sorted(got) == want
    for s in {r.sequence_id for r in out}:
        own = sorted((r.offset, r.length) for r in out if r.sequence_id == s)
        assert [o for o, _ in own] == list(np.cumsum([0, *[n for _, n in own[:-1]]])) and sum(n for _, n in own) <= 64
    assert {r.sequence_id for r in out} == set(range(max(r.sequence_id for r in out) + 1))
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_shortest_pack_first_uses_each_length_exactly():
    rng = np.random.default_rng(1)
    for _ in range(200):
        size = int(rng.integers(4, 60))
        histogram = {int(k): int(rng.integers(1, 200)) for k in rng.choice(np.arange(1, size + 1), rng.integers(1, size), replace=False)}
        used = {}
        for packs, content in packing.shortest_pack_first(histogram, size):
            assert packs > 0 and sum(n * t for n, t in content) <= size
            for n, t in content:
                used[n] = used.get(n, 0) + packs * t
        assert used == histogram


def test_shortest_pack_first_is_dense_and_quick_on_huge_counts():
    histogram = {k: 10**9 // k for k in range(1, 2049)}
    packs = sum(p for p, _ in packing.shortest_pack_first(histogram, 2048))
    assert packs * 2048 < 1.01 * sum(k * n for k, n in histogram.items())


def test_other_tokenizers_take_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    assert packing.encoder(path)("Hello <b>World</b>").tolist() == own.encode("Hello <b>World</b>", add_special_tokens=False).ids
