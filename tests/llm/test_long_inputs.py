"""Very long texts and pages take linear time and bounded memory, and give the same results."""

import random
import time

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gaugeline.llm import pii, token_counts, urls

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_states_are_dropped_within_a_piece(monkeypatch):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=3000)), "x" * 2000 + "日本" * 500]
    want = [len(Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids) for t in texts]
    monkeypatch.setattr(token_counts, "MAX_STATES", 40)
    counter = token_counts.TokenCounter(PATH)
    assert counter.count(texts).tolist() == want
    assert len(counter.pieces.states) <= 42 and not any(len(w) > token_counts.MEMO_CHARS for w in counter.memo)


def test_long_texts_are_cut_before_blanks(monkeypatch):
    rnd = random.Random(2)
    text = "".join(rnd.choice(["word", "it's", "  ", " ", "\n", ", ", ". ", "5", "é", "\t "]) for _ in range(3000))
    want = len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids)
    monkeypatch.setattr(token_counts, "BLOCK_CHARS", 50)
    parts = list(token_counts.cut_text(text, 50))
    assert len(parts) > 50 and "".join(parts) == text
    assert token_counts.TokenCounter(PATH).count([text]).tolist() == [want]


def test_pages_of_unclosed_tags_are_read_in_linear_time(spark):
    rule = [("block", "bad.net", "/")]
    mb = 5 << 20
    pages = [
        (1, "http://a.com/x", "<link " * (mb // 6) + '<link rel="canonical" href="http://bad.net/">'),
        (2, "http://b.com/x", "<meta http-equiv=refresh " * (mb // 25) + '<meta http-equiv="refresh" content="0; url=http://bad.net/">'),
        (3, "http://c.com/x", "<link " + "rel = " * (mb // 6) + ">"),
        (4, "http://d.com/x", "<link href=" + " " * mb + "http://bad.net/ rel=canonical>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    began = time.perf_counter()
    got = {r.page_id: r.verdict for r in urls.judge_urls(df, rule).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "block"}
    assert time.perf_counter() - began < 60


def test_long_segments_decode_like_short_ones():
    rng = np.random.default_rng(0)
    model = pii.fit()
    moves = model.moves()
    rnd = random.Random(3)
    for n in (1, 2, 17, 300):
        text = "".join(rnd.choice(["4111 1111 1111 1111", "5", ".", "-", "a@b.de", "x", "(0)"]) for _ in range(n))
        kinds = rng.integers(0, 4, len(text)).astype(np.uint8)
        e = pii.blended(model, [(text, 0, len(text))]) + pii.OPEN[kinds]
        first, last = model.p["s"] + pii.START, np.zeros(pii.N_TAG, np.float32)
        want = pii.viterbi(e[:, None], np.array([len(text)]), first[None], moves, last[None])[:, 0]
        for block in (150, 10**6):
            assert pii.long_tags(model, text, 0, len(text), kinds, first, last, block).tolist() == want.tolist()


def test_long_stretches_are_found_whole(monkeypatch):
    text = "call 030 1234 5678 now " + "x" * 3000 + "@example.com " + "7 " * 2000 + "end"
    model = pii.fit()
    want = pii.all_spans(model, [text, "mail a@b.de"])
    monkeypatch.setattr(pii, "LONG", 100)
    assert pii.all_spans(model, [text, "mail a@b.de"]) == want
