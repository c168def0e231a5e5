import hashlib
import itertools
import re

import numpy as np
import pytest

from gaugeline.llm import pii, queries


@pytest.fixture(scope="module")
def model():
    return pii.fit()


def slow_base(text):
    """The patterns by the plain engine; the address pattern as it is written."""
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = lambda s: [int(c) for c in s if c in "0123456789"]

    def valid(kind, s):
        d = digits(s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(x * 2 - 9 * (x > 4) for x in d[-2::-2])) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    return [(k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, text) if valid(k, m.group())]


TEXTS = [
    "mail a.b+c@x-y.co.uk, b@c.d@e.f or @x.y a@b a@b. x@y.z..w", "ips 1.2.3.4 256.1.1.1 1.2.3.4.5 01.002.3.4 10.0.0.1:80 1.2.3. 999.1.2.3.4", "cards 4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 12 4111  1111",
    "phones +1 (555) 123-4567 +1 234 +49-30-1234567890123 +12345678 9 ++15551234567", "", "é@x.com ünï@münchen.de 日本1.2.3.4日本 +4930 123 45 67.", "a" * 500 + "@x.com 1" + ".2" * 500, "٣٤٥ 1٢.3.4.5 4111 1111 1111 1111 2",
]


def test_base_spans_equal_the_patterns():
    for text in TEXTS:
        assert pii.base_spans(text) == slow_base(text), text


def test_all_spans_hold_the_base_and_do_not_overlap_it(model):
    for text, (base, own) in zip(TEXTS, pii.all_spans(model, TEXTS), strict=True):
        assert base == slow_base(text) and set(base) <= set(own)
        for k, a, b in set(own) - set(base):
            assert 0 <= a < b <= len(text) and all(b <= c or d <= a for _, c, d in base) and k in pii.KINDS


def test_network_learns_the_labels(model):
    texts, spans = pii.labelled_examples(300, seed=99)
    found = pii.network_spans(model, texts)
    hit = sum(len(set(f) & set(s)) for f, s in zip(found, spans, strict=True))
    assert hit / sum(map(len, spans)) > 0.9 and hit / max(1, sum(map(len, found))) > 0.9


def test_viterbi_equals_enumeration(model):
    rng = np.random.default_rng(1)
    sizes = np.array([4, 4, 3, 1])
    e = rng.normal(0, 2, (4, 4, pii.N_TAG)).astype(np.float32)
    first, last = rng.normal(size=(2, 4, pii.N_TAG)).astype(np.float32)
    moves = model.moves()
    tags = pii.viterbi(e, sizes, first, moves, last)
    for j, n in enumerate(sizes):

        def total(path):
            return first[j, path[0]] + last[j, path[-1]] + sum(e[t, j, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False))

        assert tuple(tags[:n, j]) == max(itertools.product(range(pii.N_TAG), repeat=int(n)), key=total)


def test_gradient_equals_differences():
    x, y = pii.tagged_windows(["to a@b.com 12", "(555) 123-4567 x"], [[("email", 3, 10)], [("phone", 0, 14)]])
    rng = np.random.default_rng(2)
    small = pii.train(x, y, steps=1)
    model = pii.TaggerModel({k: v.astype(np.float64) + rng.normal(0, 0.05, v.shape) for k, v in small.p.items()})
    x, y = x[:20], y[:20]
    _, g = pii.gradients(model, x, y)
    for name, v in model.p.items():
        for at in rng.integers(0, v.size, 4):
            was = v.flat[at]
            v.flat[at] = was + 1e-5
            up, _ = pii.gradients(model, x, y)
            v.flat[at] = was - 1e-5
            down, _ = pii.gradients(model, x, y)
            v.flat[at] = was
            assert abs((up - down) / 2e-5 - g[name].flat[at]) < 1e-5, (name, at)


def whole_text_spans(model, text):
    """All windows of the text, one search over all of it."""
    if not text:
        return []
    n = len(text)
    e = np.zeros((n, 1, pii.N_TAG), np.float32)
    for w in range(-(-n // pii.STRIDE)):
        own = model.emissions(pii.encode([text[w * pii.STRIDE : w * pii.STRIDE + pii.WIDTH]]))[:, 0]
        for t in range(w * pii.STRIDE, min(n, w * pii.STRIDE + pii.WIDTH)):
            inside = t - w * pii.STRIDE
            share = (t % pii.STRIDE + 0.5) / pii.STRIDE if t >= pii.STRIDE else 1.0
            e[t, 0] += own[inside] * (share if inside < pii.STRIDE else 1 - share)
    kinds = np.zeros(n, np.uint8)
    for m in re.finditer(r"[^\s]*@[^\s]*", text):
        kinds[slice(*m.span())] |= pii.MAIL
    for m in re.finditer(r"[0-9 +().-]+", text):
        s = m.group()
        if len(pii.digits_of(s)) >= 9 or re.search(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", s):
            kinds[slice(*m.span())] |= pii.NUMBER
    e[:, 0] += pii.OPEN[kinds]
    start = (model.p["s"] + pii.START)[None]
    tags = pii.viterbi(e, np.array([n]), start, model.moves(), 0 * start)[:, 0]
    out = []
    for t in np.flatnonzero(tags % 2 == 1):
        end = t + 1
        while end < n and tags[end] == tags[t] + 1:
            end += 1
        kind = pii.KINDS[tags[t] // 2]
        if pii.LIKELY[kind](text[t:end]):
            out.append((kind, int(t), int(end)))
    return sorted(out)


def test_parts_equal_the_search_over_the_whole_text(model, monkeypatch):
    texts, _ = pii.labelled_examples(60, seed=7)
    texts += [" ".join(texts[:20]), "1 2 " * 300 + "(555) 123-4567", "x" * 130 + "@" + "y.z" * 60, "(555) 123-4567a@b.com12.34.56.789", "@", ""] + TEXTS
    want = [whole_text_spans(model, t) for t in texts]
    assert sum(map(len, want)) > 60
    assert [sorted(f) for f in pii.network_spans(model, texts)] == want
    monkeypatch.setattr(pii, "PIECE", 50)
    monkeypatch.setattr(pii, "AREA", 100)
    assert [sorted(f) for f in pii.network_spans(model, texts)] == want


def test_spans_are_found_wherever_they_lie(model):
    bare = "call (555) 123-4567 now"
    assert pii.network_spans(model, [bare])[0] == [("phone", 5, 19)]
    for pad in range(0, 260, 13):
        text = "tall oaks. " * pad + bare + " , 3" * 200
        assert ("phone", 11 * pad + 5, 11 * pad + 19) in pii.network_spans(model, [text])[0]


class Telling:
    """A tagger that is sure: one span over each run of non-blank characters with an @."""

    def __init__(self):
        self.p = {"s": np.zeros(pii.N_TAG, np.float32)}

    def moves(self):
        return pii.FORBIDDEN

    def emissions(self, x):
        e = np.zeros((*x.shape, pii.N_TAG), np.float32)
        e[..., 2] = 5
        e[..., 1] = 4
        return e


def test_long_spans_are_not_cut():
    for size in (300, 5000):
        text = "to " + "é" * size + "@x.com and on"
        assert pii.network_spans(Telling(), [text]) == [[("email", 3, size + 9)]]


def test_clean_text_stays_clean(model):
    clean = ["The river ran past 12 mills in 1987, and 3 of them still stand.", "Version 2.10.3 of 2024-05-06 12:30 costs $1,299.00 (see pages 10-12)."] * 5
    assert not any(own for _, own in pii.all_spans(model, clean))


def test_find_and_redact(spark, model):
    assert pii.replaced("ab cd ef", [{"kind": "ip", "start": 3, "end": 5}, {"kind": "card", "start": 4, "end": 6}, {"kind": "ip", "start": 7, "end": 8}]) == "ab [IP]e[IP]"
    rows = [(1, "to a@b.com and 1.2.3.4", "x"), (1, "to a@b.com and 1.2.3.4", "x"), (2, None, "x"), (None, "", "x"), (3, "nothing", "x"), (4, "long " * 60_000 + "a@b.com", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = pii.redact(pii.find_spans(df, model)).collect()
    got = {(r.doc_id, (r.text or "")[-30:]) for r in out}
    assert len(out) == 6 and {(1, "to [EMAIL] and [IP]"), (2, ""), (None, ""), (3, "nothing")} <= got
    assert [r.text[-12:] for r in out if r.doc_id == 4] == ["long [EMAIL]"] and [r.text for r in out if r.doc_id == 2] == [None]
    assert pii.find_spans(df.limit(0), model).count() == 0


def test_query_counts_the_base_spans(spark, tmp_path):
    """What the network adds is in ``spans`` alone."""
    texts = [*TEXTS, "call (555) 123-4567 now", "(555) 123-4567 and +1 (555) 123-4567, a@b.com", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    added = 0
    for r in queries.op8_personal_data(spark, str(tmp_path)).collect():
        base = slow_base(texts[r.doc_id] or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == own for own, _, _ in base) for k in pii.KINDS)
        joined = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        found = r.spans.split(",") if r.spans else []
        assert set(joined) <= set(found)
        added += len(found) > len(base)
    assert added >= 2
