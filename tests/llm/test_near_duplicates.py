import random
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import neardup


def bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute_force(rows):
    """Smallest key of each component of links of 0.8 or more; nothing links texts without words."""
    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least.setdefault(find(i), []).append((k is None, k))
    return sorted(((k, min(least[find(i)])[1]) for i, (k, _) in enumerate(rows)), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    shared = " ".join(word() for _ in range(20))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rnd.randint(3, 120))]
        texts.append(" ".join(base))
        for _ in range(rnd.randint(0, 8)):
            other = list(base)
            for _ in range(rnd.randint(0, 4)):
                other[rnd.randrange(len(other))] = word()
            texts.append("  ".join(other).upper() if rnd.random() < 0.2 else " ".join(other))
        if rnd.random() < 0.4:
            texts.append(shared + " " + " ".join(base))
    texts += ["one two", "One  TWO", "one", "", None, " \n", "", "w " * 400, "w " * 500, "w " * 390]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[3]), (None, "alone here")]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "clash", True) for r in rows], "doc_id long, text string, class_id string, kept boolean").repartition(3)
    out = neardup.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.class_id) for r in out), key=str) == brute_force(rows)
    groups = Counter(r.class_id for r in out if r.class_id is not None)
    kept = [r for r in out if r.kept]
    assert all(r.doc_id == r.class_id for r in kept)
    empty = sum(1 for _, t in rows if not (t or "").split())
    assert len(kept) == len(groups) + sum(1 for r in out if r.class_id is None) and empty


def test_kept_columns_and_large_groups(spark):
    base = "a large group of copies shares one long text with many words in it " * 5
    rows = [(i, base + ("" if i % 3 else f"tail{i % 7}"), str(i)) for i in range(900)] + [(5000, "something else entirely that nobody has copied", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = neardup.near_duplicates(df, keep_columns=True, class_col="c", kept_col="k")
    assert out.columns == ["doc_id", "text", "source", "c", "k"]
    assert sorted((r.doc_id, r.source) for r in out.filter("k").collect()) == [(0, "0"), (5000, "x")]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("chunk, most", [(2, 10_000), (100, 200)])
def test_links_across_parts_of_a_bucket(monkeypatch, spark, chunk, most):
    """A pivot that is near none of the others must not hide links among those."""
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    monkeypatch.setattr(neardup, "CHUNK_WORDS", most)
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words), *[" ".join(words[:60] + [f"x{j}{i}" for i in range(40)]) for j in range(3)]]
    texts += [t + " end" for t in texts[1:]]
    rows = list(enumerate(texts))
    members = spark.createDataFrame([(1, len(rows), 100 * len(rows), i, i) for i, _ in rows], "band long, n long, words long, uid long, part long")
    found = neardup.block_links(members, spark.createDataFrame(rows, "uid long, text string"), 0.8).collect()
    assert sorted(tuple(sorted((r.a, r.b))) for r in found) == [(1, 4), (2, 5), (3, 6)]


def test_signatures_estimate_the_weighted_jaccard_similarity():
    a, b = "p q r s t u v " * 6 + "x y z " * 4, "p q r s t u v " * 5 + "x y z " * 6
    doc, shingle, count = neardup.shingle_bags([a, b])
    sig = neardup.signatures(doc, shingle, count, 2, registers=6000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(similarity(bag(a), bag(b)), abs=0.03)


def test_overlaps_of_many_short_pairs():
    """A slice by characters holds more pairs than one block of texts."""
    left = [f"a{i} b c d e f g" for i in range(5000)]
    right = [t if i % 3 else t + f" h{i}" for i, t in enumerate(left)]
    assert neardup.overlaps(left, right) == pytest.approx([similarity(bag(a), bag(b)) for a, b in zip(left, right, strict=True)])


def test_links_of_shingles_that_occur_very_often():
    """Every occurrence of a shingle counts, also past the 4096th: 6000 of 6500 are shared."""
    found = neardup.linked_parts(np.array([7, 8, 9]), np.array([7, 8, 9]), ["w " * 6004, "w " * 6504, "w " * 4504], 0.8)
    assert found == [(7, 8)]
