import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import embeddings, hnsw, topk

SCHEMA = "vec_id long, embedding array<float>, n_links string"


def odd_rows(dim=8):
    nan, inf = float("nan"), float("inf")
    return [(900, None, "x"), (901, [], "x"), (902, [0.0] * dim, "x"), (903, [1.0] * (dim - 1) + [nan], "x"), (904, [inf] * dim, "x"), (905, [1.0, 2.0], "x"), (906, [2.0, 4.0], "x"), (907, [1.0] * (dim - 1) + [None], "x")]


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    x = (centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * 0.2).astype(np.float32)
    x[: n // 8] = x[0]
    return x


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def brute_links(rows, least=0.9):
    ok = [(k, np.array(v, np.float64)) for k, v, _ in rows if usable(v) and any(v)]
    links = {k: set() for k, _, _ in rows}
    for i, (a, x) in enumerate(ok):
        for b, y in ok[:i]:
            if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                links[a].add(b)
                links[b].add(a)
    part = {k: k for k in links}
    for _ in links:
        new = {k: min([part[k], *(part[j] for j in near)]) for k, near in links.items()}
        if new == part:
            break
        part = new
    return {k: (len(links[k]), part[k], part[k] == k) for k in links}


@pytest.mark.parametrize("shards", [None, 3])
def test_links_equal_brute_force(spark, shards):
    rows = [(i, v, "clash") for i, v in enumerate(clustered(360, 8, 1).tolist())] + odd_rows()
    out = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), shards=shards).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out} == brute_links(rows)


def near_threshold(n, dim, seed):
    """Pairs at cosines around 0.9, a hot group and rows of their own."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    half = n // 3
    cosine = rng.uniform(0.88, 0.95, half)[:, None]
    u = x[:half] / np.linalg.norm(x[:half], axis=1, keepdims=True)
    away = rng.normal(size=(half, dim))
    away -= (away * u).sum(axis=1, keepdims=True) * u
    x[half : 2 * half] = cosine * u + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    x[2 * half : 2 * half + n // 8] = x[2 * half] + rng.normal(size=(n // 8, dim)) * 0.25
    return x[rng.permutation(n)].astype(np.float32)


def test_recall_near_the_threshold(spark):
    x = near_threshold(10_000, 64, 8)
    report = {}
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = np.array([(r.vec_id, r.n_links) for r in embeddings.near_vectors(df, report=report).collect()])
    n = got[np.argsort(got[:, 0]), 1]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = (u @ u.T >= 0.9).sum(axis=1) - 1
    assert (n <= want).all() and want.max() > 500
    linked = want > 0
    assert (n[linked] / want[linked]).mean() >= 0.99 and n.sum() >= 0.99 * want.sum()
    assert report["true"] > 100 and report["found"] >= 0.99 * report["true"]


def test_a_hot_group_gives_a_forest():
    """As many edges as vectors, not as pairs."""
    x = np.random.default_rng(2).normal(size=16) + np.random.default_rng(3).normal(size=(600, 16)) * 0.01
    sides = []
    for rows in (slice(0, 300), slice(300, 600)):
        g = hnsw.Graph.build(embeddings.unit(x[rows]))
        ids = np.arange(600)[rows]
        sides.append(embeddings.Shard({"dim": 16, "beam": 24, "ids": ids.tobytes(), "sizes": np.ones(300, np.int64).tobytes(), "vectors": x[rows].tobytes(), "layers": [near.astype("<i4").tobytes() for near in g.layers]}))
    for host, guest, links in ((sides[0], sides[1], 300), (sides[0], sides[0], 299)):
        rows = np.concatenate(embeddings.pair_rows(host, guest, host is guest, 0.9, 32, 0.99))
        assert set(rows[rows[:, 0] == embeddings.COUNT, 2]) == {links}
        assert (rows[:, 0] == embeddings.EDGE).sum() == (599 if host is not guest else 299)


def test_links_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert embeddings.near_vectors(df).count() == 0
    one = embeddings.near_vectors(spark.createDataFrame([(None, [1.0, 0.0], "x"), (3, [2.0, 0.0], "x")], SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id) for r in one) == [(-1, 1, 3), (3, 1, 3)]


def test_graph_recall_and_widening():
    rng = np.random.default_rng(3)
    x = embeddings.unit(rng.normal(size=(3000, 16)))
    graph = hnsw.Graph.build(x)
    q, least = x[:200], 0.6
    truth = q @ x.T >= least
    found = np.zeros(truth.shape, bool)
    found[graph.query(q, least, hnsw.audited_beam(graph, q, least, 8, 64, 0.99))] = True
    assert (found & truth).sum() / truth.sum() > 0.95 and not (found & ~truth).any()


def brute_top(rows, k=5):
    ok = [(i, [math.floor(c * 256) for c in v]) for i, v, _ in rows if i is not None and usable(v)]
    out = []
    for at, (q, x) in enumerate(ok):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for j, (i, y) in enumerate(ok) if j != at and len(x) == len(y))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_top_products_equal_brute_force(spark, monkeypatch, seed):
    """With small blocks and shards, odd rows, repeated rows (rows of their own) and a hot group of equal vectors."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 4)
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    rows = [(i, v, "clash") for i, v in enumerate(clustered(700, 8, seed).tolist())] + odd_rows() + [(None, [1.0] * 8, "x")]
    rows += [rows[0], rows[650], rows[650]]
    out = topk.top_products(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect()) == brute_top(rows)


def test_products_beyond_exact_doubles(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(2**19, 2**20, (300, 4)).astype(float)
    x[7] = x[8] = x[0]
    x[8, 0] += 1
    rows = [(i, v, "x") for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    out = topk.top_products(df, F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in out.collect()) == brute_top(rows)


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 1.0], "x"), (7, [1.0, -1.0], "x"), (8, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in topk.top_products(df, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 7, 0)]
    assert topk.top_products(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("n, dim, leaf", [(500, 6, 8), (1, 3, 8), (40, 2, 1), (300, 3, 300)])
def test_tree_invariants(n, dim, leaf):
    x = clustered(n, dim, 4).astype(float) if n > 12 else np.ones((n, dim))
    tree, order = topk.CoverTree.build(x, leaf)
    nodes = tree.nodes
    assert sorted(order.tolist()) == list(range(n)) and (tree.x == x[order]).all()
    assert (nodes["lo"][0], nodes["hi"][0]) == (0, n)
    leaves = nodes[nodes["child_lo"] == nodes["child_hi"]]
    assert sorted((leaves["lo"].tolist())) == [0, *sorted(leaves["hi"].tolist())[:-1]]
    top = np.linalg.norm(x - x[0], axis=1).max()
    for m in nodes:
        own = tree.x[m["lo"] : m["hi"]]
        assert np.linalg.norm(own - tree.x[m["centre"]], axis=1).max() <= m["radius"]
        children = nodes[m["child_lo"] : m["child_hi"]]
        if len(children):
            assert children["centre"][0] == m["centre"]  # nesting
            assert sorted(children["lo"].tolist()) == [m["lo"], *sorted(children["hi"].tolist())[:-1]]
            d = np.linalg.norm(tree.x[children["centre"]] - tree.x[m["centre"]], axis=1)
            assert d.max() <= top / topk.BASE ** (children["level"][0] - 1) + 1e-9  # covering
    centres = {int(m["centre"]): int(m["level"]) for m in nodes[::-1]}  # the level where a centre begins
    for level in range(max(centres.values()) + 1):
        own = [c for c, at in centres.items() if at <= level]
        d = np.linalg.norm(tree.x[own][:, None] - tree.x[own][None], axis=2) + np.eye(len(own)) * 1e9
        assert d.min() >= top / topk.BASE**level - 1e-9  # separation


def test_pairs_are_pruned_in_few_dimensions():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20_000, 3))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    data, order = topk.CoverTree.build(x, topk.DATA_LEAF)
    queries, q_order = topk.CoverTree.build(x[::50], topk.QUERY_LEAF)
    rows = np.arange(len(x))
    search = topk.DualSearch(queries, rows[::50][q_order], np.full(400, -np.inf), data, rows[order], rows[order], 5)
    search.run()
    assert search.scored < 0.2 * 400 * len(x)
    for i, row in enumerate(rows[::50][q_order][::40]):
        full = x[row] @ x.T
        full[row] = -np.inf
        assert search.found[40 * i].tolist() == np.lexsort((rows, -full))[:5].tolist()


def hot_and_small():
    """A graph whose first 400 nodes are one group that can be walked; 30 pairs after them have no links."""
    rng = np.random.default_rng(5)
    hot = rng.normal(size=32) + rng.normal(size=(400, 32)) * 0.02
    small = np.repeat(rng.normal(size=(30, 32)), 2, axis=0) + rng.normal(size=(60, 32)) * 0.02
    x = np.concatenate((hot, small))
    near = np.full((460, hnsw.DEGREE), -1)
    near[:400] = (np.arange(400)[:, None] + np.arange(1, hnsw.DEGREE + 1)) % 400
    return hnsw.Graph((x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32), [near])


def test_a_hot_group_hides_no_small_ones():
    graph = hot_and_small()
    found = np.zeros((460, 460), bool)
    beam = hnsw.audited_beam(graph, graph.x, 0.9, 8, 64, 0.99, same=True)
    found[graph.query(graph.x, 0.9, beam) if beam else hnsw.exact_query(graph, graph.x, 0.9)] = True
    assert (found == (graph.x @ graph.x.T >= 0.9)).all()


def test_a_graph_is_audited_with_moved_copies():
    graph = hot_and_small()
    assert hnsw.graph_beam(graph, 0.9, 8, 64, 0.99) == 0
    whole = hnsw.Graph.build(graph.x)
    assert hnsw.graph_beam(whole, 0.9, 8, 64, 0.99) >= 8
    q, n = hnsw.exact_query(whole, graph.x[::7], 0.9)
    truth = graph.x[::7] @ graph.x.T >= 0.9
    assert truth[q, n].all() and len(q) == truth.sum()
