"""Exact top-k inner products by dual-tree search over cover trees.

Rows are dealt to cells by their nearest pivot; a large cell is split by hash. Each shard of
candidates and each block of queries gets one cover tree, which is built once and written. A first
search in the shard where a query itself lies gives its k-th score so far. Then every block
meets every shard: both trees are walked together, and a pair of nodes is dropped when the
largest inner product that the centres and covering radii allow is below the worst k-th
score of the queries in the query node. What is left of two leaves is one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, materialize, named
from .embeddings import stack, usable

BASE = 1.3
DATA_LEAF, QUERY_LEAF, MOST_LEAVES = 64, 8, 512
SHARDS, SHARD_ROWS, BLOCK_ROWS, MOST_BYTES = 16, 32_768, 16_384, 1 << 24
SAMPLE, LEAST_PIVOTS, MOST_PIVOTS = 4096, 16, 1024
EXACT = 2.0**53
NODE = np.dtype([("centre", "<i4"), ("level", "<i4"), ("lo", "<i4"), ("hi", "<i4"), ("child_lo", "<i4"), ("child_hi", "<i4"), ("radius", "<f8"), ("angle", "<f8"), ("low", "<f8"), ("high", "<f8")])
TREE = "ids binary, rows binary, floors binary, vectors binary, nodes binary"


def distances(x: np.ndarray, norms: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(norms + to @ to - 2 * (x @ to), 0))


def spread(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to ``most`` centres, farthest first: (points, distance of each to those before it, nearest centre of every point)."""
    norms = np.einsum("ij,ij->i", x, x)
    near, which = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
    points, apart, at = [], [], 0
    while len(points) < most and (not points or near[at] > 0):
        points.append(at)
        apart.append(near[at])
        d = distances(x, norms, x[at])
        d[at] = 0
        closer = d < near
        near[closer], which[closer] = d[closer], len(points) - 1
        at = int(near.argmax())
    return np.array(points), np.array(apart), which


class CoverTree:
    """Points in the order of the leaves, and nodes (NODE), the root first.

    Level ``l`` holds the centres that are at least ``top / BASE**l`` apart from each other, where
    ``top`` is the largest distance from the root's centre. A centre stays a centre on all deeper
    levels (nesting), and every centre of a level lies within the scale of the level above
    from its parent (covering). Chains of single children are left out. At the bottom each centre has a
    leaf with the points that are nearest to it. ``radius`` and ``angle`` cover the node's points as
    seen from its centre, ``low`` and ``high`` bound their norms.
    """

    def __init__(self, x: np.ndarray, nodes: np.ndarray):
        self.x, self.nodes = x, nodes

    @classmethod
    def build(cls, x: np.ndarray, leaf: int) -> tuple[CoverTree, np.ndarray]:
        """The tree and the order of its points."""
        points, apart, which = spread(x, max(1, min(MOST_LEAVES, len(x) // leaf)))
        top = apart[1] if len(apart) > 1 else 1.0
        level = np.zeros(len(points), int)
        level[1:] = np.maximum(0, np.ceil(np.log(top / apart[1:]) / np.log(BASE) - 1e-9)).astype(int)
        centres = x[points]
        c_norm = np.einsum("ij,ij->i", centres, centres)
        made = [[0, -1, 0, 0]]  # centre, level, first child, end of children
        last = {0: 0}  # the deepest node of each centre so far
        for now in range(level[1:].max(initial=-1) + 1):
            new, before = np.flatnonzero(level == now)[(now == 0) :], np.flatnonzero(level < now) if now else np.array([0])
            parents: dict[int, list[int]] = {}
            for j in new.tolist():
                parents.setdefault(int(before[distances(centres[before], c_norm[before], centres[j]).argmin()]), []).append(j)
            for parent, children in parents.items():
                made[last[parent]][2:] = [len(made), len(made) + 1 + len(children)]
                for j in [parent, *children]:
                    last[j] = len(made)
                    made.append([j, now, 0, 0])
        nodes = np.zeros(len(made), NODE)
        own = np.bincount(which, minlength=len(points))
        at, begin, todo = 0, np.zeros(len(points), int), [(0, False)]
        while todo:  # depth first, so that the points of a node lie together
            n, done = todo.pop()
            centre, lev, first, end = made[n]
            if not done:
                nodes[n]["lo"] = at
            if first == end:
                begin[centre] = at
                at += own[centre]
            elif not done:
                todo += [(n, True), *((c, False) for c in range(end - 1, first - 1, -1))]
                continue
            nodes[n]["hi"] = at
            nodes[n]["centre"], nodes[n]["level"], nodes[n]["child_lo"], nodes[n]["child_hi"] = centre, lev, first, end
        order = np.lexsort((np.arange(len(x)), begin[which]))
        place = np.empty(len(x), int)
        place[order] = np.arange(len(x))
        x = np.ascontiguousarray(x[order])
        nodes["centre"] = place[points[nodes["centre"]]]
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        for n in nodes:
            part, centre, c = slice(n["lo"], n["hi"]), x[n["centre"]], norm[n["centre"]]
            dots = x[part] @ centre
            n["radius"] = np.sqrt(max(0.0, (norm[part] ** 2 + c * c - 2 * dots).max()))
            n["low"], n["high"] = norm[part].min(), norm[part].max()
            some = norm[part] > 0
            n["angle"] = np.arccos(np.clip(dots[some] / (norm[part][some] * c), -1, 1)).max(initial=0) if c > 0 else np.pi
        nodes["radius"] = nodes["radius"] * (1 + 1e-9) + 1e-9 * (1 + norm.max())
        nodes["angle"] += 1e-6
        return cls(x, nodes), order


class DualSearch:
    """The ``k`` best scores of each query that aren't below its floor, ties to the smaller id, the query's own row left out."""

    def __init__(self, queries: CoverTree, q_rows: np.ndarray, floors: np.ndarray, data: CoverTree, ids: np.ndarray, rows: np.ndarray, k: int):
        self.q, self.d, self.k = queries, data, k
        self.q_rows, self.ids, self.rows = q_rows, ids, rows
        n = len(q_rows)
        most = np.abs(queries.x).max(initial=0) * np.abs(data.x).max(initial=0) * max(1, queries.x.shape[1])
        # beyond exact doubles the product is taken in 64-bit integers; floors are doubles, and rounding keeps the order
        self.whole = EXACT <= most < 2.0**63
        self.none = np.int64(-(2**63)) if self.whole else -np.inf
        self.floor = floors.copy()
        self.score, self.found = np.full((n, k), self.none), np.full((n, k), np.iinfo(np.int64).max)
        self.scored = 0
        self.bound = self.bounds() + 1e-9 * (1 + most)

    def bounds(self) -> np.ndarray:
        """Largest inner product of each pair of nodes, by the balls and by the cones around their centres."""
        q, d = self.q.nodes, self.d.nodes
        a, b = self.q.x[q["centre"]], self.d.x[d["centre"]]
        a_norm, b_norm = np.linalg.norm(a, axis=1)[:, None], np.linalg.norm(b, axis=1)[None]
        dots = a @ b.T
        ball = dots + q["radius"][:, None] * b_norm + d["radius"][None] * a_norm + q["radius"][:, None] * d["radius"][None]
        length = a_norm * b_norm
        between = np.arccos(np.clip(np.divide(dots, length, out=np.ones_like(dots), where=length > 0), -1, 1))
        cosine = np.cos(np.maximum(0, between - q["angle"][:, None] - d["angle"][None]))
        cone = cosine * np.where(cosine >= 0, q["high"][:, None] * d["high"][None], q["low"][:, None] * d["low"][None])
        return np.minimum(ball, cone)

    def product(self, own: slice, points: np.ndarray) -> np.ndarray:
        if self.whole:
            return self.q.x[own].astype(np.int64) @ self.d.x[points].astype(np.int64).T
        return self.q.x[own] @ self.d.x[points].T

    def compare(self, own: slice, points: np.ndarray) -> None:
        """Score the queries of a leaf against points and keep the best."""
        scores = self.product(own, points)
        self.scored += scores.size
        ok = (scores >= self.floor[own, None]) & (self.rows[points] != self.q_rows[own, None])
        many = np.flatnonzero(np.count_nonzero(ok, axis=1) > 8 * self.k)
        if len(many):
            part = np.where(ok[many], scores[many].astype(float), -np.inf)
            ok[many] &= part >= np.partition(part, -self.k, axis=1)[:, -self.k, None]
        r, c = np.nonzero(ok)
        if not len(r):
            return
        n = own.stop - own.start
        row = np.concatenate((r, np.repeat(np.arange(n), self.k)))
        s = np.concatenate((scores[r, c], self.score[own].ravel()))
        who = np.concatenate((self.ids[points[c]], self.found[own].ravel()))
        order = np.lexsort((who, ~s if self.whole else -s, row))
        row, s, who = row[order], s[order], who[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        keep = nth < self.k
        self.score[own], self.found[own] = s[keep].reshape(n, self.k), who[keep].reshape(n, self.k)
        kth = self.score[own, -1]
        self.floor[own] = np.maximum(self.floor[own], np.where(kth == self.none, -np.inf, kth.astype(float)))

    def run(self) -> None:
        q, d, bound = self.q.nodes, self.d.nodes, self.bound
        inner = d["child_hi"] > d["child_lo"]
        todo = [(0, np.array([0]))]
        while todo:
            a, b = todo.pop()
            own = slice(int(q["lo"][a]), int(q["hi"][a]))
            last = q["child_hi"][a] == q["child_lo"][a]
            while True:  # the data nodes that may matter, as fine as the query node, or down to the leaves
                b = b[bound[a, b] >= self.floor[own].min(initial=np.inf)]
                split = inner[b] & (last | (d["radius"][b] > q["radius"][a]))
                if not split.any():
                    break
                b = np.concatenate((b[~split], *(np.arange(d["child_lo"][i], d["child_hi"][i]) for i in b[split])))
            if not len(b):
                continue
            if not last:
                todo += [(child, b) for child in range(q["child_lo"][a], q["child_hi"][a])]
                continue
            b = b[np.argsort(-bound[a, b], kind="stable")]
            at, take = 0, 4
            while at < len(b) and bound[a, b[at]] >= self.floor[own].min(initial=np.inf):
                self.compare(own, np.concatenate([np.arange(d["lo"][i], d["hi"][i]) for i in b[at : at + take]]))
                at, take = at + take, min(2 * take, 32)


# ---- rows, shards and blocks


def pivots_of(sample: pa.Table, most: int) -> dict[int, np.ndarray]:
    """For each length of vectors up to ``most`` pivots, neighbours in number near each other: centres of the sample's vectors after some rounds of Lloyd's algorithm."""
    found = {}
    sizes = np.array([len(v) for v in sample["vector"].to_pylist()], int)
    for dim in np.unique(sizes).tolist():
        x = stack(sample.filter(pa.array(sizes == dim))["vector"], dim)
        at, _, which = spread(x, most)
        p = x[at]
        for _ in range(4):
            for j in range(len(p)):
                if (which == j).any():
                    p[j] = x[which == j].mean(axis=0)
            which = nearest(x, p)
        chain, left = [0], set(range(1, len(p)))
        while left:
            rest = np.array(sorted(left))
            chain.append(int(rest[((p[rest] - p[chain[-1]]) ** 2).sum(axis=1).argmin()]))
            left.remove(chain[-1])
        found[dim] = p[chain]
    return found


def nearest(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return ((p * p).sum(axis=1) - 2 * (x @ p.T)).argmin(axis=1)


def with_cells(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch["vector"]
        sizes, cells = vectors.value_lengths().to_numpy(zero_copy_only=False), np.zeros(len(batch), np.int32)
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            if dim in pivots:
                cells[at] = nearest(stack(pa.chunked_array([vectors.take(pa.array(at))]), dim), pivots[dim])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int32()), pa.array(cells)], names=[*batch.schema.names, "dim", "cell"])


def planted(t: pa.Table, leaf: int, keys: list[str]) -> pa.Table:
    """One row with the tree of a group of rows (dim, ``keys``, id, row, vector, and floor where they have one)."""
    t = t.sort_by([("id", "ascending"), ("row", "ascending")])
    dim = t["dim"][0].as_py()
    tree, order = CoverTree.build(stack(t["vector"], dim), leaf)
    floors = t["floor"].to_numpy() if "floor" in t.schema.names else np.empty(0)
    row = {"dim": dim} | {k: t[k][0].as_py() for k in keys}
    row |= {"ids": t["id"].to_numpy()[order].astype("<i8").tobytes(), "rows": t["row"].to_numpy()[order].astype("<i8").tobytes(), "floors": (floors[order] if len(floors) else floors).astype("<f8").tobytes(), "vectors": tree.x.astype("<f8").tobytes(), "nodes": tree.nodes.tobytes()}
    return pa.Table.from_pylist([row], schema=pa.schema([("dim", pa.int32()), *((k, pa.int64()) for k in keys), *((k, pa.binary()) for k in ("ids", "rows", "floors", "vectors", "nodes"))]))


def replanted(r: dict, prefix: str = "") -> tuple[CoverTree, np.ndarray, np.ndarray, np.ndarray]:
    """(tree, ids, rows, floors) of a written row."""
    ids, rows = (np.frombuffer(r[prefix + c], "<i8") for c in ("ids", "rows"))
    return CoverTree(np.frombuffer(r[prefix + "vectors"], "<f8").reshape(len(ids), r["dim"]), np.frombuffer(r[prefix + "nodes"], NODE)), ids, rows, np.frombuffer(r[prefix + "floors"], "<f8")


def first_floors(queries: pa.Table, shard: pa.Table, k: int) -> pa.Table:
    """The queries of one shard with their k-th score within it, -inf if it has fewer candidates."""
    floor = np.full(len(queries), -np.inf)
    if len(queries) and len(shard):
        data, ids, rows, _ = replanted(shard.to_pylist()[0])
        tree, order = CoverTree.build(stack(queries["vector"], queries["dim"][0].as_py()), QUERY_LEAF)
        search = DualSearch(tree, queries["row"].to_numpy()[order], floor, data, ids, rows, k)
        search.run()
        floor[order] = search.floor
    return queries.append_column("floor", pa.array(floor))


def search_pairs(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Best candidates of a block of queries in a shard, for each row with the trees of both."""
    for batch in batches:
        for i in range(len(batch)):
            r = batch.slice(i, 1).to_pylist()[0]
            queries, q_ids, q_rows, floors = replanted(r, "q_")
            data, ids, rows, _ = replanted(r)
            search = DualSearch(queries, q_rows, floors, data, ids, rows, k)
            search.run()
            ok = (search.score != search.none).ravel()
            columns = [np.repeat(q_rows, k)[ok], np.repeat(q_ids, k)[ok], search.found.ravel()[ok], search.score.ravel()[ok].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["q_row", "query_id", "vec_id", "score"])


def top_products(df: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest integer inner product for each row where ``is_query`` holds.

    Components are taken as floor(scale * x). Result: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``;
    ties go to the smaller key; a query's own row is no candidate; all candidates if there are
    fewer. Vectors that are null or empty, or hold null or non-finite components, take no part, nor do rows
    with a null key; zero vectors do take part. Vectors of another length than the
    query's are no candidates for it. Rows that repeat a key are rows of their own, as queries and as
    candidates; an empty table gives an empty result. Products are exact up to 2**63.

    Pivots come from a sample of at most ``SAMPLE`` rows and decide only where a row is searched.
    Shards and blocks are bounded by rows and bytes, however many rows a cell has. Every block
    meets every shard of its length of vectors.
    """
    x = named(vector).cast("array<double>")
    rows = df.select(named(key).cast("long").alias("id"), x.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asked")).filter(usable(F.col("x")) & F.col("id").isNotNull())
    rows = rows.select("id", F.monotonically_increasing_id().alias("row"), "asked", F.transform("x", lambda v: F.floor(v * F.lit(scale)).cast("double")).alias("vector"))
    hashed = rows.select("vector", F.xxhash64("vector").alias("h"))
    count, different = hashed.agg(F.count(F.lit(1)), F.approx_count_distinct("h")).first()
    sample = bounded_sample(hashed, "h", SAMPLE, different).toArrow()
    pivots = pivots_of(sample, min(MOST_PIVOTS, max(LEAST_PIVOTS, count // SHARD_ROWS)))
    schema = "id long, row long, asked boolean, vector array<double>, dim int, cell int"
    placed = materialize(rows.mapInArrow(lambda it: with_cells(it, pivots), schema), "topk-rows")

    # one row for each length and cell: where its shards and blocks begin, and how many it has
    cells = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asked"))
    here, before = Window.partitionBy("dim"), Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    most = F.greatest(F.lit(1), F.least(F.lit(SHARD_ROWS), F.lit(MOST_BYTES) / (8 * F.col("dim"))))
    fair = F.least(most, F.greatest(F.lit(512), F.ceil(F.sum("n").over(here) / SHARDS)))
    cells = cells.withColumns({"parts": F.ceil(F.col("n") / fair).cast("long"), "q_most": F.least(most, F.lit(BLOCK_ROWS))}).withColumn("q_parts", F.greatest(F.lit(1), F.ceil(F.col("asked") / F.col("q_most"))).cast("long"))
    cells = cells.withColumns({"first": F.coalesce(F.sum("parts").over(before), F.lit(0)), "shards": F.sum("parts").over(here), "group": F.floor(F.coalesce(F.sum("asked").over(before), F.lit(0)) / F.col("q_most")).cast("long")})
    cells = materialize(cells.select("dim", "cell", "parts", "first", "shards", "group", "q_parts"), "topk-cells")
    spot = F.xxhash64("row", F.lit(3))
    # of equal vectors only the k + 1 first rows can be among the best
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("id", "row"))
    data = placed.withColumn("nth", nth).filter(F.col("nth") <= k + 1).join(cells, ["dim", "cell"])
    data = data.select("dim", (F.col("first") + F.pmod(spot, F.col("parts"))).alias("shard"), "id", "row", "vector")
    shards = materialize(data.groupBy("dim", "shard").applyInArrow(lambda t: planted(t, DATA_LEAF, ["shard"]), f"dim int, shard long, {TREE}"), "topk-shards")

    asked = placed.filter("asked").join(cells, ["dim", "cell"])
    asked = asked.select("dim", (F.col("first") + F.pmod(spot, F.col("parts"))).alias("shard"), "group", F.pmod(spot, F.col("q_parts")).alias("part"), "shards", "id", "row", "vector")
    floored = asked.groupBy("dim", "shard").cogroup(shards.groupBy("dim", "shard")).applyInArrow(lambda a, b: first_floors(a, b, k), "dim int, shard long, group long, part long, shards long, id long, row long, vector array<double>, floor double")
    blocks = materialize(floored.groupBy("dim", "group", "part").applyInArrow(lambda t: planted(t, QUERY_LEAF, ["shards"]), f"dim int, shards long, {TREE}"), "topk-blocks")
    blocks = blocks.select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "rows", "floors", "vectors", "nodes")])
    pairs = blocks.join(shards.hint("shuffle_hash"), ["dim", "shard"])
    best = pairs.mapInArrow(lambda it: search_pairs(it, k), "q_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
