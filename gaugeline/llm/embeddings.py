"""Near-duplicate vectors: small-world graphs per shard, verified links, components.

Equal vectors are one class. Classes are dealt to shards by hash; each shard's graph is
built once, audited with moved copies of its own vectors and written with the beam that it
needs. Each pair of shards meets in one task, where both graphs are queried with the vectors of
the other shard, from that beam on, wider until recall audits pass, and exactly where none does.
Candidates of both directions are united and verified in double precision. A task gives
no links but a count for each vector and a spanning forest, so a group of many near copies costs as
many rows as it has vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import materialize, named
from .graph import components
from .hnsw import DEGREE, QUERY_BATCH, Graph, audited_beam, exact_query, graph_beam, true_links

SHARDS, SHARD_ROWS, SHARD_BYTES = 8, 16_384, 1 << 24
INDEX = "dim int, shard int, n int, beam int, ids binary, sizes binary, vectors binary, layers array<binary>"
SLACK = 1e-4
COUNT, EDGE, AUDIT = range(3)


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision; scaled first, so that no square overflows."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def stack(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def build_index(shard: pa.Table, least: float, beam: int, audit: int, target: float) -> pa.Table:
    """One row with the graph of a shard's vectors (dim, shard, uid, n, vector) and its beam."""
    shard = shard.sort_by("uid")
    ids, dim = shard["uid"].to_numpy(), shard["dim"][0].as_py()
    order = np.random.default_rng(0).permutation(len(ids))
    vectors = stack(shard["vector"], dim)[order]
    graph = Graph.build(unit(vectors))
    beam = graph_beam(graph, least - SLACK, beam, audit, target)
    single = vectors.astype("<f4")
    kept = single if (single == vectors).all() else vectors.astype("<f8")
    row = {"dim": dim, "shard": shard["shard"][0].as_py(), "n": len(ids), "beam": beam, "ids": ids[order].astype("<i8").tobytes(), "sizes": shard["n"].to_numpy()[order].astype("<i8").tobytes(), "vectors": kept.tobytes(), "layers": [near.astype("<i4").tobytes() for near in graph.layers]}
    return pa.Table.from_pylist([row], schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("beam", pa.int32()), ("ids", pa.binary()), ("sizes", pa.binary()), ("vectors", pa.binary()), ("layers", pa.list_(pa.binary()))]))


class Shard:
    """A written shard: ids, class sizes, vectors in double precision, and the graph of their unit vectors."""

    def __init__(self, r: dict, prefix: str = ""):
        self.ids, self.sizes = (np.frombuffer(r[prefix + c], "<i8") for c in ("ids", "sizes"))
        self.beam, n = r[prefix + "beam"], len(self.ids)
        raw = r[prefix + "vectors"]
        self.x = np.frombuffer(raw, "<f4" if len(raw) == 4 * n * r["dim"] else "<f8").reshape(n, -1).astype(np.float64)
        self.graph = Graph(unit(self.x), [np.frombuffer(b, "<i4").reshape(-1, DEGREE).astype(np.int64) for b in r[prefix + "layers"]])
        self.x /= np.abs(self.x).max(axis=1, keepdims=True)
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))


def candidates(host: Shard, guest: Shard, same: bool, least: float, audit: int, target: float) -> np.ndarray:
    """Bits (guests, hosts packed by eight) of the pairs that one of the two graphs finds; of a shard with itself, both ways."""
    bits = np.zeros((len(guest.ids), -(-len(host.ids) // 8)), np.uint8)
    for own, asked in ((host, guest), (guest, host))[: 1 if same else 2]:
        q = asked.graph.x
        beam = audited_beam(own.graph, q, least, own.beam, audit, target, same)
        for i in range(0, len(q), QUERY_BATCH):
            part = q[i : i + QUERY_BATCH]
            mask = np.zeros((len(part), len(own.ids)), bool)
            mask[own.graph.query(part, least, beam) if beam else exact_query(own.graph, part, least)] = True
            if same:
                mask[np.arange(len(part)), np.arange(i, i + len(part))] = False
            if own is host:
                bits[i : i + QUERY_BATCH] |= np.packbits(mask, axis=1)
            if own is guest or same:
                packed = np.packbits(mask.T, axis=1)
                bits[:, i // 8 : i // 8 + packed.shape[1]] |= packed
    return bits


def pair_rows(host: Shard, guest: Shard, same: bool, least: float, audit: int, target: float) -> list[np.ndarray]:
    """Rows (kind, a, b): the links of each vector weighted by class sizes, a spanning forest of the links, and the audit's true and found links."""
    bits = candidates(host, guest, same, least - SLACK, audit, target)
    unpacked = lambda rows: np.unpackbits(bits[rows], axis=1, count=len(host.ids))
    probe = np.unique(np.linspace(0, len(guest.ids) - 1, min(audit, len(guest.ids))).astype(int))
    truth = true_links(host.graph, guest.graph.x[probe], least + SLACK, probe if same else None)
    edges, audited = [np.empty((0, 2), np.int64)], [[int(truth.sum()), int((truth & unpacked(probe).astype(bool)).sum())]]
    n_host, n_guest, part = np.zeros(len(host.ids)), np.zeros(len(guest.ids)), np.arange(len(host.ids))
    for i in range(0, len(guest.ids), QUERY_BATCH):
        r, c = np.nonzero(unpacked(slice(i, i + QUERY_BATCH)))
        r, ok = r + i, np.zeros(len(r), bool)
        for at in range(0, len(r), 1 << 16):
            u, v = r[at : at + (1 << 16)], c[at : at + (1 << 16)]
            ok[at : at + (1 << 16)] = np.einsum("ij,ij->i", guest.x[u], host.x[v]) / (guest.norm[u] * host.norm[v]) >= least
        r, c = r[ok], c[ok]
        if not len(r):
            continue
        n_guest += np.bincount(r, host.sizes[c], len(guest.ids))
        n_host += np.bincount(c, guest.sizes[r], len(host.ids))
        for near in np.split(np.arange(len(r)), np.flatnonzero(np.diff(r)) + 1):
            g, near = r[near[0]], c[near]
            labels, first = np.unique(part[near], return_index=True)
            if same:
                first, labels = first[labels != part[g]], np.union1d(labels, part[g])
            edges.append(np.stack((np.full(len(first), guest.ids[g]), host.ids[near[first]]), axis=1))
            if len(labels) > 1:
                part[np.isin(part, labels)] = labels[0]
    counts = [(guest.ids, n_guest)] if same else [(guest.ids, n_guest), (host.ids, n_host)]
    rows = [(COUNT, np.stack((ids[n > 0], n[n > 0].astype(np.int64)), axis=1)) for ids, n in counts] + [(EDGE, np.concatenate(edges)), (AUDIT, np.array(audited))]
    return [np.concatenate((np.full((len(x), 1), kind), x), axis=1) for kind, x in rows]


def query_pairs(batches: Iterator[pa.RecordBatch], least: float, audit: int, target: float) -> Iterator[pa.RecordBatch]:
    """Rows (kind, a, b) of each pair of shards."""
    for batch in batches:
        for i in range(len(batch)):
            r = batch.slice(i, 1).to_pylist()[0]
            same = r["shard"] == r["g_shard"]
            host = Shard(r)
            for x in pair_rows(host, host if same else Shard(r, "g_"), same, least, audit, target):
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].astype(np.int32)), pa.array(x[:, 1]), pa.array(x[:, 2])], names=["kind", "a", "b"])


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, shards: int | None = None, beam: int = 24, audit: int = 128, target: float = 0.99, report: dict | None = None) -> DataFrame:
    """Links of cosine ``least`` or more, and their components, for every row.

    Result: ``key`` (under its own name), ``n_links`` (other rows linked directly), ``component_id``
    (smallest key reachable, its own included) and ``kept`` (``key = component_id``). Rows with equal
    vectors are linked with each other. Vectors that are null, empty, zero, or hold null or
    non-finite components are linked with nothing and keep their own key; so are vectors of different
    lengths among each other. Null keys sort after all others; repeated rows are rows of their
    own; an empty table gives an empty result. Other columns are not carried.

    The number of shards is at least 8 and grows so that a shard holds about ``SHARD_ROWS``
    different vectors and ``SHARD_BYTES``, which bounds the memory of a task. ``report`` gets the audit over
    all pairs of shards: the ``true`` links of the probes, without a vector's link to itself, and how many of them were ``found``.
    """
    x = named(vector)
    if df.select(x).schema[0].dataType != ArrayType(FloatType()):
        x = x.cast("array<double>")
    fit = usable(x) & F.exists(x, lambda v: v != 0)
    # equal vectors meet by 128 bits of hash, so that whole vectors are moved once for their class and never for the rows
    row = [F.when(fit, F.xxhash64(x, F.lit(1))).alias("h1"), F.when(fit, F.xxhash64(F.lit(2), x)).alias("h2")]
    own_key = named(key)
    one = F.struct(own_key.isNull().alias("late"), own_key.alias("key"))
    classes = df.select(*row, one.alias("one"), x.alias("vector")).filter("h1 is not null").groupBy("h1", "h2").agg(F.min("one").alias("one"), F.count(F.lit(1)).alias("n"), F.any_value("vector").alias("vector"))
    classes = materialize(classes.select("h1", "h2", "one.*", "n", F.monotonically_increasing_id().alias("uid"), F.size("vector").alias("dim"), "vector"), "vector-classes")

    sizes = classes.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    parts = shards or max(SHARDS, -(-sizes["n"] // max(1, min(SHARD_ROWS, SHARD_BYTES // (4 * (sizes["dim"] or 1))))))
    dealt = classes.select("dim", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int").alias("shard"), "uid", "n", "vector")
    index = materialize(dealt.groupBy("dim", "shard").applyInArrow(lambda t: build_index(t, least, beam, audit, target), INDEX), "vector-index")
    # a shard is the guest of itself and of the half of all shards before it in a circle, so each pair meets once
    turn = F.pmod(F.col("shard") - F.col("back"), F.lit(parts))
    once = (F.col("back") * 2 < parts) | (turn < F.col("shard"))
    guests = index.withColumn("back", F.explode(F.sequence(F.lit(0), F.lit(parts // 2)))).filter(once)
    guests = guests.select("dim", turn.alias("shard"), *[F.col(c).alias(f"g_{c}") for c in index.columns if c != "dim"])
    # as many partitions on both sides, so that pairs meet without another exchange and few hosts share a task
    spots = 4 * parts
    both = guests.repartition(spots, "dim", "shard").join(index.repartition(spots, "dim", "shard").hint("shuffle_hash"), ["dim", "shard"])
    found = materialize(both.mapInArrow(lambda rows: query_pairs(rows, least, audit, target), "kind int, a long, b long"), "vector-links")
    if report is not None:
        seen = found.filter(F.col("kind") == AUDIT).agg(F.coalesce(F.sum("a"), F.lit(0)).alias("true"), F.coalesce(F.sum("b"), F.lit(0)).alias("found")).first()
        report.update(seen.asDict())

    degree = found.filter(F.col("kind") == COUNT).groupBy(F.col("a").alias("uid")).agg(F.sum("b").alias("far"))
    joined = components(found.filter(F.col("kind") == EDGE)).withColumnRenamed("v", "uid")
    told = classes.select("uid", "h1", "h2", "late", "key", "n").join(joined, "uid", "left").join(degree, "uid", "left")
    told = materialize(told.select("h1", "h2", "late", "key", F.coalesce("c", "uid").alias("part"), (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links")), "vector-told")
    # written first, so that the join sits on two exchanges and Spark splits the tasks of a large component
    least_key = materialize(told.groupBy("part").agg(F.min(F.struct("late", "key")).alias("m")).select("part", F.col("m.key").alias("component_id")), "vector-heads")
    told = materialize(told.join(least_key, "part").select("h1", "h2", "n_links", "component_id"), "vector-parts")
    out = df.select(*row, own_key.alias("key")).join(told, ["h1", "h2"], "left")
    part = F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), part.alias("component_id"), F.col("key").eqNullSafe(part).alias("kept"))
