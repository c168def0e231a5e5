"""Training the autoencoder on all rows: exact split, data-parallel descent, and the decision on a trained model.

No row reaches the driver. Every step is a job over the written, scaled rows: tasks add up the loss and its
gradient over their rows in numpy, Spark sums them by parameter, and the driver, which holds the model's few parameters
and the last steps, chooses the next ones (limited-memory quasi-Newton steps with a backtracking line search).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import discard, materialize
from .model import LEAST_ROWS, Autoencoder, error_thresholds, fit_scaler, score

BITS, HASH_BITS = 12, 60
NORMAL_RATE, RECALL = 0.02, 0.90


# ---- exact split


def hash_of(seed: str, key: Column) -> Column:
    """60 bits of a digest of the seed and the key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), 1, HASH_BITS // 4), 16, 10).cast("long")


def value_at_ranks(rows: DataFrame, column: str, ranks: Sequence[int], bits: int) -> list[tuple[int, int]]:
    """For each rank (from 0) the value of a non-negative column that stands there in ascending order, and how many rows lie below it.

    Nested histograms: each pass counts the rows of the buckets that hold the ranks by their next BITS bits; at most
    2 ** BITS counts a rank reach the driver and no rows are sorted.
    """
    found = [(0, 0, 0, bits) for _ in ranks]  # bucket's prefix, rows below it, -, bits left
    while any(left for *_, left in found):
        left = max(left for *_, left in found)
        step = min(BITS, left)
        prefixes = sorted({p for p, *_ in found})
        inside = F.shiftright(column, left).isin(prefixes) if left < bits else F.lit(True)
        counts: dict[int, list] = {}
        for r in rows.filter(inside).groupBy(F.shiftright(column, left - step).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["b"] >> step, []).append((r["b"], r["n"]))
        for i, (prefix, below, _, _) in enumerate(found):
            for b, n in sorted(counts[prefix]):
                if ranks[i] < below + n:
                    break
                below += n
            found[i] = b, below, 0, left - step
    return [(prefix, below) for prefix, below, *_ in found]


def exact_split(df: DataFrame, key: str, seed: str = "split", shares: Sequence[float] = (0.7, 0.15)) -> DataFrame:
    """``part`` 0, 1, 2, ...: of n rows the first part has ``int(n * shares[0])``, each further one ends at ``int(n *`` the shares up to it ``)``, the last one has the rest.

    Rows are dealt by the rank of a hash of seed and key, found by nested histograms. Rows of one key (null is a key) that lie on an edge
    are told apart by their place in the written input, so sizes are exact for any keys. An empty table gives an empty result.
    """
    rows = materialize(df.withColumns({"_h": hash_of(seed, F.col(key)), "_id": F.monotonically_increasing_id()}), "split-rows")
    n = rows.count()
    ends = [min(n, int(n * share)) for share in np.cumsum(shares).round(12).tolist()]
    part = F.lit(0)
    for end in ends:
        if end >= n:
            continue
        ((h, below),) = value_at_ranks(rows, "_h", [end], HASH_BITS)
        tied = rows.filter(F.col("_h") == h)
        ((first, _),) = value_at_ranks(tied, "_id", [end - below], 63)
        part = part + F.when((F.col("_h") > h) | ((F.col("_h") == h) & (F.col("_id") >= first)), 1).otherwise(0)
    return rows.withColumn("part", part).drop("_h", "_id")


# ---- descent


class Net:
    """Layers as one vector of parameters, with tanh between them and a linear end."""

    def __init__(self, sizes: Sequence[int]):
        self.shapes = [s for a, b in zip(sizes, sizes[1:], strict=False) for s in ((a, b), (b,))]
        self.ends = np.cumsum([int(np.prod(s)) for s in self.shapes])

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return np.concatenate([rng.normal(0, 1 / np.sqrt(s[0]), s).reshape(-1) if len(s) == 2 else np.zeros(s) for s in self.shapes])

    def layers(self, p: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        cut = [x.reshape(s) for x, s in zip(np.split(p, self.ends[:-1]), self.shapes, strict=True)]
        return list(zip(cut[::2], cut[1::2], strict=True))

    def loss(self, p: np.ndarray, x: np.ndarray, slope: bool) -> tuple[float, np.ndarray | None]:
        """Sum over rows of the mean squared error, and its gradient."""
        layers, states = self.layers(p), [x]
        for i, (w, b) in enumerate(layers):
            z = states[-1] @ w + b
            states.append(np.tanh(z) if i < len(layers) - 1 else z)
        off = states[-1] - x
        total = float((off * off).sum()) / x.shape[1]
        if not slope:
            return total, None
        d, parts = 2 * off / x.shape[1], []
        for i in reversed(range(len(layers))):
            parts += [d.sum(axis=0), (states[i].T @ d).reshape(-1)]
            d = (d @ layers[i][0].T) * (1 - states[i] ** 2)
        return total, np.concatenate(parts[::-1])


def summed(rows: DataFrame, net: Net, p: np.ndarray) -> tuple[float, np.ndarray, float]:
    """One pass: the mean loss of the first part, its gradient, and the mean loss of the second, added up in tasks and then by Spark."""
    n = len(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n + 4)
        for batch in batches:
            part = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            for k in (0, 1):
                own = x[part == k]
                if len(own):
                    loss, slope = net.loss(p, own, k == 0)
                    total[n + 2 * k : n + 2 * k + 2] += len(own), loss
                    if slope is not None:
                        total[:n] += slope
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n + 4, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    got = rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(n + 4)
    for r in got:
        total[r["i"]] = r["v"]
    fit, check = max(total[n], 1.0), max(total[n + 2], 1.0)
    return total[n + 1] / fit, total[:n] / fit, total[n + 3] / check


def direction(slope: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton direction from the last (step, change of the gradient)."""
    q, used = slope.copy(), []
    for s, y in reversed(steps):
        a = s @ q / (y @ s)
        q -= a * y
        used.append(a)
    if steps:
        s, y = steps[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(steps, reversed(used), strict=True):
        q += s * (a - y @ q / (y @ s))
    return -q


def descend(rows: DataFrame, net: Net, p: np.ndarray, steps: int, patience: int, memory: int = 10) -> tuple[np.ndarray, float]:
    """Parameters with the least validation loss seen, and that loss. Stops after ``patience`` steps without a better one, or where no step lowers the loss."""
    loss, slope, check = summed(rows, net, p)
    best, kept, stale, past = check, p, 0, []
    for _ in range(steps):
        way = direction(slope, past)
        if way @ slope >= 0:
            way, past = -slope, []
        rate = 1.0 if past else min(1.0, 1.0 / max(np.abs(slope).sum(), 1e-12))
        for _ in range(20):
            then = p + rate * way
            new_loss, new_slope, new_check = summed(rows, net, then)
            if new_loss <= loss + 1e-4 * rate * (way @ slope):
                break
            rate /= 3
        else:
            break
        change = new_slope - slope
        if change @ (then - p) > 1e-12:
            past = [*past, (then - p, change)][-memory:]
        done = loss - new_loss <= 1e-9 * max(loss, 1e-12)
        p, loss, slope = then, new_loss, new_slope
        if new_check < best:
            best, kept, stale = new_check, p, 0
        else:
            stale += 1
        if stale >= patience or done:
            break
    return kept, best


def train_parallel(df: DataFrame, inputs: Sequence[str], hidden: Sequence[int] = (4, 2, 4), steps: int = 150, patience: int = 10, seed: int = 0, version: str = "own") -> tuple[Autoencoder, float]:
    """Fit on all rows of ``part`` 0 (train) and 1 (validation): the model with thresholds, and its validation loss.

    Rows with a null or non-finite input are left out. Repeated rows count as often as they are there; a hot value costs its rows and
    moves nothing, as rows aren't shuffled. ``steps`` passes, each a scan of the scaled inputs.
    """
    finite = F.col("part").isin(0, 1)
    for c in inputs:
        finite = finite & F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < float("inf"))
    complete = df.filter(finite)
    if complete.filter("part = 0").limit(LEAST_ROWS).count() < LEAST_ROWS:
        raise ValueError(f"training needs at least {LEAST_ROWS} complete rows labelled normal")
    row = fit_scaler(complete.filter("part = 0"), inputs).first()
    mid, iqr = [row[f"{c}_median"] for c in inputs], [row[f"{c}_iqr"] for c in inputs]
    narrow = complete.select(F.col("part").cast("int").alias("part"), *[((F.col(c).cast("double") - m) / q).alias(f"x{i}") for i, (c, m, q) in enumerate(zip(inputs, mid, iqr, strict=True))])
    narrow = materialize(narrow, "training-rows")
    net = Net([len(inputs), *hidden, len(inputs)])
    p, best = descend(narrow, net, net.start(seed), steps, patience)
    discard(narrow)
    free = Autoencoder(mid, iqr, [(w.tolist(), b.tolist()) for w, b in net.layers(p)], float("inf"), [float("inf")] * len(inputs), list(inputs), version)
    limits = error_thresholds(score(complete.filter("part = 1"), free, inputs), len(inputs)).first()
    return replace(free, overall_threshold=limits["overall"], field_thresholds=[limits[f"field_{i}"] for i in range(len(inputs))]), best


# ---- decision


def judged(model: Autoencoder, tests: DataFrame, inputs: Sequence[str], label: str = "label", detector: str = "detector", kind: str = "kind") -> tuple[Autoencoder, dict]:
    """The model with ``validated`` set or not, and the figures: candidate rate of normal rows (label 0) at most NORMAL_RATE, and at
    least RECALL of the anomalies (label 1) that are meant for this model (``detector`` is ``autoencoder``); recall by ``kind`` (null: ``unknown``). Without such
    anomalies the recall counts as 0."""
    scored = score(tests, model, inputs)
    hit = F.col("is_candidate").cast("double")
    normal, meant = F.col(label) == 0, (F.col(label) == 1) & (F.col(detector) == "autoencoder")
    rate, recall = scored.agg(F.avg(F.when(normal, hit)), F.avg(F.when(meant, hit))).first()
    name = F.when(F.coalesce(F.col(kind), F.lit("")) == "", "unknown").otherwise(F.col(kind))
    by = {r["kind"]: r["r"] for r in scored.filter(F.col(label) == 1).groupBy(name.alias("kind")).agg(F.avg(hit).alias("r")).collect()}
    figures = {"test_normal_candidate_rate": rate, "autoencoder_anomaly_recall": recall or 0.0, "recall_by_anomaly_type": by}
    passed = rate is not None and rate <= NORMAL_RATE and (recall or 0.0) >= RECALL
    return replace(model, validated=passed), figures
