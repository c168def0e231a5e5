"""Autoencoder scoring as column expressions, training, and the automatic mode."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ModelFilter
from ..functions import values as V
from ..functions.scratch import materialize

# The model's input in order; the first five are temperatures in hundredths.
FEATURES = ["rtd1_t_x100", "rtd2_t_x100", "rtd3_t_x100", "rtd4_t_x100", "tmp102_t_x100", "moist_pc", "sleeper_rh"]
TEMPERATURES = 5
LEAST_ROWS = 100
CANDIDATE_FLAG = "reconstruction_outlier"


@dataclass
class Autoencoder:
    """Robust scaling, layers of (weights, bias) with tanh between them and a linear end, and thresholds of squared errors."""

    median: Sequence[float]
    iqr: Sequence[float]
    layers: list[tuple[list[list[float]], list[float]]]
    overall_threshold: float
    field_thresholds: Sequence[float]
    features: Sequence[str]
    version: str = "own"
    validated: bool = False
    given_id: str | None = None

    def __post_init__(self):
        n, width = len(self.features), len(self.features)
        if len(self.median) != n or len(self.iqr) != n or len(self.field_thresholds) != n:
            raise ValueError("scaler and thresholds must have one value per feature")
        if min(self.iqr) <= 0:
            raise ValueError("interquartile ranges must be positive")
        for w, b in self.layers:
            if len(w) != width or any(len(row) != len(b) for row in w):
                raise ValueError("layer shapes don't fit")
            width = len(b)
        if width != n:
            raise ValueError("the last layer must give one value per feature")

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump({k: list(v) if isinstance(v, tuple | list) else v for k, v in self.__dict__.items()}, f)

    @classmethod
    def load(cls, path: str, features: Sequence[str] | None = None) -> Autoencoder:
        """The package that ``save`` wrote, or a folder with ``metadata.json`` and ``weights.npz``; missing parts, or another order of ``features`` than asked for, are errors."""
        if os.path.isdir(path):
            return cls.load_folder(path, features)
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        needed = {"median", "iqr", "layers", "overall_threshold", "field_thresholds", "features", "version"}
        if not isinstance(d, dict) or needed - set(d) or (features is not None and list(d["features"]) != list(features)):
            raise ValueError("the model package is incomplete or has another order of features")
        return cls(**{**d, "layers": [(w, b) for w, b in d["layers"]]})

    @classmethod
    def load_folder(cls, path: str, features: Sequence[str] | None = None) -> Autoencoder:
        """A package of two files: metadata with scaler, thresholds by feature and the decision, and the weights ``w1``, ``b1`` and so on."""
        with open(os.path.join(path, "metadata.json"), encoding="utf-8") as f:
            d = json.load(f)
        names = d.get("feature_order")
        needed = {"model_version", "feature_order", "median", "iqr", "overall_threshold", "field_thresholds", "validation_status", "trained_at_utc"}
        if needed - set(d) or (features is not None and list(names) != list(features)):
            raise ValueError("the model package is incomplete or has another order of features")
        with np.load(os.path.join(path, "weights.npz")) as raw:
            n = len([k for k in raw.files if k.startswith("w")])
            layers = [(raw[f"w{i}"].tolist(), raw[f"b{i}"].tolist()) for i in range(1, n + 1)]
        limits = [float(d["field_thresholds"][f]) for f in names]
        return cls(d["median"], d["iqr"], layers, float(d["overall_threshold"]), limits, names, d["model_version"], d["validation_status"] == "passed", f"{d['model_version']}:{d['trained_at_utc']}")

    def save_folder(self, path: str, trained_at_utc: str, metrics: dict | None = None) -> None:
        """Write the package of two files."""
        os.makedirs(path, exist_ok=True)
        np.savez(os.path.join(path, "weights.npz"), **{f"{k}{i}": np.asarray(x) for i, layer in enumerate(self.layers, 1) for k, x in zip("wb", layer, strict=True)})
        d = {"model_version": self.version, "feature_order": list(self.features), "median": list(self.median), "iqr": list(self.iqr), "overall_threshold": self.overall_threshold}
        d |= {"field_thresholds": dict(zip(self.features, self.field_thresholds, strict=True)), "trained_at_utc": trained_at_utc, "validation_status": "passed" if self.validated else "failed", "metrics": metrics or {}}
        with open(os.path.join(path, "metadata.json"), "w", encoding="utf-8") as f:
            json.dump(d, f, indent=2)

    @property
    def package_id(self) -> str:
        return self.given_id or f"{self.version}:{hashlib.sha256(json.dumps(self.__dict__, sort_keys=True, default=list).encode()).hexdigest()[:16]}"


def scaled(model: Autoencoder, inputs: Sequence[Column]) -> list[Column]:
    return [(c - F.lit(float(m))) / F.lit(float(q)) for c, m, q in zip(inputs, model.median, model.iqr, strict=True)]


def score(df: DataFrame, model: Autoencoder, inputs: Sequence[str]) -> DataFrame:
    """Add ``errors`` (squared, per feature), ``error``, ``largest``, ``affected_fields`` and ``is_candidate``.

    Layers are materialised as array columns one after another, so no expression is unrolled twice;
    filters on the result leave them as they are. Rows with a null input get nulls and are no candidates.
    """
    df = df.withColumn("_x", F.array(*scaled(model, [F.col(c) for c in inputs])))
    at = "_x"
    for i, (w, b) in enumerate(model.layers):
        cells = []
        for j in range(len(b)):
            cell = F.lit(float(b[j]))
            for k in range(len(w)):
                cell = cell + F.element_at(at, k + 1) * F.lit(float(w[k][j]))
            cells.append(F.tanh(cell) if i < len(model.layers) - 1 else cell)
        df = df.withColumn(f"_l{i}", F.array(*cells))
        at = f"_l{i}"
    n = len(model.features)
    errors = F.zip_with("_x", at, lambda x, y: (x - y) * (x - y))
    complete = F.forall("_x", lambda x: x.isNotNull() & ~F.isnan(x))
    # an array of one: filters on what follows stay above this explode, else they would hold the layers unrolled
    df = df.withColumn("errors", F.explode(F.array(F.when(complete, errors))))
    total = F.aggregate("errors", F.lit(0.0), lambda a, x: a + x)
    part = lambda a, b: F.aggregate(F.slice("errors", a + 1, b - a), F.lit(0.0), lambda s, x: s + x) / F.lit(float(b - a))
    names, limits = F.array(*map(F.lit, model.features)), F.array(*[F.lit(float(t)) for t in model.field_thresholds])
    over = F.array_compact(F.zip_with(names, F.zip_with("errors", limits, lambda e, t: e > t), lambda name, hit: F.when(hit, name)))
    df = df.withColumns({"error": total / F.lit(float(n)), "largest": F.element_at(names, F.array_position("errors", F.array_max("errors")).cast("int")), "_over": over})
    if n > TEMPERATURES:
        df = df.withColumns({"temperature_error": part(0, TEMPERATURES), "environment_error": part(TEMPERATURES, n)})
    hit = F.coalesce((F.col("error") > model.overall_threshold) | (F.size("_over") > 0), F.lit(False))
    fields = F.when(hit, F.when(F.size("_over") > 0, F.col("_over")).otherwise(F.array("largest")))
    return df.withColumns({"is_candidate": hit, "affected_fields": fields}).drop("_x", "_over", *[f"_l{i}" for i in range(len(model.layers))])


def model_input(df: DataFrame, payload: str = "payload", family: str = "family") -> DataFrame:
    """Add ``in_<feature>`` columns and ``skip_reason`` of the first feature that fails; null where the record can be scored."""
    p = F.col(payload)
    # the numbers are read once, in a projection below
    df = df.withColumn("_inputs", F.transform_values(F.map_filter(p, lambda k, _: k.isin(FEATURES)), lambda _, v: V.model_number(v)))
    reason = F.when(F.coalesce(F.col(family), F.lit("")) != "environment", "family_not_applicable").when(p.isNull(), "missing_payload")
    made = {}
    for i, f in enumerate(FEATURES):
        x = F.col("_inputs")[f]
        reason = reason.when(x.isNull(), f"missing_or_non_numeric:{f}")
        if i >= TEMPERATURES:
            reason = reason.when((x < 0) | (x > 100), f"out_of_range:{f}")
        made[f"in_{f}"] = x / 100 if i < TEMPERATURES else x
    df = df.withColumn("skip_reason", reason)
    return df.withColumns({k: F.when(F.col("skip_reason").isNull(), v) for k, v in made.items()}).drop("_inputs")


# ---- training


def split(df: DataFrame, key: str, seed: str = "split", shares: Sequence[float] = (0.7, 0.15, 0.15)) -> DataFrame:
    """``part`` 0, 1, 2 by a hash of the key, so that a row's part never depends on other rows."""
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return df.withColumn("part", F.when(u < shares[0], 0).when(u < shares[0] + shares[1], 1).otherwise(2))


def exact_quantiles(df: DataFrame, asked: list[tuple[Column, float]], buckets: int = 1024) -> list[float | None]:
    """Quantiles with linear interpolation, exact and without gathering values.

    Each pass counts the values between two bounds by bucket, for all quantiles at once, and narrows each
    to the bucket that holds its ranks, until both ranks are the ends of neighbouring
    buckets or one value is left. At most ``buckets`` counts a quantile reach the driver. Nulls and NaN are left out.
    """
    narrow = df.select(*[F.nanvl(c.cast("double"), F.lit(None)).alias(f"v{i}") for i, (c, _) in enumerate(asked)])
    ends = narrow.agg(*[f(f"v{i}").alias(f"{n}{i}") for i in range(len(asked)) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    told: list[float | None] = [None] * len(asked)
    todo: dict[int, list] = {}
    for i, (_, q) in enumerate(asked):
        if ends[f"n{i}"]:
            at = q * (ends[f"n{i}"] - 1)
            todo[i] = [ends[f"lo{i}"], ends[f"hi{i}"], int(at), at - int(at)]  # bounds, rank within them, share of the next rank
    while todo:
        for i in [i for i, (lo, hi, _, _) in todo.items() if lo == hi]:
            told[i] = todo.pop(i)[0]
        if not todo:
            break
        rows = []
        for i, (lo, hi, _, _) in todo.items():
            v = F.col(f"v{i}")
            # halves, so that the width of no range overflows
            bucket = F.least(F.lit(buckets - 1), F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * buckets)).cast("int")
            rows.append(F.when((v >= lo) & (v <= hi), F.struct(F.lit(i).alias("i"), bucket.alias("b"), v.alias("v"))))
        counts = narrow.select(F.explode(F.array(*rows)).alias("r")).filter("r is not null").groupBy("r.i", "r.b").agg(F.count(F.lit(1)).alias("n"), F.min("r.v").alias("lo"), F.max("r.v").alias("hi"))
        by: dict[int, list] = {}
        for r in sorted(counts.collect(), key=lambda r: (r["i"], r["b"])):
            by.setdefault(r["i"], []).append(r)
        for i, own in by.items():
            rank, share = todo[i][2:]
            for k, r in enumerate(own):
                if rank < r["n"]:
                    break
                rank -= r["n"]
            if share and rank == r["n"] - 1:
                told[i] = r["hi"] + (own[k + 1]["lo"] - r["hi"]) * share
                del todo[i]
            elif not share and rank in (0, r["n"] - 1):
                told[i] = r["lo"] if rank == 0 else r["hi"]
                del todo[i]
            else:
                todo[i] = [r["lo"], r["hi"], rank, share]
    return told


def one_row(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    return df.sparkSession.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` double" for k in values))


def fit_scaler(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """One row: median and interquartile range (at least 1e-6) of each input, with linear interpolation."""
    found = iter(exact_quantiles(df, [(F.col(c), q) for c in inputs for q in (0.25, 0.5, 0.75)]))
    made = {}
    for c in inputs:
        low, mid, high = next(found), next(found), next(found)
        made |= {f"{c}_median": mid, f"{c}_iqr": None if mid is None else max(high - low, 1e-6)}
    return one_row(df, made)


def train(df: DataFrame, inputs: Sequence[str], hidden: Sequence[int] = (4, 2, 4), max_rows: int = 200_000, epochs: int = 100, patience: int = 10, batch: int = 512, rate: float = 0.01, clip: float = 5.0, seed: int = 0) -> Autoencoder:
    """Fit on rows with a ``part`` column (0 train, 1 validation).

    Minibatch descent with clipped gradients; stops after ``patience`` epochs without a better
    validation error and keeps the best weights. At most ``max_rows`` rows (by hash) of the two
    parts reach the driver; scaler and thresholds use all rows.
    """
    if df.filter("part < 2").limit(LEAST_ROWS).count() < LEAST_ROWS:
        raise ValueError(f"training needs at least {LEAST_ROWS} complete rows labelled normal")
    row = fit_scaler(df.filter("part = 0"), inputs).first()
    mid, iqr = [row[f"{c}_median"] for c in inputs], [row[f"{c}_iqr"] for c in inputs]
    count = df.filter("part < 2").count()
    # equal rows are one with a weight, so that no input that is repeated very often comes or goes as a whole
    alike = df.filter("part < 2").groupBy("part", *inputs).agg(F.count(F.lit(1)).alias("weight"))
    u = F.pmod(F.xxhash64(*inputs), F.lit(1_000_000)) / 1e6
    sample = alike.filter(u < max_rows / max(1, count)).orderBy("part", *inputs).limit(max_rows).toPandas()
    x = (sample[list(inputs)].to_numpy(float) - mid) / iqr
    is_fit, weight = (sample["part"] == 0).to_numpy(), sample["weight"].to_numpy(float)
    fit, check = x[is_fit], x[~is_fit]
    w_fit, w_check = weight[is_fit] / max(weight[is_fit].mean(), 1e-9), weight[~is_fit]
    rng = np.random.default_rng(seed)
    sizes = [len(inputs), *hidden, len(inputs)]
    w = [rng.normal(0, 1 / np.sqrt(a), (a, b)) for a, b in zip(sizes, sizes[1:], strict=False)]
    b = [np.zeros(n) for n in sizes[1:]]

    def forward(z):
        states = [z]
        for i in range(len(w)):
            z = states[-1] @ w[i] + b[i]
            states.append(np.tanh(z) if i < len(w) - 1 else z)
        return states

    best, kept, stale = np.inf, None, 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(fit)), max(1, len(fit) // batch)):
            s = forward(fit[at])
            d = 2 * (s[-1] - s[0]) * w_fit[at, None] / max(1, s[0].size)
            for i in reversed(range(len(w))):
                gw, gb = s[i].T @ d, d.sum(axis=0)
                d = (d @ w[i].T) * (1 - s[i] ** 2)
                w[i] -= rate * len(inputs) * np.clip(gw, -clip, clip)
                b[i] -= rate * len(inputs) * np.clip(gb, -clip, clip)
        loss = float(np.average(((forward(check)[-1] - check) ** 2).mean(axis=1), weights=w_check)) if len(check) else 0.0
        if loss < best:
            best, kept, stale = loss, ([x.copy() for x in w], [x.copy() for x in b]), 0
        else:
            stale += 1
            if stale >= patience:
                break
    w, b = kept or (w, b)
    free = [float("inf")] * len(inputs)
    model = Autoencoder(mid, iqr, [(a.tolist(), c.tolist()) for a, c in zip(w, b, strict=True)], float("inf"), free, list(inputs))
    limits = error_thresholds(score(df.filter("part = 1"), model, inputs), len(inputs)).first()
    return Autoencoder(mid, iqr, model.layers, limits["overall"], [limits[f"field_{i}"] for i in range(len(inputs))], list(inputs))


def error_thresholds(scored: DataFrame, n: int, overall: float = 0.99, per_field: float = 0.995) -> DataFrame:
    """One row: the quantile of the mean errors and those of each field's errors."""
    asked = [(F.col("error"), overall), *[(F.element_at("errors", i + 1), per_field) for i in range(n)]]
    return one_row(scored, dict(zip(["overall", *[f"field_{i}" for i in range(n)]], exact_quantiles(scored, asked), strict=True)))


def evaluate(scored: DataFrame, label: str, kind: str) -> DataFrame:
    """Candidate rate of normal rows (label 0, kind null) and recall by anomaly type."""
    name = F.when(F.col(label) == 0, "normal").otherwise(F.col(kind))
    return scored.groupBy(name.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("is_candidate").cast("double")).alias("candidate_rate"))


# ---- automatic mode


@dataclass
class ModeState:
    """What the automatic mode keeps between runs: mode and reason, scored records, and the last answers of whether a record was complete and a candidate."""

    package_id: str | None = None
    effective_mode: str = "shadow"
    reason: str = "initial_shadow"
    valid: int = 0
    complete: list[bool] = field(default_factory=list)
    candidates: list[bool] = field(default_factory=list)
    failures: int = 0

    def dump(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)

    @classmethod
    def load(cls, text: str | None) -> ModeState:
        return cls(**json.loads(text)) if text else cls()

    def for_package(self, package_id: str | None) -> ModeState:
        """The state at the start of a run: another package starts anew."""
        return self if self.package_id == package_id else ModeState(package_id, reason="model_package_changed")

    def after(self, part: ModeState, most: int) -> ModeState:
        """This state, then what ``part`` has gathered from none; modes are left as they are here."""
        failures = part.failures + (0 if part.valid else self.failures)
        return ModeState(self.package_id, self.effective_mode, self.reason, self.valid + part.valid, [*self.complete, *part.complete][-most:], [*self.candidates, *part.candidates][-most:], failures)


def decide(effective: str, valid: int, failures: int, complete: list[bool], candidates: list[bool], m: ModelFilter, validated: bool, events: bool) -> tuple[str, str]:
    """The next mode and why. The first reason that holds counts; rates of an empty tail are 0. Reasons are fixed values."""

    def tail(values: list[bool], n: int) -> float:
        last = values[-n:]
        return sum(last) / len(last) if last else 0.0

    enforcing = effective == "enforce"
    reasons = [
        (not validated, "model_validation_not_passed"), (failures > 0, "model_failure"),
        (enforcing and tail(candidates, m.fallback_window) > m.fallback_candidate_rate, "candidate_rate_above_20_percent"),
        (enforcing and tail(complete, m.fallback_window) < m.fallback_input_completeness, "input_completeness_below_90_percent"),
        (valid < m.minimum_valid_records, f"waiting_for_{m.minimum_valid_records}_valid_records"), (not events, "event_confirmation_disabled"),
        (len(complete) < m.readiness_window or tail(complete, m.readiness_window) < m.minimum_input_completeness, "input_completeness_below_95_percent"),
        (tail(candidates, m.readiness_window) > m.maximum_candidate_rate, "candidate_rate_above_10_percent"),
    ]
    return next((("shadow", why) for hit, why in reasons if hit), ("enforce", "readiness_requirements_met"))


PART_ROWS = 1_000_000


def auto_modes(series: DataFrame, m: ModelFilter, validated: bool, events: bool, keys: Sequence[str] = ("seq",), state: ModeState | None = None, package_id: str | None = None) -> tuple[DataFrame, ModeState]:
    """((keys, effective_mode, reason) after each row of (keys, complete, candidate) in order of the keys, the state for the next run).

    ``complete`` null: the record says nothing about the model (another family or a duplicate); ``candidate`` null: it was
    not scored; ``failed``, if there is such a column: scoring it failed. Invalid records must be left out before. The mode is one chain over
    all records, but it needs only the last answers and one of two modes of what lies before. So ranges of
    the keys are summed up in parallel, then folded for either mode that they may start in, and the driver joins the
    ranges' ends, a few hundred answers for each range of ``PART_ROWS`` rows.
    """
    most = max(m.readiness_window, m.fallback_window)
    begun = (state or ModeState(package_id)).for_package(package_id)
    begun.effective_mode, begun.reason = decide(begun.effective_mode, begun.valid, begun.failures, begun.complete, begun.candidates, m, validated, events)
    flag = lambda c: (F.col(c) if c in series.columns else F.lit(None)).cast("int").alias(c)
    narrow = series.select(*keys, flag("complete"), flag("candidate"), flag("failed"))
    parts = max(1, -(-narrow.count() // PART_ROWS))
    rows = materialize(narrow.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()), "auto-series")
    kinds = ", ".join(f"{k} {narrow.schema[k].dataType.simpleString()}" for k in keys)

    def step(s: ModeState, complete, candidate, failed) -> None:
        if complete is not None and complete == complete:
            s.complete.append(bool(complete))
        if failed is not None and failed == failed and failed:
            s.failures += 1
        if candidate is not None and candidate == candidate:
            s.candidates.append(bool(candidate))
            s.valid, s.failures = s.valid + 1, 0
        del s.complete[:-most], s.candidates[:-most]

    def answers(pdf):
        return zip(*(pdf[c].astype(object).where(pdf[c].notna(), None) for c in ("complete", "candidate", "failed")), strict=True)

    def summary(pdf):
        s = ModeState()
        for x in answers(pdf.sort_values(list(keys))):
            step(s, *x)
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "state": [s.dump()]})

    def fold(pdf, s: ModeState):
        for x in answers(pdf):
            step(s, *x)
            s.effective_mode, s.reason = decide(s.effective_mode, s.valid, s.failures, s.complete, s.candidates, m, validated, events)
            yield s.effective_mode, s.reason

    starts: dict[int, ModeState] = {}
    now = begun
    for r in rows.groupBy("part").applyInPandas(summary, "part int, state string").orderBy("part").collect():
        starts[r["part"]] = now
        now = now.after(ModeState.load(r["state"]), most)

    def ends(pdf):
        part, pdf = pdf["part"].iloc[0], pdf.sort_values(list(keys))
        made = []
        for mode in ("shadow", "enforce"):
            s = ModeState.load(starts[part].dump())
            s.effective_mode = mode
            for _ in fold(pdf, s):
                pass
            made.append(s.dump())
        return pd.DataFrame({"part": [part], "shadow": [made[0]], "enforce": [made[1]]})

    mode = begun.effective_mode
    last = begun
    for r in rows.groupBy("part").applyInPandas(ends, "part int, shadow string, enforce string").orderBy("part").collect():
        starts[r["part"]] = ModeState(**{**starts[r["part"]].__dict__, "effective_mode": mode})
        last = ModeState.load(r[mode])
        mode = last.effective_mode

    def modes(pdf):
        part, pdf = pdf["part"].iloc[0], pdf.sort_values(list(keys))
        told = list(fold(pdf, ModeState.load(starts[part].dump())))
        return pdf[list(keys)].assign(effective_mode=[x for x, _ in told], reason=[x for _, x in told])

    return rows.groupBy("part").applyInPandas(modes, f"{kinds}, effective_mode string, reason string"), last
