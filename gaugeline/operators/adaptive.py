"""History rules that need no feedback, as windows over a device's records.

Where accepting a value depends on the rule's own outcome, use ``scan``: the two give different
results on purpose and have different names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import values as V


def by_time(keys: Sequence[str], order: Sequence[str] = ("ts_us", "record_id")) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def rolling_baseline(df: DataFrame, value: str, keys: Sequence[str] = ("device_id",), window: int = 20, min_samples: int = 10, threshold: float = 3.5, minimum_scale: float | None = None, epsilon: float = 1e-6) -> DataFrame:
    """Median and MAD of up to ``window`` values before the row; score and whether it exceeds ``threshold``.

    With ``minimum_scale`` the scale is max(1.4826 MAD, minimum_scale), else max(MAD, epsilon) / 0.6745.
    ``is_cold`` marks rows with fewer than ``min_samples`` values before them; they have no score.
    """
    history = F.collect_list(V.finite(F.col(value))).over(by_time(keys).rowsBetween(-window, -1))
    df = df.withColumn("_history", F.sort_array(history))
    df = df.withColumn("history_samples", F.size("_history")).withColumn("is_cold", F.col("history_samples") < min_samples)
    df = df.withColumn("rolling_median", F.when(~F.col("is_cold"), V.median(F.col("_history"))))
    df = df.withColumn("mad", F.when(~F.col("is_cold"), V.mad_of(F.col("_history"), F.col("rolling_median"))))
    scale = F.greatest(1.4826 * F.col("mad"), F.lit(float(minimum_scale))) if minimum_scale is not None else F.greatest(F.col("mad"), F.lit(epsilon)) / 0.6745
    df = df.withColumn("score", F.abs(V.finite(F.col(value)) - F.col("rolling_median")) / scale)
    return df.withColumn("is_candidate", V.above(F.col("score"), threshold)).drop("_history")


def gap_allowed(elapsed: Column, least: float | None, most: float | None) -> Column:
    """Not negative and within the inclusive bounds that are set; false for null."""
    ok = elapsed >= 0
    if least is not None:
        ok = ok & (elapsed >= least)
    if most is not None:
        ok = ok & (elapsed <= most)
    return F.coalesce(ok, F.lit(False))


def changes(df: DataFrame, value: str, keys: Sequence[str] = ("device_id",), step: float | None = None, rate: float | None = None, least_gap: float | None = None, most_gap: float | None = None) -> DataFrame:
    """Step and rate against the row before: ``elapsed``, ``step``, ``rate``, ``gap_ok``, ``is_step``, ``is_rate``."""
    w = by_time(keys)
    df = df.withColumns({"elapsed": (F.col("ts_us") - F.lag("ts_us").over(w)) / F.lit(1e6), "step": F.abs(F.col(value) - F.lag(value).over(w))})
    df = df.withColumn("gap_ok", gap_allowed(F.col("elapsed"), least_gap, most_gap))
    df = df.withColumn("rate", F.when(F.col("gap_ok") & (F.col("elapsed") > 0), F.col("step") / F.col("elapsed")))
    is_step = F.col("gap_ok") & V.above(F.col("step"), step) if step is not None else F.lit(False)
    return df.withColumns({"is_step": is_step, "is_rate": V.above(F.col("rate"), rate) if rate is not None else F.lit(False)})


def stuck_exact(df: DataFrame, value: str, keys: Sequence[str] = ("device_id",), samples: int = 3, seconds: float | None = None) -> DataFrame:
    """Runs of equal values (tolerance 0): ``run_count``, ``run_elapsed`` and ``is_stuck`` from the ``samples``-th on."""
    w = by_time(keys)
    new = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)), 0).otherwise(1)
    df = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*keys, "_run").orderBy("ts_us", "record_id")
    df = df.withColumns({"run_count": F.row_number().over(inside), "run_elapsed": (F.col("ts_us") - F.first("ts_us").over(inside)) / F.lit(1e6)})
    ok = F.col("run_count") >= samples
    if seconds is not None:
        ok = ok & (F.col("run_elapsed") >= seconds)
    return df.withColumn("is_stuck", ok).drop("_new", "_run")


def reporting_gap(df: DataFrame, interval: float, multiplier: float) -> DataFrame:
    """Time since the family's last report before the row's time; ``is_gap`` above interval x multiplier. Rows of equal time don't see each other."""
    w = Window.partitionBy("device_id", "family").orderBy("ts_us").rangeBetween(Window.unboundedPreceding, -1)
    elapsed = (F.col("ts_us") - F.max("ts_us").over(w)) / F.lit(1e6)
    return df.withColumn("elapsed", elapsed).withColumn("is_gap", V.above(F.col("elapsed"), interval * multiplier))


def family_silence(df: DataFrame, silent: str, interval: float, multiplier: float) -> DataFrame:
    """The first row of another family that finds ``silent`` overdue, once for each last report of it."""
    w = Window.partitionBy("device_id").orderBy("ts_us").rangeBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("last_seen_us", F.max(F.when(F.col("family") == silent, F.col("ts_us"))).over(w))
    df = df.withColumn("elapsed", (F.col("ts_us") - F.col("last_seen_us")) / F.lit(1e6))
    late = df.filter((F.col("family") != silent) & (F.col("elapsed") > interval * multiplier))
    nth = F.row_number().over(Window.partitionBy("device_id", "last_seen_us").orderBy("ts_us", "record_id"))
    return late.withColumn("_nth", nth).filter(F.col("_nth") == 1).drop("_nth").withColumn("silent_family", F.lit(silent))
