"""Comparisons within a record and with the newest trusted record of another family."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V


def peer_spread(df: DataFrame, values: dict[str, Column], groups: Sequence[Sequence[str]] = (), scales: dict[str, float] | None = None, least: int = 2) -> DataFrame:
    """Add ``sensors`` (number), ``centre`` (median) and ``spread`` (largest distance from it) over scaled values; fields of a group count once, the first that is present.

    Each step is a projection of its own, so that nothing is sorted twice. Fewer than ``least`` sensors have neither centre nor spread.
    """
    scales = scales or {}
    scaled = {f: V.finite(c) * F.lit(float(scales.get(f, 1.0))) for f, c in values.items()}
    grouped = {f for g in groups for f in g}
    sensors = [F.coalesce(*[scaled[f] for f in g if f in scaled]) for g in groups if any(f in scaled for f in g)]
    sensors += [c for f, c in scaled.items() if f not in grouped]
    n = F.lit(0)
    for i in range(len(sensors)):
        n = n + F.when(F.col(f"_{i}").isNotNull(), 1).otherwise(0)
    df = df.withColumns({f"_{i}": c for i, c in enumerate(sensors)})
    # nulls sort to the end, where the median does not look
    df = df.withColumns({"sensors": n, "_sorted": F.sort_array(F.array(*[F.coalesce(F.col(f"_{i}"), F.lit(float("inf"))) for i in range(len(sensors))]))})
    low, high = F.element_at("_sorted", ((F.col("sensors") + 1) / 2).cast("int")), F.element_at("_sorted", (F.col("sensors") / 2 + 1).cast("int"))
    enough = (F.col("sensors") >= least) & (F.col("sensors") > 0)
    df = df.withColumn("centre", F.when(enough, (low + high) / 2))
    spread = F.greatest(*[F.abs(F.col(f"_{i}") - F.col("centre")) for i in range(len(sensors))], F.lit(None).cast("double"))
    return df.withColumn("spread", spread).drop("_sorted", *[f"_{i}" for i in range(len(sensors))])


def cross_field(a: Column, b: Column, limit: float, scale_a: float = 1.0, scale_b: float = 1.0) -> tuple[Column, Column]:
    """(difference of the scaled values, whether it exceeds the limit)."""
    d = F.abs(V.finite(a) * scale_a - V.finite(b) * scale_b)
    return d, V.above(d, limit)


def latest_trusted(df: DataFrame, family: str, fields: Sequence[str], trusted: Column, prefix: str, time: str = "ts_us", seq: str = "seq") -> DataFrame:
    """Add the newest trusted record of ``family`` on the same device, not later than the row's time.

    Rows of equal time see each other, whatever their order; the last by ``seq`` wins. This is the
    form without feedback: trust must not depend on the outcome of the comparison.
    """
    w = Window.partitionBy("device_id").orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.struct(F.col(time).alias("at"), F.col(seq).alias("seq"), *[F.col(f) for f in fields])
    newest = F.max(F.when((F.col("family") == family) & trusted & F.col(time).isNotNull(), own)).over(w)
    df = df.withColumn("_newest", F.when(F.col(time).isNotNull(), newest))
    return df.withColumns({f"{prefix}us": F.col("_newest.at"), **{f"{prefix}{f}": F.col(f"_newest.{f}") for f in fields}}).drop("_newest")


def cross_family(df: DataFrame, family: str, other: str, field: str, other_field: str, limit: float, tolerance_seconds: float | None, trusted: Column, time: str = "ts_us", seq: str = "seq") -> DataFrame:
    """Rows of ``family`` with the newest trusted row of ``other``: age, difference and whether it exceeds ``limit``.

    The tolerance is inclusive; without one any age will do.
    """
    found = latest_trusted(df, other, [other_field], trusted, "context_", time, seq).filter(F.col("family") == family)
    age = (F.col(time) - F.col("context_us")) / F.lit(1e6)
    usable = F.col("context_us").isNotNull() & (F.lit(True) if tolerance_seconds is None else age <= tolerance_seconds)
    d = F.when(usable, F.abs(V.finite(F.col(field)) - V.finite(F.col(f"context_{other_field}"))))
    return found.withColumns({"context_age": F.when(usable, age), "difference": d, "is_candidate": V.above(d, limit)})
