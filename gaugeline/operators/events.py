"""Anomaly events from point candidates, and what enforcement makes of them.

Candidates are rows (device_id, family, field, candidate_flag, ts_us, record_id, seq), one per finding
and field. Gaps and islands keep the rows of a session, which later steps need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Events
from ..functions import values as V

KEY = ["device_id", "family", "field", "candidate_flag"]


def explode_fields(findings: DataFrame) -> DataFrame:
    """One row per affected field, else the field, else ``record``; findings without a flag go."""
    some = F.array_sort(F.array_distinct(F.col("affected_fields")))
    names = F.when(F.size("affected_fields") > 0, some).otherwise(F.array(F.coalesce("field", F.lit("record"))))
    return findings.filter(F.col("candidate_flag").isNotNull()).withColumn("field", F.explode(names))


def iso_micros(us: Column) -> Column:
    """ISO text in UTC; the fraction is left out where it is zero."""
    # plain arithmetic, so the session's time zone plays no part
    t = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (us / F.lit(1e6)).cast("decimal(18,6)"))
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.pmod(us, F.lit(1_000_000))
    return F.concat(whole, F.when(part > 0, F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0"))).otherwise(""), F.lit("+00:00"))


def event_id(start_us: Column) -> Column:
    return F.concat(F.lit("event:"), F.substring(F.sha2(F.concat_ws("|", *[F.col(k) for k in KEY], iso_micros(start_us)), 256), 1, 16))


def sessions(candidates: DataFrame, events: Events) -> DataFrame:
    """Candidates with their event: start, running point count, last contributors, and whether confirmed by then.

    A gap longer than the maximum starts a new event; an equal gap continues it.
    """
    w = Window.partitionBy(*KEY).orderBy("ts_us", "seq")
    gap = (F.col("ts_us") - F.lag("ts_us").over(w)) / F.lit(1e6)
    new = F.lag("ts_us").over(w).isNull() | (V.above(gap, events.maximum_gap_seconds) if events.maximum_gap_seconds is not None else F.lit(False))
    df = candidates.withColumn("_new", new.cast("int")).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*KEY, "session").orderBy("ts_us", "seq")
    df = df.withColumns({"start_us": F.first("ts_us").over(inside), "point_count": F.row_number().over(inside).cast("long"), "record_ids": F.collect_list("record_id").over(inside.rowsBetween(-(events.window_points - 1), 0)), "is_last": F.lead("ts_us").over(inside).isNull(), "is_closed": F.max("session").over(Window.partitionBy(*KEY)) > F.col("session")})
    ok = F.col("point_count") >= events.minimum_points
    if events.minimum_duration_seconds is not None:
        ok = ok & ((F.col("ts_us") - F.col("start_us")) / F.lit(1e6) >= events.minimum_duration_seconds)
    return df.withColumns({"event_id": event_id(F.col("start_us")), "is_confirmed": ok}).drop("_new")


def summaries(points: DataFrame, events: Events) -> DataFrame:
    """Event summaries: confirmed once, updated at each later point under the confirmed_event policy, closed by a later event of the same key."""
    inside = Window.partitionBy(*KEY, "session").orderBy("ts_us", "seq").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max(F.col("is_confirmed")).over(inside), F.lit(False))
    status = F.when(~before, "confirmed")
    if events.enforcement_policy == "confirmed_event":
        status = status.otherwise("updated")
    made = points.withColumn("status", F.when(F.col("is_confirmed"), status)).filter(F.col("status").isNotNull())
    closed = points.filter(F.col("is_last") & F.col("is_closed")).withColumn("status", F.lit("closed"))
    columns = ["event_id", *KEY, "start_us", F.col("ts_us").alias("end_us"), "point_count", "record_ids", "status"]
    return made.select(*columns).union(closed.select(*columns))


def enforce(df: DataFrame, flags: Column, effective: Column) -> DataFrame:
    """Add flags to records whose effective mode is enforce; a decoded record that gets one becomes suspect, never invalid."""
    given = F.when(effective == "enforce", F.coalesce(flags, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    merged = F.array_sort(F.array_union(F.coalesce("quality_flags", F.array().cast("array<string>")), given))
    rank = F.greatest(V.state_rank(F.col("quality_state")), F.when(F.size(given) > 0, 1).otherwise(0))
    return df.withColumns({"quality_flags": merged, "quality_state": V.state_of(rank)})


def enforced_flags(points: DataFrame, policy: str) -> DataFrame:
    """(device_id, seq, record_id, flags): every candidate flag, or those of confirmed events."""
    chosen = points.filter("is_confirmed") if policy == "confirmed_event" else points
    return chosen.groupBy("device_id", "seq", "record_id").agg(F.array_sort(F.collect_set("candidate_flag")).alias("flags"))
