"""The registered queries over the star-schema tables, and the SQL that they are held against.

``events`` stands for telemetry: a device is a user, a family an event type, and the payload
holds ``value`` and ``k``. The table has no faults, duplicates or odd payloads, so queries that
need some derive them from ``event_id`` by formulas that the SQL repeats.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DynamicConfig, Events, FieldRule, Interval, ModelFilter, Reentry
from ..functions import values as V
from ..functions.scratch import scratch_root
from ..operators import adaptive, context, dedup, hard, model, report, scan, segments, training
from ..operators import events as ev
from ..sources import exports, packets, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select(F.col("user_id").cast("string").alias("device_id"), F.col("event_type").alias("family"), V.micros(F.col("ts")).alias("ts_us"), F.col("event_id").alias("record_id"), F.col("event_id").alias("seq"), "value", k.alias("k"))


R = "r AS (SELECT user_id::VARCHAR AS device_id, event_type AS family, EPOCH_US(ts) AS ts_us, event_id AS record_id, event_id AS seq, value, JSON_EXTRACT_STRING(props, '$.k')::BIGINT AS k FROM events)"
HOURS = 3600.0


def rounded(*names: str) -> list[Column]:
    return [F.round(n, 6).alias(n) for n in names]


# ---- history rules without feedback

MAD_SQL = f"""
WITH {R},
h AS (SELECT *, COALESCE(LIST(value) OVER (PARTITION BY device_id ORDER BY ts_us, record_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), []) AS hist FROM r),
m AS (SELECT *, LEN(hist) AS history_samples, LEN(hist) < 10 AS is_cold, CASE WHEN LEN(hist) >= 10 THEN LIST_MEDIAN(hist) END AS rolling_median FROM h),
s AS (SELECT *, ABS(value - rolling_median) / GREATEST(1.4826 * LIST_MEDIAN(LIST_TRANSFORM(hist, LAMBDA x: ABS(x - rolling_median))), 1.0) AS score FROM m)
"""


@query(MAD_SQL + "SELECT record_id, history_samples::BIGINT AS history_samples, is_cold, ROUND(rolling_median, 6) AS rolling_median, ROUND(score, 6) AS score, COALESCE(score > 3.5, FALSE) AS is_candidate FROM s")
def rolling_mad_outlier(spark, sf_dir):
    out = adaptive.rolling_baseline(records(spark, sf_dir), "value", minimum_scale=1.0)
    return out.select("record_id", F.col("history_samples").cast("long").alias("history_samples"), "is_cold", *rounded("rolling_median", "score"), "is_candidate")


@query(MAD_SQL + "SELECT device_id, COUNT(*) FILTER (is_cold) AS cold_starts, COUNT(*) FILTER (score > 3.5) AS candidates FROM s GROUP BY device_id")
def cold_start(spark, sf_dir):
    out = adaptive.rolling_baseline(records(spark, sf_dir), "value", minimum_scale=1.0)
    return out.groupBy("device_id").agg(F.count_if("is_cold").alias("cold_starts"), F.count_if("is_candidate").alias("candidates"))


CHANGES_SQL = f"""
WITH {R},
l AS (SELECT *, (ts_us - LAG(ts_us) OVER w) / 1e6 AS elapsed, ABS(value - LAG(value) OVER w) AS step FROM r WINDOW w AS (PARTITION BY device_id ORDER BY ts_us, record_id)),
c AS (SELECT *, COALESCE(elapsed >= 0 AND elapsed >= 60 AND elapsed <= 43200, FALSE) AS gap_ok FROM l),
g AS (SELECT *, CASE WHEN gap_ok AND elapsed > 0 THEN step / elapsed END AS rate, gap_ok AND COALESCE(step > 60, FALSE) AS is_step FROM c)
"""


def changed(spark, sf_dir) -> DataFrame:
    return adaptive.changes(records(spark, sf_dir), "value", step=60.0, rate=0.02, least_gap=60.0, most_gap=12 * HOURS)


@query(CHANGES_SQL + "SELECT record_id, ROUND(elapsed, 6) AS elapsed, ROUND(step, 6) AS step, gap_ok, is_step FROM g")
def step_change(spark, sf_dir):
    return changed(spark, sf_dir).select("record_id", *rounded("elapsed", "step"), "gap_ok", "is_step")


@query(CHANGES_SQL + "SELECT record_id, ROUND(rate, 6) AS rate, COALESCE(rate > 0.02, FALSE) AS is_rate FROM g")
def rate_change(spark, sf_dir):
    return changed(spark, sf_dir).select("record_id", *rounded("rate"), "is_rate")


@query(CHANGES_SQL + "SELECT gap_ok, COUNT(*) AS n, ROUND(MIN(elapsed), 6) AS least, ROUND(MAX(elapsed), 6) AS most FROM g GROUP BY gap_ok")
def gap_gate(spark, sf_dir):
    out = changed(spark, sf_dir).groupBy("gap_ok").agg(F.count(F.lit(1)).alias("n"), F.min("elapsed").alias("least"), F.max("elapsed").alias("most"))
    return out.select("gap_ok", "n", *rounded("least", "most"))


@query(f"""
WITH {R},
b AS (SELECT *, FLOOR(value / 25) AS level FROM r),
i AS (SELECT *, SUM(is_new) OVER w AS run FROM (SELECT *, CASE WHEN level = LAG(level) OVER w THEN 0 ELSE 1 END AS is_new FROM b WINDOW w AS (PARTITION BY device_id ORDER BY ts_us, record_id)) WINDOW w AS (PARTITION BY device_id ORDER BY ts_us, record_id)),
n AS (SELECT *, ROW_NUMBER() OVER w AS run_count, (ts_us - FIRST(ts_us) OVER w) / 1e6 AS run_elapsed FROM i WINDOW w AS (PARTITION BY device_id, run ORDER BY ts_us, record_id))
SELECT record_id, run_count, ROUND(run_elapsed, 6) AS run_elapsed, run_count >= 3 AND run_elapsed >= 3600 AS is_stuck FROM n""")
def stuck_run_exact(spark, sf_dir):
    rows = records(spark, sf_dir).withColumn("level", F.floor(F.col("value") / 25))
    out = adaptive.stuck_exact(rows, "level", samples=3, seconds=HOURS)
    return out.select("record_id", F.col("run_count").cast("long").alias("run_count"), *rounded("run_elapsed"), "is_stuck")


@query(f"""
WITH {R},
g AS (SELECT *, (ts_us - MAX(ts_us) OVER (PARTITION BY device_id, family ORDER BY ts_us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) / 1e6 AS elapsed FROM r)
SELECT record_id, ROUND(elapsed, 6) AS elapsed, COALESCE(elapsed > 43200, FALSE) AS is_gap FROM g""")
def reporting_gap(spark, sf_dir):
    return adaptive.reporting_gap(records(spark, sf_dir), 6 * HOURS, 2.0).select("record_id", *rounded("elapsed"), "is_gap")


@query(f"""
WITH {R},
l AS (SELECT *, MAX(CASE WHEN family = 'purchase' THEN ts_us END) OVER (PARTITION BY device_id ORDER BY ts_us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_seen_us FROM r),
f AS (SELECT *, (ts_us - last_seen_us) / 1e6 AS elapsed FROM l WHERE family <> 'purchase' AND (ts_us - last_seen_us) / 1e6 > 172800)
SELECT record_id, last_seen_us, ROUND(elapsed, 6) AS elapsed FROM f QUALIFY ROW_NUMBER() OVER (PARTITION BY device_id, last_seen_us ORDER BY ts_us, record_id) = 1""")
def family_silence(spark, sf_dir):
    return adaptive.family_silence(records(spark, sf_dir), "purchase", 24 * HOURS, 2.0).select("record_id", "last_seen_us", *rounded("elapsed"))


# ---- context rules


@query(f"""
WITH {R},
j AS (SELECT c.record_id, c.value, v.value AS other, (c.ts_us - v.ts_us) / 1e6 AS age FROM (SELECT * FROM r WHERE family = 'click') c ASOF LEFT JOIN (SELECT * FROM r WHERE family = 'view') v ON c.device_id = v.device_id AND c.ts_us >= v.ts_us)
SELECT record_id, CASE WHEN age <= 86400 THEN ROUND(age, 6) END AS context_age, CASE WHEN age <= 86400 THEN ROUND(ABS(value - other), 6) END AS difference, COALESCE(age <= 86400 AND ABS(value - other) > 50, FALSE) AS is_candidate FROM j""")
def cross_family_asof(spark, sf_dir):
    out = context.cross_family(records(spark, sf_dir), "click", "view", "value", "value", 50.0, 24 * HOURS, F.lit(True))
    return out.select("record_id", *rounded("context_age", "difference"), "is_candidate")


@query(f"""
WITH {R}
SELECT r.record_id, COALESCE(t.ts_us, -1) AS latest_us, COALESCE(t.record_id, -1) AS latest_record_id FROM r ASOF LEFT JOIN (SELECT * FROM r WHERE family = 'view' AND value < 80) t ON r.device_id = t.device_id AND r.ts_us >= t.ts_us""")
def latest_trusted(spark, sf_dir):
    out = context.latest_trusted(records(spark, sf_dir), "view", ["record_id"], F.col("value") < 80, "latest_")
    return out.select("record_id", *[F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("latest_us", "latest_record_id")])


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, LIST_SORT([l_quantity, l_extendedprice * 0.001, COALESCE(CASE WHEN l_tax > 0 THEN l_tax END, l_discount) * 500.0]) AS x FROM lineitem),
m AS (SELECT *, LIST_MEDIAN(x) AS centre FROM s)
SELECT l_orderkey, l_linenumber, LEN(x)::BIGINT AS sensors, ROUND(centre, 6) AS centre, ROUND(LIST_MAX(LIST_TRANSFORM(x, LAMBDA v: ABS(v - centre))), 6) AS spread FROM m""")
def peer_spread(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    sensors = {"quantity": F.col("l_quantity"), "price": F.col("l_extendedprice"), "tax": F.when(F.col("l_tax") > 0, F.col("l_tax")), "discount": F.col("l_discount")}
    out = context.peer_spread(li, sensors, [("tax", "discount")], {"price": 0.001, "tax": 500.0, "discount": 500.0}, least=3)
    return out.select("l_orderkey", "l_linenumber", F.col("sensors").cast("long").alias("sensors"), *rounded("centre", "spread"))


@query("SELECT l_orderkey, l_linenumber, ROUND(ABS(l_quantity - l_extendedprice * 0.001), 6) AS difference, ABS(l_quantity - l_extendedprice * 0.001) > 20 AS is_candidate FROM lineitem")
def cross_field(spark, sf_dir):
    d, hit = context.cross_field(F.col("l_quantity"), F.col("l_extendedprice"), 20.0, scale_b=0.001)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(d, 6).alias("difference"), hit.alias("is_candidate"))


# ---- static rules


def as_input(rows: DataFrame, payload: Column, family: Column, function: Column | None = None) -> DataFrame:
    """Records for the static rules with the payload parsed from JSON text."""
    empty = F.array().cast("array<string>")
    text = function if function is not None else F.lit(None).cast("string")
    return rows.withColumns({"family": family, "payload": V.parse_payload(payload), "function_id": text, "quality_state": F.lit("decoded"), "quality_flags": empty, "analysis_tags": empty})


def verdict(df: DataFrame, *more: Column, key=("record_id",)) -> DataFrame:
    return df.select(*key, "quality_state", F.array_join("quality_flags", ",").alias("flags"), F.array_join("analysis_tags", ",").alias("tags"), F.col("invalid_fields").cast("long").alias("invalid_fields"), *more)


@query(f"""
WITH {R},
p AS (SELECT *, (value > 100)::INT + (k * 1.5 > 100)::INT + (record_id % 4 > 1)::INT + (value - 20 < 0)::INT + (value > 200)::INT + (ABS(value * 150 - 30000) > 20000)::INT AS bad, record_id % 10 = 0 AS no_time, record_id % 5 IN (1, 3) AS mismatch FROM r)
SELECT record_id, CASE WHEN bad > 0 OR no_time OR mismatch THEN 'suspect' ELSE 'decoded' END AS quality_state,
  ARRAY_TO_STRING(LIST_FILTER([CASE WHEN mismatch THEN 'function_family_mismatch' END, CASE WHEN no_time THEN 'invalid_gps_time' END, CASE WHEN bad > 0 THEN 'invalid_value' END], LAMBDA x: x IS NOT NULL), ',') AS flags,
  '' AS tags, bad::BIGINT AS invalid_fields, value <= 200 AS has_temperature, NOT no_time AS has_year, CASE record_id % 5 WHEN 0 THEN '0x41' WHEN 1 THEN '0x42' WHEN 2 THEN NULL WHEN 3 THEN 'ABC' ELSE '0x41' END AS function_id FROM p""")
def hard_environment(spark, sf_dir):
    r, v, i = records(spark, sf_dir), F.col("value"), F.col("record_id")
    body = F.to_json(F.struct(v.alias("moist_pc"), (F.col("k") * 1.5).alias("humidity_pct"), (i % 4).alias("flood_flag"), (v - 20).alias("rain_mm"), v.alias("temperature_c"), (v * 150 - 30000).alias("rtd1_t_x100"), F.when(i % 10 == 0, 65535).otherwise(2024).alias("year"), F.lit("65535").alias("month")))
    function = F.when(i % 5 == 0, "65").when(i % 5 == 1, "0x42").when(i % 5 == 3, " abc ").when(i % 5 == 4, "0X41")
    out = hard.apply_hard(as_input(r, body, F.lit("environment"), function))
    has = lambda f: F.map_contains_key("payload", f)
    return verdict(out, has("temperature_c").alias("has_temperature"), has("year").alias("has_year"), F.col("function_id"))


FAMILY_SQL = f"""
WITH {R},
f AS (SELECT *, CASE family WHEN 'click' THEN 'gas' WHEN 'view' THEN 'gps_status' WHEN 'purchase' THEN 'network_context' WHEN 'signup' THEN 'device_telemetry' ELSE 'other' END AS kind FROM r),
p AS (SELECT *,
  CASE kind WHEN 'gas' THEN (record_id % 5 = 0)::INT + (record_id % 3 = 2)::INT WHEN 'gps_status' THEN (value - 10 < 0)::INT WHEN 'network_context' THEN (k - 10 <= 0)::INT + (record_id % 15 NOT BETWEEN 6 AND 12)::INT
    WHEN 'device_telemetry' THEN (record_id % 3 <> 0 AND value - 5 <= 0)::INT ELSE 0 END AS bad,
  CASE kind WHEN 'gas' THEN CASE WHEN record_id % 3 = 0 AND record_id % 5 = 1 THEN 'incomplete_gas_measurement' END WHEN 'gps_status' THEN CASE WHEN record_id % 4 IN (1, 2) THEN 'gps_fix_unreliable' END
    WHEN 'device_telemetry' THEN CASE WHEN record_id % 3 = 0 THEN 'incomplete_device_telemetry' END END AS soft FROM f),
v AS (SELECT *, CASE WHEN bad > 0 THEN 'invalid' WHEN soft IS NOT NULL THEN 'suspect' ELSE 'decoded' END AS quality_state, CASE WHEN bad > 0 THEN 'invalid_value' ELSE COALESCE(soft, '') END AS flags FROM p)
"""


def families(spark, sf_dir) -> DataFrame:
    r, i, v = records(spark, sf_dir), F.col("record_id"), F.col("value")
    conc = F.when(i % 5 == 0, F.lit('"bad"')).when(i % 5 == 1, F.lit("null")).otherwise(v.cast("string"))
    kind = F.when(i % 3 == 0, F.lit('"CO"')).when(i % 3 == 1, F.lit("null")).otherwise("5")
    fix = F.when(i % 4 == 0, F.lit("true")).when(i % 4 == 1, F.lit('"no-fix"')).when(i % 4 == 2, F.lit("0")).otherwise('"3D"')
    volt = F.when(i % 3 == 0, F.lit('" "')).otherwise((v - 5).cast("string"))
    parts = {"gasConc": conc, "gasType": kind, "horizontalDilution": (v - 10).cast("string"), "gpsFixStatus": fix, "Bandwidth": (F.col("k") - 10).cast("string"), "SpreadFactor": (i % 15).cast("string"), "batteryVoltage": volt, "batteryCharge": F.col("k").cast("string")}
    body = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c) for n, c in parts.items()]), F.lit("}"))
    family = F.element_at(F.create_map(*[F.lit(x) for x in ("click", "gas", "view", "gps_status", "purchase", "network_context", "signup", "device_telemetry", "error", "other")]), F.col("family"))
    return hard.apply_hard(as_input(r, body, family))


@query(FAMILY_SQL + "SELECT record_id, kind AS family, quality_state, flags, '' AS tags, bad::BIGINT AS invalid_fields FROM v")
def hard_families(spark, sf_dir):
    return verdict(families(spark, sf_dir), key=("record_id", "family"))


@query(FAMILY_SQL + """
SELECT COUNT(*) AS total_decoded_records, COUNT(*) FILTER (quality_state = 'decoded') AS decoded_records, COUNT(*) FILTER (quality_state = 'suspect') AS suspect_records, COUNT(*) FILTER (quality_state = 'invalid') AS invalid_records,
  COUNT(*) FILTER (kind = 'gas') AS gas_records, COUNT(*) FILTER (kind = 'gps_status') AS gps_status_records, COUNT(*) FILTER (kind = 'other') AS other_records, COALESCE(SUM(bad) FILTER (kind = 'gas'), 0)::BIGINT AS gas_invalid_field_count, COALESCE(SUM(bad) FILTER (kind = 'network_context'), 0)::BIGINT AS network_context_invalid_field_count FROM v""")
def quality_report(spark, sf_dir):
    names = ["total_decoded_records", "decoded_records", "suspect_records", "invalid_records", "gas_records", "gps_status_records", "other_records", "gas_invalid_field_count", "network_context_invalid_field_count"]
    return hard.hard_report(families(spark, sf_dir)).select(*names)


@query("""
WITH b AS (SELECT *, l_discount * 100 AS b0, l_quantity AS b1, l_tax * 100 AS b2, l_linenumber::DOUBLE AS b3, l_quantity - 10 AS b4, l_quantity * 0.5 AS b5 FROM lineitem),
w AS (SELECT *, l_quantity - 3 <= 0 OR l_discount * 12 > 1 OR b4 < 0 AS wrong,
  l_quantity - 3 <= 5 AND GREATEST(b0, b1, b2, b3, b4, b5) <= 1 AS quiet, b1 >= 20 AND b1 = GREATEST(b0, b1, b2, b3, b4, b5) AS wheel,
  l_extendedprice / 5 >= 8000 AND l_extendedprice / 6 >= 7000 AND b4 >= 15 AND b5 >= 15 AS squeal FROM b)
SELECT l_orderkey, l_linenumber, CASE WHEN wrong THEN 'invalid' ELSE 'decoded' END AS quality_state, CASE WHEN wrong THEN 'invalid_value' ELSE '' END AS flags,
  ARRAY_TO_STRING(LIST_FILTER([CASE WHEN wheel AND NOT wrong THEN 'flatwheel_candidate' END, CASE WHEN quiet AND NOT wrong THEN 'noise_like' END, CASE WHEN squeal AND NOT wrong THEN 'squeal_candidate' END], LAMBDA x: x IS NOT NULL), ',') AS tags, 0::BIGINT AS invalid_fields FROM w""")
def band_tags(spark, sf_dir):
    q, li = F.col("l_quantity"), table(spark, sf_dir, "lineitem")
    levels = [F.col("l_discount") * 100, q, F.col("l_tax") * 100, F.col("l_linenumber").cast("double"), q - 10, q * 0.5]
    rest = [(q - 3).alias("total_power"), (F.col("l_discount") * 12).alias("spectral_flatness"), (F.col("l_extendedprice") / 5).alias("peak_freq_hz"), (F.col("l_extendedprice") / 6).alias("spectral_centroid_hz")]
    body = F.to_json(F.struct(*[c.alias(b) for b, c in zip(hard.BANDS, levels, strict=True)], *rest))
    return verdict(hard.apply_hard(as_input(li, body, F.lit("microphone_fft"))), key=("l_orderkey", "l_linenumber"))


@query(f"""
WITH {R},
w AS (SELECT *, k * 1000 - 5000 <= 0 OR record_id % 50 - 1 < 0 AS wrong, record_id % 6 = 0 AS bad_clock, value / 1000 <= 0.05 AND value <= 10 AS weak, value / 1000 >= 0.05 + 0.05 AND value >= 80 AS strong FROM r)
SELECT record_id, CASE WHEN wrong THEN 'invalid' WHEN bad_clock THEN 'suspect' ELSE 'decoded' END AS quality_state,
  ARRAY_TO_STRING(LIST_FILTER([CASE WHEN wrong THEN 'invalid_value' END, CASE WHEN bad_clock THEN 'time_unreliable' END], LAMBDA x: x IS NOT NULL), ',') AS flags,
  CASE WHEN NOT wrong AND weak THEN 'noise_like' WHEN NOT wrong AND strong THEN 'event_candidate' ELSE '' END AS tags, 0::BIGINT AS invalid_fields FROM w""")
def acoustic_tags(spark, sf_dir):
    r, i, v = records(spark, sf_dir), F.col("record_id"), F.col("value")
    body = F.to_json(F.struct((F.col("k") * 1000 - 5000).alias("duration_us"), (i % 50 - 1).alias("counts"), v.alias("energy"), (v / 1000).alias("amplitude_v"), F.lit(0.05).alias("threshold_v"), (i % 6 != 0).alias("source_node_clock_ok")))
    return verdict(hard.apply_hard(as_input(r, body, F.lit("ae"))))


@query(f"""
WITH {R}
SELECT record_id, CASE record_id % 8 WHEN 0 THEN '0x41' WHEN 1 THEN '0x29' WHEN 2 THEN '0xFF' WHEN 3 THEN 'FOO' WHEN 4 THEN NULL WHEN 5 THEN '0x01' WHEN 6 THEN '0x1F4' ELSE '0X' END AS function_id FROM r""")
def function_id_norm(spark, sf_dir):
    texts = ["0x41", " 41 ", "255.9", "foo", "  ", "1e0", "500", "0x"]
    text = F.element_at(F.array(*map(F.lit, texts)), (F.col("record_id") % 8 + 1).cast("int"))
    return records(spark, sf_dir).select("record_id", V.function_id(text).alias("function_id"))


@query(f"""
WITH {R}
SELECT record_id, CASE WHEN record_id % 5 IN (0, 2) THEN ts_us WHEN record_id % 5 = 1 THEN ts_us - 7200000000 WHEN record_id % 5 = 3 THEN ts_us ELSE -1 END AS parsed_us FROM r""")
def time_norm(spark, sf_dir):
    r = records(spark, sf_dir)
    whole = F.regexp_replace(F.regexp_replace(ev.iso_micros(F.col("ts_us")), r"\+00:00$", ""), " ", "T")
    i = F.col("record_id") % 5
    text = F.when(i == 0, F.concat(whole, F.lit("Z"))).when(i == 1, F.concat(whole, F.lit("+02:00"))).when(i == 2, whole).when(i == 3, F.concat(F.lit(" "), whole, F.lit("999Z "))).otherwise(F.lit("2024"))
    text = F.when((i == 3) & ~whole.contains("."), F.concat(whole, F.lit("Z"))).otherwise(text)
    return r.select("record_id", F.coalesce(F.unix_micros(V.timestamp(text)), F.lit(-1)).cast("long").alias("parsed_us"))


@query(f"""
WITH {R}
SELECT record_id, CASE WHEN k % 2 = 0 THEN 'a,b' ELSE '' END AS flags, CASE WHEN k % 3 = 0 THEN 'noise_like,x' ELSE 'x' END AS tags,
  CASE WHEN record_id % 4 = 0 THEN 'invalid' WHEN record_id % 4 = 1 THEN CASE WHEN k % 3 = 0 AND k % 2 = 1 THEN 'decoded' ELSE 'suspect' END ELSE 'decoded' END AS quality_state FROM r""")
def tag_migration(spark, sf_dir):
    flags = F.concat(F.when(F.col("k") % 2 == 0, F.array(F.lit(" b"), F.lit("a"), F.lit("a "), F.lit(" "))).otherwise(F.array().cast("array<string>")), F.when(F.col("k") % 3 == 0, F.array(F.lit("noise_like"))).otherwise(F.array().cast("array<string>")))
    state = F.element_at(F.array(*map(F.lit, ("reject", "suspect", "unheard", "decoded"))), (F.col("record_id") % 4 + 1).cast("int"))
    out = hard.normalize_semantics(records(spark, sf_dir).withColumns({"quality_flags": flags, "analysis_tags": F.array(F.lit("x"), F.lit("x")), "quality_state": state}))
    return out.select("record_id", F.array_join("quality_flags", ",").alias("flags"), F.array_join("analysis_tags", ",").alias("tags"), "quality_state")


# ---- events and enforcement

POLICY = Events(enabled=True, minimum_points=2, window_points=3, maximum_gap_seconds=259200.0, minimum_duration_seconds=3600.0, enforcement_policy="confirmed_event")

POINTS_SQL = CHANGES_SQL + """,
p AS (SELECT *, (ts_us - LAG(ts_us) OVER w) / 1e6 AS gap FROM g WHERE is_step WINDOW w AS (PARTITION BY device_id, family ORDER BY ts_us, seq)),
n AS (SELECT *, SUM(CASE WHEN gap IS NULL OR gap > 259200 THEN 1 ELSE 0 END) OVER (PARTITION BY device_id, family ORDER BY ts_us, seq) AS session FROM p),
s AS (SELECT *, FIRST(ts_us) OVER w AS start_us, ROW_NUMBER() OVER w AS point_count, LIST(record_id::VARCHAR) OVER (PARTITION BY device_id, family, session ORDER BY ts_us, seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS ids,
  LEAD(ts_us) OVER w IS NULL AS is_last, MAX(session) OVER (PARTITION BY device_id, family) > session AS is_closed FROM n WINDOW w AS (PARTITION BY device_id, family, session ORDER BY ts_us, seq)),
z AS (SELECT *, point_count >= 2 AND (ts_us - start_us) / 1e6 >= 3600 AS is_confirmed,
  'event:' || SUBSTR(SHA256(CONCAT_WS('|', device_id, family, 'value', 'step_change', STRFTIME(MAKE_TIMESTAMP(start_us), '%Y-%m-%dT%H:%M:%S') || CASE WHEN start_us % 1000000 > 0 THEN '.' || LPAD((start_us % 1000000)::VARCHAR, 6, '0') ELSE '' END || '+00:00')), 1, 16) AS event_id FROM s)
"""


def step_points(spark, sf_dir) -> DataFrame:
    found = changed(spark, sf_dir).filter("is_step").withColumns({"candidate_flag": F.lit("step_change"), "affected_fields": F.array().cast("array<string>"), "field": F.lit("value"), "record_id": F.col("record_id").cast("string")})
    return ev.sessions(ev.explode_fields(found), POLICY)


@query(POINTS_SQL + "SELECT record_id, event_id, point_count, is_confirmed FROM z")
def event_sessions(spark, sf_dir):
    return step_points(spark, sf_dir).select(F.col("record_id").cast("long").alias("record_id"), "event_id", "point_count", "is_confirmed")


@query(POINTS_SQL + "SELECT record_id, ARRAY_TO_STRING(ids, ',') AS contributors FROM z")
def event_contributors(spark, sf_dir):
    return step_points(spark, sf_dir).select(F.col("record_id").cast("long").alias("record_id"), F.array_join("record_ids", ",").alias("contributors"))


@query(POINTS_SQL + """,
f AS (SELECT *, COALESCE(MAX(is_confirmed::INT) OVER (PARTITION BY device_id, family, session ORDER BY ts_us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM z)
SELECT event_id, ts_us AS end_us, point_count, CASE WHEN before = 0 THEN 'confirmed' ELSE 'updated' END AS status FROM f WHERE is_confirmed
UNION ALL SELECT event_id, ts_us, point_count, 'closed' FROM f WHERE is_last AND is_closed""")
def event_confirmed(spark, sf_dir):
    return ev.summaries(step_points(spark, sf_dir), POLICY).select("event_id", "end_us", "point_count", "status")


def enforced(spark, sf_dir, policy: str) -> DataFrame:
    r = records(spark, sf_dir).withColumns({"quality_flags": F.when(F.col("k") % 9 == 0, F.array(F.lit("a"))).otherwise(F.array().cast("array<string>")), "quality_state": F.when(F.col("k") % 9 == 0, "suspect").when(F.col("k") % 10 == 1, "invalid").otherwise("decoded")})
    flags = ev.enforced_flags(step_points(spark, sf_dir), policy).select("device_id", "seq", "flags")
    out = ev.enforce(r.join(flags, ["device_id", "seq"], "left"), F.when(F.col("quality_state") != "invalid", F.col("flags")), F.lit("enforce"))
    return out.select("record_id", "quality_state", F.array_join("quality_flags", ",").alias("flags"))


ENFORCED_SQL = """
SELECT r.record_id, CASE WHEN r.k % 9 = 0 THEN 'suspect' WHEN r.k % 10 = 1 THEN 'invalid' WHEN z.seq IS NOT NULL THEN 'suspect' ELSE 'decoded' END AS quality_state,
  CASE WHEN r.k % 9 = 0 THEN CASE WHEN z.seq IS NOT NULL THEN 'a,step_change' ELSE 'a' END WHEN r.k % 10 = 1 OR z.seq IS NULL THEN '' ELSE 'step_change' END AS flags FROM r LEFT JOIN"""


@query(POINTS_SQL + ENFORCED_SQL + " z ON z.seq = r.seq")
def enforcement_point(spark, sf_dir):
    return enforced(spark, sf_dir, "point")


@query(POINTS_SQL + ENFORCED_SQL + " (SELECT * FROM z WHERE is_confirmed) z ON z.seq = r.seq")
def enforcement_confirmed(spark, sf_dir):
    return enforced(spark, sf_dir, "confirmed_event")


@query(CHANGES_SQL + "SELECT family, COUNT(*) AS n FROM g WHERE is_step GROUP BY family")
def counts_by_family(spark, sf_dir):
    return report.trigger_counts(changed(spark, sf_dir).withColumn("candidate_flag", F.when(F.col("is_step"), "step_change")), "family")


@query(CHANGES_SQL + "SELECT device_id, COUNT(*) AS n FROM g WHERE is_step GROUP BY device_id")
def counts_by_device(spark, sf_dir):
    return report.trigger_counts(changed(spark, sf_dir).withColumn("candidate_flag", F.when(F.col("is_step"), "step_change")), "device_id")


@query(CHANGES_SQL + "SELECT rule_id, COUNT(*) AS n FROM (SELECT 'adaptive.step_change' AS rule_id FROM g WHERE is_step UNION ALL SELECT 'adaptive.rate_change' FROM g WHERE rate > 0.02) GROUP BY rule_id")
def counts_by_rule(spark, sf_dir):
    c = changed(spark, sf_dir)
    found = F.array_compact(F.array(F.when(F.col("is_step"), F.lit("adaptive.step_change")), F.when(F.col("is_rate"), F.lit("adaptive.rate_change"))))
    return report.trigger_counts(c.select(F.explode(found).alias("rule_id")).withColumn("candidate_flag", F.col("rule_id")), "rule_id")


# ---- fingerprints, ledger, runs

PRINT_SQL = "SHA256(CONCAT_WS('|', device_id, family, record_id::VARCHAR, ts_us::VARCHAR, k::VARCHAR))"
REPEATED_SQL = f"WITH {R}, t AS (SELECT * FROM r UNION ALL SELECT * REPLACE (seq + 1000000000 AS seq) FROM r WHERE record_id % 10 = 0), d AS (SELECT *, {PRINT_SQL} AS fingerprint FROM t)"


def printed(df: DataFrame) -> DataFrame:
    return df.withColumn("fingerprint", dedup.fingerprint([F.col(c) for c in ("device_id", "family", "record_id", "ts_us", "k")]))


def repeated(spark, sf_dir) -> DataFrame:
    r = records(spark, sf_dir)
    return printed(r.union(r.filter("record_id % 10 = 0").withColumn("seq", F.col("seq") + 1_000_000_000)))


def ledger(spark, sf_dir) -> DataFrame:
    return printed(records(spark, sf_dir).filter("record_id % 17 = 0"))


@query(f"WITH {R} SELECT record_id, {PRINT_SQL} AS fingerprint FROM r")
def fingerprint(spark, sf_dir):
    return printed(records(spark, sf_dir)).select("record_id", "fingerprint")


@query(REPEATED_SQL + "SELECT seq, record_id % 17 = 0 OR ROW_NUMBER() OVER (PARTITION BY fingerprint ORDER BY seq) > 1 AS is_duplicate FROM d")
def dedup_first(spark, sf_dir):
    return dedup.mark_duplicates(repeated(spark, sf_dir), ledger(spark, sf_dir)).select("seq", "is_duplicate")


@query(REPEATED_SQL + "SELECT seq, fingerprint FROM d ORDER BY seq DESC LIMIT 500")
def ledger_fifo(spark, sf_dir):
    return dedup.ledger_tail(repeated(spark, sf_dir), 500).select("seq", "fingerprint")


@query(REPEATED_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """
, newest AS (SELECT fingerprint, record_id FROM d WHERE record_id % 7 = 0 AND seq < 1000000000 ORDER BY record_id DESC LIMIT 600),
old AS (SELECT fingerprint, ROW_NUMBER() OVER (ORDER BY record_id) - 1 AS j FROM newest),
f AS (SELECT fingerprint, MIN(device_id) AS device_id, MIN(ts_us) AS ts_us, MIN(CASE WHEN k % 9 <> 0 THEN seq END) AS first_seq FROM d GROUP BY fingerprint),
g AS (SELECT f.*, j, COUNT(*) FILTER (j IS NULL AND first_seq IS NOT NULL) OVER w - COUNT(*) FILTER (j IS NULL AND first_seq IS NOT NULL) OVER (PARTITION BY device_id, ts_us) + (SELECT COUNT(*) FROM old) - 600 AS before
  FROM f LEFT JOIN old USING (fingerprint) WINDOW w AS (ORDER BY device_id, ts_us)),
o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY device_id, ts_us) AS n, LAG(device_id || ':' || ts_us::VARCHAR) OVER (ORDER BY device_id, ts_us) IS NOT DISTINCT FROM device_id || ':' || ts_us::VARCHAR AS same FROM g WHERE j IS NOT NULL),
gone AS (SELECT n, fingerprint, j < before AS is_gone, (j < before AND first_seq IS NOT NULL)::INT AS entered, 0 AS earlier FROM o WHERE n = 1
  UNION ALL SELECT n, fingerprint, j < before + earlier, entered + (j < before + earlier AND first_seq IS NOT NULL)::INT, earlier
    FROM (SELECT o.*, x.entered, CASE WHEN o.same THEN x.earlier ELSE x.entered END AS earlier FROM gone x JOIN o ON o.n = x.n + 1))
SELECT seq, COALESCE(NOT is_gone, FALSE) OR COALESCE(first_seq < seq, FALSE) AS is_duplicate FROM d JOIN f USING (fingerprint) LEFT JOIN gone USING (fingerprint)""")
def ledger_global(spark, sf_dir):
    rows = repeated(spark, sf_dir).withColumn("eligible", F.col("k") % 9 != 0)
    old = printed(records(spark, sf_dir).filter("record_id % 7 = 0")).select("fingerprint", "device_id", F.col("record_id").alias("place"))
    marked, _ = dedup.ledger_scan(rows, old, 600, ("device_id", "ts_us"), ("device_id", "ts_us", "seq"), "eligible")
    return marked.select("seq", "is_duplicate")


@query(REPEATED_SQL + "SELECT seq FROM d WHERE record_id % 17 <> 0")
def upload_anti_join(spark, sf_dir):
    return dedup.not_in_ledger(repeated(spark, sf_dir), ledger(spark, sf_dir)).select("seq")


@query(REPEATED_SQL + "SELECT record_id, COUNT(*) AS n FROM d GROUP BY record_id HAVING COUNT(*) > 1")
def duplicate_ids(spark, sf_dir):
    return dedup.repeated_ids(repeated(spark, sf_dir))


@query(f"WITH {R} SELECT ts_us - ts_us % 900000000 AS slot_us, COUNT(*) AS n FROM r GROUP BY slot_us")
def execution_slot(spark, sf_dir):
    return records(spark, sf_dir).groupBy(dedup.execution_slot(F.col("ts_us")).alias("slot_us")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {R}, d AS (SELECT *, {PRINT_SQL} AS fingerprint, ts_us - ts_us % 3600000000 AS slot_us FROM r),
p AS (SELECT slot_us, SUBSTR(fingerprint, 1, 2) AS part, COUNT(*) AS n, SHA256(STRING_AGG(fingerprint, ',' ORDER BY fingerprint)) AS digest FROM d GROUP BY slot_us, part)
SELECT slot_us, SUM(n)::BIGINT AS n, 'run:' || SHA256('v2|' || slot_us::VARCHAR || '|' || STRING_AGG(digest, ',' ORDER BY part)) AS run_key FROM p GROUP BY slot_us""")
def run_key(spark, sf_dir):
    rows = printed(records(spark, sf_dir)).withColumn("slot_us", dedup.execution_slot(F.col("ts_us"), 60))
    return dedup.run_key(rows, ["slot_us"], "v2")


# ---- packets, exports and views


def little(n: Column, size: int) -> Column:
    """Hex text of an integer, low byte first."""
    big = F.lpad(F.hex(F.pmod(n, F.lit(1 << (8 * size)))), 2 * size, "0")
    return F.concat(*[F.substring(big, 2 * k + 1, 2) for k in range(size - 1, -1, -1)])


def packet(temperature: Column, place: Column, i: Column) -> Column:
    """A packet of 51 bytes with four varying values; the others are constants."""
    values = {"rtd1_t_x100": temperature, "moist_pc": i % 120, "flood_flag": i % 2, "lat": place, "year": F.lit(2024).cast("long"), "second": i % 60}
    body = [little(values.get(name, F.lit(7).cast("long")), size) for name, size, _ in packets.LAYOUT]
    return F.concat(F.lit("aabb0041"), *body, F.lit("00" * 15), F.lit(",8"))


PACKET_SQL = f"WITH {R}, p AS (SELECT *, record_id % 3 = 0 AS two, k * 37 - 2000 AS t1, 3000 - k * 41 AS t2 FROM r)"


@query(PACKET_SQL + "SELECT record_id, CASE WHEN two THEN t2 ELSE t1 END AS rtd1_t_x100, (record_id % 120)::BIGINT AS moist_pc, record_id % 2 AS flood_flag, CASE WHEN two THEN 5 - k ELSE k * 100000 - 4000000 END AS lat, 2024::BIGINT AS year, record_id % 60 AS second, 7::BIGINT AS lon FROM p")
def packet_decode(spark, sf_dir):
    r, i, k = records(spark, sf_dir), F.col("record_id"), F.col("k")
    first, other = packet(k * 37 - 2000, k * 100000 - 4000000, i), packet(3000 - k * 41, 5 - k, i)
    slots = {"FirstPacket": first, "FifthPacket": F.when(i % 3 == 0, other).otherwise(F.concat(F.substring(other, 1, 40), F.lit(",8"))), "NinthPacket": F.lit("null"), "TenthPacket": F.regexp_replace(first, "^aabb00", "aabb01")}
    rows = packets.with_frame(r.withColumns(slots), [F.col(s) if s in slots else F.lit(None).cast("string") for s in packets.SLOTS], "frame")
    return rows.select("record_id", *[F.col(f"frame.{n}") for n in ("rtd1_t_x100", "moist_pc", "flood_flag", "lat", "year", "second", "lon")])


@query(f"WITH {R} SELECT device_id, record_id::VARCHAR AS t, CASE WHEN k % 4 <> 0 THEN k::VARCHAR END AS first_packet FROM r WHERE device_id::BIGINT % 5 <> 0")
def envelope_rows(spark, sf_dir):
    r = records(spark, sf_dir)
    columns = F.array(F.lit("time"), F.when(F.col("device_id").cast("long") % 5 == 0, "Other").otherwise("FirstPacket"), F.lit("ControllerName"))
    row = F.to_json(F.array(F.col("record_id").cast("string"), F.when(F.col("k") % 4 != 0, F.col("k").cast("string")), F.col("device_id")))
    per_device = r.groupBy("device_id", F.to_json(columns).alias("columns")).agg(F.array_join(F.collect_list(row), ",").alias("rows"))
    body = per_device.select(F.concat(F.lit('{"results":[{"series":[{"columns":'), F.col("columns"), F.lit(',"values":[[],'), F.col("rows"), F.lit(',7]},{"columns":3}]},{"x":1}]}')).alias("body"))
    rows = exports.export_rows(body).filter(F.size("row") > 0)
    return rows.select(V.as_text(F.col("row")["ControllerName"]).alias("device_id"), V.as_text(F.col("row")["time"]).alias("t"), exports.text_of(F.col("row")["FirstPacket"]).alias("first_packet"))


@query(f"WITH {R} SELECT record_id, CASE WHEN record_id % 3 <> 1 THEN device_id END AS device_id, CASE WHEN record_id % 3 <> 1 THEN record_id::VARCHAR END AS t, CASE WHEN record_id % 3 <> 1 AND k % 4 <> 0 THEN k::VARCHAR END AS first_packet FROM r")
def rows_by_position(spark, sf_dir):
    """Export rows without names; each third row is one value short."""
    r = records(spark, sf_dir)
    given = {"time": F.col("record_id").cast("string"), "ControllerName": F.col("device_id"), "FirstPacket": F.when(F.col("k") % 4 != 0, F.col("k").cast("string"))}
    cells = F.array(*[given.get(c, F.lit("x")) for c in packets.POSITIONS])
    body = F.to_json(F.when(F.col("record_id") % 3 == 1, F.slice(cells, 1, len(packets.POSITIONS) - 1)).otherwise(cells))
    rows = r.select("record_id", packets.by_position(F.try_variant_get(F.try_parse_json(body), "$", "array<variant>"), strict=False).alias("row"))
    return rows.select("record_id", V.as_text(F.col("row")["ControllerName"]).alias("device_id"), V.as_text(F.col("row")["time"]).alias("t"), exports.text_of(F.col("row")["FirstPacket"]).alias("first_packet"))


@query(f"WITH {R} SELECT record_id, CASE WHEN record_id % 8 IN (0, 2) THEN 1 WHEN record_id % 8 IN (1, 3) THEN 0 END AS label FROM r")
def label_parse(spark, sf_dir):
    texts = F.array(*map(F.lit, ("1", " 0", "TRUE ", "False", "yes", "", "1.0", None)))
    return records(spark, sf_dir).select("record_id", exports.label(F.element_at(texts, (F.col("record_id") % 8 + 1).cast("int"))).alias("label"))


IDENTITY_SQL = f"""
WITH {R} SELECT record_id, CASE record_id % 4 WHEN 0 THEN device_id WHEN 1 THEN 'platform:c' || device_id || '||' || family || '|' WHEN 2 THEN '' ELSE 'source:t' END AS device_id,
CASE WHEN record_id % 5 <> 0 THEN ts_us - ts_us % 1000000 END AS ts_us FROM r"""


@query(IDENTITY_SQL)
def record_identity(spark, sf_dir):
    """Identity and time of records parsed from JSON: a device, a platform, a blank device, only a source."""
    r, i = records(spark, sf_dir), F.col("record_id") % 4
    time = F.date_format(F.timestamp_seconds(F.floor(F.col("ts_us") / 1000000)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    place = F.when(i == 1, F.struct(F.concat(F.lit("c"), F.col("device_id")).alias("ControllerName"), F.lit(" ").alias("Site"), F.col("family").alias("Location"), F.lit("null").alias("Area")))
    fields = {"record_id": F.col("record_id").cast("string"), "device_id": F.when(i == 0, F.concat(F.lit(" "), F.col("device_id"))).when(i == 2, " "), "source_type": F.lit("t"), "platform_meta": place}
    fields |= {"timestamp": F.when(F.col("record_id") % 5 == 0, "soon").when(F.col("record_id") % 5 > 1, time), "source_time_utc": F.when(F.col("record_id") % 5 == 1, time)}
    lines = r.select(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("line"))
    return exports.with_identity(exports.parse_records(lines, "line")).select(F.col("record_id").cast("long").alias("record_id"), "device_id", "ts_us")


@query(f"WITH {R} SELECT record_id, CASE WHEN record_id % 3 = 0 THEN k + 1 ELSE k END AS k FROM r UNION ALL SELECT -record_id, k FROM r WHERE record_id % 3 = 1")
def stored_records(spark, sf_dir):
    """All records are written twice; in the second write a third has changed, a third comes under new ids and a third is the same."""
    r, part = records(spark, sf_dir), F.col("record_id") % 3
    path = f"{scratch_root(spark)}/stored-{uuid.uuid4().hex}"
    later = r.withColumns({"k": F.when(part == 0, F.col("k") + 1).otherwise(F.col("k")), "record_id": F.when(part == 1, -F.col("record_id")).otherwise(F.col("record_id"))})
    for rows in (r, later):
        sinks.upsert(rows.select("record_id", "k", F.sha2(F.concat_ws("|", "record_id", "k"), 256).alias("record_fingerprint")), path)
    return sinks.current_rows(spark, path).select("record_id", "k")


@query(f"WITH {R} SELECT record_id, CASE WHEN record_id % 4 <> 2 THEN k::DOUBLE END AS k, value AS v FROM r WHERE family = 'view'")
def typed_view(spark, sf_dir):
    i = F.col("record_id") % 4
    k = F.col("k").cast("string")
    shown = F.when(i == 0, k).when(i == 1, F.concat(F.lit('"'), k, F.lit('"'))).when(i == 2, F.lit("true")).otherwise(F.concat(F.lit('" '), k, F.lit('.0 "')))
    body = F.concat(F.lit('{"k":'), shown, F.lit(',"v":'), F.col("value").cast("string"), F.lit("}"))
    rows = as_input(records(spark, sf_dir), body, F.col("family"))
    return sinks.typed_view(rows, "view", ["k", "v"]).select("record_id", "k", "v")


@query("SELECT event_type, JSON_EXTRACT_STRING(props, '$.k')::BIGINT AS k, COUNT(*) AS n FROM events GROUP BY ALL")
def json_projection(spark, sf_dir):
    payload = V.parse_payload(F.col("props"))
    k = V.finite_number(payload["k"]).cast("long")
    return table(spark, sf_dir, "events").groupBy("event_type", k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {R} SELECT record_id, ts_us, k FROM r WHERE family = 'error' ORDER BY ts_us DESC, record_id DESC LIMIT 20")
def recent_runs(spark, sf_dir):
    return records(spark, sf_dir).filter(F.col("family") == "error").orderBy(F.desc("ts_us"), F.desc("record_id")).limit(20).select("record_id", "ts_us", "k")


# ---- model

INPUTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
#: Literal weights, so that scores can be compared.
MODEL = model.Autoencoder([25.0, 35000.0, 0.05, 0.04], [25.0, 37000.0, 0.05, 0.04], [([[0.5, -0.3], [0.4, 0.2], [-0.6, 0.7], [0.1, -0.8]], [0.1, -0.2]), ([[0.9, 0.7, -0.4, 0.2], [-0.5, 0.3, 0.8, -0.9]], [0.05, 0.0, -0.1, 0.02])], 0.35, [1.0, 1.2, 0.9, 1.1], INPUTS)


def _model_sql() -> str:
    (w0, b0), (w1, b1) = MODEL.layers
    scaled = ", ".join(f"({c} - {m!r}::DOUBLE) / {q!r}::DOUBLE AS x{i}" for i, (c, m, q) in enumerate(zip(INPUTS, MODEL.median, MODEL.iqr, strict=True)))
    hidden = ", ".join(f"TANH({b0[j]!r}::DOUBLE + " + " + ".join(f"x{k} * {w0[k][j]!r}::DOUBLE" for k in range(4)) + f") AS h{j}" for j in range(2))
    errors = ", ".join(f"POWER(x{j} - ({b1[j]!r}::DOUBLE + " + " + ".join(f"h{k} * {w1[k][j]!r}::DOUBLE" for k in range(2)) + f"), 2) AS e{j}" for j in range(4))
    over = " OR ".join(f"e{j} > {t!r}" for j, t in enumerate(MODEL.field_thresholds))
    return f"WITH a AS (SELECT *, {scaled} FROM lineitem), b AS (SELECT *, {hidden} FROM a), c AS (SELECT *, {errors} FROM b), s AS (SELECT *, (e0 + e1 + e2 + e3) / 4 AS error, {over} AS over FROM c)"


MODEL_SQL = _model_sql()


def scored(spark, sf_dir) -> DataFrame:
    return model.score(table(spark, sf_dir, "lineitem"), MODEL, INPUTS)


@query(MODEL_SQL + "SELECT l_orderkey, l_linenumber, ROUND(error, 6) AS error, ROUND(GREATEST(e0, e1, e2, e3), 6) AS worst FROM s")
def ae_score(spark, sf_dir):
    return scored(spark, sf_dir).select("l_orderkey", "l_linenumber", F.round("error", 6).alias("error"), F.round(F.array_max("errors"), 6).alias("worst"))


@query(MODEL_SQL + f"""
SELECT l_orderkey, l_linenumber, ARRAY_TO_STRING(CASE WHEN over THEN LIST_FILTER([{", ".join(f"CASE WHEN e{j} > {t!r} THEN '{INPUTS[j]}' END" for j, t in enumerate(MODEL.field_thresholds))}], LAMBDA x: x IS NOT NULL)
  ELSE [CASE GREATEST(e0, e1, e2, e3) WHEN e0 THEN 'l_quantity' WHEN e1 THEN 'l_extendedprice' WHEN e2 THEN 'l_discount' ELSE 'l_tax' END] END, ',') AS affected FROM s WHERE error > 0.35 OR over""")
def ae_candidates(spark, sf_dir):
    return scored(spark, sf_dir).filter("is_candidate").select("l_orderkey", "l_linenumber", F.array_join("affected_fields", ",").alias("affected"))


@query("SELECT " + ", ".join(f"ROUND(QUANTILE_CONT({c}, 0.5), 6) AS {c}_median, ROUND(GREATEST(QUANTILE_CONT({c}, 0.75) - QUANTILE_CONT({c}, 0.25), 1e-6), 6) AS {c}_iqr" for c in INPUTS) + " FROM lineitem")
def ae_scaler(spark, sf_dir):
    one = model.fit_scaler(table(spark, sf_dir, "lineitem"), INPUTS)
    return one.select(*rounded(*one.columns))


@query(MODEL_SQL + "SELECT ROUND(QUANTILE_CONT(error, 0.99), 6) AS overall, " + ", ".join(f"ROUND(QUANTILE_CONT(e{j}, 0.995), 6) AS field_{j}" for j in range(4)) + " FROM s")
def ae_thresholds(spark, sf_dir):
    one = model.error_thresholds(scored(spark, sf_dir), 4)
    return one.select(*rounded(*one.columns))


@query("""
WITH u AS (SELECT ('0x' || SUBSTR(MD5('split:' || l_orderkey::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u FROM lineitem)
SELECT CASE WHEN u < 0.7 THEN 0 WHEN u < 0.85 THEN 1 ELSE 2 END::INT AS part, COUNT(*) AS n FROM u GROUP BY part""")
def train_split(spark, sf_dir):
    return model.split(table(spark, sf_dir, "lineitem"), "l_orderkey", shares=(0.7, 0.15, 0.15)).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH h AS (SELECT l_orderkey, l_linenumber, ('0x' || SUBSTR(MD5('split:' || (l_orderkey * 8 + l_linenumber)::VARCHAR), 1, 15))::BIGINT AS h FROM lineitem),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY h) AS r, COUNT(*) OVER () AS n FROM h)
SELECT l_orderkey, l_linenumber, ((r > n * 70 // 100)::INT + (r > n * 85 // 100)::INT)::INT AS part FROM r""")
def exact_split(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"))
    return training.exact_split(rows, "key").select("l_orderkey", "l_linenumber", "part")


@query(MODEL_SQL + "SELECT CASE WHEN l_returnflag = 'N' THEN 'normal' ELSE l_linestatus || l_returnflag END AS kind, COUNT(*) AS n, ROUND(AVG((error > 0.35 OR over)::INT), 6) AS candidate_rate FROM s GROUP BY kind")
def recall_by_type(spark, sf_dir):
    rows = scored(spark, sf_dir).withColumns({"label": F.when(F.col("l_returnflag") == "N", 0).otherwise(1), "kind": F.concat("l_linestatus", "l_returnflag")})
    return model.evaluate(rows, "label", "kind").select("kind", "n", *rounded("candidate_rate"))


@query(f"""
WITH {R},
s AS (SELECT seq, (k % 25 <> 0)::INT AS complete, (k < CASE WHEN (seq // 400) % 3 = 1 THEN 25 ELSE 7 END)::INT AS candidate FROM r),
w AS (SELECT seq, ROW_NUMBER() OVER o AS n, AVG(candidate) OVER (ORDER BY seq ROWS 99 PRECEDING) AS c100, AVG(complete) OVER (ORDER BY seq ROWS 99 PRECEDING) AS k100, AVG(candidate) OVER (ORDER BY seq ROWS 199 PRECEDING) AS c200, AVG(complete) OVER (ORDER BY seq ROWS 199 PRECEDING) AS k200 FROM s WINDOW o AS (ORDER BY seq)),
f AS (SELECT *, n >= 500 AND k200 >= 0.93 AND c200 <= 0.1 AS ready, c100 > 0.2 OR k100 < 0.9 AS fallback FROM w),
g AS (SELECT *, MAX(CASE WHEN NOT (ready AND fallback) THEN n END) OVER (ORDER BY seq) AS base FROM f),
h AS (SELECT g.seq, g.ready, b.ready AND NOT b.fallback AS was, g.n - g.base AS steps FROM g LEFT JOIN f b ON b.n = g.base)
SELECT seq, CASE WHEN COALESCE(was, FALSE) = (steps % 2 = 0) THEN 'enforce' ELSE 'shadow' END AS effective_mode FROM h""")
def auto_mode(spark, sf_dir):
    limit = F.when(F.floor(F.col("seq") / 400) % 3 == 1, 25).otherwise(7)
    series = records(spark, sf_dir).select("seq", (F.col("k") % 25 != 0).alias("complete"), (F.col("k") < limit).alias("candidate"))
    modes, _ = model.auto_modes(series, ModelFilter(enabled=True, minimum_input_completeness=0.93), True, True)
    return modes.select("seq", "effective_mode")


# ---- the exact scan


def scan_input(spark, sf_dir) -> DataFrame:
    return printed(records(spark, sf_dir)).withColumns({"family": F.lit("all"), "record_id": F.col("record_id").cast("string"), "quality_state": F.lit("decoded")})


def scanned(spark, sf_dir, rule: FieldRule, **more) -> DataFrame:
    return segments.scan_devices(scan_input(spark, sf_dir), ["value"], DynamicConfig(fields={"value": rule}, **more))


FOLD_SQL = f"WITH RECURSIVE {R}, o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY ts_us, record_id) AS n FROM r),"


@query(FOLD_SQL + """
t AS (SELECT device_id, n, record_id, value AS prev, FALSE AS hit, NULL::DOUBLE AS ref FROM o WHERE n = 1
  UNION ALL SELECT o.device_id, o.n, o.record_id, CASE WHEN ABS(o.value - t.prev) > 60 THEN t.prev ELSE o.value END, ABS(o.value - t.prev) > 60, t.prev FROM t JOIN o ON o.device_id = t.device_id AND o.n = t.n + 1)
SELECT record_id, ROUND(ref, 6) AS reference FROM t WHERE hit""")
def step_change_feedback(spark, sf_dir):
    found = scan.findings_of(scanned(spark, sf_dir, FieldRule(step_threshold=60.0)))
    return found.filter(F.col("candidate_flag") == "step_change").select(F.col("record_id").cast("long").alias("record_id"), *rounded("reference"))


@query(FOLD_SQL + """
t AS (SELECT device_id, n, record_id, [value] AS hist, FALSE AS hit FROM o WHERE n = 1
  UNION ALL SELECT device_id, n, record_id, CASE WHEN hit THEN hist ELSE LIST_CONCAT(hist, [value])[-20:] END, hit FROM (
    SELECT o.device_id, o.n, o.record_id, o.value, t.hist, LEN(t.hist) >= 10 AND ABS(o.value - LIST_MEDIAN(t.hist)) / GREATEST(1.4826 * LIST_MEDIAN(LIST_TRANSFORM(t.hist, LAMBDA x: ABS(x - LIST_MEDIAN(t.hist)))), 1.0) > 3.5 AS hit
    FROM t JOIN o ON o.device_id = t.device_id AND o.n = t.n + 1))
SELECT record_id FROM t WHERE hit""")
def mad_feedback(spark, sf_dir):
    found = scan.findings_of(scanned(spark, sf_dir, FieldRule(mad_score_threshold=3.5, minimum_scale=1.0)))
    return found.filter(F.col("candidate_flag") == "adaptive_outlier").select(F.col("record_id").cast("long").alias("record_id"))


@query(FOLD_SQL + """
t AS (SELECT device_id, n, record_id, value AS prev, NULL::DOUBLE AS q, 0 AS c, FALSE AS hit, FALSE AS shift, 1 AS version FROM o WHERE n = 1
  UNION ALL SELECT device_id, n, record_id, CASE WHEN hit AND NOT shift THEN prev ELSE value END, CASE WHEN hit AND NOT shift THEN value END, CASE WHEN hit AND NOT shift THEN c2 ELSE 0 END, hit, shift, version + shift::INT FROM (
    SELECT *, hit AND c2 >= 3 AS shift FROM (
      SELECT o.device_id, o.n, o.record_id, o.value, t.prev, t.version, ABS(o.value - t.prev) > 60 AS hit, CASE WHEN t.c > 0 AND ABS(o.value - t.q) <= 40 THEN t.c + 1 ELSE 1 END AS c2
      FROM t JOIN o ON o.device_id = t.device_id AND o.n = t.n + 1)))
SELECT record_id, version::BIGINT AS version FROM t WHERE shift""")
def baseline_reentry(spark, sf_dir):
    rule = FieldRule(step_threshold=60.0, baseline_reentry=Reentry(enabled=True, consecutive_samples=3, value_tolerance=40.0))
    found = scan.findings_of(scanned(spark, sf_dir, rule)).filter(F.col("candidate_flag") == "baseline_shift")
    return found.select(F.col("record_id").cast("long").alias("record_id"), F.col("threshold").cast("long").alias("version"))


@query(FOLD_SQL + """
t AS (SELECT device_id, n, record_id, value AS anchor, 1 AS c FROM o WHERE n = 1
  UNION ALL SELECT o.device_id, o.n, o.record_id, CASE WHEN ABS(o.value - t.anchor) <= 20 THEN t.anchor ELSE o.value END, CASE WHEN ABS(o.value - t.anchor) <= 20 THEN t.c + 1 ELSE 1 END FROM t JOIN o ON o.device_id = t.device_id AND o.n = t.n + 1)
SELECT record_id, ROUND(anchor, 6) AS reference, c::BIGINT AS run_count FROM t WHERE c >= 3""")
def stuck_run_tolerance(spark, sf_dir):
    found = scan.findings_of(scanned(spark, sf_dir, FieldRule(stuck_enabled=True, stuck_tolerance=20.0, stuck_sample_count=3)))
    return found.filter(F.col("candidate_flag") == "stuck_sensor").select(F.col("record_id").cast("long").alias("record_id"), *rounded("reference"), F.col("score").cast("long").alias("run_count"))


@query(f"""
WITH {R},
g AS (SELECT record_id, (ts_us - LAG(ts_us) OVER (PARTITION BY device_id ORDER BY ts_us, record_id)) / 1e6 AS elapsed FROM r)
SELECT record_id, ROUND(elapsed, 6) AS elapsed_seconds FROM g WHERE elapsed > 43200""")
def reporting_gap_scan(spark, sf_dir):
    found = scan.findings_of(scanned(spark, sf_dir, FieldRule(), expected_reporting={"all": Interval(6 * HOURS, 2.0)}))
    return found.filter(F.col("candidate_flag") == "reporting_gap").select(F.col("record_id").cast("long").alias("record_id"), *rounded("elapsed_seconds"))


@query(f"""
WITH RECURSIVE {R}, o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY ts_us, record_id) AS n FROM r),
t AS (SELECT device_id, n, record_id, ts_us, family, value AS prev, FALSE AS hit FROM o WHERE n = 1
  UNION ALL SELECT o.device_id, o.n, o.record_id, o.ts_us, o.family, CASE WHEN ABS(o.value - t.prev) > 60 THEN t.prev ELSE o.value END, ABS(o.value - t.prev) > 60 FROM t JOIN o ON o.device_id = t.device_id AND o.n = t.n + 1),
p AS (SELECT *, (ts_us - LAG(ts_us) OVER w) / 1e6 AS gap FROM t WHERE hit WINDOW w AS (PARTITION BY device_id ORDER BY ts_us, n)),
s AS (SELECT *, SUM(CASE WHEN gap IS NULL OR gap > 259200 THEN 1 ELSE 0 END) OVER (PARTITION BY device_id ORDER BY ts_us, n) AS session FROM p),
e AS (SELECT *, ROW_NUMBER() OVER w AS point_count, FIRST(ts_us) OVER w AS start_us FROM s WINDOW w AS (PARTITION BY device_id, session ORDER BY ts_us, n)),
c AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id, session ORDER BY ts_us, n) AS nth FROM e WHERE point_count >= 2 AND (ts_us - start_us) / 1e6 >= 3600)
SELECT device_id, start_us, ts_us AS end_us, point_count, CASE WHEN nth = 1 THEN 'confirmed' ELSE 'updated' END AS status FROM c
UNION ALL SELECT device_id, start_us, ts_us, point_count, 'closed' FROM e
WHERE session < (SELECT MAX(session) FROM e x WHERE x.device_id = e.device_id) AND point_count = (SELECT MAX(point_count) FROM e x WHERE x.device_id = e.device_id AND x.session = e.session)""")
def events_of_scan(spark, sf_dir):
    out = scanned(spark, sf_dir, FieldRule(step_threshold=60.0), events=POLICY)
    return scan.events_of(out).select("device_id", "start_us", "end_us", "point_count", "status")


# ---- records that can't be judged or leave no state


@query(f"""
WITH {R}
SELECT record_id, CASE WHEN record_id % 5 < 3 THEN 'invalid' ELSE 'decoded' END AS quality_state, CASE WHEN record_id % 5 < 3 THEN 'invalid_payload' ELSE '' END AS flags, '' AS tags, 0::BIGINT AS invalid_fields FROM r""")
def payload_guard(spark, sf_dir):
    """Payloads that are no object, no JSON or absent; a family that isn't known passes."""
    kind = F.col("record_id") % 5
    body = F.when(kind == 0, "[1, 2]").when(kind == 1, "nope").when(kind == 2, F.lit(None).cast("string")).otherwise(F.to_json(F.struct(F.lit(1).alias("gasValue"))))
    family = F.when(kind == 4, "unheard").otherwise("gas")
    return verdict(hard.apply_hard(as_input(records(spark, sf_dir), body, family)))


@query(FOLD_SQL + """
s AS (SELECT *, CASE WHEN k % 7 = 0 THEN 'invalid' WHEN k % 5 = 0 THEN 'undated' ELSE 'ok' END AS how FROM r),
q AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY ts_us, record_id) AS m FROM s WHERE how = 'ok'),
t AS (SELECT device_id, m, record_id, value AS prev, FALSE AS hit FROM q WHERE m = 1
  UNION ALL SELECT q.device_id, q.m, q.record_id, CASE WHEN ABS(q.value - t.prev) > 60 THEN t.prev ELSE q.value END, ABS(q.value - t.prev) > 60 FROM t JOIN q ON q.device_id = t.device_id AND q.m = t.m + 1)
SELECT record_id, 'adaptive.step_change' AS rule_id FROM t WHERE hit UNION ALL SELECT record_id, 'dynamic.timestamp_unavailable' FROM s WHERE how = 'undated'""")
def ineligible_records(spark, sf_dir):
    """Invalid records are passed by and undated ones are noted; neither becomes the value before the next one."""
    rows = scan_input(spark, sf_dir)
    invalid = F.col("k") % 7 == 0
    rows = rows.withColumns({"quality_state": F.when(invalid, "invalid").otherwise("decoded"), "ts_us": F.when(~invalid & (F.col("k") % 5 == 0), None).otherwise(F.col("ts_us"))})
    found = scan.findings_of(segments.scan_devices(rows, ["value"], DynamicConfig(fields={"value": FieldRule(step_threshold=60.0)})))
    return found.select(F.col("record_id").cast("long").alias("record_id"), "rule_id")


@query(f"""
WITH {R},
i AS (SELECT record_id, CASE WHEN family <> 'view' THEN 'family_not_applicable' WHEN k % 11 = 0 THEN 'missing_payload' WHEN k % 7 = 0 THEN 'missing_or_non_numeric:rtd3_t_x100' WHEN value > 100 THEN 'out_of_range:moist_pc' END AS skip_reason, value, k FROM r)
SELECT record_id, skip_reason, CASE WHEN skip_reason IS NULL THEN ROUND(value / 100, 6) END AS first, CASE WHEN skip_reason IS NULL THEN ROUND(value, 6) END AS moisture FROM i""")
def model_inputs(spark, sf_dir):
    r = records(spark, sf_dir)
    temps = [F.when(F.col("k") % 7 == 0, "x").otherwise(F.col("value").cast("string")).alias(f) if f == "rtd3_t_x100" else F.col("value").alias(f) for f in model.FEATURES[: model.TEMPERATURES]]
    body = F.when(F.col("k") % 11 != 0, F.to_json(F.struct(*temps, F.col("value").alias("moist_pc"), F.lit(50).alias("sleeper_rh"))))
    rows = as_input(r, body, F.when(F.col("family") == "view", "environment").otherwise("gas"))
    return model.model_input(rows).select("record_id", "skip_reason", F.round(f"in_{model.FEATURES[0]}", 6).alias("first"), F.round("in_moist_pc", 6).alias("moisture"))
