"""Static quality rules: each family's checks as column expressions over the payload.

A rule set gives labels (flags), the state they imply, tags, the number of invalid fields
and the payload fields to blank. Thresholds are literals, so absent rules cost nothing.
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V

# Limits and names of the record formats.
THRESHOLDS = {
    "environment": {"temp_abs_limit_x100": 20000.0},
    "microphone_fft": {"low_power_threshold": 5.0, "low_band_power_threshold": 1.0, "flatwheel_band_threshold": 20.0, "squeal_peak_freq_threshold": 8000.0, "squeal_centroid_threshold": 7000.0, "high_band_threshold": 15.0},
    "ae": {"low_energy_threshold": 10.0, "event_energy_threshold": 80.0, "event_amplitude_margin": 0.05},
}
FUNCTION_IDS = {"environment": ["0x41"], "microphone_fft": ["0x47", "0x48", "0x49", "0x4A", "0x4B"], "ae": ["0x4C", "0x4D", "0x4E", "0x4F"]}
TAGS = ["noise_like", "flatwheel_candidate", "squeal_candidate", "event_candidate"]
BANDS = ["band_0_100", "band_100_1000", "band_1000_5000", "band_5000_10000", "band_10000_15000", "band_15000_20000"]
NO_FIX = ["0", "false", "invalid", "no fix", "none", "not fixed", "unfixed"]
FAMILIES = ["environment", "gas", "gps_status", "network_context", "device_telemetry", "microphone_fft", "ae"]


def thresholds(overrides: dict | None = None) -> dict:
    """Defaults with partial overrides; unknown sections or names and values that aren't numbers are refused."""
    merged = {k: dict(v) for k, v in THRESHOLDS.items()}
    for section, given in (overrides or {}).items():
        if section not in merged:
            raise ValueError(f"unknown threshold section {section!r}")
        for name, value in given.items():
            if name not in merged[section]:
                raise ValueError(f"unknown threshold {section}.{name}")
            if isinstance(value, bool) or not isinstance(value, int | float):
                raise ValueError(f"{section}.{name} must be a number")
            merged[section][name] = float(value)
    return merged


@dataclass
class Verdict:
    """Conditions by flag, the conditions for each state, tags, invalid fields and fields to blank."""

    flags: list[tuple[str, Column]] = field(default_factory=list)
    suspect: Column = field(default_factory=lambda: F.lit(False))
    invalid: Column = field(default_factory=lambda: F.lit(False))
    tags: list[tuple[str, Column]] = field(default_factory=list)
    invalid_fields: Column = field(default_factory=lambda: F.lit(0))
    blank: list[tuple[str, Column]] = field(default_factory=list)


class Fields:
    """What a family's rules read of the payload, in two projections below the rules.

    ``READ`` has the payload's fields, each read once by one expression for all families;
    ``let`` keeps a condition that several results need, null for records of other families.
    """

    READ = "_read"

    def __init__(self, family: str, payload: Column):
        self.family, self.payload = family, payload
        self.kept: list[Column] = []

    def read(self, name: str, part: str) -> Column:
        return F.col(self.READ)[name][part]

    def number(self, name: str) -> Column:
        return self.read(name, "number")

    def present(self, name: str) -> Column:
        kind = self.read(name, "kind")
        return F.coalesce((kind != "VOID") & ((kind != "STRING") | self.read(name, "filled")), F.lit(False))

    def is_text(self, name: str) -> Column:
        return F.coalesce(self.read(name, "kind") == "STRING", F.lit(False))

    def is_filled(self, name: str) -> Column:
        return F.coalesce((self.read(name, "kind") == "STRING") & self.read(name, "filled"), F.lit(False))

    def boolean(self, name: str) -> Column:
        return V.boolean(self.payload[name])

    def let(self, condition: Column) -> Column:
        self.kept.append(condition)
        return F.col(f"_{self.family}")[f"c{len(self.kept) - 1}"]

    @staticmethod
    def read_all(payload: Column) -> Column:
        """Number, kind and whether a text is filled, for each field that the payload has."""

        def told(kind: Column, v: Column) -> Column:
            text = kind == "STRING"
            number = F.when(text, V.text_number(V.as_text(v))).when(kind != "BOOLEAN", F.try_variant_get(v, "$", "double"))
            return F.struct(number.alias("number"), kind.alias("kind"), F.when(text, F.btrim(V.as_text(v)) != "").alias("filled"))

        def one(_, v: Column) -> Column:
            return V.once(V.kind(v), lambda kind: told(kind, v))

        return F.when(F.col("family").isin(FAMILIES), F.transform_values(payload, one))

    def struct(self) -> Column:
        here = F.coalesce((F.col("family") == self.family) & self.payload.isNotNull(), F.lit(False))
        return F.when(here, F.struct(F.lit(True).alias("here"), *[c.alias(f"c{i}") for i, c in enumerate(self.kept)]))


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def count_of(conditions: list[Column]) -> Column:
    out = F.lit(0)
    for c in conditions:
        out = out + F.when(c, 1).otherwise(0)
    return out


def environment(p: Fields, limits: dict) -> Verdict:
    get = p.number
    bad = [p.let(V.outside(get(f), 0, 100)) for f in ("moist_pc", "sleeper_rh", "humidity_pct")]
    flood = get("flood_flag")
    bad.append(p.let(F.coalesce(~flood.isin(0.0, 1.0), F.lit(False))))
    bad.append(p.let(V.below(F.coalesce(get("rain_mm"), get("rainfall_mm")), 0)))
    limit, blank = limits["temp_abs_limit_x100"], []
    for f in ("rtd1_t_x100", "rtd2_t_x100", "rtd3_t_x100", "rtd4_t_x100", "tmp102_t_x100", "temperature_c"):
        over = p.let(V.above(F.abs(get(f)), limit / 100 if f == "temperature_c" else limit))
        bad.append(over)
        blank.append((f, over))
    missing = []
    for f, sentinel in (("year", 0xFFFF), *((part, 0xFF) for part in ("month", "day", "hour", "minute", "second"))):
        hit = p.let(F.coalesce(~p.is_text(f) & (get(f) == float(sentinel)), F.lit(False)))
        missing.append(hit)
        blank.append((f, hit))
    wrong, no_time = any_of(bad), any_of(missing)
    return Verdict([("invalid_value", wrong), ("invalid_gps_time", no_time)], suspect=wrong | no_time, invalid_fields=count_of(bad), blank=blank)


def structural(p: Fields, bad: list[Column], flag: str | None = None, incomplete: Column | None = None) -> Verdict:
    """Invalid if any field is bad; otherwise suspect with ``flag`` if ``incomplete``."""
    bad = list(map(p.let, bad))
    wrong, flags, suspect = any_of(bad), [], F.lit(False)
    flags.append(("invalid_value", wrong))
    if flag is not None:
        suspect = ~wrong & p.let(F.coalesce(incomplete, F.lit(False)))
        flags.append((flag, suspect))
    return Verdict(flags, suspect=suspect, invalid=wrong, invalid_fields=count_of(bad))


def present_but(p: Fields, name: str, wrong) -> Column:
    """The field is present and not a number, or a number for which ``wrong`` holds."""
    x = p.number(name)
    return p.present(name) & (x.isNull() | wrong(x))


def gas(p: Fields) -> Verdict:
    named = p.is_filled("gasType")
    bad = [present_but(p, "gasConc", lambda x: F.lit(False)), p.present("gasType") & ~named]
    return structural(p, bad, "incomplete_gas_measurement", named & ~p.present("gasConc"))


def unreliable_fix(v: Column) -> Column:
    """False, numbers up to 0, and texts that say there is no fix."""
    text = F.translate(F.lower(F.btrim(V.as_text(v))), "-_", "  ")
    by_text = (text != "") & (text.isin(NO_FIX) | text.contains("no fix") | text.contains("invalid"))
    by_kind = F.when(V.is_boolean(v), ~F.try_variant_get(v, "$", "boolean")).when(V.is_text(v), by_text).otherwise(V.at_most(V.number(v), 0))
    return ~V.is_absent(v) & F.coalesce(by_kind, F.lit(False))


def gps_status(p: Fields) -> Verdict:
    bad = [present_but(p, f, lambda x: V.below(x, 0)) for f in ("horizontalDilution", "numSatellites")]
    return structural(p, bad, "gps_fix_unreliable", unreliable_fix(p.payload["gpsFixStatus"]))


def network_context(p: Fields) -> Verdict:
    return structural(p, [present_but(p, "Bandwidth", lambda x: V.at_most(x, 0)), present_but(p, "SpreadFactor", lambda x: V.outside(x, 6, 12))])


def device_telemetry(p: Fields) -> Verdict:
    has = {f: p.present(f) for f in ("batteryVoltage", "inputVoltage", "batteryCharge", "MapStatus")}
    bad = [present_but(p, f, lambda x: V.at_most(x, 0)) for f in ("batteryVoltage", "inputVoltage")]
    bad.append(present_but(p, "batteryCharge", lambda x: F.lit(False)))
    alone = (has["batteryCharge"] | has["MapStatus"]) & ~(has["batteryVoltage"] | has["inputVoltage"])
    return structural(p, bad, "incomplete_device_telemetry", alone)


def quiet_decibels(payload: Column) -> Column:
    """Whether the map in decibels holds numbers and none of them is above -90."""
    nested = F.try_variant_get(payload["band_powers_db"], "$", "map<string,variant>")
    levels = F.filter(F.transform(F.map_values(nested), V.model_number), lambda x: x.isNotNull())
    return F.coalesce((F.size(levels) > 0) & F.forall(levels, lambda x: V.at_most(x, -90)), F.lit(False))


def microphone_fft(p: Fields, limits: dict) -> Verdict:
    """The six linear bands count if any of them is a number, else the map in decibels."""
    get = p.number
    bands = {b: get(b) for b in BANDS}
    power, power_db = get("total_power"), get("total_power_db")
    linear = p.let(any_of([x.isNotNull() for x in bands.values()]))
    wrong = p.let(V.at_most(power, 0) | V.outside(get("spectral_flatness"), 0, 1) | any_of([V.below(x, 0) for x in bands.values()]))
    # conditions that are kept can't refer to others, so what they share is repeated or left to the end
    loud = any_of([x.isNotNull() & ~V.at_most(x, limits["low_band_power_threshold"]) for x in bands.values()])
    quiet = linear & p.let(power.isNotNull() & V.at_most(power, limits["low_power_threshold"]) & ~loud)
    quiet_db = ~linear & p.let(power_db.isNotNull() & V.at_most(power_db, -100) & quiet_decibels(p.payload))
    wheel_band = bands["band_100_1000"]
    wheel = linear & p.let(power.isNotNull() & V.at_least(wheel_band, limits["flatwheel_band_threshold"]) & F.coalesce(wheel_band == F.greatest(*bands.values()), F.lit(False)))
    squeal = V.at_least(get("peak_freq_hz"), limits["squeal_peak_freq_threshold"]) & V.at_least(get("spectral_centroid_hz"), limits["squeal_centroid_threshold"])
    for b in BANDS[4:]:
        squeal = squeal & V.at_least(bands[b], limits["high_band_threshold"])
    return Verdict([("invalid_value", wrong)], invalid=wrong, tags=[("noise_like", ~wrong & (quiet | quiet_db)), ("flatwheel_candidate", ~wrong & wheel), ("squeal_candidate", ~wrong & linear & p.let(squeal))])


def ae(p: Fields, limits: dict) -> Verdict:
    get = p.number
    duration = F.coalesce(get("duration_s"), get("duration_us") / 1e6)
    energy = F.coalesce(get("energy_marse"), get("energy"))
    amplitude, floor = get("amplitude_v"), get("threshold_v")
    clock = p.let(F.coalesce(~p.boolean("source_node_clock_ok"), F.lit(False)))
    wrong = p.let(V.at_most(duration, 0) | V.below(get("counts"), 0) | V.below(energy, 0) | V.at_most(floor, 0))
    weak = V.at_most(amplitude, floor) & V.at_most(energy, limits["low_energy_threshold"]) & floor.isNotNull()
    strong = V.at_least(amplitude, floor + limits["event_amplitude_margin"]) & V.at_least(energy, limits["event_energy_threshold"]) & floor.isNotNull()
    return Verdict([("invalid_value", wrong), ("time_unreliable", clock)], suspect=clock, invalid=wrong, tags=[("noise_like", ~wrong & p.let(weak)), ("event_candidate", ~wrong & p.let(strong))])


RULES = {"environment": environment, "gas": gas, "gps_status": gps_status, "network_context": network_context, "device_telemetry": device_telemetry, "microphone_fft": microphone_fft, "ae": ae}


def normalize_semantics(df: DataFrame) -> DataFrame:
    """Labels cleaned; tags that lie among the flags move to the tags, and a suspect record that has no flag left is decoded again."""
    flags, tags = V.labels(F.col("quality_flags")), V.labels(F.col("analysis_tags"))
    known = F.array(*map(F.lit, TAGS))
    kept = F.array_except(flags, known)
    state = V.merge_states(F.col("quality_state"))
    moved = F.size(kept) < F.size(flags)
    state = F.when(moved & (F.size(kept) == 0) & (state == "suspect"), "decoded").otherwise(state)
    return df.withColumns({"quality_flags": kept, "analysis_tags": F.array_sort(F.array_union(tags, F.array_intersect(flags, known))), "quality_state": state})


def apply_hard(df: DataFrame, overrides: dict | None = None) -> DataFrame:
    """The static layer for records (family, function_id, payload, quality_state, quality_flags, analysis_tags, ...).

    Adds ``invalid_fields``; payload fields that fail are blanked where the family's rule says so.
    A record of a known family without a payload object is invalid. Unknown families pass.
    """
    df = normalize_semantics(df).withColumn("function_id", V.function_id(F.col("function_id")))
    names = [*df.columns, "invalid_fields"]
    limits = thresholds(overrides)
    read, kept, found, payload = layers(json.dumps(limits, sort_keys=True), id(SparkContext._gateway))
    return df.withColumns(read).withColumns(kept).withColumns(found).withColumn("payload", payload).select(*dict.fromkeys(names))


@functools.cache
def layers(limits_text: str, gateway: int) -> tuple[dict[str, Column], dict[str, Column], dict[str, Column], Column]:
    """The projections of all rules, one above the other. They name columns only, so they are made once for a set of limits (and a JVM)."""
    limits = json.loads(limits_text)
    p, family = F.col("payload"), F.coalesce(F.col("family"), F.lit(""))
    no_object = family.isin(FAMILIES) & p.isNull()
    kept, flags, tags, blank = {}, [(no_object, "invalid_payload")], [], []
    rank, count = F.when(no_object, 2).otherwise(0), F.lit(0)
    for name, rule in RULES.items():
        fields = Fields(name, p)
        v = rule(fields, limits[name]) if name in limits else rule(fields)
        here = F.col(f"_{name}").isNotNull()
        flags += [(here & c, f) for f, c in v.flags]
        tags += [(here & c, t) for t, c in v.tags]
        rank = F.when(here, F.when(v.invalid, 2).when(v.suspect, 1).otherwise(0)).otherwise(rank)
        count = F.when(here, v.invalid_fields).otherwise(count)
        blank += [(here & c, f) for f, c in v.blank]
        kept[f"_{name}"] = fields.struct()
    mismatch = F.lit(False)
    for name, ids in FUNCTION_IDS.items():
        mismatch = mismatch | ((family == name) & F.col("function_id").isNotNull() & ~F.col("function_id").isin(ids))
    flags.append((mismatch, "function_family_mismatch"))
    rank = F.greatest(rank, F.when(mismatch, 1).otherwise(0), V.state_rank(F.col("quality_state")))
    found = {
        "quality_flags": F.sort_array(F.array_union("quality_flags", V.chosen(flags))), "analysis_tags": F.sort_array(F.array_union("analysis_tags", V.chosen(tags))),
        "quality_state": V.state_of(rank), "invalid_fields": count, "_blank": V.chosen(blank),
    }
    clean = F.when(F.size("_blank") > 0, F.map_filter(p, lambda k, _: ~F.array_contains("_blank", k))).otherwise(p)
    return {Fields.READ: Fields.read_all(p)}, kept, found, clean


#: Tags and flags that the report counts by family (fixed values).
COUNTED = [("microphone_fft", "analysis_tags", t, f"microphone_{t}_count") for t in TAGS[:3]] + [("ae", "analysis_tags", t, f"ae_{t}_count") for t in ("noise_like", "event_candidate")] + [("ae", "quality_flags", "time_unreliable", "ae_time_unreliable_count")]


def hard_report(df: DataFrame) -> DataFrame:
    """One row of counters over cleaned records: totals, states, families, invalid fields, tags and unreliable clocks."""
    n = lambda c: F.count_if(c)
    family, state = F.coalesce(F.col("family"), F.lit("")), F.col("quality_state")
    aggs = [F.count(F.lit(1)).alias("total_decoded_records"), *[n(state == s).alias(f"{s}_records") for s in V.STATES]]
    aggs += [n(family == f).alias(f"{f}_records") for f in FAMILIES]
    aggs += [n(~family.isin(FAMILIES)).alias("other_records")]
    aggs += [F.coalesce(F.sum(F.when(family == f, F.col("invalid_fields"))), F.lit(0)).cast("long").alias(f"{f}_invalid_field_count") for f in FAMILIES[:5]]
    aggs += [n((family == f) & F.array_contains(column, label)).alias(name) for f, column, label, name in COUNTED]
    return df.agg(*aggs)
