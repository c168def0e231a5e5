"""The whole evaluation of a set of records: static rules, model, the exact scan, modes, enforcement and report."""

from __future__ import annotations

import zipfile
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DynamicConfig, ModelFilter, resolve_mode
from ..functions import values as V
from ..functions.scratch import materialize
from ..operators import dedup, events, hard, report, scan, segments
from ..operators.model import CANDIDATE_FLAG, FEATURES, Autoencoder, ModeState, auto_modes, model_input, score

EXTRA = "array<struct<layer:string,rule_id:string,candidate_flag:string,affected_fields:array<string>,score:double,threshold:double,state:string>>"
STATE_VERSION = 3


@dataclass
class Filtered:
    """records: cleaned and enforced, with ``filter_evidence``; the others are null in mode off. ``mode_state`` is kept for the next run."""

    records: DataFrame
    hard_report: DataFrame
    findings: DataFrame | None = None
    events: DataFrame | None = None
    dynamic_report: DataFrame | None = None
    states: DataFrame | None = None
    mode_state: ModeState | None = None


def numbered(records: DataFrame, index: str = "_index") -> DataFrame:
    """Add ``fingerprint`` and ``seq``, ascending in the order of device, time (undated last), family, id, payload and the input's ``index``.

    Ranges of (device, time) are sorted side by side; ``seq`` has gaps between ranges. It is fixed once the result is written.
    """
    text = dedup.canonical_payload(F.col("payload"))
    out = records.withColumn("_payload", text).withColumn("fingerprint", dedup.fingerprint([F.col(c) for c in ("device_id", "family", "record_id", "ts_us", "_payload")]))
    dated = F.col("ts_us").isNull()
    out = out.repartitionByRange("device_id", dated, "ts_us").sortWithinPartitions("device_id", dated, "ts_us", "family", "record_id", "_payload", index)
    return out.withColumn("seq", F.monotonically_increasing_id()).drop("_payload")


def finding(rule: str, **parts: Column) -> Column:
    """An entry of EXTRA with nulls for what isn't given."""
    kinds = {"candidate_flag": "string", "affected_fields": "array<string>", "score": "double", "threshold": "double", "state": "string"}
    return F.struct(F.lit("model").alias("layer"), F.lit(rule).alias("rule_id"), *[(parts[k] if k in parts else F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])


def model_findings(records: DataFrame, model: Autoencoder) -> DataFrame:
    """Add ``extra`` (the model's findings), ``complete`` and ``candidate`` for the automatic mode."""
    scored = score(model_input(records), model, [f"in_{f}" for f in FEATURES])
    found = finding("model.autoencoder_reconstruction", candidate_flag=F.when(F.col("is_candidate"), CANDIDATE_FLAG), affected_fields=F.col("affected_fields"), score=F.col("error"), threshold=F.lit(float(model.overall_threshold)))
    skipped = finding("model.autoencoder_not_evaluated", state=F.lit("not_evaluated"))
    valid, other = F.col("quality_state") != "invalid", F.col("skip_reason") == "family_not_applicable"
    extra = F.when(~valid | F.coalesce(other, F.lit(False)), F.array().cast(EXTRA)).when(F.col("skip_reason").isNull(), F.array(found).cast(EXTRA)).otherwise(F.array(skipped).cast(EXTRA))
    complete = F.when(valid & ~F.coalesce(other, F.lit(False)), F.col("skip_reason").isNull())
    return scored.withColumns({"extra": extra, "complete": complete, "candidate": F.when(complete, F.col("is_candidate"))}).select(*records.columns, "extra", "complete", "candidate")


def load_model(settings: ModelFilter) -> tuple[Autoencoder | None, str | None]:
    """The package at ``model_path``, or why it can't be had."""
    try:
        return Autoencoder.load(settings.model_path, FEATURES), None
    except (OSError, ValueError, KeyError, TypeError, zipfile.BadZipFile) as e:
        return None, str(e)


def filter_records(
    records: DataFrame, fields: Sequence[str] = (), mode: str | None = None, config: DynamicConfig | None = None, thresholds: dict | None = None,
    states: DataFrame | None = None, model: Autoencoder | None = None, mode_state: ModeState | None = None,
) -> Filtered:
    """Evaluate records (record_id, device_id, family, function_id, ts_us, quality_state, quality_flags, analysis_tags, payload, ...).

    ``fields``: payload fields that history and context rules read. Mode off, or a configuration that isn't enabled, stops after the
    static rules; ``shadow`` adds findings; ``enforce`` marks records; ``auto`` decides between the two
    record by record. ``states`` and ``mode_state`` are what an earlier run left. Without a ``model`` the configuration's package is
    loaded; where that fails, records are noted as not evaluated and the automatic mode stays in shadow.
    Null payloads and times, repeated records and empty tables are ordinary input. The
    cleaned and the scanned records are written once and read by all results.
    """
    mode = resolve_mode(mode, config is not None)
    clean = hard.apply_hard(records, thresholds)
    if mode == "off" or not (config or DynamicConfig()).enabled:
        return Filtered(clean, hard.hard_report(clean))
    config = config or DynamicConfig()
    # the place in the input, written with the records, is the last that tells equal records apart
    clean = materialize(clean.withColumn("_index", F.monotonically_increasing_id()), "clean-records")
    failure = None
    if config.model.enabled and model is None:
        model, failure = load_model(config.model)
    ordered = numbered(clean.withColumn("device_id", F.coalesce("device_id", F.lit("unknown"))))
    ordered = ordered.withColumns({f: V.finite_number(F.col("payload")[f]) for f in fields})
    if model is not None and config.model.enabled:
        ordered = model_findings(ordered, model)
    else:
        none, missing = F.lit(None).cast("boolean"), finding("model.autoencoder_unavailable", state=F.lit("not_evaluated"))
        extra = F.when(F.col("quality_state") != "invalid", F.array(missing).cast(EXTRA)).otherwise(F.array().cast(EXTRA)) if failure else F.array().cast(EXTRA)
        ordered = ordered.withColumns({"extra": extra, "complete": none, "candidate": none})
    ordered = materialize(ordered, "ordered-records")
    scanned = materialize(segments.scan_devices(ordered, list(fields), config, states), "scanned-records")
    judged = ordered.join(scanned.select("device_id", "seq", "duplicate", "flags", "findings"), ["device_id", "seq"])
    effective = F.lit(mode)
    validated, package = bool(model and model.validated), model.package_id if model else None
    last = (mode_state or ModeState(package)).for_package(package)
    last.failures += failure is not None
    if mode == "auto":
        series = judged.filter(F.col("quality_state") != "invalid").withColumns({c: F.when(~F.col("duplicate"), F.col(c)) for c in ("complete", "candidate")})
        modes, last = auto_modes(series, config.model, validated, config.events.enabled, ("device_id", "seq"), last, package)
        judged = judged.join(modes, ["device_id", "seq"], "left")
        effective = F.coalesce("effective_mode", F.lit("shadow"))
    else:
        last.effective_mode, last.reason = mode, f"requested_{mode}"
    before = V.state_rank(F.col("quality_state"))
    told = report.evidence(F.lit(mode), report.hard_evidence(F.col("quality_flags"), F.col("quality_state")), F.col("findings"))
    judged = judged.withColumns({"filter_evidence": told, "_before": before})
    marked = events.enforce(judged, F.when(F.col("quality_state") != "invalid", F.col("flags")), effective)
    final = marked.select(*[c for c in clean.columns if c != "_index"], "fingerprint", "seq", "duplicate", "filter_evidence")
    found, summaries = scan.findings_of(scanned), scan.events_of(scanned)
    more = marked.agg(F.count_if((F.col("_before") == 0) & (F.col("quality_state") == "suspect")).alias("enforced_suspect_count"), F.count_if(F.col("_before") == 2).alias("hard_invalid_count"), F.count(F.lit(1)).alias("hard_layer_records_evaluated"))
    head = {"requested_mode": mode, "filtering_mode": mode, "effective_mode": last.effective_mode, "mode_transition_reason": last.reason, "model_effective_mode": last.effective_mode, "model_load_failure": failure, "model_version": model.version if model else None}
    full = report.one_row(report.dynamic_report(found, summaries, scanned), report.state_counts(final), more)
    full = full.withColumns({k: F.lit(v).cast("string") for k, v in head.items()} | {"state_loaded": F.lit(states is not None), "state_schema_version": F.lit(STATE_VERSION)})
    return Filtered(final, hard.hard_report(clean.drop("_index")), found, summaries, full, scan.next_states(scanned, states), last)
