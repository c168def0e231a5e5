"""Counters over findings, events and final states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V

LAYERS = ("context", "adaptive", "model", "sequence")


def state_counts(records: DataFrame) -> DataFrame:
    """One row: records in total and in each state."""
    return records.agg(F.count(F.lit(1)).alias("total_records"), *[F.count_if(V.merge_states(F.col("quality_state")) == s).alias(f"{s}_records") for s in V.STATES])


HARD = "array<struct<rule_id:string,flag:string,state:string>>"


def hard_evidence(flags: Column, state: Column) -> Column:
    """An entry for each flag, and one for the state unless it is decoded."""
    none = F.lit(None).cast("string")
    per_flag = F.transform(flags, lambda f: F.struct(F.lit("hard.quality_flag").alias("rule_id"), f.alias("flag"), none.alias("state")))
    of_state = F.when(state != "decoded", F.array(F.struct(F.lit("hard.quality_state").alias("rule_id"), none.alias("flag"), state.alias("state")))).otherwise(F.array().cast(HARD))
    return F.concat(per_flag, of_state)


def evidence(mode: Column, hard: Column, findings: Column) -> Column:
    """What each layer says about a record: mode, the static layer's entries, and the findings by layer."""

    def of(layer: str) -> Column:
        return F.filter(findings, lambda f: f["layer"] == layer).alias(layer)

    return F.struct(mode.alias("mode"), hard.alias("hard"), *map(of, LAYERS))


def trigger_counts(findings: DataFrame, by: str) -> DataFrame:
    """Candidates by rule, family or device: partial sums, then a row for each value."""
    rows = findings.filter(F.col("candidate_flag").isNotNull())
    return rows.groupBy(F.coalesce(F.col(by), F.lit("unknown")).alias(by)).agg(F.count(F.lit(1)).alias("n"))


def dynamic_report(findings: DataFrame, events: DataFrame, scanned: DataFrame) -> DataFrame:
    """One row of counters over (layer, rule_id, candidate_flag, state), event summaries and scanned records."""
    hit = F.col("candidate_flag").isNotNull()
    is_layer = {k: F.col("layer") == k for k in LAYERS}
    f = findings.agg(
        *[F.count_if(is_layer[k] & hit).alias(f"{k}_candidate_count") for k in LAYERS[:3]], F.count_if((is_layer["context"] | is_layer["adaptive"]) & hit).alias("event_candidate_count"),
        F.count_if(F.col("rule_id") == "adaptive.cold_start").alias("cold_start_count"), F.count_if(F.col("rule_id") == "adaptive.baseline_shift").alias("baseline_shift_count"),
        F.count_if(F.col("rule_id") == "dynamic.timestamp_unavailable").alias("timestamp_not_evaluated_count"),
        F.count_if(F.col("candidate_flag") == "reporting_gap").alias("reporting_gap_count"), F.count_if(F.col("candidate_flag") == "family_silence").alias("family_silence_count"),
        F.count_if(F.col("rule_id") == "model.autoencoder_reconstruction").alias("model_records_evaluated"), F.count_if(F.col("rule_id") == "model.autoencoder_not_evaluated").alias("model_records_skipped"),
    )
    e = events.agg(F.count_if(F.col("status") == "confirmed").alias("confirmed_anomaly_event_count"))
    # quarantines that are open when the records end, from the states that devices' last rows carry
    series = F.map_values(F.from_json("state", "series map<string,struct<quarantine:string>>")["series"])
    d = scanned.agg(F.count_if("duplicate").alias("duplicate_state_update_count"), F.coalesce(F.sum(F.size(F.filter(series, lambda s: s["quarantine"].isNotNull()))), F.lit(0)).alias("quarantine_active_count"))
    return one_row(f, e, d)


def one_row(*rows: DataFrame) -> DataFrame:
    """Single rows side by side."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
