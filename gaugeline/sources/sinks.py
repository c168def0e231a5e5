"""Writing records, reports, versioned state and the ingest tables; every write can be repeated."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.scratch import discard, materialize
from .records import current_rows, upsert


def write_records(df: DataFrame, path: str) -> None:
    """JSON lines, nulls included."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report is one row."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def current_version(spark: SparkSession, path: str) -> int | None:
    """The newest version whose write was committed."""
    fs, at = _path(spark, path)
    if not fs.exists(at):
        return None
    names = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("version=")]
    done = [int(p.getName().partition("=")[2]) for p in names if fs.exists(_path(spark, f"{p.toString()}/_SUCCESS")[1])]
    return max(done, default=None)


def write_states(states: DataFrame, path: str) -> int:
    """A new version beside the old ones. A version counts once its success marker exists, so a reader never sees half a state."""
    spark = states.sparkSession
    version = (current_version(spark, path) or 0) + 1
    states.write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def prepare(records: DataFrame, source_type: str) -> DataFrame:
    """Records for ingest: required texts and time checked, ids unique, defaults filled, ``record_fingerprint`` set.

    A blank id or family, a missing time or an id on two rows fails the job. Uniqueness is one
    aggregation over the ids, whose rows aren't moved.
    """
    empty = F.array().cast("array<string>")
    problem = F.when(F.coalesce(F.btrim("record_id"), F.lit("")) == "", "a record has no record_id")
    problem = problem.when(F.coalesce(F.btrim("family"), F.lit("")) == "", "a record has no family").when(F.col("ts_us").isNull(), "a record has no time")
    checked = records.withColumn("record_id", F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.col("record_id")))
    repeats = records.groupBy("record_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    if repeats:
        raise ValueError("a record_id is on more than one record")
    filled = {"source_type": F.coalesce(F.col("source_type"), F.lit(source_type)) if "source_type" in records.columns else F.lit(source_type), "quality_state": V.merge_states(F.col("quality_state"))}
    filled |= {c: F.coalesce(F.col(c), empty) if c in records.columns else empty for c in ("quality_flags", "analysis_tags")}
    if "fingerprint" in records.columns:
        filled["record_fingerprint"] = F.col("fingerprint")
    return checked.withColumns(filled)


def ingest_rows(prepared: DataFrame, run_key: str, mode: str, pipeline_version: str, config_hash: str | None) -> DataFrame:
    """Rows of the processed-records table."""
    return prepared.withColumns({"run_key": F.lit(run_key), "filtering_mode": F.lit(mode), "pipeline_version": F.lit(pipeline_version), "dynamic_config_hash": F.lit(config_hash).cast("string")})


def describe_run(run_key: str, source_file_name: str, source_name: str, source_type: str, mode: str, pipeline_version: str, execution_slot: str, config_hash: str | None = None, state_schema_version: int = 3) -> dict:
    """The description of a run that goes with its records; an incomplete one is an error."""
    run = {"run_key": run_key, "source_name": source_name, "source_file_name": source_file_name, "source_type": source_type, "pipeline_version": pipeline_version}
    run |= {"filtering_mode": mode, "dynamic_config_hash": config_hash, "state_schema_version": state_schema_version, "execution_slot": execution_slot}
    if problems := payload_problems(run):
        raise ValueError("; ".join(problems))
    return run


def payload_problems(run: dict) -> list[str]:
    """Why a run description can't be accepted; empty if it can."""
    texts = ("run_key", "source_name", "source_file_name", "source_type", "pipeline_version", "execution_slot", "filtering_mode")
    out = [f"{k} is required" for k in texts if not isinstance(run.get(k), str) or not run[k].strip()]
    if run.get("filtering_mode") not in ("off", "shadow", "auto", "enforce"):
        out.append("unknown filtering_mode")
    return out


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> dict[str, int]:
    """Append rows whose keys the Parquet table doesn't hold yet; returns how many were inserted and skipped.

    A repeated call inserts nothing. Only the keys of the table are read, and ``df`` is computed once.
    """
    spark = df.sparkSession
    fs, at = _path(spark, path)
    given = materialize(df, "given")
    fresh = given.dropDuplicates(list(keys))
    if fs.exists(at):
        fresh = fresh.join(spark.read.parquet(path).select(*keys), list(keys), "left_anti")
    fresh = materialize(fresh, "fresh")
    fresh.write.mode("append").parquet(path)
    total, inserted = given.count(), fresh.count()
    discard(given, fresh)
    return {"inserted_records": inserted, "skipped_records": total - inserted}


def ingest(root: str, run: dict, report: DataFrame, records: DataFrame, events: DataFrame, states: DataFrame | None) -> dict:
    """Write a run into the four tables. The run's row comes last, so a run that is listed is complete; a repeat changes nothing."""
    problems = payload_problems(run)
    if problems:
        raise ValueError("; ".join(problems))
    counts = upsert(ingest_rows(records, run["run_key"], run["filtering_mode"], run["pipeline_version"], run.get("dynamic_config_hash")), f"{root}/processed_records")
    stored = append_new(events.withColumn("run_key", F.lit(run["run_key"])), f"{root}/anomaly_events", ["run_key", "event_id", "status", "point_count"])
    if states is not None:
        write_states(states, f"{root}/dynamic_filter_state/{run['run_key']}")
    row = report.select(F.lit(run["run_key"]).alias("run_key"), F.lit(json.dumps(run, sort_keys=True)).alias("run"), F.to_json(F.struct("*")).alias("quality_report"))
    append_new(row, f"{root}/ingest_runs", ["run_key"])
    answer = {"success": True, "run_key": run["run_key"], **counts, "anomaly_events": stored["inserted_records"], "state_saved": states is not None}
    check_answer(answer, run["run_key"], sum(counts.values()))
    return answer


def check_answer(answer: dict, run_key: str, sent: int) -> None:
    """The contract of an ingest answer: its counts are not negative and sum to what was sent, and it echoes the key."""
    counts = [answer.get(k) for k in ("inserted_records", "updated_records", "skipped_records")]
    if answer.get("success") is not True or answer.get("run_key") != run_key:
        raise ValueError("the ingest failed or answered for another run")
    if any(not isinstance(n, int) or isinstance(n, bool) or n < 0 for n in counts) or sum(counts) != sent:
        raise ValueError("the ingest's counts don't sum to the records sent")


def typed_view(records: DataFrame, family: str, fields: Sequence[str], source_type: str | None = None) -> DataFrame:
    """Records of a family with payload fields as numbers; what isn't a number becomes null."""
    rows = records.filter(F.col("family") == family)
    if source_type is not None:
        rows = rows.filter(F.col("source_type") == source_type)
    return rows.select("record_id", "device_id", "ts_us", "quality_state", *[V.finite_number(F.col("payload")[f]).alias(f) for f in fields])


def foreach_batch(root: str, make: callable) -> callable:
    """A ``foreachBatch`` function that ingests ``make(df, batch_id)`` = (run, report, records, events, states); replays are skipped by key."""

    def write(df: DataFrame, batch_id: int) -> None:
        ingest(root, *make(df, batch_id))

    return write
