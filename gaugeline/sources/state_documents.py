"""State documents, one JSON text with the state of all devices, in versions 1 to 3, as rows of (device_id, state).

The document's maps are exploded into cells by device; the cells of a device are put together into the
state that the scan takes. Keys of cells are JSON arrays, or in older documents texts parted by ``|``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators.scan import DeviceState, Series
from .exports import BOM

# The names of a document's parts.
VALUE = "struct<value:double,timestamp:string,record_id:string>"
EVENT = "struct<event_id:string,family:string,field:string,candidate_flag:string,start_time_utc:string,end_time_utc:string,point_count:bigint,contributing_record_ids:array<string>,confirmed:boolean>"
DOCUMENT = f"""state_schema_version int,
adaptive struct<histories:map<string,array<{VALUE}>>,previous_values:map<string,{VALUE}>,stuck_runs:map<string,struct<value:double,count:bigint,start_timestamp:string>>,
  last_seen_by_device_family:map<string,string>,reported_silence_events:array<array<string>>,
  quarantines:map<string,struct<values:array<{VALUE}>,start_timestamp:string,consecutive_count:bigint>>,baseline_versions:map<string,bigint>>,
context struct<latest_by_device_family:map<string,struct<timestamp:string,record:struct<record_id:string,payload:string>>>>,
events struct<active_events:map<string,{EVENT}>,active_points:map<string,array<struct<record_id:string,timestamp:string>>>>,
deduplication struct<entries:array<struct<fingerprint:string,device_id:string>>>"""
VERSIONS = (1, 2, 3)


def key_parts(key: Column, n: int) -> Column:
    """The ``n`` parts of a cell's key, the first of which is the device; a key that has other parts fails the job."""
    told = F.from_json(key, "array<string>")
    # an older key: the last n - 1 parts hold no bar
    old = F.array(*[F.regexp_extract(key, r"(?s)^(.+)" + r"\|([^|]+)" * (n - 1) + "$", i) for i in range(1, n + 1)])
    parts = F.when((F.size(told) == n) & F.forall(told, lambda p: p.isNotNull()), told).when(old[0] != "", old)
    return F.coalesce(parts, F.raise_error(F.concat(F.lit("the state has a malformed key: "), key)).cast("array<string>"))


def us_of(text: Column) -> Column:
    return F.unix_micros(V.timestamp(text))


def cells(document: DataFrame) -> DataFrame:
    """(device_id, kind, name, body): the document's cells, ``body`` as JSON with times in microseconds."""
    history = lambda xs: F.transform(xs, lambda x: x["value"])
    value = lambda x: F.array(x["value"].cast("double"), us_of(x["timestamp"]).cast("double"))
    maps = [
        ("history", "adaptive.histories", 3, history),
        ("previous", "adaptive.previous_values", 3, value),
        ("run", "adaptive.stuck_runs", 3, lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count"), us_of(x["start_timestamp"]).alias("us"))),
        ("last", "adaptive.last_seen_by_device_family", 2, us_of),
        ("quarantine", "adaptive.quarantines", 3, lambda x: F.struct(history(x["values"]).alias("values"), us_of(x["start_timestamp"]).alias("us"), x["consecutive_count"].alias("count"))),
        ("version", "adaptive.baseline_versions", 3, lambda x: x),
        ("context", "context.latest_by_device_family", 2, lambda x: F.struct(us_of(x["timestamp"]).alias("us"), x["record"]["record_id"].alias("record_id"), x["record"]["payload"].alias("payload"))),
        ("event", "events.active_events", 4, lambda x: F.struct(*[x[c].alias(c) for c in ("event_id", "family", "field", "candidate_flag", "point_count", "contributing_record_ids", "confirmed")], us_of(x["start_time_utc"]).alias("start_us"), us_of(x["end_time_utc"]).alias("end_us"))),
        ("points", "events.active_points", 4, lambda x: F.transform(x, lambda p: F.struct(us_of(p["timestamp"]).alias("us"), p["record_id"].alias("record_id")))),
    ]
    parts = []
    for kind, where, n, body in maps:
        one = document.select("state_schema_version", F.explode(where).alias("key", "x"))
        one = one.withColumn("parts", key_parts(F.col("key"), n))
        parts.append(one.select(F.col("parts")[0].alias("device_id"), F.lit(kind).alias("kind"), F.array_join(F.slice("parts", 2, n), "|").alias("name"), F.to_json(F.struct(body(F.col("x")).alias("x"))).alias("body")))
    marks = document.select(F.explode("adaptive.reported_silence_events").alias("m"))
    parts.append(marks.select(F.col("m")[0].alias("device_id"), F.lit("silence").alias("kind"), F.col("m")[1].alias("name"), F.to_json(F.struct(us_of(F.col("m")[2]).alias("x"))).alias("body")))
    # documents of version 1 have fingerprints of another kind
    entries = document.filter("state_schema_version > 1").select(F.posexplode("deduplication.entries").alias("place", "e"))
    parts.append(entries.select("e.device_id", F.lit("ledger").alias("kind"), F.col("e.fingerprint").alias("name"), F.to_json(F.struct(F.col("place").alias("x"))).alias("body")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def put_together(device: str, rows: Iterable[tuple[str, str, dict]]) -> DeviceState:
    """A device's state from its cells (kind, name, content)."""
    state = DeviceState()
    for kind, name, x in rows:
        if kind in ("history", "previous", "run", "quarantine", "version"):
            s = state.series.setdefault(name, Series())
            if kind == "history":
                s.history = x
            elif kind == "previous":
                s.previous = [x[0], None if x[1] is None else int(x[1])]
            elif kind == "run":
                s.run = [x["value"], x["count"], x.get("us")]
            elif kind == "quarantine":
                s.quarantine = [x["values"], x.get("us"), x["count"]]
            else:
                s.version = x
        elif kind == "last":
            state.last_seen[name] = x
        elif kind == "silence":
            state.silences.append(f"{name}|{x}")
        elif kind == "context":
            payload = json.loads(x.get("payload") or "{}")
            finite = {k: float(v) for k, v in payload.items() if isinstance(v, int | float) and not isinstance(v, bool) and math.isfinite(v)}
            state.context[name] = {"us": x.get("us"), "values": finite, "record_id": x.get("record_id") or ""}
        elif kind == "event":
            keep = ("event_id", "family", "field", "candidate_flag", "start_us", "end_us", "point_count")
            state.open_events[name] = {**{k: x[k] for k in keep}, "record_ids": x.get("contributing_record_ids") or [], "confirmed": bool(x.get("confirmed"))}
        elif kind == "points" and x:
            family, field, flag = name.rsplit("|", 2)
            own = sorted(x, key=lambda p: p["us"])
            state.open_events[name] = {"event_id": f"event:{device}|{name}|{own[0]['us']}", "family": family, "field": field, "candidate_flag": flag, "start_us": own[0]["us"], "end_us": own[-1]["us"], "point_count": len(own), "record_ids": [p.get("record_id") or "" for p in own], "confirmed": False}
        elif kind == "ledger":
            state.ledger.append([name, x])
    state.silences.sort()
    state.ledger.sort(key=lambda e: e[1])
    return state


def read_state_document(spark: SparkSession, path: str) -> DataFrame:
    """(device_id, state) of a state document, for ``scan_devices``, ``scan_stream`` and ``filter_records``.

    Versions 1, 2 and 3 are read; another version, a text that is no object, or a malformed key fails the job. Of version 1 the
    fingerprints are left out and points of open events become events. Parts that are absent count as empty. Ledger
    entries keep their order; fingerprints of another program match only what it made itself.
    """
    text = spark.read.text(path, wholetext=True).select(F.ltrim(F.col("value"), F.lit(BOM)).alias("value"))
    document = text.select(F.from_json("value", DOCUMENT).alias("d")).select("d.*")
    version = F.col("state_schema_version")
    problem = F.concat(F.lit("not a state document of version 1, 2 or 3: "), F.coalesce(version.cast("string"), F.lit("none")))
    document = document.withColumn("state_schema_version", F.when(version.isin(*VERSIONS), version).otherwise(F.raise_error(problem).cast("int")))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(k, n, json.loads(b).get("x")) for k, n, b in zip(pdf["kind"], pdf["name"], pdf["body"], strict=True)]
        return pd.DataFrame([(key[0], put_together(key[0], rows).dump())], columns=["device_id", "state"])

    return cells(document).groupBy("device_id").applyInPandas(build, "device_id string, state string")
