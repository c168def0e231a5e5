"""Reading exports, JSON lines, training rows and state tables."""

from __future__ import annotations

import base64
import json
import os
import time
import urllib.error
import urllib.request
import uuid

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions import values as V

BOM = "﻿"
BASE_TEXT = ["record_id", "schema_version", "device_id", "batch_id", "function_id", "family", "timestamp", "source_time_utc", "ingest_time_utc", "source_type", "quality_state"]


class SourceError(RuntimeError):
    """A failure that is safe to show: it holds neither credentials nor response bodies."""


def fetch_json(url: str, user: str, password: str, timeout: float = 30.0) -> str:
    """The body of a GET with Basic auth. Errors name only the status or the kind of failure."""
    if not user or not password:
        raise SourceError("user and password must be set")
    token = base64.b64encode(f"{user}:{password}".encode()).decode("ascii")
    request = urllib.request.Request(url, headers={"accept": "application/json", "authorization": f"Basic {token}"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            body = response.read().decode("utf-8-sig")
    except urllib.error.HTTPError as e:
        raise SourceError("authentication failed" if e.code == 401 else f"the source answered with status {e.code}") from None
    except TimeoutError:
        raise SourceError("the source timed out") from None
    except (urllib.error.URLError, UnicodeDecodeError):
        raise SourceError("the source can't be read") from None
    check_export(body)
    return body


class HttpJsonSource(DataSource):
    """``spark.read.format("json_http")`` with options url, user_env, password_env and timeout: one row with the body.

    Options name environment variables of the executors, so no secret is part of a plan.
    """

    @classmethod
    def name(cls) -> str:
        return "json_http"

    def schema(self) -> str:
        return "body string"

    def reader(self, schema) -> DataSourceReader:
        return _HttpReader(dict(self.options))


class SnapshotStream(DataSource):
    """``spark.readStream.format("json_snapshots")``: the body of the source once in every slot of time, as (slot_us, body).

    Options as of ``json_http``, and ``slot_seconds`` (900) and ``spool``, a folder that driver and executors share. The first read of a
    slot puts its body into the spool, under its final name only when it is whole; a replay reads it from there, so a
    slot is the same in every attempt and after a restart. Slots that passed while nobody read aren't made up: a
    snapshot holds what the source has at the time. Committed slots leave the spool.
    """

    @classmethod
    def name(cls) -> str:
        return "json_snapshots"

    def schema(self) -> str:
        return "slot_us long, body string"

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _SnapshotReader(dict(self.options))


class _Slot(InputPartition):
    def __init__(self, slot: int):
        self.slot = slot


class _SnapshotReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        o = {k.lower(): v for k, v in options.items()}
        self.options, self.width = options, int(float(o.get("slot_seconds", 900)) * 1_000_000)
        self.store, self.spool = pafs.FileSystem.from_uri(o["spool"])
        self.spool_uri = o["spool"]

    def __getstate__(self):
        return {"options": self.options}

    def __setstate__(self, state):
        self.__init__(state["options"])

    def initialOffset(self) -> dict:  # noqa: N802
        return {"slot": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        now = time.time_ns() // 1000
        return {"slot": now - now % self.width}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Slot(end["slot"])] if end["slot"] > start["slot"] else []

    def read(self, partition: _Slot):
        name = f"{self.spool}/{partition.slot:020d}.json"
        if self.store.get_file_info(name).type == pafs.FileType.NotFound:
            body = next(_HttpReader(self.options).read(None))[0]
            own = f"{self.spool}/.{partition.slot:020d}-{uuid.uuid4().hex}"
            self.store.create_dir(self.spool, recursive=True)
            with self.store.open_output_stream(own) as out:
                out.write(body.encode("utf-8"))
            self.store.move(own, name)
        with self.store.open_input_stream(name) as f:
            yield (partition.slot, f.read().decode("utf-8"))

    def commit(self, end: dict) -> None:
        for f in self.store.get_file_info(pafs.FileSelector(self.spool, allow_not_found=True)):
            slot = f.base_name.removeprefix(".").partition(".")[0].partition("-")[0]
            if slot.isdigit() and int(slot) <= end["slot"]:
                self.store.delete_file(f.path)


class _HttpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        o = {k.lower(): v for k, v in self.options.items()}
        yield (fetch_json(o["url"], os.environ.get(o.get("user_env", "SOURCE_USER"), ""), os.environ.get(o.get("password_env", "SOURCE_PASSWORD"), ""), float(o.get("timeout", 30))),)


def check_export(body: str) -> None:
    """The envelope is an object with a list of results."""
    try:
        given = json.loads(body.removeprefix(BOM))
    except ValueError:
        raise SourceError("the export isn't JSON") from None
    if not isinstance(given, dict) or not isinstance(given.get("results"), list):
        raise SourceError("the export must be an object with a list of results")


def load_environment(path: str) -> None:
    """KEY=VALUE lines; variables that are set already stay."""
    with open(path, encoding="utf-8-sig") as f:
        for line in map(str.strip, f):
            if line and not line.startswith("#") and "=" in line:
                key, _, value = line.removeprefix("export ").partition("=")
                os.environ.setdefault(key.strip(), value.strip().strip("\"'"))


def read_exports(spark: SparkSession, path: str) -> DataFrame:
    """One row (body) for each export file; a byte order mark is dropped."""
    return spark.read.text(path, wholetext=True).select(F.ltrim(F.col("value"), F.lit(BOM)).alias("body"))


def export_rows(exports: DataFrame, body: str = "body", strict: bool = True) -> DataFrame:
    """Rows of all series that have a ``FirstPacket`` column, as ``row``: map of column name to variant.

    Malformed series, rows and other parts are skipped. A body that isn't an object with a list of
    results fails the job if ``strict``, else it has no rows. Of columns of one name the last wins;
    surplus values and columns are left out. The export itself is one JSON document, which bounds a task.
    """
    v = F.try_parse_json(F.col(body))
    results = F.try_variant_get(v, "$.results", "array<variant>")
    if strict:
        results = F.coalesce(results, F.raise_error(F.lit("the export must be an object with a list of results")).cast("array<variant>"))
    series = exports.select(F.explode(results).alias("r")).select(F.explode(F.try_variant_get("r", "$.series", "array<variant>")).alias("s"))
    parts = series.select(F.try_variant_get("s", "$.columns", "array<string>").alias("c"), F.try_variant_get("s", "$.values", "array<variant>").alias("v"))
    parts = parts.filter(F.array_contains("c", "FirstPacket")).select("c", F.explode("v").alias("one"))
    parts = parts.select("c", F.try_variant_get("one", "$", "array<variant>").alias("one")).filter(F.col("one").isNotNull())
    n = F.least(F.size("c"), F.size("one"))
    cells = F.arrays_zip(F.slice("c", 1, n).alias("k"), F.slice("one", 1, n).alias("x"))
    later = F.filter(cells, lambda cell, i: cell["k"].isNotNull() & ~F.array_contains(F.slice("c", i + 2, F.greatest(n - i - 1, F.lit(0))), cell["k"]))
    return parts.select(F.map_from_entries(F.transform(later, lambda cell: F.struct(cell["k"].alias("key"), cell["x"].alias("value")))).alias("row"))


def text_of(v: Column) -> Column:
    """Text of a variant; null for null, for blank text and for the text ``null``."""
    t = V.as_text(v)
    return F.when(~V.is_absent(v) & (F.btrim(t) != "") & (F.lower(F.btrim(t)) != "null"), t)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as (file, number, value), numbered from 1 in each file, blank ones too.

    Files are read in splits: the lines of each split are counted, and sums of the counts before it give the
    number of its first line. Within a split ids are consecutive. No line is moved.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value").withColumn("id", F.monotonically_increasing_id())
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("number"), "value")


def read_records(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """JSON lines as records: the base columns, ``payload`` (map of variants, null unless an object), labels and ``record_json``.

    Blank lines are skipped, and so are lines that aren't objects unless ``strict``, which fails on them and names the file
    and the line; the lines are counted first. Missing labels are empty lists. Unknown keys stay in ``record_json``.
    """
    place = None
    if strict:
        text = numbered_lines(spark, path)
        place = F.concat(F.lit("line "), F.col("number").cast("string"), F.lit(" of "), F.col("file"), F.lit(" isn't a JSON object"))
    else:
        text = spark.read.text(path)
    lines = text.withColumn("line", F.btrim(F.ltrim(F.col("value"), F.lit(BOM)))).filter(F.col("line") != "")
    return parse_records(lines, "line", strict, place)


def parse_records(lines: DataFrame, line: str, strict: bool = False, problem: Column | None = None) -> DataFrame:
    parsed = lines.withColumn("_v", F.try_parse_json(F.col(line))).withColumn("_o", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    parsed = parsed.withColumn("_v", F.when(F.col("_o"), F.col("_v")).otherwise(F.raise_error(F.lit("a line isn't a JSON object") if problem is None else problem).cast("variant"))) if strict else parsed.filter("_o")
    get = lambda name, kind: F.try_variant_get("_v", f"$.{name}", kind)
    texts = [get(name, "string").alias(name) for name in BASE_TEXT]
    lists = [F.coalesce(get(name, "array<string>"), F.array().cast("array<string>")).alias(name) for name in ("quality_flags", "analysis_tags")]
    maps = [get(name, "map<string,variant>").alias(name) for name in ("payload", "platform_meta", "raw_unmapped")]
    return parsed.select(*texts, *lists, *maps, F.col(line).alias("record_json"))


def with_identity(records: DataFrame) -> DataFrame:
    """Add ``ts_us`` (first time field that can be read) and replace ``device_id`` by the record's identity.

    A device id that is present but blank stays empty and does not fall through to the site.
    """
    times = [V.timestamp(F.col(c)) for c in ("timestamp", "source_time_utc", "ingest_time_utc")]
    site = F.concat_ws("|", *[F.coalesce(text_of(F.col("platform_meta")[f]), F.lit("")) for f in ("ControllerName", "Site", "Location", "Area")])
    given = F.coalesce(*[F.btrim(F.col(c)) for c in ("sleeper_id", "device_id", "gateway_id") if c in records.columns])
    named = F.when(given.isNotNull(), given).when(F.replace(site, F.lit("|"), F.lit("")) != "", F.concat(F.lit("platform:"), site))
    return records.withColumns({"ts_us": F.unix_micros(F.coalesce(*times)), "device_id": F.coalesce(named, F.concat(F.lit("source:"), F.col("source_type")), F.lit("unknown"))})


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """Labelled rows from CSV with a header, or from JSON ``{"records": [...]}``; all columns as text."""
    if path.lower().endswith(".csv"):
        return spark.read.csv(path, header=True)
    v = F.try_parse_json(F.ltrim(F.col("value"), F.lit(BOM)))
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.try_variant_get(v, "$.records", "array<variant>")).alias("v"))
    names = ["isAnomaly", "is_anomaly", "expectedDetector", "anomalyType", "rail1Temp", "rail2Temp", "sleeperTemp", "envMonIntTemp", "ambiantTemp", "moisture", "envMonHumidity"]
    return rows.select(*[F.try_variant_get("v", f"$.{n}", "string").alias(n) for n in names])


def label(value: Column) -> Column:
    """1 for ``1`` and ``true``, 0 for ``0`` and ``false``, null for anything else."""
    t = F.lower(F.btrim(value.cast("string")))
    return F.when(t.isin("1", "true"), 1).when(t.isin("0", "false"), 0)


def labelled(rows: DataFrame, features: list[str], percentages: list[str]) -> DataFrame:
    """Rows with an explicit label and finite features, percentages within 0 to 100."""
    flag = F.coalesce(*[label(F.col(c)) for c in ("isAnomaly", "is_anomaly") if c in rows.columns])
    out = rows.withColumns({"label": flag, **{f: V.finite(V.text_number(F.col(f).cast("string"))) for f in features}})
    ok = F.col("label").isNotNull()
    for f in features:
        ok = ok & F.col(f).isNotNull()
    for f in percentages:
        ok = ok & F.col(f).between(0, 100)
    return out.filter(ok)


def read_states(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a state table (device_id, state), or none."""
    from .sinks import current_version

    at = current_version(spark, path)
    return None if at is None else spark.read.parquet(f"{path}/version={at}")


def remote_state(table: DataFrame, key: str) -> DataFrame:
    """The states kept under a key."""
    if not key.strip():
        raise ValueError("a state key is required")
    return table.filter(F.col("state_key") == key)


def state_of_answer(answer: object) -> dict | None:
    """The state in a remote store's answer; none if it says that there is none. Any other answer is an error."""
    if not isinstance(answer, dict) or not isinstance(answer.get("found"), bool):
        raise ValueError("the answer doesn't say whether a state was found")
    if answer["found"] and not isinstance(answer.get("state_json"), dict):
        raise ValueError("the answer has no state")
    return answer["state_json"] if answer["found"] else None


def read_object(spark: SparkSession, path: str) -> DataFrame:
    """JSON objects, one for each file, as the variant ``object``; a file that holds anything else fails the job. An empty file has no row."""
    v = F.try_parse_json(F.ltrim(F.col("value"), F.lit(BOM)))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("not a JSON object: "), F.input_file_name())).cast("variant")
    return spark.read.text(path, wholetext=True).select(F.when(is_object, v).otherwise(wrong).alias("object"))
