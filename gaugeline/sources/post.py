"""Posting a run to an HTTP ingest in parallel, with commit: a data source writer for batches and for streams.

Tasks post their rows in batches; every batch has a key made of the run and its content, so that a repeated
task or request can be told by the ingest and stored once. Tasks hand the counts of the answers to the driver, which checks their
sums and closes the run with its description and report; only then is the run complete. If a task or a check fails, the
run is closed as aborted. Secrets are named by environment variables of driver and executors and are no part of a plan.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .sinks import payload_problems

KINDS = ("record", "event", "state")
COUNTS = ("inserted_records", "updated_records", "skipped_records")


class PostError(RuntimeError):
    """A failure that is safe to show: it holds neither secrets nor bodies."""


def canonical(body: dict) -> bytes:
    return json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode("utf-8")


def post_json(url: str, secret: str, body: dict, timeout: float, retries: int, pause: float) -> dict:
    """The answer of a POST. Connection failures, time-outs and the statuses 408, 429 and 5xx are tried again with growing pauses."""
    headers = {"content-type": "application/json", "accept": "application/json", "apikey": secret}
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, data=canonical(body), method="POST", headers=headers), timeout=timeout) as answer:
                told = json.loads(answer.read().decode("utf-8"))
            if not isinstance(told, dict):
                raise PostError("the ingest's answer is no object")
            return told
        except urllib.error.HTTPError as e:
            failure, again = f"the ingest answered with status {e.code}", e.code in (408, 429) or e.code >= 500
        except (UnicodeDecodeError, json.JSONDecodeError):
            failure, again = "the ingest's answer is no JSON", False
        except TimeoutError:
            failure, again = "the ingest timed out", True
        except (urllib.error.URLError, ConnectionError):
            failure, again = "the ingest can't be reached", True
        if not again or attempt == retries:
            raise PostError(failure)
        time.sleep(pause * 2**attempt)
    raise PostError("no attempt was made")


@dataclass
class Posted(WriterCommitMessage):
    """What a task sent and what the answers counted, by kind."""

    sent: dict[str, int] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)

    def add(self, kind: str, sent: int, counts: dict[str, int]) -> None:
        self.sent[kind] = self.sent.get(kind, 0) + sent
        own = self.counts.setdefault(kind, dict.fromkeys(COUNTS, 0))
        for c in COUNTS:
            own[c] += counts[c]


def added(messages: Iterable[Posted | None]) -> Posted:
    total = Posted()
    for m in messages:
        for kind in m.sent if m else ():
            total.add(kind, m.sent[kind], m.counts[kind])
    return total


class _Client:
    """The requests of one run. ``suffix`` tells the micro-batches of a stream apart."""

    def __init__(self, options: dict[str, str]):
        o = {k.lower(): v for k, v in options.items()}
        self.url, self.secret_env = o["url"], o.get("secret_env", "INGEST_SECRET")
        self.run, self.report = json.loads(o["run"]), json.loads(o.get("report", "{}"))
        self.rows, self.bytes = int(o.get("batch_rows", 500)), int(o.get("batch_bytes", 1 << 20))
        self.limits = float(o.get("timeout", 30)), int(o.get("retries", 4)), float(o.get("pause", 0.5))
        if problems := payload_problems(self.run):
            raise PostError("; ".join(problems))

    def send(self, body: dict) -> dict:
        secret = os.environ.get(self.secret_env, "")
        if not secret:
            raise PostError(f"{self.secret_env} must be set")
        return post_json(self.url, secret, body, *self.limits)

    def described(self, suffix: str) -> dict:
        return {**self.run, "run_key": self.run["run_key"] + suffix}

    def batches(self, rows: Iterator[Row]) -> Iterator[tuple[str, list[str]]]:
        held: dict[str, list[str]] = {k: [] for k in KINDS}
        sizes = dict.fromkeys(KINDS, 0)
        for kind, body in rows:
            if kind not in held or body is None:
                raise PostError("a row has an unknown kind or no body")
            if held[kind] and (len(held[kind]) >= self.rows or sizes[kind] + len(body) > self.bytes):
                yield kind, held[kind]
                held[kind], sizes[kind] = [], 0
            held[kind].append(body)
            sizes[kind] += len(body)
        yield from ((k, x) for k, x in held.items() if x)

    def write(self, rows: Iterator[Row], suffix: str) -> Posted:
        run, done = self.described(suffix), Posted()
        for kind, bodies in self.batches(rows):
            key = hashlib.sha256("\n".join([run["run_key"], kind, *bodies]).encode()).hexdigest()
            answer = self.send({"step": "batch", "run_key": run["run_key"], "kind": kind, "batch_key": key, "items": [json.loads(b) for b in bodies]})
            counts = {c: answer.get(c) for c in COUNTS}
            if answer.get("success") is not True or answer.get("run_key") != run["run_key"] or answer.get("batch_key") != key:
                raise PostError("the ingest failed or answered for another batch")
            if any(not isinstance(n, int) or isinstance(n, bool) or n < 0 for n in counts.values()) or sum(counts.values()) != len(bodies):
                raise PostError("the ingest's counts don't sum to the items sent")
            done.add(kind, len(bodies), counts)
        return done

    def commit(self, messages: list, suffix: str) -> None:
        total, run = added(messages), self.described(suffix)
        answer = self.send({"step": "commit", "run_key": run["run_key"], "run": run, "quality_report": self.report, "sent": total.sent, "counts": total.counts})
        if answer.get("success") is not True or answer.get("run_key") != run["run_key"] or not str(answer.get("ingest_run_id") or "").strip():
            raise PostError("the ingest didn't confirm the run")
        if answer.get("stored") != total.sent:
            raise PostError("the ingest stored another number of items than were sent")

    def abort(self, suffix: str) -> None:
        # a run without commit is incomplete anyway; the failure that led here is the one to show
        with contextlib.suppress(PostError):
            self.send({"step": "abort", "run_key": self.described(suffix)["run_key"]})


class HttpIngestSink(DataSource):
    """``df.write.format("json_post")`` for rows (kind, body): body is the JSON text of a record, an event or a device's state.

    Options: ``url``; ``run``, the description of ``sinks.describe_run`` as JSON; ``report``, one JSON object; ``secret_env``, the name of the
    environment variable with the secret; ``batch_rows``, ``batch_bytes``, ``timeout``, ``retries``, ``pause``. A stream writes each micro-batch as a
    run of its own, with the batch's number behind the key, so a replayed micro-batch is told by its key.
    """

    @classmethod
    def name(cls) -> str:
        return "json_post"

    def schema(self) -> str:
        return "kind string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _BatchWriter(check_schema(schema, dict(self.options)))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802
        return _StreamWriter(check_schema(schema, dict(self.options)))


def check_schema(schema: StructType, options: dict[str, str]) -> dict[str, str]:
    if [(f.name, f.dataType.simpleString()) for f in schema] != [("kind", "string"), ("body", "string")]:
        raise PostError("rows are (kind string, body string)")
    _Client(options)
    return options


class _BatchWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def write(self, iterator: Iterator[Row]) -> Posted:
        return _Client(self.options).write(iterator, "")

    def commit(self, messages: list) -> None:
        _Client(self.options).commit(messages, "")

    def abort(self, messages: list) -> None:
        _Client(self.options).abort("")


class _StreamWriter(DataSourceStreamWriter):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def write(self, iterator: Iterator[Row]) -> Posted:
        # Spark's local property of the micro-batch's number
        batch = TaskContext.get().getLocalProperty("streaming.sql.batchId")
        if batch is None:
            raise PostError("the task doesn't know its micro-batch")
        return _Client(self.options).write(iterator, f":{batch}")

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        _Client(self.options).commit(messages, f":{batchId}")

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        _Client(self.options).abort(f":{batchId}")


def outgoing(records: DataFrame, events: DataFrame | None = None, states: DataFrame | None = None) -> DataFrame:
    """Rows (kind, body) of a run; nulls are part of a body."""
    parts = {"record": records, "event": events, "state": states}
    out = None
    for kind, df in parts.items():
        if df is not None:
            own = df.select(F.lit(kind).alias("kind"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("body"))
            out = own if out is None else out.unionByName(own)
    return out


def post_run(url: str, run: dict, report: DataFrame, records: DataFrame, events: DataFrame | None = None, states: DataFrame | None = None, **options: object) -> None:
    """Post a run: prepared records, events and states by the tasks, the report (one row) with the commit. Raises if any of it isn't confirmed."""
    records.sparkSession.dataSource.register(HttpIngestSink)
    told = report.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()
    given = {"url": url, "run": json.dumps(run, sort_keys=True), "report": told[0] if told else "{}", **{k: str(v) for k, v in options.items()}}
    outgoing(records, events, states).write.format("json_post").options(**given).mode("append").save()
