"""Posting runs to an ingest that fails, repeats and miscounts, and reading snapshots as a stream."""

import http.server
import json
import threading
import time

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeline.sources import exports, post, sinks

RUN = sinks.describe_run("run:1", "file.json", "source", "sensor_export", "enforce", "p1", "2024-01-01T00:00:00Z")


class Ingest:
    """A plain ingest: batches are stored once by key, a run is complete after its commit."""

    def __init__(self):
        self.batches, self.runs, self.aborted, self.requests, self.secrets = {}, {}, [], 0, set()
        self.fail_every, self.fail_always, self.miscount, self.lose = 0, None, False, False
        self.lock = threading.Lock()

    def answer(self, body):
        key = body["run_key"]
        if body["step"] == "abort":
            self.aborted.append(key)
            return {"success": True, "run_key": key}
        if body["step"] == "batch":
            if not self.lose:
                self.batches.setdefault((key, body["batch_key"]), (body["kind"], body["items"]))
            n = len(body["items"])
            return {"success": True, "run_key": key, "batch_key": body["batch_key"], "inserted_records": n + self.miscount, "updated_records": 0, "skipped_records": 0}
        stored = {}
        for (run, _), (kind, items) in self.batches.items():
            if run == key:
                stored[kind] = stored.get(kind, 0) + len(items)
        self.runs[key] = body
        return {"success": True, "run_key": key, "ingest_run_id": "7", "stored": stored}


@pytest.fixture
def ingest():
    own = Ingest()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["content-length"])))
            with own.lock:
                own.requests += 1
                own.secrets.add(self.headers["apikey"])
                told = own.answer(body)
                # an answer that is lost after the batch was stored: the repeat must not store it twice
                status = own.fail_always or (503 if own.fail_every and own.requests % own.fail_every == 0 else 200)
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps(told).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    own.url = f"http://127.0.0.1:{server.server_port}"
    yield own
    server.shutdown()


def rows(spark, n):
    return spark.range(n).repartition(4).select(F.col("id").cast("string").alias("record_id"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("value"), F.lit("é\n").alias("text"))


def items(ingest, kind, run="run:1"):
    return [i for (r, _), (k, x) in ingest.batches.items() if k == kind and r == run for i in x]


def test_a_run_is_posted_once_though_answers_are_lost(spark, ingest):
    ingest.fail_every = 3
    report = spark.createDataFrame([(103, None)], "total_records long, note string")
    events = spark.createDataFrame([("e1", 2)], "event_id string, point_count long")
    for _ in range(2):  # the whole run again, as after a crash before the commit
        post.post_run(ingest.url, RUN, report, rows(spark, 103), events, batch_rows=10, pause=0.01)
    got = items(ingest, "record")
    assert sorted(int(r["record_id"]) for r in got) == list(range(103)) and all(r["text"] == "é\n" and "value" in r for r in got)
    assert items(ingest, "event") == [{"event_id": "e1", "point_count": 2}]
    closed = ingest.runs["run:1"]
    assert closed["sent"] == {"record": 103, "event": 1} and closed["quality_report"] == {"total_records": 103, "note": None} and closed["run"]["filtering_mode"] == "enforce"
    assert max(len(x) for _, x in ingest.batches.values()) <= 10 and ingest.secrets == {"s3cret"} and not ingest.aborted


@pytest.mark.parametrize("fault", ["miscount", "lose", "fail_always"])
def test_runs_that_are_not_confirmed_fail_and_are_aborted(spark, ingest, fault):
    setattr(ingest, fault, 400 if fault == "fail_always" else True)
    report = spark.createDataFrame([(1,)], "total_records long")
    with pytest.raises((PySparkException, Py4JJavaError)) as e:
        post.post_run(ingest.url, RUN, report, rows(spark, 30), batch_rows=7, retries=1, pause=0.01)
    assert "s3cret" not in str(e.value)
    assert ingest.aborted and "run:1" not in ingest.runs or fault == "lose"


def test_bad_runs_and_rows_are_refused(spark, ingest):
    report = spark.createDataFrame([(1,)], "total_records long")
    with pytest.raises((PySparkException, Py4JJavaError), match="run_key is required"):
        post.post_run(ingest.url, {**RUN, "run_key": " "}, report, rows(spark, 3))
    with pytest.raises((PySparkException, Py4JJavaError), match="rows are"):
        rows(spark, 3).write.format("json_post").options(url=ingest.url, run=json.dumps(RUN)).mode("append").save()
    post.post_run(ingest.url, RUN, report, rows(spark, 0))
    assert ingest.runs["run:1"]["sent"] == {}


def test_each_micro_batch_is_a_run(spark, ingest, tmp_path):
    spark.dataSource.register(post.HttpIngestSink)
    source = str(tmp_path / "in")
    for _ in range(2):  # equal content in both
        rows(spark, 25).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows(spark, 1).schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = post.outgoing(stream).writeStream.format("json_post").options(url=ingest.url, run=json.dumps(RUN), batch_rows=10, pause=0.01)
    out.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(ingest.runs) == ["run:1:0", "run:1:1"]
    assert [len(items(ingest, "record", r)) for r in sorted(ingest.runs)] == [25, 25]


def test_snapshots_are_read_once_for_each_slot_also_after_a_restart(spark, tmp_path):
    served = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            served.append(len(served))
            values = [[f"d{i}", None] for i in range(len(served) + 2)]  # each snapshot repeats the rows before
            body = json.dumps({"results": [{"series": [{"columns": ["ControllerName", "FirstPacket"], "values": values}]}]})
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(exports.SnapshotStream)
    table = str(tmp_path / "table")

    def keep(df, _):
        found = exports.export_rows(df.select("body")).select(F.col("row")["ControllerName"].cast("string").alias("device"))
        sinks.append_new(found, table, ["device"])

    def run(slots):
        before = len(served)
        stream = spark.readStream.format("json_snapshots").options(url=f"http://127.0.0.1:{server.server_port}", slot_seconds=3, spool=f"file://{tmp_path}/spool").load()
        q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="500 milliseconds").start()
        end = time.time() + 90
        while time.time() < end and len([p for p in q.recentProgress if p.numInputRows]) < slots and q.isActive:
            time.sleep(0.2)
        q.stop()
        assert q.exception() is None and len(served) > before

    run(2)
    run(1)
    server.shutdown()
    got = [r.device for r in spark.read.parquet(table).collect()]
    assert len(got) == len(set(got)) >= 5 and set(got) <= {f"d{i}" for i in range(len(served) + 2)}
    # a replay of a slot reads the spool and not the source
    reader = exports._SnapshotReader({"url": "http://127.0.0.1:9", "slot_seconds": "3", "spool": f"file://{tmp_path}/own"})
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / f"{3_000_000:020d}.json").write_text("[1]")
    assert list(reader.read(reader.partitions({"slot": 0}, {"slot": 3_000_000})[0])) == [(3_000_000, "[1]")]
    reader.commit({"slot": 3_000_000})
    assert not list((tmp_path / "own").iterdir()) and reader.partitions({"slot": 5}, {"slot": 5}) == []
