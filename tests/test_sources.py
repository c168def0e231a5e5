import http.server
import json
import os
import struct
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeline.functions import values as V
from gaugeline.sources import exports, packets, sinks

LAYOUT = struct.Struct("<hhhhhHBHHiiHBBBBB")


def packet(*values, number=0, kind=0x41, port=8, tail=b"\0" * 15):
    return (bytes([1, 2, number, kind]) + LAYOUT.pack(*values) + tail).hex() + f",{port}"


VALUES = (2200, -200, 32767, -32768, 0, 65535, 255, 12, 34, -2_000_000_000, 2_000_000_000, 0xFFFF, 1, 2, 3, 4, 255)


def export(rows, columns):
    return json.dumps({"results": [{"series": [{"columns": columns, "values": rows}, {"columns": ["x"], "values": [[1]]}, 5]}, {"other": 1}, None]})


COLUMNS = ["time", "Area", "ControllerName", "Latitude", "Longitude", "Location", "Site", *packets.SLOTS]


def row(slots, device="dev", time="2026-03-01T00:00:00Z", place=(1.5, 2.5)):
    return [time, "A", device, *place, "null", " ", *[slots.get(s) for s in packets.SLOTS]]


def test_export_to_records(spark, tmp_path):
    rows = [
        row({"FirstPacket": packet(*VALUES)}), row({"FirstPacket": packet(*VALUES), "FifthPacket": packet(7, *VALUES[1:]), "NinthPacket": "null", "TenthPacket": "aa bb,3"}),
        row({"FirstPacket": packet(*VALUES, number=1)}), row({"FirstPacket": packet(*VALUES, kind=0)}), row({}), row({"FirstPacket": "01020041" + "ff" * 47 + ",1"}), "bad", [1],
    ]
    path = tmp_path / "export.json"
    path.write_text("﻿" + export(rows, COLUMNS), encoding="utf-8")
    found = exports.export_rows(exports.read_exports(spark, str(path)))
    assert found.count() == 7
    out = packets.export_records(found.filter(F.size("row") > 1)).collect()
    assert len(out) == 2 and len({r.record_id for r in out}) == 2
    by_first = {json.loads(r.payload["rtd1_t_x100"].toJson()): r for r in out}
    for first, r in by_first.items():
        got = {k: json.loads(v.toJson()) for k, v in r.payload.items()}
        assert [got[n] for n, _, _ in packets.LAYOUT] == [first, *VALUES[1:]]
        assert r.device_id == "dev" and set(r.platform_meta) == {"ControllerName", "Area"} and "Latitude" in r.raw_unmapped and "time" not in r.raw_unmapped
    assert set(by_first) == {2200, 7}


@pytest.mark.parametrize("slots", [{"FirstPacket": "zz,1"}, {"FirstPacket": "aabb"}, {"FirstPacket": ""}, {"FirstPacket": packet(*VALUES), "SecondPacket": "aa,x"}])
def test_malformed_packets(spark, slots):
    df = spark.createDataFrame([(export([row(slots), row({"FirstPacket": packet(*VALUES)})], COLUMNS),)], "body string")
    rows = exports.export_rows(df)
    with pytest.raises(PySparkException):
        packets.export_records(rows).collect()
    assert packets.export_records(rows, strict=False).count() >= 1


def test_a_malformed_packet_before_a_good_one_is_an_error(spark):
    rows = exports.export_rows(spark.createDataFrame([(export([row({"FirstPacket": "zz,1", "SecondPacket": packet(*VALUES)})], COLUMNS),)], "body string"))
    with pytest.raises(PySparkException):
        packets.export_records(rows).collect()
    assert packets.export_records(rows, strict=False).count() == 1


def test_rows_without_place_or_device(spark):
    body = export([row({"FirstPacket": packet(*VALUES)}, place=(None, 1.0)), row({"FirstPacket": packet(*VALUES)}, device=None), row({"FirstPacket": packet(*VALUES)}, time=" ")], COLUMNS)
    rows = exports.export_rows(spark.createDataFrame([(body,)], "body string"))
    assert packets.export_records(rows, strict=False).count() == 0
    with pytest.raises(PySparkException):
        packets.export_records(rows).collect()


def test_envelope(spark):
    bodies = spark.createDataFrame([("[]",), ('{"results":{}}',), ("nope",), (None,)], "body string")
    assert exports.export_rows(bodies, strict=False).count() == 0
    with pytest.raises(PySparkException):
        exports.export_rows(bodies).collect()
    twice = spark.createDataFrame([('{"results":[{"series":[{"columns":["FirstPacket","a","a"],"values":[[null,1,2,3],[null]]}]}]}',)], "body string")
    assert sorted(str({k: v and v.toJson() for k, v in r.row.items()}) for r in exports.export_rows(twice).collect()) == sorted([str({"FirstPacket": "null", "a": "2"}), str({"FirstPacket": "null"})])


def test_json_lines(spark, tmp_path):
    path = tmp_path / "records.jsonl"
    good = [{"record_id": "a", "family": "gas", "timestamp": "2026-03-01T00:00:00Z", "payload": {"gasConc": 1}, "quality_flags": ["x"], "device_id": " d "}, {"record_id": "b", "payload": 5, "source_time_utc": "2026-03-01", "platform_meta": {"Site": "s"}}, {"record_id": "c", "source_type": "t", "device_id": ""}]
    path.write_text("﻿" + "\n".join([json.dumps(good[0]), "", "{bad", "[1]", *map(json.dumps, good[1:])]), encoding="utf-8")
    out = {r.record_id: r for r in exports.with_identity(exports.read_records(spark, str(path))).collect()}
    assert set(out) == {"a", "b", "c"} and out["a"].quality_flags == ["x"] and out["b"].quality_flags == [] and out["b"].payload is None
    assert out["a"].device_id == "d" and out["b"].device_id == "platform:|s||" and out["c"].device_id == ""
    assert out["a"].ts_us == out["b"].ts_us == 1772323200000000 and out["c"].ts_us is None
    with pytest.raises(PySparkException):
        exports.read_records(spark, str(path), strict=True).collect()


def test_training_rows(spark, tmp_path):
    csv, js = tmp_path / "t.csv", tmp_path / "t.json"
    csv.write_text("isAnomaly,rail1Temp,moisture\n0,20.5,30\ntrue,1e1,50\nyes,1,1\n1,x,5\n0,1,101\n")
    js.write_text(json.dumps({"records": [{"is_anomaly": True, "rail1Temp": 20, "moisture": "40"}, {"rail1Temp": 1, "moisture": 1}]}))
    for path, want in ((csv, [(0, 20.5), (1, 10.0)]), (js, [(1, 20.0)])):
        rows = exports.labelled(exports.read_training(spark, str(path)), ["rail1Temp", "moisture"], ["moisture"])
        assert sorted((r.label, r.rail1Temp) for r in rows.collect()) == want


@pytest.fixture
def server():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            ok = self.headers.get("authorization", "").endswith("dTpw")  # u:p
            self.send_response(200 if ok else 401)
            self.end_headers()
            self.wfile.write(b'{"results": []}' if ok and "bad" not in self.path else b"secret body")

        def log_message(self, *args):
            pass

    s = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_http_source(spark, server, tmp_path, monkeypatch):
    assert json.loads(exports.fetch_json(server, "u", "p")) == {"results": []}
    for url, user in ((server, "w"), (f"{server}/bad", "u"), ("http://127.0.0.1:9", "u"), (server, "")):
        with pytest.raises(exports.SourceError) as e:
            exports.fetch_json(url, user, "p", 5)
        assert "secret" not in str(e.value)
    env = tmp_path / ".env"
    env.write_text("# a\nMY_USER=u\nexport MY_PASS='p'\n")
    monkeypatch.setenv("MY_USER", "kept")
    exports.load_environment(str(env))
    assert os.environ["MY_USER"] == "kept" and os.environ.pop("MY_PASS") == "p"


RUN = {"run_key": "k1", "source_name": "s", "source_file_name": "f", "source_type": "t", "pipeline_version": "1", "execution_slot": "x", "filtering_mode": "shadow"}


def test_ingest_can_be_repeated(spark, tmp_path):
    root = str(tmp_path)
    records = spark.createDataFrame([(f"r{i}", "gas", 1, f"p{i}") for i in range(5)], "record_id string, family string, ts_us long, fingerprint string").withColumn("quality_state", F.lit("reject"))
    events = spark.createDataFrame([("e1", "confirmed", 2)], "event_id string, status string, point_count long")
    report, states = spark.createDataFrame([(5,)], "total long"), spark.createDataFrame([("d", "{}")], "device_id string, state string")
    rows = sinks.prepare(records, "t")
    first = sinks.ingest(root, RUN, report, rows, events, states)
    again = sinks.ingest(root, RUN, report, rows, events, states)
    assert (first["inserted_records"], first["skipped_records"], first["anomaly_events"]) == (5, 0, 1)
    assert (again["inserted_records"], again["skipped_records"], again["anomaly_events"]) == (0, 5, 0)
    assert spark.read.parquet(f"{root}/ingest_runs").count() == 1 and {r.quality_state for r in sinks.current_rows(spark, f"{root}/processed_records").collect()} == {"invalid"}
    assert sinks.current_version(spark, f"{root}/dynamic_filter_state/k1") == 2 and exports.read_states(spark, f"{root}/dynamic_filter_state/k1").count() == 1
    assert exports.read_states(spark, f"{root}/none") is None
    with pytest.raises(ValueError):
        sinks.ingest(root, {**RUN, "filtering_mode": "other"}, report, rows, events, states)
    for bad in ([("r1", "gas", 1, "p"), ("r1", "gas", 1, "q")], [(" ", "gas", 1, "p")], [("r", None, 1, "p")], [("r", "gas", None, "p")]):
        with pytest.raises((ValueError, PySparkException)):
            sinks.prepare(spark.createDataFrame(bad, "record_id string, family string, ts_us long, fingerprint string").withColumn("quality_state", F.lit("decoded")), "t").collect()


def test_changed_records_replace_stored_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(r, "record_id string, record_fingerprint string, x long")
    now = lambda: sorted(tuple(r) for r in sinks.current_rows(spark, path).collect())
    counts = lambda i, u, k: {"inserted_records": i, "updated_records": u, "skipped_records": k}
    assert sinks.upsert(rows(("a", "1", 1), ("b", "2", 1), ("b", "2", 1)), path) == counts(2, 0, 1)
    assert sinks.upsert(rows(("a", "1", 9), ("b", "3", 2), ("c", "4", 2)), path) == counts(1, 1, 1)
    assert now() == [("a", "1", 1), ("b", "3", 2), ("c", "4", 2)]
    assert sinks.upsert(rows(("b", "2", 3)), path) == counts(0, 1, 0)  # back to an earlier content
    assert sinks.upsert(rows(("b", "2", 4)), path) == counts(0, 0, 1) and sinks.upsert(rows(), path) == counts(0, 0, 0)
    (tmp_path / "t" / "data" / "never-ended").mkdir()
    assert now() == [("a", "1", 1), ("b", "2", 3), ("c", "4", 2)]
    for bad in ((("d", "5", 1), ("d", "6", 1)), ((None, "5", 1),), (("d", None, 1),)):
        with pytest.raises(ValueError):
            sinks.upsert(rows(*bad), path)


def test_run_description():
    run = sinks.describe_run("k", "f", "s", "t", "auto", "1", "slot")
    assert run["state_schema_version"] == 3 and run["dynamic_config_hash"] is None and not sinks.payload_problems(run)
    with pytest.raises(ValueError):
        sinks.describe_run("k", " ", "s", "t", "other", "1", "slot")


def test_remote_states():
    assert exports.state_of_answer({"found": True, "state_json": {"a": 1}}) == {"a": 1} and exports.state_of_answer({"found": False}) is None
    for bad in ([], {}, {"found": 1, "state_json": {}}, {"found": True}, {"found": True, "state_json": "x"}):
        with pytest.raises(ValueError):
            exports.state_of_answer(bad)


def test_object_files(spark, tmp_path):
    path = tmp_path / "o.json"
    path.write_text("\ufeff{\n\"a\": 1}", encoding="utf-8")
    assert json.loads(exports.read_object(spark, str(path)).first().object.toJson()) == {"a": 1}
    for body in ("[1]", "{", " ", "5"):
        path.write_text(body)
        with pytest.raises(PySparkException):
            exports.read_object(spark, str(path)).collect()


def test_rows_by_position(spark):
    whole = [f"v{i}" for i in range(len(packets.POSITIONS))]
    df = spark.createDataFrame([(json.dumps([*whole, "more"]),), (None,)], "body string")
    values = F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>")
    out = df.select(packets.by_position(values).alias("row")).collect()
    assert {k: json.loads(v.toJson()) for k, v in out[0].row.items()} == dict(zip(packets.POSITIONS, whole, strict=True)) and out[1].row is None
    assert sorted(packets.POSITIONS) == sorted(COLUMNS)
    short = spark.createDataFrame([(json.dumps(whole[:-1]),)], "body string")
    assert short.select(packets.by_position(values, strict=False).alias("row")).first().row is None
    with pytest.raises(PySparkException):
        short.select(packets.by_position(values)).collect()
    given = dict(zip(COLUMNS, row({"FirstPacket": packet(*VALUES)}), strict=True))
    body = json.dumps([given[c] for c in packets.POSITIONS])
    rows = spark.createDataFrame([(body,)], "body string").select(packets.by_position(values).alias("row"))
    assert packets.export_records(rows).count() == 1
    less = rows.select(F.map_filter("row", lambda k, _: k != "NinthPacket").alias("row"))
    assert packets.export_records(less, strict=False).count() == 1
    with pytest.raises(PySparkException):
        packets.export_records(less).collect()


def test_answers():
    good = {"success": True, "run_key": "k", "inserted_records": 1, "updated_records": 0, "skipped_records": 1}
    sinks.check_answer(good, "k", 2)
    for change in ({"success": False}, {"run_key": "j"}, {"inserted_records": -1}, {"inserted_records": True}, {"skipped_records": 0}):
        with pytest.raises(ValueError):
            sinks.check_answer({**good, **change}, "k", 2)


def test_writers(spark, tmp_path):
    sinks.write_records(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "r"))
    assert json.loads(spark.read.text(str(tmp_path / "r")).first().value) == {"x": "a", "y": None}
    sinks.write_report(spark.createDataFrame([(1,)], "n long"), str(tmp_path / "q"))
    assert spark.read.json(str(tmp_path / "q")).first().n == 1


def test_numbers_of_three_kinds(spark):
    body = '{"a": true, "b": "1e2", "c": "nan", "d": null, "e": "x", "f": 2.5, "g": " 1_000 ", "h": "12d"}'
    p = V.parse_payload(F.lit(body))
    row = spark.range(1).select(*[f(p[k]).alias(f"{f.__name__}_{k}") for f in (V.number, V.finite_number, V.model_number) for k in "abcdefgh"]).first()
    get = lambda f: [None if row[f"{f}_{k}"] is None else str(row[f"{f}_{k}"]) for k in "abcdefgh"]
    assert get("number") == [None, "100.0", "nan", None, None, "2.5", "1000.0", None]
    assert get("finite_number") == [None, "100.0", None, None, None, "2.5", "1000.0", None]
    assert get("model_number") == ["1.0", "100.0", None, None, None, "2.5", "1000.0", None]


def test_strict_lines_name_file_and_line(spark, tmp_path):
    """Files of several splits; blank lines, both kinds of line ends and a mark at the beginning count as they do in an editor."""
    import random

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "100b")
    try:
        rnd, want = random.Random(4), {}
        (tmp_path / "in").mkdir()
        for f in range(3):
            lines = [rnd.choice(["", '{"record_id": "%s"}' % ("x" * rnd.randint(1, 60)), "  "]) for _ in range(120)]
            text = "".join(x + rnd.choice(["\n", "\r\n"]) for x in lines)
            (tmp_path / "in" / f"f{f}.jsonl").write_bytes((("\ufeff" if f else "") + text).encode())
            want[f"f{f}.jsonl"] = [x.strip() for x in lines]
        got = {}
        found = exports.numbered_lines(spark, str(tmp_path / "in"))
        assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 6
        for r in found.collect():
            got.setdefault(r.file.rpartition("/")[2], {})[r.number] = r.value.lstrip("\ufeff").strip()
        assert got == {f: dict(enumerate(x, 1)) for f, x in want.items()}
        assert exports.read_records(spark, str(tmp_path / "in"), strict=True).count() == sum(bool(x) for xs in want.values() for x in xs)
        broken = (tmp_path / "in" / "f1.jsonl").read_bytes().splitlines(keepends=True)
        broken[86] = b"[1]\n"
        (tmp_path / "in" / "f1.jsonl").write_bytes(b"".join(broken))
        with pytest.raises(PySparkException, match="line 87 of .*f1.jsonl"):
            exports.read_records(spark, str(tmp_path / "in"), strict=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_two_writers_and_compaction(spark, tmp_path, monkeypatch):
    """Writers that commit in between don't lose each other's rows; the number of folders to read stays bounded."""
    from concurrent.futures import ThreadPoolExecutor

    from gaugeline.sources import records as table

    path = str(tmp_path / "t")
    rows = lambda ids, v: spark.createDataFrame([(f"r{i}", f"{i}:{v}", v) for i in ids], "record_id string, record_fingerprint string, v int")
    assert table.upsert(rows(range(20), 0), path)["inserted_records"] == 20
    # a writer that is overtaken: another one commits after it has looked at the version
    real, done = table.commit, []

    def overtaken(spark_, path_, version):
        if not done:
            done.append(1)
            monkeypatch.setattr(table, "commit", real)
            table.upsert(rows(range(15, 25), 1), path)
        return real(spark_, path_, version)

    monkeypatch.setattr(table, "commit", overtaken)
    assert table.upsert(rows(range(18, 30), 1), path) == {"inserted_records": 5, "updated_records": 0, "skipped_records": 7}
    now = lambda: {r.record_id: r.v for r in table.current_rows(spark, path).collect()}
    assert now() == {f"r{i}": int(i >= 15) for i in range(30)} and table.current_rows(spark, path).count() == 30
    with ThreadPoolExecutor(3) as pool:
        counts = list(pool.map(lambda k: table.upsert(rows(range(30 + 10 * k, 45 + 10 * k), 2), path), range(3)))
    assert sum(c["inserted_records"] for c in counts) == 35 and sum(c["skipped_records"] for c in counts) == 10 and len(now()) == 65
    monkeypatch.setattr(table, "COMPACT_AFTER", 4)
    for v in range(3, 8):
        table.upsert(rows([1, 2], v), path)
        assert len(table.newest(spark, path).folders) <= 5
    assert now() == {f"r{i}": 7 if i in (1, 2) else 2 if i >= 30 else int(i >= 15) for i in range(65)}
    assert table.vacuum(spark, path) > 5 and len(now()) == 65 and not table.commit(spark, path, table.Version(1, []))
    plan = table.stored_rows(spark, path, table.newest(spark, path), "record_id", [3], ["record_id"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "Exchange" not in plan.partition("Physical Plan")[2]
