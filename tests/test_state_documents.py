"""State documents of all versions become states of devices that the scan goes on from."""

import json

import pytest
from pyspark.errors import PySparkException

from gaugeline.config import DynamicConfig, Events, FieldRule
from gaugeline.operators import scan, segments
from gaugeline.sources.state_documents import read_state_document

T0 = "1970-01-01T00:01:00+00:00"
T1 = "1970-01-01T00:02:00+00:00"


def key(old, *parts):
    return "|".join(parts) if old else json.dumps(parts)


def document(version, old=False):
    point = lambda v, t=T0: {"value": v, "timestamp": t, "record_id": "r"}
    series = key(old, "plat|x" if old else "d1", "env", "v")
    event = {"event_id": "event:1", "device_id": "d1", "family": "env", "field": "v", "candidate_flag": "step_change", "start_time_utc": T0, "end_time_utc": T1, "point_count": 2, "contributing_record_ids": ["a", "b"], "confirmed": True, "closed": False}
    return {
        "state_schema_version": version, "updated_at_utc": T1,
        "adaptive": {
            "histories": {series: [point(10.0), point(11.5, T1)]}, "previous_values": {series: point(11.5, T1)}, "stuck_runs": {series: {"value": 11.5, "count": 2, "start_timestamp": T0}},
            "last_seen_by_device_family": {key(old, "d1", "env"): T1}, "reported_silence_events": [["d1", "gas", T0]],
            "quarantines": {series: {"values": [point(90.0, T1)], "start_timestamp": T1, "last_value": 90.0, "consecutive_count": 1}}, "baseline_versions": {series: 3},
        },
        "context": {"latest_by_device_family": {key(old, "d1", "env"): {"timestamp": T1, "record": {"record_id": "r7", "payload": {"v": 11.5, "w": "x", "b": True, "n": 3}}}}},
        "events": {"active_points": {key(old, "d1", "env", "v", "step_change"): [{"record_id": "b", "timestamp": T1}, {"record_id": "a", "timestamp": T0}]}} if version == 1 else {"active_events": {key(old, "d1", "env", "v", "step_change"): event}, "closed_events": {}},
        "deduplication": {"entries": [{"fingerprint": "f2", "device_id": "d2"}, {"fingerprint": "f1", "device_id": "d1"}]}, "model": {},
    }


def read(spark, tmp_path, doc):
    path = tmp_path / "state.json"
    path.write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=2))
    return read_state_document(spark, str(path))


@pytest.mark.parametrize("version", [1, 2, 3])
def test_versions(spark, tmp_path, version):
    got = {r.device_id: scan.DeviceState.load(r.state) for r in read(spark, tmp_path, document(version)).collect()}
    d = got["d1"]
    assert d.series["env|v"] == scan.Series([10.0, 11.5], [11.5, 120_000_000], [11.5, 2, 60_000_000], [[90.0], 120_000_000, 1], 3)
    assert d.last_seen == {"env": 120_000_000} and d.silences == ["gas|60000000"]
    assert d.context == {"env": {"us": 120_000_000, "values": {"v": 11.5, "n": 3.0}, "record_id": "r7"}}
    event = d.open_events["env|v|step_change"]
    assert (event["start_us"], event["end_us"], event["point_count"], event["record_ids"], event["confirmed"]) == (60_000_000, 120_000_000, 2, ["a", "b"], version > 1)
    assert d.ledger == ([] if version == 1 else [["f1", 1]]) and (version == 1) == ("d2" not in got)


def test_older_keys_and_bad_documents(spark, tmp_path):
    got = {r.device_id for r in read(spark, tmp_path, document(2, old=True)).collect()}
    assert got == {"plat|x", "d1", "d2"}
    bad = document(3)
    bad["adaptive"]["histories"] = {"nokey": []}
    for doc in (document(4), "[]", "nope", bad):
        with pytest.raises(PySparkException):
            read(spark, tmp_path, doc).collect()
    assert read(spark, tmp_path, {"state_schema_version": 3}).count() == 0


def test_the_scan_goes_on_from_a_document(spark, tmp_path):
    states = read(spark, tmp_path, document(3))
    config = DynamicConfig(fields={"v": FieldRule(step_threshold=5.0)}, events=Events(enabled=True, minimum_points=2, enforcement_policy="confirmed_event"))
    rows = [("d1", 1, "x1", "env", 180_000_000, "decoded", "n1", 20.0), ("d1", 2, "x2", "env", 240_000_000, "decoded", "f1", 20.0)]
    out = segments.scan_devices(spark.createDataFrame(rows, "device_id string, seq long, record_id string, family string, ts_us long, quality_state string, fingerprint string, v double"), ["v"], config, states)
    got = {r.record_id: r for r in out.collect()}
    assert [(f.rule_id, f.reference, f.event_id) for f in got["x1"].findings] == [("adaptive.step_change", 11.5, "event:1")] and got["x2"].duplicate
    assert [(e.status, e.point_count) for e in got["x1"].events] == [("updated", 3)]
