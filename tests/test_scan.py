"""Worked sequences for the exact scan, and that neither order, partitioning nor splitting into runs changes its results."""

import pytest
from pyspark.sql import functions as F

from gaugeline.config import CrossFamily, DynamicConfig, Events, FieldRule, Interval, PeerGroup, Reentry
from gaugeline.operators import scan, segments
from gaugeline.plans import queries

SCHEMA = "device_id string, seq long, record_id string, family string, ts_us long, quality_state string, fingerprint string, v double, w double"


def rows(values, family="environment", device="d", start=0, state="decoded"):
    return [(device, start + i, f"r{start + i:03d}", family, None if t is None else int(t * 1e6), state, f"{family}{t}{v}{start + i}", v, None) for i, (t, v) in enumerate(values)]


def run(spark, data, config, states=None):
    out = segments.scan_devices(spark.createDataFrame(data, SCHEMA), ["v", "w"], config, states)
    return out


def flags(out):
    return {(r.record_id, r.candidate_flag) for r in scan.findings_of(out).collect() if r.candidate_flag}


def config(**rule):
    return DynamicConfig(fields={"v": FieldRule(**rule)})


@pytest.mark.parametrize(
    ("values", "rule", "want"),
    [
        ([(0, 20), (60, 20), (120, 20), (180, 40)], {"min_samples": 3, "mad_score_threshold": 5.0, "epsilon": 0.1}, {("r003", "adaptive_outlier")}),
        ([(0, 20), (60, 20), (120, 20), (180, 20.1)], {"min_samples": 3, "mad_score_threshold": 4.0, "minimum_scale": 1.0}, set()),
        ([(0, 10), (30, 30), (40, 50)], {"step_threshold": 5.0, "min_time_gap_seconds": 5.0, "max_time_gap_seconds": 20.0}, {("r002", "step_change")}),
        ([(0, 10), (60, 20), (120, 30)], {"step_threshold": 15.0}, {("r002", "step_change")} - {("r002", "step_change")}),
        ([(0, 20), (60, 20), (120, 20)], {"stuck_enabled": True, "stuck_tolerance": 0.0, "stuck_sample_count": 3}, {("r002", "stuck_sensor")}),
    ],
)
def test_worked_sequences(spark, values, rule, want):
    values = [(t, float(v)) for t, v in values]
    assert flags(run(spark, rows(values), config(**rule))) == want


def test_rate_and_cold_start(spark):
    out = scan.findings_of(run(spark, rows([(0, 10.0), (2, 20.0)]), config(rate_threshold_per_second=4.0, mad_score_threshold=3.0, min_samples=3))).collect()
    assert [r.score for r in out if r.candidate_flag == "rate_change"] == [5.0]
    assert sum(r.rule_id == "adaptive.cold_start" for r in out) == 2


def test_flagged_values_do_not_join_the_baseline(spark):
    found = flags(run(spark, rows([(0, 10.0), (60, 20.0), (120, 30.0)]), config(step_threshold=5.0)))
    assert found == {("r001", "step_change"), ("r002", "step_change")}


def test_baseline_shift(spark):
    rule = {"min_samples": 3, "mad_score_threshold": 4.0, "minimum_scale": 1.0, "baseline_reentry": Reentry(enabled=True, consecutive_samples=3, value_tolerance=0.5)}
    values = [(60 * i, x) for i, x in enumerate((12.5, 12.0, 12.5, 41.0, 41.3, 40.8, 41.1))]
    out = scan.findings_of(run(spark, rows(values), config(**rule))).collect()
    assert [(r.record_id, r.threshold) for r in out if r.candidate_flag == "baseline_shift"] == [("r005", 2.0)]
    assert not [r for r in out if r.record_id == "r006" and r.candidate_flag]
    back = [(60 * i, x) for i, x in enumerate((12.5, 12.0, 12.5, 41.0, 12.5))]
    assert flags(run(spark, rows(back), config(**rule))) == {("r003", "adaptive_outlier")}


def test_gap_and_silence(spark):
    c = DynamicConfig(expected_reporting={"environment": Interval(60.0, 2.0)}, family_silence={"gas": Interval(60.0, 2.0)})
    data = rows([(0, 1.0), (60, 1.0), (190, 1.0), (320, 1.0)]) + rows([(10, 1.0)], "gas", start=50)
    assert flags(run(spark, data, c)) == {("r002", "reporting_gap"), ("r002", "family_silence"), ("r003", "reporting_gap")}


def test_records_of_equal_time_see_each_other_in_both_orders(spark):
    c = DynamicConfig(cross_family_rules=(CrossFamily("x", "environment", "gas", "v", "v", 5.0, 0.0),))
    for env, gas in ((0, 50), (50, 0)):
        assert flags(run(spark, rows([(0, 30.0)], start=env) + rows([(0, 10.0)], "gas", start=gas), c)) == {(f"r{env:03d}", "cross_family_disagreement")}
    assert flags(run(spark, rows([(0, 30.0)]) + rows([(60, 10.0)], "gas", start=9), c)) == set()


def test_peers_and_blocked_fields(spark):
    c = DynamicConfig(peer_sensor_groups=(PeerGroup("p", "environment", ("v", "w"), 5.0),), fields={"v": FieldRule(step_threshold=100.0)})
    data = [(*r[:8], 45.0) for r in rows([(0, 20.0)])] + rows([(60, 500.0)], start=1)
    assert flags(run(spark, data, c)) == {("r000", "peer_sensor_disagreement")}  # the first value was not accepted, so there is no step


def test_one_event_of_four_points(spark):
    c = DynamicConfig(fields={"v": FieldRule(step_threshold=5.0)}, events=Events(enabled=True, minimum_points=2, window_points=2, enforcement_policy="confirmed_event"))
    out = scan.events_of(run(spark, rows([(60 * i, 10.0 * (i + 1)) for i in range(5)]), c)).orderBy("seq").collect()
    assert [r.status for r in out] == ["confirmed", "updated", "updated"] and len({r.event_id for r in out}) == 1
    assert out[-1].point_count == 4 and out[-1].record_ids == ["r003", "r004"]


def test_odd_records(spark):
    data = rows([(0, 10.0), (None, 99.0), (60, float("nan")), (120, 500.0)]) + rows([(180, 900.0)], start=9, state="invalid") + rows([(0, 1.0)], device="e")
    twice = data[0][:1] + (99, "r000") + data[0][3:]
    out = run(spark, [*data, twice], config(step_threshold=5.0))
    found = scan.findings_of(out).collect()
    assert flags(out) == {("r003", "step_change")}
    assert [r.rule_id for r in found if r.record_id == "r001"] == ["dynamic.timestamp_unavailable"]
    assert sum(r.duplicate for r in out.collect()) == 1 and out.count() == 7
    assert run(spark, [], config(step_threshold=5.0)).count() == 0


RULE = FieldRule(mad_score_threshold=3.5, minimum_scale=1.0, step_threshold=60.0, stuck_enabled=True, stuck_tolerance=5.0, stuck_sample_count=3, baseline_reentry=Reentry(enabled=True, consecutive_samples=3, value_tolerance=40.0))
LONG = DynamicConfig(fields={"value": RULE}, expected_reporting={"all": Interval(3600.0, 6.0)}, events=queries.POLICY)


def results(out):
    return sorted((r.seq, r.duplicate, tuple(r.flags), str(r.findings), str(r.events)) for r in out.select("seq", "duplicate", "flags", "findings", "events").collect())


def test_partitioning_and_splitting_change_nothing(spark):
    df = queries.scan_input(spark, queries_sf := "/root/testdata/sf0.001")
    assert queries_sf
    whole = results(segments.scan_devices(df, ["value"], LONG))
    for n in (1, 7):
        assert results(segments.scan_devices(df.orderBy(F.rand(n)).repartition(n), ["value"], LONG)) == whole
    middle = df.approxQuantile("ts_us", [0.5], 0)[0]
    first = segments.scan_devices(df.filter(F.col("ts_us") <= middle), ["value"], LONG)
    states = scan.next_states(first)
    second = segments.scan_devices(df.filter(F.col("ts_us") > middle), ["value"], LONG, states)
    assert sorted(results(first) + results(second)) == whole
    assert scan.next_states(second, states).count() == df.select("device_id").distinct().count()
    assert scan.reset_device(states, "1").filter("device_id = '1'").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    from gaugeline.streaming.scan import PROVIDER, scan_stream

    df = queries.scan_input(spark, "/root/testdata/sf0.001")
    edges = df.approxQuantile("ts_us", [0.3, 0.7], 0)
    source = str(tmp_path / "in")
    low = None
    for i, high in enumerate([*edges, None]):
        part = df if high is None else df.filter(F.col("ts_us") <= high)
        (part if low is None else part.filter(F.col("ts_us") > low)).coalesce(1).write.mode("append").parquet(source)
        low = high
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        q = scan_stream(stream, ["value"], LONG).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    finally:
        if before:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
        else:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert results(spark.read.parquet(str(tmp_path / "out"))) == results(segments.scan_devices(df, ["value"], LONG))


def test_batch_then_stream_then_batch_equals_one_run(spark, tmp_path):
    """Three parts of the records: a batch run, a stream that begins with its states, and a batch run that goes on from the stream's."""
    from gaugeline.streaming.scan import PROVIDER, scan_stream, stream_states

    df = queries.scan_input(spark, "/root/testdata/sf0.001")
    one, two = df.approxQuantile("ts_us", [0.4, 0.7], 0)
    parts = [df.filter(F.col("ts_us") <= one), df.filter((F.col("ts_us") > one) & (F.col("ts_us") <= two)), df.filter(F.col("ts_us") > two)]
    first = segments.scan_devices(parts[0], ["value"], LONG)
    kept = spark.createDataFrame(scan.next_states(first).collect(), "device_id string, state string")
    source, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    parts[1].write.parquet(source)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        stream = spark.readStream.schema(df.schema).parquet(source)
        q = scan_stream(stream, ["value"], LONG, kept).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", cp).trigger(availableNow=True).start()
        q.awaitTermination(120)
        states = spark.createDataFrame(stream_states(spark, cp).collect(), "device_id string, state string")
    finally:
        if before:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
        else:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert {r.device_id for r in states.collect()} == {r.device_id for r in df.filter(F.col("ts_us") <= two).select("device_id").distinct().collect()}
    last = segments.scan_devices(parts[2], ["value"], LONG, states)
    assert sorted(results(first) + results(spark.read.parquet(str(tmp_path / "out"))) + results(last)) == results(segments.scan_devices(df, ["value"], LONG))
    # a reset drops one device, which then begins anew
    device = df.select("device_id").first()[0]
    anew = segments.scan_devices(parts[2].filter(F.col("device_id") == device), ["value"], LONG, scan.reset_device(states, device))
    assert results(anew) == results(segments.scan_devices(parts[2].filter(F.col("device_id") == device), ["value"], LONG))
