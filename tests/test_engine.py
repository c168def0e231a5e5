import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugeline import config as C
from gaugeline.functions import values as V
from gaugeline.operators import model
from gaugeline.plans.engine import filter_records

RULES = {"enabled": True, "adaptive": {"default": {"min_samples": 3, "window_size": 5}, "fields": {"moist_pc": {"step_threshold": 10}}}, "event_confirmation": {"enabled": True, "minimum_points": 1, "window_points": 3, "enforcement_policy": "point"}, "model_filter": {"enabled": True, "minimum_valid_records": 3, "readiness_window": 3, "fallback_window": 3, "maximum_candidate_rate": 1.0, "fallback_candidate_rate": 1.0}}
AE = model.Autoencoder([20.0] * 5 + [50.0, 50.0], [5.0] * 5 + [10.0, 10.0], [([[0.0] * 2] * 7, [0.0, 0.0]), ([[0.0] * 7] * 2, [0.0] * 7)], 4.0, [100.0] * 7, model.FEATURES, validated=True)


def payload(moist, **more):
    return json.dumps({**{f: 2000 for f in model.FEATURES[:5]}, "moist_pc": moist, "sleeper_rh": 50, **more})


def records(spark, rows):
    df = spark.createDataFrame(rows, "record_id string, device_id string, family string, ts_us long, body string")
    empty = F.array().cast("array<string>")
    return df.withColumns({"payload": V.parse_payload(F.col("body")), "function_id": F.lit(None).cast("string"), "quality_state": F.lit("decoded"), "quality_flags": empty, "analysis_tags": empty}).drop("body")


ROWS = [(f"r{i}", "d", "environment", i * 60_000_000, payload(m)) for i, m in enumerate((50, 51, 90, 52, 150, 50))] + [("r9", "d", "gas", 0, '{"gasConc": "x"}'), ("r8", "d", "environment", 0, "[1]"), ("r7", None, None, None, None), ("r0", "d", "environment", 0, payload(50))]


@pytest.mark.parametrize("mode", ["off", "shadow", "enforce", "auto"])
def test_modes(spark, mode):
    out = filter_records(records(spark, ROWS), ["moist_pc"], mode, C.dynamic_config(RULES), model=AE)
    got = sorted((r.record_id, r.quality_state, ",".join(r.quality_flags)) for r in out.records.select("record_id", "quality_state", "quality_flags").collect())
    hard = {"r8": ("invalid", "invalid_payload"), "r9": ("invalid", "invalid_value"), "r4": ("suspect", "invalid_value")}
    assert len(got) == len(ROWS)
    for rid, state, flags in got:
        if mode in ("off", "shadow"):
            assert (state, flags) == hard.get(rid, ("decoded", ""))
    if mode == "off":
        assert out.findings is None
        return
    report = out.dynamic_report.first()
    found = {(r.record_id, r.candidate_flag) for r in out.findings.collect() if r.candidate_flag}
    assert found == {("r2", "step_change"), ("r4", "step_change")} | ({("r2", "reconstruction_outlier")} if 16 / 7 > 4.0 else set())
    assert report.duplicate_state_update_count == 1 and report.adaptive_candidate_count == 2 and report.model_records_evaluated == 6 and report.model_records_skipped == 1
    assert report.total_records == len(ROWS) and report.invalid_records == 2
    if mode == "enforce":
        assert {r for r in got if r[0] in ("r2", "r4")} == {("r2", "suspect", "step_change"), ("r4", "suspect", "invalid_value,step_change")}
    if mode == "auto":  # ready with the third complete record; r4 can't be evaluated, so completeness falls
        assert ("r2", "suspect", "step_change") in got and ("r4", "suspect", "invalid_value") in got
    assert {r.device_id for r in out.states.collect()} == {"d", "unknown"}
    assert (report.requested_mode, report.hard_invalid_count, report.quarantine_active_count) == (mode, 2, 0)
    assert report.enforced_suspect_count == {"shadow": 0, "enforce": 1, "auto": 1}[mode]
    told = {r.record_id: r.filter_evidence for r in out.records.collect() if r.record_id in ("r2", "r8")}
    assert [(x.rule_id, x.flag, x.state) for x in told["r8"].hard] == [("hard.quality_flag", "invalid_payload", None), ("hard.quality_state", None, "invalid")]
    assert [x.rule_id for x in told["r2"].adaptive if x.candidate_flag] == ["adaptive.step_change"] and told["r2"].mode == mode and not told["r2"].hard


def test_empty_and_no_configuration(spark):
    nothing = records(spark, ROWS).limit(0)
    for mode in ("off", "enforce"):
        assert filter_records(nothing, ["moist_pc"], mode, C.dynamic_config(RULES)).records.count() == 0
    out = filter_records(records(spark, ROWS), mode=None, config=None)
    assert out.hard_report.first().total_decoded_records == len(ROWS) and out.findings is None


def test_two_runs_equal_one(spark):
    """A run continues the devices' and the mode's state; another package starts the mode anew."""
    rule = C.dynamic_config(RULES)
    first, rest = ROWS[:4], ROWS[4:6]
    one = filter_records(records(spark, first + rest), ["moist_pc"], "auto", rule, model=AE)
    two = filter_records(records(spark, first), ["moist_pc"], "auto", rule, model=AE)
    then = filter_records(records(spark, rest), ["moist_pc"], "auto", rule, model=AE, states=two.states, mode_state=model.ModeState.load(two.mode_state.dump()))
    got = lambda *runs: {(r.record_id, r.quality_state, ",".join(r.quality_flags)) for x in runs for r in x.records.collect()}
    assert got(one) == got(two, then)
    assert then.mode_state == one.mode_state and two.mode_state.effective_mode == "enforce"
    other = model.Autoencoder(**{**AE.__dict__, "version": "2"})
    anew = filter_records(records(spark, rest), ["moist_pc"], "auto", rule, model=other, mode_state=two.mode_state)
    assert anew.mode_state.valid == 1 and anew.mode_state.package_id != two.mode_state.package_id


def test_missing_package(spark, tmp_path):
    rule = C.dynamic_config({**RULES, "model_filter": {"model_path": str(tmp_path / "none")}})
    out = filter_records(records(spark, ROWS), ["moist_pc"], "auto", rule)
    r = out.dynamic_report.first()
    assert r.effective_mode == "shadow" and "none" in r.model_load_failure and out.mode_state.failures == 1
    assert {f.state for f in out.findings.filter("rule_id = 'model.autoencoder_unavailable'").collect()} == {"not_evaluated"}


def plain_modes(rows, m):
    effective, valid, complete, candidates, out = "shadow", 0, [], [], []
    for c, k in rows:
        if c is not None:
            complete.append(c)
        if k is not None:
            candidates.append(k)
            valid += 1
        effective, why = model.decide(effective, valid, 0, complete, candidates, m, True, True)
        out.append((effective, why))
    return out


def test_modes_of_ranges_equal_one_chain(spark, monkeypatch):
    import random

    monkeypatch.setattr(model, "PART_ROWS", 37)
    rng = random.Random(3)
    m = C.ModelFilter(minimum_valid_records=20, readiness_window=12, fallback_window=6, minimum_input_completeness=0.6, fallback_input_completeness=0.4, maximum_candidate_rate=0.3, fallback_candidate_rate=0.4)
    rows = [(None, None) if rng.random() < 0.1 else (True, rng.random() < (0.1 if i // 60 % 2 else 0.45)) if rng.random() < 0.8 else (False, None) for i in range(400)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, complete boolean, candidate boolean")
    modes, last = model.auto_modes(df, m, True, True)
    got = [(r.effective_mode, r.reason) for r in modes.orderBy("seq").collect()]
    assert got == plain_modes(rows, m) and len({x for x, _ in got}) == 2 and (last.effective_mode, last.reason) == got[-1]


@pytest.mark.parametrize("values", [[1.0], [3.0, 3.0, 3.0], [1.0, 2.0], [float("nan"), 5.0, None, 1.0], [-1e300, 0.0, 1e-300, 2e-300, 1e300], []])
def test_quantiles_are_exact(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "v double")
    asked = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = model.exact_quantiles(df, [(F.col("v"), q) for q in asked], buckets=4)
    some = [v for v in values if v is not None and v == v]
    assert got == [None] * 5 if not some else np.allclose(got, np.quantile(some, asked), rtol=1e-12)


FILE = """{"enabled": true, "enabled_families": [], "enabled_fields": ["v"], "allow_suspect_context": false, "allow_candidate_context": false, "deduplication_capacity": 10000,
 "recent_context_tolerance_seconds": 300, "cross_family_rules": [], "cross_field_rules": [{"family": "environment", "fields": ["moist_pc", "sleeper_rh"], "max_abs_difference": null}],
 "peer_sensor_groups": [{"rule_id": "p", "family": "environment", "fields": ["rtd1_t_x100", "temp"], "field_scales": {"temp": 1}, "aliases": [["temperature_c", "temp"]], "min_available": 3, "spread_threshold": null}],
 "adaptive": {"default": {"mad_score_threshold": null, "baseline_reentry": {"enabled": false, "action": "reset"}}, "fields": {"environment.v": {"step_threshold": 5}}, "expected_reporting": {}, "family_silence": {}},
 "event_confirmation": {"minimum_duration_seconds": 0}, "model_filter": {"enabled": true, "model_path": "models/x", "minimum_valid_records": 500}}"""


def test_configuration_file(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(FILE)
    c = C.dynamic_config(str(path))
    assert c.recent_context_tolerance_seconds == 300 and c.enabled_fields == ("v",) and c.model.model_path == "models/x"
    assert c.peer_sensor_groups[0].candidate_flag == "peer_sensor_disagreement" and c.cross_field_rules[0].rule_id == "cross_field_rules[0]"
    assert (c.events.minimum_points, c.events.window_points, c.events.maximum_gap_seconds, c.events.enforcement_policy, c.events.enabled) == (3, 5, 300.0, "confirmed_event", True)
    assert c.fields["environment.v"].baseline_reentry.minimum_duration_seconds == 120 and c.fields["environment.v"].step_threshold == 5
    assert c.field_enabled("environment", "v") and not c.field_enabled("environment", "w")
    default = C.dynamic_config(None)
    assert default.peer_sensor_groups[0].rule_id == "environment.peer_temperature_disagreement" and default.peer_sensor_groups[0].min_available == 3
    path.write_text("[1]")
    for bad in (str(path), {"adaptive": {"fields": {"a": {"baseline_reentry": {"action": "shift"}}}}}, {"peer_sensor_groups": {}}, {"enabled": 1}, {"adaptive": {"family_silence": {"g": {"gap_multiplier": 0}}}}, {"event_confirmation": {"enforcement_policy": "x"}}, {"cross_field_rules": [{"family": "e", "fields": ["a"]}]}, {"model_filter": {"model_path": " "}}):
        with pytest.raises(ValueError):
            C.dynamic_config(bad)
    assert C.resolve_mode(" Enforce ", False) == "enforce"


def test_configuration_is_closed():
    for bad in ({"x": 1}, {"adaptive": {"y": 1}}, {"adaptive": {"fields": {"a": {"z": 1}}}}, {"adaptive": {"fields": {"a": {"window_size": True}}}}, {"adaptive": {"fields": {"a": {"window_size": 2, "min_samples": 3}}}}, {"event_confirmation": {"minimum_points": 9, "window_points": 2}}, {"model_filter": {"maximum_candidate_rate": 2}}, []):
        with pytest.raises(ValueError):
            C.dynamic_config(bad)
    c = C.dynamic_config({"adaptive": {"default": {"epsilon": 0.5}, "fields": {"a": {"window_size": 30}}, "expected_reporting": {"gas": {"expected_interval_seconds": 60}}}})
    assert (c.fields["a"].epsilon, c.fields["a"].window_size, c.expected_reporting) == (0.5, 30, {})
    assert C.dynamic_config(None).events.enabled and not C.dynamic_config({}).events.enabled
    assert (C.resolve_mode(None, True), C.resolve_mode(None, False)) == ("shadow", "off")
    with pytest.raises(ValueError):
        C.resolve_mode("loud", True)
    assert C.config_hash({"b": 1, "a": 2}) == C.config_hash({"a": 2, "b": 1}) != C.config_hash({"a": 2}) and C.config_hash(None) is None


def test_training_finds_odd_rows(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(0)
    base = rng.normal(size=(3000, 1))
    x = np.hstack([base + rng.normal(scale=0.1, size=(3000, 1)) for _ in range(4)])
    df = model.split(spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double, d double"), "id")
    trained = model.train(df, ["a", "b", "c", "d"], hidden=(3, 1, 3), epochs=60)
    normal = model.score(df.filter("part = 2"), trained, trained.features).agg(F.avg(F.col("is_candidate").cast("int"))).first()[0]
    odd = spark.createDataFrame([(1.0, -1.5, 1.0, 1.0), (2.0, 2.0, -2.0, 2.0)], "a double, b double, c double, d double")
    assert normal < 0.06 and model.score(odd, trained, trained.features).filter("is_candidate").count() == 2
    trained.save(str(tmp_path / "m.json"))
    assert model.Autoencoder.load(str(tmp_path / "m.json")) == trained
    with pytest.raises(ValueError):
        model.Autoencoder([0.0], [0.0], [([[1.0]], [0.0])], 1.0, [1.0], ["a"])


def test_a_filter_on_scores_does_not_unroll_the_layers(spark):
    """Each neuron is in the plan once, also where rows are picked by what they scored."""
    names = ["a", "b"]
    net = model.Autoencoder([0.0, 1.0], [1.0, 2.0], [([[0.5, -0.3, 0.2], [0.1, 0.4, -0.6]], [0.1, 0.0, 0.2]), ([[0.3, 0.1], [-0.2, 0.5], [0.4, 0.4]], [0.0, 0.1]), ([[0.7, -0.4], [0.2, 0.9]], [0.0, 0.0])], 1.0, [2.0, 2.0], names)
    rows = [(i, float(i % 7) - 3, float(i % 5)) for i in range(70)] + [(70, None, 1.0), (71, float("nan"), 1.0), (72, 1e6, None), (73, 9.0, 9.0), (73, 9.0, 9.0)]
    scored = model.score(spark.createDataFrame(rows, "i long, a double, b double"), net, names)
    every = scored.select("i", "error", "is_candidate", "affected_fields").collect()
    assert len(every) == 75 and [r.error for r in every if r.i in (70, 71, 72)] == [None] * 3
    picked = scored.filter("is_candidate")
    want = sorted((r.i, tuple(r.affected_fields)) for r in every if r.is_candidate)
    assert 2 < len(want) < 72 and sorted((r.i, tuple(r.affected_fields)) for r in picked.select("i", "affected_fields").collect()) == want
    assert picked._jdf.queryExecution().optimizedPlan().toString().upper().count("TANH") == 5


def test_equal_records_keep_their_own_findings(spark):
    """Records equal in device, time, family, id and payload differ in their state: the first of the input counts, in every run."""
    rows = [(f"r{i}", "d", "environment", i * 60_000_000, payload(50)) for i in range(5)] + [("same", "d", "environment", 300_000_000, payload(90))] * 3
    df = records(spark, rows)
    states = ["decoded"] * 5 + ["suspect", "decoded", "invalid"]
    df = df.withColumn("_nth", F.monotonically_increasing_id()).coalesce(1).orderBy("_nth")
    told = F.element_at(F.array(*map(F.lit, states)), (F.row_number().over(Window.orderBy("_nth"))).cast("int"))
    df = df.withColumns({"quality_state": told, "quality_flags": F.when(F.col("record_id") == "same", F.array(F.concat(F.lit("own_"), told))).otherwise(F.col("quality_flags"))}).drop("_nth")
    seen = set()
    for _ in range(10):
        out = filter_records(df, ["moist_pc"], "enforce", C.dynamic_config(RULES), model=AE).records.filter("record_id = 'same'")
        seen.add(tuple(sorted((r.quality_state, tuple(r.quality_flags), r.duplicate, tuple(sorted(x.rule_id for x in r.filter_evidence.adaptive))) for r in out.collect())))
    assert len(seen) == 1
    (got,) = seen
    assert [g[:3] for g in got] == [("decoded", ("own_decoded",), True), ("invalid", ("own_invalid",), False), ("suspect", ("own_suspect", "step_change"), False)]
    assert [("adaptive.step_change" in g[3]) for g in got] == [False, False, True]
