"""The scan in segments and the ledger of all devices, held to one plain loop over the records."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeline.config import CrossFamily, DynamicConfig, Events, FieldRule, Interval, Reentry
from gaugeline.operators import dedup, scan, segments

SCHEMA = "device_id string, seq long, record_id string, family string, ts_us long, quality_state string, fingerprint string, v double, w double"
REENTRY = Reentry(enabled=True, consecutive_samples=3, value_tolerance=2.0)
RULE = FieldRule(mad_score_threshold=4.0, minimum_scale=1.0, min_samples=3, window_size=5, step_threshold=20.0, stuck_enabled=True, stuck_tolerance=0.0, stuck_sample_count=3, baseline_reentry=REENTRY)
PLAIN = DynamicConfig(fields={"v": RULE})
FULL = DynamicConfig(
    fields={"v": RULE, "w": FieldRule(rate_threshold_per_second=2.0, mad_score_threshold=5.0, min_samples=2, baseline_reentry=REENTRY)}, enabled_families=("env", "gas", "rare"),
    expected_reporting={"env": Interval(20.0, 2.0)}, family_silence={"gas": Interval(30.0, 2.0), "rare": Interval(500.0, 2.0)},
    cross_family_rules=(CrossFamily("x", "env", "rare", "v", "v", 15.0, None),), events=Events(enabled=True, minimum_points=2, window_points=3, maximum_gap_seconds=200.0, enforcement_policy="confirmed_event"),
)


def series(seed, n, device="hot", start=0):
    """Walks with shifts, flat parts, faults, gaps, repeats, equal times and undated records."""
    rnd, out, us, level = random.Random(seed), [], 0, 50.0
    base = {"cold": 10**5, "b": 2 * 10**5, "c": 3 * 10**5}.get(device, 0)
    for i in range(base, base + n):
        us += rnd.choice([0, 1, 5, 10, 10, 10, 60]) * 1_000_000
        level += rnd.choice([0, 0, 0.5, -0.5, 0, 30 * (rnd.random() < 0.03)])
        v = rnd.choice([level, level, level, level + rnd.gauss(0, 1), level + 100 * (rnd.random() < 0.1)])
        family = rnd.choices(["env", "gas", "rare", "other"], [0.6, 0.3, 0.01, 0.09])[0]
        ts = None if rnd.random() < 0.02 else start + us
        row = (device, i, f"r{i:05d}", family, ts, rnd.choice(["decoded"] * 8 + ["suspect", "invalid"]), f"{device}|{family}|{ts}|{v}|{i}", v, rnd.choice([None, level, v]))
        out.append(row)
        if rnd.random() < 0.05:
            out.append((*row[:1], i + 50_000, *row[2:]))
    return out


def order(r):
    return r[0], r[4] is None, r[4] or 0, r[3], r[2], r[1]


def plain_ledger(rows, old, capacity, families=()):
    """Which rows are duplicates and the ledger afterwards, by one queue; repeats within the run are always told."""
    queue, seen, told, waiting, group = list(old)[-capacity:], set(), {}, [], None
    for r in sorted(rows, key=order):
        if (r[0], r[4]) != group:
            for f in waiting:
                if f not in queue:
                    queue = [*queue, f][-capacity:]
            waiting, group = [], (r[0], r[4])
        told[r[1]] = r[6] in queue or r[6] in seen
        if not told[r[1]] and r[5] != "invalid" and r[4] is not None and (not families or r[3] in families):
            seen.add(r[6])
            waiting.append(r[6])
    for f in waiting:
        if f not in queue:
            queue = [*queue, f][-capacity:]
    return told, queue


def plain_scan(rows, config, states=None, old=()):
    told, queue = plain_ledger(rows, old, config.deduplication_capacity, config.enabled_families)
    out, after = [], {}
    for device in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == device), key=order)
        records = [{"seq": r[1], "record_id": r[2], "family": r[3], "us": r[4], "state": r[5], "values": {k: x for k, x in (("v", r[7]), ("w", r[8])) if x is not None}, "keys": {"v", "w"}, "fingerprint": r[6], "extra": [], "duplicate": told[r[1]]} for r in own]
        fold = scan.DeviceScan(device, config, scan.DeviceState.load((states or {}).get(device)))
        out += list(scan.fold(fold, records))
        after[device] = fold.state.dump(ledger=False)
    return sorted(map(shown, out)), after, queue


def shown(row):
    """A result without its state; findings and events as sorted texts."""
    clean = lambda d: sorted((k, x) for k, x in d.items() if x is not None)
    device, seq, rid, duplicate, flags, found, events = row[:7]
    return device, seq, rid, duplicate, str(list(flags)), str([clean(f) for f in found]), str([clean(e) for e in events])


def collected(out):
    return sorted(shown([r.device_id, r.seq, r.record_id, r.duplicate, r.flags, [f.asDict() for f in r.findings], [e.asDict() for e in r.events]]) for r in out.collect())


@pytest.mark.parametrize(("config", "parts", "warm"), [(PLAIN, 9, 40), (FULL, 12, 15), (FULL, 7, 200)])
def test_segments_equal_one_fold(spark, monkeypatch, config, parts, warm):
    monkeypatch.setattr(segments, "WARM_ROWS", warm)
    rows = series(parts, 900) + series(3, 40, "cold") + [("one", 5_000_000, "x", "env", 1, "decoded", "one", 1.0, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want, after, queue = plain_scan(rows, config)
    out = segments.scan_devices(df, ["v", "w"], config, parts=parts)
    assert collected(out) == want
    states = {r.device_id: r.state for r in scan.next_states(out).collect()}
    plain = {d: scan.DeviceState.load(s) for d, s in after.items()}
    for device, text in states.items():
        got = scan.DeviceState.load(text)
        assert {**got.__dict__, "ledger": None, "silences": sorted(got.silences)} == {**plain[device].__dict__, "ledger": None, "silences": sorted(plain[device].silences)}
    ledger = sorted((e[1], e[0]) for s in states.values() for e in scan.DeviceState.load(s).ledger)
    assert [f for _, f in ledger] == queue
    # a later run goes on from these states
    more = [(*r[:1], r[1] + 10**7, "n" + r[2], r[3], r[4] and r[4] + 10**10, r[5], "n" + r[6], *r[7:]) for r in series(parts + 1, 300)] + [(r[0], r[1] + 2 * 10**7, *r[2:]) for r in rows[:30]]
    want, _, _ = plain_scan(more, config, after, queue)
    assert collected(segments.scan_devices(spark.createDataFrame(more, SCHEMA), ["v", "w"], config, scan.next_states(out), parts=5)) == want


def test_a_hot_device_is_many_tasks(spark):
    n = 8000
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 500)).alias("device_id"), F.col("id").alias("seq"), F.col("id").cast("string").alias("record_id"), F.lit("env").alias("family"), (F.col("id") * 1_000_000).alias("ts_us"), F.lit("decoded").alias("quality_state"), F.col("id").cast("string").alias("fingerprint"), (F.col("id") % 7).cast("double").alias("v"))
    rows = segments.placed(df.withColumn("duplicate", F.lit(False)), 8)
    counts = {r.part: r["count"] for r in rows.filter("device_id = 'hot'").groupBy("part").count().collect()}
    assert len(counts) >= 4 and max(counts.values()) <= n / 4
    assert rows.filter("tail").groupBy("part").count().agg(F.max("count")).first()[0] <= segments.WARM_ROWS


@pytest.mark.parametrize("capacity", [1, 7, 300, 10_000])
def test_ledger_equals_a_plain_queue(spark, capacity):
    rows = series(5, 300, "a") + series(6, 300, "b") + series(7, 50, "c")
    rnd = random.Random(capacity)
    old = [f"gone{i}" for i in range(20)] + [r[6] for r in rnd.sample(rows, 200)] + ["gone"]
    old = list(dict.fromkeys(old))
    rnd.shuffle(old)
    ledger = spark.createDataFrame([(f, f[:1], i * 3) for i, f in enumerate(old)], "fingerprint string, device_id string, place long")
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("ok", (F.col("quality_state") != "invalid") & F.col("ts_us").isNotNull())
    marked, after = dedup.ledger_scan(df, ledger, capacity, ("device_id", "ts_us"), segments.in_order("device_id"), "ok")
    told, queue = plain_ledger(rows, old, capacity)
    assert {r.seq: r.is_duplicate for r in marked.collect()} == told and marked.columns == [*df.columns, "is_duplicate"]
    assert [r.fingerprint for r in after.orderBy("place").collect()] == queue
    marked, after = dedup.ledger_scan(df.limit(0), ledger, capacity, ("device_id", "ts_us"), segments.in_order("device_id"), "ok")
    assert marked.count() == 0 and [r.fingerprint for r in after.orderBy("place").collect()] == old[-capacity:]
