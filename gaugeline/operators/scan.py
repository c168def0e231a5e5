"""The exact scan with feedback: one device's records in order, with bounded state.

Whether a value joins a baseline depends on the findings about it, so the rules cannot be
written as windows. The scan is a per-device fold that batch (``segments.scan_devices``) and streaming share.
Records of equal time form a group: they are judged against the state before the group, but
for stuck runs, quarantines, silence marks and events, which move while judging.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from itertools import groupby
from statistics import median
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CrossFamily, DynamicConfig, Events, FieldRule

POINT_FLAGS = {"adaptive_outlier", "step_change", "rate_change", "stuck_sensor"}
Finding = dict[str, Any]


@dataclass
class Series:
    """State of one (family, field): accepted values, previous accepted, stuck run, quarantine, version."""

    history: list[float] = field(default_factory=list)
    previous: list | None = None  # value, us
    run: list | None = None  # anchor, count, start us
    quarantine: list | None = None  # values, start us, count
    version: int = 1


@dataclass
class DeviceState:
    series: dict[str, Series] = field(default_factory=dict)
    last_seen: dict[str, int] = field(default_factory=dict)
    silences: list[str] = field(default_factory=list)
    context: dict[str, dict] = field(default_factory=dict)
    open_events: dict[str, dict] = field(default_factory=dict)
    ledger: list[list] = field(default_factory=list)  # fingerprint, place among all insertions

    def dump(self, ledger: bool = True) -> str:
        parts = {**self.__dict__, "series": {k: v.__dict__ for k, v in self.series.items()}}
        if not ledger:
            del parts["ledger"]
        return json.dumps(parts, sort_keys=True)

    @classmethod
    def load(cls, text: str | None) -> DeviceState:
        if not text:
            return cls()
        d = json.loads(text)
        ledger = [[x[0], int(x[1])] if isinstance(x, list) else [x, i] for i, x in enumerate(d.get("ledger", ()))]
        return cls(**{**d, "series": {k: Series(**v) for k, v in d["series"].items()}, "ledger": ledger})

    def cell(self, kind: str, name: str):
        """A part of the state that rules read and write on its own."""
        if kind == "series":
            return {k: v for k, v in self.series.get(name, Series()).__dict__.items() if k != "version"}
        if kind == "silence":
            return f"{name}|{self.last_seen.get(name)}" in self.silences
        return {"last": self.last_seen, "context": self.context, "event": self.open_events}[kind].get(name)

    def agrees(self, other: DeviceState, cells: Iterable[tuple[str, str]]) -> bool:
        """Versions may differ: they only number the shifts, which can be done afterwards."""
        return all(self.cell(*c) == other.cell(*c) for c in cells if c[0] != "version")

    def after(self, start: DeviceState, end: DeviceState, cells: Iterable[tuple[str, str]]) -> DeviceState:
        """This state after a segment that went from ``start`` to ``end`` and touched ``cells``, where both agree on them."""
        out = DeviceState.load(self.dump())
        for kind, name in cells:
            if kind == "series" and name in end.series:
                own, before = end.series[name], start.series.get(name, Series())
                out.series[name] = Series(**{**own.__dict__, "version": self.series.get(name, Series()).version + own.version - before.version})
            for mine, theirs in {"last": [(out.last_seen, end.last_seen)], "context": [(out.context, end.context)], "event": [(out.open_events, end.open_events)]}.get(kind, ()):
                if name in theirs:
                    mine[name] = theirs[name]
        out.silences += [m for m in end.silences if m not in start.silences and m not in out.silences]
        return out


def iso(us: int) -> str:
    return (datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=us)).isoformat()


def seconds(later: int, earlier: int) -> float:
    return (later - earlier) / 1e6


def gap_ok(elapsed: float, rule: FieldRule) -> bool:
    low, high = rule.min_time_gap_seconds, rule.max_time_gap_seconds
    return elapsed >= 0 and (low is None or elapsed >= low) and (high is None or elapsed <= high)


def judge_baseline(value: float, rule: FieldRule, s: Series) -> Finding | None:
    if rule.mad_score_threshold is None:
        return None
    seen = s.history[-rule.window_size :]
    if len(seen) < rule.min_samples:
        return {"rule_id": "adaptive.cold_start", "score": None, "reference": None, "threshold": float(rule.min_samples), "state": "cold_start"}
    centre = median(seen)
    mad = median([abs(x - centre) for x in seen])
    scale = max(mad, rule.epsilon) / 0.6745 if rule.minimum_scale is None else max(1.4826 * mad, rule.minimum_scale)
    score = abs(value - centre) / scale
    if score > rule.mad_score_threshold:
        return {"rule_id": "adaptive.robust_baseline", "candidate_flag": "adaptive_outlier", "reference": centre, "score": score, "threshold": rule.mad_score_threshold}
    return None


def judge_change(value: float, us: int, rule: FieldRule, s: Series) -> list[Finding]:
    if s.previous is None:
        return []
    before, at = s.previous
    elapsed = seconds(us, at)
    if not gap_ok(elapsed, rule):
        return []
    found, step = [], abs(value - before)
    if rule.step_threshold is not None and step > rule.step_threshold:
        found.append({"rule_id": "adaptive.step_change", "candidate_flag": "step_change", "reference": before, "score": step, "threshold": rule.step_threshold, "elapsed_seconds": elapsed})
    if rule.rate_threshold_per_second is not None and elapsed > 0 and step / elapsed > rule.rate_threshold_per_second:
        found.append({"rule_id": "adaptive.rate_change", "candidate_flag": "rate_change", "reference": before, "score": step / elapsed, "threshold": rule.rate_threshold_per_second, "elapsed_seconds": elapsed})
    return found


def judge_stuck(value: float, us: int, rule: FieldRule, s: Series) -> Finding | None:
    if not rule.stuck_enabled or rule.stuck_tolerance is None or rule.stuck_sample_count is None:
        return None
    if s.run is not None and abs(value - s.run[0]) <= rule.stuck_tolerance:
        s.run[1] += 1
    else:
        s.run = [value, 1, us]
    anchor, count, start = s.run
    elapsed, least = seconds(us, start), rule.stuck_min_duration_seconds
    if count < rule.stuck_sample_count or (least is not None and elapsed < least):
        return None
    return {"rule_id": "adaptive.stuck_sensor", "candidate_flag": "stuck_sensor", "reference": anchor, "score": float(count), "threshold": float(rule.stuck_sample_count), "elapsed_seconds": elapsed}


def quarantine(value: float, us: int, rule: FieldRule, s: Series) -> Finding | None:
    """Collect anomalous values that agree; enough of them become the new baseline."""
    entry = rule.baseline_reentry
    if not entry.enabled:
        return None
    q = s.quarantine
    s.quarantine = [[value], us, 1] if q is None or abs(value - q[0][-1]) > entry.value_tolerance else [[*q[0], value], q[1], q[2] + 1]
    values, start, count = s.quarantine
    least = entry.minimum_duration_seconds
    if count < entry.consecutive_samples or (least is not None and seconds(us, start) < least):
        return None
    old = median(s.history) if s.history else None
    s.history = values[-rule.window_size :]
    s.previous, s.quarantine, s.version = [values[-1], us], None, s.version + 1
    return {"rule_id": "adaptive.baseline_shift", "candidate_flag": "baseline_shift", "reference": old, "score": median(s.history), "threshold": float(s.version)}


class DeviceScan:
    """Folds groups of records into findings, event summaries and state.

    A record is a dictionary: seq, record_id, family, us (or None), state, values (finite numbers), keys (names in the
    payload), fingerprint, and findings of layers that were computed before (``extra``).
    """

    def __init__(self, device: str, config: DynamicConfig, state: DeviceState | None = None):
        self.device, self.config, self.state = device, config, state or DeviceState()
        self.seen = {fingerprint for fingerprint, _ in self.state.ledger}
        self.touched: set[tuple[str, str]] = set()

    # -- eligibility

    def keeps_state(self, r: dict) -> bool:
        return r["state"] != "invalid" and self.config.family_enabled(r["family"]) and r["us"] is not None

    def is_trusted(self, r: dict, candidate: bool) -> bool:
        c = self.config
        return self.keeps_state(r) and (c.allow_candidate_context or not candidate) and (c.allow_suspect_context or r["state"] != "suspect")

    # -- layers

    def series(self, r: dict, name: str) -> Series:
        key = f"{r['family']}|{name}"
        self.touched.add(("series", key))
        return self.state.series.setdefault(key, Series())

    def sequence(self, r: dict) -> list[Finding]:
        found, rule = [], self.config.expected_reporting.get(r["family"])
        before = self.state.last_seen.get(r["family"])
        self.touched.add(("last", r["family"]))
        if rule is not None and before is not None and seconds(r["us"], before) > rule.limit:
            found.append({"layer": "sequence", "rule_id": "sequence.reporting_gap", "candidate_flag": "reporting_gap", "elapsed_seconds": seconds(r["us"], before), "threshold": rule.limit})
        for family, rule in sorted(self.config.family_silence.items()):
            last = self.state.last_seen.get(family)
            self.touched |= {("last", family), ("silence", family)}
            if family == r["family"] or last is None or not self.config.family_enabled(family):
                continue
            mark = f"{family}|{last}"
            if seconds(r["us"], last) > rule.limit and mark not in self.state.silences:
                self.state.silences.append(mark)
                found.append({"layer": "sequence", "rule_id": "sequence.family_silence", "candidate_flag": "family_silence", "silent_family": family, "elapsed_seconds": seconds(r["us"], last), "threshold": rule.limit})
        return found

    def context(self, r: dict, snapshot: dict[str, dict]) -> list[Finding]:
        found, v = [], r["values"]
        scaled = lambda rule, name, values=v: None if values.get(name) is None else values[name] * float(rule.field_scales.get(name, 1.0))
        for rule in self.config.peer_sensor_groups:
            if rule.family != r["family"] or rule.spread_threshold is None:
                continue
            grouped = {f for g in rule.aliases for f in g}
            asked = [f for f in rule.fields if self.config.field_enabled(r["family"], f)]
            names = [next((f for f in g if f in asked and v.get(f) is not None), None) for g in rule.aliases] + [f for f in asked if f not in grouped]
            sensors = {f: scaled(rule, f) for f in names if f is not None and v.get(f) is not None}
            if len(sensors) < rule.min_available:
                continue
            centre = median(sensors.values())
            spread = max(abs(x - centre) for x in sensors.values())
            if spread > rule.spread_threshold:
                found.append({"layer": "context", "rule_id": rule.rule_id, "candidate_flag": rule.candidate_flag, "affected_fields": sorted(sensors), "reference": centre, "score": spread, "threshold": rule.spread_threshold})
        for rule in self.config.cross_field_rules:
            if rule.family != r["family"] or rule.max_abs_difference is None or not all(self.config.field_enabled(r["family"], f) for f in rule.fields):
                continue
            a, b = (scaled(rule, f) for f in rule.fields)
            if a is not None and b is not None and abs(a - b) > rule.max_abs_difference:
                found.append({"layer": "context", "rule_id": rule.rule_id, "candidate_flag": rule.candidate_flag, "affected_fields": sorted(rule.fields), "score": abs(a - b), "threshold": rule.max_abs_difference})
        for rule in self.config.cross_family_rules:
            if rule.family == r["family"] and r["us"] is not None and rule.max_abs_difference is not None and self.config.field_enabled(r["family"], rule.field):
                found += self.as_of(rule, r, snapshot, scaled)
        return found

    def as_of(self, rule: CrossFamily, r: dict, snapshot: dict[str, dict], scaled: Callable) -> list[Finding]:
        other = snapshot.get(rule.context_family)
        self.touched.add(("context", rule.context_family))
        limit = rule.tolerance_seconds if rule.tolerance_seconds is not None else self.config.recent_context_tolerance_seconds
        if other is None or other["us"] > r["us"] or (limit is not None and seconds(r["us"], other["us"]) > limit):
            return []
        a, b = scaled(rule, rule.field), scaled(rule, rule.context_field, other["values"])
        if a is None or b is None or abs(a - b) <= rule.max_abs_difference:
            return []
        return [{"layer": "context", "rule_id": rule.rule_id, "candidate_flag": rule.candidate_flag, "affected_fields": [rule.field], "reference": b, "score": abs(a - b), "threshold": rule.max_abs_difference, "elapsed_seconds": seconds(r["us"], other["us"])}]

    def rules_for(self, r: dict) -> list[tuple[str, FieldRule]]:
        """Rules whose field the payload has; a field named both with and without family is judged twice."""
        found = [(name.rpartition(".")[2], rule) for name, rule in self.config.fields.items() if name in r["keys"] or (name.startswith(f"{r['family']}.") and name[len(r["family"]) + 1 :] in r["keys"])]
        return sorted([x for x in found if self.config.field_enabled(r["family"], x[0])], key=lambda x: x[0])

    def adaptive(self, r: dict, blocked: set[str]) -> tuple[list[Finding], set[str]]:
        found, skip = [], set()
        for name, rule in self.rules_for(r):
            value = r["values"].get(name)
            if value is None:
                continue
            s = self.series(r, name)
            own = [x for x in (judge_baseline(value, rule, s), *judge_change(value, r["us"], rule, s)) if x]
            if name not in blocked:
                own += [x for x in [judge_stuck(value, r["us"], rule, s)] if x]
            own = [{"layer": "adaptive", "field": name, "observed": value, **x} for x in own]
            found += own
            if any(x.get("candidate_flag") in POINT_FLAGS for x in own):
                skip.add(name)
            earlier = any(x.get("candidate_flag") in POINT_FLAGS for x in found if x["field"] == name)
            if earlier and name not in blocked:
                shift = quarantine(value, r["us"], rule, s)
                if shift:
                    self.touched.add(("version", f"{r['family']}|{name}"))
                    found.append({"layer": "adaptive", "field": name, "observed": value, **shift})
                    skip.add(name)
        return found, skip | blocked

    def accept(self, r: dict, skip: set[str]) -> None:
        self.state.last_seen[r["family"]] = r["us"]
        self.touched.add(("last", r["family"]))
        for name, rule in self.rules_for(r):
            value = r["values"].get(name)
            if value is None or name in skip:
                continue
            s = self.series(r, name)
            s.history = [*s.history, value][-rule.window_size :]
            s.previous, s.quarantine = [value, r["us"]], None

    def events(self, r: dict, found: list[Finding]) -> tuple[list[dict], set[str]]:
        e, out, flags = self.config.events, [], set()
        if not e.enabled:
            return [], flags
        for f in found:
            flag = f.get("candidate_flag")
            for name in (sorted(set(f.get("affected_fields") or ())) or [f.get("field") or "record"]) if flag else ():
                key = f"{r['family']}|{name}|{flag}"
                self.touched.add(("event", key))
                event = self.state.open_events.get(key)
                if event and e.maximum_gap_seconds is not None and seconds(r["us"], event["end_us"]) > e.maximum_gap_seconds:
                    out.append({**event, "status": "closed"})
                    event = None
                if event is None:
                    body = "|".join((self.device, r["family"], name, flag, iso(r["us"])))
                    event = {"event_id": "event:" + hashlib.sha256(body.encode()).hexdigest()[:16], "family": r["family"], "field": name, "candidate_flag": flag, "start_us": r["us"], "end_us": r["us"], "point_count": 1, "record_ids": [r["record_id"]], "confirmed": False}
                    self.state.open_events[key] = event
                else:
                    event["end_us"], event["point_count"] = r["us"], event["point_count"] + 1
                    event["record_ids"] = [*event["record_ids"], r["record_id"]][-e.window_points :]
                if is_confirmed(event, e):
                    f["event_id"] = event["event_id"]
                    if not event["confirmed"]:
                        event["confirmed"] = True
                        out.append({**event, "status": "confirmed"})
                    elif e.enforcement_policy == "confirmed_event":
                        out.append({**event, "status": "updated"})
                    flags.add(flag)
        return out, flags

    # -- the fold

    def group(self, records: list[dict]) -> Iterable[dict]:
        """Judge records of equal time, then update the state. Yields a result for each record."""
        snapshot = dict(self.state.context)
        for r in records:
            if self.is_trusted(r, r.get("had_candidate", False)):
                self.trust(snapshot, r)
        updates, own_seen = [], set()
        for r in records:
            if r["state"] == "invalid":
                yield {"seq": r["seq"], "findings": [], "events": [], "flags": set(), "duplicate": False}
                continue
            told = r.get("duplicate")
            duplicate = r["fingerprint"] in self.seen if told is None else told or r["fingerprint"] in own_seen
            context = self.context(r, snapshot) if self.config.enabled and self.config.family_enabled(r["family"]) else []
            blocked = {f for x in context for f in x["affected_fields"]}
            own, skip, sequence = [], set(blocked), []
            if duplicate:
                own.append({"layer": "adaptive", "rule_id": "dynamic.duplicate_state_update_skipped", "state": "not_updated"})
            elif self.config.enabled and self.config.family_enabled(r["family"]):
                if r["us"] is None:
                    own.append({"layer": "adaptive", "rule_id": "dynamic.timestamp_unavailable", "state": "not_evaluated"})
                else:
                    sequence = self.sequence(r)
                    own, skip = self.adaptive(r, blocked)
            found = context + own + list(r.get("extra", ())) + sequence
            summaries, flags = self.events(r, found) if not duplicate and self.keeps_state(r) else ([], set())
            if self.config.events.enforcement_policy == "point":
                flags = {f["candidate_flag"] for f in found if f.get("candidate_flag")}
            updates.append((r, skip, duplicate, any(f.get("candidate_flag") for f in found)))
            if not duplicate and self.keeps_state(r):
                (self.seen if told is None else own_seen).add(r["fingerprint"])
            yield {"seq": r["seq"], "findings": found, "events": summaries, "flags": flags, "duplicate": duplicate}
        for r, _, duplicate, candidate in updates:
            if not duplicate and self.is_trusted(r, candidate):
                self.trust(self.state.context, r)
        for r, skip, duplicate, _ in updates:
            if not duplicate and self.keeps_state(r):
                if self.config.enabled:
                    self.accept(r, skip)
                if r.get("duplicate") is None:
                    self.state.ledger.append([r["fingerprint"], self.state.ledger[-1][1] + 1 if self.state.ledger else 0])
                    self.seen.add(r["fingerprint"])
        # a fingerprint holds the record's time, so repeats lie in one group or in the ledger
        for old, _ in self.state.ledger[: -self.config.deduplication_capacity]:
            self.seen.discard(old)
        del self.state.ledger[: -self.config.deduplication_capacity]

    def trust(self, where: dict[str, dict], r: dict) -> None:
        now = where.get(r["family"])
        self.touched.add(("context", r["family"]))
        if now is None or r["us"] >= now["us"]:
            where[r["family"]] = {"us": r["us"], "values": r["values"], "record_id": r["record_id"]}

    def run(self, records: Iterable[dict]) -> Iterable[dict]:
        """Records ordered by (time, undated last; then seq). Undated records leave no state, so each is a group of its own."""
        for us, group in groupby(records, key=lambda r: r["us"]):
            if us is None:
                for r in group:
                    yield from self.group([r])
            else:
                yield from self.group(list(group))


def is_confirmed(event: dict, e: Events) -> bool:
    least = e.minimum_duration_seconds
    return event["point_count"] >= e.minimum_points and (least is None or seconds(event["end_us"], event["start_us"]) >= least)


FINDING = "layer:string,rule_id:string,field:string,affected_fields:array<string>,candidate_flag:string,observed:double,reference:double,score:double,threshold:double,elapsed_seconds:double,event_id:string,state:string,silent_family:string"
EVENT = "event_id:string,family:string,field:string,candidate_flag:string,start_us:long,end_us:long,point_count:long,record_ids:array<string>,status:string"
RESULT = f"device_id string, seq long, record_id string, duplicate boolean, flags array<string>, findings array<struct<{FINDING}>>, events array<struct<{EVENT}>>, state string"
_FINDING = [x.partition(":")[0] for x in FINDING.split(",")]
_EVENT = [x.partition(":")[0] for x in EVENT.split(",")]


def as_record(row: Any, fields_: list[str]) -> dict:
    values = {f: float(x) for f in fields_ if (x := getattr(row, f)) is not None and x == x and abs(x) != float("inf")}
    us, extra, duplicate = row.ts_us, getattr(row, "extra", None), getattr(row, "duplicate", None)
    return {"duplicate": None if duplicate is None else bool(duplicate), "seq": int(row.seq), "record_id": row.record_id or "", "family": row.family or "", "us": None if us is None or us != us else int(us), "state": row.quality_state, "values": values, "keys": set(fields_), "fingerprint": row.fingerprint, "extra": [x.asDict() if hasattr(x, "asDict") else dict(x) for x in (() if extra is None else extra)]}


COLUMNS = ["device_id", "seq", "record_id", "duplicate", "flags", "findings", "events", "state"]
BATCH = 4096


def result_row(device: str, record_id: str, x: dict) -> list:
    return [device, x["seq"], record_id, x["duplicate"], sorted(x["flags"]), [{k: f.get(k) for k in _FINDING} for f in x["findings"]], [{k: e.get(k) for k in _EVENT} for e in x["events"]], None]


def fold(scan: DeviceScan, records: Iterable[dict]) -> Iterable[list]:
    """A result row for each record in the order of time, without state."""
    ids = {}

    def noted(rows):
        for r in rows:
            ids[r["seq"]] = r["record_id"]
            yield r

    for x in scan.run(noted(records)):
        yield result_row(scan.device, ids.pop(x["seq"], ""), x)


def fold_device(device: str, records: Iterable[dict], config: DynamicConfig, state: DeviceState) -> Iterable[list]:
    """``fold`` of a device's records; the last row carries the new state."""
    scan, last = DeviceScan(device, config, state), None
    for row in fold(scan, records):
        if last is not None:
            yield last
        last = row
    if last is not None:
        yield [*last[:-1], scan.state.dump()]


def scan_rows(device: str, pdf: pd.DataFrame, fields_: list[str], config: DynamicConfig, state: DeviceState) -> pd.DataFrame:
    """Findings of one device's rows of a micro-batch; the last row carries the new state."""
    pdf = pdf.assign(ts_us=pdf["ts_us"].astype("Int64").astype(object).where(pdf["ts_us"].notna(), None))
    pdf = pdf.sort_values(["ts_us", "family", "record_id", "seq"], na_position="last")
    return pd.DataFrame(list(fold_device(device, (as_record(r, fields_) for r in pdf.itertuples(index=False)), config, state)), columns=COLUMNS)


def next_states(scanned: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """(device_id, state) after a scan; devices without records keep the state they had."""
    new = scanned.filter(F.col("state").isNotNull()).select("device_id", "state")
    return new if states is None else new.union(states.select("device_id", "state").join(new.select("device_id"), "device_id", "left_anti"))


def reset_device(states: DataFrame, device: str) -> DataFrame:
    return states.filter(F.col("device_id") != device)


def findings_of(scanned: DataFrame) -> DataFrame:
    """One row per finding."""
    return scanned.select("device_id", "seq", "record_id", F.explode("findings").alias("f")).select("device_id", "seq", "record_id", "f.*")


def events_of(scanned: DataFrame) -> DataFrame:
    """One row per event summary, in the order of the records."""
    return scanned.select("device_id", "seq", F.posexplode("events").alias("nth", "e")).select("device_id", "seq", "nth", "e.*")
