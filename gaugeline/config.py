"""Rule configuration: dataclasses, closed validation of dictionaries and files, and modes."""

from __future__ import annotations

import hashlib
import json
from dataclasses import MISSING, dataclass, field, fields
from typing import Any

MODES = ("off", "shadow", "auto", "enforce")


def setting(default: Any, kind: str) -> Any:
    """A field of a rule with the kind of value that it takes (KINDS)."""
    made = {"default_factory": lambda: default} if isinstance(default, dict) else {"default": default}
    return field(metadata={"kind": kind}, **({} if default is MISSING else made))


# Names, defaults and kinds of all settings are fixed values of the file format.


@dataclass(frozen=True)
class Reentry:
    enabled: bool = setting(False, "bool")
    consecutive_samples: int = setting(4, "count")
    value_tolerance: float | None = setting(0.5, "least zero or null")
    minimum_duration_seconds: float | None = setting(0.0, "least zero or null")
    action: str | None = setting("reset", "reset")


@dataclass(frozen=True)
class FieldRule:
    """History rules of one field. A threshold that is unset turns its rule off."""

    window_size: int = setting(20, "count")
    min_samples: int = setting(10, "count")
    mad_score_threshold: float | None = setting(None, "positive or null")
    epsilon: float = setting(1e-6, "positive")
    minimum_scale: float | None = setting(None, "positive or null")
    step_threshold: float | None = setting(None, "positive or null")
    rate_threshold_per_second: float | None = setting(None, "positive or null")
    min_time_gap_seconds: float | None = setting(None, "least zero or null")
    max_time_gap_seconds: float | None = setting(None, "positive or null")
    stuck_tolerance: float | None = setting(None, "least zero or null")
    stuck_sample_count: int | None = setting(None, "count or null")
    stuck_min_duration_seconds: float | None = setting(None, "least zero or null")
    stuck_enabled: bool = setting(False, "bool")
    baseline_reentry: Reentry = field(default=Reentry(), metadata={"kind": Reentry})

    def __post_init__(self):
        if not 1 <= self.min_samples <= self.window_size:
            raise ValueError("min_samples must lie between 1 and window_size")
        low, high = self.min_time_gap_seconds, self.max_time_gap_seconds
        if low is not None and high is not None and low > high:
            raise ValueError("min_time_gap_seconds exceeds max_time_gap_seconds")


@dataclass(frozen=True)
class Interval:
    expected_interval_seconds: float | None = setting(MISSING, "positive or null")
    gap_multiplier: float | None = setting(MISSING, "positive or null")

    @property
    def limit(self) -> float:
        return self.expected_interval_seconds * self.gap_multiplier


@dataclass(frozen=True)
class PeerGroup:
    rule_id: str = setting(MISSING, "text")
    family: str = setting(MISSING, "text")
    fields: tuple[str, ...] = setting(MISSING, "some texts")
    spread_threshold: float | None = setting(None, "positive or null")
    candidate_flag: str = setting("peer_sensor_disagreement", "text")
    field_scales: dict = setting({}, "numbers by name")
    aliases: tuple[tuple[str, ...], ...] = setting((), "lists of texts")
    min_available: int = setting(2, "count")


@dataclass(frozen=True)
class CrossField:
    rule_id: str = setting(MISSING, "text")
    family: str = setting(MISSING, "text")
    fields: tuple[str, str] = setting(MISSING, "some texts")
    max_abs_difference: float | None = setting(None, "positive or null")
    candidate_flag: str = setting("cross_field_disagreement", "text")
    field_scales: dict = setting({}, "numbers by name")

    def __post_init__(self):
        if len(self.fields) != 2:
            raise ValueError("fields must name exactly two fields")


@dataclass(frozen=True)
class CrossFamily:
    rule_id: str = setting(MISSING, "text")
    family: str = setting(MISSING, "text")
    context_family: str = setting(MISSING, "text")
    field: str = setting(MISSING, "text")
    context_field: str = setting(MISSING, "text")
    max_abs_difference: float | None = setting(None, "positive or null")
    tolerance_seconds: float | None = setting(None, "least zero or null")
    candidate_flag: str = setting("cross_family_disagreement", "text")
    field_scales: dict = setting({}, "numbers by name")


@dataclass(frozen=True)
class Events:
    enabled: bool = setting(False, "bool")
    minimum_points: int = setting(3, "count")
    window_points: int = setting(5, "count")
    maximum_gap_seconds: float | None = setting(300.0, "positive or null")
    minimum_duration_seconds: float | None = setting(0.0, "least zero or null")
    enforcement_policy: str | None = setting("point", "policy")

    def __post_init__(self):
        if not 1 <= self.minimum_points <= self.window_points:
            raise ValueError("minimum_points must lie between 1 and window_points")


@dataclass(frozen=True)
class ModelFilter:
    enabled: bool = setting(True, "bool")
    model_path: str = setting("models/autoencoder-v0", "text")
    minimum_valid_records: int = setting(500, "count")
    readiness_window: int = setting(200, "count")
    fallback_window: int = setting(100, "count")
    maximum_candidate_rate: float = setting(0.1, "rate")
    fallback_candidate_rate: float = setting(0.2, "rate")
    minimum_input_completeness: float = setting(0.95, "rate")
    fallback_input_completeness: float = setting(0.9, "rate")


@dataclass(frozen=True)
class DynamicConfig:
    """Everything the dynamic layers need. Keys of ``fields`` are ``field`` or ``family.field``."""

    enabled: bool = setting(True, "bool")
    enabled_families: tuple[str, ...] = setting((), "texts")
    enabled_fields: tuple[str, ...] = setting((), "texts")
    allow_suspect_context: bool = setting(False, "bool")
    allow_candidate_context: bool = setting(False, "bool")
    deduplication_capacity: int = setting(10_000, "count")
    recent_context_tolerance_seconds: float | None = setting(None, "least zero or null")
    peer_sensor_groups: tuple[PeerGroup, ...] = ()
    cross_field_rules: tuple[CrossField, ...] = ()
    cross_family_rules: tuple[CrossFamily, ...] = ()
    fields: dict[str, FieldRule] = field(default_factory=dict)
    expected_reporting: dict[str, Interval] = field(default_factory=dict)
    family_silence: dict[str, Interval] = field(default_factory=dict)
    events: Events = Events()
    model: ModelFilter = ModelFilter(enabled=False)

    def family_enabled(self, family: str) -> bool:
        return not self.enabled_families or family in self.enabled_families

    def field_enabled(self, family: str, name: str) -> bool:
        return not self.enabled_fields or name in self.enabled_fields or f"{family}.{name}" in self.enabled_fields


def is_number(v: Any) -> bool:
    return isinstance(v, int | float) and not isinstance(v, bool)


def is_text(v: Any) -> bool:
    return isinstance(v, str) and bool(v.strip())


def is_list(v: Any, item) -> bool:
    return isinstance(v, list | tuple) and all(map(item, v))


#: What a value of each kind must be. A null text takes the setting's default.
KINDS = {
    "bool": lambda v: isinstance(v, bool),
    "text": is_text,
    "reset": lambda v: v == "reset",
    "policy": lambda v: v in ("point", "confirmed_event"),
    "count": lambda v: is_number(v) and isinstance(v, int) and v > 0,
    "count or null": lambda v: v is None or KINDS["count"](v),
    "positive": lambda v: is_number(v) and v > 0,
    "positive or null": lambda v: v is None or KINDS["positive"](v),
    "least zero or null": lambda v: v is None or is_number(v) and v >= 0,
    "rate": lambda v: is_number(v) and 0 < v <= 1,
    "texts": lambda v: is_list(v, is_text),
    "some texts": lambda v: is_list(v, is_text) and len(v) > 0,
    "lists of texts": lambda v: is_list(v, KINDS["some texts"]),
    "numbers by name": lambda v: isinstance(v, dict) and all(is_text(k) and is_number(x) for k, x in v.items()),
}


def plain(v: Any) -> Any:
    """Texts without white space around them, lists as tuples."""
    return v.strip() if isinstance(v, str) else tuple(map(plain, v)) if isinstance(v, list | tuple) else v


def build(rule: type, given: Any, where: str, named: str | None = None):
    """An instance of a rule class from a dictionary; unknown keys and wrong values are refused. ``named``: the rule_id if none is given."""
    if not isinstance(given, dict):
        raise ValueError(f"{where} must be an object")
    known = {f.name: f for f in fields(rule)}
    if set(given) - set(known):
        raise ValueError(f"{where}: unknown keys {sorted(set(given) - set(known))}")
    given, made = ({"rule_id": named} if named else {}) | {k: v for k, v in given.items() if not (v is None and k in ("rule_id", "candidate_flag", "action", "enforcement_policy"))}, {}
    for name, value in given.items():
        kind = known[name].metadata["kind"]
        if isinstance(kind, type):
            made[name] = build(kind, value, f"{where}.{name}")
        elif KINDS[kind](value):
            made[name] = plain(value)
        else:
            raise ValueError(f"{where}.{name} must be: {kind}")
    try:
        return rule(**made)
    except (TypeError, ValueError) as e:
        raise ValueError(f"{where}: {e}") from e


def merge(base: dict, over: dict) -> dict:
    """Deep merge; ``over`` wins."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


# Default settings of a configuration file (fixed values), which dictionaries are not merged with.
FILE_DEFAULTS = {
    "recent_context_tolerance_seconds": 300,
    "peer_sensor_groups": [
        {
            "rule_id": "environment.peer_temperature_disagreement", "family": "environment",
            "fields": ["rtd1_t_x100", "rtd2_t_x100", "rtd3_t_x100", "rtd4_t_x100", "tmp102_t_x100", "temperature_c", "temp"],
            "field_scales": {"rtd1_t_x100": 0.01, "rtd2_t_x100": 0.01, "rtd3_t_x100": 0.01, "rtd4_t_x100": 0.01, "tmp102_t_x100": 0.01, "temperature_c": 1, "temp": 1},
            "aliases": [["temperature_c", "temp"]], "min_available": 3, "spread_threshold": None, "candidate_flag": "peer_sensor_disagreement",
        }
    ],
    "adaptive": {"default": {"baseline_reentry": {"minimum_duration_seconds": 120}}},
    "event_confirmation": {"enabled": True, "enforcement_policy": "confirmed_event"},
}
GROUPS = {"peer_sensor_groups": PeerGroup, "cross_field_rules": CrossField, "cross_family_rules": CrossFamily}


def load_object(path: str) -> dict:
    """The object of a JSON file; anything else is an error."""
    with open(path, encoding="utf-8") as f:
        try:
            loaded = json.load(f)
        except json.JSONDecodeError as e:
            raise ValueError(f"{path} is no JSON: {e.msg}") from e
    if not isinstance(loaded, dict):
        raise ValueError(f"{path} must hold an object")
    return loaded


def section(given: dict, name: str, known: set[str] | None = None) -> dict:
    part = given.get(name, {})
    if not isinstance(part, dict):
        raise ValueError(f"{name} must be an object")
    if known is not None and set(part) - known:
        raise ValueError(f"{name}: unknown keys {sorted(set(part) - known)}")
    return part


def dynamic_config(given: dict[str, Any] | str | None) -> DynamicConfig:
    """From a dictionary as it stands, or from a JSON file merged over FILE_DEFAULTS; none gives the file defaults."""
    if given is None or isinstance(given, str):
        given = merge(FILE_DEFAULTS, load_object(given) if given else {})
    if not isinstance(given, dict):
        raise ValueError("the configuration must be an object")
    simple = {f.name for f in fields(DynamicConfig) if "kind" in f.metadata}
    unknown = set(given) - simple - set(GROUPS) - {"adaptive", "event_confirmation", "model_filter"}
    if unknown:
        raise ValueError(f"unknown keys {sorted(unknown)}")
    adaptive = section(given, "adaptive", {"default", "fields", "expected_reporting", "family_silence"})
    default = section(adaptive, "default")
    build(FieldRule, default, "adaptive.default")
    rules = {}
    for name, rule in section(adaptive, "fields").items():
        if not is_text(name) or not isinstance(rule, dict):
            raise ValueError(f"adaptive.fields.{name} must be an object with a name")
        rules[name.strip()] = build(FieldRule, merge(default, rule), f"adaptive.fields.{name}")
    # a sequence rule without interval or multiplier is checked and left out
    intervals = {k: {f: build(Interval, {"expected_interval_seconds": None, "gap_multiplier": None} | r if isinstance(r, dict) else r, f"{k}.{f}") for f, r in section(adaptive, k).items()} for k in ("expected_reporting", "family_silence")}
    intervals = {k: {f: r for f, r in own.items() if None not in (r.expected_interval_seconds, r.gap_multiplier)} for k, own in intervals.items()}
    lists = {}
    for name, rule in GROUPS.items():
        if not isinstance(given.get(name, []), list):
            raise ValueError(f"{name} must be a list")
        lists[name] = tuple(build(rule, r, f"{name}[{i}]", f"{name}[{i}]") for i, r in enumerate(given.get(name, [])))
    top = build(DynamicConfig, {k: v for k, v in given.items() if k in simple}, "configuration")
    return DynamicConfig(
        **{k: getattr(top, k) for k in simple}, **lists, fields=rules, **intervals,
        events=build(Events, given.get("event_confirmation", {}), "event_confirmation"), model=build(ModelFilter, given.get("model_filter", {}), "model_filter"),
    )


def resolve_mode(mode: str | None, has_config: bool) -> str:
    """The mode without white space and in lower case; none means shadow with a configuration and off without."""
    if mode is None:
        return "shadow" if has_config else "off"
    if str(mode).strip().lower() not in MODES:
        raise ValueError(f"unknown mode {mode!r}; modes are {', '.join(sorted(MODES))}")
    return str(mode).strip().lower()


def config_hash(given: Any) -> str | None:
    """SHA-256 of the canonical JSON; none for none."""
    if given is None:
        return None
    return hashlib.sha256(json.dumps(given, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
