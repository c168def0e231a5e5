"""Reading values out of dynamic payloads, a ``map<string, variant>`` column.

Three ways to read a number exist side by side, because the layers differ: the static
rules keep NaN and infinities, the history rules want finite numbers, and the model
also takes booleans. None of them takes text that is not a decimal number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


def parse_payload(text: Column) -> Column:
    """The object in a JSON text as a map of variants; null for anything else."""
    return F.from_json(text, "map<string,variant>")


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_absent(v: Column) -> Column:
    return v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(True))


def as_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def is_text(v: Column) -> Column:
    return F.coalesce(kind(v) == "STRING", F.lit(False))


def is_boolean(v: Column) -> Column:
    return F.coalesce(kind(v) == "BOOLEAN", F.lit(False))


def text_number(text: Column) -> Column:
    """A decimal number, ``nan`` or a signed ``inf``/``infinity``; null for other text."""
    t = F.lower(F.btrim(text))
    plain = F.when(t.rlike(NUMERIC), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))
    return plain.when(t.isin("nan", "+nan", "-nan"), F.lit(float("nan"))).when(t.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))).when(t.isin("-inf", "-infinity"), F.lit(float("-inf")))


def number(v: Column) -> Column:
    """For the static rules: numbers and numeric text; neither booleans nor null; NaN and infinities stay."""
    # plain numbers, the usual case, are told by one look at the kind
    return F.when(kind(v).isin("STRING", "BOOLEAN"), F.when(is_text(v), text_number(as_text(v)))).otherwise(F.try_variant_get(v, "$", "double"))


def finite(x: Column) -> Column:
    # NaN sorts above all numbers
    return F.when(F.abs(x) < float("inf"), x)


def once(x: Column, use) -> Column:
    """``use(x)`` with ``x`` evaluated once, however often it is used."""
    return F.transform(F.array(x), use)[0]


def finite_number(v: Column) -> Column:
    """For the history rules."""
    return finite(number(v))


def model_number(v: Column) -> Column:
    """For the model: as ``finite_number``, but booleans count as 0 and 1."""
    return F.coalesce(finite_number(v), F.when(is_boolean(v), F.try_variant_get(v, "$", "boolean").cast("double")))


def boolean(v: Column) -> Column:
    """True and false only; text isn't a boolean."""
    return F.when(is_boolean(v), F.try_variant_get(v, "$", "boolean"))


def above(x: Column, limit) -> Column:
    """``x > limit`` where NaN is above nothing; false for null."""
    return F.coalesce(~F.isnan(x) & (x > limit), F.lit(False))


def at_least(x: Column, limit) -> Column:
    return F.coalesce(~F.isnan(x) & (x >= limit), F.lit(False))


def below(x: Column, limit) -> Column:
    return F.coalesce(~F.isnan(x) & (x < limit), F.lit(False))


def at_most(x: Column, limit) -> Column:
    return F.coalesce(~F.isnan(x) & (x <= limit), F.lit(False))


def outside(x: Column, low, high) -> Column:
    """Present and not within the closed range; NaN is outside."""
    return F.coalesce(F.isnan(x) | (x < low) | (x > high), F.lit(False))


def timestamp(text: Column) -> Column:
    """ISO 8601 text; no offset means UTC; digits beyond microseconds are cut; null for anything else."""
    t = F.btrim(text)
    ok = t.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?\s*(Z|z|[+-]\d{2}(:?\d{2})?)?)?$")
    cut = F.regexp_replace(F.regexp_replace(t, ",", "."), r"(\.\d{6})\d+", "$1")
    zoned = F.when(cut.rlike(r"[T ].*(Z|z|[+-]\d{2}(:?\d{2})?)$"), F.upper(cut)).otherwise(F.concat(cut, F.when(cut.rlike(r"[T ]"), F.lit("Z")).otherwise("T00:00:00Z")))
    zoned = F.regexp_replace(zoned, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(ok, F.try_to_timestamp(zoned))


def micros(ts: Column) -> Column:
    """Microseconds since 1970; a timestamp without zone is taken as UTC, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)


def function_id(text: Column) -> Column:
    """``0x`` text is hexadecimal, other numbers are decimal and cut to integers; both become ``0x%02X``. Other text in capitals; blank is null."""
    t = F.btrim(text)
    as_hex = F.when(t.rlike(r"^0[xX][0-9a-fA-F]+(_[0-9a-fA-F]+)*$"), F.conv(F.replace(F.substring(t, 3, 64), F.lit("_"), F.lit("")), 16, 10).cast("long"))
    as_decimal = once(text_number(t), lambda x: F.when(F.abs(x) < 9e18, x.cast("long")))
    digits = lambda n: once(F.hex(F.abs(n)), lambda h: F.lpad(h, F.greatest(F.lit(2), F.length(h)), F.lit("0")))
    shown = once(F.coalesce(as_hex, F.when(~F.lower(t).startswith("0x"), as_decimal)), lambda n: F.concat(F.when(n < 0, F.lit("0x-")).otherwise("0x"), digits(n)))
    return F.when(t != "", F.coalesce(shown, F.upper(t)))


def labels(values: Column) -> Column:
    """Sorted, different, trimmed and non-empty texts; null gives an empty list."""
    trimmed = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.btrim(x))
    return F.sort_array(F.array_distinct(F.filter(trimmed, lambda x: x.isNotNull() & (x != ""))))


STATES = ("decoded", "suspect", "invalid")


def state_rank(state: Column) -> Column:
    """0 decoded, 1 suspect, 2 invalid; ``reject`` is invalid and unknown text is decoded."""
    t = F.lower(F.btrim(state))
    return F.when(t.isin("invalid", "reject"), 2).when(t == "suspect", 1).otherwise(0)


def state_of(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, STATES)), (rank + 1).cast("int"))


def merge_states(*states: Column) -> Column:
    ranks = [state_rank(s) for s in states]
    return state_of(F.greatest(*ranks) if len(ranks) > 1 else ranks[0])


def median(sorted_values: Column) -> Column:
    """Middle of a sorted array, the mean of the two middle ones for an even size; null for none."""
    n = F.size(sorted_values)
    low, high = F.element_at(sorted_values, ((n + 1) / 2).cast("int")), F.element_at(sorted_values, (n / 2 + 1).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def median_of(values: Column) -> Column:
    return median(F.sort_array(values))


def mad_of(values: Column, centre: Column) -> Column:
    return median(F.sort_array(F.transform(values, lambda x: F.abs(x - centre))))


def chosen(entries: list[tuple[Column, str]]) -> Column:
    """The texts whose condition holds, in order."""
    return F.array_remove(F.array(*[F.when(c, t).otherwise("") for c, t in entries]) if entries else F.array().cast("array<string>"), "")
