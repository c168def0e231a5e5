"""Sensor packets as hex text: validation, unpacking and records, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from .exports import text_of

# The packet's layout.
ORDINALS = ["First", "Second", "Third", "Fourth", "Fifth", "Sixth", "Seventh", "Eighth", "Ninth", "Tenth", "Eleventh", "Twelfth", "Thirteenth", "Fourteenth", "Fifteenth"]
SLOTS = [f"{o}Packet" for o in ORDINALS]
SIZE, HEADER = 51, 4
#: (field, bytes, signed), little-endian, without gaps
LAYOUT = [
    ("rtd1_t_x100", 2, True), ("rtd2_t_x100", 2, True), ("rtd3_t_x100", 2, True), ("rtd4_t_x100", 2, True), ("tmp102_t_x100", 2, True),
    ("moist_pc", 2, False), ("flood_flag", 1, False), ("rain_mm", 2, False), ("sleeper_rh", 2, False), ("lat", 4, True), ("lon", 4, True),
    ("year", 2, False), ("month", 1, False), ("day", 1, False), ("hour", 1, False), ("minute", 1, False), ("second", 1, False),
]
META = ["ControllerName", "Site", "Location", "Area"]
#: The columns of an export without names, in their order
POSITIONS = [
    "time", "Area", "ControllerName", "EighthPacket", "EleventhPacket", "FifteenthPacket", "FifthPacket", "FirstPacket", "FourteenthPacket", "FourthPacket", "Latitude",
    "Location", "Longitude", "NinthPacket", "SecondPacket", "SeventhPacket", "Site", "SixthPacket", "TenthPacket", "ThirdPacket", "ThirteenthPacket", "TwelfthPacket",
]


def integer(hexes: Column, at: int, size: int, signed: bool) -> Column:
    """The little-endian integer at byte ``at`` of a hex text."""
    big = F.concat(*[F.substring(hexes, 2 * (at + k) + 1, 2) for k in range(size - 1, -1, -1)])
    n = F.conv(big, 16, 10).cast("long")
    return F.when(n >= 1 << (8 * size - 1), n - (1 << (8 * size))).otherwise(n) if signed else n


def is_empty(packet: Column) -> Column:
    return packet.isNull() | (F.lower(F.btrim(packet)) == "null")


def is_well_formed(packet: Column) -> Column:
    """``<hex>,<port>``; white space may part the bytes and surround the port."""
    return packet.rlike(r"^(\s*[0-9a-fA-F]{2})*\s*,\s*[+-]?\d+(_\d+)*\s*$")


def sensor_hex(packet: Column, strict: bool = True) -> Column:
    """The packet as hex text in capitals; null for none and for other kinds of packets.

    A packet that isn't well-formed fails the job if ``strict``, else it counts as none.
    """
    hexes = F.regexp_replace(F.upper(F.substring_index(packet, ",", 1)), r"\s", "")
    real = hexes.rlike("^.{4}00(?!00|FF)..") & (F.length(hexes) == 2 * SIZE) & ~hexes.endswith("FF" * (SIZE - HEADER))
    out = F.when(is_well_formed(packet), F.when(real, hexes))
    if strict:
        out = out.otherwise(F.raise_error(F.concat(F.lit("not a packet: "), packet)).cast("string"))
    return F.when(~is_empty(packet), out)


def last_hex(packets: list[Column], strict: bool = True) -> Column:
    """The last packet that holds environment values. If ``strict``, a packet that isn't well-formed fails the job in whatever slot it is."""
    last = F.coalesce(*[sensor_hex(p, False) for p in reversed(packets)])
    if not strict:
        return last
    wrong = F.coalesce(*[F.when(~is_empty(p) & ~is_well_formed(p), p) for p in packets])
    return F.when(wrong.isNotNull(), F.raise_error(F.concat(F.lit("not a packet: "), wrong)).cast("string")).otherwise(last)


def unpacked(hexes: Column) -> Column:
    """The environment values of a packet as a struct; null for null."""
    fields, at = [], HEADER
    for field, size, signed in LAYOUT:
        fields.append(integer(hexes, at, size, signed).alias(field))
        at += size
    return F.when(hexes.isNotNull(), F.struct(*fields))


def with_frame(df: DataFrame, packets: list[Column], name: str, strict: bool = True) -> DataFrame:
    """Add the environment values of the last packet that has some; null if none has.

    The packet is chosen in a projection of its own, so one is unpacked, not each. Don't filter on
    the result: the optimizer would copy all of it into the filter.
    """
    return df.withColumn("_hex", last_hex(packets, strict)).withColumn(name, unpacked(F.col("_hex"))).drop("_hex")


def by_position(values: Column, strict: bool = True) -> Column:
    """An export row without column names (array of variants) as a map from name to value; surplus values are left out.

    A row that is too short fails the job if ``strict``, else it is null. Null stays null.
    """
    n = len(POSITIONS)
    out = F.when(F.size(values) >= n, F.map_from_arrays(F.array(*map(F.lit, POSITIONS)), F.slice(values, 1, n)))
    if strict:
        lacking = F.concat(F.lit("a row has only "), F.size(values).cast("string"), F.lit(f" of {n} values"))
        out = out.when(values.isNotNull(), F.raise_error(lacking).cast("map<string,variant>"))
    return out


def export_records(rows: DataFrame, strict: bool = True, source_type: str = "sensor_export") -> DataFrame:
    """Canonical records of the export rows that hold a frame (``row``: map of variants).

    Rows without a frame are dropped. A row that lacks the column of a packet, a time or a device, or with a
    coordinate that is no number, fails the job if ``strict``, else an absent packet counts as none and other such rows are dropped.
    """
    cell = lambda name: F.col("row")[name]
    packets = [V.as_text(cell(s)) for s in SLOTS]
    df = rows.withColumns({"_time": text_of(cell("time")), "_device": V.as_text(cell("ControllerName")), "_hex": last_hex(packets, strict)})
    ok = F.col("_time").isNotNull() & F.col("_device").isNotNull() & V.number(cell("Latitude")).isNotNull() & V.number(cell("Longitude")).isNotNull()
    if strict:
        ok = ok & F.forall(F.array(*map(F.lit, SLOTS)), lambda s: F.map_contains_key("row", s))
    lacking = F.raise_error(F.lit("a row lacks its time, device, place or the column of a packet")).cast("boolean") if strict else F.lit(False)
    df = df.filter(F.when(ok, F.col("_hex").isNotNull()).otherwise(lacking))
    used = F.transform(F.array(*[F.struct(F.lit(s).alias("k"), text_of(cell(s)).alias("x")) for s in SLOTS]), lambda c: F.when(c["x"].isNotNull(), F.concat(c["k"], F.lit("="), c["x"])))
    identity = F.concat_ws("|", F.col("_device"), F.col("_time"), F.array_join(F.array_sort(F.array_compact(used)), "&"))
    filled = F.map_filter("row", lambda k, v: text_of(v).isNotNull() | (~V.is_absent(v) & ~V.is_text(v)))
    empty = F.array().cast("array<string>")
    return df.select(
        F.concat(F.lit("sensor:"), F.sha2(identity, 256)).alias("record_id"), F.lit("decoded_record/v1").alias("schema_version"), F.col("_device").alias("device_id"), F.lit("environment").alias("family"),
        F.lit(None).cast("string").alias("function_id"), F.col("_time").alias("timestamp"), F.col("_time").alias("source_time_utc"), F.lit(None).cast("string").alias("ingest_time_utc"), F.lit(source_type).alias("source_type"), F.lit("decoded").alias("quality_state"),
        empty.alias("quality_flags"), empty.alias("analysis_tags"), V.parse_payload(F.to_json(unpacked(F.col("_hex")))).alias("payload"),
        F.map_filter(filled, lambda k, _: k.isin(META)).alias("platform_meta"), F.map_filter(filled, lambda k, _: ~k.isin([*META, "time"])).alias("raw_unmapped"),
    )
