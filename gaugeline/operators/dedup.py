"""Fingerprints, duplicates, the ledger, run keys and slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import materialize


def canonical_payload(payload: Column) -> Column:
    """``key=value`` pairs of a payload map in order of the keys; values as JSON text."""
    pairs = F.transform(F.map_entries(payload), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(F.to_json(e["value"]), F.lit("null"))))
    return F.coalesce(F.array_join(F.array_sort(pairs), "&"), F.lit(""))


def fingerprint(parts: Sequence[Column]) -> Column:
    """SHA-256 of the parts, joined by ``|``; null parts count as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def mark_duplicates(df: DataFrame, ledger: DataFrame | None = None, order: Sequence[str] = ("seq",)) -> DataFrame:
    """``is_duplicate``: the fingerprint is in the ledger or on an earlier row.

    The first row of a fingerprint comes from a partial minimum and a join, so a fingerprint
    with very many rows is not one task's window.
    """
    first = df.groupBy("fingerprint").agg(F.min(F.struct(*order)).alias("_first"))
    if ledger is not None:
        known = ledger.select("fingerprint").distinct().withColumn("_known", F.lit(True))
        first = first.join(known, "fingerprint", "left")
    else:
        first = first.withColumn("_known", F.lit(None).cast("boolean"))
    out = df.join(first, "fingerprint")
    return out.withColumn("is_duplicate", F.coalesce("_known", F.lit(False)) | (F.struct(*order) != F.col("_first"))).drop("_first", "_known")


def ledger_scan(df: DataFrame, ledger: DataFrame | None, capacity: int, group: Sequence[str], order: Sequence[Column | str], eligible: str) -> tuple[DataFrame, DataFrame]:
    """Duplicates by one bounded ledger for all rows: (``df`` with ``is_duplicate``, the ledger after it).

    Rows come in ``order``, whose first columns are the ``group`` (here a device and a time). A row is a duplicate if its fingerprint
    is in the ledger or on an earlier ``eligible`` row of this run. Other eligible rows are entered after their group, and
    what exceeds ``capacity`` goes, the oldest first; so an entry of an earlier run may be gone when its fingerprint comes again, which is then
    entered anew. A fingerprint determines its group. ``ledger``: fingerprint, device_id, place (ascending, no order within equal ones);
    the result has the same columns. Null fingerprints are told by nothing.

    Nothing is queued one by one: first rows of fingerprints are a grouped minimum; how many come before an entry's group is a
    prefix sum over ranges; only the entries that come again, at most ``capacity``, meet on the driver, where those that are entered anew
    move the later ones.
    """
    known, first, after = ledger_step(df, ledger, capacity, group, order, eligible)
    marked = df.withColumn("_at", row_place(order)).join(first.select("fingerprint", "_first"), "fingerprint", "left")
    told = F.coalesce(F.col("_first") < F.col("_at"), F.lit(False))
    if known is not None:
        marked = marked.join(known.withColumn("_known", F.lit(True)), "fingerprint", "left")
        told = told | F.coalesce("_known", F.lit(False))
    return marked.withColumn("is_duplicate", told).select(*df.columns, "is_duplicate"), after


def row_place(order: Sequence[Column | str]) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)])


def ledger_step(df: DataFrame, ledger: DataFrame | None, capacity: int, group: Sequence[str], order: Sequence[Column | str], eligible: str) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """What ``ledger_scan`` needs: the entries that are still there when their fingerprint comes (none without a ledger), the first eligible row of each fingerprint, the ledger afterwards."""
    spark = df.sparkSession
    groups = F.struct(*[c for i, g in enumerate(group) for c in (F.col(g).isNull().alias(f"n{i}"), F.col(g).alias(f"g{i}"))])
    first = df.groupBy("fingerprint").agg(F.min(F.when(F.col(eligible), row_place(order))).alias("_first"), F.min(groups).alias("_group"), F.min("device_id").alias("device_id"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_first"))
    old = size = None
    if ledger is not None:
        old = ledger.orderBy(F.desc("place")).limit(capacity)  # a top-k of at most `capacity` rows
        old = materialize(old.withColumn("_old", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("place")) - 1), "ledger")
        size, base = old.agg(F.count(F.lit(1)), F.max("place")).first()
    if not size:
        last = first.filter(F.col("_first").isNotNull()).orderBy(F.desc("_first")).limit(capacity)
        return None, first, last.select("fingerprint", "device_id", place.cast("long").alias("place"))
    first = materialize(first.join(old.select("fingerprint", "_old"), "fingerprint", "left"), "first-rows")
    # at most `capacity` fingerprints
    gone = spark.createDataFrame([(f,) for f in gone_entries(first, size, capacity)], "fingerprint string").withColumn("_gone", F.lit(True))
    known = old.join(gone, "fingerprint", "left_anti").select("fingerprint")
    inserted = first.join(gone, "fingerprint", "left").filter(F.col("_first").isNotNull() & (F.col("_old").isNull() | F.col("_gone")))
    stay = old.filter(F.col("_old") >= size + inserted.count() - capacity).select("fingerprint", "device_id", "place")
    last = inserted.orderBy(F.desc("_first")).limit(capacity)
    return known, first, materialize(stay.unionByName(last.select("fingerprint", "device_id", (place + F.lit(base)).cast("long").alias("place"))), "ledger")


def gone_entries(first: DataFrame, size: int, capacity: int) -> list[str]:
    """Of the ledger's entries that come again (``_old``: their number from the oldest) those that are gone by then. Those with an eligible row are entered anew."""
    groups = first.select("_group", "_old", "fingerprint", F.col("_first").isNotNull().alias("enters"))
    parts = max(1, first.sparkSession.sparkContext.defaultParallelism)
    groups = materialize(groups.repartitionByRange(parts, "_group").withColumn("part", F.spark_partition_id()), "first-groups")
    new = F.when(F.col("_old").isNull() & F.col("enters"), 1).otherwise(0)
    # fingerprints of earlier groups in the same range; those of the ranges before are added below
    upto = F.sum(new).over(Window.partitionBy("part").orderBy("_group")) - F.sum(new).over(Window.partitionBy("part", "_group"))
    again = groups.withColumn("inner", upto).filter(F.col("_old").isNotNull())
    before, total = {}, 0
    for r in groups.groupBy("part").agg(F.sum(new).alias("n")).orderBy("part").collect():
        before[r["part"]] = total
        total += r["n"]
    gone, entered, earlier, group = [], 0, 0, None
    for r in again.orderBy("_group").collect():
        if r["_group"] != group:
            group, earlier = r["_group"], entered
        if r["_old"] < size + before[r["part"]] + r["inner"] + earlier - capacity:
            gone.append(r["fingerprint"])
            entered += r["enters"]
    return gone


def ledger_tail(entries: DataFrame, capacity: int, order: Sequence[str] = ("seq",)) -> DataFrame:
    """The last ``capacity`` entries in order; a top-k, so nothing is sorted whole."""
    return entries.orderBy(*[F.desc(c) for c in order]).limit(capacity)


def not_in_ledger(df: DataFrame, ledger: DataFrame) -> DataFrame:
    return df.join(ledger.select("fingerprint"), "fingerprint", "left_anti")


def repeated_ids(df: DataFrame, key: str = "record_id") -> DataFrame:
    """Ids on more than one row with their number."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def execution_slot(us: Column, minutes: int = 15) -> Column:
    """Start of the slot in microseconds."""
    width = minutes * 60_000_000
    return us - F.pmod(us, F.lit(width))


def run_key(df: DataFrame, by: Sequence[str], metadata: str, digits: int = 2) -> DataFrame:
    """An idempotency key for each group: SHA-256 of metadata and the digests of its sorted fingerprints.

    Fingerprints are digested in ranges by their first ``digits`` hex digits and then the digests in
    order of the ranges, so that no group is gathered in one value. The key therefore differs from one
    over all fingerprints at once.
    """
    ranges = df.withColumn("_range", F.substring("fingerprint", 1, digits)).groupBy(*by, "_range")
    parts = ranges.agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("fingerprint")), ","), 256).alias("_digest"))
    digests = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_range", "_digest"))), lambda x: x["_digest"]), ",")
    body = F.concat_ws("|", F.lit(metadata), *[F.col(c).cast("string") for c in by], digests)
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.concat(F.lit("run:"), F.sha2(body, 256)).alias("run_key"))
