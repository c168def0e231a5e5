"""Stored records by key: concurrent writers, small updates that don't move the table, and compaction.

A table is a folder with ``data/``, one folder for each write, and ``log/``, one file for each version. A log file
lists the write folders that make up the version, in their order; it is created under its final name only if that
doesn't exist, so of two writers one commits and the other looks at the new version and tries again. A reader takes the newest
log file and nothing else, and so never sees half a write.

Rows lie in buckets of their keys. An update joins its own rows, which are few, with key and content of the buckets that it
touches; the table's rows aren't shuffled for it. When a version has more than ``COMPACT_AFTER`` write folders, the writer
puts them together, so that reading costs the same however often the table was written.
"""

from __future__ import annotations

import json
import os
import urllib.parse
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scratch import discard, materialize

BUCKETS, COMPACT_AFTER, MOST_TRIES = 64, 16, 20
BUCKET, REPLACES = "_bucket", "_replaces"


class Conflict(RuntimeError):
    """Other writers were faster too often."""


@dataclass
class Version:
    number: int
    folders: list[dict]  # folder, schema, whether some of its rows replace older ones


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def newest(spark: SparkSession, path: str) -> Version:
    """The last committed version; number 0 without folders for a table that doesn't exist."""
    fs, at = _fs(spark, f"{path}/log")
    if not fs.exists(at):
        return Version(0, [])
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    last = max((n for n in names if n.endswith(".json") and not n.startswith(".")), default=None)
    if last is None:
        return Version(0, [])
    entry = json.loads(spark.read.text(f"{path}/log/{last}", wholetext=True).first()[0])
    return Version(entry["version"], entry["folders"])


def commit(spark: SparkSession, path: str, version: Version) -> bool:
    """Create the log file of this version; false if it exists already.

    The content is written under another name first and then linked or renamed without overwriting, which is one step on local and
    shared file systems and on HDFS. A store without such a step needs one writer at a time.
    """
    fs, folder = _fs(spark, f"{path}/log")
    fs.mkdirs(folder)
    name, own = f"{version.number:020d}.json", f".{uuid.uuid4().hex}"
    jvm = spark._jvm
    temp, final = jvm.org.apache.hadoop.fs.Path(folder, own), jvm.org.apache.hadoop.fs.Path(folder, name)
    out = fs.create(temp, False)
    out.write(bytearray(json.dumps({"version": version.number, "folders": version.folders}).encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            place = urllib.parse.unquote(fs.makeQualified(folder).toUri().getRawPath())
            try:
                os.link(f"{place}/{own}", f"{place}/{name}")
            except FileExistsError:
                return False
            return True
        if fs.exists(final):
            return False
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(temp, final, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True
    finally:
        fs.delete(temp, False)


def bucket_of(key: str):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")


def stored_rows(spark: SparkSession, path: str, version: Version, key: str, buckets: list[int] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The newest row of each key. Only keys that were ever replaced are looked up; whole rows aren't grouped."""
    out = None
    for i, f in enumerate(version.folders):
        rows = spark.read.schema(StructType.fromJson(json.loads(f["schema"]))).parquet(f"{path}/data/{f['folder']}").withColumn("_order", F.lit(i))
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(buckets))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if columns is not None:
        out = out.select(*columns, REPLACES, "_order")
    if any(f["replaces"] for f in version.folders):
        latest = out.filter(REPLACES).groupBy(key).agg(F.max("_order").alias("_latest"))
        out = out.join(latest, key, "left").filter(F.col("_latest").isNull() | (F.col("_order") == F.col("_latest"))).drop("_latest")
    return out.drop(REPLACES, "_order", *([BUCKET] if columns is None else []))


def _written(rows: DataFrame, path: str, replaces: bool) -> dict:
    """Write rows (with BUCKET and REPLACES) as a folder of their own."""
    folder = uuid.uuid4().hex
    rows.write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    return {"folder": folder, "schema": rows.schema.json(), "replaces": replaces}


def _dropped(spark: SparkSession, path: str, folder: str) -> None:
    fs, at = _fs(spark, f"{path}/data/{folder}")
    fs.delete(at, True)


def upsert(df: DataFrame, path: str, key: str = "record_id", content: str = "record_fingerprint") -> dict[str, int]:
    """Store rows by ``key``: new ones are inserted, those whose ``content`` changed replace the stored one, the rest is skipped.

    Any number of writers may call this at once; a writer that lost compares its rows with the new version and tries again.
    Of repeated rows one is stored; two contents of one key, or a null in either column, are an error.
    """
    spark = df.sparkSession
    given = materialize(df.withColumn(BUCKET, bucket_of(key)), "given")
    wrong = given.groupBy(key).agg(F.countDistinct(content).alias("n"), F.count(F.lit(1)).alias("rows"), F.count(content).alias("set"))
    if wrong.filter(F.col(key).isNull() | (F.col("n") > 1) | (F.col("set") < F.col("rows"))).limit(1).count():
        raise ValueError(f"{key} or {content} is null, or a {key} has rows of different {content}")
    total = given.count()
    once = given.dropDuplicates([key])
    buckets = [r[0] for r in given.select(BUCKET).distinct().collect()]  # BUCKETS at most
    for _ in range(MOST_TRIES):
        now = newest(spark, path)
        if now.folders:
            stored = stored_rows(spark, path, now, key, buckets, [key, content]).select(F.col(key).alias("_key"), F.col(content).alias("_content"))
            fresh = once.join(stored, F.col(key) == F.col("_key"), "left").filter(F.col("_key").isNull() | (F.col("_content") != F.col(content)))
            fresh = fresh.withColumn(REPLACES, F.col("_key").isNotNull()).drop("_key", "_content")
        else:
            fresh = once.withColumn(REPLACES, F.lit(False))
        fresh = materialize(fresh, "fresh")
        n = {r[0]: r[1] for r in fresh.groupBy(REPLACES).count().collect()}
        inserted, updated = n.get(False, 0), n.get(True, 0)
        if not n and now.folders:
            discard(fresh)
            break
        entry = _written(fresh, path, updated > 0)
        discard(fresh)
        if commit(spark, path, Version(now.number + 1, [*now.folders, entry])):
            break
        _dropped(spark, path, entry["folder"])
    else:
        raise Conflict(f"{MOST_TRIES} writes of others came first")
    discard(given)
    if len(newest(spark, path).folders) > COMPACT_AFTER:
        compact(spark, path, key)
    return {"inserted_records": inserted, "updated_records": updated, "skipped_records": total - inserted - updated}


def compact(spark: SparkSession, path: str, key: str = "record_id") -> bool:
    """Put the write folders of the newest version together; false if another writer came first. Older folders stay for readers until ``vacuum``."""
    now = newest(spark, path)
    if len(now.folders) < 2:
        return True
    rows = stored_rows(spark, path, now, key).withColumns({BUCKET: bucket_of(key), REPLACES: F.lit(False)})
    entry = _written(rows.repartition(BUCKET), path, False)
    if commit(spark, path, Version(now.number + 1, [entry])):
        return True
    _dropped(spark, path, entry["folder"])
    return False


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete write folders that the newest version doesn't list, when nobody reads older versions or writes; returns how many."""
    keep = {f["folder"] for f in newest(spark, path).folders}
    fs, at = _fs(spark, f"{path}/data")
    gone = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName() not in keep] if fs.exists(at) else []
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def current_rows(spark: SparkSession, path: str, key: str = "record_id") -> DataFrame:
    """The newest stored row of each key."""
    now = newest(spark, path)
    if not now.folders:
        raise ValueError("the table has no complete version")
    return stored_rows(spark, path, now, key)
