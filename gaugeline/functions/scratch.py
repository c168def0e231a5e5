"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """This application's folder in the one that driver and executors share, ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a temporary folder. Elsewhere a
    machine-local folder would lose the executors' files, so that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.gettempdir()
    return f"{root.rstrip('/')}/gaugeline-{context.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    This cuts the lineage, keeps a single computation for several readers, and
    survives the loss of executors because the files are on shared storage. ``discard`` removes what
    later steps have written anew; the rest stays as long as a returned table may be read, and all of
    it lies in one folder for each application.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` gave and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
