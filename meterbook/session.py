"""Session settings the jobs rely on, and scratch tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_PREFIX = "meterbook-scratch"


def tune(spark: SparkSession) -> SparkSession:
    """Turn on run-time re-planning; safe to call on any live session.

    ``forceOptimizeSkewedJoin`` lets Spark split a skewed join even where the
    next aggregation then needs a shuffle of its own. The group limit lets first-n-per-key plans
    drop rows before the shuffle for any n that a report asks for.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1000000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where that is unset, a folder under the session's warehouse, which executors share as well. A warehouse on the
    driver's own disk will do on a local master only.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        if folder.startswith("file:") and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    """A new path for one scratch table, in a folder of this application."""
    return f"{shared_dir(spark)}/{_PREFIX}-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write a result once to the shared folder and read it back.

    Later steps then share one computation, see the real size of the table, and
    survive lost executors. ``release`` removes the table when nothing reads it any more.
    ``by`` names a column whose values get folders of their own, so that a filter on it reads only those.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(*tables: DataFrame) -> None:
    """Remove scratch tables that no later step reads."""
    for table in tables:
        if path := getattr(table, "_scratch", None):
            _delete(table.sparkSession, path)


def release_all(spark: SparkSession) -> None:
    """Remove every scratch table of this application: call it when results are stored."""
    _delete(spark, f"{shared_dir(spark)}/{_PREFIX}-{spark.sparkContext.applicationId}")
