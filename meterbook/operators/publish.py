"""Snapshots and checked appends of parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class CheckFailed(RuntimeError):
    """Staged rows did not pass their check; the table was left as it was."""


def table_exists(spark: SparkSession, path: str) -> bool:
    """A finished table: its writer left the success marker."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put one folder in the place of another."""
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")


def snapshot(df: DataFrame, path: str, mode: str = "if_absent") -> DataFrame:
    """Write a copy of a table and return its row count.

    ``if_absent`` leaves a finished copy alone, ``replace`` writes it anew: aside first, then
    in place of the old copy, so that ``df`` may read the table it replaces.
    """
    if mode not in ("if_absent", "replace"):
        raise ValueError(mode)
    spark = df.sparkSession
    if mode == "replace" or not table_exists(spark, path):
        # an unfinished copy (no success marker) is written over as well
        aside = f"{path}-{uuid.uuid4().hex}"
        df.write.parquet(aside)
        _move(spark, aside, path)
        spark.catalog.refreshByPath(path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("snapshot_rows"))


def checked_append(
    base_path: str,
    new: DataFrame,
    expected: int,
    staging_path: str,
    check: Callable[[DataFrame], bool] | None = None,
) -> DataFrame:
    """Append rows to a parquet table only if they pass a check.

    The rows are written to a staging folder and read back; if their count is not the
    expected one, or ``check`` rejects them, :class:`CheckFailed` is raised and the
    table is untouched. Otherwise the staged files' rows are appended in one job, which
    Spark commits as a whole. Returns one row of counts.
    """
    spark = new.sparkSession
    staged_path = f"{staging_path}/{uuid.uuid4().hex}"
    new.write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    found = staged.count()
    if found != expected:
        raise CheckFailed(f"expected {expected} rows, staged {found}")
    if check is not None and not check(staged):
        raise CheckFailed("the staged rows were rejected")
    before = spark.read.parquet(base_path).count()
    staged.write.mode("append").parquet(base_path)
    after = spark.read.parquet(base_path).agg(F.count(F.lit(1)).alias("rows_after"))
    return after.select(
        F.lit(before).cast("bigint").alias("rows_before"),
        F.lit(found).cast("bigint").alias("rows_added"),
        "rows_after",
        (F.col("rows_after") == before + found).alias("ok"),
    )


def write_ordered(df: DataFrame, path: str, order: Sequence[str | Column]) -> DataFrame:
    """Write rows so that the files by name, and the rows in them, are in order; returns what was written.

    Spark deals the rows by ranges of the order and sorts each range, so no task holds more than its range.
    """
    df.orderBy(*order).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a working table dealt to buckets by its keys, as catalog table ``name`` in folder ``path``.

    Joins and sums on these keys between tables with as many buckets need no exchange.
    """
    spark = df.sparkSession
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)
