"""Versioned tables: pinned readers, refused writers, killed jobs, buckets that stay."""

import os

import pytest
from pyspark.sql import functions as F

from meterbook.operators.publish import CheckFailed
from meterbook.operators.versions import VersionConflict, VersionedTable


def rows(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture
def frame(spark):
    return spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


def test_two_writers_from_one_version(spark, tmp_path, frame):
    one, two = (VersionedTable(spark, f"{tmp_path}/t") for _ in range(2))
    assert one.latest() is None
    first = one.replace(frame, None)
    assert (first.number, first.rows) == (0, 40)
    seen = two.latest()
    one.append(frame.limit(3), first, expected=3)
    with pytest.raises(VersionConflict):
        two.append(frame.limit(5), seen, expected=5)
    with pytest.raises(VersionConflict):
        two.replace(frame, None)
    assert one.latest().rows == 43 == one.read().count()


def test_reader_keeps_its_version(spark, tmp_path, frame):
    table = VersionedTable(spark, f"{tmp_path}/t")
    first = table.replace(frame, None)
    reader = table.read()
    second = table.append(frame.withColumn("v", F.lit(-1).cast("long")), first)
    assert rows(reader) == rows(frame) and rows(table.read(first)) == rows(frame)
    assert table.read(second).count() == 80
    table.replace(table.read(second).where("v = -1"), second)
    assert rows(reader) == rows(frame) and table.read().count() == 40


def test_rejected_or_killed_append_leaves_no_row(spark, tmp_path, frame):
    table = VersionedTable(spark, f"{tmp_path}/t")
    first = table.replace(frame, None)
    with pytest.raises(CheckFailed):
        table.append(frame, first, expected=39)
    with pytest.raises(CheckFailed):
        table.append(frame, first, check=lambda staged: staged.where("v < 0").count() > 0)
    broken = frame.withColumn("v", F.when(F.col("k") == 39, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.append(broken, first)
    # a writer that stopped behind its rows and in front of its manifest
    table._write(frame)
    assert table.latest() == first and rows(table.read()) == rows(frame)
    assert len(table.vacuum(1)) >= 3 and rows(table.read()) == rows(frame)


def files_of(table, version):
    return {f"{folder}/{name}" for folder in version.folders() for name in os.listdir(folder) if name.endswith(".parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path, frame):
    table = VersionedTable(spark, f"{tmp_path}/t", key="k", buckets=8)
    first = table.replace(frame, None)
    assert len(first.parts) == 8
    touched = frame.where("k in (3, 4)")
    own = {r[0] for r in touched.select(table._bucket()).collect()}
    double = lambda part: part.withColumn("v", F.when(F.col("k").isin(3, 4), F.col("v") * 2).otherwise(F.col("v")))
    second = table.rewrite(touched, double, first)
    assert rows(table.read()) == rows(double(frame)) and second.rows == 40
    kept = {p for b, p in map(tuple, first.parts) if b not in own}
    assert kept == set(second.folders()) & set(first.folders())
    assert {f for f in files_of(table, first) if f.rsplit("/", 1)[0] in kept} <= files_of(table, second)
    assert table.rewrite(touched.where("k < 0"), double, second) == second
    with pytest.raises(CheckFailed):
        table.rewrite(touched, lambda part: part.withColumn("k", F.col("k") + 1000), second)
    with pytest.raises(VersionConflict):
        table.rewrite(touched, double, first)
    # rows may be dropped, and a bucket may become empty
    third = table.rewrite(frame, lambda part: part.where("k = 0"), second)
    assert rows(table.read(third)) == [(0, 0)] and third.rows == 1
    fourth = table.append(frame.limit(2), third)
    assert fourth.rows == 3 and table.read().count() == 3
    table.vacuum(1)
    assert table.read().count() == 3
