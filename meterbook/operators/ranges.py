"""Joins of points to the intervals that hold them, by equality alone.

An interval of days is cut into blocks of 1, 2, 4, … days that start at multiples of their length: at most two of each
length, and no day in two of them. A day lies in one block of each length. Day and interval therefore meet in exactly one
block, and the join is on (length, block). A long interval costs a few rows, not one for each of its days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by.cast("int"))


def blocks_of(first: Column, last: Column, levels: Column) -> Column:
    """The blocks, as (level, block) structs, that make up the whole numbers from ``first`` to ``last`` (not below 0)."""

    def pair(level: Column) -> Column:
        span = _shift("shiftleft", F.lit(1).cast("bigint"), level)
        low = _shift("shiftright", first + span - 1, level)
        high = _shift("shiftright", last + 1, level)
        some = low < high
        entry = lambda use, block: F.when(use, F.struct(level.alias("level"), block.alias("block")))
        return F.array(entry(some & (F.pmod(low, F.lit(2)) == 1), low), entry(some & (F.pmod(high, F.lit(2)) == 1), high - 1))

    found = F.flatten(F.transform(F.sequence(F.lit(0), levels), pair))
    return F.filter(found, lambda b: b.isNotNull())


def range_join(
    points: DataFrame, point: str, intervals: DataFrame, first: str, last: str, on: Sequence[str] = ()
) -> DataFrame:
    """Each date of ``points`` with every interval that holds it, both ends included, and equal in the columns ``on``.

    A NULL ``last`` is open, a NULL ``first`` or date matches nothing, and an interval that ends before it starts is empty.
    Columns of both sides must differ but for ``on``. Intervals are cut to the span of the dates first.
    """
    number = lambda c: F.date_diff(c, F.lit("1900-01-01").cast("date")).cast("bigint")
    span = points.agg(F.min(point).alias("lo"), F.max(point).alias("hi"))
    low, high = span.select(number(F.col("lo"))).scalar(), span.select(number(F.col("hi"))).scalar()
    # the length of the span in binary digits: no longer block is needed
    levels = F.length(F.conv((high - low + 1).cast("string"), 10, 2))
    days = points.filter(F.col(point).isNotNull()).withColumn("_day", number(F.col(point)) - low)
    each = days.withColumn("_levels", levels).withColumn("_level", F.explode(F.sequence(F.lit(0), F.col("_levels")))).withColumn(
        "_block", _shift("shiftright", F.col("_day"), F.col("_level"))
    ).drop("_day", "_levels")
    start = F.greatest(number(F.col(first)), low) - low
    stop = F.least(F.coalesce(number(F.col(last)), high), high) - low
    cut = intervals.filter(F.col(first).isNotNull()).withColumn("_from", start).withColumn("_to", stop).filter("_from <= _to")
    cut = cut.withColumn("_levels", levels)
    blocks = cut.withColumn("_at", F.explode(blocks_of(F.col("_from"), F.col("_to"), F.col("_levels")))).drop("_from", "_to", "_levels")
    blocks = blocks.withColumn("_level", F.col("_at.level")).withColumn("_block", F.col("_at.block")).drop("_at")
    return each.join(blocks, [*on, "_level", "_block"]).drop("_level", "_block")
