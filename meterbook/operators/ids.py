"""Consecutive ids over a distributed sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterbook.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def highest_id(table: DataFrame, column: str) -> Column:
    """The greatest id of a table, 0 when it is empty, as a scalar subquery."""
    return table.agg(F.coalesce(F.max(column).cast("bigint"), F.lit(0).cast("bigint"))).scalar()


def assign_ids(rows: DataFrame, order: Sequence[str], start: Column | int, name: str) -> DataFrame:
    """Add ``start + 1, start + 2, …`` in the given order.

    The order must be total. Rows are range-partitioned on it, so a key with many
    rows spreads over several tasks; each row is numbered inside its partition, and
    the partitions' row counts (one row per partition) give the offsets. The rows are
    written before the range partitioning, which reads them twice (it samples), and the
    numbered rows after it: both later reads see the same partitions even if an executor
    is lost in between.
    """
    placed = materialize(
        materialize(rows).repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    numbered = (
        placed.withColumn("_part", F.shiftright("_pos", _ROW_BITS))
        .withColumn("_row", F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    counts = numbered.groupBy("_part").agg((F.max("_row") + 1).alias("_n"))
    # one row per partition, so a single window over them is small by construction
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, (first + F.col("_offset") + F.col("_row") + 1).cast("bigint"))
        .drop("_part", "_pos", "_row", "_offset")
    )
