"""Joins to one row per key, SQL's NOT IN, newest and first rows per key.

Skew is left to Spark: ``session.tune`` turns on run-time splitting of skewed joins, also where the next
aggregation then needs a shuffle of its own. What is broadcast is decided by the planner from sizes it knows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def join_keyed(rows: DataFrame, keyed: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join many rows to a table with one row per key: never more rows than before.

    Only joins whose many-row side Spark may split at run time are allowed, so that one key may hold any share of
    ``rows``. Rows with a NULL key match nothing.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a skewed {how} join cannot be split")
    return rows.join(keyed, list(on), how)


def flag_unlisted(rows: DataFrame, column: str, values: DataFrame, value: str, name: str) -> DataFrame:
    """Add the truth of ``column NOT IN (values)``, with SQL's NULL rules, as a column.

    True for every row when the list is empty; never true when it holds a NULL, nor,
    unless it is empty, for a row whose own value is NULL.
    """
    values = values.select(F.col(value).alias("_v"))
    listing = (
        values.filter(F.col("_v").isNotNull())
        .distinct()
        .select(F.col("_v").alias(column), F.lit(True).alias("_listed"))
    )
    n = values.agg(F.count(F.lit(1))).scalar()
    known = values.agg(F.count("_v")).scalar()
    unlisted = (n == known) & F.col(column).isNotNull() & F.col("_listed").isNull()
    return (
        join_keyed(rows, listing, [column])
        .withColumn(name, F.coalesce((n == 0) | unlisted, F.lit(False)))
        .drop("_listed")
    )


def exclude_listed(
    rows: DataFrame, column: str, values: DataFrame, value: str, per: Sequence[str] = ()
) -> DataFrame:
    """The rows for which ``column NOT IN (values)`` is true (see :func:`flag_unlisted`).

    ``per`` keeps one list per key. The lists are then never counted: rows with a value are checked against their
    own value and against lists that hold a NULL, rows without one against all lists of their key. Where values are
    never NULL, the last two read next to nothing, because their filters reach the scan.
    """
    if not per:
        return flag_unlisted(rows, column, values, value, "_unlisted").filter("_unlisted").drop("_unlisted")
    values = values.select(*per, F.col(value).alias(column))
    # anti joins ask whether a row is there, however often
    with_null = values.filter(F.col(column).isNull()).select(*per)
    listing = values.filter(F.col(column).isNotNull())
    valued = join_keyed(rows.filter(F.col(column).isNotNull()), listing, [*per, column], "left_anti")
    valued = join_keyed(valued, with_null, per, "left_anti")
    blank = join_keyed(rows.filter(F.col(column).isNull()), values.select(*per), per, "left_anti")
    return valued.unionByName(blank.select(valued.columns))


def top_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key; Spark keeps only ``n`` rows per key in each task before the shuffle."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def newest(values: Sequence[str | Column], order: Sequence[str | Column], when: Column | None = None) -> Column:
    """The values of the row with the greatest order, as one mergeable aggregate."""
    picked, position = F.struct(*values), F.struct(*order)
    if when is None:
        return F.max_by(picked, position)
    return F.max_by(F.when(when, picked), F.when(when, position))


def earliest(values: Sequence[str | Column], order: Sequence[str | Column], when: Column | None = None) -> Column:
    picked, position = F.struct(*values), F.struct(*order)
    if when is None:
        return F.min_by(picked, position)
    return F.min_by(F.when(when, picked), F.when(when, position))


def scalar_lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], value: str, name: str, unique: bool = True
) -> DataFrame:
    """Add ``(SELECT value FROM table WHERE on)`` as column ``name``; NULL where there is no row.

    As in SQL, a second row for a key that is asked for is an error, raised by the task that meets it; the count is part of
    the aggregate that the look-up needs anyway. With ``unique=False`` the smallest value counts.
    """
    keyed = table.filter(F.expr(" and ".join(f"`{c}` is not null" for c in on))).groupBy(*on).agg(
        F.min(value).alias(name), F.count(F.lit(1)).alias("_rows")
    )
    found = join_keyed(rows, keyed, on)
    if unique:
        text = F.concat(F.lit(f"more than one row of {name} for {', '.join(on)} "), F.concat_ws(", ", *[F.col(c).cast("string") for c in on]))
        checked = F.when(F.col("_rows") > 1, F.raise_error(text).cast(found.schema[name].dataType)).otherwise(F.col(name))
        found = found.withColumn(name, checked)
    return found.drop("_rows")
