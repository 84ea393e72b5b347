"""Payment arrangements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import day
from meterbook.operators.joins import earliest, newest

ACCOUNT = ["customer", "account"]

# Number reported for each arrangement status; any other status gives 5.
STATUS_NUMBER = {"N": 1, "B": 2, "K": 3, "P": 4}


def status_number(status: Column) -> Column:
    number = F.lit(5)
    for code, value in STATUS_NUMBER.items():
        number = F.when(status == code, value).otherwise(number)
    return number


def arrangement_status(arrangements: DataFrame, as_of) -> DataFrame:
    """The newest arrangement; if it belongs to a group and is not over, the group's next one.

    First one row per (account, group) with its newest and next arrangement, then one
    row per account: no rows are joined back. Same dates are ordered by group, amount
    and status.
    """
    fields = [
        F.col("amount").alias("arrangement_amount"),
        F.col("arrange_date").alias("arrangement_date"),
        status_number(F.col("status")).alias("arrangement_status"),
    ]
    order = ["arrange_date", F.coalesce("group_id", F.lit(0)).alias("g"), "amount", "status"]
    upcoming = F.col("arrange_date") >= day(as_of)
    by_group = arrangements.groupBy(*ACCOUNT, "group_id").agg(
        F.max(F.struct(*order)).alias("pos"),
        newest(fields, order).alias("last"),
        earliest(fields, order, upcoming).alias("next"),
    )
    in_group = (F.col("group_id") > 0) & (F.col("pos.arrange_date") >= day(as_of))
    chosen = F.when(in_group, F.col("next")).otherwise(F.col("last"))
    return (
        by_group.withColumn("chosen", chosen)
        .groupBy(*ACCOUNT)
        .agg(F.max_by("chosen", "pos").alias("c"))
        .select(*ACCOUNT, "c.*")
    )
