"""Transaction-code lists and settings read from small code tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import comma_list
from meterbook.operators.joins import join_keyed

ACCOUNT = ["customer", "account"]


def balance_codes(ar_codes: DataFrame) -> Column:
    """Credit and debit codes of the summary and balance receivable codes, as one list text.

    The text holds the whole list by definition; blank codes are skipped.
    """
    counted = ar_codes.filter(F.col("is_summary") | F.col("in_balance"))
    both = counted.select(F.col("credit_code").alias("code")).unionByName(
        counted.select(F.col("debit_code").alias("code"))
    )
    codes = both.filter(F.col("code") != "").distinct()
    return codes.agg(comma_list(F.array_sort(F.collect_set("code")))).scalar()


def excluded_codes(ar_codes: DataFrame, plans: DataFrame) -> tuple[Column, Column]:
    """The balance list, and that list extended by the plan's own credit and debit lists.

    Without a plan both lists are empty texts; a NULL list makes the whole text NULL.
    """
    base = balance_codes(ar_codes)
    no_plan = F.col("plan_type").isNull()
    credits = F.when(no_plan, "").otherwise(F.col("exclude_credits"))
    debits = F.when(no_plan, "").otherwise(F.col("exclude_debits"))
    return base, F.concat(base, credits, F.lit(","), debits, F.lit(","))


def exclude_codes(accounts: DataFrame, plans: DataFrame, ar_codes: DataFrame) -> DataFrame:
    """Both code lists for every account."""
    frame = accounts.select(*ACCOUNT).distinct().join(
        plans.select(*ACCOUNT, "plan_type", "exclude_credits", "exclude_debits"), ACCOUNT, "left"
    )
    base, full = excluded_codes(ar_codes, plans)
    return frame.select(*ACCOUNT, base.alias("balance_codes"), full.alias("exclude_codes"))


def notice_codes_on(trans_codes: DataFrame) -> bool:
    """Does any transaction code count towards the balance owing?

    Read once while the plan is built: it decides which of two different sets of
    tables the not-due amount is taken from.
    """
    return not trans_codes.filter("include_in_owing").isEmpty()


def translate_codes(
    rows: DataFrame, crosswalk: DataFrame, key: int, column: str, name: str = "internal_code"
) -> DataFrame:
    """Internal code for an external value under one integration key; NULL if unknown.

    A value listed twice under a key takes the smallest code, so rows never multiply.
    """
    mapping = (
        crosswalk.filter(F.col("integ_key") == key)
        .groupBy(F.col("external_value").alias(column))
        .agg(F.min("internal_code").alias(name))
    )
    return join_keyed(rows, mapping, [column], "left")
