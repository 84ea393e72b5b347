"""Payment plans: active enrolments, plan status, balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import active_at, money, or_zero, total
from meterbook.operators.joins import join_keyed, newest
from meterbook.operators.ranges import range_join

ACCOUNT = ["customer", "account"]

# Number reported for each plan class.
PLAN_NUMBER = {"E": 1, "V": 2, "L": 3}

# Plan types whose balance the older summary reads from the plan.
BALANCE_PLANS_V1 = ["EN", "LN"]


def active_plans(enrolments: DataFrame, plan_types: DataFrame, as_of) -> DataFrame:
    """Enrolments in force on a day, with the settings of their plan type."""
    running = enrolments.filter(active_at(F.col("start_date"), F.col("stop_date"), as_of))
    return join_keyed(running, plan_types, ["plan_type"], "inner")


def active_plans_on(dates: DataFrame, enrolments: DataFrame, plan_types: DataFrame, date: str = "as_of") -> DataFrame:
    """The enrolments in force on each of many days, with the settings of their plan type."""
    running = range_join(dates.select(date), date, enrolments, "start_date", "stop_date")
    return join_keyed(running, plan_types, ["plan_type"], "inner")


def plan_number(plan_class: Column) -> Column:
    number = F.lit(0)
    for code, value in PLAN_NUMBER.items():
        number = F.when(plan_class == code, value).otherwise(number)
    return number


def plan_status(enrolments: DataFrame, plan_types: DataFrame, as_of) -> DataFrame:
    """One active plan per account: the one started last, then the greatest plan type."""
    fields = [
        "plan_type",
        "plan_class",
        "draw",
        "use_plan_balance",
        "use_plan_billed",
        "exclude_credits",
        "exclude_debits",
    ]
    picked = (
        active_plans(enrolments, plan_types, as_of)
        .groupBy(*ACCOUNT)
        .agg(newest(fields, ["start_date", "plan_type"]).alias("p"))
        .select(*ACCOUNT, "p.*")
    )
    billed = F.when(~F.col("plan_class").isin("E", "L"), F.lit(False)).otherwise(F.col("use_plan_billed"))
    return picked.withColumn("plan_number", plan_number(F.col("plan_class"))).withColumn("use_plan_billed", billed)


def plan_status_v1(enrolments: DataFrame, plan_types: DataFrame, as_of) -> DataFrame:
    """The older form reads every active plan in start order, so the last one wins.

    The number comes from the last plan of a known class, and the plan balance is
    used if any active plan of a listed type asks for it.
    """
    order = ["start_date", "plan_type"]
    known = F.col("plan_class").isin(*PLAN_NUMBER)
    uses_balance = F.col("plan_type").isin(*BALANCE_PLANS_V1) & F.col("use_plan_balance")
    return (
        active_plans(enrolments, plan_types, as_of)
        .groupBy(*ACCOUNT)
        .agg(
            F.max_by("draw", F.struct(*order)).alias("draw"),
            newest([plan_number(F.col("plan_class")).alias("n")], order, known)["n"].alias("plan_number"),
            F.coalesce(F.max(uses_balance), F.lit(False)).alias("use_plan_balance"),
        )
        .withColumn("plan_number", F.coalesce("plan_number", F.lit(0)))
    )


def ar_balance(ar_balances: DataFrame, ar_codes: DataFrame) -> DataFrame:
    """Receivable balance over the codes that count towards it."""
    counted = ar_codes.filter("in_balance").select("ar_code").distinct()
    return (
        join_keyed(ar_balances, counted, ["ar_code"], "left_semi")
        .groupBy(*ACCOUNT)
        .agg(total(F.col("current_balance")).alias("ar_balance"))
    )


def plan_balance(plan_balances: DataFrame) -> DataFrame:
    """Plan balance and credits of each account (one row per account in the source)."""
    return (
        plan_balances.groupBy(*ACCOUNT)
        .agg(newest([money(F.col("plan_billed") + F.col("credits")).alias("plan_balance"), "credits"],
                    ["plan_billed", "credits"]).alias("b"))
        .select(*ACCOUNT, "b.*")
    )


def balance_rule(frame: DataFrame) -> DataFrame:
    """Current balance and plan credit from plan settings, plan balance and receivables.

    A plan that keeps its own balance is used only for classes E and L; with any
    other class, or with no setting, the balance stays 0.
    """
    setting = F.col("use_plan_balance")
    no_plan = F.col("plan_class").isNull() & F.col("plan_type").isNull()
    own = F.col("plan_class").isin("E", "L") & setting
    balance = F.when(no_plan | ~setting, F.col("ar_balance")).when(own, F.col("plan_balance"))
    return frame.withColumn("current_balance", or_zero(balance)).withColumn(
        "plan_credit", or_zero(F.when(own, F.col("credits")))
    )


def current_balance(
    accounts: DataFrame,
    enrolments: DataFrame,
    plan_types: DataFrame,
    plan_balances: DataFrame,
    ar_balances: DataFrame,
    ar_codes: DataFrame,
    as_of,
) -> DataFrame:
    """Balance of every account: receivables, or the plan's own balance."""
    frame = (
        accounts.select(*ACCOUNT)
        .distinct()
        .join(plan_status(enrolments, plan_types, as_of), ACCOUNT, "left")
        .join(plan_balance(plan_balances), ACCOUNT, "left")
        .join(ar_balance(ar_balances, ar_codes), ACCOUNT, "left")
    )
    return balance_rule(frame).select(*ACCOUNT, "current_balance")
