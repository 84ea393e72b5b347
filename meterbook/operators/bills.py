"""Bills: the real-bill filter, newest bills, due amounts, history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import (
    business_days_add,
    day,
    empty_date,
    is_real_bill,
    money,
    or_zero,
    total,
)
from meterbook.operators.accounts import is_readable, request_date, validated_rows
from meterbook.operators.joins import join_keyed, newest

ACCOUNT = ["customer", "account"]

def billable_bills(bills: DataFrame) -> DataFrame:
    return bills.filter(is_real_bill())


def _current() -> Column:
    return newest(
        [
            "bill_date",
            F.coalesce("new_due_date", "due_date").alias("bill_due_date"),
            F.col("due_date").alias("plain_due_date"),
            F.col("current_amount").alias("bill_amount"),
            "account_type",
            "bill_type",
            "amount_due_before",
            "calc_ts",
            "bill_number",
        ],
        ["bill_date", "bill_number"],
    )


def _plan_bill(as_of) -> Column:
    return newest(
        [
            "is_reconcile",
            F.col("plan_bill").alias("billed"),
            F.col("plan_cred").alias("credit"),
            "bill_number",
        ],
        ["due_date", "bill_number"],
        F.col("due_date") >= day(as_of),
    )


def _past_due_date(as_of) -> Column:
    overdue = F.col("due_date") < day(as_of)
    return newest(["due_date"], ["bill_date", "bill_number"], overdue)["due_date"]


def bill_facts(bills: DataFrame, as_of) -> DataFrame:
    """Everything the account summary needs from the bills, in one pass.

    ``current`` newest bill by (bill date, bill number); ``plan_bill`` the bill with
    the latest due date not yet past; ``not_due`` the sum of bills not yet due;
    ``past_due_date`` the due date of the newest overdue bill.
    """
    return (
        billable_bills(bills)
        .groupBy(*ACCOUNT)
        .agg(
            _current().alias("current"),
            _plan_bill(as_of).alias("plan_bill"),
            total(F.col("current_amount"), F.col("due_date") >= day(as_of)).alias("not_due"),
            _past_due_date(as_of).alias("past_due_date"),
        )
    )


def current_bill(bills: DataFrame) -> DataFrame:
    """The newest real bill of each account; a new due date replaces the due date."""
    return billable_bills(bills).groupBy(*ACCOUNT).agg(_current().alias("b")).select(*ACCOUNT, "b.*")


def last_past_due_bill(bills: DataFrame, as_of) -> DataFrame:
    """The newest real bill, by bill date, whose due date is over."""
    return (
        billable_bills(bills)
        .filter(F.col("due_date") < day(as_of))
        .groupBy(*ACCOUNT)
        .agg(newest(["bill_number", "bill_date", "due_date"], ["bill_date", "bill_number"]).alias("b"))
        .select(*ACCOUNT, "b.*")
    )


def not_due_bills(bills: DataFrame, as_of) -> DataFrame:
    """Per account, what real bills not yet due amount to."""
    return (
        billable_bills(bills)
        .filter(F.col("due_date") >= day(as_of))
        .groupBy(*ACCOUNT)
        .agg(total(F.col("current_amount")).alias("not_due_amount"))
    )


def grace_days(grace: DataFrame) -> DataFrame:
    return grace.groupBy("account_type", "bill_type").agg(F.sum("days").cast("int").alias("grace_days"))


def bill_grace_days(bills: DataFrame, grace: DataFrame) -> DataFrame:
    """Current bills with the summed grace days of their account and bill type, else 0."""
    return (
        join_keyed(current_bill(bills), grace_days(grace), ["account_type", "bill_type"], "left")
        .select(
            *ACCOUNT,
            "bill_number",
            "account_type",
            "bill_type",
            F.coalesce("grace_days", F.lit(0)).alias("grace_days"),
        )
    )


def disconnect_on(due: Column, account_type: Column, days: Column, holidays: Column, business: bool) -> Column:
    """Due date plus grace days; no date without a due date or an account type."""
    days = F.coalesce(days, F.lit(0))
    after = business_days_add(due, days, holidays) if business else F.date_add(due, days)
    return F.coalesce(F.when(due.isNotNull() & (F.rtrim(account_type) != ""), after), empty_date())


def with_holidays(rows: DataFrame, holidays: DataFrame | None) -> DataFrame:
    """Add the holiday calendar as one array; it lists days, so its size is bounded by the calendar."""
    if holidays is None:
        return rows.withColumn("holidays", F.array().cast("array<date>"))
    return rows.withColumn("holidays", holidays.agg(F.array_sort(F.collect_set("holiday"))).scalar())


def disconnect_date(
    bills: DataFrame, grace: DataFrame, business_days: bool = False, holidays: DataFrame | None = None
) -> DataFrame:
    """When service may be cut for the current bill of each account."""
    bill = join_keyed(
        current_bill(bills), grace_days(grace), ["account_type", "bill_type"], "left"
    )
    on = disconnect_on(
        F.col("bill_due_date"), F.col("account_type"), F.col("grace_days"), F.col("holidays"), business_days
    )
    return with_holidays(bill, holidays).select(*ACCOUNT, "bill_due_date", on.alias("disconnect_date"))


def group_not_due(bills: DataFrame, as_of) -> DataFrame:
    """Per bill group, what the non-master accounts' bills not yet due amount to."""
    return (
        bills.filter(
            ~F.col("is_master")
            & F.col("processed")
            & (F.col("bill_type") != "CB")
            & (F.col("due_date") >= day(as_of))
        )
        .groupBy("bill_group")
        .agg(total(F.col("current_amount")).alias("group_not_due"))
    )


def master_not_due(accounts: DataFrame, bill_groups: DataFrame, bills: DataFrame, as_of) -> DataFrame:
    """Master accounts of groups that update their master, with the group's amount not yet due.

    ``accounts`` are all account rows. A pair with several such masters takes the one with the greatest account
    status (then the greatest group): the original keeps the last row of that order.
    """
    updating = bill_groups.filter("updates_master").select("bill_group").distinct()
    masters = (
        join_keyed(accounts.filter("is_master"), updating, ["bill_group"], "left_semi")
        .groupBy(*ACCOUNT)
        .agg(F.max_by("bill_group", F.struct("account_status", "bill_group")).alias("bill_group"))
    )
    return join_keyed(masters, group_not_due(bills, as_of), ["bill_group"], "left").select(
        *ACCOUNT, "bill_group", or_zero(F.col("group_not_due")).alias("master_not_due")
    )


def _history(bills: DataFrame) -> DataFrame:
    owing = F.when(F.col("plan_type").startswith("L"), F.col("balance_forward")).otherwise(
        F.col("balance_forward")
        + F.col("cancelled_billing")
        + F.col("since_last_bill")
        + F.col("previous_billing")
    )
    return (
        billable_bills(bills)
        .select(
            *ACCOUNT,
            F.lit(1).alias("responsecode"),
            F.col("customer").alias("customernumber"),
            F.col("account").alias("accountnumber"),
            F.col("bill_number").alias("billnumber"),
            F.col("due_date").alias("duedate"),
            F.col("bill_date").alias("billdate"),
            F.col("current_amount").alias("billamount"),
            money(owing).alias("owing"),
        )
    )


def billing_history(bills: DataFrame, first: str, last: str) -> DataFrame:
    """Real bills of a closed date range with the amount owing at each."""
    return _history(bills).filter(F.col("billdate").between(day(first), day(last))).drop(*ACCOUNT)


def billing_history_lookup(requests: DataFrame, accounts: DataFrame, bills: DataFrame) -> DataFrame:
    """The billing history that each request asks for by customer, account and two date texts.

    A text that is no date, or an unknown pair, is answered with response code 0 and defaults.
    """
    first, last = F.col("first_text"), F.col("last_text")
    return validated_rows(
        requests,
        accounts,
        _history(bills),
        "billdate",
        readable=is_readable(first) & is_readable(last),
        within=F.col("billdate").between(request_date(first), request_date(last)),
    )
