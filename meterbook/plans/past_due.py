"""What every account owes past its due date: the current rules and the older ones.

``tables`` is any object with the tables as attributes (``SourceTables`` for the
billing system's own tables).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import day, empty_date, money, or_empty_date, or_zero
from meterbook.operators.accounts import current_accounts
from meterbook.operators.bills import bill_facts, current_bill, last_past_due_bill, master_not_due
from meterbook.operators import ledger as led
from meterbook.operators.codes import balance_codes, excluded_codes, notice_codes_on
from meterbook.operators.enrolments import (
    ar_balance,
    balance_rule,
    plan_balance,
    plan_status,
    plan_status_v1,
)
from meterbook.operators.joins import join_keyed
from meterbook.operators.payments import pending_payments
from meterbook.operators.receivables import bill_adjustments_v1, later_charges_v1, plan_adjustments
from meterbook.session import materialize

ACCOUNT = ["customer", "account"]


def account_state(tables, as_of, plan_billed: bool = False) -> DataFrame:
    """One row per account: newest account row, plan, balances, bill facts, code lists.

    Written once, because the receivable and line jobs below all join to it; each of
    the big tables behind it is read a single time. With ``plan_billed`` only accounts on plan billing are
    looked at, and of the big tables only their rows move.
    """
    plans = plan_status(tables.plan_enrolments, tables.plan_types, as_of)
    wanted = plans.filter("use_plan_billed").select(*ACCOUNT)

    def own(rows: DataFrame) -> DataFrame:
        return join_keyed(rows, wanted, ACCOUNT, "left_semi") if plan_billed else rows

    facts = bill_facts(own(tables.bills), as_of).withColumnRenamed("not_due", "not_due_bills")
    pending = pending_payments(own(tables.payments), tables.trans_codes, own(tables.ext_pending))
    frame = (
        current_accounts(own(tables.accounts))
        .join(plans, ACCOUNT, "left")
        .join(plan_balance(own(tables.plan_balances)), ACCOUNT, "left")
        .join(ar_balance(own(tables.ar_balances), tables.ar_codes), ACCOUNT, "left")
        .join(facts, ACCOUNT, "left")
        .join(pending, ACCOUNT, "left")
    )
    _, full = excluded_codes(tables.ar_codes, plans)
    frame = balance_rule(frame).withColumn("exclude_codes", full)
    return materialize(
        frame.withColumn("pending_payment", or_zero(F.col("pending_payment")))
        .withColumn("bill_date", F.col("current.bill_date"))
        .withColumn("calc_ts", F.col("current.calc_ts"))
        .withColumn("plan_bill_number", F.col("plan_bill.bill_number"))
    )


def pending_counts(company_settings: DataFrame) -> Column:
    """Do pending payments reduce what is past due? Yes when no company row says otherwise."""
    setting = F.coalesce(F.max("pending_in_past_due"), F.lit(False))
    return company_settings.agg(F.when(F.count(F.lit(1)) == 0, F.lit(True)).otherwise(setting)).scalar()


def plan_past_due_rule(balance: Column) -> Column:
    """The plan bill not yet due, its credits and adjustments; the balance without such a bill."""
    bill = F.col("plan_bill")
    credit = F.when(bill["is_reconcile"], bill["credit"]).otherwise(F.lit(0))
    amount = bill["billed"] + credit + F.col("plan_credit") - F.coalesce("plan_adjustments", F.lit(0))
    return F.when(bill["is_reconcile"].isNotNull(), amount).otherwise(balance)


def plan_past_due(tables, as_of, exact_tokens: bool = False) -> DataFrame:
    """Accounts on plan billing, with the amount taken from the plan bill."""
    state = account_state(tables, as_of, plan_billed=True)
    adjustments = plan_adjustments(
        tables.bill_lines, state.filter("plan_bill_number is not null"), exact_tokens
    )
    return state.join(adjustments, ACCOUNT, "left").select(
        *ACCOUNT, money(plan_past_due_rule(F.col("current_balance"))).alias("plan_past_due")
    )


def past_due_frame(tables, as_of, notice_codes: bool | None = None, exact_tokens: bool = False) -> DataFrame:
    """The account state with ``past_due_amount`` and ``past_due_date``."""
    return past_due_and_state(tables, as_of, notice_codes, exact_tokens)[0]


def past_due_and_state(
    tables, as_of, notice_codes: bool | None = None, exact_tokens: bool = False
) -> tuple[DataFrame, DataFrame]:
    """:func:`past_due_frame` and the stored state below it, one row per account."""
    notice = notice_codes_on(tables.trans_codes) if notice_codes is None else notice_codes
    state = account_state(tables, as_of)
    master = master_not_due(
        tables.accounts.select(*ACCOUNT, "is_master", "bill_group", "account_status"),
        tables.bill_groups,
        tables.bills,
        as_of,
    ).select(*ACCOUNT, "master_not_due")

    ledger = led.read_ledger(tables, state, as_of, notice, exact_tokens)
    plan_rows = state.filter("use_plan_billed and plan_bill_number is not null")
    parts = [master, led.plan_adjustments(ledger, plan_rows, exact_tokens), led.transaction_sums(ledger)]
    if notice:
        parts.append(led.not_due_amount(ledger, state, balance_codes(tables.ar_codes), exact_tokens))
    frame = state
    for part in parts:
        frame = frame.join(part, ACCOUNT, "left")
    if not notice:
        frame = frame.withColumn("not_due_amount", F.col("not_due_bills"))

    balance = F.col("current_balance")
    not_due = F.abs(F.coalesce("not_due_amount", F.lit(0)))
    own = (
        F.when(F.col("use_plan_billed"), plan_past_due_rule(balance))
        .when(balance > 0, balance - not_due)
        .otherwise(balance)
    )
    pending = F.when(pending_counts(tables.company_settings), F.col("pending_payment")).otherwise(F.lit(0))
    own = own - F.coalesce("unbilled_amount", F.lit(0)) + pending - F.coalesce("nsf_amount", F.lit(0))
    of_master = balance - F.greatest(F.col("master_not_due"), F.lit(0))
    raw = F.when(F.col("master_not_due").isNotNull(), of_master).otherwise(own)
    below = F.coalesce(F.col("_raw") < 0, F.lit(False))
    frame = (
        frame.withColumn("_raw", raw)
        .withColumn("past_due_amount", money(F.when(below, F.lit(0)).otherwise(F.col("_raw"))))
        .withColumn("past_due_date", F.when(below, empty_date()).otherwise(or_empty_date(F.col("past_due_date"))))
        .drop("_raw")
    )
    return frame, state


def past_due(tables, as_of, notice_codes: bool | None = None, exact_tokens: bool = False) -> DataFrame:
    return past_due_frame(tables, as_of, notice_codes, exact_tokens).select(
        *ACCOUNT, "current_balance", "past_due_amount", "past_due_date"
    )


def state_v1(tables, as_of) -> DataFrame:
    """The older form's account state: its own plan and balance rules, plain due dates."""
    plans = plan_status_v1(tables.plan_enrolments, tables.plan_types, as_of)
    overdue = last_past_due_bill(tables.bills, F.date_add(day(as_of), 1)).select(
        *ACCOUNT, F.col("due_date").alias("overdue_date")
    )
    frame = (
        current_accounts(tables.accounts)
        .join(plans, ACCOUNT, "left")
        .join(plan_balance(tables.plan_balances), ACCOUNT, "left")
        .join(ar_balance(tables.ar_balances, tables.ar_codes), ACCOUNT, "left")
        .join(
            current_bill(tables.bills)
            .drop("bill_due_date", "calc_ts", "amount_due_before")
            .withColumnRenamed("account_type", "bill_account_type"),
            ACCOUNT,
            "left",
        )
        .join(overdue, ACCOUNT, "left")
    )
    balance = F.when(F.col("use_plan_balance"), F.col("plan_balance")).otherwise(F.col("ar_balance"))
    return materialize(frame.withColumn("current_balance", or_zero(balance)))


def past_due_frame_v1(tables, as_of) -> DataFrame:
    """The older form: current bill and adjustments off while not due, then later charges."""
    state = state_v1(tables, as_of)
    billed = state.filter("bill_number is not null")
    frame = state.join(
        bill_adjustments_v1(tables.bill_lines, tables.trans_codes, billed), ACCOUNT, "left"
    ).join(later_charges_v1(tables.ar_txns, tables.bill_lines, tables.trans_codes, state), ACCOUNT, "left")
    balance = F.col("current_balance")
    not_due = F.coalesce(day(as_of) <= F.col("plain_due_date"), F.lit(False))
    first = F.when(
        not_due, balance - F.col("bill_amount") - F.coalesce("bill_adjustments", F.lit(0))
    ).otherwise(balance)
    second = F.col("_first") - F.coalesce("later_charges", F.lit(0))
    owing = (F.col("_first") > 0) & (F.col("_second") > 0)
    return (
        frame.withColumn("_first", first)
        .withColumn("_second", second)
        .withColumn("past_due_amount", money(F.when(owing, F.col("_second")).otherwise(F.lit(0))))
        .withColumn(
            "due_date",
            or_empty_date(
                F.when(owing, F.coalesce("overdue_date", "plain_due_date")).otherwise(F.col("plain_due_date"))
            ),
        )
        .drop("_first", "_second")
    )


def past_due_v1(tables, as_of) -> DataFrame:
    return past_due_frame_v1(tables, as_of).select(*ACCOUNT, "current_balance", "past_due_amount", "due_date")
