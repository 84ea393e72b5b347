"""Receivable transactions: amount due, unbilled, returned payments, not-due lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import day, listed, money, or_empty_date, total
from meterbook.operators.bills import current_bill
from meterbook.operators.joins import exclude_listed, join_keyed, scalar_lookup

ACCOUNT = ["customer", "account"]


def before_due_payments(ar_txns: DataFrame, lines: DataFrame, trans_codes: DataFrame, state: DataFrame) -> DataFrame:
    """Payments made since the current bill was calculated, and returned payments.

    ``state`` has one row per account with ``calc_ts``.
    """
    since = F.col("trans_date") >= F.col("calc_ts")
    state = state.select(*ACCOUNT, "calc_ts")
    fields = [*ACCOUNT, "trans_num", "trans_code", "amount", "trans_date"]

    # both kinds are narrowed by what their own row tells before any row is moved
    paid = ar_txns.filter((F.col("amount") < 0) & (F.col("bill_number") == 0)).select(fields)
    adjustments = trans_codes.filter(F.col("transaction_type") == "AD")
    paid = exclude_listed(paid, "trans_code", adjustments, "trans_code")
    paid = join_keyed(paid, state, ACCOUNT, "inner").filter(since).drop("calc_ts")
    paid = exclude_listed(paid, "trans_num", lines, "trans_num", per=["account"])

    aged = trans_codes.filter("use_original_age").select("trans_code").distinct()
    returned = ar_txns.filter((F.col("amount") > 0) & ~F.col("is_statement")).select(fields)
    returned = join_keyed(returned, aged, ["trans_code"], "left_semi")
    returned = join_keyed(returned, state, ACCOUNT, "inner").filter(since).drop("calc_ts")
    columns = [*ACCOUNT, "amount"]
    return (
        paid.select(columns)
        .unionByName(returned.select(columns))
        .groupBy(*ACCOUNT)
        .agg(total(F.col("amount")).alias("paid_before_due"))
    )


def due_before_due_date(amount: Column, paid: Column, has_bill: Column, pending: Column) -> Column:
    """The bill's amount plus payments, not below 0, plus pending payments."""
    left = amount + F.coalesce(paid, F.lit(0))
    floored = F.when(left < 0, F.lit(0)).otherwise(left)
    return money(F.when(has_bill, floored).otherwise(F.lit(0)) + F.coalesce(pending, F.lit(0)))


def amount_due_before_due_date(
    accounts: DataFrame,
    bills: DataFrame,
    ar_txns: DataFrame,
    lines: DataFrame,
    trans_codes: DataFrame,
    pending: DataFrame,
) -> DataFrame:
    """What is still to pay on the current bill, per account."""
    bill = current_bill(bills).select(*ACCOUNT, "bill_number", "amount_due_before", "calc_ts")
    paid = before_due_payments(ar_txns, lines, trans_codes, bill)
    frame = (
        accounts.select(*ACCOUNT)
        .distinct()
        .join(bill, ACCOUNT, "left")
        .join(paid, ACCOUNT, "left")
        .join(pending, ACCOUNT, "left")
    )
    due = due_before_due_date(
        F.col("amount_due_before"),
        F.col("paid_before_due"),
        F.col("bill_number").isNotNull(),
        F.col("pending_payment"),
    )
    return frame.select(*ACCOUNT, due.alias("amount_due_before_due_date"))


def is_open_charge(as_of) -> Column:
    """Positive, unstatemented and unaged, of the last twelve months."""
    return (
        (F.col("trans_date") > F.add_months(day(as_of), -12))
        & ~F.col("is_statement")
        & (F.col("amount") > 0)
        & F.col("aging_date").isNull()
    )


def open_charges(ar_txns: DataFrame, as_of) -> DataFrame:
    """The open charges (see :func:`is_open_charge`)."""
    return ar_txns.filter(is_open_charge(as_of)).select(*ACCOUNT, "trans_num", "bill_number", "linked_trans_num", "trans_code", "amount")


def unbilled_amount(
    ar_txns: DataFrame,
    lines: DataFrame,
    payments: DataFrame,
    bills: DataFrame,
    trans_codes: DataFrame,
    exclusions: DataFrame,
    as_of,
    notice_codes: bool,
    exact_tokens: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Charges not billed yet, per account.

    A charge is open when it is on no bill and either unlinked or on no bill line, or
    when its bill is the one its payment names and that bill is past due.
    ``exclusions`` holds the code list of each account; a NULL list excludes everything.
    With ``unique`` a payment or bill number that occurs twice among those looked up stops the job, as it does in
    the source; otherwise any of its rows may match.
    """
    charges = open_charges(ar_txns, as_of)
    if notice_codes:
        outside = trans_codes.filter(~F.col("include_in_owing")).select("trans_code").distinct()
        charges = join_keyed(charges, outside, ["trans_code"], "left_semi")
    charges = join_keyed(
        charges, exclusions.select(*ACCOUNT, "exclude_codes"), ACCOUNT, "inner"
    ).filter(~listed(F.col("trans_code"), F.col("exclude_codes"), exact_tokens)).drop("exclude_codes")

    unlinked = charges.filter((F.col("bill_number") == 0) & (F.col("linked_trans_num") == 0))
    linked = charges.filter(
        (F.col("bill_number") == 0) & F.coalesce(F.col("linked_trans_num") != 0, F.lit(True))
    )
    on_lines = lines.select("trans_num").distinct()
    unlisted = join_keyed(linked, on_lines, ["trans_num"], "left_anti")

    # a bill that does not exist counts as due on the day itself, so never as past due
    billed = charges.filter(F.col("bill_number") != 0)
    if unique:
        billed = scalar_lookup(billed, payments, ["trans_num"], "paid_bill", "paid_bill")
        billed = scalar_lookup(billed.filter("paid_bill = bill_number"), bills, ["bill_number"], "due_date", "due_date")
        billed = billed.filter(F.col("due_date") < day(as_of))
    else:
        paid_for = payments.filter(F.col("paid_bill") != 0).select("trans_num", F.col("paid_bill").alias("bill_number"))
        due = bills.filter(F.col("due_date") < day(as_of)).select("bill_number").distinct()
        billed = join_keyed(billed, paid_for.distinct(), ["trans_num", "bill_number"], "left_semi")
        billed = join_keyed(billed, due, ["bill_number"], "left_semi")
    columns = [*ACCOUNT, "amount"]
    return (
        unlinked.select(columns)
        .unionByName(unlisted.select(columns))
        .unionByName(billed.select(columns))
        .groupBy(*ACCOUNT)
        .agg(total(F.col("amount")).alias("unbilled_amount"))
    )


def nsf_amount(ar_txns: DataFrame, trans_codes: DataFrame, last_bills: DataFrame, as_of) -> DataFrame:
    """Unaged returned-payment charges after the last bill (after ``as_of`` without one).

    ``last_bills`` has one row per billed account with ``bill_date``.
    """
    returned = trans_codes.filter("is_nsf").select("trans_code").distinct()
    rows = ar_txns.filter((F.col("amount") > 0) & F.col("aging_date").isNull()).select(
        *ACCOUNT, "trans_num", "trans_code", "amount", "trans_date"
    )
    rows = join_keyed(rows, returned, ["trans_code"], "left_semi")
    return (
        join_keyed(rows, last_bills.select(*ACCOUNT, "bill_date"), ACCOUNT, "left")
        .filter(F.col("trans_date") > F.coalesce("bill_date", day(as_of)))
        .groupBy(*ACCOUNT)
        .agg(total(F.col("amount")).alias("nsf_amount"))
    )


def not_due_lines(
    accounts: DataFrame,
    lines: DataFrame,
    bills: DataFrame,
    trans_codes: DataFrame,
    ar_codes: DataFrame,
    ar_txns: DataFrame,
    balance_list: Column,
    as_of,
    exact_tokens: bool = False,
) -> DataFrame:
    """Per account, the lines of processed bills that are not due yet.

    Lines count when outside the balance, or inside it as a positive non-cash
    entry; deposit receivable codes, the account's aged returned-payment codes and
    the balance codes are left out. Lines carry the account only.
    """
    due = bills.filter((F.col("due_date") >= day(as_of)) & F.col("processed")).select("bill_number").distinct()
    rows = lines.filter((F.col("orig_bill") == 0) & (F.col("trans_num") > 0) & (F.col("sum_flag") != 5)).select(
        "account", "bill_number", "trans_num", "trans_code", "amount", "in_balance", "ar_code"
    )
    rows = join_keyed(rows, due, ["bill_number"], "left_semi")
    types = trans_codes.groupBy("trans_code").agg(F.max("transaction_type").alias("transaction_type"))
    rows = join_keyed(rows, types, ["trans_code"], "inner").filter(
        ~F.col("in_balance") | ((F.col("transaction_type") != "CA") & (F.col("amount") > 0))
    )
    rows = rows.filter(~listed(F.col("trans_code"), balance_list, exact_tokens))
    deposits = ar_codes.filter(F.col("deposit_paid") | F.col("deposit_interest"))
    rows = exclude_listed(rows, "ar_code", deposits, "ar_code")

    sums = (
        rows.groupBy("account", "trans_code").agg(total(F.col("amount")).alias("amount"))
    )
    nsf = trans_codes.filter("is_nsf").select("trans_code").distinct()
    aged = (
        join_keyed(
            ar_txns.filter(F.col("aging_date").isNotNull()).select(*ACCOUNT, "trans_code", "trans_num"),
            nsf,
            ["trans_code"],
            "left_semi",
        )
        .select(*ACCOUNT, "trans_code")
        .distinct()
    )
    pairs = accounts.select(*ACCOUNT).distinct()
    return (
        pairs.join(sums, "account")
        .join(aged, [*ACCOUNT, "trans_code"], "left_anti")
        .groupBy(*ACCOUNT)
        .agg(total(F.col("amount")).alias("not_due_amount"))
    )


def plan_adjustments(lines: DataFrame, state: DataFrame, exact_tokens: bool = False) -> DataFrame:
    """Positive balance lines of an account's plan bill whose codes are not excluded.

    ``state`` has one row per account with ``plan_bill_number`` and ``exclude_codes``.
    """
    counted = lines.filter(
        F.col("in_balance")
        & (F.col("sum_flag") == 0)
        & (F.col("amount") > 0)
        & (F.col("trans_num") > 0)
        & (F.col("orig_bill") == 0)
    )
    by_code = (
        counted.groupBy("account", F.col("bill_number").alias("plan_bill_number"), "trans_code")
        .agg(total(F.col("amount")).alias("amount"))
    )
    return (
        join_keyed(
            by_code,
            state.select(*ACCOUNT, "plan_bill_number", "exclude_codes"),
            ["account", "plan_bill_number"],
            "inner",
        )
        .filter(~listed(F.col("trans_code"), F.col("exclude_codes"), exact_tokens))
        .groupBy(*ACCOUNT)
        .agg(total(F.col("amount")).alias("plan_adjustments"))
    )


def bill_adjustments_v1(lines: DataFrame, trans_codes: DataFrame, last_bills: DataFrame) -> DataFrame:
    """The older form: positive balance lines of the current bill with codes outside the balance owing."""
    counted = lines.filter(
        F.col("in_balance") & (F.col("sum_flag") == 0) & (F.col("trans_num") > 0) & (F.col("amount") > 0)
    )
    owing = trans_codes.filter("include_in_owing")
    counted = exclude_listed(counted, "trans_code", owing, "trans_code")
    sums = counted.groupBy("bill_number").agg(total(F.col("amount")).alias("bill_adjustments"))
    return (
        last_bills.select(*ACCOUNT, "bill_number")
        .join(sums, "bill_number", "inner")
        .select(*ACCOUNT, "bill_adjustments")
    )


def later_charges_v1(ar_txns: DataFrame, lines: DataFrame, trans_codes: DataFrame, last_bills: DataFrame) -> DataFrame:
    """The older form: unstatemented charges after the last bill that are on no line of their bill."""
    owing = trans_codes.filter("include_in_owing")
    rows = ar_txns.filter((F.col("amount") > 0) & ~F.col("is_statement")).select(
        *ACCOUNT, "trans_num", "bill_number", "trans_code", "amount", "trans_date"
    )
    rows = exclude_listed(rows, "trans_code", owing, "trans_code")
    rows = join_keyed(rows, last_bills.select(*ACCOUNT, "bill_date"), ACCOUNT, "left").filter(
        F.col("trans_date") > or_empty_date(F.col("bill_date"))
    )
    no_bill = rows.filter(F.coalesce("bill_number", F.lit(0)) <= 0)
    on_lines = lines.select("bill_number", "trans_num").distinct()
    unlisted = join_keyed(
        rows.filter(F.col("bill_number") > 0), on_lines, ["bill_number", "trans_num"], "left_anti"
    )
    columns = [*ACCOUNT, "amount"]
    return (
        no_bill.select(columns)
        .unionByName(unlisted.select(columns))
        .groupBy(*ACCOUNT)
        .agg(total(F.col("amount")).alias("later_charges"))
    )
