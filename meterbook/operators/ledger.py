"""Features of receivable transactions and bill lines, each table flagged in one pass.

The transactions are read once: every row meets its code's properties and its account's state, gets the flags of all features,
and only rows with a flag are kept, narrow. The lines are read twice: once for the transactions that some
flagged row asks about, once for the sums by account, bill and code. All features of a table are then sums over
the few rows that were kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import day, listed, total
from meterbook.operators.joins import flag_unlisted, join_keyed
from meterbook.operators.receivables import is_open_charge
from meterbook.session import materialize

ACCOUNT = ["customer", "account"]


@dataclass
class Ledger:
    """Transactions with a feature, and the line sums by account, bill and code."""

    flagged: DataFrame
    lines: DataFrame
    notice: bool


def code_properties(trans_codes: DataFrame) -> DataFrame:
    """One row per transaction code with what the features ask of it."""
    return trans_codes.groupBy("trans_code").agg(
        F.max(F.coalesce("use_original_age", F.lit(False))).alias("original_age"),
        F.max(F.coalesce("is_nsf", F.lit(False))).alias("nsf_code"),
        F.max(~F.coalesce("include_in_owing", F.lit(True))).alias("outside_owing"),
        F.max("transaction_type").alias("transaction_type"),
    )


def _flag_transactions(ar_txns: DataFrame, trans_codes: DataFrame, state: DataFrame, as_of, notice: bool, exact_tokens: bool) -> DataFrame:
    fields = [*ACCOUNT, "trans_num", "trans_code", "amount", "trans_date", "bill_number", "linked_trans_num"]
    aged = F.col("aging_date").isNotNull()
    rows = ar_txns.select(
        *fields, aged.alias("aged"), F.col("is_statement").alias("statement"), is_open_charge(as_of).alias("open")
    )
    # what no feature can use goes before any row is moved
    rows = rows.filter("(amount < 0 and bill_number = 0) or amount > 0 or aged")
    rows = join_keyed(rows, code_properties(trans_codes).drop("transaction_type"), ["trans_code"])
    rows = flag_unlisted(rows, "trans_code", trans_codes.filter(F.col("transaction_type") == "AD"), "trans_code", "not_adjusting")
    known = state.select(*ACCOUNT, "calc_ts", "bill_date", "exclude_codes", F.lit(True).alias("in_state"))
    rows = join_keyed(rows, known, ACCOUNT)

    since = F.col("trans_date") >= F.col("calc_ts")
    positive = F.col("amount") > 0
    outside = ~listed(F.col("trans_code"), F.col("exclude_codes"), exact_tokens)
    charge = F.col("open") & F.col("in_state") & outside
    if notice:
        charge = charge & F.col("outside_owing")
    no_bill, unlinked = F.col("bill_number") == 0, F.col("linked_trans_num") == 0
    flags = {
        "paid": (F.col("amount") < 0) & no_bill & F.col("not_adjusting") & since,
        "returned": positive & ~F.col("statement") & F.col("original_age") & since,
        "unlinked": charge & no_bill & unlinked,
        "linked": charge & no_bill & F.coalesce(~unlinked, F.lit(True)),
        "billed": charge & (F.col("bill_number") != 0),
        "nsf": positive & ~F.col("aged") & F.col("nsf_code") & (F.col("trans_date") > F.coalesce("bill_date", day(as_of))),
        "aged_nsf": F.col("aged") & F.col("nsf_code"),
    }
    named = rows.select(*fields[:5], "bill_number", *[F.coalesce(f, F.lit(False)).alias(n) for n, f in flags.items()])
    return named.filter(" or ".join(flags))


def _line_hits(flagged: DataFrame, lines: DataFrame) -> DataFrame:
    """Account and number of the lines that a flagged row asks about.

    Those are lines of an asked-for transaction, lines without a number, and all lines of an account that has a payment
    without a number, because SQL's NOT IN looks at all of them.
    """
    asked = flagged.filter("paid or linked").select("trans_num").distinct().withColumn("asked", F.lit(True))
    blank = flagged.filter("paid and trans_num is null").select("account").distinct().withColumn("asked_all", F.lit(True))
    # only distinct pairs are kept, so they are made distinct first: a frequent number then brings one row per account
    pairs = lines.select("account", "trans_num").distinct()
    found = join_keyed(join_keyed(pairs, asked, ["trans_num"]), blank, ["account"])
    return found.filter("asked or asked_all or trans_num is null").select("account", "trans_num").distinct()


def _line_sums(lines: DataFrame, bills: DataFrame, trans_codes: DataFrame, ar_codes: DataFrame, as_of, notice: bool) -> DataFrame:
    """Per account, bill and code: positive balance lines, and lines of processed bills that are not due yet."""
    fields = ["account", "bill_number", "trans_code", "amount", "in_balance", "sum_flag", "ar_code"]
    rows = lines.filter((F.col("orig_bill") == 0) & (F.col("trans_num") > 0)).select(fields)
    adjusting = F.col("in_balance") & (F.col("sum_flag") == 0) & (F.col("amount") > 0)
    sums = [total(F.col("amount"), adjusting).alias("adjustments")]
    if notice:
        due = bills.filter((F.col("due_date") >= day(as_of)) & F.col("processed")).select("bill_number").distinct()
        rows = join_keyed(rows, due.withColumn("not_yet_due", F.lit(True)), ["bill_number"])
        rows = join_keyed(rows, code_properties(trans_codes).select("trans_code", "transaction_type", F.lit(True).alias("coded")), ["trans_code"])
        deposits = ar_codes.filter(F.col("deposit_paid") | F.col("deposit_interest"))
        rows = flag_unlisted(rows, "ar_code", deposits, "ar_code", "no_deposit")
        counted = ~F.col("in_balance") | ((F.col("transaction_type") != "CA") & (F.col("amount") > 0))
        not_due = F.col("not_yet_due") & F.col("coded") & (F.col("sum_flag") != 5) & F.col("no_deposit") & counted
        sums.append(total(F.col("amount"), not_due).alias("not_due"))
    out = rows.groupBy("account", "bill_number", "trans_code").agg(*sums)
    return out.filter("adjustments is not null" + (" or not_due is not null" if notice else ""))


def read_ledger(tables, state: DataFrame, as_of, notice: bool, exact_tokens: bool = False) -> Ledger:
    """One pass over the transactions and two over the lines; what is kept is stored."""
    flagged = materialize(_flag_transactions(tables.ar_txns, tables.trans_codes, state, as_of, notice, exact_tokens))
    hits = materialize(_line_hits(flagged, tables.bill_lines))
    lines = materialize(_line_sums(tables.bill_lines, tables.bills, tables.trans_codes, tables.ar_codes, as_of, notice))
    return Ledger(materialize(_resolved(flagged, hits, tables.payments, tables.bills, as_of)), lines, notice)


def _resolved(flagged: DataFrame, hits: DataFrame, payments: DataFrame, bills: DataFrame, as_of) -> DataFrame:
    """Flagged rows with the answers of lines, payments and bills in their flags; one row per transaction and code."""
    on_lines = hits.filter("trans_num is not null")
    anywhere = on_lines.select("trans_num").distinct().withColumn("on_a_line", F.lit(True))
    own = on_lines.withColumn("on_own_line", F.lit(True))
    # one line without a number makes every NOT IN of its account unknown
    by_account = hits.groupBy("account").agg(F.max(F.col("trans_num").isNull()).alias("unknown"))
    plain = flagged.filter("not (paid or linked or billed)")
    asked = join_keyed(flagged.filter("paid or linked"), anywhere, ["trans_num"])
    asked = join_keyed(asked, own, ["account", "trans_num"])
    asked = join_keyed(asked, by_account, ["account"])
    absent = F.col("on_own_line").isNull() & ~F.coalesce("unknown", F.lit(False))
    missing = F.when(F.col("trans_num").isNull(), F.col("unknown").isNull()).otherwise(absent)
    asked = asked.withColumn("paid", F.col("paid") & missing).withColumn("linked", F.col("linked") & F.col("on_a_line").isNull())
    paid_for = payments.filter(F.col("paid_bill") != 0).select("trans_num", F.col("paid_bill").alias("bill_number")).distinct()
    overdue = bills.filter(F.col("due_date") < day(as_of)).select("bill_number").distinct()
    billed = join_keyed(flagged.filter("billed"), paid_for.withColumn("paid_it", F.lit(True)), ["trans_num", "bill_number"])
    billed = join_keyed(billed, overdue.withColumn("overdue", F.lit(True)), ["bill_number"])
    billed = billed.withColumn("billed", F.col("paid_it").isNotNull() & F.col("overdue").isNotNull())
    names = plain.columns
    return plain.unionByName(asked.select(names)).unionByName(billed.select(names))


def transaction_sums(ledger: Ledger) -> DataFrame:
    """``paid_before_due``, ``unbilled_amount`` and ``nsf_amount`` of each account with any, in one sum."""
    amount = F.col("amount")
    return ledger.flagged.groupBy(*ACCOUNT).agg(
        total(amount, F.expr("paid or returned")).alias("paid_before_due"),
        total(amount, F.expr("unlinked or linked or billed")).alias("unbilled_amount"),
        total(amount, F.col("nsf")).alias("nsf_amount"),
    )


def plan_adjustments(ledger: Ledger, state: DataFrame, exact_tokens: bool = False) -> DataFrame:
    """Positive balance lines of an account's plan bill whose codes are not excluded."""
    sums = ledger.lines.filter("adjustments is not null").withColumnRenamed("bill_number", "plan_bill_number")
    known = state.select(*ACCOUNT, "plan_bill_number", "exclude_codes")
    found = join_keyed(sums, known, ["account", "plan_bill_number"], "inner")
    kept = found.filter(~listed(F.col("trans_code"), F.col("exclude_codes"), exact_tokens))
    return kept.groupBy(*ACCOUNT).agg(total(F.col("adjustments")).alias("plan_adjustments"))


def not_due_amount(ledger: Ledger, state: DataFrame, balance_list: Column, exact_tokens: bool = False) -> DataFrame:
    """Lines not due yet, without the balance codes and the account's aged returned-payment codes."""
    sums = ledger.lines.filter("not_due is not null").filter(~listed(F.col("trans_code"), balance_list, exact_tokens))
    sums = sums.groupBy("account", "trans_code").agg(total(F.col("not_due")).alias("not_due"))
    aged = ledger.flagged.filter("aged_nsf").select(*ACCOUNT, "trans_code").distinct()
    rows = state.select(*ACCOUNT).join(sums, "account").join(aged, [*ACCOUNT, "trans_code"], "left_anti")
    return rows.groupBy(*ACCOUNT).agg(total(F.col("not_due")).alias("not_due_amount"))
