"""Payments: history, pending sums, the last payment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterbook.functions.rules import total
from meterbook.operators.accounts import validated_rows
from meterbook.operators.joins import exclude_listed, flag_unlisted, join_keyed, top_per_key

ACCOUNT = ["customer", "account"]


def settled(payments: DataFrame) -> DataFrame:
    """Processed payments (negative amounts) that were not deleted."""
    return payments.filter((F.col("amount") < 0) & F.col("processed") & ~F.col("is_deleted"))


def payment_history(payments: DataFrame, trans_codes: DataFrame, n: int, prefix: str = "PA") -> DataFrame:
    """The newest ``n`` payments of each account, summed by parent transaction and date."""
    codes = trans_codes.filter(F.col("trans_code").startswith(prefix)).select("trans_code").distinct()
    sums = (
        join_keyed(settled(payments), codes, ["trans_code"], "left_semi")
        .groupBy(*ACCOUNT, "parent_tr", "pay_date")
        .agg((-total(F.col("amount"))).cast("decimal(15,2)").alias("payamount"))
    )
    picked = top_per_key(sums, ACCOUNT, [F.desc("pay_date"), F.asc("parent_tr")], n)
    return picked.select(*ACCOUNT, F.lit(1).alias("responsecode"), "payamount", F.col("pay_date").alias("paydate"))


def payment_history_lookup(
    requests: DataFrame, accounts: DataFrame, payments: DataFrame, trans_codes: DataFrame, n: int
) -> DataFrame:
    """The payment history of each requested pair; an unknown pair has response code 0 and defaults."""
    return validated_rows(requests, accounts, payment_history(payments, trans_codes, n), "paydate")


def payment_history_by_batch(payments: DataFrame, n: int) -> DataFrame:
    """The older form: signed sums by batch and date, any transaction code."""
    sums = (
        settled(payments)
        .groupBy(*ACCOUNT, "batch_id", "pay_date")
        .agg(total(F.col("amount")).alias("payamount"))
    )
    picked = top_per_key(sums, ACCOUNT, [F.desc("pay_date"), F.asc("batch_id")], n)
    return picked.select(*ACCOUNT, F.lit(1).alias("responsecode"), "payamount", F.col("pay_date").alias("paydate"))


def payments_excluding_codes(payments: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Settled payments whose code is not in a list (SQL ``NOT IN``)."""
    return exclude_listed(settled(payments), "trans_code", codes, column)


def _sum_parts(*parts: DataFrame) -> DataFrame:
    """Add up per-account sums; each part is already one row per account."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy(*ACCOUNT).agg(total(F.col("pending")).alias("pending_payment"))


def _external(ext_pending: DataFrame) -> DataFrame:
    return (
        ext_pending.filter(~F.col("processed")).groupBy(*ACCOUNT).agg(total(F.col("amount")).alias("pending"))
    )


def pending_payments(payments: DataFrame, trans_codes: DataFrame, ext_pending: DataFrame) -> DataFrame:
    """Unprocessed cash payments, receipted or not, and unprocessed external ones."""
    cash = trans_codes.filter(F.col("transaction_type") == "CA").select("trans_code").distinct()
    counted = (F.col("receipt") != 0) | ((F.col("receipt") == 0) & (F.col("parent_tr") == 0))
    waiting = payments.filter(
        (F.col("amount") < 0) & ~F.col("processed") & ~F.col("is_deleted") & counted
    )
    own = (
        join_keyed(waiting, cash, ["trans_code"], "left_semi")
        .groupBy(*ACCOUNT)
        .agg(total(F.col("amount")).alias("pending"))
    )
    return _sum_parts(own, _external(ext_pending))


def pending_payments_v1(payments: DataFrame, ext_pending: DataFrame) -> DataFrame:
    """The older form: top-level unprocessed payments of any code, and external ones."""
    own = (
        payments.filter(
            (F.col("amount") < 0) & ~F.col("processed") & ~F.col("is_deleted") & (F.col("parent_tr") == 0)
        )
        .groupBy(*ACCOUNT)
        .agg(total(F.col("amount")).alias("pending"))
    )
    return _sum_parts(own, _external(ext_pending))


def last_payment(
    payments: DataFrame, batches: DataFrame, deposit_codes: DataFrame | None = None
) -> DataFrame:
    """The newest payment of each account, with the rows of the same batch before it.

    Payments are taken newest first (date, then transaction number) while the batch
    stays that of the first; with batch -1 the amount is all settled payments of that
    date. Done without a per-account sort: the newest position of each batch gives
    the first batch and the position where the run stops, and one more pass sums.
    """
    cash = (
        batches.filter(F.col("transaction_type") == "CA").select("batch_id").distinct().withColumn("_cash", F.lit(True))
    )
    paid = join_keyed(
        settled(payments).select(
            *ACCOUNT, "trans_num", "batch_id", "trans_code", "ar_code", "pay_date", "amount"
        ),
        cash,
        ["batch_id"],
        "left",
    )
    listed = F.col("_cash").isNotNull() & (F.rtrim("ar_code") != "")
    if deposit_codes is not None:
        paid = flag_unlisted(paid, "trans_code", deposit_codes, "deposit_code", "_no_deposit")
        listed = listed & F.col("_no_deposit")
    paid = paid.select(
        *ACCOUNT, "trans_num", "batch_id", "pay_date", "amount", F.coalesce(listed, F.lit(False)).alias("listed")
    )

    position = F.struct("pay_date", "trans_num")
    by_batch = paid.filter("listed").groupBy(*ACCOUNT, "batch_id").agg(F.max(position).alias("pos"))
    first_two = top_per_key(by_batch, ACCOUNT, [F.desc("pos")], 2)
    run = first_two.groupBy(*ACCOUNT).agg(
        F.max_by("batch_id", "pos").alias("first_batch"),
        F.max("pos").alias("first_pos"),
        F.when(F.count(F.lit(1)) == 2, F.min("pos")).alias("stop_pos"),
    )

    whole_day = (F.col("first_batch") == -1) & (F.col("pay_date") == F.col("first_pos.pay_date"))
    in_run = (
        F.col("listed")
        & (F.col("first_batch") != -1)
        & (F.col("batch_id") == F.col("first_batch"))
        & (F.col("stop_pos").isNull() | (position > F.col("stop_pos")))
    )
    # the first payment itself always qualifies, so every account with a run has a sum
    return (
        join_keyed(paid, run, ACCOUNT, "inner")
        .filter(whole_day | in_run)
        .groupBy(*ACCOUNT)
        .agg(
            total(F.col("amount")).alias("payment_amount"),
            F.max("first_pos.pay_date").alias("payment_date"),
        )
    )
