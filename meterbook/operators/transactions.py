"""System transactions that cancelled-bill records lack."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterbook.functions.rules import day, money
from meterbook.operators.joins import join_keyed


def missing_system_txns(
    bills: DataFrame, lines: DataFrame, code: str, cutoff: str, inclusive: bool = False
) -> DataFrame:
    """Lines to add for processed 'CB' bills after a date that have no line of ``code``.

    The amount is the original bill's amount due before the due date, NULL when that
    bill is not found.
    """
    after = F.col("bill_date") >= day(cutoff) if inclusive else F.col("bill_date") > day(cutoff)
    cancelled = bills.filter((F.col("bill_type") == "CB") & F.col("processed") & after).select(
        "bill_number", "batch_id", "account", "bill_date", "user_id", "orig_bill"
    )
    present = lines.filter(F.col("trans_code") == code).select("bill_number").distinct()
    lacking = join_keyed(cancelled, present, ["bill_number"], "left_anti")
    originals = bills.select(F.col("bill_number").alias("orig_bill"), "amount_due_before")
    rows = join_keyed(lacking, originals, ["orig_bill"], "left")

    # What a system line carries.
    constants = {
        "in_balance": True,
        "sum_flag": 0,
        "is_penalty": False,
        "is_hidden": False,
        "ar_code": "",
        "supplier": "",
        "is_system_hidden": False,
        "service": "",
        "in_cancel_section": False,
        "wap": 0,
        "orig_tran": 2,
        "sort_no": 2,
        "is_taxed": True,
        "loan_num": 0,
        "orig_bill": 0,
    }
    return rows.select(
        "bill_number",
        "batch_id",
        "account",
        F.col("bill_date").alias("trans_date"),
        F.lit(code).alias("trans_code"),
        F.col("amount_due_before").alias("amount"),
        F.lit(-1).alias("trans_num"),
        "user_id",
        *[F.lit(value).alias(name) for name, value in constants.items()],
    )


def staged_amount_stats(staged: DataFrame) -> DataFrame:
    """Count, average, least and greatest amount of staged rows."""
    return staged.agg(
        F.count(F.lit(1)).alias("total_records"),
        money(F.avg("amount")).alias("average_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def sample_top_rows(staged: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest staged rows, for review."""
    return (
        staged.orderBy(F.desc("trans_date"), F.desc("bill_number"))
        .limit(n)
        .select("bill_number", "account", "trans_date", "amount")
    )


def reconcile_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows expected and rows found, and whether they agree, in one row."""
    found = actual.agg(F.count(F.lit(1))).scalar()
    return (
        expected.agg(F.count(F.lit(1)).alias("expected_rows"))
        .withColumn("actual_rows", found)
        .withColumn("ok", F.col("expected_rows") == F.col("actual_rows"))
    )


def reconcile_above(staged: DataFrame, table: DataFrame, on: str, pk: str, mark, inserted: DataFrame | None = None) -> DataFrame:
    """Do the rows that an append put above the old highest key join back to the staged rows one to one?

    ``mark`` is the highest key before the append. A staged key that stands twice, or a row that came twice, joins back
    more often than rows were inserted, and ``ok`` is false. Both sides are counted per key, so matches are never listed.
    """
    above = table.filter(F.col(pk) > mark)
    wanted = staged.groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    found = above.groupBy(on).agg(F.count(F.lit(1)).alias("m"))
    verified = wanted.join(found, on).agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).cast("bigint").alias("v")).scalar()
    expected = staged.agg(F.count(F.lit(1))).scalar()
    counted = (above if inserted is None else inserted).agg(F.count(F.lit(1)).alias("inserted_rows"))
    return counted.select(
        expected.alias("staged_rows"), "inserted_rows", verified.alias("verified_rows"),
        ((F.col("inserted_rows") == verified) & (expected == F.col("inserted_rows"))).alias("ok"),
    )
