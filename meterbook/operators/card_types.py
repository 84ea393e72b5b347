"""Card types: seed rows, recoding, expansion into debit, savings and point-of-sale types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from meterbook.sources.seeds import CARD_TYPE_COLUMNS, CARD_TYPES
from meterbook.sources.tables import append_rows, inline_table

# Fixed values: (old text, new code), applied in this order.
RECODES = [
    ("Visa", "VISA"),
    ("MasterCard", "MC"),
    ("AmericanExpress", "AMEX"),
    ("Discover", "DISC"),
    ("eCheck", "CHQ"),
    ("PayPal", "PAYPAL"),
    ("WalmartPay", "WALMART_PAY"),
    ("Venmo", "VENMO"),
    ("GooglePay", "GP"),
    ("ApplePay", "AP"),
]

# Fixed values: (source code, added code).
EXPANSIONS = [
    ("VISA", "VISA_DEBIT"),
    ("MC", "MC_DEBIT"),
    ("DISC", "DISC_DEBIT"),
    ("CHQ", "SAV"),
    ("PAYPAL", "PAYPAL_CREDIT"),
    ("PAYPAL", "PAYPAL_ACCOUNT"),
]

# Codes that get a point-of-sale row, and the transaction code it is taken from.
POS_SOURCES = ["AMEX", "DISC", "DISC_DEBIT", "MC", "MC_DEBIT", "VISA", "VISA_DEBIT"]
POS_PREFIX = "CP_POS_"
POS_TRANSACTION = "DEP2"

# The codes listed by the final check.
CHECKED = [
    "VISA_DEBIT",
    "MC_DEBIT",
    "DISC_DEBIT",
    "SAV",
    "PAYPAL_CREDIT",
    "PAYPAL_ACCOUNT",
    "WALMART_PAY",
    "VENMO",
    "GP",
    "AP",
]


def seed_rows(card_types: DataFrame, rows: Iterable[Sequence] = CARD_TYPES) -> DataFrame:
    """Append the literal seed rows."""
    return append_rows(card_types, inline_table(card_types.sparkSession, CARD_TYPE_COLUMNS, rows))


def recode(
    df: DataFrame, column: str, pairs: Sequence[tuple[str, str]] = RECODES, ignore_case: bool = False
) -> DataFrame:
    """Replace texts by codes, one pair after the other (a later pair sees earlier results)."""

    def same(text: str) -> str:
        return text.upper() if ignore_case else text

    value = F.upper(F.col(column)) if ignore_case else F.col(column)
    result = F.when(F.lit(False), F.col(column))
    for start, (old, _) in enumerate(pairs):
        # what this text ends up as once the remaining pairs have been applied to it
        code = old
        for text, new in pairs[start:]:
            code = new if same(code) == same(text) else code
        result = result.when(value == same(old), F.lit(code))
    return df.withColumn(column, result.otherwise(F.col(column)))


def expand(card_types: DataFrame, pairs: Sequence[tuple[str, str]] = EXPANSIONS) -> DataFrame:
    """New rows: the distinct rows of each source code under the added code, in one pass.

    Every added code belongs to one source code, so one ``distinct`` serves all pairs.
    """
    added: dict[str, list[str]] = {}
    for source, code in pairs:
        added.setdefault(source, []).append(code)
    codes = F.create_map(
        *[item for source, new in added.items() for item in (F.lit(source), F.array(*map(F.lit, new)))]
    )
    return (
        card_types.filter(F.col("card_type").isin(list(added)))
        .distinct()
        .withColumn("card_type", F.explode(codes[F.col("card_type")]))
    )


def pos_rows(card_types: DataFrame) -> DataFrame:
    """One point-of-sale row per source code: its least row with the deposit code."""
    others = [c for c in card_types.columns if c != "card_type"]
    return (
        card_types.filter(
            F.col("card_type").isin(POS_SOURCES) & (F.col("transaction_code") == POS_TRANSACTION)
        )
        .groupBy("card_type")
        .agg(F.min(F.struct(*others)).alias("r"))
        .select(F.concat(F.lit(POS_PREFIX), "card_type").alias("card_type"), "r.*")
        .select(card_types.columns)
    )


def card_type_pipeline(card_types: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Recode, expand, then add point-of-sale rows, which also read the expanded rows."""
    coded = recode(card_types, "card_type", RECODES, ignore_case)
    expanded = coded.unionByName(expand(coded))
    return expanded.unionByName(pos_rows(expanded))


def checked_types(card_types: DataFrame) -> DataFrame:
    return card_types.filter(F.col("card_type").isin(CHECKED))


def unmatched_types(card_types: DataFrame, pairs: Sequence[tuple[str, str]] = RECODES) -> DataFrame:
    """Texts that no recoding names, with their row counts."""
    named = [text for pair in pairs for text in pair]
    return (
        card_types.filter(~F.col("card_type").isin(named))
        .groupBy("card_type")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
