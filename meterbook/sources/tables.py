"""Reading tables, by readable names or by the billing system's own names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterbook.sources.schemas import SOURCE_TABLES, TYPE_BY_PREFIX


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder, or a catalog table when ``folder`` is ``catalog:<schema>``."""
    if folder.startswith("catalog:"):
        return spark.table(f"{folder.removeprefix('catalog:')}.{name}")
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Columns that hold codes, which the source compares without trailing blanks and without case.
# Not among them: card types, which the recoding tells apart by case, and free text.
CODE_COLUMNS = frozenset(
    {
        "account_status", "account_type", "add_type", "ar_code", "bill_group", "bill_type", "code", "col_status",
        "comment_code", "comment_type", "company", "credit_code", "debit_code", "deposit_code", "disconnect_status",
        "division", "num_suffix", "pending_status", "phone_type", "plan_class", "plan_type", "service", "service_group",
        "street_prefix", "trans_code", "transaction_type",
    }
)


def canonical_codes(df: DataFrame, ignore_case: bool = True) -> DataFrame:
    """Codes in the one form that equals all that the source holds equal: no trailing blanks, upper case.

    Joins, groupings, lists and filters on these columns then compare as the source does, in every operator and
    at no cost but a projection. NULL stays NULL.
    """

    def plain(name: str) -> Column:
        text = F.rtrim(F.col(f"`{name}`"))
        return (F.upper(text) if ignore_case else text).alias(name)

    texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(*[plain(c) if c in CODE_COLUMNS and c in texts else F.col(f"`{c}`") for c in df.columns])


def typed(name: str) -> Column:
    """A source column cast by its prefix (``C_`` text, ``D_`` date, ``Y_`` money, …)."""
    return F.col(name).cast(TYPE_BY_PREFIX[name.split("_", 1)[0]])


def from_source(df: DataFrame, table: str) -> DataFrame:
    """Rename and cast a billing-system table (``BIF951`` …) to the names the operators use.

    Columns the operators do not know are kept as they are, so that copies of rows
    lose nothing.
    """
    known = SOURCE_TABLES[table]
    present = {c.upper(): c for c in df.columns}
    missing = [c for c in known if c not in present]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
    renamed = [typed(source).alias(name) for source, name in known.items()]
    others = [F.col(c) for upper, c in present.items() if upper not in known]
    return df.select(*renamed, *others)


def to_source(df: DataFrame, table: str) -> DataFrame:
    """The reverse of :func:`from_source`, for writing rows back."""
    names = {name: source for source, name in SOURCE_TABLES[table].items()}
    return df.select([F.col(c).alias(names.get(c, c)) for c in df.columns])


def inline_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """A small literal table; Spark knows its size, as it does for a file."""
    rows = list(rows)
    return spark.createDataFrame(pa.table({c: [r[i] for r in rows] for i, c in enumerate(columns)}))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, the same columns."""
    return df.sparkSession.createDataFrame([], df.schema)


def append_rows(base: DataFrame, new: DataFrame) -> DataFrame:
    """Append by column name; columns the new rows do not fill become NULL."""
    types = {f.name: f.dataType for f in base.schema.fields}
    unknown = [c for c in new.columns if c not in types]
    if unknown:
        raise ValueError(f"the table has no column {', '.join(unknown)}")
    filled = [
        (F.col(c) if c in new.columns else F.lit(None)).cast(types[c]).alias(c) for c in base.columns
    ]
    return base.unionByName(new.select(filled))


class SourceTables:
    """The billing system's tables by the attribute names the plans read.

    Each table comes from ``load`` under its source name, is renamed and cast, and has its codes in one form
    (see :func:`canonical_codes`; ``ignore_case=False`` for a source whose collation tells cases apart).
    """

    # Attribute -> source table.
    NAMES = {
        "company_settings": "BIF000",
        "customers": "BIF001",
        "service_addresses": "BIF002",
        "accounts": "BIF003",
        "services": "BIF004",
        "addresses": "BIF006",
        "arrangements": "BIF007",
        "contacts": "BIF010",
        "comments": "BIF017",
        "service_orders": "BIF023",
        "ar_balances": "BIF040",
        "ar_txns": "BIF041",
        "bill_groups": "BIF071",
        "multipliers": "BIF205",
        "batches": "BIF503",
        "bills": "BIF951",
        "bill_lines": "BIF955",
        "payments": "BIF956",
        "ext_pending": "UTL045",
        "plan_enrolments": "PAP001",
        "plan_types": "PAP002",
        "plan_balances": "PAP003",
        "trans_codes": "GLE001",
        "grace_days": "CON008",
        "phone_types": "CON014",
        "comment_codes": "CON081",
        "payment_types": "CON082",
        "ar_codes": "CON091",
        "deposit_codes": "CON103",
        "street_prefixes": "CON137",
        "num_suffixes": "CON151",
        "collection_settings": "COL109",
        "web_signups": "WEB003",
        "card_types": "PAY005",
        "crosswalk": "INT100",
    }

    def __init__(self, spark: SparkSession, folder: str, ignore_case: bool = True):
        self.spark, self.folder, self.ignore_case = spark, folder, ignore_case
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        if name not in self._built:
            table = self.NAMES[name]
            rows = from_source(load(self.spark, self.folder, table), table)
            self._built[name] = canonical_codes(rows, self.ignore_case)
        return self._built[name]
