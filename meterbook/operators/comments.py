"""Comments on accounts and customers: cash-only and payment-type restrictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import appears_in, comma_list, not_expired
from meterbook.operators.joins import earliest, join_keyed

ACCOUNT = ["customer", "account"]


def active_comments(comments: DataFrame, comment_codes: DataFrame, as_of) -> DataFrame:
    """Comments not expired, with the settings of their code."""
    valid = comments.filter(not_expired(F.col("expiration_date"), as_of))
    return join_keyed(valid, comment_codes, ["comment_code"], "inner")


def cash_only(accounts: DataFrame, comments: DataFrame, comment_codes: DataFrame, as_of) -> DataFrame:
    """Cash-only by a type A comment on the account, or by any comment on the customer."""
    restricting = active_comments(comments, comment_codes, as_of).filter("cash_only")
    by_account = (
        restricting.filter("comment_type = 'A'").select("account").distinct().withColumn("_a", F.lit(True))
    )
    by_customer = restricting.select("customer").distinct().withColumn("_c", F.lit(True))
    rows = join_keyed(accounts.select(*ACCOUNT).distinct(), by_account, ["account"], "left")
    rows = join_keyed(rows, by_customer, ["customer"], "left")
    return rows.select(*ACCOUNT, F.coalesce("_a", "_c", F.lit(False)).alias("cash_only"))


def comment_codes(accounts: DataFrame, comments: DataFrame, codes: DataFrame, as_of) -> DataFrame:
    """Distinct active comment codes of an account or its customer, and their disallowed types.

    The sets hold comment codes, so their size is bounded by the code table. Both texts
    follow the order of the codes; a NULL disallowed list makes that text NULL.
    """
    valid = active_comments(comments, codes, as_of)
    entry = F.struct("comment_code", "disallowed")
    by_account = valid.groupBy("account").agg(F.collect_set(entry).alias("_a"))
    by_customer = valid.groupBy("customer").agg(F.collect_set(entry).alias("_c"))
    rows = join_keyed(accounts.select(*ACCOUNT).distinct(), by_account, ["account"], "left")
    rows = join_keyed(rows, by_customer, ["customer"], "left")
    none = F.array().cast("array<struct<comment_code:string,disallowed:string>>")
    both = F.array_sort(F.array_union(F.coalesce("_a", none), F.coalesce("_c", none)))
    return rows.withColumn("_all", both).select(
        *ACCOUNT,
        comma_list(F.transform("_all", lambda e: e["comment_code"])).alias("comment_type_code"),
        comma_list(F.transform("_all", lambda e: e["disallowed"])).alias("disallowed_types"),
    )


def type_list(payment_types: DataFrame) -> Column:
    """The payment-type table as one sorted array; each result row lists it anyway."""
    entry = F.struct("code", "payment_type", "container")
    return payment_types.agg(F.array_sort(F.collect_list(entry))).scalar()


def allowed_types(types: Column, disallowed: Column) -> Column:
    """Payment types whose code appears nowhere in the disallowed text; none if it is NULL."""
    return F.coalesce(
        F.filter(types, lambda t: ~appears_in(t["code"], disallowed)),
        F.array().cast("array<struct<code:string,payment_type:string,container:string>>"),
    )


def payment_types_allowed(
    restrictions: DataFrame, payment_types: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Per account, the payment types and container names not disallowed, as list texts."""
    allowed = restrictions.withColumn("_types", type_list(payment_types)).withColumn(
        "_allowed", allowed_types(F.col("_types"), F.col("disallowed_types"))
    )
    return allowed.select(
        *ACCOUNT,
        *keep,
        comma_list(F.transform("_allowed", lambda t: t["payment_type"])).alias("comment_code"),
        comma_list(F.transform("_allowed", lambda t: t["container"])).alias("container_name"),
    )


def comment_restrictions(
    accounts: DataFrame, comments: DataFrame, codes: DataFrame, payment_types: DataFrame, as_of
) -> DataFrame:
    """Comment codes, allowed payment types and container names of every account."""
    found = comment_codes(accounts, comments, codes, as_of)
    texts = payment_types_allowed(found, payment_types, keep=["comment_type_code"])
    return texts.select(*ACCOUNT, "comment_type_code", "comment_code", "container_name")


def comment_restrictions_v1(
    accounts: DataFrame, comments: DataFrame, codes: DataFrame, payment_types: DataFrame, as_of
) -> DataFrame:
    """The older form: allowed types by the account's first unrestricted comment, else the customer's.

    "First" is the lowest comment id. A blank or missing account text falls back to the
    customer's, which may be NULL.
    """
    valid = active_comments(comments, codes, as_of).filter("not cash_only")
    types = F.col("_types")

    def text(disallowed: Column) -> Column:
        kept = F.filter(allowed_types(types, disallowed), lambda t: t["payment_type"] != "")
        return comma_list(F.transform(kept, lambda t: t["payment_type"]))

    def first(key: str, name: str) -> DataFrame:
        picked = valid.groupBy(key).agg(earliest(["disallowed"], ["comment_id"]).alias(name))
        return picked.filter(F.col(key).isNotNull())

    rows = join_keyed(accounts.select(*ACCOUNT).distinct(), first("account", "_a"), ["account"], "left")
    rows = join_keyed(rows, first("customer", "_c"), ["customer"], "left")
    rows = rows.withColumn("_types", type_list(payment_types))
    own = F.when(F.col("_a").isNotNull(), text(F.col("_a.disallowed")))
    other = F.when(F.col("_c").isNotNull(), text(F.col("_c.disallowed")))
    return rows.select(*ACCOUNT, F.when(own != "", own).otherwise(other).alias("comment_code"))
