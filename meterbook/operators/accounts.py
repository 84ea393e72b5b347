"""Accounts: newest rows, counts, IVR status, lookups, service addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import or_empty_date
from meterbook.operators.joins import join_keyed, newest

ACCOUNT = ["customer", "account"]


def current_accounts(accounts: DataFrame) -> DataFrame:
    """The newest row of each (customer, account) by effective date."""
    others = [c for c in accounts.columns if c not in ACCOUNT]
    order = ["effective_date", "account_status", "cycle"]
    return accounts.groupBy(*ACCOUNT).agg(newest(others, order).alias("a")).select(*ACCOUNT, "a.*")


def account_cycle(accounts: DataFrame) -> DataFrame:
    """The billing cycle of each account's newest row."""
    return accounts.groupBy(*ACCOUNT).agg(
        F.max_by("cycle", F.struct("effective_date", "cycle")).alias("cycle")
    )


def account_counts(accounts: DataFrame, account_type: str, division: str) -> DataFrame:
    """Rows and distinct accounts of one type and division, in one row."""
    return accounts.filter(
        (F.col("account_type") == account_type) & (F.col("division") == division)
    ).agg(F.count(F.lit(1)).alias("account_rows"), F.countDistinct("account").alias("distinct_accounts"))


def open_service_order_flag(accounts: DataFrame, service_orders: DataFrame) -> DataFrame:
    """Does the account have a service order neither cancelled nor completed?"""
    waiting = (
        service_orders.filter(~F.col("is_cancelled") & ~F.col("is_completed"))
        .select(*ACCOUNT)
        .distinct()
        .withColumn("service_order", F.lit(True))
    )
    return (
        accounts.select(*ACCOUNT)
        .distinct()
        .join(waiting, ACCOUNT, "left")
        .select(*ACCOUNT, F.coalesce("service_order", F.lit(False)).alias("service_order"))
    )


def collection_codes(collection_settings: DataFrame) -> tuple[Column, Column]:
    """The pending-disconnect and disconnected codes: the smallest non-blank ones."""

    def pick(name: str) -> Column:
        return collection_settings.filter(F.rtrim(name) != "").agg(F.min(name)).scalar()

    return pick("pending_status"), pick("disconnect_status")


def ivr_rule(
    status: Column, collection: Column, past_due: Column, pending: Column, disconnected: Column, v1: bool = False
) -> Column:
    """1 active and nothing past due, 2 not active, 3 pending disconnect, 4 disconnected, 5 otherwise.

    Where both collection codes are the same text the current form reports 4, the older one 3.
    """
    active = status == "AC"
    rule = F.when(active & (past_due == 0), 1).when(status != "AC", 2)
    steps = [(pending, 3), (disconnected, 4)] if v1 else [(disconnected, 4), (pending, 3)]
    for code, number in steps:
        rule = rule.when(active & (collection == code), number)
    return rule.otherwise(5)


def service_address(
    addresses: DataFrame, prefixes: DataFrame, suffixes: DataFrame, v1: bool = False
) -> DataFrame:
    """Street number and street line of each service address.

    Number and descriptions default to blank; street, suffix and apartment do not, so a
    NULL there leaves the line NULL. The older form writes the raw prefix and the number's
    own text, and does not default it.
    """
    rows = join_keyed(
        addresses,
        suffixes.groupBy(F.col("code").alias("num_suffix")).agg(F.min("description").alias("suffix_text")),
        ["num_suffix"],
        "left",
    )
    number, prefix = F.col("street_num_text") if v1 else None, F.col("street_prefix")
    if not v1:
        number = F.col("street_num").cast("int").cast("string")
        rows = join_keyed(
            rows,
            prefixes.groupBy("street_prefix").agg(F.min("description").alias("prefix_text")),
            ["street_prefix"],
            "left",
        )
        number, prefix = F.coalesce(number, F.lit("")), F.coalesce("prefix_text", F.lit(""))
    blank = F.lit(" ")
    return rows.select(
        "account",
        F.concat(number, blank, F.coalesce("suffix_text", F.lit(""))).alias("street_number"),
        F.concat(prefix, blank, "street", blank, "street_suffix", blank, "apt").alias("street_name"),
        F.col("town").alias("city_town"),
        F.col("prov").alias("state_prov"),
        F.col("post_code").alias("zip_postal"),
    )


def _default(data_type) -> Column:
    """What an answer without data holds: blank text, the empty date or 0."""
    kind = data_type.typeName()
    if kind == "string":
        return F.lit("")
    if kind == "date":
        return or_empty_date(F.lit(None).cast("date"))
    return F.lit(0).cast(data_type)


def validated_lookup(
    requests: DataFrame, accounts: DataFrame, result: DataFrame, request_id: str = "request_id"
) -> DataFrame:
    """Answer (customer, account) requests: code 1 with data, else code 0 with default values.

    A request is valid when the pair exists among the accounts. A valid request
    without a result row is answered with NULL data.
    """
    known = accounts.select(*ACCOUNT).distinct().withColumn("_known", F.lit(True))
    values = known.join(result, ACCOUNT, "left")
    rows = join_keyed(requests, values, ACCOUNT, "left")
    valid = F.col("_known").isNotNull()
    filled = []
    for field in result.schema.fields:
        if field.name in ACCOUNT:
            continue
        filled.append(F.when(valid, F.col(field.name)).otherwise(_default(field.dataType)).alias(field.name))
    return rows.select(request_id, *ACCOUNT, F.when(valid, 1).otherwise(0).alias("responsecode"), *filled)


def validated_rows(
    requests: DataFrame,
    accounts: DataFrame,
    result: DataFrame,
    newest_first: str,
    request_id: str = "request_id",
    readable: Column | None = None,
    within: Column | None = None,
) -> DataFrame:
    """All result rows of each valid (customer, account) request, or one row of defaults for an invalid one.

    A request is valid when the pair exists among the accounts and ``readable`` holds; a valid one without result
    rows (those that pass ``within``) has none. Rows come by request and then newest first.
    """
    known = accounts.select(*ACCOUNT).distinct().withColumn("_known", F.lit(True))
    valid = F.col("_known").isNotNull()
    if readable is not None:
        valid = valid & readable
    judged = join_keyed(requests, known, ACCOUNT).withColumn("_valid", F.coalesce(valid, F.lit(False)))
    fields = [f for f in result.schema.fields if f.name not in ACCOUNT]
    found = judged.filter("_valid").join(result, ACCOUNT)
    found = found if within is None else found.filter(within)
    refused = judged.filter(~F.col("_valid")).select(request_id, *[_default(f.dataType).alias(f.name) for f in fields])
    rows = found.select(request_id, *[f.name for f in fields]).unionByName(refused)
    return rows.orderBy(request_id, F.desc(newest_first))


# The forms of a date text that the source's conversion reads, in the order they are tried.
DATE_FORMS = [
    "yyyy-M-d", "yyyyMMdd", "M/d/yyyy", "M-d-yyyy", "M.d.yyyy", "yyyy/M/d", "yyyy.M.d", "MMM d, yyyy", "MMM d yyyy", "d MMM yyyy",
]


def parsed_date(text: Column) -> Column:
    """A date from caller text, in any of ``DATE_FORMS``, with or without a time of day behind it.

    Text that is no date gives NULL instead of failing.
    """
    plain = F.regexp_replace(F.trim(text), r"\s+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(\s*[AaPp][Mm])?$", "")
    return F.coalesce(*[F.try_to_date(plain, form) for form in DATE_FORMS])


def request_date(text: Column) -> Column:
    """A request's date text: blank text is the empty date, NULL stays NULL, text that is no date gives NULL."""
    return F.when(F.trim(text) == "", or_empty_date(F.lit(None).cast("date"))).otherwise(parsed_date(text))


def is_readable(text: Column) -> Column:
    """False for a text that is no date."""
    return text.isNull() | request_date(text).isNotNull()


def customer_of_account(accounts: DataFrame, active: str = "AC") -> DataFrame:
    """One customer for each account, and how many it has.

    An account's customer is the one whose newest row is active, the newest of them by effective date and then by
    the greatest number; without an active one, the newest of all.
    """
    newest_row = accounts.groupBy("account", "customer").agg(F.max(F.struct("effective_date", "account_status")).alias("row"))
    order = F.struct((F.col("row.account_status") == active).alias("active"), F.col("row.effective_date").alias("since"), "customer")
    chosen = newest_row.groupBy("account").agg(F.max(order).alias("chosen"), F.count(F.lit(1)).cast("int").alias("customers"))
    return chosen.select("account", F.col("chosen.customer").alias("customer"), "customers")


def account_lookup(requests: DataFrame, accounts: DataFrame, result: DataFrame, request_id: str = "request_id") -> DataFrame:
    """Answer requests that name an account alone.

    Code 1: the account has one customer; 2: it has several and :func:`customer_of_account` chose; 0: there is no such account,
    and the values are defaults. A known account without a result row is answered with NULL data.
    """
    asked = join_keyed(requests.select(request_id, "account"), customer_of_account(accounts), ["account"], "left")
    rows = join_keyed(asked, result, ACCOUNT, "left")
    known = F.col("customers").isNotNull()
    fields = [f for f in result.schema.fields if f.name not in ACCOUNT]
    code = F.when(~known, 0).when(F.col("customers") == 1, 1).otherwise(2)
    return rows.select(
        request_id, "account", F.coalesce("customer", F.lit(0)).alias("customer"), code.alias("responsecode"),
        *[F.when(known, F.col(f.name)).otherwise(_default(f.dataType)).alias(f.name) for f in fields],
    )
