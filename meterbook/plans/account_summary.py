"""The account summary: one row per (customer, account), current form and older form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from meterbook.functions.rules import or_empty_date, or_zero
from meterbook.operators.accounts import (
    collection_codes,
    ivr_rule,
    open_service_order_flag,
    service_address,
)
from meterbook.operators.arrangements import arrangement_status
from meterbook.operators.bills import disconnect_on, grace_days, with_holidays
from meterbook.operators.comments import cash_only, comment_restrictions, comment_restrictions_v1
from meterbook.operators.contacts import phone_by_priority, phone_by_priority_v1
from meterbook.operators.joins import earliest, join_keyed
from meterbook.operators.payments import last_payment, pending_payments_v1
from meterbook.operators.receivables import due_before_due_date
from meterbook.plans.past_due import past_due_and_state, past_due_frame, past_due_frame_v1

ACCOUNT = ["customer", "account"]


def _names(customers: DataFrame) -> DataFrame:
    """Both names from the same row of a customer, the first by last and first name."""
    return (
        customers.groupBy("customer")
        .agg(earliest(["first_name", "last_name"], ["last_name", "first_name"]).alias("n"))
        .select("customer", "n.*")
    )


def _text(name: str):
    return F.coalesce(name, F.lit(""))


def ivr_status(tables, as_of, notice_codes: bool | None = None) -> DataFrame:
    """Service status number of every account."""
    frame = past_due_frame(tables, as_of, notice_codes)
    pending, disconnected = collection_codes(tables.collection_settings)
    rule = ivr_rule(F.col("account_status"), F.col("col_status"), F.col("past_due_amount"), pending, disconnected)
    return frame.select(*ACCOUNT, "account_status", "col_status", "past_due_amount", rule.alias("ivr_status"))


def account_summary(
    tables,
    as_of,
    phone_types: Sequence[str],
    business_days: bool = False,
    holidays: DataFrame | None = None,
    notice_codes: bool | None = None,
    exact_tokens: bool = False,
) -> DataFrame:
    """All output columns of the current summary for every account.

    ``accounts`` also carries ``col_status`` and ``pin``, which the account check reports.
    The bill number is that of the current bill.
    """
    frame, state = past_due_and_state(tables, as_of, notice_codes, exact_tokens)
    parts = [
        last_payment(tables.payments, tables.batches, tables.deposit_codes),
        arrangement_status(tables.arrangements, as_of),
        cash_only(state, tables.comments, tables.comment_codes, as_of),
        comment_restrictions(state, tables.comments, tables.comment_codes, tables.payment_types, as_of),
        open_service_order_flag(state, tables.service_orders),
    ]
    for part in parts:
        frame = frame.join(part, ACCOUNT, "left")
    frame = frame.withColumn("bill_account_type", F.col("current.account_type")).withColumn(
        "bill_bill_type", F.col("current.bill_type")
    )
    grace = grace_days(tables.grace_days).select(
        F.col("account_type").alias("bill_account_type"), F.col("bill_type").alias("bill_bill_type"), "grace_days"
    )
    frame = join_keyed(frame, grace, ["bill_account_type", "bill_bill_type"], "left")
    address = service_address(tables.service_addresses, tables.street_prefixes, tables.num_suffixes)
    frame = join_keyed(frame, address, ["account"], "left")
    frame = join_keyed(frame, _names(tables.customers), ["customer"], "left")
    phones = phone_by_priority(tables.contacts, tables.phone_types, phone_types)
    frame = join_keyed(frame, phones, ["customer"], "left")
    frame = with_holidays(frame, holidays)

    bill = F.col("current")
    pending, disconnected = collection_codes(tables.collection_settings)
    due_before = due_before_due_date(
        bill["amount_due_before"], F.col("paid_before_due"), bill.isNotNull(), F.col("pending_payment")
    )
    disconnect = disconnect_on(
        bill["bill_due_date"], bill["account_type"], F.col("grace_days"), F.col("holidays"), business_days
    )
    bill_due = F.when(bill.isNull(), or_empty_date(F.lit(None).cast("date"))).otherwise(bill["bill_due_date"])
    return frame.select(
        "customer",
        "account",
        "pin",
        F.col("current_balance").alias("currentbalance"),
        F.col("account_status").alias("accountstatus"),
        ivr_rule(
            F.col("account_status"), F.col("col_status"), F.col("past_due_amount"), pending, disconnected
        ).alias("ivrstatus"),
        or_empty_date(bill["bill_date"]).alias("billdate"),
        bill_due.alias("billduedate"),
        or_zero(bill["bill_amount"]).alias("billamount"),
        F.col("past_due_amount").alias("pastdueamount"),
        F.col("first_name").alias("firstname"),
        F.col("last_name").alias("lastname"),
        F.col("street_number").alias("streetnumber"),
        F.col("street_name").alias("streetname"),
        F.col("city_town").alias("citytown"),
        F.col("state_prov").alias("stateprov"),
        F.col("zip_postal").alias("zippostal"),
        or_zero(F.col("payment_amount")).alias("paymentamount"),
        or_empty_date(F.col("payment_date")).alias("paymentdate"),
        F.col("col_status").alias("colstatuscode"),
        F.col("cash_only").alias("cashonly"),
        disconnect.alias("disconnectdate"),
        F.col("pending_payment").alias("pendingpayment"),
        F.coalesce("plan_number", F.lit(0)).alias("paymentplantype"),
        F.when(F.col("plan_type").isNull(), F.lit(False)).otherwise(F.col("draw")).alias("drawpayment"),
        or_zero(F.col("arrangement_amount")).alias("arrangementamount"),
        or_empty_date(F.col("arrangement_date")).alias("arrangementdate"),
        F.coalesce("arrangement_status", F.lit(0)).alias("arrangementstatus"),
        _text("phone_number").alias("phonenumber"),
        _text("phone_type").alias("phonetype"),
        _text("phone_desc").alias("phonedesc"),
        F.col("comment_code").alias("commentcode"),
        "cycle",
        F.col("service_order").alias("serviceorder"),
        F.col("past_due_date").alias("pastduedate"),
        due_before.alias("amountduebeforeduedate"),
        F.col("comment_type_code").alias("commenttypecode"),
        F.col("container_name").alias("containername"),
        F.coalesce(bill["bill_number"], F.lit(0)).alias("billnumber"),
        F.lit(1).alias("responsecode"),
    )


def account_summary_v1(
    tables,
    as_of,
    phone_types: Sequence[str],
    business_days: bool = False,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """All output columns of the older summary for every account."""
    frame = past_due_frame_v1(tables, as_of)
    parts = [
        pending_payments_v1(tables.payments, tables.ext_pending),
        last_payment(tables.payments, tables.batches),
        arrangement_status(tables.arrangements, as_of),
        cash_only(tables.accounts, tables.comments, tables.comment_codes, as_of),
        comment_restrictions_v1(
            tables.accounts, tables.comments, tables.comment_codes, tables.payment_types, as_of
        ),
    ]
    for part in parts:
        frame = frame.join(part, ACCOUNT, "left")
    grace = grace_days(tables.grace_days).withColumnRenamed("account_type", "bill_account_type")
    frame = join_keyed(frame, grace, ["bill_account_type", "bill_type"], "left")
    address = service_address(tables.service_addresses, tables.street_prefixes, tables.num_suffixes, v1=True)
    frame = join_keyed(frame, address.withColumn("_addr", F.lit(True)), ["account"], "left")
    frame = join_keyed(
        frame, _names(tables.customers).withColumn("_named", F.lit(True)), ["customer"], "left"
    )
    phones = phone_by_priority_v1(tables.contacts, tables.phone_types, phone_types)
    frame = join_keyed(frame, phones, ["customer"], "left")
    frame = with_holidays(frame, holidays)

    def kept(flag: str, name: str):
        """The row's own value, blank only when there was no row."""
        return F.when(F.col(flag).isNull(), F.lit("")).otherwise(F.col(name))

    pending, disconnected = collection_codes(tables.collection_settings)
    ivr = ivr_rule(
        F.col("account_status"), F.col("col_status"), F.col("past_due_amount"), pending, disconnected, v1=True
    )
    disconnect = disconnect_on(
        F.col("plain_due_date"),
        F.col("bill_account_type"),
        F.col("grace_days"),
        F.col("holidays"),
        business_days,
    )
    return frame.select(
        "customer",
        "account",
        "pin",
        F.col("current_balance").alias("currentbalance"),
        F.col("account_status").alias("accountstatus"),
        ivr.alias("ivrstatus"),
        or_empty_date(F.col("bill_date")).alias("billdate"),
        F.col("due_date").alias("billduedate"),
        or_zero(F.col("bill_amount")).alias("billamount"),
        F.col("past_due_amount").alias("pastdueamount"),
        kept("_named", "first_name").alias("firstname"),
        kept("_named", "last_name").alias("lastname"),
        kept("_addr", "street_number").alias("streetnumber"),
        kept("_addr", "street_name").alias("streetname"),
        kept("_addr", "city_town").alias("citytown"),
        kept("_addr", "state_prov").alias("stateprov"),
        kept("_addr", "zip_postal").alias("zippostal"),
        or_zero(F.col("payment_amount")).alias("paymentamount"),
        or_empty_date(F.col("payment_date")).alias("paymentdate"),
        F.col("col_status").alias("colstatuscode"),
        F.col("cash_only").alias("cashonly"),
        disconnect.alias("disconnectdate"),
        or_zero(F.col("pending_payment")).alias("pendingpayment"),
        F.coalesce("plan_number", F.lit(0)).alias("paymentplantype"),
        F.when(F.col("plan_number").isNull(), F.lit(False)).otherwise(F.col("draw")).alias("drawpayment"),
        or_zero(F.col("arrangement_amount")).alias("arrangementamount"),
        or_empty_date(F.col("arrangement_date")).alias("arrangementdate"),
        F.coalesce("arrangement_status", F.lit(0)).alias("arrangementstatus"),
        _text("phone_number").alias("phonenumber"),
        F.coalesce("phone_type", F.lit(phone_types[0].strip() if phone_types else "")).alias("phonetype"),
        _text("phone_desc").alias("phonedesc"),
        F.lit(1).alias("responsecode"),
        F.col("comment_code").alias("commentcode"),
    )
