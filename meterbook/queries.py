"""The registered queries: every operator over the tables derived from the driver's."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterbook.functions.rules import business_days_add
from meterbook.operators import (
    accounts as acc,
    arrangements as arr,
    bills,
    card_types as cards,
    codes,
    comments as com,
    contacts as con,
    enrolments as plan,
    payments as pay,
    publish,
    receivables as rec,
    services as srv,
    transactions as txn,
)
from meterbook.operators.ids import assign_ids, highest_id
from meterbook.operators.versions import VersionedTable
from meterbook.plans import past_due as due, account_summary as summary
from meterbook.session import shared_dir, tune
from meterbook.sources.derived import AS_OF, Tables
from meterbook.sources.tables import append_rows, empty_like

ACCOUNT = ["customer", "account"]
NEWEST = 3
PHONES = ["P3", "P11", "P5", "P7"]
TYPE, DIVISION, SERVICE = "BU", "02", "30"
CODE, CUTOFF = "RF", "2000-01-01"
STAGED_START = "2023-01-01"
STAGE_BUCKETS = 8

# the aggregation behind the bill lines and receivables; plans that read those several times store it first
LEDGERS = ("bill_txns",)

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


# ---- sources, snapshots, sinks ----------------------------------------------------------


@query
def code_crosswalk(t):
    return codes.translate_codes(t.external_codes, t.crosswalk, 25, "external_value")


@query
def card_type_seed(t):
    return cards.seed_rows(t.card_types)


@query
def snapshot_if_absent(t):
    path = f"{shared_dir(t.spark)}/{_scratch()}-bill-lines"
    publish.snapshot(t.bill_lines, path)
    return publish.snapshot(empty_like(t.bill_lines), path)


@query
def stage_target_accounts(t):
    staged = srv.stage_target_accounts(t.services, t.accounts, SERVICE, TYPE, DIVISION)
    path = f"{shared_dir(t.spark)}/{_scratch()}-targets"
    publish.snapshot(staged, path, "replace")
    return t.spark.read.parquet(path)


# ---- projections, filters, predicates -------------------------------------------------------


@query
def billable_bills(t):
    return bills.billable_bills(t.bills).select("bill_number", *ACCOUNT, "bill_date", "current_amount")


@query
def active_plans(t):
    return plan.active_plans(t.plan_enrolments, t.plan_types, AS_OF).select(
        *ACCOUNT, "plan_type", "start_date", "stop_date", "plan_class", "draw"
    )


@query
def active_plans_on(t):
    dates = t.bills.select((F.trunc("bill_date", "month") + F.expr("interval 1400 days")).cast("date").alias("as_of")).distinct()
    return plan.active_plans_on(dates, t.plan_enrolments, t.plan_types).select(
        "as_of", *ACCOUNT, "plan_type", "start_date", "stop_date", "plan_class"
    )


@query
def staged_receivables(t):
    """Receivables of the target accounts, both stored in buckets by account."""
    folder, name = f"{shared_dir(t.spark)}/{_scratch()}", uuid.uuid4().hex
    staged = srv.stage_target_accounts(t.services, t.accounts, SERVICE, TYPE, DIVISION).select("account").distinct()
    targets = publish.stage_bucketed(staged, f"targets_{name}", f"{folder}-targets", ["account"], STAGE_BUCKETS)
    txns = publish.stage_bucketed(t.ar_txns.select("account", "amount"), f"txns_{name}", f"{folder}-txns", ["account"], STAGE_BUCKETS)
    return srv.staged_receivables(targets, txns)


# ---- joins and subqueries -------------------------------------------------------------------


@query
def multiplier_profile(t):
    return srv.multiplier_profile(t.services, t.accounts, t.multipliers, TYPE, 30, 1, 2).orderBy("multiplier")


@query
def multiplier_coverage(t):
    return srv.multiplier_coverage(t.services, t.accounts, t.multipliers, SERVICE, TYPE, DIVISION)


@query
def service_accounts_semi(t):
    return srv.service_accounts_semi(t.services, t.accounts, SERVICE, TYPE, DIVISION)


@query
def payments_excluding_codes(t):
    kept = pay.payments_excluding_codes(t.payments, t.deposit_codes, "deposit_code")
    return kept.select("trans_num", *ACCOUNT, "trans_code", "amount")


@query
def unmatched_bf_addresses(t):
    return con.without_peer(t.addresses, ["account"])


@query
def missing_system_txns(t):
    return _missing(t)


@query
def contact_recency(t):
    return con.contact_recency(t.contacts).select(
        "contact_info_id", "account", "phone_type", "updated", "new_updated", "peers", "update_status"
    )


@query
def open_service_order_flag(t):
    return acc.open_service_order_flag(t.accounts, t.service_orders)


@query
def latest_web_contact(t):
    return con.latest_web_contact(t.web_signups)


@query
def payment_types_allowed(t):
    found = com.comment_codes(t.accounts, t.comments, t.comment_codes, AS_OF)
    return com.payment_types_allowed(found, t.payment_types)


# ---- aggregations ----------------------------------------------------------------------------


@query
def payment_history(t):
    return pay.payment_history(t.payments, t.trans_codes, NEWEST)


@query
def payment_history_by_batch(t):
    return pay.payment_history_by_batch(t.payments, NEWEST)


@query
def ar_balance(t):
    return plan.ar_balance(t.ar_balances, t.ar_codes)


@query
def pending_payments(t):
    return pay.pending_payments(t.payments, t.trans_codes, t.ext_pending)


@query
def pending_payments_v1(t):
    return pay.pending_payments_v1(t.payments, t.ext_pending)


@query
def grace_days(t):
    return bills.bill_grace_days(t.bills, t.grace_days)


@query
def account_counts(t):
    return acc.account_counts(t.accounts, TYPE, DIVISION)


@query
def staged_amount_stats(t):
    return txn.staged_amount_stats(_missing(t))


@query
def reconcile_counts(t):
    staged = _missing(t)
    lines = append_rows(
        t.bill_lines, staged.select([c for c in staged.columns if c in t.bill_lines.columns])
    )
    return txn.reconcile_counts(staged, lines.filter((F.col("trans_code") == CODE) & (F.col("trans_num") == -1)))


@query
def reconcile_above_mark(t):
    staged = srv.stage_target_accounts(t.services, t.accounts, SERVICE, TYPE, DIVISION)
    new = srv.add_multipliers_staged(staged, t.multipliers, STAGED_START, SERVICE)
    mark = highest_id(t.multipliers, "multiplier_pk")
    return txn.reconcile_above(staged, append_rows(t.multipliers, new), "servgrp_id", "multiplier_pk", mark)


@query
def exclude_codes(t):
    plans = plan.plan_status(t.plan_enrolments, t.plan_types, AS_OF)
    return codes.exclude_codes(t.accounts, plans, t.ar_codes)


@query
def comment_codes(t):
    return com.comment_codes(t.accounts, t.comments, t.comment_codes, AS_OF)


# ---- order-dependent picks ---------------------------------------------------------------------


@query
def next_ids(t):
    wanted = t.contacts.filter(F.col("add_type") == "BF").select("account", "phone_type", "contact_info_id")
    first = highest_id(t.contacts, "contact_info_id")
    return assign_ids(wanted, ["account", "phone_type", "contact_info_id"], first, "new_id")


@query
def last_payment(t):
    return pay.last_payment(t.payments, t.batches, t.deposit_codes)


@query
def last_payment_v1(t):
    return pay.last_payment(t.payments, t.batches)


@query
def current_bill(t):
    return bills.current_bill(t.bills)


@query
def last_past_due_bill(t):
    return bills.last_past_due_bill(t.bills, AS_OF)


@query
def account_cycle(t):
    return acc.account_cycle(t.accounts)


@query
def arrangement_status(t):
    return arr.arrangement_status(t.arrangements, AS_OF)


@query
def phone_by_priority(t):
    return con.phone_by_priority(t.contacts, t.phone_types, PHONES)


@query
def phone_by_priority_v1(t):
    return con.phone_by_priority_v1(t.contacts, t.phone_types, PHONES)


# ---- sorts, limits, distinct ---------------------------------------------------------------------


@query
def sample_top_rows(t):
    return txn.sample_top_rows(_missing(t), 5)


@query
def card_type_expand(t):
    return cards.expand(cards.recode(t.card_types, "card_type"))


@query
def pos_card_types(t):
    coded = cards.recode(t.card_types, "card_type")
    return cards.pos_rows(coded.unionByName(cards.expand(coded)))


# ---- scalar functions ------------------------------------------------------------------------------


@query
def formatted_service_address(t):
    return acc.service_address(t.service_addresses, t.street_prefixes, t.num_suffixes)


@query
def formatted_service_address_v1(t):
    return acc.service_address(t.service_addresses, t.street_prefixes, t.num_suffixes, v1=True)


@query
def business_days(t):
    days = F.pmod("bill_number", F.lit(25)).cast("int")
    return t.bills.select("bill_number", "due_date", business_days_add(F.col("due_date"), days).alias("cut_date"))


# ---- change operators ---------------------------------------------------------------------------------


@query
def card_type_recode(t):
    return cards.recode(t.card_types, "card_type")


@query
def card_type_pipeline(t):
    return cards.card_type_pipeline(t.card_types)


@query
def card_type_check(t):
    return cards.checked_types(cards.card_type_pipeline(t.card_types))


@query
def card_type_unmatched(t):
    return cards.unmatched_types(t.card_types)


@query
def promote_addresses(t):
    return con.promote_addresses(t.addresses)[0]


@query
def promote_addresses_deleted(t):
    return con.promote_addresses(t.addresses)[1]


@query
def promote_contacts(t):
    return con.promote_contacts(t.contacts)[0]


@query
def sync_newer_contacts(t):
    return con.sync_newer_contacts(t.contacts)


@query
def sync_newer_addresses(t):
    return con.sync_newer_addresses(t.addresses)


@query
def web_contacts_insert(t):
    return con.web_contacts_insert(t.web_signups, t.web_contacts, AS_OF)


@query
def web_contacts_table(t):
    return con.web_contacts_table(t.web_signups, t.web_contacts, AS_OF)


@query
def add_multipliers(t):
    return srv.add_multipliers(t.services, t.accounts, t.multipliers, TYPE, 30, 1, 2)


@query
def add_multipliers_missing(t):
    return srv.add_multipliers(t.services, t.accounts, t.multipliers, TYPE, 30, 1, 2, only_missing=True)


@query
def add_multipliers_staged(t):
    staged = srv.stage_target_accounts(t.services, t.accounts, SERVICE, TYPE, DIVISION)
    return srv.add_multipliers_staged(staged, t.multipliers, STAGED_START, SERVICE)


@query
def checked_append(t):
    base = f"{shared_dir(t.spark)}/{_scratch()}-multipliers"
    publish.snapshot(t.multipliers, base)
    targets = (TYPE, 30, 1, 2)
    new = srv.add_multipliers(t.services, t.accounts, t.multipliers, *targets)
    expected = srv.target_services(t.services, t.accounts, *targets)

    def joins_back(staged):
        found = srv.multiplier_verification(t.services, t.accounts, staged, *targets)
        return found.agg(F.coalesce(F.sum("verified_count"), F.lit(0))).first()[0] >= expected

    rows = append_rows(empty_like(t.multipliers), new)
    return publish.checked_append(base, rows, expected, f"{base}-staging", joins_back)


@query
def versioned_append(t):
    """The append of new multipliers as a version of its own."""
    table = VersionedTable(t.spark, f"{shared_dir(t.spark)}/{_scratch()}-multipliers")
    before = table.replace(t.multipliers, None)
    targets = (TYPE, 30, 1, 2)
    new = append_rows(empty_like(t.multipliers), srv.add_multipliers(t.services, t.accounts, t.multipliers, *targets))
    after = table.append(new, before, expected=srv.target_services(t.services, t.accounts, *targets))
    counts = table.read(after).agg(F.count(F.lit(1)).alias("rows_after"))
    return counts.select(
        F.lit(before.rows).cast("bigint").alias("rows_before"), F.lit(after.rows - before.rows).cast("bigint").alias("rows_added"),
        "rows_after", (F.col("rows_after") == after.rows).alias("ok"),
    )


@query
def sync_newer_contacts_touched(t):
    """The update of contacts, written only to the buckets of accounts that have a newer row."""
    table = VersionedTable(t.spark, f"{shared_dir(t.spark)}/{_scratch()}-contacts", key="account", buckets=STAGE_BUCKETS)
    before = table.replace(t.contacts, None)
    touched = t.contacts.filter(F.col("add_type") == "BF").select("account").distinct()
    after = table.rewrite(touched, con.sync_newer_contacts, before)
    return table.read(after)


@query
def promote_addresses_touched(t):
    """The promotion of addresses, written only to the buckets of accounts that have one of the old type."""
    table = VersionedTable(t.spark, f"{shared_dir(t.spark)}/{_scratch()}-addresses", key="account", buckets=STAGE_BUCKETS)
    before = table.replace(t.addresses, None)
    touched = t.addresses.filter(F.col("add_type") == "BF").select("account").distinct()
    after = table.rewrite(touched, lambda part: con.promote_addresses(part)[0], before)
    return table.read(after)


@query
def card_type_recode_touched(t):
    """The recoding of card types, written only to the buckets of owners with an old code."""
    table = VersionedTable(t.spark, f"{shared_dir(t.spark)}/{_scratch()}-cards", key="pay003_fk", buckets=STAGE_BUCKETS)
    before = table.replace(t.card_types, None)
    coded = cards.recode(t.card_types.withColumn("_old", F.col("card_type")), "card_type")
    touched = coded.filter(~F.col("_old").eqNullSafe(F.col("card_type"))).select("pay003_fk").distinct()
    after = table.rewrite(touched, lambda part: cards.recode(part, "card_type"), before)
    return table.read(after)


@query
def multiplier_targets(t):
    return srv.multiplier_targets(t.services, t.accounts, TYPE, 30, 1, 2)


@query
def multiplier_verification(t):
    return srv.multiplier_verification(t.services, t.accounts, t.multipliers, TYPE, 30, 1, 2)


# ---- account operators -----------------------------------------------------------------------------------


@query
def plan_status(t):
    return plan.plan_status(t.plan_enrolments, t.plan_types, AS_OF)


@query
def plan_status_v1(t):
    return plan.plan_status_v1(t.plan_enrolments, t.plan_types, AS_OF)


@query
def current_balance(t):
    return plan.current_balance(
        t.accounts, t.plan_enrolments, t.plan_types, t.plan_balances, t.ar_balances, t.ar_codes, AS_OF
    )


@query
def disconnect_date(t):
    return bills.disconnect_date(t.bills, t.grace_days)


@query
def disconnect_date_business(t):
    return bills.disconnect_date(t.bills, t.grace_days, business_days=True)


@query
def amount_due_before_due_date(t):
    t.stored(*LEDGERS)
    waiting = pay.pending_payments(t.payments, t.trans_codes, t.ext_pending)
    return rec.amount_due_before_due_date(t.accounts, t.bills, t.ar_txns, t.bill_lines, t.trans_codes, waiting)


@query
def not_due_amount(t):
    if not codes.notice_codes_on(t.trans_codes):
        return bills.not_due_bills(t.bills, AS_OF)
    return rec.not_due_lines(
        t.accounts, t.bill_lines, t.bills, t.trans_codes, t.ar_codes, t.ar_txns, codes.balance_codes(t.ar_codes), AS_OF
    )


@query
def not_due_bills(t):
    return bills.not_due_bills(t.bills, AS_OF)


@query
def plan_past_due(t):
    return due.plan_past_due(t, AS_OF)


@query
def master_not_due(t):
    return bills.master_not_due(t.accounts, t.bill_groups, t.bills, AS_OF)


@query
def unbilled_amount(t):
    plans = plan.plan_status(t.plan_enrolments, t.plan_types, AS_OF)
    lists = codes.exclude_codes(t.accounts, plans, t.ar_codes)
    return rec.unbilled_amount(t.ar_txns, t.bill_lines, t.payments, t.bills, t.trans_codes, lists, AS_OF, True)


@query
def unbilled_amount_plain(t):
    plans = plan.plan_status(t.plan_enrolments, t.plan_types, AS_OF)
    lists = codes.exclude_codes(t.accounts, plans, t.ar_codes)
    return rec.unbilled_amount(t.ar_txns, t.bill_lines, t.payments, t.bills, t.trans_codes, lists, AS_OF, False)


@query
def unbilled_amount_unique(t):
    plans = plan.plan_status(t.plan_enrolments, t.plan_types, AS_OF)
    lists = codes.exclude_codes(t.accounts, plans, t.ar_codes)
    return rec.unbilled_amount(
        t.ar_txns, t.bill_lines, t.payments, t.bills, t.trans_codes, lists, AS_OF, True, unique=True
    )


@query
def nsf_amount(t):
    return rec.nsf_amount(t.ar_txns, t.trans_codes, bills.current_bill(t.bills), AS_OF)


@query
def past_due(t):
    return due.past_due(t.stored(*LEDGERS), AS_OF)


@query
def past_due_plain(t):
    return due.past_due(t.stored(*LEDGERS), AS_OF, notice_codes=False)


@query
def past_due_v1(t):
    return due.past_due_v1(t.stored(*LEDGERS), AS_OF)


@query
def cash_only(t):
    return com.cash_only(t.accounts, t.comments, t.comment_codes, AS_OF)


@query
def comment_restrictions(t):
    return com.comment_restrictions(t.accounts, t.comments, t.comment_codes, t.payment_types, AS_OF)


@query
def comment_restrictions_v1(t):
    return com.comment_restrictions_v1(t.accounts, t.comments, t.comment_codes, t.payment_types, AS_OF)


@query
def ivr_status(t):
    return summary.ivr_status(t.stored(*LEDGERS), AS_OF)


@query
def account_summary(t):
    return summary.account_summary(t.stored(*LEDGERS), AS_OF, PHONES)


@query
def account_summary_v1(t):
    return summary.account_summary_v1(t.stored(*LEDGERS), AS_OF, PHONES)


@query
def billing_history(t):
    rows = bills.billing_history(t.bills, "1999-01-01", "2000-12-31")
    return rows.orderBy("customernumber", "accountnumber", F.desc("billdate"), "billnumber")


@query
def billing_history_lookup(t):
    return bills.billing_history_lookup(t.lookup_requests, t.accounts, t.bills)


@query
def payment_history_lookup(t):
    return pay.payment_history_lookup(t.lookup_requests, t.accounts, t.payments, t.trans_codes, NEWEST)


@query
def validated_lookup(t):
    balances = current_balance(t)
    newest = bills.current_bill(t.bills).select(*ACCOUNT, "bill_date", "bill_amount")
    return acc.validated_lookup(t.lookup_requests, t.accounts, balances.join(newest, ACCOUNT, "left"))


@query
def account_lookup(t):
    newest = bills.current_bill(t.bills).select(*ACCOUNT, "bill_date", "bill_amount")
    return acc.account_lookup(t.lookup_requests, t.accounts, newest)


# ---- helpers ------------------------------------------------------------------------------------------------


def _missing(t: Tables) -> DataFrame:
    return txn.missing_system_txns(t.bills, t.bill_lines, CODE, CUTOFF)


def _scratch() -> str:
    return f"meterbook-{uuid.uuid4().hex}"


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Tables(tune(spark), folder))
