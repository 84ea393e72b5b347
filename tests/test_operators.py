"""Operators on hand-written rows."""

import datetime as dt
from decimal import Decimal

import pytest

from meterbook.operators import arrangements, card_types, comments, contacts, payments, publish, services, transactions
from meterbook.operators.bills import disconnect_date, master_not_due
from meterbook.operators.receivables import unbilled_amount
from meterbook.session import shared_dir

AS_OF = "2001-07-15"


def day(text):
    return dt.date.fromisoformat(text)


PAYMENT = "trans_num long, customer long, account long, amount decimal(15,2), batch_id long, pay_date date, "
PAYMENT += "ar_code string, trans_code string, processed boolean, is_deleted boolean"


def pay(num, amount, batch, date, account=1, ar="AR1", code="PAY1", processed=True, deleted=False):
    return (num, account, account, Decimal(amount), batch, day(date), ar, code, processed, deleted)


def paid(spark, rows, batches=((1, "CA"), (2, "CA"), (-1, "CA"), (9, "AD")), deposits=("DEP1",)):
    frame = spark.createDataFrame(rows, PAYMENT)
    found = payments.last_payment(
        frame,
        spark.createDataFrame(list(batches), "batch_id long, transaction_type string"),
        spark.createDataFrame([(d,) for d in deposits], "deposit_code string"),
    ).collect()
    return {r["account"]: (r["payment_amount"], str(r["payment_date"])) for r in found}


def test_last_payment_takes_the_leading_batch(spark):
    rows = [pay(5, -10, 1, "2001-03-03"), pay(4, -20, 1, "2001-03-01"), pay(3, -40, 2, "2001-02-01"),
            pay(2, -80, 1, "2001-01-01")]
    assert paid(spark, rows) == {1: (-30, "2001-03-03")}


def test_last_payment_breaks_within_a_day(spark):
    rows = [pay(5, -10, 1, "2001-03-03"), pay(4, -20, 2, "2001-03-03"), pay(3, -40, 1, "2001-03-03")]
    assert paid(spark, rows) == {1: (-10, "2001-03-03")}


def test_last_payment_of_batch_minus_one_sums_the_day(spark):
    rows = [
        pay(5, -10, -1, "2001-03-03"),
        pay(4, -20, 9, "2001-03-03"),  # not a cash batch, still of that day
        pay(3, -40, 1, "2001-03-03", code="DEP1"),  # a deposit, still of that day
        pay(2, -80, -1, "2001-03-02"),
        pay(1, -160, 1, "2001-03-03", deleted=True),
    ]
    assert paid(spark, rows) == {1: (-70, "2001-03-03")}


def test_last_payment_skips_what_does_not_count(spark):
    rows = [pay(9, -1, 9, "2001-09-09"), pay(8, -1, 1, "2001-09-08", ar=" "), pay(7, -1, 1, "2001-09-07", code="DEP1"),
            pay(6, -1, 1, "2001-09-06", processed=False), pay(5, -7, 1, "2001-05-05")]
    assert paid(spark, rows) == {1: (-7, "2001-05-05")}


def test_last_payment_with_a_null_deposit_code_finds_nothing(spark):
    assert paid(spark, [pay(5, -10, 1, "2001-03-03")], deposits=("DEP1", None)) == {}


def test_last_payment_of_a_hot_account(spark):
    rows = [pay(n, -1, 1, "2001-01-01") for n in range(1, 41)] + [pay(100, -5, 2, "2001-02-01", account=2)]
    assert paid(spark, rows) == {1: (-40, "2001-01-01"), 2: (-5, "2001-02-01")}


def test_arrangement_of_a_group_is_its_next_one(spark):
    rows = [
        (1, 1, 10, "2001-09-01", "N", 3),
        (1, 1, 20, "2001-08-01", "B", 3),
        (1, 1, 30, "2001-07-15", "K", 3),
        (1, 1, 40, "2001-07-14", "P", 3),
        (1, 1, 50, "2001-07-20", "P", 4),
        (2, 2, 10, "2001-09-01", "P", 0),
        (2, 2, 20, "2001-08-01", "B", 0),
        (3, 3, 10, "2001-07-14", "Z", 5),
        (3, 3, 20, "2001-07-01", "B", 5),
    ]
    frame = spark.createDataFrame(
        [(c, a, Decimal(m), day(d), s, g) for c, a, m, d, s, g in rows],
        "customer long, account long, amount decimal(15,2), arrange_date date, status string, group_id int",
    )
    found = {
        r["account"]: (r["arrangement_amount"], str(r["arrangement_date"]), r["arrangement_status"])
        for r in arrangements.arrangement_status(frame, AS_OF).collect()
    }
    assert found == {1: (30, "2001-07-15", 3), 2: (10, "2001-09-01", 4), 3: (10, "2001-07-14", 5)}


@pytest.fixture
def comment_tables(spark):
    accounts = spark.createDataFrame([(1, 11), (1, 12), (2, 21), (3, 31)], "customer long, account long")
    codes = spark.createDataFrame(
        [("CO", True, "A", "CC,"), ("CU", True, "C", ""), ("OK", False, "A", "CHK"), ("NU", False, "A", None)],
        "comment_code string, cash_only boolean, comment_type string, disallowed string",
    )
    notes = spark.createDataFrame(
        [
            (1, 9, 11, "CO", None),
            (2, 2, 99, "CU", day("2001-07-15")),
            (3, 1, 99, "OK", None),
            (4, 3, 31, "NU", None),
            (5, 3, 31, "CO", day("2001-07-14")),
        ],
        "comment_id long, customer long, account long, comment_code string, expiration_date date",
    )
    types = spark.createDataFrame(
        [("C", "CASH", "c"), ("CC", "CARD", "cc"), ("CHK", "CHECK", "k"), ("DD", "DEBIT", "d")],
        "code string, payment_type string, container string",
    )
    return accounts, notes, codes, types


def test_cash_only_by_account_or_customer(comment_tables):
    accounts, notes, codes, _ = comment_tables
    found = {r["account"]: r["cash_only"] for r in comments.cash_only(accounts, notes, codes, AS_OF).collect()}
    assert found == {11: True, 12: False, 21: True, 31: False}


def test_comment_restrictions(comment_tables):
    found = {
        r["account"]: (r["comment_type_code"], r["comment_code"], r["container_name"])
        for r in comments.comment_restrictions(*comment_tables, AS_OF).collect()
    }
    assert found == {
        11: ("CO,OK,", "DEBIT,", "d,"),  # 'C' appears inside 'CC' and 'CHK'
        12: ("OK,", "CARD,DEBIT,", "cc,d,"),
        21: ("CU,", "CASH,CARD,CHECK,DEBIT,", "c,cc,k,d,"),
        31: ("NU,", "", ""),  # a NULL list leaves no type
    }


def test_comment_restrictions_v1(comment_tables):
    found = {r["account"]: r["comment_code"] for r in comments.comment_restrictions_v1(*comment_tables, AS_OF).collect()}
    assert found == {11: "CARD,DEBIT,", 12: "CARD,DEBIT,", 21: None, 31: ""}


CONTACT = "contact_info_id long, contact_pk long, customer long, account long, phone_type string, "
CONTACT += "phone_number string, add_type string, updated timestamp_ntz, custom1 boolean, notes string, "
CONTACT += "preferred boolean, contact_times string"


def contact(spark, rows):
    return spark.createDataFrame(
        [
            (i, i, a, a, p, n, t, dt.datetime(2001, 1, d), False, None, False, "")
            for i, a, p, n, t, d in rows
        ],
        CONTACT,
    )


def test_promotion_twice_is_promotion_once(spark):
    table = contact(spark, [(1, 1, "H", "a", "BF", 1), (2, 1, "H", "b", "BF", 2), (3, 1, "W", "c", "BF", 1),
                            (4, 1, "W", "d", "BM ", 1), (9, 2, "H", "e", "", 1)])
    once, deleted = contacts.promote_contacts(table)
    numbers = sorted((r["contact_info_id"], r["phone_number"], r["add_type"]) for r in once.collect())
    assert numbers == [(4, "d", "BM "), (9, "e", ""), (10, "a", "BM"), (11, "b", "BM")]
    assert deleted.count() == 3
    twice, again = contacts.promote_contacts(once)
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    assert again.count() == 0


def test_recency_is_one_row_per_old_contact(spark):
    table = contact(spark, [(1, 1, "H", "a", "BF", 2), (2, 1, "H", "b", "BM", 1), (3, 1, "H", "c", "BM", 3),
                            (4, 2, "H", "d", "BF", 1)])
    found = {r["contact_info_id"]: (r["peers"], r["update_status"][:8]) for r in contacts.contact_recency(table).collect()}
    assert found == {1: (2, "BM is ne"), 4: (0, "BF is ne")}


def test_sync_takes_the_newest_old_row(spark):
    table = contact(spark, [(1, 1, "H", "a", "BF", 5), (2, 1, "H", "b", "BF", 6), (3, 1, "H", "c", "BM", 4),
                            (4, 1, "H", "d", "BM", 6)])
    found = {r["contact_info_id"]: r["phone_number"] for r in contacts.sync_newer_contacts(table).collect()}
    assert found == {1: "a", 2: "b", 3: "b", 4: "d"}


def test_phone_priority_skips_blank_numbers(spark):
    table = contact(spark, [(1, 1, "H", " ", "", 1), (2, 1, "W", "w", " ", 1), (3, 1, "X", "x", "", 1),
                            (4, 2, "H", "h", "BF", 1)])
    kinds = spark.createDataFrame([("H", "Home"), ("W", "Work")], "phone_type string, description string")
    found = contacts.phone_by_priority(table, kinds, ["X", "H", "W"]).collect()
    assert [tuple(r) for r in found] == [(1, "w", "W", "Work")]


def test_older_phone_pick_stops_at_a_blank_number(spark):
    table = contact(spark, [(1, 1, "H", " ", "", 1), (2, 1, "W", "555", "", 1), (3, 2, "H", None, "", 1),
                            (4, 2, "W", " 777 ", "", 1), (5, 3, "X", "9", "", 1), (6, 4, "W", "1" * 25, "BF", 1)])
    kinds = spark.createDataFrame([("H", "Home"), ("W", "Work")], "phone_type string, description string")
    found = contacts.phone_by_priority_v1(table, kinds, ["X", "H", "W"]).collect()
    assert sorted(tuple(r) for r in found) == [(1, "", "H", "Home"), (2, "777", "W", "Work")]


def test_address_copies_leave_keys_alone(spark):
    table = spark.createDataFrame(
        [(1, 1, "BF", "new", dt.datetime(2001, 1, 2), 100), (1, 1, "BM", "old", dt.datetime(2001, 1, 1), 200),
         (2, 2, "BF", "two", dt.datetime(2001, 1, 1), 300)],
        "customer long, account long, add_type string, address1 string, updated timestamp_ntz, own_key long",
    )
    synced = contacts.sync_newer_addresses(table).filter("add_type = 'BM'").collect()
    assert [(r["address1"], r["own_key"]) for r in synced] == [("new", 200)]
    promoted = contacts.promote_addresses(table)[0].collect()
    assert sorted((r["account"], r["address1"], r["own_key"]) for r in promoted) == [(1, "old", 200), (2, "two", None)]


def test_every_web_contact_takes_its_key(spark):
    table = contact(spark, [(555, 1, "E3", "one@x", "", 1), (3, 1, "H", "1", "", 1)])
    table = table.withColumn("contact_pk", table["contact_info_id"] % 10)
    signups = spark.createDataFrame([(1, 2, "two@x")], "web_pk long, customer long, email string")
    found = contacts.web_contacts_table(signups, table, AS_OF).collect()
    assert sorted((r["phone_number"], r["contact_info_id"]) for r in found) == [("1", 3), ("one@x", 5), ("two@x", 6)]


def test_web_contacts(spark):
    table = contact(spark, [(5, 1, "E3", "one@x", "", 1)])
    signups = spark.createDataFrame(
        [(1, 1, "old@x"), (2, 1, "one@x"), (3, 2, "two@x"), (4, None, "none@x"), (5, 3, None)],
        "web_pk long, customer long, email string",
    )
    kept = contacts.web_contacts_insert(signups, table, AS_OF).collect()
    assert sorted((r["customer"], r["phone_number"], r["contact_info_id"]) for r in kept) == [(2, "two@x", 6), (3, None, 7)]
    assert contacts.web_contacts_insert(signups, table, AS_OF, drop_null=True).count() == 1


BILL = "bill_number long, customer long, account long, bill_date date, due_date date, new_due_date date, "
BILL += "current_amount decimal(15,2), amount_due_before decimal(15,2), calc_ts timestamp_ntz, bill_type string, "
BILL += "account_type string, bill_group string, is_master boolean, is_cancelled boolean, no_bill boolean, "
BILL += "processed boolean, orig_bill long, batch_id long, user_id string"


def bill(num, account, date, due, new=None, amount=100, kind="RG", acct="RE", group="G", processed=True, orig=0):
    at = day(date)
    return (num, account, account, at, day(due), new and day(new), Decimal(amount), Decimal(amount) - 1,
            dt.datetime(at.year, at.month, at.day), kind, acct, group, False, False, False, processed, orig, 0, "U")


def test_disconnect_date(spark):
    table = spark.createDataFrame(
        [bill(1, 1, "2001-06-01", "2001-06-20", "2001-06-29"), bill(2, 2, "2001-06-01", "2001-06-20", acct=" ")], BILL
    )
    grace = spark.createDataFrame([("RE", "RG", 2), ("RE", "RG", 1)], "account_type string, bill_type string, days int")
    holidays = spark.createDataFrame([(day("2001-07-02"),)], "holiday date")
    plain = {r["account"]: str(r["disconnect_date"]) for r in disconnect_date(table, grace).collect()}
    assert plain == {1: "2001-07-02", 2: "1900-01-01"}
    working = disconnect_date(table, grace, business_days=True, holidays=holidays).collect()
    assert {r["account"]: str(r["disconnect_date"]) for r in working} == {1: "2001-07-05", 2: "1900-01-01"}


def test_master_counts_the_group_but_not_itself(spark):
    table = spark.createDataFrame(
        [bill(1, 1, "2001-07-01", "2001-07-15"), bill(2, 2, "2001-07-01", "2001-07-14"),
         bill(3, 3, "2001-07-01", "2001-08-01", kind="CB"), bill(4, 4, "2001-07-01", "2001-08-01", group="H")], BILL
    )
    accounts = spark.createDataFrame(
        [(9, 9, True, "K", "AC"), (9, 9, True, "G", "FI"), (8, 8, True, "H", "AC"), (7, 7, False, "G", "AC")],
        "customer long, account long, is_master boolean, bill_group string, account_status string",
    )
    groups = spark.createDataFrame([("G", True), ("K", True), ("H", False)], "bill_group string, updates_master boolean")
    found = master_not_due(accounts, groups, table, AS_OF).collect()
    assert [(r["account"], r["master_not_due"]) for r in found] == [(9, 100)]


def test_missing_transactions(spark):
    table = spark.createDataFrame(
        [bill(1, 1, "2000-05-01", "2000-05-20"), bill(2, 1, "2001-01-01", "2001-01-20", kind="CB", orig=1),
         bill(3, 1, "2001-02-01", "2001-02-20", kind="CB", orig=77), bill(4, 1, "2001-03-01", "2001-03-20", kind="CB"),
         bill(5, 1, "2001-04-01", "2001-04-20", kind="CB", processed=False)], BILL
    )
    lines = spark.createDataFrame([(4, "SYS1"), (2, "OTHER")], "bill_number long, trans_code string")
    found = transactions.missing_system_txns(table, lines, "SYS1", "2001-01-01").collect()
    assert [(r["bill_number"], r["amount"], r["trans_num"]) for r in found] == [(3, None, -1)]
    found = transactions.missing_system_txns(table, lines, "SYS1", "2001-01-01", inclusive=True)
    assert {r["bill_number"]: r["amount"] for r in found.collect()} == {2: 99, 3: None}


def test_unbilled_with_a_null_list_is_nothing(spark):
    txns = spark.createDataFrame(
        [(1, 1, 1, 0, "A", Decimal(5), day("2001-07-01"), False, None, 0),
         (2, 2, 2, 0, "A", Decimal(7), day("2001-07-01"), False, None, 0),
         (3, 2, 2, 0, "A", Decimal(9), day("2001-07-01"), False, None, 3),
         (4, 2, 2, 50, "A", Decimal(11), day("2001-07-01"), False, None, 0),
         (5, 2, 2, 0, "A", Decimal(13), day("2000-07-15"), False, None, 0)],
        "trans_num long, customer long, account long, bill_number long, trans_code string, amount decimal(15,2), "
        "trans_date date, is_statement boolean, aging_date date, linked_trans_num long",
    )
    lines = spark.createDataFrame([(3, 1)], "trans_num long, bill_number long")
    settled = spark.createDataFrame([(4, 50)], "trans_num long, paid_bill long")
    bills = spark.createDataFrame([(50, day("2001-07-14"))], "bill_number long, due_date date")
    codes = spark.createDataFrame([("A", False)], "trans_code string, include_in_owing boolean")
    lists = spark.createDataFrame([(1, 1, None), (2, 2, "X,,")], "customer long, account long, exclude_codes string")
    for notice in (True, False):
        found = unbilled_amount(txns, lines, settled, bills, codes, lists, AS_OF, notice).collect()
        assert [(r["account"], r["unbilled_amount"]) for r in found] == [(2, 18)]


CARDS = "pay003_fk long, card_type string, description string, transaction_code string, external_source string"


def test_card_pipeline(spark):
    rows = [(1, "Visa", "v", "DEP2", "AD"), (1, "Visa", "v", "DEP2", "AD"), (1, "Discover", "d", "DEP2", "AD"),
            (2, "PayPal", "p", "PAY1", "WEB"), (3, "Google_PAY", "g", "DEP2", "AD")]
    found = {}
    for r in card_types.card_type_pipeline(spark.createDataFrame(rows, CARDS)).collect():
        found[r["card_type"]] = found.get(r["card_type"], 0) + 1
    assert found == {"VISA": 2, "VISA_DEBIT": 1, "DISC": 1, "DISC_DEBIT": 1, "PAYPAL": 1, "PAYPAL_CREDIT": 1,
                     "PAYPAL_ACCOUNT": 1, "Google_PAY": 1, "CP_POS_VISA": 1, "CP_POS_VISA_DEBIT": 1,
                     "CP_POS_DISC": 1, "CP_POS_DISC_DEBIT": 1}


def test_recode_applies_pairs_in_order(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("c",), ("A",)], "t string")
    pairs = [("a", "b"), ("b", "c"), ("c", "d")]
    assert [r["t"] for r in card_types.recode(frame, "t", pairs).collect()] == ["d", "d", "d", "A"]
    assert [r["t"] for r in card_types.recode(frame, "t", pairs, ignore_case=True).collect()] == ["d"] * 4


def test_seed_has_every_row(spark):
    seeded = card_types.seed_rows(spark.createDataFrame([], CARDS))
    assert seeded.count() == 128


def test_multipliers_only_missing(spark):
    accounts = spark.createDataFrame(
        [(1, "RE", "02", "1"), (1, "RE", "2", "01"), (2, "RE", "X", "1")],
        "account long, account_type string, division string, company string",
    )
    table = spark.createDataFrame(
        [(1, "30", 10, 10, "30", day("2000-01-01")), (1, "30", 11, 11, "30", day("2000-01-02")),
         (2, "30", 12, 12, "30", day("2000-01-03")), (1, "W", 13, 13, "W", day("2000-01-04"))],
        "account long, service string, servgrp_id long, service_id long, service_group string, install_date date",
    )
    present = spark.createDataFrame(
        [(7, 10, 1), (8, 11, 2)], "multiplier_pk long, servgrp_id long, multiplier int"
    )
    args = (table, accounts, present, "RE", 30, 1, 2)
    every = services.add_multipliers(*args).collect()
    assert sorted((r["servgrp_id"], r["multiplier_pk"]) for r in every) == [(10, 9), (11, 10)]
    missing = services.add_multipliers(*args, only_missing=True).collect()
    assert [(r["servgrp_id"], r["multiplier_pk"]) for r in missing] == [(11, 9)]
    profile = services.multiplier_profile(table, accounts, present, "RE", 30, 1, 2).collect()
    assert {r["multiplier"]: r["record_count"] for r in profile} == {1: 2, 2: 2}


def test_snapshot_is_kept_or_replaced(spark, tmp_path):
    path = str(tmp_path / "copy")
    assert publish.snapshot(spark.range(5), path).first()[0] == 5
    assert publish.snapshot(spark.range(9), path).first()[0] == 5
    assert publish.snapshot(spark.range(9), path, "replace").first()[0] == 9


def test_checked_append(spark, tmp_path):
    base, staging = str(tmp_path / "base"), str(tmp_path / "staging")
    spark.range(5).write.parquet(base)
    with pytest.raises(publish.CheckFailed):
        publish.checked_append(base, spark.range(3), 4, staging)
    with pytest.raises(publish.CheckFailed):
        publish.checked_append(base, spark.range(3), 3, staging, lambda rows: rows.filter("id > 5").count() > 0)
    assert spark.read.parquet(base).count() == 5
    assert tuple(publish.checked_append(base, spark.range(3), 3, staging).first()) == (5, 3, 8, True)
    assert spark.read.parquet(base).count() == 8


def test_duplicated_service_id_is_refused(spark, tmp_path):
    accounts = spark.createDataFrame(
        [(1, 1, "RE", "02", "1")], "customer long, account long, account_type string, division string, company string"
    )
    table = spark.createDataFrame(
        [(1, "30", 10, day("2000-01-01")), (1, "30", 10, day("2000-01-02"))],
        "account long, service string, service_id long, install_date date",
    )
    present = spark.createDataFrame([(7, 3, 1)], "multiplier_pk long, servgrp_id long, multiplier int")
    base, targets = str(tmp_path / "multipliers"), ("RE", 30, 1, 2)
    present.write.parquet(base)
    new = services.add_multipliers(table, accounts, present, *targets).select(present.columns)
    with pytest.raises(publish.CheckFailed):
        publish.checked_append(base, new, services.target_services(table, accounts, *targets), str(tmp_path / "staged"))
    assert spark.read.parquet(base).count() == 1
    counts = services.multiplier_targets(table, accounts, *targets).collect()
    assert [(r["account"], r["record_count"]) for r in counts] == [(1, 2)]


def test_replaced_snapshot_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "copy")
    publish.snapshot(spark.range(5), path)
    assert publish.snapshot(spark.read.parquet(path).filter("id > 1"), path, "replace").first()[0] == 3


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark)
