"""One pass over the fact tables: reads counted in the plans, and the same figures as the single-feature operators."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from meterbook.operators import ledger as led, receivables as rec
from meterbook.plans import account_summary as summary, past_due as due
from meterbook.sources.derived import AS_OF, DERIVED, Tables

PHONES = ["P3", "P11"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived tables as files, so that a read of a table shows in a plan by its path."""
    folder = tmp_path_factory.mktemp("facts")
    made = Tables(spark, SMALL)
    for name in DERIVED:
        getattr(made, name).write.parquet(f"{folder}/{name}")
    return SimpleNamespace(**{name: spark.read.parquet(f"{folder}/{name}") for name in DERIVED}), str(folder)


def test_each_fact_table_is_read_at_most_twice(spark, stored, monkeypatch):
    tables, _ = stored
    plans = []
    for module in (led, due):
        kept = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, kept=kept: plans.append(df) or kept(df))
    plans.append(summary.account_summary(tables, AS_OF, PHONES))
    reads = {"ar_txns": 0, "bill_lines": 0}
    for frame in plans:
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        for i in range(leaves.size()):
            if leaves.apply(i).nodeName().startswith("LogicalRelation"):
                path = leaves.apply(i).relation().location().rootPaths().mkString(",")
                for name in reads:
                    reads[name] += path.endswith(f"/{name}")
    assert reads == {"ar_txns": 1, "bill_lines": 2}


STATE = "customer long, account long, calc_ts timestamp, bill_date date, exclude_codes string, plan_bill_number long"
TXN = (
    "trans_num long, customer long, account long, bill_number long, trans_code string, amount decimal(15,2), trans_date date, "
    "is_statement boolean, aging_date date, linked_trans_num long"
)
LINE = (
    "bill_number long, account long, trans_num long, trans_code string, amount decimal(15,2), in_balance boolean, sum_flag int, "
    "ar_code string, orig_bill long"
)


def random_tables(spark, seed):
    import random

    pick = random.Random(seed)
    day = lambda n: dt.date(2001, 1, 1) + dt.timedelta(days=n)
    maybe = lambda v: None if pick.random() < 0.08 else v
    codes = ["AD1", "NS", "OA", "CH", "CA", None]
    txns = [
        (maybe(pick.randrange(30)), 1, pick.randrange(4), maybe(pick.choice([0, 0, 5, 6])), pick.choice(codes), maybe(pick.randrange(-5, 6)),
         maybe(day(pick.randrange(260))), maybe(pick.random() < 0.3), day(3) if pick.random() < 0.2 else None, maybe(pick.choice([0, 0, 9])))
        for _ in range(400)
    ]
    lines = [
        (pick.choice([5, 6, 7]), pick.randrange(5), maybe(pick.randrange(-1, 40)) if seed % 2 else pick.randrange(-1, 40), pick.choice(codes), maybe(pick.randrange(-3, 6)), maybe(pick.random() < 0.5),
         pick.choice([0, 1, 5]), maybe(pick.choice(["A", "B", "D"])), pick.choice([0, 0, 0, 4]))
        for _ in range(60)
    ]
    from decimal import Decimal

    money = lambda rows, at: [(*r[:at], None if r[at] is None else Decimal(r[at]), *r[at + 1 :]) for r in rows]
    state = [(1, a, None if a == 2 else dt.datetime(2001, 2, 1 + a), None if a == 2 else day(40 + a), [",", "CH,", None, ""][a], 5 + a % 2) for a in range(4)]
    return SimpleNamespace(
        ar_txns=spark.createDataFrame(money(txns, 5), TXN), bill_lines=spark.createDataFrame(money(lines, 4), LINE),
        payments=spark.createDataFrame([(pick.randrange(30), pick.choice([0, 5, 6])) for _ in range(25)], "trans_num long, paid_bill long"),
        bills=spark.createDataFrame([(5, day(100), True), (6, day(250), True), (7, day(260), None)], "bill_number long, due_date date, processed boolean"),
        trans_codes=spark.createDataFrame(
            [("AD1", "AD", False, False, False), ("NS", "CH", False, True, False), ("OA", "CH", None, False, True), ("CH", "CH", False, None, False), ("CA", "CA", True, False, False)]
            + ([(None, "AD", False, False, False)] if seed == 3 else []),
            "trans_code string, transaction_type string, include_in_owing boolean, is_nsf boolean, use_original_age boolean"),
        ar_codes=spark.createDataFrame([("D", True, False), ("A", False, False)], "ar_code string, deposit_paid boolean, deposit_interest boolean"),
    ), spark.createDataFrame(state, STATE)


@pytest.mark.parametrize(("seed", "notice"), [(1, True), (2, False), (3, True), (4, True)])
def test_same_as_single_features(spark, seed, notice):
    t, state = random_tables(spark, seed)
    as_of = "2001-08-01"
    ledger = led.read_ledger(t, state, as_of, notice)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    kept = lambda df, name: rows(df.where(F.col(name).isNotNull()).join(state, led.ACCOUNT, "left_semi").select(*led.ACCOUNT, name))
    sums = led.transaction_sums(ledger)
    paid = rec.before_due_payments(t.ar_txns, t.bill_lines, t.trans_codes, state)
    assert kept(sums, "paid_before_due") == kept(paid, "paid_before_due")
    unbilled = rec.unbilled_amount(t.ar_txns, t.bill_lines, t.payments, t.bills, t.trans_codes, state, as_of, notice)
    assert kept(sums, "unbilled_amount") == kept(unbilled, "unbilled_amount")
    assert kept(sums, "nsf_amount") == kept(rec.nsf_amount(t.ar_txns, t.trans_codes, state, as_of), "nsf_amount")
    assert rows(led.plan_adjustments(ledger, state)) == rows(rec.plan_adjustments(t.bill_lines, state))
    if notice:
        balance = F.lit("CH,")
        plain = rec.not_due_lines(state, t.bill_lines, t.bills, t.trans_codes, t.ar_codes, t.ar_txns, balance, as_of)
        assert kept(led.not_due_amount(ledger, state, balance), "not_due_amount") == kept(plain, "not_due_amount")
