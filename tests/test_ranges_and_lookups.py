"""Interval joins, insisting look-ups, join-back checks, requests by account, date texts, ordered and bucketed output, code forms."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from meterbook.operators import accounts as acc, publish, ranges, receivables as rec, services as srv, transactions as txn
from meterbook.operators.joins import scalar_lookup
from meterbook.sources.tables import canonical_codes


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def day(n):
    return dt.date(2000, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("seed", range(4))
def test_range_join(spark, seed):
    pick = random.Random(seed)
    points = [(i, None if i == 5 else day(pick.randrange(-50, 700)), i % 3) for i in range(60)]
    spans = []
    for k in range(80):
        first = None if k == 7 else day(pick.randrange(-900, 800))
        last = None if k % 6 == 0 or first is None else first + dt.timedelta(days=pick.choice([-3, 0, 1, 40, 900]))
        spans.append((k, first, last, k % 3))
    p = spark.createDataFrame(points, "i int, at date, g int")
    s = spark.createDataFrame(spans, "k int, first date, last date, g int")
    got = ranges.range_join(p, "at", s.withColumnRenamed("g", "h"), "first", "last")
    want = [(i, k) for i, at, _ in points for k, a, b, _ in spans if at and a and a <= at and (b is None or at <= b)]
    assert rows(got.select("i", "k")) == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    grouped = ranges.range_join(p, "at", s, "first", "last", on=["g"])
    want = [(i, k) for i, at, g in points for k, a, b, h in spans if g == h and at and a and a <= at and (b is None or at <= b)]
    assert rows(grouped.select("i", "k")) == sorted(want, key=repr)
    assert ranges.range_join(p.limit(0), "at", s.drop("g"), "first", "last").count() == 0


def test_blocks_cover_each_day_once(spark):
    spans = [(a, b) for a in range(0, 40) for b in range(a, 40)]
    frame = spark.createDataFrame(spans, "a long, b long").withColumn("blocks", ranges.blocks_of(F.col("a"), F.col("b"), F.lit(6)))
    for a, b, blocks in frame.collect():
        held = [d for x in blocks for d in range(x.block << x.level, (x.block + 1) << x.level)]
        assert sorted(held) == list(range(a, b + 1)) and len(blocks) <= 12


def test_scalar_lookup_insists_on_one_row(spark):
    asked = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    table = spark.createDataFrame([(1, "a"), (3, "x"), (3, "y"), (None, "n"), (None, "m")], "k int, v string")
    # a key that nobody asks for may stand twice
    assert rows(scalar_lookup(asked, table, ["k"], "v", "found")) == sorted([(1, "a"), (2, None), (None, None)], key=repr)
    twice = table.unionByName(spark.createDataFrame([(1, "b")], "k int, v string"))
    with pytest.raises(Exception, match="more than one row of found for k 1"):
        scalar_lookup(asked, twice, ["k"], "v", "found").collect()
    assert rows(scalar_lookup(asked, twice, ["k"], "v", "found", unique=False).where("k = 1")) == [(1, "a")]


def test_duplicated_bill_number_stops_unbilled_amount(spark):
    from decimal import Decimal

    txns = spark.createDataFrame(
        [(11, 1, 1, 5, "CH", Decimal(9), dt.date(2001, 6, 1), False, None, 0)],
        "trans_num long, customer long, account long, bill_number long, trans_code string, amount decimal(15,2), trans_date date, "
        "is_statement boolean, aging_date date, linked_trans_num long")
    lines = spark.createDataFrame([], "account long, trans_num long")
    payments = spark.createDataFrame([(11, 5)], "trans_num long, paid_bill long")
    codes = spark.createDataFrame([("CH", False)], "trans_code string, include_in_owing boolean")
    lists = spark.createDataFrame([(1, 1, ",")], "customer long, account long, exclude_codes string")
    one = spark.createDataFrame([(5, dt.date(2001, 5, 1))], "bill_number long, due_date date")
    run = lambda bills, **more: rec.unbilled_amount(txns, lines, payments, bills, codes, lists, "2001-07-01", True, **more)
    assert rows(run(one, unique=True)) == rows(run(one)) == [(1, 1, Decimal(9))]
    two = one.unionByName(spark.createDataFrame([(5, dt.date(2001, 5, 2))], "bill_number long, due_date date"))
    with pytest.raises(Exception, match="more than one row of due_date for bill_number 5"):
        run(two, unique=True).collect()
    assert rows(run(two)) == [(1, 1, Decimal(9))]


def test_join_back_above_the_mark(spark):
    staged = spark.createDataFrame([(1,), (2,)], "g long")
    table = spark.createDataFrame([(5, 1), (11, 1), (12, 2)], "pk long, g long")
    mark = F.lit(10)
    assert rows(txn.reconcile_above(staged, table, "g", "pk", mark)) == [(2, 2, 2, True)]
    # a staged key that stands twice fans out
    fanned = staged.unionByName(staged.limit(1))
    more = table.unionByName(spark.createDataFrame([(13, 1)], "pk long, g long"))
    assert txn.reconcile_above(fanned, more, "g", "pk", mark).first().ok is False
    # a row that was lost
    assert txn.reconcile_above(staged, table.where("pk <> 12"), "g", "pk", mark).first().ok is False
    assert rows(txn.reconcile_above(staged.limit(0), table.where("pk = 5"), "g", "pk", mark)) == [(0, 0, 0, True)]


def test_requests_by_account(spark):
    when = dt.date
    accounts = spark.createDataFrame(
        [(1, 10, "AC", when(2000, 1, 1)), (2, 20, "FI", when(2001, 1, 1)), (3, 20, "AC", when(2000, 1, 1)), (3, 20, "FI", when(1999, 1, 1)),
         (4, 30, "FI", when(2000, 1, 1)), (5, 30, "FI", when(2001, 1, 1))],
        "customer long, account long, account_status string, effective_date date")
    result = spark.createDataFrame([(1, 10, "a"), (3, 20, "b"), (2, 20, "no")], "customer long, account long, note string")
    asked = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 99), (5, None)], "request_id int, account long")
    got = acc.account_lookup(asked, accounts, result)
    assert rows(got) == sorted([(1, 10, 1, 1, "a"), (2, 20, 3, 2, "b"), (3, 30, 5, 2, None), (4, 99, 0, 0, ""), (5, None, 0, 0, "")], key=repr)


def test_date_forms(spark):
    same = ["2024-01-31", "2024-1-31", "20240131", "1/31/2024", "01/31/2024", "1-31-2024", "1.31.2024", "2024/01/31", "Jan 31, 2024", "Jan 31 2024",
            "31 Jan 2024", " 2024-01-31 ", "2024-01-31 10:11", "20240131 10:11:12.5", "1/31/2024 1:02 PM"]
    wrong = ["2024-13-01", "31/31/2024", "soon", "2024", "20241301", "2024-02-30"]
    frame = spark.createDataFrame([(t,) for t in [*same, *wrong, "", "  ", None]], "t string")
    got = {r.t: (r.d, r.ok) for r in frame.select("t", acc.request_date(F.col("t")).alias("d"), acc.is_readable(F.col("t")).alias("ok")).collect()}
    assert {t: got[t] for t in same} == dict.fromkeys(same, (dt.date(2024, 1, 31), True))
    assert {t: got[t] for t in wrong} == dict.fromkeys(wrong, (None, False))
    assert got[""] == got["  "] == (dt.date(1900, 1, 1), True) and got[None] == (None, True)


def test_files_in_order(spark, tmp_path):
    pick = random.Random(1)
    made = [(pick.randrange(30), day(pick.randrange(300)), i) for i in range(2000)]
    frame = spark.createDataFrame(made, "account int, at date, i int").repartition(5)
    publish.write_ordered(frame, f"{tmp_path}/t", ["account", F.desc("at"), "i"])
    read = []
    for name in sorted(n for n in os.listdir(f"{tmp_path}/t") if n.endswith(".parquet")):
        import pyarrow.parquet as pq

        read += [tuple(r.values()) for r in pq.read_table(f"{tmp_path}/t/{name}").to_pylist()]
    assert read == sorted(made, key=lambda r: (r[0], -r[1].toordinal(), r[2]))


def test_bucketed_tables_meet_without_an_exchange(spark, tmp_path):
    targets = spark.createDataFrame([(i,) for i in range(0, 50, 2)], "account long")
    txns = spark.createDataFrame([(i % 50, i) for i in range(500)], "account long, amount long").withColumn("amount", F.col("amount").cast("decimal(15,2)"))
    names = [f"bucketed_{os.getpid()}_{n}" for n in ("targets", "txns")]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = publish.stage_bucketed(targets, names[0], f"{tmp_path}/a", ["account"], 4)
        b = publish.stage_bucketed(txns, names[1], f"{tmp_path}/b", ["account"], 4)
        got = srv.staged_receivables(a, b)
        assert "Exchange" not in plan(got) and "Exchange" in plan(srv.staged_receivables(targets, txns))
        assert rows(got) == rows(srv.staged_receivables(targets, txns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        for name in names:
            spark.sql(f"drop table if exists {name}")


def test_code_forms(spark):
    frame = spark.createDataFrame([("ab ", "x ", 1), ("AB", "x", 2), (None, None, 3)], "trans_code string, note string, plan_type int")
    assert rows(canonical_codes(frame)) == sorted([("AB", "x ", 1), ("AB", "x", 2), (None, None, 3)], key=repr)
    assert rows(canonical_codes(frame, ignore_case=False).select("trans_code")) == sorted([("ab",), ("AB",), (None,)], key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_last_payment_against_the_row_by_row_rule(spark, seed):
    """The source's loop: newest first, while the batch stays that of the first."""
    from decimal import Decimal

    from meterbook.operators.payments import last_payment

    pick = random.Random(seed)
    made = []
    for n in range(400):
        made.append((n, 1, pick.randrange(25), Decimal(-pick.randrange(1, 9)), pick.choice([-1, 1, 1, 2]), day(pick.randrange(4)),
                     pick.choice(["A", "A", "A", " "]), "PAY", pick.random() < 0.9, pick.random() < 0.05))
    schema = ("trans_num long, customer long, account long, amount decimal(15,2), batch_id long, pay_date date, ar_code string, trans_code string, "
              "processed boolean, is_deleted boolean")
    batches = spark.createDataFrame([(-1, "CA"), (1, "CA"), (2, "CA" if seed else "AD")], "batch_id long, transaction_type string")
    cash = {-1, 1} | ({2} if seed else set())
    want = []
    for account in range(25):
        settled = [r for r in made if r[2] == account and r[3] < 0 and r[8] and not r[9]]
        rows_ = sorted((r for r in settled if r[4] in cash and r[6].strip()), key=lambda r: (r[5], r[0]), reverse=True)
        if not rows_:
            continue
        first = rows_[0]
        amount = Decimal(0)
        if first[4] == -1:
            amount = sum(r[3] for r in settled if r[5] == first[5])
        else:
            for r in rows_:
                if r[4] != first[4]:
                    break
                amount += r[3]
        want.append((1, account, amount, first[5]))
    assert rows(last_payment(spark.createDataFrame(made, schema), batches)) == sorted(want, key=repr)
