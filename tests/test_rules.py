"""Column rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterbook.functions import rules
from meterbook.operators.accounts import ivr_rule, parsed_date
from meterbook.operators.enrolments import balance_rule
from meterbook.operators.receivables import due_before_due_date
from meterbook.sources.tables import append_rows, empty_like, from_source, inline_table, to_source


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "code, codes, loose, exact",
    [
        ("PAY1", "PAY1,", True, True),
        ("AY1", "PAY1,", True, False),  # the source looks for text, not entries
        ("X", "PAY1,", False, False),
        ("", "A,", True, False),
        ("A", None, None, None),
        (None, "A,", None, None),
    ],
)
def test_listed(spark, code, codes, loose, exact):
    a, b = F.lit(code).cast("string"), F.lit(codes).cast("string")
    assert value(spark, rules.listed(a, b)) is loose
    assert value(spark, rules.listed(a, b, exact_tokens=True)) is exact


def test_blank_text_appears_nowhere(spark):
    assert value(spark, rules.appears_in(F.lit(""), F.lit("CC,"))) is False
    assert value(spark, rules.appears_in(F.lit("C"), F.lit("CC,"))) is True


def test_comma_list_with_a_null_is_null(spark):
    assert value(spark, rules.comma_list(F.array(F.lit("a"), F.lit("b")))) == "a,b,"
    assert value(spark, rules.comma_list(F.array(F.lit("a"), F.lit(None).cast("string")))) is None
    assert value(spark, rules.comma_list(F.array().cast("array<string>"))) == ""


def test_same_code_ignores_trailing_blanks(spark):
    assert value(spark, rules.same_code(F.lit("  "), " ")) is True
    assert value(spark, rules.same_code(F.lit("BF "), "BF")) is True
    assert value(spark, rules.same_code(F.lit("bf"), "BF")) is False
    assert value(spark, rules.same_code(F.lit("bf"), "BF", ignore_case=True)) is True


def test_code_number(spark):
    assert value(spark, rules.code_number(F.lit("02"))) == 2
    assert value(spark, rules.code_number(F.lit("W"))) is None


@pytest.mark.parametrize(
    "stop, active", [(None, True), ("2001-07-15", True), ("2001-07-14", False), ("2002-01-01", True)]
)
def test_last_day_still_counts(spark, stop, active):
    start, end = F.lit("2000-01-01").cast("date"), F.lit(stop).cast("date")
    assert value(spark, rules.active_at(start, end, "2001-07-15")) is active


def _by_hand(start, days, holidays):
    day = start
    while days > 0:
        day += dt.timedelta(days=1)
        if day.weekday() < 5 and day not in holidays:
            days -= 1
    return day


@pytest.mark.parametrize("days", [0, 1, 4, 5, 11, 30])
@pytest.mark.parametrize("offset", range(7))
def test_business_days(spark, days, offset):
    start = dt.date(2001, 7, 2) + dt.timedelta(days=offset)
    holidays = [dt.date(2001, 7, 4), dt.date(2001, 7, 16), dt.date(2001, 7, 14)]
    off = F.array(*[F.lit(h) for h in holidays])
    assert value(spark, rules.business_days_add(F.lit(start), F.lit(days), off)) == _by_hand(start, days, holidays)
    assert value(spark, rules.business_days_add(F.lit(start), F.lit(days))) == _by_hand(start, days, [])


@pytest.mark.parametrize(
    "status, code, owed, v2, v1",
    [
        ("AC", "PD", 0, 1, 1),
        ("FI", "PD", 0, 2, 2),
        ("AC", "PD", 5, 4, 3),  # both settings hold the same code
        ("AC", "", 5, 5, 5),
        ("AC", None, 5, 5, 5),
        (None, "PD", 5, 5, 5),
    ],
)
def test_ivr_with_equal_codes(spark, status, code, owed, v2, v1):
    args = (F.lit(status).cast("string"), F.lit(code).cast("string"), F.lit(owed), F.lit("PD"), F.lit("PD"))
    assert value(spark, ivr_rule(*args)) == v2
    assert value(spark, ivr_rule(*args, v1=True)) == v1


def test_balance_rule(spark):
    rows = [
        ("no plan", None, None, None, 10, 7, -2, 10, 0),
        ("plan balance", "EN", "E", True, 10, 7, -2, 7, -2),
        ("receivables", "EN", "E", False, 10, 7, -2, 10, 0),
        ("class V", "VA", "V", True, 10, 7, -2, 0, 0),
        ("no setting", "V2", "V", None, 10, 7, -2, 0, 0),
        ("no balance row", "EN", "E", True, 10, None, None, 0, 0),
    ]
    names = "name string, plan_type string, plan_class string, use_plan_balance boolean, ar_balance int, "
    frame = spark.createDataFrame(rows, names + "plan_balance int, credits int, balance int, credit int")
    for r in balance_rule(frame).collect():
        assert (r["current_balance"], r["plan_credit"]) == (r["balance"], r["credit"]), r["name"]


def test_due_before_due_date_has_a_floor(spark):
    def due(amount, paid, bill, pending):
        columns = [F.lit(v).cast("decimal(15,2)") for v in (amount, paid)]
        return value(spark, due_before_due_date(*columns, F.lit(bill), F.lit(pending).cast("decimal(15,2)")))

    assert due(100, -30, True, -5) == 65
    assert due(100, -300, True, -5) == -5
    assert due(None, None, False, -5) == -5
    assert due(100, None, True, None) == 100


def test_bad_date_text_gives_null(spark):
    assert value(spark, parsed_date(F.lit("2001-02-30"))) is None
    assert value(spark, parsed_date(F.lit("2001-02-28"))) == dt.date(2001, 2, 28)


def test_source_names_round_trip(spark):
    raw = spark.createDataFrame(
        [("7", "9", "AR1", 12.5, "kept")],
        "C_CUSTOMER string, C_ACCOUNT string, c_arcode string, Y_CURRENTBALANCE double, X_OTHER string",
    )
    frame = from_source(raw, "BIF040")
    assert frame.columns == ["customer", "account", "ar_code", "current_balance", "X_OTHER"]
    assert dict(frame.dtypes)["current_balance"] == "decimal(15,2)"
    assert to_source(frame, "BIF040").columns == [
        "C_CUSTOMER", "C_ACCOUNT", "C_ARCODE", "Y_CURRENTBALANCE", "X_OTHER",
    ]
    with pytest.raises(ValueError, match="C_ARCODE"):
        from_source(raw.drop("c_arcode"), "BIF040")


def test_append_fills_with_null_and_keeps_types(spark):
    base = spark.createDataFrame([(1, "a")], "id long, note string")
    both = append_rows(base, spark.createDataFrame([(2,)], "id int"))
    assert both.schema.fields[0].dataType == base.schema.fields[0].dataType
    assert sorted(tuple(r) for r in both.collect()) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        append_rows(base, spark.createDataFrame([(2,)], "other int"))
    assert empty_like(base).count() == 0
    assert inline_table(spark, ["a", "b"], [(1, "x"), (2, None)]).count() == 2
