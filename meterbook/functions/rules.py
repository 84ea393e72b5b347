"""Column rules shared by the operators.

They keep the three-valued logic of the source system: a NULL operand makes a
test unknown, and an unknown test does not select the row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Fixed value: the date the source system stores for "no date".
EMPTY_DATE = dt.date(1900, 1, 1)

MONEY = "decimal(15,2)"


def empty_date() -> Column:
    return F.lit(EMPTY_DATE)


def day(value: dt.date | str | Column) -> Column:
    """A date column from a date, an ISO text or a column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def money(column: Column) -> Column:
    return column.cast(MONEY)


def total(amount: Column, when: Column | None = None) -> Column:
    """Sum of an amount over the rows that pass ``when``; NULL if none does."""
    return money(F.sum(amount if when is None else F.when(when, amount)))


def or_zero(column: Column) -> Column:
    return money(F.coalesce(column, F.lit(0)))


def or_empty_date(column: Column) -> Column:
    return F.coalesce(column, empty_date())


def is_real_bill() -> Column:
    """Not cancelled, not a no-bill, not a cancelled-bill record, and processed."""
    return (
        ~F.col("is_cancelled") & ~F.col("no_bill") & (F.col("bill_type") != "CB") & F.col("processed")
    )


def not_expired(stop: Column, as_of) -> Column:
    """Still valid on ``as_of``: no end date, or an end date not yet over."""
    return stop.isNull() | (day(as_of) <= stop)


def active_at(start: Column, stop: Column, as_of) -> Column:
    return (day(as_of) >= start) & not_expired(stop, as_of)


def same_code(column: Column, code: str, ignore_case: bool = False) -> Column:
    """Equality as the source compares text: trailing blanks do not count."""
    left = F.rtrim(column)
    if ignore_case:
        return F.upper(left) == code.rstrip().upper()
    return left == code.rstrip()


def code_number(column: Column) -> Column:
    """A code compared as a number; text that is no number matches nothing."""
    return column.try_cast("int")


def appears_in(text: Column, listing: Column) -> Column:
    """Substring test; an empty text appears nowhere, a NULL list is unknown."""
    return (text != "") & (F.position(text, listing) > 0)


def listed(code: Column, codes: Column, exact_tokens: bool = False) -> Column:
    """Is ``code`` in a list such as ``'AB,CD,'``?

    The source looks for the text ``code + ','``, so ``AY1`` counts as listed in
    ``PAY1,``. ``exact_tokens`` compares whole entries instead.
    """
    if exact_tokens:
        return F.position(F.concat(F.lit(","), code, F.lit(",")), F.concat(F.lit(","), codes)) > 0
    return F.position(F.concat(code, F.lit(",")), codes) > 0


def comma_list(values: Column) -> Column:
    """``'a,b,'`` from an array; one NULL entry makes the whole text NULL."""
    return F.aggregate(values, F.lit(""), lambda text, item: F.concat(text, item, F.lit(",")))


def business_days_add(start: Column, days: Column, holidays: Column | None = None) -> Column:
    """The date ``days`` working days after ``start``, skipping weekends and holidays.

    ``holidays`` is an array of dates. The searched span is long enough for any
    holiday list: two calendar days per working day, the holidays, and a week.
    """
    off = F.coalesce(holidays, F.array().cast("array<date>")) if holidays is not None else None
    span = days * 2 + 7 + (F.size(off) if off is not None else F.lit(0))
    candidates = F.sequence(F.date_add(start, 1), F.date_add(start, span.cast("int")))
    working = F.filter(candidates, lambda d: F.weekday(d) < 5)
    if off is not None:
        working = F.array_except(working, off)
    return F.when(days <= 0, start).otherwise(F.element_at(working, F.greatest(days, F.lit(1)).cast("int")))
