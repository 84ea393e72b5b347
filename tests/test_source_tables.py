"""The plans over tables stored under the billing system's own names."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from meterbook.operators.payments import payment_history
from meterbook.plans.account_summary import account_summary
from meterbook.sources.derived import AS_OF, DERIVED, Tables
from meterbook.sources.schemas import SOURCE_TABLES
from meterbook.sources.tables import SourceTables

PHONES = ["P3", "P11", "P5", "P7"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("source"))
    derived = Tables(spark, SMALL)
    for attribute, table in SourceTables.NAMES.items():
        if attribute not in DERIVED:
            continue
        frame = getattr(derived, attribute)
        columns = [
            (F.col(name) if name in frame.columns else F.lit(None).cast("string")).alias(source)
            for source, name in SOURCE_TABLES[table].items()
        ]
        others = [c for c in frame.columns if c not in SOURCE_TABLES[table].values()]
        frame.select(*columns, *others).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    return SourceTables(spark, folder)


def test_account_summary_is_the_same(spark, stored):
    mine = account_summary(stored, AS_OF, PHONES)
    other = account_summary(Tables(spark, SMALL), AS_OF, PHONES)
    assert mine.columns == other.columns
    text = [F.col(c).cast("string").alias(c) for c in mine.columns]
    assert sorted(mine.select(text).collect(), key=str) == sorted(other.select(text).collect(), key=str)
    amounts = [r["pastdueamount"] for r in mine.select("pastdueamount").collect()]
    assert min(amounts) == 0 < max(amounts)


def test_payment_history_is_the_same(spark, stored):
    derived = Tables(spark, SMALL)
    mine = payment_history(stored.payments, stored.trans_codes, 3)
    other = payment_history(derived.payments, derived.trans_codes, 3)
    text = [F.col(c).cast("string").alias(c) for c in mine.columns]
    assert sorted(mine.select(text).collect(), key=str) == sorted(other.select(text).collect(), key=str)


def test_unknown_table(stored):
    with pytest.raises(AttributeError):
        stored.nothing
