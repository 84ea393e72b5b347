"""Every registered query against its SQL counterpart, on whole tables."""

from functools import partial

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from meterbook.operators import ledger
from meterbook.plans import past_due
from meterbook.queries import QUERIES as NAMES, run
from meterbook.session import tune
from meterbook.sources import derived
from meterbook_checks.compare import connect, differences
from meterbook_checks.oracles import oracle_texts

QUERIES, SQL = {name: partial(run, name) for name in NAMES}, oracle_texts()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    assert differences(frame.columns, frame.collect(), duck, SQL[name]) == ""


def test_entry(spark):
    frame = entry.entry(spark)
    assert len(frame.columns) == 40
    assert frame.count() == 155  # 150 customers' own accounts, five of them shared with a second customer


def jobs(spark):
    return spark.sparkContext._jsc.sc().statusTracker().getJobIdsForGroup(None)


@pytest.mark.parametrize(("name", "most"), [("account_summary", 2), ("past_due", 2), ("ivr_status", 2), ("amount_due_before_due_date", 0)])
def test_building_starts_only_the_written_tables(spark, monkeypatch, name, most):
    """With the writes left out no job runs, but the look at the notice codes."""
    for module in (derived, ledger, past_due):
        monkeypatch.setattr(module, "materialize", lambda df: df)
    tables = derived.Tables(tune(spark), SMALL)
    for table in derived.DRIVER_TABLES:  # Spark reads the files' schemas
        getattr(tables, table)
    before = set(jobs(spark))
    NAMES[name](tables)
    assert len(set(jobs(spark)) - before) <= most


def test_building_a_promotion_starts_few_jobs(spark):
    before = set(jobs(spark))
    QUERIES["promote_contacts"](spark, SMALL)
    assert len(set(jobs(spark)) - before) <= 40
