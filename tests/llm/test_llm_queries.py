"""The registered queries against their SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from meterbook.llm.oracles import SQL
from meterbook.llm.queries import QUERIES
from meterbook_checks.compare import connect, differences


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    assert differences(frame.columns, frame.collect(), duck, SQL[name]) == ""


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
