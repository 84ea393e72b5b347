"""Joins, picks and ids: NULL rules, hot keys, order."""

import pytest
from pyspark.sql import functions as F

from meterbook.operators.ids import assign_ids, highest_id
from meterbook.operators.joins import exclude_listed, join_keyed, top_per_key


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda t: [(v is None, str(v)) for v in t])


@pytest.fixture
def skewed(spark):
    """A thousand rows: 600 of one key, 200 without a key."""
    key = F.when(F.col("id") < 600, 1).when(F.col("id") < 800, F.lit(None)).otherwise(F.col("id"))
    return spark.range(1000).select(key.alias("k"), "id").repartition(3)


@pytest.fixture
def splitting(spark):
    """Join by sorting, and split every partition over a few hundred bytes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_skewed_join_is_split_at_run_time(splitting, how):
    rows = splitting.range(0, 40000, 1, 8).select(F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("k"), "id")
    keyed = splitting.createDataFrame([(k, "v") for k in (9, 19, 5000)] + ([] if how == "left_anti" else [(1, "one")]), "k long, v string")
    joined = join_keyed(rows, keyed, ["k"], how)
    found = joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    matched = 2 if how == "left_anti" else 36002
    assert len(found) == {"left": 40000, "left_anti": 40000 - matched}.get(how, matched)


def test_outer_join_is_refused(spark, skewed):
    with pytest.raises(ValueError):
        join_keyed(skewed, skewed, ["k"], "full")


@pytest.mark.parametrize(
    "listed, kept",
    [([], ["A", "B", None]), (["A"], ["B"]), (["A", None], []), ([None], [])],
)
def test_not_in_null_rules(spark, listed, kept):
    rows = spark.createDataFrame([("A",), ("B",), (None,)], "code string")
    values = spark.createDataFrame([(v,) for v in listed], "v string")
    found = [r["code"] for r in exclude_listed(rows, "code", values, "v").collect()]
    assert sorted(found, key=str) == sorted(kept, key=str)


def test_not_in_per_key(spark):
    rows = spark.createDataFrame(
        [(1, "A"), (1, "B"), (2, "A"), (3, "A"), (3, None), (4, None)], "k int, code string"
    )
    values = spark.createDataFrame([(1, "A"), (2, None), (4, "Z")], "k int, v string")
    expected = [(1, "B"), (3, "A"), (3, None)]
    assert rows_of(exclude_listed(rows, "code", values, "v", per=["k"]), "k", "code") == expected


def test_top_per_key_limits_before_the_shuffle(spark):
    rows = spark.range(50).select((F.col("id") % 2).alias("k"), "id")
    picked = top_per_key(rows, ["k"], [F.desc("id")], 2)
    assert rows_of(picked, "k", "id") == [(0, 46), (0, 48), (1, 47), (1, 49)]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_per_key_of_many(spark):
    rows = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")
    picked = top_per_key(rows, ["k"], [F.desc("id")], 1200)
    assert picked._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert {r["id"] for r in picked.collect()} == set(range(2600, 5000))


def test_ids_are_contiguous_and_ordered(spark):
    base = spark.createDataFrame([(7,), (40,)], "pk long")
    rows = spark.range(3000).select((F.col("id") % 3).alias("account"), "id").repartition(7)
    numbered = assign_ids(rows, ["account", "id"], highest_id(base, "pk"), "pk").collect()
    ordered = sorted(numbered, key=lambda r: (r["account"], r["id"]))
    assert [r["pk"] for r in ordered] == list(range(41, 3041))


def test_ids_start_at_one_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "pk long")
    numbered = assign_ids(spark.range(3), ["id"], highest_id(empty, "pk"), "pk")
    assert sorted(r["pk"] for r in numbered.collect()) == [1, 2, 3]


def test_ids_with_no_rows(spark):
    assert assign_ids(spark.range(0), ["id"], 5, "pk").count() == 0
