from meterbook.operators.ledger import _line_hits


def test_lines_are_distinct_before_they_are_joined(spark):
    lines = spark.createDataFrame([(1, 5)] * 50 + [(2, 5)] * 50 + [(3, None)] * 3 + [(4, 6)], "account long, trans_num long")
    flagged = spark.createDataFrame(
        [(5, True, False), (None, True, False)], "trans_num long, paid boolean, linked boolean"
    ).withColumn("account", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(4).cast("long"))
    hits = _line_hits(flagged, lines)
    assert sorted(hits.collect(), key=str) == sorted([(1, 5), (2, 5), (3, None), (4, 6)], key=str)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    # the lines reach the first join as distinct pairs, not one row per line
    assert "Aggregate [account" in plan[join:]
