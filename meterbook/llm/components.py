"""Connected components of a link table, without gathering it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterbook.session import materialize, release


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the smallest node it can reach, for every node of a link.

    Each step takes the smallest label among the neighbours and then the label's own label, so distances to
    the smallest node about halve; every step is written, so a lost executor costs one step.
    """
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = materialize(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("v"), "label"), "v")
            .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        moved = materialize(
            step.join(far, "label").select("node", "old", F.least("label", "jump").alias("label"))
        )
        changed = moved.where(F.col("old") != F.col("label")).limit(1).count()
        release(labels)
        labels = moved
        if not changed:
            release(both)
            return labels.select("node", "label")
