"""Mix sources to target weights by weighted sampling with exponential keys.

Targets. Sources in code point order, null last, take the weights in turn and share ``share`` of all words;
a target stops at ``most`` times its source's words and the excess goes to the others by weight. That is the water level L of
``sum(min(L * weight, most * size)) = share * total``. Each step fixes the sources above the level and solves for
the rest; levels only rise, so it ends when no further source passes its limit. Only sums reach the driver.

Documents. A target of e + f epochs takes every document e times, then a fraction: document i with weight w draws
the key -ln(u) / w from a hash of its id, and the smallest keys are taken while their words fit the rest of the
target; the document that crosses it is taken if that comes nearer. Keys fall into ordered bins of about ``bin_rows`` rows.
Bin sums find the one bin of each source that the target crosses; bins below are taken whole, and only the rows of the
crossing bin are sorted. No source is ever one task.

Defined cases: a null or blank text has size 0 and takes 0 words; a null weight, or one not above 0, counts as 1; equal keys
go by id, then size; repeated rows are documents of their own; an empty table gives an empty result;
a source without words has target 0. Other columns stay; columns named as the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterbook.llm.runtime import WORD
from meterbook.operators.ids import assign_ids
from meterbook.session import materialize

WEIGHTS, SHARE, MOST, BIN_ROWS = (3.0, 1.0, 2.0), 1.5, 2, 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def unit(id_column: Column, seed: int) -> Column:
    """A number in (0, 1) that an id and a seed fix, from 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: ``source_size``, ``docs``, ``weight`` and ``target``, written once."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranked = assign_ids(
        totals.withColumn("_null", F.col("source").isNull()).withColumn("_s", F.coalesce("source", F.lit(""))),
        ["_null", "_s"], -1, "place",
    )
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ranked = materialize(ranked.select("source", "source_size", "docs", turn.alias("weight")))
    limit = F.col("source_size") * F.lit(float(most))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        over = limit < F.lit(level) * F.col("weight")
        row = ranked.agg(
            F.sum(F.when(over, limit)).alias("fixed"), F.sum(F.when(~over, F.col("weight"))).alias("open"),
            F.count(F.when(over, 1)).alias("n"),
        ).first()
        if row.n == capped or not row.open:
            break
        capped, level = row.n, (total - (row.fixed or 0.0)) / row.open
    return ranked.withColumn("target", F.least(F.lit(level) * F.col("weight"), limit))


def mix(
    docs: DataFrame, size: Column, weight: Column, seed: int = 7, id_column: str = "doc_id", source: str = "source",
    weights=WEIGHTS, share: float = SHARE, most: int = MOST, bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """One row per document: id, ``size``, ``source``, ``source_size``, ``target`` and ``taken``."""
    sizes = materialize(
        docs.select(
            F.col(id_column).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"),
            F.when(weight > 0, weight.cast("double")).otherwise(1.0).alias("w"),
        )
    )
    targets = source_targets(sizes, weights, share, most)
    plan = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("epochs"),
        F.ceil(F.col("docs") / F.lit(bin_rows)).alias("bins"),
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    key = -F.log(unit(F.col("doc_id"), seed)) / F.col("w")
    same = F.col("s.source").eqNullSafe(F.col("p.source"))
    # 1 - exp(-key) rises with the key and spreads keys of weight 1 evenly
    keyed = materialize(
        sizes.alias("s").join(plan.alias("p"), same)
        .select("s.*", "source_size", "target", "epochs", "rest", "bins", key.alias("key"))
        .withColumn("bin", F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("bins")), F.col("bins") - 1))
    )
    bins = keyed.groupBy("source", "bin", "rest").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bin")
    cross = (
        bins.withColumn("through", F.sum("words").over(upto))
        .where(F.col("through") > F.col("rest"))
        .groupBy("source").agg(F.min(F.struct("bin", (F.col("through") - F.col("words")).alias("before"))).alias("at"))
        .select(F.col("source").alias("cs"), F.col("at.bin").alias("cross_bin"), F.col("at.before").alias("before"))
    )
    # written, so that the planner sees how small it is and need not deal the documents by source
    placed = keyed.join(materialize(cross), F.col("source").eqNullSafe(F.col("cs")), "left").drop("cs")
    inside = F.col("bin").eqNullSafe(F.col("cross_bin"))
    in_order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    sorted_rows = placed.where(inside).withColumn("end", F.col("before") + F.sum("size").over(in_order))
    # taken if the end of the document is no further from the target than its start
    near = (2 * F.col("end") - F.col("size")) <= 2 * F.col("rest")
    picked = sorted_rows.withColumn("extra", F.when(near, 1).otherwise(0)).drop("end")
    whole = placed.where(~inside).withColumn(
        "extra", F.when(F.col("cross_bin").isNull() | (F.col("bin") < F.col("cross_bin")), 1).otherwise(0)
    )
    rows = whole.unionByName(picked)
    return rows.select(
        "doc_id", "size", "source", "source_size", "target",
        # a source whose target is a whole number of epochs has no fractional part
        (F.col("epochs") + F.when(F.col("rest") > 0, F.col("extra")).otherwise(0)).cast("bigint").alias("copies"),
    ).withColumn("taken", F.col("copies") * F.col("size"))


def quality_weights(labels: DataFrame) -> DataFrame:
    """Sampling weight by quality label: 2 for good, 0.5 for bad; several labels of an id give their mean."""
    mean = F.avg(F.col("quality").cast("double"))
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.pow(F.lit(4.0), mean - 0.5).alias("quality_weight")
    )
