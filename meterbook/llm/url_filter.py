"""URL rules by a sort-merge range join over reversed-host keys.

A host becomes the key of its labels in reverse, each closed by a dot: ``www.example.com`` is
``com.example.www.``. A rule's host and all its subdomains are then exactly the keys that start with the
rule's key, one interval of the sorted keys, and the intervals of any two rules are nested or apart.
Rules and urls are sorted together. Behind a rule's key the sweep holds that rule's stack: the rule
and every rule around it. A url takes the stack of the last rule at or before its key; a rule that
holds the url's key started no later and so is on that stack. Of the stack, the rules whose interval holds
the key and whose path starts the url's path fit, and the longest wins.

Keys of one top label may be most of the rows, so each label's urls are dealt out over ``salts`` sorted runs,
and each run gets the rules of that label. Only urls and rules move, never pages.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and gets
``default``. A url without a path has an empty path, which no rule path starts. Repeated urls and ids are judged row
by row; of equal rules the first by action counts; a rule with null host or path is ignored; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterbook.llm.runtime import parts

RULES = "host string, path string, action string"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^(.*?)://([^/?#]*)([^?#]*)", 2)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    path = F.regexp_extract(url, r"(?s)^(.*?)://([^/?#]*)([^?#]*)", 3)
    return F.coalesce(F.translate(found, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def reversed_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    )


def rule_stacks(rules: DataFrame) -> DataFrame:
    """One row per rule key: the rules at the key and around it, as the sweep's stack."""
    rules = (
        rules.where("host is not null and path is not null")
        .groupBy("host", "path").agg(F.min("action").alias("action"))
        .withColumn("key", reversed_key(F.col("host")))
    )
    # a key's ancestors are its own leading labels: as many rows per key as it has labels, no comparison of pairs
    labels = F.split(F.col("key"), r"\.")
    heads = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
    )
    keys = rules.select("key").distinct().withColumn("around", F.explode(heads))
    held = rules.select(
        F.col("key").alias("around"),
        F.struct("key", "path", F.concat("host", "path").alias("rule"), "action").alias("entry"),
    )
    return keys.join(held, "around").groupBy("key").agg(F.collect_list("entry").alias("stack"))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", salts: int | None = None
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row; columns of those names are replaced."""
    spark = pages.sparkSession
    salts = salts or parts(spark)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = split_url(F.col(url))
    urls = pages.select(F.struct(*kept).alias("row"), host.alias("host"), path.alias("path"))
    urls = urls.select(
        reversed_key(F.col("host")).alias("key"),
        F.lit(1).alias("kind"),
        F.pmod(F.xxhash64("row"), F.lit(salts)).alias("salt"),
        "row", "host", "path",
    )
    starts = rule_stacks(rules).select("key", "stack").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    # last by name: nulls fill what a url has and a rule lacks
    both = urls.unionByName(starts.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    both = both.withColumn("top", F.substring_index("key", ".", 1))
    sweep = Window.partitionBy("top", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fits = F.filter(
        F.coalesce("stack", F.array()),
        lambda r: F.col("key").startswith(r["key"]) & F.col("path").startswith(r["path"]),
    )
    best = F.array_max(
        F.transform(
            fits,
            lambda r: F.struct(
                F.length(r["rule"]).alias("n"), F.length(r["key"]).alias("k"), r["rule"].alias("rule"), r["action"].alias("action")
            ),
        )
    )
    return swept.withColumn("best", best).select(
        *[F.col("row")[c].alias(c) for c in kept],
        "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def rules_frame(spark, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULES)
