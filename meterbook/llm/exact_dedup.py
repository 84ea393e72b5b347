"""Exact duplicates by content-defined chunk recipes.

A normalised text is cut where its own content says so: a chunk has at least ``LEAST`` and at most ``MOST``
characters and ends behind a cut mark, so texts that share a passage share its chunks. Every text becomes a recipe,
the ordered list of its chunks' identifiers (128 bits of a SHA-256), in the task that reads it. Chunk texts move once
each: equal chunks meet in the tasks' partial aggregation, and what is left is compared per identifier. An identifier
that two different chunks claim stops the job, so equal recipes are equal texts. From then on only
recipes move: equal ordered lists form a group, and the smallest id stays.

Defined cases: null counts as empty and empty texts are equal; a run of white space equals one space, also at the
ends; repeated rows of an id and text give as many rows, of which one is kept; a null id sorts behind all ids;
an empty table gives an empty result. Columns beside id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterbook.llm.runtime import SPACE, keep_listed
from meterbook.session import materialize

#: Characters of a chunk. A cut mark is a space behind one of eight letters and in front of one of eight.
LEAST, MOST = 512, 8192
CUT = r"[aeinorst] (?=[abcdilot])"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def chunks(text: Column) -> Column:
    """Chunks that, joined, are the text; none for an empty text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{LEAST},{MOST}}}?{CUT}|.{{1,{MOST}}}"), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.unhex(F.substring(F.sha2(chunk, 256), 1, 32))


def chunk_identifiers(docs: DataFrame, text: str = "text") -> DataFrame:
    """The chunk dictionary's check: identifiers with the number of different chunks that have them."""
    found = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk"))
    different = found.select(identifier(F.col("chunk")).alias("chunk_id"), "chunk").distinct()
    return different.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("texts"))


def verify_identifiers(docs: DataFrame, text: str = "text") -> int:
    """The number of different chunks; an identifier of two chunks is an error."""
    row = chunk_identifiers(docs, text).agg(
        F.count(F.lit(1)).alias("n"), F.max("texts").alias("most")
    ).first()
    if (row.most or 1) > 1:
        raise RuntimeError("two different chunks have one identifier: use more bits")
    return row.n


def recipes(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its ordered chunk identifiers and the SHA-256 of its normalised text."""
    plain = docs.select(F.col(id_column).alias("doc_id"), normalised(F.col(text)).alias("t"))
    return plain.select(
        "doc_id",
        F.transform(chunks(F.col("t")), identifier).alias("recipe"),
        F.sha2(F.col("t"), 256).alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, a row for each row of ``docs``."""
    verify_identifiers(docs, text)
    held = materialize(recipes(docs, id_column, text))
    # equal rows first: one row per id and recipe is left, however often it repeats
    single = held.groupBy("doc_id", "recipe", "text_sha256").agg(F.count(F.lit(1)).alias("rows"))
    groups = single.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    # most rows are alone in their group and need no partner
    shared = groups.where("group_size > 1").withColumnRenamed("recipe", "shared")
    joined = single.join(shared, F.col("recipe") == F.col("shared"), "left")
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    keep = F.when(F.col("shared").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return each.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def _row_key(id_column: Column, text_sha: Column) -> Column:
    """One text for an id, null too, and a text."""
    return F.concat_ws(":", text_sha, F.coalesce(id_column.cast("string"), F.lit("")), id_column.isNull().cast("string"))


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, all columns; a repeated row of a kept id stays once."""
    found = exact_duplicates(docs, id_column, text)
    each = found.groupBy(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("key")).agg(F.max("kept").alias("stays"))
    marks = materialize(each.where("not stays"))
    return keep_listed(docs, _row_key(F.col(id_column), F.sha2(normalised(F.col(text)), 256)), marks)
