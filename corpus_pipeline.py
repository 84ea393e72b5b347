"""A training corpus from ``documents``: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; ``run`` writes each result as Parquet in the shared
folder and reads it again for the next. All but the last return the columns of ``documents``. A stage never
looks at other stages' tables, so each can be run alone on any table with those columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from meterbook.llm import exact_dedup, language_id, mixing, near_dedup, packing
from meterbook.llm.runtime import WORD, keep_listed, table, unused
from meterbook.session import materialize, release, tune

def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what has no language: a text without a letter. Without any label there is nothing to learn; texts with a letter stay."""
    model = language_id.train(docs)
    if not model[0]:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    judged = language_id.predict_language(docs, model, [F.struct(*docs.columns).alias("row")])
    return judged.where(F.col("lang_pred") != "und").select("row.*")


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def row_key(docs: DataFrame) -> Column:
    """A key of a row that sorts by id (null last) and then by 128 bits of the row's values; ``key`` is all of it as text."""
    shown = [F.col(f"`{c}`").cast("string") for c in docs.columns]
    # a value behind its length, so that no two rows give one text
    values = F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in shown])
    none = F.col("doc_id").isNull()
    key = F.concat_ws(":", F.substring(F.sha2(values, 256), 1, 32), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.struct(none.alias("none"), F.col("doc_id").alias("id"), key.alias("key"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: rows with an id first, then the smallest id, then the smallest hash of the row.

    Ids may be null or repeat, so rows go by a key of their own. Equal rows share one; the first of them stays. Rows
    without words are linked with nothing and all stay.
    """
    names = docs.columns
    (column,) = unused(docs, "_row")
    keyed = docs.select(F.col("text"), row_key(docs).alias(column))
    found = near_dedup.near_duplicates(keyed, id_column=column).where("n_shingles > 0")
    # rows without words share no key with others: their place among equal rows is not a copy
    by_key = found.groupBy(F.col("doc_id.key").alias("key")).agg(F.max("kept").alias("stays"))
    marks = materialize(by_key.where("not stays"))
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    return keep_listed(docs.where(worded), row_key(docs)["key"], marks).unionByName(docs.where(~worded)).select(*names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; good ones by their label are likelier."""
    key, copies, nth, copy = unused(docs, "_key", "_copies", "_nth", "_copy")
    own = row_key(docs)["key"]
    weights = mixing.quality_weights(table(spark, sf_dir, "labels"))
    sized = docs.select("doc_id", "source", own.alias("row"), mixing.word_count(F.col("text")).alias("size"))
    weighed = sized.join(weights, F.col("doc_id") == F.col("label_id"), "left")
    mixed = mixing.mix(weighed, F.col("size"), F.col("quality_weight"), id_column="row")
    taken = mixed.groupBy(F.col("doc_id").alias(key)).agg(F.sum("copies").alias(copies)).where(F.col(copies) > 0)
    # repeated rows share a key and its copies: the first of them stands for all
    first = docs.withColumn(key, own).join(taken, key).withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))
    return first.where(F.col(nth) == 1).withColumn(copy, each).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack(packing.token_pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has neither the trained classifier nor the vocabulary file; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        if before is not None:  # what the stage read is stored anew
            release(before)
        before = docs
    return docs
