"""The operators over the given tables, as registered, and their SQL where SQL has the means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterbook.llm import (
    conversations, exact_dedup, language_id, line_dedup, lm_scoring, mixing, near_dedup, packing, phrases, privacy,
    token_counts, topk, url_filter,
)
from meterbook.llm.runtime import fold, table
from meterbook.session import materialize, tune


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language_id.train(docs.where(~held_out))
    return language_id.predict_language(docs, model, ["doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out")])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(tune(spark), sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    return line_dedup.clean_lines(docs, line_dedup.build_index(docs)).drop("kept_text")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "source", "text")
    weights = mixing.quality_weights(table(spark, sf_dir, "labels"))
    weighed = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")).join(
        weights, F.col("doc_id") == F.col("label_id"), "left"
    )
    mixed = mixing.mix(weighed, F.col("size"), F.col("quality_weight"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(tune(spark), sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(tune(spark), sf_dir, "documents")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(tune(spark), sf_dir, "documents"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(tune(spark), sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


#: The rules of the contract.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(tune(spark), sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.rules_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 1
    return lm_scoring.lm_scores(docs, ~held_out, held_out)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(tune(spark), sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    terms = materialize(privacy.disclosing_terms(docs))
    return privacy.span_digest(privacy.find_spans(docs, terms))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(tune(spark), sf_dir, "conversations")
    return conversations.repair_digest(rows, conversations.damage(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_exact_dedup, op3_line_dedup, op4_mixing, op5_minhash_near_dedup,
        op6_best_fit_packing, op7_token_counts, op8_exact_topk, op9_url_filter, op10_lm_scoring, op11_phrase_mining,
        op12_pii, op13_conversation_repair,
    )
}
