"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and the n-grams of 1 to 3 characters fall into 2^15 buckets.
The classifier is fitted on at most ``SAMPLE_DOCS`` whole labelled documents per language, those with the smallest
hash of their id, and on every label there is. Tasks count buckets per language and the counts are summed.
The matrix of log probabilities (2^15 rows, a column per language) is broadcast in blocks of ``BLOCK`` languages; driver
and workers hold one block at a time, so memory does not grow with the labels, but the work does.
Every whole text is scored in slices: each n-gram's row is looked up and the rows of a document are summed, block after
block; of each document the best label and the sum of all likelihoods relative to it go on. The score is the
posterior probability of the best language at equal priors, over all languages.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was
learned; rows with a null label or id are not learned from; repeated rows are predicted each; other columns stay
unread; equal posteriors go to the label that sorts first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterbook.llm.runtime import small_batches
from meterbook.session import materialize, release

BITS, ORDERS, SAMPLE_DOCS, BLOCK, SMOOTH = 15, (1, 2, 3), 2000, 64, 0.5
#: Entries of look-up results held at a time.
SLICE = 1 << 21
_LETTERS: list[np.ndarray] = []


def letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000))
    out = _LETTERS[0][np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):
        found, place = np.unique(points[high], return_inverse=True)
        out[high] = np.fromiter((chr(c).isalpha() for c in found.tolist()), bool, len(found))[place]
    return out


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points with spaces for all but letters, where each text begins, and how many letters each has."""
    lowered = [t.lower() if t else "" for t in texts]
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)))])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = letters(points)
    total = np.concatenate([[0], np.cumsum(kind)])
    return np.where(kind, points, np.uint32(32)), edges, total[edges[1:]] - total[edges[:-1]]


def grams(points: np.ndarray, edges: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of n-grams and the text each is from, slice by slice; ``width`` entries go with each bucket."""
    step = max(4096, SLICE // width)
    for a in range(0, len(points), step):
        own = points[a : a + step + max(ORDERS) - 1]
        doc = np.searchsorted(edges, np.arange(a, a + len(own)), "right") - 1
        value = np.zeros(len(own), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            size = min(step, len(own) - n + 1)
            if size <= 0:
                break
            value = value[: len(own) - n + 1] * np.uint32(0x9E3779B1) + own[n - 1 :]
            if n not in ORDERS:
                continue
            inside = (doc[:size] == doc[n - 1 : n - 1 + size]) & ((own[:size] != 32) | (own[n - 1 : n - 1 + size] != 32))
            mixed = value[:size] ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            yield (mixed >> np.uint32(32 - BITS))[inside], doc[:size][inside]


def _count(langs: list[str], block: int):
    place = {x: i for i, x in enumerate(langs)}

    def count(batches):
        # counts of at most a block of languages are held; they go out when others come, and are summed later
        held, total = np.zeros(0, np.int64), np.zeros((0, 1 << BITS), np.int64)
        for batch in batches:
            own = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            texts, met = batch.column(1).to_pylist(), np.unique(own)
            for k in range(0, len(met), block):
                wanted = met[k : k + block]
                union = np.union1d(held, wanted)
                if len(union) > block:
                    yield _counted(held, total)
                    held, total = wanted, np.zeros((len(wanted), 1 << BITS), np.int64)
                elif len(union) > len(held):
                    grown = np.zeros((len(union), 1 << BITS), np.int64)
                    grown[np.searchsorted(union, held)] = total
                    held, total = union, grown
                rows = np.flatnonzero((own >= wanted[0]) & (own <= wanted[-1]))
                at = np.searchsorted(held, own[rows])
                points, edges, _ = code_points([texts[r] for r in rows.tolist()])
                for bucket, doc in grams(points, edges, 1):
                    total += np.bincount((at[doc] << BITS) + bucket, minlength=total.size).reshape(total.shape)
        yield _counted(held, total)

    return count


def _counted(held: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    lang, bucket = np.nonzero(total)
    return pa.RecordBatch.from_arrays(
        [pa.array(held[lang].astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[lang, bucket])],
        names=["lang", "bucket", "n"],
    )


def sample(docs: DataFrame, most: int = SAMPLE_DOCS) -> DataFrame:
    """At most ``most`` labelled documents of each language, by the smallest hash of their id."""
    drawn = (F.xxhash64("doc_id").cast("double") / F.lit(2.0**64)) + 0.5
    counts = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # a threshold leaves few rows more than wanted, so that the ranking below is over a bounded number
    share = F.least(F.lit(1.0), (F.lit(float(most)) + 8 * F.sqrt(F.lit(float(most)))) / F.col("n"))
    near = docs.withColumn("drawn", drawn).join(F.broadcast(counts), "lang")
    near = near.where(F.col("drawn") <= share)
    order = Window.partitionBy("lang").orderBy("drawn", "doc_id", F.xxhash64("text"))
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("lang", "text")


def train(docs: DataFrame, most: int = SAMPLE_DOCS, block: int = BLOCK) -> tuple[list[str], list[Broadcast]]:
    """Labels in order and the matrix of log probabilities, from rows with ``doc_id``, ``text`` and ``lang``.

    Of the matrix, each ``block`` labels in turn are a broadcast.
    """
    spark = small_batches(docs.sparkSession)
    labelled = docs.where("lang is not null and doc_id is not null and text is not null").select("doc_id", "lang", "text")
    langs = sorted(r.lang for r in labelled.select("lang").distinct().collect())
    if not langs:
        return [], []
    counted = sample(labelled, most).mapInArrow(_count(langs, block), "lang int, bucket int, n bigint")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    several = len(langs) > block
    if several:
        summed = materialize(summed.withColumn("block", F.floor(F.col("lang") / F.lit(block))), by="block")
    shared = []
    for k in range(0, len(langs), block):
        total = np.zeros((len(langs[k : k + block]), 1 << BITS))
        # at most a row for each language of the block and bucket
        found = (summed.where(F.col("block") == k // block) if several else summed).select("lang", "bucket", "n").toArrow()
        total[found["lang"].to_numpy() - k, found["bucket"].to_numpy()] = found["n"].to_numpy()
        chance = (total + SMOOTH) / (total.sum(axis=1, keepdims=True) + SMOOTH * total.shape[1])
        shared.append(spark.sparkContext.broadcast(np.log(chance).T.astype(np.float32).copy()))
    if several:
        release(summed)
    return langs, shared


def predictor(langs: list[str], blocks: Callable[[], Iterator[np.ndarray]]) -> Callable[[list[str | None]], tuple[list[str], np.ndarray]]:
    """Predicts from the blocks of the matrix, which ``blocks`` gives in the order of the labels."""

    def predict(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        points, edges, has = code_points(texts)
        most, share, best, at = np.full(len(texts), -np.inf), np.zeros(len(texts)), np.zeros(len(texts), np.int64), 0
        for matrix in blocks():
            scores = np.zeros((len(texts), matrix.shape[1]))
            for bucket, doc in grams(points, edges, matrix.shape[1]):
                if len(doc):
                    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                    scores[doc[first]] += np.add.reduceat(matrix[bucket], first, axis=0)
            # equal scores stay with the earlier label
            top = scores.max(axis=1)
            best = np.where(top > most, at + scores.argmax(axis=1), best)
            higher = np.maximum(most, top)
            share = share * np.exp(most - higher) + np.exp(scores - higher[:, None]).sum(axis=1)
            most, at = higher, at + matrix.shape[1]
        score = np.where(has > 0, 1.0 / share, 0.0) if len(texts) else share
        return [langs[b] if k else "und" for b, k in zip(best.tolist(), (has > 0).tolist(), strict=True)], score

    return predict


def _read(shared: list[Broadcast]) -> Iterator[np.ndarray]:
    for one in shared:
        yield one.value
        if len(shared) > 1 and hasattr(one, "_path"):
            # read again for the next batch: a worker holds one block
            del one._value


def predict_language(docs: DataFrame, model: tuple[list[str], list[Broadcast]], keep: list[Column | str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score`` for every row of ``docs``; the text itself is read only.

    Kept columns that are named ``lang_pred`` or ``score`` give way to the result's.
    """
    small_batches(docs.sparkSession)
    langs, shared = model

    def score(batches):
        predict = predictor(langs, lambda: _read(shared))
        for batch in batches:
            names, values = predict(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names, pa.string()), pa.array(values)],
                names=[*batch.schema.names[1:], "lang_pred", "score"],
            )

    rows = docs.select(F.col(text).cast("string").alias("_text_"), *keep).drop("lang_pred", "score")
    schema = rows.drop("_text_").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(score, schema)
