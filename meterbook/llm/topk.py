"""Exact top-k by inner product: tiles of queries and candidates, partial lists, a tree of merges.

Queries are dealt into rows and candidates into columns of a grid by a hash of their id, so that each tile has
a bounded number of both. A tile is one matrix product and keeps each query's k best. Lists of a query are merged
``FAN`` at a time, level by level. No task sees all candidates of a query, nor all lists before they are short.

Components become floor(256 x). Products are exact: single precision where every sum stays below 2^24, double below
2^53, whole numbers of any size beyond, held to the range of a long.

Defined cases: a vector that is null or has a null or non-finite component takes no part, nor a null id; only vectors of
equal dimension are compared; a query's own id is no candidate; rows that repeat an id count as one candidate, or
query, with the best of their scores; fewer than k candidates give fewer rows; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterbook.llm.runtime import small_batches
from meterbook.session import materialize

QUERY_ROWS, SHARD_ROWS, FAN = 2048, 8192, 16
_LONG = np.iinfo(np.int64)


def usable(vector: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _matrix(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(256.0 * flat.reshape(-1, dim)) if dim else np.zeros((len(vectors), 0))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    return np.array(
        [[min(_LONG.max, max(_LONG.min, sum(x * y for x, y in zip(p, q, strict=True)))) for q in whole[1]] for p in whole[0]],
        np.int64,
    )


def _tile(k: int):
    def best(key: tuple, rows: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        asked = rows.filter(pc.equal(rows["kind"], 0))
        there = rows.filter(pc.equal(rows["kind"], 1)).sort_by("id")
        out_q, out_v, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if asked.num_rows and there.num_rows:
            ids, first = np.unique(there["id"].to_numpy(), return_index=True)
            right = _matrix(there["vector"], dim)
            for a in range(0, asked.num_rows, 512):
                part = asked.slice(a, 512)
                # columns in order of id, an id's repeated rows as their best
                score = np.maximum.reduceat(_product(_matrix(part["vector"], dim), right), first, axis=1)
                for query, row in zip(part["id"].to_numpy(), score, strict=True):
                    own = np.searchsorted(ids, query)
                    open_ = np.ones(len(ids), bool)
                    if own < len(ids) and ids[own] == query:
                        open_[own] = False
                    at = np.flatnonzero(open_)
                    values = row[at]
                    if len(at) > k:
                        least = np.partition(values, len(values) - k)[len(values) - k]
                        at = at[values >= least]
                        values = row[at]
                    order = np.lexsort((at, ~values))[:k]  # ~x falls as x rises, also at the ends of a long
                    out_q.append(np.full(len(order), query, np.int64))
                    out_v.append(ids[at[order]])
                    out_s.append(values[order])
        return pa.table({
            "query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s),
            "part": pa.array([key[2].as_py()] * sum(map(len, out_q)), pa.int64()),
        })

    return best


def top_k(
    vectors: DataFrame, is_query: Column, k: int, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's k best."""
    small_batches(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    held = materialize(rows.select("dim", "id", "vector", "asks"))
    sizes = held.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(SHARD_ROWS)).alias("columns"),
        F.greatest(F.lit(1), F.ceil(F.count(F.when(F.col("asks"), 1)) / F.lit(QUERY_ROWS))).alias("lines"),
    )
    sized = held.join(sizes, "dim")
    line, column = F.pmod(F.xxhash64("id", F.lit(1)), "lines"), F.pmod(F.xxhash64("id", F.lit(2)), "columns")
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    asked = sized.where("asks").select("dim", line.alias("r"), all_of("columns").alias("s"), F.lit(0).alias("kind"), "id", "vector")
    there = sized.select("dim", all_of("lines").alias("r"), column.alias("s"), F.lit(1).alias("kind"), "id", "vector")
    lists = asked.unionByName(there).groupBy("dim", "r", "s").applyInArrow(
        _tile(k), "query_id bigint, vec_id bigint, score bigint, part bigint"
    )
    most = sizes.agg(F.max("columns")).first()[0] or 1
    while True:
        most = -(-most // FAN)
        merged = lists.groupBy("query_id", F.floor(F.col("part") / FAN).alias("part"), "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id")
        lists = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if most <= 1:
            return lists.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
