"""Token counts of documents without token ids.

Pre-tokens are the words between white space, which no piece of the vocabulary file reaches over. A block of documents
keeps each document's pre-token frequencies and asks once for each pre-token it holds. The shards of the
pre-tokens count the pieces of each distinct one once, and a block sums its frequencies times those counts.

Defined cases: null counts as empty, with 0 bytes and tokens; special strings in a text are special tokens, as the library
reads them; repeated rows are counted each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterbook.llm import blocks as B
from meterbook.llm.pretokens import SPECIAL, pieces_of
from meterbook.llm.runtime import TOKENIZER, small_batches, text_shards, tokenizer_path
from meterbook.llm.textnum import numbers, sums, text_bytes, words_of
from meterbook.session import materialize

LIMIT = 2048


def _block(shards: int):
    def make(block: int, docs: pa.Table) -> list[tuple]:
        found = words_of(docs["text"], SPECIAL)
        # words are told apart by their bytes; their numbers only deal them to shards
        number = numbers(found.distinct)
        order = np.argsort(number, kind="stable")
        place_of = np.empty(len(order), np.int64)
        place_of[order] = np.arange(len(order))
        place, size = place_of[found.code], np.diff(found.rows)
        pair = np.sort((np.repeat(np.arange(len(size)), size).astype(np.uint64) << np.uint64(32)) | place.astype(np.uint64))
        pair, times = np.unique(pair, return_counts=True)
        per_doc = np.bincount((pair >> np.uint64(32)).astype(np.int64), minlength=len(size))
        own = docs.drop_columns(["text"]).append_column("n_bytes", pa.array(np.diff(text_bytes(docs["text"])[1])))
        body = B.joined([B.framed(own), B.packed(per_doc), B.packed(pair & np.uint64(0xFFFFFFFF)), B.packed(times)])
        asked = [found.distinct[i] for i in order.tolist()]
        out = [(0, block, block, -1, body)]
        edges = B.shard_edges(number[order], shards).tolist()
        for shard, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if b > a:
                out.append((1, shard, block, shard, B.squeeze(b" ".join(asked[a:b]))))
        return out

    return B.each_block(make)


def _shard(path_name: str):
    def count(rows: pa.Table) -> pa.Table:
        pieces = pieces_of(tokenizer_path(path_name))
        counts: dict[bytes, int] = {}
        out = []
        for block, shard, data in zip(rows["block"].to_pylist(), rows["part"].to_pylist(), rows["data"], strict=True):
            asked = B.unsqueeze(data.as_py()).split(b" ")
            for word in set(asked).difference(counts):
                counts[word] = len(pieces.word(word))
            out.append((2, block, block, shard, B.packed(np.fromiter(map(counts.__getitem__, asked), np.int64, len(asked)))))
        pieces.forget()
        return pa.Table.from_batches([B.row_batch(out)])

    return count


def _sum(limit: int):
    def total(rows: pa.Table) -> pa.Table:
        kept = sorted(zip(rows["part"].to_pylist(), rows["data"].to_pylist(), strict=True))
        own, per_doc, place, times = B.parted(kept[0][1])
        answers = [B.unpacked(x) for _, x in kept[1:]]
        pieces = np.concatenate([np.zeros(0, np.uint64), *answers]).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(B.unpacked(per_doc).astype(np.int64))])
        tokens = sums(pieces[B.unpacked(place).astype(np.int64)] * B.unpacked(times).astype(np.int64), edges)
        docs = B.unframed(own)
        return pa.table({
            "doc_id": docs["doc_id"], "n_bytes": docs["n_bytes"].cast(pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()), "over_limit": pa.array(tokens > limit, pa.bool_()),
        })

    return total


def token_counts(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``, a row for each row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    shards = text_shards(rows)
    stored = materialize(rows.mapInArrow(_block(shards), B.ROWS), by="kind")
    # as many tasks as shards: a task's share does not grow with the input
    dealt = lambda frame: frame.repartition(shards, "key").groupBy("key")
    answers = dealt(stored.where("kind = 1")).applyInArrow(_shard(tokenizer), B.ROWS)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    own = stored.where("kind = 0").select(*answers.columns)
    return dealt(own.unionByName(answers)).applyInArrow(
        _sum(limit), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
