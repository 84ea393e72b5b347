"""Repeated lines: exact reference counts behind sharded cuckoo filters.

The index has three tables. ``refs`` names each document's keys, ``counts`` has for each key the number of its
documents and the largest id, exactly, and ``filters`` has a cuckoo filter per shard of the keys that reached the
limit. Documents can be inserted and deleted: their references change the counts, and the keys that cross the limit enter or leave
the filters, so that inserting and deleting a document gives the index before.

Looking up asks the filters first: the references of a shard, dealt to as many groups as they need, meet copies of its filter, and
only references that may be repeated (all that are, and a few in ten thousand others) are joined to the exact counts. The
references are counted by shard and then dealt once, and no filter passes the driver. A key in a third of all documents is counted before the
shuffle, and run-time splitting spreads its references in the join.

A line's key is the line without white space at its ends, A-Z lower-cased, as 128 bits of BLAKE2b.

Defined cases: a null or empty text is one empty line; each row is a document, also rows that repeat an id; a null id is
smaller than all others; keys shorter than ``LEAST`` code points always stay; an empty table gives an empty result;
lines end at ``\\n`` only; other columns are not read; ``delete`` leaves documents without an id, which no id names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from meterbook.llm.cuckoo import Cuckoo, Full
from meterbook.llm.runtime import small_batches
from meterbook.session import materialize

LEAST, DOCS = 40, 5
#: Keys of a filter shard, and references that ask one copy of its filter.
SHARD_KEYS, GROUP_ROWS = 1 << 18, 1 << 20
_EDGE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least: int = LEAST) -> bytes | None:
    """16 bytes for a line that is long enough."""
    key = line.strip(_EDGE)
    if len(key) < least or (not key.isascii() and len(key.decode()) < least):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def _references(least: int):
    def read(batches):
        for batch in batches:
            docs, keys = [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                own = {k for k in (line_key(x, least) for x in (text or b"").split(b"\n")) if k is not None}
                keys.extend(own)
                docs.extend([i] * len(own))
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), batch.column(0).take(pa.array(docs, pa.int64()))],
                names=["a", "b", "doc_id"],
            )

    return read


def references(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document and distinct key: ``a``, ``b`` (the key's halves) and ``doc_id``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(
        _references(least), f"a bigint, b bigint, doc_id {rows.schema['doc_id'].dataType.simpleString()}"
    )


@dataclass(frozen=True)
class LineIndex:
    """A state of the index; every change gives a new one."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    limit: int


def _counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))


def _shard(shards: int):
    return F.pmod(F.col("b"), F.lit(shards)).alias("shard")


def _halves(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return rows["a"].to_numpy().view(np.uint64), rows["b"].to_numpy().view(np.uint64)


def _filter(key: tuple, rows: pa.Table) -> pa.Table:
    return pa.table({"shard": [key[0].as_py()], "image": pa.array([Cuckoo.of(*_halves(rows)).image()], pa.binary())})


def _filters(repeated: DataFrame, shards: int) -> DataFrame:
    keyed = repeated.select("a", "b", _shard(shards))
    return materialize(keyed.groupBy("shard").applyInArrow(_filter, "shard bigint, image binary"))


def build_index(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST, limit: int = DOCS
) -> LineIndex:
    refs = materialize(references(docs, id_column, text, least))
    counts = materialize(_counted(refs))
    repeated = counts.where(F.col("n") >= limit)
    shards = max(1, -(-repeated.count() // SHARD_KEYS))
    return LineIndex(refs, counts, _filters(repeated, shards), shards, limit)


def _changed(key: tuple, old: pa.Table, change: pa.Table) -> pa.Table:
    images = old["image"].to_pylist()
    held = Cuckoo.load(images[0]) if images else Cuckoo.sized(1)
    gone = change.filter(pc.equal(change["change"], "out"))
    held.delete(*_halves(gone))
    kept = change.filter(pc.not_equal(change["change"], "out"))
    new = kept.filter(pc.equal(kept["change"], "in"))
    try:
        held.insert(*_halves(new))
    except Full:  # the exact table has all keys of the shard
        held = Cuckoo.of(*_halves(kept))
    return pa.table({"shard": [key[0].as_py()], "image": pa.array([held.image()], pa.binary())})


def _moved(index: LineIndex, refs: DataFrame, counts: DataFrame) -> LineIndex:
    """The index with new tables; the keys that crossed the limit change the filters."""
    was = index.counts.where(F.col("n") >= index.limit).select("a", "b", F.lit(True).alias("was"))
    now = counts.where(F.col("n") >= index.limit).select("a", "b", F.lit(True).alias("now"))
    change = F.when(F.col("was") & F.col("now"), "stay").when(F.col("was"), "out").otherwise("in")
    moved = was.join(now, ["a", "b"], "full").select("a", "b", _shard(index.shards), change.alias("change"))
    filters = index.filters.groupBy("shard").cogroup(moved.groupBy("shard")).applyInArrow(
        _changed, "shard bigint, image binary"
    )
    return LineIndex(refs, counts, materialize(filters), index.shards, index.limit)


def insert(index: LineIndex, docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST) -> LineIndex:
    new = materialize(references(docs, id_column, text, least))
    merged = index.counts.unionByName(_counted(new)).groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.max("last").alias("last")
    )
    return _moved(index, materialize(index.refs.unionByName(new)), materialize(merged))


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """Without the documents whose ``doc_id`` is in ``ids``; only their keys are counted again."""
    gone = ids.select("doc_id").distinct()
    left = materialize(index.refs.join(gone, "doc_id", "left_anti").select("a", "b", "doc_id"))
    touched = index.refs.join(gone, "doc_id", "left_semi").select("a", "b").distinct()
    again = _counted(left.join(touched, ["a", "b"], "left_semi"))
    counts = index.counts.join(touched, ["a", "b"], "left_anti").unionByName(again)
    return _moved(index, left, materialize(counts))


def may_repeat(index: LineIndex, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The references that the filters let through: every repeated one, and few others."""
    small_batches(index.refs.sparkSession)
    # the rows of a stored table have the same numbers whenever they are read
    nth = F.monotonically_increasing_id().alias("nth")
    sharded = index.refs.select("a", "b", "doc_id", _shard(index.shards), nth)
    # only references whose shard has a filter are dealt; a shard gets groups by its own number of references
    asked = index.refs.groupBy(_shard(index.shards)).agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("groups"))
    load = materialize(asked.join(index.filters.select("shard"), "shard"))
    dealt = F.pmod("nth", "groups").alias("part")
    refs = sharded.join(load, "shard").select("a", "b", "doc_id", "shard", dealt)
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)).alias("part")
    filters = index.filters.join(load, "shard").select("shard", "image", parts)
    met = refs.groupBy("shard", "part").cogroup(filters.groupBy("shard", "part"))
    return met.applyInArrow(_probe, index.refs.schema)


def _probe(refs: pa.Table, filters: pa.Table) -> pa.Table:
    own = refs.select(["a", "b", "doc_id"])
    if not len(filters):
        return own.slice(0, 0)
    return own.filter(pa.array(Cuckoo.load(filters["image"][0].as_py()).holds(*_halves(own))))


def _cleaned(least: int):
    def clean(batches):
        for batch in batches:
            n, gone, digest, kept_text = [], [], [], []
            lists = batch.column(2)
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                lines = (text or b"").split(b"\n")
                drop = lists[i]
                kept = lines
                if drop.is_valid and len(drop.values):
                    halves = np.stack([drop.values.field(f).to_numpy() for f in (0, 1)], axis=1).astype(np.int64)
                    raw = halves.tobytes()
                    keys = {raw[p : p + 16] for p in range(0, len(raw), 16)}
                    kept = [x for x in lines if line_key(x, least) not in keys]
                new = b"\n".join(kept)
                n.append(len(lines))
                gone.append(len(lines) - len(kept))
                digest.append(hashlib.sha256(new).hexdigest())
                kept_text.append(new)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(kept_text, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"],
            )

    return clean


def clean_lines(
    docs: DataFrame, index: LineIndex, id_column: str = "doc_id", text: str = "text", least: int = LEAST
) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped``, ``kept_sha256`` and ``kept_text`` for every row of ``docs``."""
    small_batches(docs.sparkSession)
    repeated = index.counts.where(F.col("n") >= index.limit).select("a", "b", "last")
    older = (F.col("doc_id") < F.col("last")) | (F.col("doc_id").isNull() & F.col("last").isNotNull())
    drops = (
        may_repeat(index).join(repeated, ["a", "b"]).where(older)
        .groupBy(F.col("doc_id").alias("of")).agg(F.collect_set(F.struct("a", "b")).alias("drops"))
    )
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("doc_id", "text", "drops")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        _cleaned(least), f"doc_id {id_type}, n_lines bigint, n_dropped bigint, kept_sha256 string, kept_text string"
    )
