"""Near duplicates by an inverted join of MinHash signatures.

Every document gets MinHash coordinates of its set of five-word shingles. Equal sets are one class, however many copies
there are, and only classes are compared. Each of ``LISTS`` coordinates with its value is a posting list. Two classes
are a candidate pair if they meet in at least ``MEET`` lists and agree in ``AGREE`` of ``BITS`` further coordinates, of
which one bit each is kept. A pair at the threshold of 0.75 falls short with a chance of about 2 in 100,000, and more
similar ones much less often.

Prefix: a pair that meets in ``MEET`` lists meets in one of the ``LISTS - MEET + 1`` rarest of either class, so a class is
posted only under those; a list with one member takes a place in the prefix and costs nothing. Most documents
share too little to be posted at all.
Skip: the most frequent lists, those of widely shared passages, are then not merged at all unless a
class has little else. A list longer than ``BLOCK`` is compared in pairs of blocks. A pair is taken up only in
the first list that both post it in, and its collisions are counted there on the sketches that postings carry, so no
pair below the thresholds leaves its task.

Large groups. Not all pairs of a group are needed, only its components. Three rounds verify, for each class, its best
candidate in another component; the last round takes all candidates that are left between components.
Pairs inside a component are skipped. Verification compares the full shingle sets of both texts.

Defined cases: a null text, or one without words, has no shingles and is linked with nothing; 1 to 4 words are one
shingle; rows that repeat an id are documents of their own; a null id is no component's smallest unless all its ids
are null; an empty table gives an empty result; columns beside id and text are not read. Sets are told apart by 128 bits
and get a number of their own; words and shingles have 64 bits. The list that takes up a pair is found by 32 bits of each list's number.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterbook.llm.components import components
from meterbook.llm.runtime import small_batches
from meterbook.llm.textnum import gathered, mixed, shingles, words
from meterbook.session import materialize

LISTS, MEET, BITS, AGREE, BLOCK, WORDS, PERCENT, ROUNDS = 32, 13, 2048, 1728, 1024, 5, 75, 3
#: Shingles of which all coordinates are computed at a time.
SLICE = 1 << 18


def signatures(own: np.ndarray, rows: np.ndarray, first: int, count: int) -> np.ndarray:
    """The smallest hash of each row's shingles for ``count`` coordinates; rows must not be empty."""
    seeds = mixed(np.arange(2 * first + 1, 2 * (first + count) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    factor, shift = seeds[::2] | np.uint64(1), seeds[1::2]
    out = np.empty((len(rows) - 1, count), np.uint64)
    for c in range(count):
        out[:, c] = np.minimum.reduceat(own * factor[c] + shift[c], rows[:-1])
    return mixed(out)


def tokens_of(own: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One number for each list: a coordinate with its value."""
    coordinate = np.arange(LISTS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed(signatures(own, rows, 0, LISTS) + coordinate)


def by_slices(make, own: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``make`` over a few rows at a time, at least one."""
    parts, a = [], 0
    while a < len(rows) - 1:
        b = max(a + 1, int(np.searchsorted(rows, rows[a] + SLICE, "right")) - 1)
        parts.append(make(own[rows[a] : rows[b]], rows[a : b + 1] - rows[a]))
        a = b
    return np.concatenate(parts)


def _set_id(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _sign(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        number, at = words(batch.column(1))
        own, rows = shingles(number, at, WORDS)
        size = np.diff(rows)
        full = np.flatnonzero(size)
        tokens = np.zeros((batch.num_rows, LISTS), np.int64)
        if len(full):
            tokens[full] = by_slices(tokens_of, own, np.append(rows[:-1][full], rows[-1])).view(np.int64)
        sets = [_set_id(own[s:e]) if e > s else b"" for s, e in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(sets, pa.binary()),
             pa.FixedSizeListArray.from_arrays(pa.array(tokens.ravel()), LISTS).cast(pa.list_(pa.int64()))],
            names=["doc_id", "print", "n_shingles", "set_id", "tokens"],
        )


def sketches(own: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Bytes of each row: a bit of ``BITS`` coordinates, then 32 bits of each list's number."""
    bits = np.packbits((signatures(own, rows, LISTS, BITS) & np.uint64(1)).astype(np.uint8), axis=1)
    return np.concatenate([bits, (tokens_of(own, rows) & np.uint64(0xFFFFFFFF)).astype("<u4").view(np.uint8)], axis=1)


def _candidates(best: bool):
    """For ``mapInArrow`` over postings sorted by list and block pair."""
    key = ["token", "i", "j"]

    def merge(rows: pa.Table) -> pa.RecordBatch | None:
        n = rows.num_rows
        lists = [rows[c].to_numpy() for c in key]
        start = np.zeros(n, bool)
        start[:1] = True
        for x in lists:
            start[1:] |= x[1:] != x[:-1]
        group = np.cumsum(start)
        node, size, label, tried, block = (rows[c].to_numpy() for c in ("node", "n", "label", "tried", "block"))
        cross = lists[1] != lists[2]
        bit = np.int64(1) << rows["c"].to_numpy().astype(np.int64)
        mask = rows["mask"].to_numpy()
        raw = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(n, -1)
        sketch = np.ascontiguousarray(raw[:, : BITS // 8]).view(np.uint64)
        values = np.ascontiguousarray(raw[:, BITS // 8 :]).view("<u4")
        powers = np.int64(1) << np.arange(LISTS, dtype=np.int64)
        left, right, agree = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in range(1, n):
            i = np.flatnonzero(group[d:] == group[:-d])
            if not len(i):
                break
            j = i + d
            small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            use = (label[i] != label[j]) & (100 * small >= PERCENT * large) & (~cross[i] | (block[i] != block[j]))
            use &= (tried[i] != node[j]) & (tried[j] != node[i])
            i, j = i[use], j[use]
            if len(i):  # of the lists that both post it in, the first takes up the pair
                common = mask[i] & mask[j] & ((values[i] == values[j]) @ powers)
                use = (common & -common) == bit[i]
                i, j = i[use], j[use]
            if len(i):
                count = BITS - np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1).astype(np.int64)
                use = count >= AGREE
                left.append(i[use])
                right.append(j[use])
                agree.append(count[use])
        a, b, m = np.concatenate(left), np.concatenate(right), np.concatenate(agree)
        if not len(a):
            return None
        if best:  # each class's best partner here; ties to the smaller
            a, b, m = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([m, m])
            order = np.lexsort((node[b], -m, node[a]))
            a, b, m = a[order], b[order], m[order]
            first = np.concatenate([[True], node[a][1:] != node[a][:-1]])
            a, b, m = a[first], b[first], m[first]
        else:
            swap = node[a] > node[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            pair = np.unique(np.stack([node[a], node[b]], axis=1), axis=0, return_index=True)[1]
            a, b, m = a[pair], b[pair], m[pair]
        return pa.RecordBatch.from_arrays(
            [pa.array(node[a]), pa.array(node[b]), pa.array(label[a]), pa.array(label[b]), pa.array(m)],
            names=["a", "b", "la", "lb", "m"],
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            last = [rows[c][-1].as_py() for c in key]
            # the last list may go on in the next batch
            open_ = np.ones(rows.num_rows, bool)
            for c, x in zip(key, last, strict=True):
                open_ &= rows[c].to_numpy() == x
            upto = rows.num_rows - int(open_.sum())
            if upto and (found := merge(rows.slice(0, upto))) is not None:
                yield found
            held = rows.slice(upto).combine_chunks().to_batches()
        if held and (found := merge(pa.Table.from_batches(held))) is not None:
            yield found

    return run


def _postings(classes: DataFrame) -> DataFrame:
    """A row for each list of a class's prefix and each pair of blocks it is compared in."""
    mask = F.aggregate("prefix", F.lit(0).cast("bigint"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), x["c"])))
    each = classes.select("node", "n", "sketch", "label", "tried", mask.alias("mask"), F.explode("prefix").alias("post"))
    blocks = F.ceil(F.col("post.f") / F.lit(BLOCK))
    own = each.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    return spread.select(
        F.col("post.token").alias("token"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "node", "n", "label", "tried", F.col("post.c").alias("c"), "mask", "sketch",
    )


def _pairs(classes: DataFrame, best: bool) -> DataFrame:
    dealt = _postings(classes).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    found = dealt.mapInArrow(_candidates(best), "a bigint, b bigint, la bigint, lb bigint, m bigint")
    if not best:
        return found.groupBy("a", "b").agg(F.max("la").alias("la"), F.max("lb").alias("lb"))
    top = F.max(F.struct("m", (-F.col("b")).alias("rank"), "b", "la", "lb")).alias("top")
    return found.groupBy("a").agg(top).select("a", "top.b", "top.la", "top.lb")


def _texts(batches):
    """Texts with their sketches, only of rows whose text is the class's: a row may repeat an id with another text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        number, at = words(batch.column(1))
        own, rows = shingles(number, at, WORDS)
        sets = batch.column(2).to_pylist()
        right = [e > s and _set_id(own[s:e]) == n for n, s, e in zip(sets, rows[:-1].tolist(), rows[1:].tolist(), strict=True)]
        there = np.flatnonzero(right)
        if len(there):
            size = np.diff(rows)[there]
            made = by_slices(sketches, gathered(own, rows[:-1][there], size), np.concatenate([[0], np.cumsum(size)]))
            yield pa.RecordBatch.from_arrays(
                [*batch.filter(pa.array(right, pa.bool_())).columns[:2], pa.array([x.tobytes() for x in made], pa.binary())],
                names=["node", "text", "sketch"],
            )


def _verify(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, first, place = np.unique(np.concatenate([a, b]), return_index=True, return_inverse=True)
        both = pa.chunked_array([batch.column(4), batch.column(5)]).take(pa.array(first))
        number, at = words(both)
        own, rows = shingles(number, at, WORDS)
        linked = []
        for x, y in zip(place[: len(a)].tolist(), place[len(a) :].tolist(), strict=True):
            s, t = own[rows[x] : rows[x + 1]], own[rows[y] : rows[y + 1]]
            common = len(np.intersect1d(s, t, assume_unique=True))
            linked.append(100 * common >= PERCENT * (len(s) + len(t) - common))
        yield pa.RecordBatch.from_arrays(batch.columns[:4], names=batch.schema.names[:4]).filter(pa.array(linked, pa.bool_()))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are links."""
    joined = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "la", "lb", "ta", "tb")
    )
    return materialize(joined.mapInArrow(_verify, "a bigint, b bigint, la bigint, lb bigint"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    signed = materialize(
        rows.mapInArrow(_sign, f"doc_id {id_type}, print bigint, n_shingles bigint, set_id binary, tokens array<bigint>")
    )
    members = signed.where("n_shingles > 0")
    # one row of a class gives its text, found again by its id, null too, and its text's fingerprint
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")
    heads = members.groupBy("set_id").agg(F.min(row).alias("rep"), F.min("n_shingles").alias("n"), F.first("tokens").alias("tokens"))
    # written, so that a class keeps its number
    numbered = materialize(heads.withColumn("node", F.monotonically_increasing_id()))
    tokens = numbered.select("node", F.posexplode("tokens").alias("c", "token"))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # a list with one member is not here, and takes a place in the prefix all the same
    shared = (
        tokens.join(common, "token").groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("f", "token", "c"))).alias("posts"))
        .where(F.size("posts") >= MEET)
        .select("node", F.slice("posts", F.lit(1), F.size("posts") - F.lit(MEET - 1)).alias("prefix"))
    )
    posted = materialize(shared.join(numbered.drop("tokens"), "node"))
    own = F.col("rep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("rep.print") == F.col("print"))
    texts = materialize(
        posted.select("node", "rep", "set_id").join(rows, own).select("node", "text", "set_id")
        .mapInArrow(_texts, "node bigint, text string, sketch binary").dropDuplicates(["node"])
    )
    classes = posted.join(texts.select("node", "sketch"), "node")
    labels = materialize(posted.select("node", F.col("node").alias("label"), F.lit(None).cast("bigint").alias("tried")))
    for best in [True] * ROUNDS + [False]:
        now = classes.join(labels, "node").withColumn("tried", F.coalesce("tried", "node"))
        pairs = materialize(_pairs(now, best))
        links = _verified(pairs, texts)
        if links.limit(1).count():
            merged = components(links, "la", "lb")
            labels = labels.join(merged.withColumnRenamed("label", "to").withColumnRenamed("node", "label"), "label", "left")
            labels = labels.select("node", F.coalesce("to", "label").alias("label"))
        else:
            labels = labels.select("node", "label")
        if best:
            tried = pairs.select(F.col("a").alias("node"), F.col("b").alias("tried"))
            labels = labels.join(tried, "node", "left")
        labels = materialize(labels)
    named = numbered.select("node", "set_id").join(labels.select("node", "label"), "node", "left")
    named = named.select("set_id", F.coalesce("label", "node").alias("label"))
    placed = members.select("doc_id", "n_shingles", "set_id").join(named, "set_id")
    smallest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    linked = placed.join(smallest, "label").select("doc_id", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
