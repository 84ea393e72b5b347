"""Collocations of two and three words, from suffix subtrees that are built group by group.

Every word position starts a suffix, cut after three words or at the end of its piece. Suffixes that begin with one word
make one subtree. Vertical partitioning: the occurrences of first words are counted in ``BUCKETS`` hash buckets, a
fixed number, and runs of buckets that together stay within ``BUDGET`` suffixes become groups. A bucket beyond the
budget alone is split by what follows its word, so no group depends on one word or pair.

Blocks of documents merge equal suffixes and send each group one message: its suffixes as sorted codes and the words they
use, once each. A group merges its messages by the words' bytes into subtrees of depth three. A leaf's total is the number of
times its words occur, and an inner node's is the sum of its leaves: all frequencies are read there. What
reaches ``least`` is a phrase. Only where a bucket was split are shorter phrases summed over groups first.

Scores are computed in 38-digit integers; they are at most 1,000,000, because a part occurs at least as often as the whole.

Defined cases: null counts as an empty text, null ``lang`` as ``und``; empty texts and empty pieces have no words; repeated
rows count each; an empty table gives an empty result; other columns are not read. A language without phrases has no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from meterbook.llm import blocks as B
from meterbook.llm.runtime import small_batches
from meterbook.llm.textnum import bounds, coded, lower, mixed, numbers, text_bytes
from meterbook.session import materialize

#: Hash buckets of first words, suffixes of a group, and positions a block merges at a time.
BUCKETS, BUDGET, SLICE = 1 << 14, 2_000_000, 1 << 20
#: What a phrase must reach, the share of a longer phrase that replaces it, phrases of a language.
LEAST, INSIDE_PERCENT, TOP = 10, 50, 2000
NO_LANG = "und"
#: What ends a piece, and what stands between words.
_ENDS = np.isin(np.arange(256), list(b".,;:!?\x0a\x0b\x0c\x0d"))
_BLANK = np.isin(np.arange(256), [0x20, 0x09])
_SCALE = 1_000_000


def _by_lang(docs: pa.Table) -> Iterator[tuple[str, np.ndarray, list[bytes], np.ndarray]]:
    """Per language its words in order, as codes, the words by code, and the number of each word's piece."""
    for lang in docs["lang"].unique().to_pylist():
        raw, offsets = text_bytes(docs.filter(pc.equal(docs["lang"], lang))["text"])
        data = lower(raw)
        ends_piece = _ENDS[data]
        inside = ~(ends_piece | _BLANK[data])
        starts, ends, rows = bounds(inside, offsets)
        if not len(starts):
            continue
        code, distinct = coded(data, inside, starts, ends)
        # grows with every mark and with every row, so neighbours are equal inside a piece only
        piece = np.cumsum(ends_piece)[starts] + np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        yield lang, code, distinct, piece


def _buckets(lang: str, distinct: list[bytes]) -> np.ndarray:
    salt = numbers([lang.encode()])[0]
    return (mixed(numbers(distinct) ^ salt) % np.uint64(BUCKETS)).astype(np.int64)


def _tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            own = batch.column(batch.schema.get_field_index("text")).nbytes
            if held and size + own > B.BLOCK_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch)
            size += own
    if held:
        yield pa.Table.from_batches(held)


def _count_buckets(batches):
    """A task's word occurrences by bucket, and by language (as bucket -1)."""
    total, langs = np.zeros(BUCKETS, np.int64), {}
    for docs in _tables(batches):
        for lang, code, distinct, _ in _by_lang(docs):
            own = np.bincount(code, minlength=len(distinct))
            total += np.bincount(_buckets(lang, distinct), own, BUCKETS).astype(np.int64)
            langs[lang] = langs.get(lang, 0) + len(code)
    there = np.flatnonzero(total)
    bucket = np.concatenate([there, np.full(len(langs), -1)]).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([None] * len(there) + list(langs), pa.string()), pa.array(bucket),
         pa.array(np.concatenate([total[there], np.array(list(langs.values()), np.int64)]), pa.int64())],
        names=["lang", "bucket", "n"],
    )


def plan_groups(counts: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket its first group and how many groups share it: 1 unless the bucket alone passes the budget."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    group, held = 0, 0
    for bucket, n in enumerate(counts.tolist()):
        if n > budget:
            group += held > 0
            first[bucket], parts[bucket] = group, -(-n // budget)
            group, held = group + int(parts[bucket]), 0
            continue
        if held + n > budget:
            group, held = group + 1, 0
        first[bucket] = group
        held += n
    return first, parts


def _suffixes(code: np.ndarray, piece: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """First, second and third word (from 1, 0 for none) and the count of the distinct suffixes, slice by slice."""
    for a in range(0, len(code), SLICE):
        b = min(a + SLICE, len(code))
        c, p = code[a : b + 2], piece[a : b + 2]
        names, base = None, size + 1
        if base > 1 << 21:  # three codes share 63 bits
            names, c = np.unique(c, return_inverse=True)
            base = len(names) + 1
        follows = np.zeros(len(c) + 1, bool)
        follows[: len(c) - 1] = p[1:] == p[:-1]
        after = np.append(c + 1, [0, 0])
        n = b - a
        two = np.where(follows[:n], after[1 : n + 1], 0)
        three = np.where(follows[:n] & follows[1 : n + 1], after[2 : n + 2], 0)
        key, count = np.unique(((c[:n] + 1) * base + two) * base + three, return_counts=True)
        pair, three = np.divmod(key, base)
        one, two = np.divmod(pair, base)
        if names is not None:
            back = np.concatenate([[0], names + 1])
            one, two, three = back[one], back[two], back[three]
        yield one, two, three, count


def _message(lang: str, distinct: list[bytes], one: np.ndarray, two: np.ndarray, three: np.ndarray, count: np.ndarray) -> bytes:
    used, place = np.unique(np.concatenate([[0], one, two, three]), return_inverse=True)
    one, two, three = np.split(place[1:], 3)
    words = b"\n".join([distinct[i] for i in (used[1:] - 1).tolist()])
    columns = [np.diff(one, prepend=0), two, three, count]
    return B.joined([lang.encode(), B.squeeze(words), *map(B.packed, columns)])


def _messages(first: np.ndarray, parts: np.ndarray):
    """For ``mapInArrow``: a block's suffixes, one row for each group."""

    def make(block: int, docs: pa.Table) -> list[tuple]:
        out = []
        for lang, code, distinct, piece in _by_lang(docs):
            bucket, number = _buckets(lang, distinct), np.append(np.uint64(0), numbers(distinct))
            for one, two, three, count in _suffixes(code, piece, len(distinct)):
                own = bucket[one - 1]
                rest = mixed(mixed(number[two]) + number[three])
                group = first[own] + (rest % parts[own].astype(np.uint64)).astype(np.int64)
                order = np.lexsort((one, group))
                edges = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1)).tolist()
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    i = order[a:b]
                    split = int(parts[own[i[0]]] > 1)
                    out.append((split, int(group[i[0]]), block, 0, _message(lang, distinct, one[i], two[i], three[i], count[i])))
        return out

    filled = B.each_block(make)

    def run(batches):
        for rows in filled(batches):
            if rows.num_rows:
                yield rows

    return run


def _phrases(words: list[bytes], *codes: np.ndarray) -> list[str]:
    return [b" ".join([words[c - 1] for c in one]).decode() for one in zip(*(c.tolist() for c in codes), strict=True)]


def _subtrees(least: int):
    """For ``applyInArrow``: a group's phrases with their frequencies."""

    def read(rows: pa.Table) -> pa.Table:
        split = bool(rows["kind"][0].as_py())
        by_lang: dict[bytes, list[list[bytes]]] = {}
        for data in rows["data"]:
            lang, *body = B.parted(data.as_py())
            by_lang.setdefault(lang, []).append(body)
        out: list[tuple[list, list, list]] = []
        for lang, bodies in by_lang.items():
            blobs = [B.unsqueeze(b[0]) for b in bodies]
            data = np.frombuffer(b"\n".join(blobs), np.uint8)
            inside = data != 10
            starts, ends, _ = bounds(inside, np.array([0, len(data)]))
            code, distinct = coded(data, inside, starts, ends)
            columns: list[list[np.ndarray]] = [[], [], [], []]
            at = 0
            for blob, body in zip(blobs, bodies, strict=True):
                n = blob.count(b"\n") + 1
                names = np.append(0, code[at : at + n] + 1)
                at += n
                one, two, three, count = (B.unpacked(x).astype(np.int64) for x in body[1:])
                for held, x in zip(columns, (names[np.cumsum(one)], names[two], names[three], count), strict=True):
                    held.append(x)
            one, two, three, count = map(np.concatenate, columns)
            base = len(distinct) + 1
            # depth two, then depth three below it: the leaves
            pair, pair_of = np.unique(one * base + two, return_inverse=True)
            leaf, leaf_of = np.unique(pair_of * base + three, return_inverse=True)
            total = np.zeros(len(leaf), np.int64)
            np.add.at(total, leaf_of, count)
            above = leaf // base
            in_pair = np.zeros(len(pair), np.int64)
            np.add.at(in_pair, above, total)
            in_word = np.zeros(base, np.int64)
            np.add.at(in_word, pair // base, in_pair)
            few = 1 if split else least
            i = np.flatnonzero(in_word >= few)
            j = np.flatnonzero((in_pair >= few) & (pair % base > 0))
            k = np.flatnonzero((total >= least) & (leaf % base > 0))
            w1, w2 = np.divmod(pair, base)
            for size, names, f in (
                (1, _phrases(distinct, i), in_word[i]),
                (2, _phrases(distinct, w1[j], w2[j]), in_pair[j]),
                (3, _phrases(distinct, w1[above[k]], w2[above[k]], leaf[k] % base), total[k]),
            ):
                out.append(pa.table({
                    "lang": pa.array([lang.decode()] * len(names), pa.string()), "size": pa.array([size] * len(names), pa.int32()),
                    "phrase": pa.array(names, pa.string()), "f": pa.array(f, pa.int64()),
                }))
        return pa.concat_tables(out)

    return read


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Words and phrases that occur ``least`` times (``lang``, ``size``, ``phrase``, ``f``), and all words of each language."""
    spark = small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"))
    counted = materialize(
        rows.mapInArrow(_count_buckets, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    counts = np.zeros(BUCKETS, np.int64)
    for r in counted.where("bucket >= 0").collect():  # at most BUCKETS rows
        counts[r.bucket] = r.n
    first, parts = plan_groups(counts, budget)
    found = (
        rows.mapInArrow(_messages(first, parts), B.ROWS).groupBy("key")
        .applyInArrow(_subtrees(least), "lang string, size int, phrase string, f bigint")
    )
    whole = found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return materialize(whole), counted.where("bucket < 0").select("lang", "n")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, budget: int = BUDGET
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    held, sizes = phrase_counts(docs, text, lang, least, budget)
    word = F.split("phrase", " ")

    def part(start: int, n: int):
        return F.array_join(F.slice(word, start, n), " ")

    longer = held.where("size = 3")
    around = (
        longer.select("lang", "f", F.explode(F.array(part(1, 2), part(2, 2))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    )
    two = held.where("size = 2").join(around, ["lang", "phrase"], "left")
    two = two.where(F.col("longest").isNull() | (100 * F.col("longest") < INSIDE_PERCENT * F.col("f"))).drop("longest")
    cut = lambda k, n: F.struct(F.lit(k).alias("k"), part(1, k).alias("left"), part(k + 1, n - k).alias("right"))
    cuts = two.withColumn("cut", F.explode(F.array(cut(1, 2)))).unionByName(
        longer.withColumn("cut", F.explode(F.array(cut(1, 3), cut(2, 3))))
    ).select("lang", "phrase", F.col("f").alias("a"), "cut.*")
    for side in ("left", "right"):
        names = held.select("lang", F.col("phrase").alias(side), F.col("f").alias(side[0]))
        cuts = cuts.join(names, ["lang", side])
    wide = {x: F.col(x).cast("decimal(38,0)") for x in "alr"}
    scored = cuts.withColumn("over", wide["a"] * wide["a"] * F.lit(_SCALE).cast("decimal(38,0)")).withColumn("under", wide["l"] * wide["r"])
    scored = scored.withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "best.l", "best.r", "best.score").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
