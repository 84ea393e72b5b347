"""Pack token pieces into sequences by a configuration linear program over the length histogram.

Documents become pieces of at most ``room`` tokens. However many there are, the histogram has at most ``room`` lengths, so
the driver plans on counts: a configuration is a multiset of lengths that fits a sequence. Multiplicative weights
solve the covering program over configurations: lengths covered less weigh more, and a knapsack dynamic program over the
lengths that are not yet covered finds for each length the configuration worth most at these prices that has it. The
dearest ``EACH`` of them are used, each for a part of the scarcest of its lengths: half of what is left in the first
``STEPS`` pricings, then all of it, so the program ends when every length is covered, after ``STEPS`` pricings and
one for each length at most. The fractional uses are rounded up, best filled first, as far as pieces are left, and
the rest, of which no whole sequence of the program can be filled, is placed best fit in decreasing length, by counts.

Pieces of a length are numbered in parallel, over salted parts with offsets, and the plan's ranges of numbers
give each its sequence and offset. The plan has a row per configuration and length, so it depends on the
number of lengths and configurations, never on the number of pieces.

Defined cases: a null or empty text is one piece with only the end id; repeated rows are packed each; an empty table gives
an empty result; equal pieces may change places; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from meterbook.llm.pretokens import pieces_of
from meterbook.llm.runtime import TOKENIZER, small_batches, tokenizer_path
from meterbook.session import materialize

ROOM, END, STEPS, EACH, PART_ROWS = 2048, 0, 400, 256, 50_000
#: The worth of a length grows with this power of it, so that short pieces stay to fill gaps, and falls with what is covered.
POWER, RATE = 1.3, 1.0
#: A length counts as covered when no more than this share of it is left.
TOLERANCE = 1e-9

Plan = list[tuple[int, tuple[tuple[int, int], ...]]]


def _pieces(room: int, end: int, tokenizer: str):
    def cut(batches):
        pieces = pieces_of(tokenizer_path(tokenizer))
        for batch in batches:
            ids, rows = pieces.batch(batch.column(1))
            doc, number, start, length, crc = [], [], [], [], []
            tail = np.array([end], "<u4").tobytes()
            raw, at = ids.astype("<u4").tobytes(), rows.tolist()
            for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                own = raw[4 * a : 4 * b] + tail
                for k, p in enumerate(range(0, b - a + 1, room)):
                    part = own[4 * p : 4 * (p + room)]
                    doc.append(i)
                    number.append(k)
                    start.append(p)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def token_pieces(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", room: int = ROOM, end: int = END, tokenizer: str = TOKENIZER
) -> DataFrame:
    """The pieces of every document: number, start, length and CRC-32 of the little-endian ids."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _pieces(room, end, tokenizer), f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def priced(prices: np.ndarray, lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The most worth of each room and a length that it ends with, 0 for none: a knapsack, any length any number of times."""
    worth, last = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    fit = np.searchsorted(lengths, np.arange(room + 1), "right").tolist()
    for w in range(1, room + 1):
        worth[w] = worth[w - 1]
        if k := fit[w]:
            with_each = worth[w - lengths[:k]] + prices[:k]
            best = int(with_each.argmax())
            if with_each[best] > worth[w]:
                worth[w], last[w] = with_each[best], lengths[best]
    return worth, last


def configuration(last: np.ndarray, length: int, room: int) -> dict[int, int]:
    """What is worth most together with a piece of ``length``."""
    found = {length: 1}
    w = room - length
    while w > 0:
        if x := int(last[w]):
            found[x] = found.get(x, 0) + 1
            w -= x
        else:
            w -= 1
    return found


def fractional_uses(counts: dict[int, int], room: int, steps: int = STEPS) -> dict[tuple, float]:
    """Uses of configurations that cover the whole histogram, by multiplicative weights."""
    lengths = np.array(sorted(counts), np.int64)
    demand = np.array([counts[x] for x in lengths.tolist()], float)
    place = {x: i for i, x in enumerate(lengths.tolist())}
    left, uses, priced_times = demand.copy(), {}, 0
    base = (lengths / room) ** POWER
    while len(open_ := np.flatnonzero(left > 0)):
        own, price = lengths[open_], (base * np.exp(-RATE * (1 - left / demand)))[open_]
        worth, last = priced(price, own, room)
        dearest = np.argsort(-(price + worth[room - own]), kind="stable")[:EACH]
        for length in own[dearest].tolist():
            found = configuration(last, length, room)
            index = [place[x] for x in found]
            if not left[index].all():  # another configuration has just used up one of its lengths
                continue
            amount = np.array(list(found.values()), float)
            most = float(np.min(left[index] / amount))
            step = min(most, most / 2 + 0.5) if priced_times < steps else most
            rest = left[index] - step * amount
            left[index] = np.where(rest > TOLERANCE * demand[index], rest, 0.0)
            key = tuple(sorted(found.items(), reverse=True))
            uses[key] = uses.get(key, 0.0) + step
        priced_times += 1
    return uses


def best_fit(left: dict[int, int], room: int) -> Plan:
    """Best fit in decreasing length over counts; equal sequences are one entry."""
    open_at: dict[int, list[list]] = {}
    done: Plan = []
    smallest = min(left, default=0)

    def put(space: int, count: int, items: tuple) -> None:
        if count:
            open_at.setdefault(space, []).append([count, items])

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            space = min((s for s in open_at if s >= length and open_at[s]), default=None)
            if space is None:
                each = room // length
                put(room - each * length, n // each, ((length, each),))
                if rest := n % each:
                    put(room - rest * length, 1, ((length, rest),))
                break
            count, items = open_at[space].pop()
            each = min(space // length, n)
            used = min(count, n // each)
            put(space, count - used, items)
            put(space - each * length, used, (*items, (length, each)))
            n -= used * each
        for space in [s for s in open_at if s < smallest]:
            done += [(c, i) for c, i in open_at.pop(space)]
    return done + [(c, i) for groups in open_at.values() for c, i in groups]


def plan_sequences(counts: dict[int, int], room: int = ROOM, steps: int = STEPS) -> Plan:
    """(number of sequences, their lengths and how many of each) for a length histogram."""
    if not counts:
        return []
    left, plan = dict(counts), []
    for key, use in sorted(fractional_uses(counts, room, steps).items(), key=lambda x: -sum(n * a for n, a in x[0])):
        whole = min([int(np.ceil(use - 1e-6)), *(left[n] // a for n, a in key)])
        if whole > 0:
            plan.append((whole, key))
            for n, a in key:
                left[n] -= whole * a
    rest = {n: c for n, c in left.items() if c}
    return plan + (best_fit(rest, room) if rest else [])


def plan_ranges(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """Per configuration and length: numbers from and to, sequences, first sequence, offset of the first."""
    given: dict[int, int] = {}
    rows, sequence = [], 0
    for count, items in plan:
        offset = 0
        for length, each in items:
            at = given.get(length, 0)
            given[length] = at + count * each
            rows.append((length, at, at + count * each, count, sequence, offset))
            offset += each * length
        sequence += count
    return rows


def pack(pieces: DataFrame, room: int = ROOM, steps: int = STEPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length``."""
    spark = pieces.sparkSession
    held = materialize(pieces)
    histogram = held.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    # at most ``room`` rows by construction
    counts = {r.length: r.n for r in histogram.collect()}
    ranges = spark.createDataFrame(
        plan_ranges(plan_sequences(counts, room, steps)),
        "of bigint, from_no bigint, to_no bigint, each bigint, first bigint, at bigint",
    )
    per_length = spark.createDataFrame(
        [(n, -(-c // PART_ROWS)) for n, c in counts.items()], "length bigint, salts bigint"
    )
    names = held.columns
    salted = held.join(F.broadcast(per_length), "length").withColumn(
        "salt", F.pmod(F.xxhash64(*[c for c in names if c != "length"]), F.col("salts"))
    )
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"))
    )
    inside = Window.partitionBy("length", "salt").orderBy(*[c for c in names if c != "length"])
    numbered = salted.join(offsets, ["length", "salt"]).withColumn(
        "no", F.col("skipped") + F.row_number().over(inside) - 1
    )
    hit = (F.col("length") == F.col("of")) & (F.col("no") >= F.col("from_no")) & (F.col("no") < F.col("to_no"))
    step = F.col("no") - F.col("from_no")
    return numbered.join(F.broadcast(ranges), hit).select(
        *names,
        (F.col("first") + step % F.col("each")).alias("sequence_id"),
        (F.col("at") + F.floor(step / F.col("each")) * F.col("length")).alias("offset"),
    )
