"""Repair of conversation structure by the cheapest edits, decided by one integer minimum.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Keep costs 0, Rerole to user or assistant 3, Delete 4,
Insert of an empty user or assistant turn 3; a truncated row that is not deleted adds 3, and blank and duplicate rows must
go. The choices form a graph without cycles: a layer for each row, in it the four states start, ``s``, ``u`` and ``a``, and at
most two inserts before a row. A path's weight is one integer: its high digits are the cost, its low digits the
edits' initials, three bits each, from the highest place down, with zeros behind the last. The smaller of two integers is then
the cheaper path and, of equal costs, the one whose initials come first in ASCII; the rest is an ordinary shortest path.

Rows go by turn (nulls first), then role, then SHA-256 of the text. They are dealt by ranges of that order, so a
conversation may span any number of tasks: each task gives its part as a 4 by 4 matrix of weights (from state, to state), and
the parts' matrices are multiplied in order. Inside a task long parts are cut into ``CHUNK`` rows and multiplied as a tree.
This part moves no texts, and equal rows move once with their number. Then texts meet the edits of their conversation in
one sorted stream, which is what the hash of a whole conversation needs; it holds one batch and the initials.

Defined cases: a null role or text is one space, a null conversation id is a conversation of its own; a role without an initial
of s, u or a cannot be kept; without rows there are no edits; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from meterbook.llm import blocks as B
from meterbook.llm.runtime import parts, small_batches
from meterbook.session import materialize

#: Rows whose edits are decided in one go, and decided chunks that a worker remembers.
CHUNK, REMEMBERED = 256, 1 << 14
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Edits in ASCII order; an edit's digit is its place from 1.
EDITS = "DIKR"
START, S, U, A = range(4)
#: The state after an inserted or reroled row, and what each initial may follow.
_AFTER = {START: U, S: U, U: A, A: U}
_KEPT = {"s": {START: S}, "u": {START: U, S: U, A: U}, "a": {U: A}}
#: Symbol of a row that must go; other rows have their initial (``o`` for any other), in capitals if truncated.
GONE = "d"
_ROLE = {U: "user", A: "assistant"}

Entry = tuple[int, str] | None
Matrix = list[list[Entry]]


def weight(cost: int, edits: str, width: int) -> int:
    """Cost in the high digits, edits in ``width`` octal digits, zeros at their end."""
    digits = edits.translate(_DIGITS) + "0" * (width - len(edits))
    return (cost << 3 * width) | int(digits or "0", 8)


_DIGITS = str.maketrans({c: str(i) for i, c in enumerate(EDITS, 1)})
_LETTERS = str.maketrans({str(i): c for i, c in enumerate(EDITS, 1)})


def unweighted(value: int, width: int) -> tuple[int, str]:
    digits = value & ((1 << 3 * width) - 1)
    return value >> 3 * width, f"{digits:0{width}o}".rstrip("0").translate(_LETTERS) if width else ""


def _before(values: list[int | None], symbol: str, shift: int) -> list[int | None]:
    """The least weights in front of a row from those behind it, by state."""
    mask = (1 << shift) - 1

    def led(value: int | None, cost: int, edit: str) -> int | None:
        if value is None:
            return None
        digit = EDITS.index(edit) + 1
        return (((value >> shift) + cost) << shift) | (digit << (shift - 3)) | ((value & mask) >> 3)

    least = lambda found: min((v for v in found if v is not None), default=None)
    extra = TRUNCATED if symbol.isupper() else 0
    kept = _KEPT.get(symbol.lower(), {})
    straight = []
    for state in range(4):
        found = [led(values[state], DELETE, "D")]
        if symbol != GONE:
            found.append(led(values[_AFTER[state]], REROLE + extra, "R"))
            if state in kept:
                found.append(led(values[kept[state]], extra, "K"))
        straight.append(least(found))
    out = straight
    for _ in range(2):  # a third insert would lead back to a state at a higher cost
        out = [least([straight[s], led(out[_AFTER[s]], INSERT, "I")]) for s in range(4)]
    return out


@lru_cache(REMEMBERED)
def chunk_matrix(pattern: str) -> Matrix:
    """Cost and edits from each state to each state over at most ``CHUNK`` rows."""
    width = 3 * len(pattern)
    columns = []
    for end in range(4):
        values: list[int | None] = [0 if s == end else None for s in range(4)]
        for symbol in reversed(pattern):
            values = _before(values, symbol, 3 * width)
        columns.append([None if v is None else unweighted(v, width) for v in values])
    return [[columns[e][s] for e in range(4)] for s in range(4)]


def product(left: Matrix, right: Matrix) -> Matrix:
    """The least weights over both parts."""
    longest = lambda m: max((len(x[1]) for row in m for x in row if x), default=0)
    width = longest(left) + longest(right)
    out: Matrix = []
    for row in left:
        made: list[Entry] = []
        for end in range(len(right[0])):
            found = [
                weight(a[0] + b[0], a[1] + b[1], width)
                for a, b in ((row[mid], right[mid][end]) for mid in range(4)) if a and b
            ]
            made.append(unweighted(min(found), width) if found else None)
        out.append(made)
    return out


def matrix(pattern: str) -> Matrix:
    level = [chunk_matrix(pattern[i : i + CHUNK]) for i in range(0, max(1, len(pattern)), CHUNK)]
    while len(level) > 1:
        level = [product(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


#: What completes a conversation from each state.
_CLOSE: Matrix = [[(0, "")], [(2 * INSERT, "II")], [(INSERT, "I")], [(0, "")]]


def edits_of(parts_: list[Matrix]) -> tuple[int, str]:
    """The cheapest edits of a conversation from its parts in order."""
    last = _CLOSE
    for one in reversed(parts_):
        last = product(one, last)
    return last[START][0]


@lru_cache(REMEMBERED)
def _edits(pattern: str) -> tuple[int, str]:
    return edits_of([matrix(pattern)])


_PLAN = "conv_id {id}, part int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, matrix binary, ends string"


def _packed(m: Matrix) -> bytes:
    return B.squeeze("|".join("" if x is None else f"{x[0]},{x[1]}" for row in m for x in row).encode())


def _unpacked(data: bytes) -> Matrix:
    entries = [(int(c), e) if c else None for c, _, e in (x.partition(",") for x in B.unsqueeze(data).decode().split("|"))]
    return [entries[i : i + 4] for i in range(0, 16, 4)]


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def _plan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations with their edits; the first and last of a task, which may go on elsewhere, with a matrix."""
    task = TaskContext.get().partitionId()
    out: list[tuple] = []
    id_type = None
    held: list | None = None
    first = True

    def close(cut: bool) -> None:
        conv, initials, pattern, blank, duplicate, truncated = held
        initials, pattern = "".join(initials), "".join(pattern)
        cost, edits = (None, None) if cut else _edits(pattern) if len(pattern) <= CHUNK else edits_of([matrix(pattern)])
        out.append((conv, task, blank, duplicate, truncated, _illegal(initials), cost, edits,
                    _packed(matrix(pattern)) if cut else None, initials[0] + initials[-1]))

    for batch in batches:
        id_type = batch.schema.field(0).type
        for conv, initial, fault, fresh, n in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if held is None or conv != held[0]:
                if held is not None:
                    close(first)
                    first = False
                held = [conv, [], [], 0, 0, 0]
            held[1].append(initial * n)
            copies = n - 1 if fresh else n
            if fault == "blank":
                held[3] += n
                copies = n
            else:
                held[4] += copies
                if fresh:
                    held[5] += fault == "truncated"
                    held[2].append(initial.upper() if fault == "truncated" else initial)
            held[2].append(GONE * copies)
        if out:
            yield _rows(out, id_type)
            out.clear()
    if held is not None:
        close(True)
    if out:
        yield _rows(out, id_type)


def _rows(out: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.string()]
    return _batch(out, types, ["conv_id", "part", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "matrix", "ends"])


def _batch(out: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _join_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from their parts, which come in order."""
    held: list[dict] = []

    def whole() -> tuple:
        cost, edits = edits_of([_unpacked(x["matrix"]) for x in held])
        ends = "".join(x["ends"] for x in held)
        between = sum(_illegal(ends[i : i + 2]) for i in range(1, len(ends) - 1, 2))
        total = [sum(x[c] for x in held) for c in ("blank", "duplicate", "truncated", "illegal")]
        return (held[0]["conv_id"], 0, *total[:3], total[3] + between, cost, edits, None, ends[0] + ends[-1])

    id_type = None
    for batch in batches:
        id_type, out = batch.schema.field(0).type, []
        for row in batch.to_pylist():
            if held and row["conv_id"] != held[0]["conv_id"]:
                out.append(whole())
                held = []
            held.append(row)
        if out:
            yield _rows(out, id_type)
    if held:
        yield _rows([whole()], id_type)


def damage(rows: DataFrame) -> DataFrame:
    """Drops, empties, truncates, repeats or reroles rows by the checksum of ``conv_id:turn``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    plain = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], kind.alias("_kind"))
    return plain.where("_kind <> 0").select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _plain(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    out = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("role", "text")])
    return out.withColumn("digest", F.unhex(F.sha2("text", 256)))


def plan_repairs(rows: DataFrame) -> DataFrame:
    """Per conversation: ``gaps``, counts of faults, ``illegal`` pairs, ``cost`` and ``audit``, the initials of the edits."""
    spark = small_batches(rows.sparkSession)
    text = F.col("text")
    fault = (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("none")
    )
    initial = F.substring("role", 1, 1)
    keys = _plain(rows).select(
        "conv_id", "turn", "role", "digest", fault.alias("fault"), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial")
    )
    same = keys.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.first("fault").alias("fault"), F.first("initial").alias("initial")
    )
    held = materialize(same)
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    repeated = (
        held.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns"))
        .where("turns > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")], "first")
    )
    match = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    marked = held.join(repeated, match, "left").withColumn("fresh", F.col("first").isNull() | turn.eqNullSafe(F.col("first")))
    ordered = marked.repartitionByRange(parts(spark), *_order()).sortWithinPartitions(*_order())
    id_type = rows.schema["conv_id"].dataType.simpleString()
    schema = _PLAN.format(id=id_type)
    pieces = materialize(ordered.select("conv_id", "initial", "fault", "fresh", "n").mapInArrow(_plan, schema))
    cut = pieces.where("matrix is not null").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    plans = pieces.where("matrix is null").unionByName(cut.mapInArrow(_join_parts, schema)).drop("part", "matrix", "ends")
    turns = held.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps")
    )
    paired = plans.join(turns.withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")))
    return paired.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _edited(audit: str) -> Callable[[str, str], Iterator[tuple[str, str, str]]]:
    """A function to call with each row in order: it gives the rows that stay or come in up to it, with their edit."""
    state, at = START, 0

    def inserts() -> Iterator[tuple[str, str, str]]:
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            state, at = _AFTER[state], at + 1
            yield "I", _ROLE[state], ""

    def row(role: str | None, text: str | None) -> Iterator[tuple[str, str, str]]:
        nonlocal state, at
        yield from inserts()
        if role is None:  # behind the last row
            return
        edit, at = audit[at], at + 1
        if edit == "K":
            state = _KEPT[role[0]][state]
            yield edit, role, text
        elif edit == "R":
            state = _AFTER[state]
            yield edit, _ROLE[state], text

    return row


def _walk(batches: Iterable[pa.RecordBatch], types: list[pa.DataType]) -> Iterator[tuple]:
    """Steps through sorted rows, a conversation's header (its audit) and then its rows.

    ("open", id), ("row", edit, role, text), ("close", id), and ("pause",) behind each batch.
    """
    conv = row = None
    for batch in batches:
        types[:] = [batch.schema.field(0).type]
        for own, audit, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if audit is None:
                yield from (("row", *made) for made in row(role, text))
                continue
            if row:
                yield from (("row", *made) for made in row(None, None))
                yield "close", conv
            conv, row = own, _edited(audit)
            yield "open", conv
        yield ("pause",)
    if row:
        yield from (("row", *made) for made in row(None, None))
        yield "close", conv
        yield ("pause",)


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types: list[pa.DataType] = []
    out: list[tuple] = []
    for step, *made in _walk(batches, types):
        if step == "open":
            digest, between = hashlib.sha256(), b""
        elif step == "row":
            digest.update(between + f"{made[1]}:{made[2]}".encode())
            between = b"\n"
        elif step == "close":
            out.append((made[0], digest.hexdigest()))
        elif out:
            yield _batch(out, [types[0], pa.string()], ["conv_id", "repaired_sha256"])
            out = []


def _listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types: list[pa.DataType] = []
    out: list[tuple] = []
    for step, *made in _walk(batches, types):
        if step == "open":
            conv, place = made[0], 0
        elif step == "row":
            out.append((conv, place, *made))
            place += 1
        elif step == "pause" and out:
            yield _batch(out, [types[0], pa.int64(), *[pa.string()] * 3], ["conv_id", "place", "edit", "role", "text"])
            out = []


def _beside(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Texts behind the edits of their conversation, in one sorted stream."""
    texts = _plain(rows).select("conv_id", F.lit(None).cast("string").alias("audit"), "role", "text", "turn", "digest", F.lit(1).alias("kind"))
    empty = {c: F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("role", "text", "turn", "digest")}
    heads = plans.select("conv_id", "audit", *empty.values(), F.lit(0).alias("kind"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("kind"), *_order()[1:]]
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)
    return both.select("conv_id", "audit", "role", "text")


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` from 0, ``edit``, ``role`` and ``text``."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    return _beside(rows, plans).mapInArrow(_listed, f"conv_id {id_type}, place bigint, edit string, role string, text string")


def repaired_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation, its ``role:text`` rows joined by newlines."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    return _beside(rows, plans).mapInArrow(_hashed, f"conv_id {id_type}, repaired_sha256 string")


def repair_digest(original: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for each id of ``original`` with the repair of its rows in ``rows``; without rows zeros and empty texts."""
    plans = materialize(plan_repairs(rows))
    hashes = repaired_digests(rows, plans).select(F.col("conv_id").alias("_hash_id"), "repaired_sha256")
    ids = original.select(F.col("conv_id").alias("_own")).distinct()
    joined = ids.join(plans, F.col("_own").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    joined = joined.join(hashes, F.col("_own").eqNullSafe(F.col("_hash_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.col("_own").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
