"""Personal data and the terms that give it away, by information theory over the whole corpus.

Patterns find the protected entities: addresses, numbers and cards (the base). What else discloses an entity is learned from
co-occurrence: a term is a word of 3 to 64 letters or digits, not digits alone, and it co-occurs with an entity in a document where it stands among
the ``WINDOW`` words on either side of it. With N documents, the entity tells ``IC(e) = log2(N / df(e))`` bits, and a term
tells ``PMI(e; t) = log2(N df(e, t) / (df(e) df(t)))`` of them. A term whose share ``PMI / IC`` of some entity reaches
``REMOVE`` is removed, one that reaches ``GENERALISE`` is generalised, wherever it occurs. A share of 1 says that the term
occurs only with the entity. ``CONTEXTS`` different surroundings must support a pair, so one passage in many copies is one.

Pairs come from the windows only, so their number grows with the personal data found. Document frequencies count all
documents. Which words to count, and later to look up, passes to the tasks as a bit map of fixed size (``BITS``); what it lets
through is joined to the exact list, which no task holds.

Spans are code points of the text as given, the end exclusive. Term spans do not touch base spans; base spans stay as they are.

Defined cases: null counts as empty; repeated rows count each; a null id is an id; an empty table gives an empty result; an entity in
every document has no information and discloses nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterbook.llm.runtime import small_batches
from meterbook.llm.textnum import bounds, coded, lower, text_bytes
from meterbook.session import materialize

#: Words on either side, supporting surroundings, shares of an entity's information, bits of the word map.
WINDOW, CONTEXTS, GENERALISE, REMOVE, BITS = 16, 3, 0.9, 0.97, 1 << 23
#: Kinds in order; the last is the method's.
KINDS = ["email", "ip", "card", "phone", "term"]
TERM = len(KINDS) - 1

#: The classes of the patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_OTHER = re.compile(r"[^0-9]+")
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_INSIDE = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        # a domain holds no other sign of its kind
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Each run of dotted numbers in fours; a four with a part above 255 is passed over."""
    for run in _DOTTED.finditer(text):
        numbers = run.group().split(".")
        at = run.start()
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of the base kinds, in order."""
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        found += [(a, 1, b) for a, b in _addresses(text)]
        for m in _GROUPED.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(digits := _OTHER.sub("", m.group())) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_OTHER.sub("", m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity(text: str, kind: int, start: int, end: int) -> str:
    """The key of a protected entity: the same for the same value, however it is written."""
    raw = text[start:end]
    value = raw.lower() if kind == 0 else ".".join(x.lstrip("0") or "0" for x in raw.split(".")) if kind == 1 else _OTHER.sub("", raw)
    return hashlib.blake2b(f"{KINDS[kind]}:{value}".encode(), digest_size=16).hexdigest()


def is_term(word: str) -> bool:
    return 3 <= len(word) <= 64 and not (word.isascii() and word.isdigit())


def _lowered(word: str) -> str:
    return lower(np.frombuffer(word.encode(), np.uint8)).tobytes().decode()


def surroundings(text: str, spans: list[tuple[int, int, int]], window: int) -> dict[str, tuple[set[str], str]]:
    """Per entity of a text the terms around it and a fingerprint of all words around it."""
    words: list[tuple[int, int]] = []
    ends = iter(spans)
    blocked = 0
    ahead = next(ends, None)
    for m in _WORD.finditer(text):
        while ahead and ahead[0] < m.end():
            blocked, ahead = max(blocked, ahead[2]), next(ends, None)
        if m.start() >= blocked:
            words.append(m.span())
    starts = [a for a, _ in words]
    out: dict[str, tuple[set[str], str]] = {}
    around: dict[str, list[str]] = {}
    for start, kind, end in spans:
        i, j = np.searchsorted(starts, [start, end]).tolist()
        near = [_lowered(text[a:b]) for a, b in words[max(0, i - window) : j + window]]
        around.setdefault(entity(text, kind, start, end), []).extend(near)
    for key, near in around.items():
        out[key] = ({w for w in near if is_term(w)}, hashlib.blake2b("\n".join(near).encode(), digest_size=16).hexdigest())
    return out


def _pairs(window: int):
    def run(batches):
        for batch in batches:
            keys, terms, prints = [], [], []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text) if text else []
                for key, (near, mark) in (surroundings(text, spans, window) if spans else {}).items():
                    keys.append(key)
                    terms.append(sorted(near))
                    prints.append(mark)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(prints), pa.array(terms, pa.list_(pa.string()))], names=["entity", "context", "terms"]
                )

    return run


def bit_map(terms: DataFrame, bits: int = BITS) -> np.ndarray:
    """One bit for each bucket of the terms' checksums; ``bits / 64`` numbers at most, whatever the number of terms."""
    bucket = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bucket, F.lit(64)).cast("int"))
    slots = terms.groupBy(F.floor(bucket / 64).alias("slot")).agg(F.bit_or(one).alias("bits"))
    out = np.zeros(bits // 64, np.int64)
    for r in slots.collect():
        out[r.slot] = r.bits
    return out


def _marked_words(column, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words that the map lets through: row, start and end in code points, code, and the words by code."""
    raw, offsets = text_bytes(column)
    inside = _INSIDE[raw]
    starts, ends, rows = bounds(inside, offsets)
    code, distinct = coded(lower(raw), inside, starts, ends)
    bucket = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) % (64 * len(bits))
    held = ((bits[bucket >> 6] >> (bucket & 63)) & 1).astype(bool)
    there = np.flatnonzero(held[code])
    row = np.searchsorted(rows, there, "right") - 1
    # bytes in front that begin a code point
    points = np.append(0, np.cumsum((raw & 0xC0) != 0x80)) if len(there) else np.zeros(len(raw) + 1, np.int64)
    base = points[offsets[row]]
    return row, points[starts[there]] - base, points[ends[there]] - base, code[there], distinct


def _frequencies(bits: np.ndarray):
    def run(batches):
        for batch in batches:
            row, _, _, code, distinct = _marked_words(batch.column(0), bits)
            if len(row):
                seen = np.unique(row * len(distinct) + code) % len(distinct)
                codes, count = np.unique(seen, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([distinct[c].decode() for c in codes.tolist()]), pa.array(count, pa.int64())], names=["term", "df"]
                )

    return run


def disclosing_terms(
    docs: DataFrame, text: str = "text", window: int = WINDOW, contexts: int = CONTEXTS,
    generalise: float = GENERALISE, remove: float = REMOVE, bits: int = BITS,
) -> DataFrame:
    """``term``, ``disclosure`` (its greatest share of an entity's information) and ``action``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"))
    held = materialize(rows.mapInArrow(_pairs(window), "entity string, context string, terms array<string>"))
    near = held.select("entity", "context", F.explode("terms").alias("term"))
    pairs = near.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n")).groupBy("entity", "term").agg(
        F.sum("n").alias("df_both"), F.count(F.lit(1)).alias("contexts")
    )
    candidates = materialize(pairs.where(F.col("contexts") >= contexts))
    found = rows.mapInArrow(_frequencies(bit_map(candidates.select("term"), bits)), "term string, df bigint")
    df_term = found.groupBy("term").agg(F.sum("df").alias("df_term"))
    df_entity = held.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"))
    n = rows.agg(F.count(F.lit(1)).cast("double").alias("docs")).scalar()
    told = candidates.join(df_term, "term").join(df_entity, "entity").withColumn("docs", n)
    information = F.log2(F.col("docs") / F.col("df_entity"))
    mutual = F.log2(F.col("docs") * F.col("df_both") / (F.col("df_entity") * F.col("df_term")))
    share = told.where("docs > df_entity").groupBy("term").agg(F.max(mutual / information).alias("disclosure"))
    action = F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")
    return share.where(F.col("disclosure") >= generalise).withColumn("action", action)


def _find(bits: np.ndarray):
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    hit = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("term", pa.string())])

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [base_spans(t) if t else [] for t in texts]
            hits: list[list[dict]] = [[] for _ in texts]
            covered: list[list[tuple[int, int]]] = [[] for _ in texts]
            row, starts, ends, codes, distinct = _marked_words(batch.column(1), bits)
            for i, start, end, code in zip(row.tolist(), starts.tolist(), ends.tolist(), codes.tolist(), strict=True):
                if base[i] and not covered[i]:
                    covered[i] = _joined(base[i])
                # the first covered stretch that ends behind the word's start
                at = bisect_right(covered[i], start, key=lambda s: s[1])
                if at == len(covered[i]) or covered[i][at][0] >= end:
                    hits[i].append({"start": start, "end": end, "term": distinct[code].decode()})
            spans = [[{"start": a, "kind": k, "end": b} for a, k, b in own] for own in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, pa.list_(span)), pa.array(hits, pa.list_(hit))],
                names=["doc_id", "text", "base", "hits"],
            )

    return run


def _joined(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What the spans cover, without overlaps."""
    out: list[tuple[int, int]] = []
    for start, _, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_spans(docs: DataFrame, terms: DataFrame, id_column: str = "doc_id", text: str = "text", keep_text: bool = False, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``base`` and ``added`` (arrays of start, kind, end), and the text if asked for."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(
        _find(bit_map(terms, bits)),
        f"doc_id {id_type}, text string, base array<struct<start:bigint,kind:int,end:bigint>>, "
        "hits array<struct<start:bigint,end:bigint,term:string>>",
    )
    made = made if keep_text else made.drop("text")
    held = materialize(made.withColumn("row", F.monotonically_increasing_id()))
    open_ = held.where(F.size("hits") > 0)
    each = open_.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    sure = each.join(terms.select("term", "action"), "term").groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(TERM).alias("kind"), "end", "action")).alias("added")
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,action:string>>")
    plain = held.where(F.size("hits") == 0).withColumn("added", none)
    added = open_.join(sure, "row", "left").withColumn("added", F.coalesce("added", none))
    return plain.unionByName(added).drop("row", "hits")


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def span_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the base's checksum and all spans as text."""
    own = F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(TERM)], F.size("added").cast("bigint").alias("n_term"),
        F.sha2(_written(F.array_sort("base")), 256).alias("base_sha256"), _written(F.array_sort(F.concat("base", own))).alias("spans"),
    )


def _replaced(batches):
    for batch in batches:
        texts = []
        for text, base, added in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            spans = sorted((s["start"], s["end"], _PLACE.get(s.get("action"), f"[{KINDS[s['kind']]}]")) for s in base + added)
            out, at = [], 0
            for start, end, place in spans:
                if start >= at:  # of spans that overlap the first gives the name
                    out += [text[at:start], place]
                at = max(at, end)
            texts.append(None if text is None else "".join([*out, text[at:]]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


#: What stands for a term that is generalised or removed.
_PLACE = {"generalise": "[term]", "remove": ""}


def sanitised(docs: DataFrame, terms: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` with base spans replaced by their kind and terms by their action."""
    found = find_spans(docs, terms, id_column, text, keep_text=True).select("doc_id", "text", "base", "added")
    id_type = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(_replaced, f"doc_id {id_type}, text string")
