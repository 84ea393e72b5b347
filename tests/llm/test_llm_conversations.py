"""Conversation repair against trying all edits."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterbook.llm import conversations as C

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "none")
        seen.add((role, text))
    return out


def brute(rows):
    """Cost, edits and repaired rows by trying every edit of every row and every insert."""
    found = faults(rows)
    gaps = ["", "u", "a", "ua", "au"]
    choices = []
    for (role, text), fault in zip(rows, found, strict=True):
        own = [(4, "D", "", None)]
        if fault in ("none", "truncated"):
            extra = 3 * (fault == "truncated")
            own.append((extra, "K", role[:1] if role[:1] in ("s", "u", "a") else "?", (role, text)))
            own += [(3 + extra, "R", r[0], (r, text)) for r in ("user", "assistant")]
        choices.append(own)
    insert = lambda g: [(3 * len(g), "I" * len(g), g, *[({"u": "user", "a": "assistant"}[x], "") for x in g])]
    best = None
    slots = []
    for own in choices:
        slots += [[insert(g)[0] for g in gaps], own]
    slots.append([insert(g)[0] for g in gaps])
    for pick in itertools.product(*slots):
        if not LEGAL.match("".join(x[2] for x in pick)):
            continue
        value = (sum(x[0] for x in pick), "".join(x[1] for x in pick))
        if best is None or value < best[:2]:
            best = (*value, [r for x in pick for r in x[3:] if r])
    return best


def made_conversations():
    rng = np.random.default_rng(4)
    texts, roles = ["yes.", "no", "", "why? ", "  \n", "ok!"], ["user", "assistant", "system", "tool", "user"]
    out = [[(roles[rng.integers(5)], texts[rng.integers(6)]) for _ in range(n)] for n in (0, 1, 1, 2, 2, 2, 3, 3, 3, 3, 3, 3)]
    return [*out, [("system", "go.")], [("user", "a."), ("user", "a."), ("assistant", "b")], [("assistant", "b."), ("user", "x.")]]


@pytest.mark.parametrize("rows", made_conversations())
def test_edits_are_the_cheapest(rows):
    cost, edits, kept = brute(rows)
    pattern = "".join(
        C.GONE if f in ("blank", "duplicate") else (i.upper() if f == "truncated" else i)
        for (r, _), f in zip(rows, faults(rows), strict=True) for i in [r[:1] if r[:1] in "sua" else "o"]
    )
    assert C.edits_of([C.matrix(pattern)] if rows else []) == (cost, edits)
    # in parts of every length
    for n in range(1, len(rows)):
        assert C.edits_of([C.matrix(pattern[i : i + n]) for i in range(0, len(pattern), n)]) == (cost, edits)
    walk = C._edited(edits)
    made = [x for r in rows for x in walk(*r)] + list(walk(None, None))
    assert [(r, t) for _, r, t in made] == kept


def test_long_patterns_are_cut(monkeypatch):
    pattern = "".join("suadUAo"[i] for i in np.random.default_rng(5).integers(0, 7, 700))
    whole = C.edits_of([C.matrix(pattern)])
    monkeypatch.setattr(C, "CHUNK", 11)
    assert C.edits_of([C.matrix(pattern)]) == whole
    assert C.edits_of([C.matrix(pattern[:333]), C.matrix(pattern[333:])]) == whole


def expected(original):
    out = {}
    for conv in {c for c, *_ in original}:
        rows = []
        for c, turn, role, text in original:
            if c != conv:
                continue
            role, text = (" " if x is None else x for x in (role, text))
            kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (c, turn)).encode()) % 20
            if kind == 0:
                continue
            role = "user" if kind == 4 else role
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest(), text)] * (2 if kind == 3 else 1)
        rows.sort()
        pairs = [(r[2], r[4]) for r in rows]
        found, turns = faults(pairs), [r[1] for r in rows if r[0]]
        ini = [r[0][:1] for r in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(ini))
        cost, edits, kept = brute(pairs) if len(pairs) < 5 else (None, None, None)
        text = None if kept is None else hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
                     illegal, cost, edits, text)
    return out


def test_whole_job(spark):
    original = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 5, "user", "more"), (2, None, None, None), (None, 1, "user", "x."),
        (None, 2, "assistant", "y."), (3, 2, "", "."), (3, 2, "", "."), (3, 3, "user", "   "), (4, 0, "user", "é!"), (4, 0, "user", "a."),
        *[(k, t, ("user", "assistant")[t % 2], f"t{t}{'.' * (k % 2)}") for k in range(5, 60) for t in range(3)],
        *[(99, 7, "user", "same.")] * 40, *[(99, t, "assistant", "same.") for t in range(3000)],
    ]
    frame = spark.createDataFrame(original, "conv_id bigint, turn bigint, role string, text string").withColumn("audit", F.lit("x"))
    frame = frame.repartition(4)
    rows = C.damage(frame).withColumn("digest", F.lit(0))
    got = {r.conv_id: tuple(r)[1:] for r in C.repair_digest(frame, rows).collect()}
    want = expected(original)
    assert got.keys() == want.keys()
    for conv, own in want.items():
        assert got[conv][: 5 if own[5] is None else 8] == own[: 5 if own[5] is None else 8], conv
    plans = C.plan_repairs(rows)
    texts = {}
    for r in sorted(C.repaired_rows(rows, plans).collect(), key=lambda r: (str(r.conv_id), r.place)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, own in got.items():
        assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == own[7]


def test_conversation_over_many_tasks(spark):
    rows = [(1, t, "suax"[(t * t + t // 3) % 4], f"w{t % 900}{'.' * (t % 3)}") for t in range(2000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    plan = C.plan_repairs(frame).collect()
    pairs = [(r, t) for _, _, r, t in rows]
    found = faults(pairs)
    pattern = "".join(
        C.GONE if f in ("blank", "duplicate") else (r[0].upper() if f == "truncated" else r[0]).replace("x", "o").replace("X", "O")
        for (r, _), f in zip(pairs, found, strict=True)
    )
    assert len(plan) == 1 and (plan[0].cost, plan[0].audit) == C.edits_of([C.matrix(pattern)])
    assert (plan[0].duplicate, plan[0].truncated) == (found.count("duplicate"), found.count("truncated"))
    assert plan[0].illegal == sum(a[0][0] + b[0][0] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert C.repair_digest(frame, C.damage(frame)).count() == 0
