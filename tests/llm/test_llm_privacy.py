"""Personal data against the contract's own patterns, and disclosing terms against plain counts."""

import hashlib
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from meterbook.llm import privacy as P

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                each = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
                if not 12 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in each) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=3000, deadline=None)
@given(st.one_of(
    st.text("a1@.-+% ", max_size=30), st.text("0127.", max_size=40), st.text("+1 ().-x", max_size=40), st.text("04 -", max_size=40),
    st.lists(st.sampled_from(["a@b.c", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (555) 010-9999", "é", "@", ".", " ", "x", "+"])).map("".join),
))
def test_base_spans(text):
    assert P.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000 + ".", "1 " * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "1." * 150_000):
        P.base_spans(text)


def docs_rows():
    rng = np.random.default_rng(1)
    word = lambda: "".join("abcdefghij"[i] for i in rng.integers(0, 10, 5))
    rows = [(i, " ".join(word() for _ in range(30))) for i in range(200)]
    rows += [(300 + i, f"{word()} {word()} Quibbler {word()} Jane.Doe@mail.example.com {word()} common {word()}") for i in range(6)]
    rows += [(310 + i, f"{word()} common {word()}") for i in range(40)]
    rows += [(360 + i, f"alone quibbler {word()} ÉÉ Quibbler's {word()}") for i in range(2)]
    # a passage in many copies supports nothing
    rows += [(400 + i, "copied passage holds zanzibar +1 (555) 010-9999 here") for i in range(9)]
    rows += [(500, None), (501, ""), (None, "null id 10.0.0.1 or 4111-1111-1111-1111"), (502, "10.0.0.1"), (502, "10.0.0.1")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(docs_rows(), "doc_id bigint, text string").withColumn("term", F.lit("x")).repartition(3).cache()


def plain_terms(rows):
    n, pairs, entities, df = len(rows), {}, {}, {}
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    for _, text in rows:
        text = text or ""
        for w in {low(w) for w in P._WORD.findall(text)}:
            df[w] = df.get(w, 0) + 1
        spans = plain_spans(text)
        words = [m for m in P._WORD.finditer(text) if not any(a < m.end() and m.start() < b for a, _, b in spans)]
        near = {}
        for a, k, b in spans:
            before = [low(m[0]) for m in words if m.start() < a][-P.WINDOW :]
            behind = [low(m[0]) for m in words if m.start() >= b][: P.WINDOW]
            near.setdefault(P.entity(text, k, a, b), []).extend(before + behind)
        for e, terms in near.items():
            entities[e] = entities.get(e, 0) + 1
            for t in set(filter(P.is_term, terms)):
                pairs.setdefault((e, t), []).append(tuple(terms))
    out = {}
    for (e, t), held in pairs.items():
        if len(set(held)) >= P.CONTEXTS and n > entities[e]:
            share = math.log2(n * len(held) / (entities[e] * df[t])) / math.log2(n / entities[e])
            if share >= P.GENERALISE:
                out[t] = max(out.get(t, 0), share)
    return out


def test_disclosing_terms(docs):
    want = plain_terms(docs_rows())
    got = {r.term: r for r in P.disclosing_terms(docs).collect()}
    assert set(got) == set(want) == {"quibbler"}
    assert got["quibbler"].disclosure == pytest.approx(want["quibbler"])
    assert got["quibbler"].action == ("remove" if want["quibbler"] >= P.REMOVE else "generalise")
    # a map so small that other words pass it changes nothing
    assert {r.term for r in P.disclosing_terms(docs, bits=64).collect()} == set(want)


@pytest.mark.parametrize("bits", [P.BITS, 64])
def test_spans_and_texts(docs, bits):
    terms = P.disclosing_terms(docs).cache()
    got = P.span_digest(P.find_spans(docs, terms, bits=bits)).collect()
    want = []
    for i, text in docs_rows():
        base = plain_spans(text or "")
        own = [
            (m.start(), 4, m.end()) for m in P._WORD.finditer(text or "")
            if m[0].lower() == "quibbler" and not any(a < m.end() and m.start() < b for a, _, b in base)
        ]
        written = lambda spans: ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        want.append((i, *[sum(k == x for _, k, _ in base) for x in range(4)], len(own), hashlib.sha256(written(base).encode()).hexdigest(), written(base + own)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    clean = {r.doc_id: r.text for r in P.sanitised(docs.where("doc_id in (300, 360, 502) or doc_id is null"), terms).collect()}
    assert "uibbler" not in clean[300] + clean[360] and "[email]" in clean[300] and " common " in clean[300]
    assert clean[502] == "[ip]" and clean[None] == "null id [ip] or [card]"


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert P.span_digest(P.find_spans(frame, P.disclosing_terms(frame))).count() == 0
