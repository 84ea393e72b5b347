"""Stages of the pipeline on awkward tables, and the registered queries that have no SQL, against plain Python."""

import itertools
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from conftest import SMALL
from meterbook.llm.queries import QUERIES
from meterbook.llm.runtime import tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def near(seed, n=40):
    return " ".join(f"w{seed}n{i}" for i in range(n))


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(sets):
    """The first place each place can reach by links of 75 percent."""
    by_shingle, least = {}, list(range(len(sets)))
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {(a, b) for own in by_shingle.values() for a, b in itertools.combinations(own, 2)}
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


@pytest.fixture(scope="module")
def small(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    return frame, [tuple(r) for r in frame.select("doc_id", "text", "lang", "source").collect()]


def test_clashing_columns(spark):
    names = ("_id", "_key", "_marked_key", "_stays", "_nth", "_copies", "_row", "row", "score", "lang_pred", "label", "set_id", "key")
    rows = [(i, near(i % 3) + " x" * (i % 2), "en", "a", None, *[f"{n}{i}" for n in names]) for i in range(8)]
    rows.append((None, near(1), None, None, None, *names))
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", `{n}` string" for n in names))
    own = {tuple(r) for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        left = stage(spark, docs, SMALL)
        assert left.columns == docs.columns and {tuple(r) for r in left.collect()} <= own, name


def test_language_stage_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words", None, None, None), (2, "12 ?", None, None, None), (3, None, None, None, None)], SCHEMA)
    assert [r.doc_id for r in P.identify_language(spark, docs, SMALL).collect()] == [1]


def test_exact_stage_on_repeated_and_null_ids(spark):
    rows = [(1, "a  b", "x"), (1, "a b", "y"), (2, "a b", "z"), (2, "c", "z"), (2, "c", "z"), (None, "c", "z"), (None, "d", "z"), (None, "d", "z"), (None, None, None), (3, "", None)]
    docs = spark.createDataFrame([(i, t, s, None, None) for i, t, s in rows], SCHEMA).repartition(4)
    left = sorted(((r.doc_id, re.sub(r"\s+", " ", r.text or "")) for r in P.remove_exact_copies(spark, docs, SMALL).collect()), key=repr)
    assert left == sorted([(1, "a b"), (2, "c"), (None, "d"), (3, "")], key=repr)


def plain_language(train, asked):
    """Naive Bayes over dictionaries of the operator's grams."""
    def grams(t):
        t = "".join(c if c.isalpha() else " " for c in (t or "").lower())
        return [t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1) if t[i] != " " or t[i + n - 1] != " "]

    def bucket(g):
        value = 0
        for c in g:
            value = (value * 0x9E3779B1 + ord(c)) & 0xFFFFFFFF
        value ^= len(g) * 0x85EBCA6B & 0xFFFFFFFF
        return ((value ^ (value >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 17

    held = {}
    for lang, t in train:
        if lang is not None:
            own = held.setdefault(lang, np.zeros(2**15))
            np.add.at(own, np.array([bucket(g) for g in grams(t)], int), 1)
    log = {x: np.log((c + 0.5) / (c.sum() + 0.5 * 2**15)) for x, c in sorted(held.items())}
    out = []
    for t in asked:
        if not any(map(str.isalpha, t or "")):
            out.append(("und", 0.0))
            continue
        index = np.array([bucket(g) for g in grams(t)], int)
        score = {x: float(v[index].sum()) for x, v in log.items()}
        best = max(score, key=score.get)
        out.append((best, 1 / sum(np.exp(v - score[best]) for v in score.values())))
    return out


def test_op1(spark, small):
    _, rows = small
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    want = plain_language([(x, t) for i, t, x, _ in rows if fold(i) != 2], [t for _, t, _, _ in rows])
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    for (i, *_), (lang, score) in zip(rows, want, strict=True):
        assert got[i].held_out == (fold(i) == 2) and got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=1e-3)


def test_op5(spark, small):
    _, rows = small
    rows = sorted(rows)
    sets = [shingles(t) for _, t, _, _ in rows]
    least = components(sets)
    want = {i: (len(s), rows[k][0]) for (i, *_), s, k in zip(rows, sets, least, strict=True)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_minhash_near_dedup"](spark, SMALL).collect()}
    assert got == want


def test_op6_and_op7(spark, small):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    _, rows = small
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t, _, _ in rows}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op7_token_counts"](spark, SMALL).collect()}
    assert got == {i: (len((t or "").encode()), len(ids[i]), len(ids[i]) > 2048) for i, t, _, _ in rows}
    pieces = QUERIES["op6_best_fit_packing"](spark, SMALL).collect()
    want = {(i, k // 2048): (k, ([*x, 0])[k : k + 2048]) for i, x in ids.items() for k in range(0, len(x) + 1, 2048)}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in pieces} == {
        p: (k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for p, (k, x) in want.items()
    }
    room = {}
    for r in sorted(pieces, key=lambda r: r.offset):
        assert room.setdefault(r.sequence_id, 0) == r.offset
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 2048


def test_op10(spark, small):
    _, rows = small
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i, *_ in rows]
    count, n = {}, 0
    for (_, t, *_), learned in zip(rows, train, strict=True):
        if learned:
            for w in [*words(t), None]:
                count[w] = count.get(w, 0) + 1
                n += 1
    got = {r.doc_id: r for r in QUERIES["op10_lm_scoring"](spark, SMALL).collect()}
    for (i, t, *_), learned in zip(rows, train, strict=True):
        own = [*words(t), None]
        base = sum(np.log10((count.get(w, 0) + 0.5) / (n + 0.5 * (len(count) + 1))) for w in own)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learned, len(own), sum(w in count for w in own), n)
        assert r.base_score == pytest.approx(base)


def test_pipeline_run(spark, small):
    """Every stage of ``run`` against what plain Python keeps of the stage before."""
    _, rows = small
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    stages = dict(P.STAGES)
    docs = stages["language_id"](spark, frame, SMALL)
    assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i, *_ in kept)
    first = {}
    for i, t, *_ in kept:
        k = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        first[k] = min(first.get(k, i), i)
    docs = stages["exact_dedup"](spark, docs, SMALL)
    kept = sorted(r for r in kept if r[0] in first.values())
    assert sorted(r.doc_id for r in docs.collect()) == [i for i, *_ in kept]
    least = components([shingles(t) for _, t, _, _ in kept])
    kept = [r for k, r in enumerate(kept) if least[k] == k]
    docs = stages["near_dedup"](spark, docs, SMALL)
    assert sorted(r.doc_id for r in docs.collect()) == [i for i, *_ in kept]
    mixed = [r.doc_id for r in stages["mixing"](spark, docs, SMALL).collect()]
    size = {i: len(words(t)) for i, t, _, _ in kept}
    assert set(mixed) <= set(size) and max(mixed.count(i) for i in set(mixed)) <= 2
    sources = sorted({s for *_, s in kept}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, _, _, x in kept if x == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while True:
        level = (1.5 * sum(total.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * total[s]}
        if not over:
            break
        target |= {s: 2 * total[s] for s in over}
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    of = {i: s for i, _, _, s in kept}
    for s in sources:
        taken = sum(size[i] for i in mixed if of[i] == s)
        assert abs(taken - target[s]) <= max(n for i, n in size.items() if of[i] == s)
    out = P.run(spark, SMALL).collect()
    per_doc = {}
    for r in out:
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + (r.piece == 0)
    assert per_doc == {i: mixed.count(i) for i in set(mixed)}
