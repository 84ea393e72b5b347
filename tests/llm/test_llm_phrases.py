"""Phrase mining against plain counting."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterbook.llm import phrases

TEXTS = [
    (None, "en"), ("", "en"), ("alpha beta. gamma", None), ("a.b", "en"),
    *[("New York city hall\tNEW york", "en")] * 6, *[("new york; city\nhall new york", "en")] * 6,
    *[("im im im im", "de")] * 7, *[("im Haus, im haus im", "de")] * 9,
    *[("x y z w", None)] * 12, *[("x y q", "und")] * 5, (" é  b é b é b ", "fr"),
    (" ".join(["long"] * 3000 + [f"t{i}" for i in range(3000)]), "en"),
]


def plain(rows, least, top):
    found, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            for n in (1, 2, 3):
                for i in range(len(w) - n + 1):
                    found[lang, tuple(w[i : i + n])] += 1
    out = []
    for (lang, w), a in found.items():
        if len(w) < 2 or a < least:
            continue
        cuts = [(1_000_000 * a * a // (found[lang, w[:k]] * found[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if len(w) == 2 and any(
            f >= least and 100 * f >= 50 * a and w in (x[:2], x[1:]) for (g, x), f in found.items() if g == lang and len(x) == 3
        ):
            continue
        out.append((lang, -score, -a, " ".join(w).encode(), found[lang, w[:k]], found[lang, w[k:]]))
    rank, ranked = Counter(), []
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(ranked)


@pytest.mark.parametrize(("budget", "least", "top"), [(2_000_000, 10, 2000), (40, 10, 3), (3, 2, 2000)])
def test_against_plain_counts(spark, budget, least, top):
    frame = spark.createDataFrame(TEXTS, "text string, lang string").withColumn("phrase", F.lit("x")).repartition(3)
    got = phrases.collocations(frame, least=least, top=top, budget=budget)
    assert sorted(map(tuple, got.collect())) == plain(TEXTS, least, top)


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001)], "a bigint, l bigint")
    wide = a.select(F.col("a").cast("decimal(38,0)").alias("a"), F.col("l").cast("decimal(38,0)").alias("l"))
    over = wide.withColumn("over", F.col("a") * F.col("a") * F.lit(1_000_000).cast("decimal(38,0)")).withColumn("under", F.col("l") * F.col("l"))
    assert over.select(F.expr("over div under")).first()[0] == 10**6 * 3_000_000_000_000**2 // 3_000_000_000_001**2


def test_groups_hold_the_budget():
    import numpy as np

    counts = np.array([5, 0, 9, 30, 1, 1, 10, 2])
    first, parts = phrases.plan_groups(counts, 10)
    held = Counter()
    for g, p, n in zip(first.tolist(), parts.tolist(), counts.tolist(), strict=True):
        for i in range(p):
            held[g + i] += -(-n // p)
    assert max(held.values()) <= 10 and parts.tolist() == [1, 1, 1, 3, 1, 1, 1, 1]
    own = set(range(first[3], first[3] + 3))
    assert not own & set(first[np.arange(8) != 3].tolist())


def test_long_streams_are_cut_into_slices(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 7)
    made = [" ".join("abcd"[(i * i + k) % 4] for i in range(60)) + ". a b" for k in range(3)]
    import pyarrow as pa

    whole = Counter()
    for _, code, words, piece in phrases._by_lang(pa.table({"text": made, "lang": ["en"] * 3})):
        for one, two, three, count in phrases._suffixes(code, piece, len(words)):
            for x, y, z, n in zip(one.tolist(), two.tolist(), three.tolist(), count.tolist(), strict=True):
                whole[tuple(words[i - 1].decode() for i in (x, y, z) if i)] += n
    want = Counter()
    for text in made:
        for piece in text.split("."):
            w = piece.split()
            for i in range(len(w)):
                want[tuple(w[i : i + 3])] += 1
    assert whole == want
