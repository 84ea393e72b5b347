"""The operators on small hand-made tables: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterbook.llm import (
    blocks, exact_dedup, language_id, line_dedup, lm_scoring, mixing, near_dedup, packing, token_counts, topk, url_filter,
)
from meterbook.llm.cuckoo import Cuckoo
from meterbook.llm.elias_fano import EliasFano, Trie
from meterbook.llm.runtime import tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LINE = "This same line has more than forty characters in it."
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))


def near(seed, n=60):
    return " ".join(f"w{seed}n{i}" for i in range(n))


TEXTS = [
    None, "", "   ", "one two", "One  TWO", LONG, LONG + " tail", near(1), near(1) + " more", near(2), near(1),
    f"a\n{LINE}\nb", f" {LINE.upper()} \nc", LINE, f"d\n{LINE}", LINE, "1234 !!", "中文 é <|endoftext|> ok",
    "A<|ENDOFTEXT|>b <|EndOfText|> a<|endoftext|>B <|StartOfText|>", "<|ENDOFTEXT|> x< | Ab<|startoftext|>", "Y<", "|Z İ ı'LL",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "de", None)[i % 3], ("b", "a", None)[i % 3], None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[9], (None, "null id", None, None, 1)], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_empty_tables(spark, nothing):
    frames = [
        exact_dedup.exact_duplicates(nothing), near_dedup.near_duplicates(nothing), token_counts.token_counts(nothing),
        packing.pack(packing.token_pieces(nothing)), lm_scoring.lm_scores(nothing, F.lit(True), F.lit(False)),
        mixing.mix(nothing, F.lit(1), F.lit(1.0)), line_dedup.clean_lines(nothing, line_dedup.build_index(nothing)),
        language_id.predict_language(nothing, language_id.train(nothing), ["doc_id"]),
        topk.top_k(nothing.selectExpr("doc_id as vec_id", "array(1.0) as embedding"), F.lit(True), 5),
        url_filter.judge_urls(nothing.selectExpr("text as url"), url_filter.rules_frame(spark, [("com", "/", "allow")])),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_exact(docs):
    plain = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t)) for i, t in listed(docs)]
    got = exact_dedup.exact_duplicates(docs.withColumn("keep_id", F.lit("x")))
    for r in got.collect():
        same = [i for i, t in plain if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        assert r.group_size == len(same) and r.keep_id == min((i for i in same if i is not None), default=None)
    assert got.count() == len(plain) and got.where("kept").count() == len({t for _, t in plain})
    assert exact_dedup.drop_exact_duplicates(docs).count() == len({t for _, t in plain})


def test_near(docs):
    sets = {}
    for i, t in listed(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.setdefault(i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    least = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.permutations([i for i in sets if sets[i] and i is not None], 2):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                least[a] = min(least[a], least[b])
    got = near_dedup.near_duplicates(docs.withColumn("label", F.lit(1)))
    assert got.count() == docs.count()
    for r in got.collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), least[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id)


def test_near_links_rows_without_id(spark):
    made = [(None, near(5)), (None, near(5) + " more"), (7, near(6)), (None, near(6) + " extra"), (None, near(8)), (9, near(8))]
    got = near_dedup.near_duplicates(spark.createDataFrame(made, "doc_id bigint, text string"))
    want = [(None, 56, None), (None, 57, None), (7, 56, 7), (None, 57, 7), (None, 56, 9), (9, 56, 9)]
    assert rows(got.select("doc_id", "n_shingles", "component_id")) == sorted(want, key=repr)


def test_lines(docs):
    index = line_dedup.build_index(docs.withColumn("a", F.lit(1)))
    held, total = {}, listed(docs)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    for i, t in total:
        for k in {key(x) for x in t.split("\n")}:
            held.setdefault(k, []).append(i)
    want = []
    for i, t in total:
        kept = [x for x in t.split("\n") if len(key(x)) < 40 or len(held[key(x)]) < 5 or i == max(j for j in held[key(x)] if j is not None)]
        n = t.count("\n") + 1
        want.append((i, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert rows(line_dedup.clean_lines(docs, index).drop("kept_text")) == sorted(want, key=repr)


def test_line_index_is_reversible(spark, docs):
    new = spark.createDataFrame([(100 + i, f"x{i}\n{LINE}") for i in range(5)], "doc_id bigint, text string")
    first = line_dedup.build_index(docs)
    back = line_dedup.delete(line_dedup.insert(first, new), new.select("doc_id"))
    assert rows(back.refs) == rows(first.refs) and rows(back.counts) == rows(first.counts)
    assert rows(line_dedup.may_repeat(back)) == rows(line_dedup.may_repeat(first))


def test_filters_meet_references_in_groups(docs):
    index = line_dedup.build_index(docs)
    repeated = index.counts.where(f"n >= {line_dedup.DOCS}")
    want = rows(index.refs.join(repeated, ["a", "b"], "left_semi"))
    for group_rows in (1, 3, 1 << 20):
        got = rows(line_dedup.may_repeat(index, group_rows))
        assert len(want) > 3 and not [r for r in want if got.count(r) != want.count(r)]


def test_cuckoo():
    keys = np.random.default_rng(1).integers(0, 1 << 63, (2, 50_000)).astype(np.uint64)
    held = Cuckoo.of(*keys)
    assert held.holds(*keys).all()
    held.delete(*keys[:, :25_000])
    assert held.holds(*keys[:, 25_000:]).all() and held.holds(*keys[:, :25_000]).mean() < 0.01


def test_mixing(docs):
    got = mixing.mix(docs, mixing.word_count(F.col("text")), F.lit(None), bin_rows=2)
    assert rows(got) == rows(mixing.mix(docs, mixing.word_count(F.col("text")), F.lit(None), bin_rows=2))
    sources = {}
    for r in got.collect():
        assert 0 <= r.taken <= 2 * r["size"]
        sources.setdefault((r.source, r.source_size, r.target), []).append((r["size"], r.taken))
    for (_, total, target), own in sources.items():
        assert sum(s for s, _ in own) == total and target <= 2 * total
        assert abs(sum(t for _, t in own) - target) <= max(s for s, _ in own)
    assert sum(t for _, _, t in sources) == pytest.approx(1.5 * sum(n for _, n, _ in sources))


def test_tokens_and_packing(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    ids = sorted(((i, library.encode(t, add_special_tokens=False).ids, t) for i, t in listed(docs)), key=repr)
    got = rows(token_counts.token_counts(docs.withColumn("n_bytes", F.lit(0))))
    assert got == sorted(((i, len(t.encode()), len(x), len(x) > 2048) for i, x, t in ids), key=repr)
    want = []
    for i, x, _ in ids:
        x = [*x, 0]
        want += [(i, k // 2048, k, len(x[k : k + 2048]), zlib.crc32(np.array(x[k : k + 2048], "<u4").tobytes())) for k in range(0, len(x), 2048)]
    packed = packing.pack(packing.token_pieces(docs)).collect()
    assert sorted((tuple(r)[:5] for r in packed), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(own)) and sum(own[-1]) <= 2048


def test_plan_needs_few_sequences():
    counts = {n: 7 + n % 5 for n in range(1, 2049, 3)}
    plan = packing.plan_sequences(counts, steps=40)
    used = {}
    for count, items in plan:
        assert sum(n * a for n, a in items) <= 2048
        for n, a in items:
            used[n] = used.get(n, 0) + a * count
    assert used == counts
    assert sum(c for c, _ in plan) <= 1.02 * sum(n * c for n, c in counts.items()) / 2048 + 1


def test_top_k(spark):
    made = [(i, [float(x) for x in np.random.default_rng(i % 40).normal(size=8)]) for i in range(90)]
    made += [(200, None), (201, [1.0, None] * 4), (202, [float("nan")] * 8), (203, [1.0]), (None, [1.0] * 8), made[3]]
    frame = spark.createDataFrame(made, "vec_id bigint, embedding array<double>")
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in made[:90]}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ whole[c]), c) for c in whole if c != q)[:5]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert rows(topk.top_k(frame, F.col("vec_id") % 50 == 0, 5)) == sorted(want, key=repr)
    large = spark.createDataFrame([(0, [1e15, 3.0]), (1, [2e15, 1.0])], "vec_id bigint, embedding array<double>")
    assert topk.top_k(large, F.col("vec_id") == 0, 5).collect()[0].score == (1 << 63) - 1


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://COM", "HTTP://a.COM/x?y", "http://www.example.com/en/1#z",
            "http://a.www.example.com/en/", "http://example.com/en", "http://notexample.com/en/", "x://net/es/", "x://b.net/fr/q"]
    frame = spark.createDataFrame([(u, "row") for u in urls], "url string, host string")
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    for r in url_filter.judge_urls(frame, url_filter.rules_frame(spark, rules), salts=2).collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, a) for h, p, a in rules if ("." + host).endswith("." + h) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[1], best[2])


def test_language(spark, docs):
    model = language_id.train(docs.withColumn("score", F.lit(1)))
    got = language_id.predict_language(docs, model, ["doc_id", "text"]).collect()
    for r in got:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.score <= 1


def plain_scores(texts, train):
    """Base and trigram score of each text, and its tokens, from plain counts."""
    cut = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)), None]
    one, two, three = {}, {}, {}
    for i, t in texts.items():
        if train(i):
            words = cut(t)
            for u, v, w in zip([None, None, *words], [None, *words], words, strict=False):
                for held, k in ((one, w), (two, (v, w)), (three, (u, v, w))):
                    held[k] = held.get(k, 0) + 1
    pair = {}
    for (u, v, _), c in three.items():
        pair[u, v] = pair.get((u, v), 0) + c
    n, distinct, out = sum(one.values()), len(one), {}
    for i, t in texts.items():
        words = cut(t)
        alone = [(one.get(w, 0) + 0.5) / (n + 0.5 * (distinct + 1)) for w in words]
        p = []
        for u, v, w, q in zip([None, None, *words], [None, *words], words, alone, strict=False):
            q = (two.get((v, w), 0) + lm_scoring.MU * q) / (one.get(v, 0) + lm_scoring.MU)
            p.append((three.get((u, v, w), 0) + lm_scoring.MU3 * q) / (pair.get((u, v), 0) + lm_scoring.MU3))
        out[i] = (words, sum(w in one for w in words), n, sum(map(np.log10, alone)), sum(map(np.log10, p)))
    return out


@pytest.mark.parametrize("split", [1 << 20, 1 << 19, 3])
def test_lm_against_plain_counts(docs, monkeypatch, split):
    """Also with the contexts of every repeated word split over shards, and with shards cut to many stretches."""
    monkeypatch.setattr(lm_scoring, "SPLIT", split)
    monkeypatch.setattr(lm_scoring, "STRETCH", 20)
    monkeypatch.setattr(lm_scoring, "OFTEN", 5)
    train = F.col("doc_id") % 2 == 0
    # the workers of tasks do not see a changed limit, so with that the blocks run here
    want = plain_scores(dict(listed(docs)), lambda i: i is not None and i % 2 == 0)
    for r in (lm_scoring.lm_scores(docs, train, ~train).collect() if split == 1 << 20 else scored_here(docs, 5)):
        words, known, n, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), known, n)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] == pytest.approx(score, abs=0.075 * len(words))


def scored_here(docs, shards):
    """The steps of the scoring over two blocks, without Spark."""
    import pyarrow as pa

    table = lambda rows: pa.Table.from_batches([blocks.row_batch(rows)])
    by_key = lambda rows: [[r for r in rows if r[1] == k] for k in sorted({r[1] for r in rows})]
    taken = lambda t: list(zip(*[t[c].to_pylist() for c in t.column_names], strict=True))
    every = [(i, t, i is not None and i % 2 == 0) for i, t in listed(docs)]
    rows = []
    for part in (every[: len(every) // 2], every[len(every) // 2 :]):
        batch = pa.RecordBatch.from_pydict({
            "doc_id": pa.array([i for i, _, _ in part], pa.int64()), "text": [t for _, t, _ in part],
            "train": [x for *_, x in part], "held_out": [not x for *_, x in part],
        })
        for out in lm_scoring._ask_words(shards)([batch]):
            rows += taken(pa.Table.from_batches([out]))
    said = [r for g in by_key([r for r in rows if r[0] == 1]) for r in taken(lm_scoring._answer_words(shards)(table(g)))]
    known = [r for r in rows if r[0] == 0] + [r for r in said if r[0] == 2]
    n, v = (sum(r[i] for r in said if r[0] == 3) for i in (2, 3))
    asked = [r for g in by_key(known) for r in taken(lm_scoring._ask_contexts(shards)(table(g)))]
    answers = [r for g in by_key(asked) for r in taken(lm_scoring._answer_contexts(None)(table(g)))]
    return [r for g in by_key(known + answers) for r in lm_scoring._score(shards, n, v)(table(g)).to_pylist()]


def test_elias_fano(monkeypatch):
    made = np.random.default_rng(2)
    for top in (3, 5000, 1 << 40, (1 << 63) - 1):
        values = np.sort(made.integers(0, top, 5000))
        held = EliasFano.open(np.frombuffer(EliasFano.image(values), np.uint8))
        for window in (1, 300, 1 << 19):
            monkeypatch.setattr("meterbook.llm.elias_fano.WINDOW", window)
            index = made.integers(0, 5000, 700)
            assert (held.at(index) == values.astype(np.uint64)[index]).all()
            asked = np.append(made.integers(0, top, 700), [0, int(values[-1]), int(values[0])])
            assert (held.successor(asked) == np.searchsorted(values, asked)).all()
    none = EliasFano.open(np.frombuffer(EliasFano.image(np.zeros(0, np.uint64)), np.uint8))
    assert none.successor(np.array([0, 5])).tolist() == [0, 0] and none.place(np.array([3]))[1].tolist() == [False]


def test_trie(tmp_path):
    words = np.array([4, 9, 1 << 50], np.uint64)
    # keys are parent * 3 + child; before 9 stand 4 and 1 << 50, the pairs (9, 4) and (9, 1 << 50) are numbers 0 and 1
    image = Trie.image(words, (np.array([3, 5]), np.array([7, 8])), (np.array([1, 3]), np.array([5, 6])), (np.array([2, 3]), np.array([1, 2])))
    for folder in (str(tmp_path / "maps"), None):
        trie = Trie.mapped(image, folder)
        assert trie.places(np.array([1 << 50, 4, 5], np.uint64)).tolist() == [2, 0, -1]
        assert trie.before.look_up(np.array([1, 1, 1, 0]), np.array([2, 0, 1, 0])).tolist() == [8, 7, 0, 0]
        assert trie.after.look_up(np.array([0, 1, 2]), np.array([1, 0, 2])).tolist() == [5, 6, 0]
        assert trie.third.look_up(np.array([0, 1, 1]), np.array([2, 0, 2])).tolist() == [1, 2, 0]
    assert not list((tmp_path / "maps").iterdir())


def test_stages_keep_the_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, "/root/testdata/sf0.001")
        assert left.columns == docs.columns, name
        assert left.join(docs, ["doc_id", "text"], "left_semi").count() == left.where("doc_id is not null and text is not null").count()


def test_near_stage_keeps_one_row_of_a_component(spark):
    made = [
        (5, near(20), "kept"), (None, near(20) + " more", None), (7, near(20) + " extra", None), (7, near(21), "kept"),
        (8, near(22), "either"), (8, near(22) + " more", "either"), (None, near(23), "either"), (None, near(23) + " more", "either"),
        (9, near(24), "kept"), (9, near(24), "kept"), (10, "", "kept"), (10, "", "kept"), (None, None, "kept"),
        (30, near(25), None), (4, near(25) + " more", "kept"), (None, near(26), "kept"),
    ]
    frame = spark.createDataFrame([(i, t, "en", "a", None) for i, t, _ in made], SCHEMA).repartition(3)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.remove_near_copies(spark, frame, "").collect()]
    once = {(9, near(24))}
    sure = [(i, t) for i, t, x in made if x == "kept"]
    sure.remove(*once)
    either = [(8, near(22)), (None, near(23))]
    assert sorted((x for x in left if x in sure), key=repr) == sorted(sure, key=repr)
    rest = [x for x in left if x not in sure]
    assert len(rest) == 2 and {(i, t.removesuffix(" more")) for i, t in rest} == set(either)


def plain_language(rows, text):
    """Brute force over dictionaries: label and score of a text by rows of (label, text)."""
    def grams(t):
        t = "".join(c if c.isalpha() else " " for c in t.lower())
        return [t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1) if t[i] != " " or t[i + n - 1] != " "]

    def bucket(g):
        value = 0
        for c in g:
            value = (value * 0x9E3779B1 + ord(c)) & 0xFFFFFFFF
        value ^= len(g) * 0x85EBCA6B & 0xFFFFFFFF
        return ((value ^ (value >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 17

    total = {}
    for lang, t in rows:
        held = total.setdefault(lang, {})
        for g in grams(t):
            held[bucket(g)] = held.get(bucket(g), 0) + 1
    if not any(map(str.isalpha, text)):
        return "und", 0.0
    log = {x: sum(np.log((h.get(bucket(g), 0) + 0.5) / (sum(h.values()) + 0.5 * 2**15)) for g in grams(text)) for x, h in total.items()}
    best = max(sorted(log), key=log.get)
    return best, 1 / sum(np.exp(v - log[best]) for v in log.values())


def test_language_learns_every_label(spark):
    word = lambda k: "".join(chr(97 + c) for c in np.random.default_rng(k).integers(0, 26, 7).tolist())
    # the labels past the 64th in frequency have one document
    made = [(100 * k + j, f"{word(k)} {word(k)} {word(k + 200)}", f"l{k:03}") for k in range(130) for j in range(1 + (k < 64))]
    frame = spark.createDataFrame(made, "doc_id bigint, text string, lang string").repartition(3)
    asked = [*(f"{word(k)} {word(k + 200)}" for k in range(130)), "", "12", word(3) * 2]
    wanted = [plain_language([(x, t) for _, t, x in made], t) for t in asked]
    texts = spark.createDataFrame(list(enumerate(asked)), "doc_id bigint, text string")
    for block in (64, 7, 1000):
        model = language_id.train(frame, block=block)
        assert len(model[0]) == 130 and len(model[1]) == -(-130 // block)
        got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict_language(texts, model, ["doc_id"]).collect()}
        for i, (lang, score) in enumerate(wanted):
            assert got[i][1] == pytest.approx(score, abs=1e-4)
            assert got[i][0] == lang or score < 0.51
    assert len({x for x, _ in wanted}) > 100


@pytest.mark.parametrize("times", [1, 1000])
def test_program_covers_the_histogram(monkeypatch, times):
    counts = {n: times * (20 + n % 5) for n in range(1, 2049, 2)}
    held = dict.fromkeys(counts, 0.0)
    for key, use in packing.fractional_uses(counts, 2048).items():
        assert sum(n * a for n, a in key) <= 2048
        for n, a in key:
            held[n] += use * a
    assert all(held[n] == pytest.approx(counts[n]) for n in counts)
    given, fit = [], packing.best_fit
    monkeypatch.setattr(packing, "best_fit", lambda left, room: given.append(sum(left.values())) or fit(left, room))
    plan = packing.plan_sequences(counts)
    assert sum(given) <= 0.02 * sum(counts.values())
    assert sum(c for c, _ in plan) <= 1.005 * sum(n * c for n, c in counts.items()) / 2048 + 1
