"""Trigram language-model scores of documents, learned from the corpus itself.

Counts cover all training documents. Blocks of documents ask the shards of the vocabulary for each distinct word once
and get its id and count; then they ask the shards of the contexts for each distinct triple of words once. A context shard
sums the blocks' counts, builds an Elias-Fano trie of its pairs and triples with quantised probabilities, maps it from the
shared folder and looks up what the blocks ask. All of a word's contexts lie in one shard, unless it has many
occurrences: then its triples and pairs are split by their other words, and its pairs are asked for on their own.

``P(w | u v) = (c(u, v, w) + MU3 * P(w | v)) / (c(u, v) + MU3)``, ``P(w | v) = (c(v, w) + MU * P(w)) / (c(v) + MU)`` and
``P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))``. The trie keeps each count of ``v``'s pairs and triples as a share of ``c(v) +
MU`` in 8 bits of its logarithm, so that shards need not hold all of a pair's triples. A document starts after two
ends, and its end is a token.

Defined cases: null counts as empty, which is one end; rows with a null id are scored and not learned from; repeated rows are
documents of their own; words are told apart by 64 bits; an empty table gives an empty result; without
training tokens every probability is 1; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterbook.llm import blocks as B
from meterbook.llm.elias_fano import Trie
from meterbook.llm.runtime import small_batches, text_shards
from meterbook.llm.textnum import mixed, numbers, sums, words_of
from meterbook.session import materialize, scratch_path

#: Mass of the word's own probability and of that after one word, occurrences of a context per shard, and the smallest log10 kept.
MU, MU3, SPLIT, FLOOR = 100.0, 10.0, 1 << 20, 12.0
#: Rows of a shard that one trie is built for.
STRETCH = 1 << 19
#: Words of a block that get the smallest numbers in it, so that the list of its words compresses well.
OFTEN = 4096
#: The number of the end token; words have mixed numbers.
END = np.uint64(0x5851F42D4C957F2D)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def coded(p: np.ndarray) -> np.ndarray:
    """1 to 255 for probabilities from 1 down to 10^-FLOOR."""
    return (1 + np.rint(np.clip(-np.log10(p), 0, FLOOR) * (254 / FLOOR))).astype(np.uint8)


_DECODED = np.append(0.0, 10.0 ** (-np.arange(255) * (FLOOR / 254)))


def decoded(codes: np.ndarray) -> np.ndarray:
    """The probability of each code; 0 for 0, which stands for nothing seen."""
    return _DECODED[codes]


def _by_short(often: np.ndarray, distinct: int) -> np.ndarray:
    """The places of a block's words: of the most frequent first, then of the others in order."""
    rest = np.ones(distinct, bool)
    rest[often] = False
    return np.append(often, np.flatnonzero(rest))


def _ask_words(shards: int):
    def make(block: int, docs: pa.Table) -> list[tuple]:
        found = words_of(docs["text"])
        distinct, own = np.unique(np.append(numbers(found.distinct), END), return_inverse=True)
        n = np.diff(found.rows) + 1
        place = np.insert(own[found.code], found.rows[1:], own[-1])
        learned = np.repeat(docs["train"].to_numpy(zero_copy_only=False), n)
        count = np.bincount(place[learned], minlength=len(distinct))
        often = np.argsort(-np.bincount(place), kind="stable")[:OFTEN]
        short = np.empty(len(distinct), np.int64)
        short[_by_short(often, len(distinct))] = np.arange(len(distinct))
        own_rows = docs.select(["doc_id", "held_out", "train"])
        out = [(0, block, block, -1, B.joined([B.framed(own_rows), *map(B.packed, (n, often, short[place]))]))]
        edges = B.shard_edges(distinct, shards).tolist()
        for shard, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if b > a:
                out.append((1, shard, block, shard, B.joined([distinct[a:b].tobytes(), B.packed(count[a:b])])))
        return out

    return B.each_block(make)


def _answer_words(shards: int):
    def answer(rows: pa.Table) -> pa.Table:
        asked = [B.parted(x) for x in rows["data"].to_pylist()]
        own_numbers = [np.frombuffer(a, np.uint64) for a, _ in asked]
        distinct, place = np.unique(np.concatenate(own_numbers), return_inverse=True)
        count = np.bincount(place, np.concatenate([B.unpacked(c) for _, c in asked]), len(distinct)).astype(np.int64)
        shard = rows["part"][0].as_py()
        # frequent words get small ids; the ids of shards interleave, and 0 is no word's
        rank = np.empty(len(distinct), np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(distinct))
        word = rank * shards + shard + 1
        out, at = [], 0
        for block, own in zip(rows["block"].to_pylist(), own_numbers, strict=True):
            mine = place[at : at + len(own)]
            at += len(own)
            out.append((2, block, block, shard, B.joined([B.packed(word[mine]), B.packed(count[mine])])))
        out.append((3, 0, int(count.sum()), int((count > 0).sum()), b""))
        return pa.Table.from_batches([B.row_batch(out)])

    return answer


def _shard_of(ids: np.ndarray, v: np.ndarray, other, seen: np.ndarray, shards: int) -> np.ndarray:
    """The shard of what lies around each ``v``: one for all, or several by the other words where ``v`` is frequent."""
    shard = (mixed(ids * _SPREAD) % np.uint64(shards)).astype(np.int32)[v]
    hot = np.flatnonzero((seen >= SPLIT)[v])
    part = mixed(other(hot)) % (seen[v[hot]] // SPLIT + 1).astype(np.uint64)
    shard[hot] = (mixed(ids[v[hot]] * _SPREAD + part) % np.uint64(shards)).astype(np.int32)
    return shard


class _Block:
    """A block with the vocabulary's answers: its tokens, and its distinct triples and pairs in the order in which shards are asked.

    Words have local places in the order of their ids; place 0 is any word without training count. ``t`` are the triples (v, u, w)
    with a known ``v``, the word before ``w``; ``a`` their pairs (v, u) and ``b`` their pairs (v, w).
    """

    def __init__(self, rows: list[tuple[int, int, bytes]], shards: int):
        (_, _, body), *answers = sorted(x for x in rows if x[0] in (0, 2))
        own, n, often, place = B.parted(body)
        self.docs, self.n = B.unframed(own), B.unpacked(n).astype(np.int64)
        pairs = [B.parted(x) for _, _, x in answers]
        word = np.concatenate([B.unpacked(w) for w, _ in pairs])
        count = np.concatenate([B.unpacked(c) for _, c in pairs]).astype(np.int64)
        known = count > 0
        self.ids = np.append(np.uint64(0), np.sort(word[known]))
        local = np.zeros(len(word), np.int64)
        local[known] = np.searchsorted(self.ids, word[known])
        self.seen = np.zeros(len(self.ids), np.int64)
        self.seen[local[known]] = count[known]

        self.edges = np.concatenate([[0], np.cumsum(self.n)])
        place = B.unpacked(place).astype(np.int64)
        w = local[_by_short(B.unpacked(often).astype(np.int64), len(word))][place]
        del place
        end, start = w[-1], self.edges[:-1]
        # before a document's first token stand two ends; every document's last token is one
        v = np.append(end, w[:-1])
        u = np.append(end, v[:-1])
        u[start] = end
        self.token = w.astype(np.int32)
        self.asked = np.flatnonzero(v > 0).astype(np.int32)
        m = len(self.ids)
        a_key, a_of = np.unique(v[self.asked] * m + u[self.asked], return_inverse=True)
        del u, v
        t_key, t_of = np.unique(a_of * m + w[self.asked], return_inverse=True)
        del a_of, w
        self.t_of = t_of.astype(np.int32)
        a, t_w = (x.astype(np.int32) for x in np.divmod(t_key, m))
        del t_key, t_of
        self.a_v, self.a_u = (x.astype(np.int32) for x in np.divmod(a_key, m))
        self.t_a, self.t_w, self.t_v, self.t_u = a, t_w, self.a_v[a], self.a_u[a]
        b_key, b = np.unique(self.t_v.astype(np.int64) * m + t_w, return_inverse=True)
        self.t_b = b.astype(np.int32)
        self.b_v, self.b_w = (x.astype(np.int32) for x in np.divmod(b_key, m))
        del b, a_key, b_key

        seen, ids = self.seen, self.ids
        t_shard = _shard_of(ids, self.t_v, lambda i: ids[self.t_u[i]] * _SPREAD + ids[self.t_w[i]], seen, shards)
        a_shard = _shard_of(ids, self.a_v, lambda i: ids[self.a_u[i]], seen, shards)
        b_shard = _shard_of(ids, self.b_v, lambda i: ids[self.b_w[i]], seen, shards)
        self.t_order = np.argsort(t_shard, kind="stable").astype(np.int32)
        # pairs of frequent words come last: the others follow from the triples
        self.a_order = np.lexsort((seen[self.a_v] >= SPLIT, a_shard)).astype(np.int32)
        self.b_order = np.lexsort((seen[self.b_v] >= SPLIT, b_shard)).astype(np.int32)
        every = ((t_shard, self.t_order), (a_shard, self.a_order), (b_shard, self.b_order))
        #: Where each shard's triples and pairs begin in these orders.
        self.cuts = [np.searchsorted(x[o], np.arange(shards + 1)) for x, o in every]

    def requests(self, shards: int):
        """Of each shard that is asked, its number and the request."""
        learned = np.repeat(self.docs["train"].to_numpy(zero_copy_only=False), self.n)[self.asked]
        t_count = np.bincount(self.t_of[learned], minlength=len(self.t_w))
        a_count = np.bincount(self.t_a, t_count, len(self.a_v)).astype(np.int64)
        b_count = np.bincount(self.t_b, t_count, len(self.b_v)).astype(np.int64)
        orders = (self.t_order, self.a_order, self.b_order)
        used, place = np.zeros(len(self.ids), bool), np.zeros(len(self.ids), np.uint64)
        for shard in range(shards):
            t, a, b = (o[c[shard] : c[shard + 1]] for o, c in zip(orders, self.cuts, strict=True))
            if len(t) or len(a) or len(b):
                a, b = a[self.seen[self.a_v[a]] >= SPLIT], b[self.seen[self.b_v[b]] >= SPLIT]
                kinds = (
                    ([self.t_v[t], self.t_u[t], self.t_w[t]], t_count[t]),
                    ([self.a_v[a], self.a_u[a]], a_count[a]), ([self.b_v[b], self.b_w[b]], b_count[b]),
                )
                # the request lists its words once; its rows name them by their place in the list
                used[:] = False
                for columns, _ in kinds:
                    used[columns[0]] = True
                around = np.flatnonzero(used)
                for columns, _ in kinds:
                    for column in columns[1:]:
                        used[column] = True
                own = np.flatnonzero(used)
                place[own] = np.arange(len(own), dtype=np.uint64)
                yield shard, B.joined([
                    B.packed(np.diff(self.ids[own], prepend=np.uint64(0))), B.packed(self.seen[around]),
                    *[_packed_rows([place[c] for c in columns], count) for columns, count in kinds],
                ])

    def log_p(self, answers: list[bytes], n: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probability of each token, on its own and by the model; ``answers`` in the order of shards."""
        codes = [B.parted(x) for x in answers]
        found = []
        for i, order in enumerate((self.t_order, self.a_order, self.b_order)):
            own = np.empty(len(order), np.uint8)
            own[order] = np.concatenate([np.zeros(0, np.uint8), *[B.unpacked(x[i]).astype(np.uint8) for x in codes]])
            found.append(own)
        three, before, after = found
        # a triple of a word in one shard is told by its distance to its pair
        three = decoded(np.where((self.seen >= SPLIT)[self.t_v], three, three + before[self.t_a]))
        before, after = decoded(before), decoded(after)
        alone = (self.seen + 0.5) / (n + 0.5 * (distinct + 1))
        total = self.seen[self.t_v] + MU
        two = after[self.t_b] + MU / total * alone[self.t_w]
        p = (three + MU3 / total * two) / (before[self.t_a] + MU3 / total)
        base = np.log10(alone)[self.token]
        scored = base.copy()
        scored[self.asked] = np.log10(np.minimum(p, 1.0))[self.t_of]
        return base, scored


def _packed_rows(columns: list[np.ndarray], count: np.ndarray) -> bytes:
    """Sorted rows of numbers: each column as steps inside the run of the columns before it, and the runs' lengths."""
    new = np.zeros(len(count), bool)
    new[:1] = True
    body = []
    for i, column in enumerate(columns):
        opens = new.copy()
        new[1:] |= column[1:] != column[:-1]
        if i == len(columns) - 1:
            new[:] = True
        at = np.flatnonzero(new)
        value = column[at]
        step = np.diff(value, prepend=np.uint64(0))
        fresh = opens[at]
        step[fresh] = value[fresh]
        # how many runs of this column each run of the column before has
        each = np.diff(np.append(np.flatnonzero(fresh), len(at)))
        body += [B.packed(each), B.packed(step)]
    return B.joined([*body, B.packed(count)])


def _unpacked_rows(data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns and the counts."""
    *listed, count = [B.unpacked(x) for x in B.parted(data)]
    columns: list[np.ndarray] = []
    for each, step in zip(listed[0::2], listed[1::2], strict=True):
        each = each.astype(np.int64)
        total = np.cumsum(step)
        if len(total):
            first = np.cumsum(each) - each
            total = total - np.repeat(total[first] - step[first], each)
        # runs of this column in each run of the one before
        columns = [*(np.repeat(c, each) for c in columns), total]
    return columns, count.astype(np.int64)


def _rows_of(table: pa.Table) -> list[tuple[int, int, bytes]]:
    return list(zip(table["kind"].to_pylist(), table["part"].to_pylist(), table["data"].to_pylist(), strict=True))


def _ask_contexts(shards: int):
    def ask(rows: pa.Table) -> pa.Table:
        own = _Block(_rows_of(rows), shards)
        block = rows["block"][0].as_py()
        out = [(4, shard, block, shard, request) for shard, request in own.requests(shards)]
        return pa.Table.from_batches([B.row_batch(out)] if out else [], schema=B._SCHEMA)

    return ask


def _stretches(requests: list[bytes]):
    """The requests to a shard in stretches of the words ``v`` in order, each of a bounded number of rows or one word."""
    parted = [B.parted(r) for r in requests]
    ids = [np.cumsum(B.unpacked(p[0])) for p in parted]
    words = np.unique(np.concatenate(ids))
    before, rows = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    held = []
    for own, (_, seen, *kinds) in zip(ids, parted, strict=True):
        local = np.searchsorted(words, own).astype(np.int32)
        held.append([])
        n = np.zeros(len(own), np.int64)
        for columns, count in map(_unpacked_rows, kinds):
            n += np.bincount(columns[0].astype(np.int64), minlength=len(own))
            held[-1].append((*(local[c.astype(np.int64)] for c in columns), count.astype(np.int32 if count.max(initial=0) < 1 << 31 else np.int64)))
        rows[local] += n
        before[local[n > 0]] = B.unpacked(seen)
    at = np.cumsum(rows) // STRETCH
    first = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(words)).tolist()
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        yield _Stretch(words, before, [[_cut(x, lo, hi) for x in kinds] for kinds in held])


def _cut(rows: tuple[np.ndarray, ...], first: int, last: int) -> list[np.ndarray]:
    a, b = np.searchsorted(rows[0], [first, last])
    return [x[a:b] for x in rows]


class _Stretch:
    """What all blocks ask about some words, with words by their place in the shard's list.

    Of the distinct pairs (v, u), triples and pairs (v, w) there are keys, counts, and which of them each row asks for.
    """

    def __init__(self, words: np.ndarray, seen: np.ndarray, held: list[list[list[np.ndarray]]]):
        self.words, self.seen = words, seen
        self.m = m = len(words)
        #: Where each block's rows of the three kinds begin, with a last entry.
        self.edges = [np.cumsum([0, *[len(kinds[k][0]) for kinds in held]]) for k in range(3)]
        joined = lambda k, i: np.concatenate([kinds[k][i] for kinds in held]).astype(np.int64)
        v, w, count = joined(0, 0), joined(0, 2), joined(0, 3)
        self.whole = whole = (seen < SPLIT)[v]
        self.n = len(v)
        self.before, self.of_before = np.unique(
            np.append(v * m + joined(0, 1), joined(1, 0) * m + joined(1, 1)), return_inverse=True
        )
        own = np.append(np.where(whole, count, 0), joined(1, 2))
        self.n_before = np.bincount(self.of_before, own, len(self.before))
        self.third, self.of_third = np.unique(self.of_before[: self.n] * m + w, return_inverse=True)
        self.n_third = np.bincount(self.of_third, count, len(self.third))
        self.after, self.of_after = np.unique(np.append((v * m + w)[whole], joined(2, 0) * m + joined(2, 1)), return_inverse=True)
        self.n_after = np.bincount(self.of_after, np.append(count[whole], joined(2, 2)), len(self.after))

    def image(self) -> bytes:
        """The trie of what was seen in training."""
        m, total = self.m, self.seen + MU
        pair, w = np.divmod(self.third, m)
        three, after = self.n_third > 0, self.n_after > 0
        kept = self.n_before > 0
        kept[pair[three]] = True  # also pairs of split words, whose own count another shard may have
        place = np.cumsum(kept) - 1
        share = self.n_before[kept] / total[self.before[kept] // m]
        codes = np.zeros(len(share), np.uint8)
        codes[share > 0] = coded(share[share > 0])
        return Trie.image(
            self.words, (self.before[kept], codes),
            (self.after[after], coded(self.n_after[after] / total[self.after[after] // m])),
            ((place[pair] * m + w)[three], coded(self.n_third[three] / total[self.before[pair[three]] // m])),
        )

    def answers(self, trie: Trie):
        """Of each request, the codes of its triples, and those of the pairs behind it: of words whole here, and asked for."""
        local, m, n = trie.places(self.words), self.m, self.n
        v, u = np.divmod(self.before, m)
        at, there = trie.before.find(local[v], local[u])
        codes = np.zeros(len(at), np.uint8)
        codes[there] = trie.before.codes[at[there]]
        before, a_codes = codes[self.of_before[:n]], codes[self.of_before[n:]]
        pair, w = np.divmod(self.third, m)
        held = there[pair]
        codes = np.zeros(len(pair), np.uint8)
        codes[held] = trie.third.look_up(at[pair[held]], local[w[held]])
        three = codes[self.of_third]
        three = np.where(self.whole, three - before, three)
        v, w = np.divmod(self.after, m)
        after = trie.after.look_up(local[v], local[w])
        wholes = np.append(0, np.cumsum(self.whole))
        b_codes = after[self.of_after[wholes[-1] :]]
        for i in range(len(self.edges[0]) - 1):
            t, a, b = (slice(e[i], e[i + 1]) for e in self.edges)
            pair, whole = self.of_before[t], self.whole[t]
            opens = np.flatnonzero(whole & (np.append(-1, pair[:-1]) != pair))
            once = np.unique(self.of_after[wholes[t.start] : wholes[t.stop]])
            yield three[t], before[t][opens], a_codes[a], after[once], b_codes[b]


def _answer_contexts(folder: str | None):
    def answer(rows: pa.Table) -> pa.Table:
        requests = rows["data"].to_pylist()
        found: list[list[tuple]] = [[] for _ in requests]
        for stretch in _stretches(requests):
            trie = Trie.mapped(stretch.image(), folder)
            for own, codes in zip(found, stretch.answers(trie), strict=True):
                own.append(codes)
        shard, out = rows["part"][0].as_py(), []
        for block, own in zip(rows["block"].to_pylist(), found, strict=True):
            three, a, a_hot, b, b_hot = zip(*own, strict=True)
            out.append((5, block, block, shard, B.joined(B.packed(np.concatenate(x)) for x in (three, a + a_hot, b + b_hot))))
        return pa.Table.from_batches([B.row_batch(out)])

    return answer


def _score(shards: int, n: int, v: int):
    def score(rows: pa.Table) -> pa.Table:
        listed = _rows_of(rows)
        own = _Block(listed, shards)
        base, scored = own.log_p([x for _, _, x in sorted(x for x in listed if x[0] == 5)], n, v)
        return pa.table({
            "doc_id": own.docs["doc_id"], "held_out": own.docs["held_out"],
            "n_tokens": pa.array(own.n, pa.int64()),
            "n_known": pa.array(sums((own.token > 0).astype(np.int64), own.edges), pa.int64()),
            "train_tokens": pa.array(np.full(len(own.n), n, np.int64)),
            "base_score": np.add.reduceat(base, own.edges[:-1]),
            "score": np.add.reduceat(scored, own.edges[:-1]),
        })

    return score


def _map_folder(docs: DataFrame) -> str | None:
    """A new folder for mapped files where the shared folder is one that tasks can open, else none."""
    path = scratch_path(docs.sparkSession)
    return path.removeprefix("file://").removeprefix("file:") if path.startswith(("file:", "/")) else None


def lm_scores(docs: DataFrame, train: Column, held_out: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of ``docs``; the model learns from the rows where ``train`` is true."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(train, F.lit(False)).alias("train"), F.col(text).cast("string").alias("text"),
    )
    shards = text_shards(rows)
    stored = materialize(rows.mapInArrow(_ask_words(shards), B.ROWS), by="kind")
    names = ["kind", "key", "block", "part", "data"]
    # as many tasks as shards: a task's share does not grow with the input
    dealt = lambda frame: frame.repartition(shards, "key").groupBy("key")
    ask = stored.where("kind = 1").select(*names)
    vocabulary = materialize(dealt(ask).applyInArrow(_answer_words(shards), B.ROWS), by="kind")
    totals = vocabulary.where("kind = 3").agg(F.sum("block").alias("n"), F.sum("part").alias("v")).first()
    known = stored.where("kind = 0").select(*names).unionByName(vocabulary.where("kind = 2").select(*names))
    requests = dealt(known).applyInArrow(_ask_contexts(shards), B.ROWS)
    answers = dealt(requests).applyInArrow(_answer_contexts(_map_folder(docs)), B.ROWS)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return dealt(known.unionByName(answers)).applyInArrow(
        _score(shards, totals.n or 0, totals.v or 0),
        f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
