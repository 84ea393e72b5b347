"""Words that a polynomial hash modulo 2^64 cannot tell apart, in every operator that numbers words."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterbook.llm import lm_scoring, near_dedup, packing, token_counts
from meterbook.llm.runtime import tokenizer_path
from meterbook.llm.textnum import numbers, words

SIGNS = "a1"
FIRST, SECOND = ("".join(SIGNS[(i.bit_count() + flip) % 2] for i in range(1024)) for flip in (0, 1))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, FIRST), (2, SECOND)], "doc_id bigint, text string").repartition(1)


def test_numbers_differ():
    import pyarrow as pa

    got, rows = words(pa.array([FIRST, None, f"{SECOND} {FIRST.upper()}", ""]))
    assert rows.tolist() == [0, 1, 1, 3, 3] and got[0] == got[2] != got[1]
    assert numbers([FIRST.encode()])[0] == got[0]


def test_operators_tell_them_apart(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in ((1, FIRST), (2, SECOND))}
    assert ids[1] != ids[2]
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs).collect()} == {i: len(x) for i, x in ids.items()}
    import zlib

    for r in packing.token_pieces(docs).collect():
        assert (r.length, r.ids_crc32) == (len(ids[r.doc_id]) + 1, zlib.crc32(np.array([*ids[r.doc_id], 0], "<u4").tobytes()))
    assert {r.component_id for r in near_dedup.near_duplicates(docs).collect()} == {1, 2}
    first = F.col("doc_id") == 1
    assert {r.doc_id: r.n_known for r in lm_scoring.lm_scores(docs, first, ~first).collect()} == {1: 2, 2: 1}


def test_a_full_cache_keeps_ids_right(monkeypatch):
    import pyarrow as pa
    from meterbook.llm import pretokens

    monkeypatch.setattr(pretokens, "CACHE", 40)
    pieces = pretokens.Pieces(tokenizer_path())
    for k in range(12):
        texts = [" ".join(f"often{i} word{i * k}" for i in range(k, k + n)) for n in (0, 3, 30, 7)]
        ids, rows = pieces.batch(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[rows[i] : rows[i + 1]].tolist() == pieces.library.encode(text, add_special_tokens=False).ids
