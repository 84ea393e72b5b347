"""Words of whole Arrow batches as numbers, with no Python object per occurrence.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased. Inside a batch words are told apart by their
bytes: Arrow gives each distinct one a code. Across tasks a word's number is a keyed 64-bit BLAKE2b of its bytes, so no
arrangement of letters makes two words clash by rule; two given words share a number with a chance of 2^-64.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_KEY = b"meterbook words"
#: Words whose digests a worker keeps.
REMEMBERED = 1 << 17
_KNOWN: dict[bytes, bytes] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked bytes, none across rows, and where each row's runs begin, with a last entry."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(inside), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def coded(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """A code for each run of marked bytes, and the runs' bytes by code."""
    edges = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist()


def numbers(distinct: list[bytes]) -> np.ndarray:
    """The numbers of words; a worker remembers the digests of the last ones."""
    if len(_KNOWN) + len(distinct) > REMEMBERED:
        _KNOWN.clear()
    for w in distinct:
        if w not in _KNOWN:
            _KNOWN[w] = hashlib.blake2b(w, digest_size=8, key=_KEY).digest()
    made = b"".join(map(_KNOWN.__getitem__, distinct))
    if len(_KNOWN) > REMEMBERED:
        _KNOWN.clear()
    return np.frombuffer(made, "<u8").astype(np.uint64)


@dataclass
class Words:
    """All words of a text column in order, by code; ``rows`` says where each row's begin, with a last entry."""

    code: np.ndarray
    distinct: list[bytes]
    rows: np.ndarray


def lower(raw: np.ndarray) -> np.ndarray:
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def words_of(column: pa.Array | pa.ChunkedArray, cased: bytes | None = None) -> Words:
    """The words of a column. Those that hold the two bytes ``cased`` keep their upper case."""
    raw, offsets = text_bytes(column)
    data = lower(raw)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    starts, ends, rows = bounds(inside, offsets)
    if cased and len(hits := np.flatnonzero((raw[:-1] == cased[0]) & (raw[1:] == cased[1]))):
        held = np.unique(np.searchsorted(starts, hits, "right") - 1)
        step = np.zeros(len(raw) + 1, np.int8)
        np.add.at(step, starts[held], 1)
        np.add.at(step, ends[held], -1)
        data = np.where(np.cumsum(step[:-1], dtype=np.int8) > 0, raw, data)
    return Words(*coded(data, inside, starts, ends), rows)


def words(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all words in order, and where each row's words begin; one more entry closes the last row."""
    found = words_of(column)
    return numbers(found.distinct)[found.code], found.rows


def shingles(word: np.ndarray, rows: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Per row its distinct shingles of k words, sorted, and where each row's begin; fewer words make one shingle."""
    n = np.diff(rows)
    parts, counts = [], np.zeros(len(n), np.int64)
    total = np.zeros(len(word), np.uint64)
    full = max(0, len(word) - k + 1)
    for j in range(k):
        total[:full] += mixed(word[j : j + full] + np.uint64((j + 1) * 0xA0761D6478BD642F % (1 << 64)))
    total = mixed(total)
    for i, (start, size) in enumerate(zip(rows[:-1], n, strict=True)):
        if size >= k:
            own = np.unique(total[start : start + size - k + 1])
        elif size:
            own = np.array([size], np.uint64)
            for j in range(size):
                own = mixed((own ^ word[start + j : start + j + 1]) + np.array([j], np.uint64))
        else:
            continue
        parts.append(own)
        counts[i] = len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)])


def gathered(values: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``values[begin:begin + count]`` of all entries, one behind the other."""
    total = int(count.sum())
    if not total:
        return values[:0]
    step = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return values[step + np.arange(total)]


def sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the values of each row; 0 for a row without."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[rows[1:]] - total[rows[:-1]]
