"""Elias-Fano lists and an n-gram trie over them, as one byte image that is queried through a memory map.

A sorted list of n numbers below u keeps the low log2(u / n) bits of each as they are and the high bits in unary:
about 2 + log2(u / n) bits a number. Look-ups read the packed bits: a directory with one entry for 512 high bits
finds the window in which a successor lies, and only windows are unpacked.

A level has the successors of numbered parents: monotone pointers to where each parent's begin, the successors, made monotone by
their parent's number, and 8-bit codes of probabilities. The trie has three: words before a context word, words
behind it, and words behind a pair.
"""

from __future__ import annotations

import mmap
import os
import uuid

import numpy as np

from meterbook.llm.blocks import joined

#: High bits of a directory entry in bytes, numbers packed or asked at a time, numbers unpacked at a time.
BLOCK, CHUNK, WINDOW = 64, 1 << 16, 1 << 19


class EliasFano:
    """A sorted list of whole numbers below 2^63."""

    def __init__(self, head: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.n, self.bits = int(head[0]), int(head[1])
        self.low, self.high = low, high
        blocks = -(-len(high) // BLOCK)
        ones = np.zeros(blocks + 1, np.int64)
        for b in range(0, blocks, CHUNK // BLOCK):
            part = np.bitwise_count(high[b * BLOCK : (b + CHUNK // BLOCK) * BLOCK])
            own = np.add.reduceat(part, np.arange(0, len(part), BLOCK), dtype=np.int64)
            ones[b + 1 : b + 1 + len(own)] = own
        #: Numbers before each block, and the high part that its first bit belongs to.
        self.before = np.cumsum(ones)
        self.tops = np.arange(blocks + 1) * (8 * BLOCK) - self.before

    @staticmethod
    def image(values: np.ndarray) -> bytes:
        values = values.astype(np.uint64)
        n = len(values)
        most = int(values[-1]) + 1 if n else 1
        bits = max(0, (most // max(1, n)).bit_length() - 1)
        place = np.arange(bits, dtype=np.uint64)
        low = []
        for a in range(0, n, CHUNK):  # a multiple of 8, so that chunks end on whole bytes
            own = (values[a : a + CHUNK, None] >> place).astype(np.uint8) & np.uint8(1)
            low.append(np.packbits(own.ravel(), bitorder="little").tobytes())
        top = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(top[-1]) + 1 if n else 0, np.uint8)
        high[top] = 1
        head = np.array([n, bits], np.int64).tobytes()
        return joined([head, b"".join([*low, bytes(16)]), np.packbits(high, bitorder="little").tobytes()])

    @classmethod
    def open(cls, buffer: np.ndarray) -> EliasFano:
        head, low, high = slices(buffer)
        return cls(np.frombuffer(head.tobytes(), np.int64), low, high)

    def between(self, first: int, last: int) -> np.ndarray:
        """The numbers at the places from ``first`` up to ``last``."""
        if first >= last:
            return np.zeros(0, np.uint64)
        a = int(np.searchsorted(self.before, first, "right")) - 1
        b = int(np.searchsorted(self.before, last, "left"))
        ones = np.flatnonzero(np.unpackbits(self.high[a * BLOCK : b * BLOCK], bitorder="little"))
        skip = first - int(self.before[a])
        top = ones[skip : skip + last - first] + a * 8 * BLOCK - np.arange(first, last)
        return (top.astype(np.uint64) << np.uint64(self.bits)) | self._lows(first, last)

    def _lows(self, first: int, last: int) -> np.ndarray:
        if not self.bits:
            return np.zeros(last - first, np.uint64)
        bit = np.arange(first, last) * self.bits
        byte, shift = bit >> 3, (bit & 7).astype(np.uint64)
        word = np.zeros(last - first, np.uint64)
        for k in range(min(8, (self.bits + 14) // 8)):
            word |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        word >>= shift
        if self.bits > 57:  # the last bits are in a ninth byte
            over = self.low[byte + 8].astype(np.uint64)
            word |= np.where(shift > 0, over << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return word & np.uint64((1 << self.bits) - 1)

    def at(self, index: np.ndarray) -> np.ndarray:
        """The numbers at places in any order."""
        return _in_order(index.astype(np.int64), lambda i: (i, i + 1), lambda i, a, b: self.between(a, b)[i - a], np.uint64)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The first place whose number is not below x; n if there is none."""

        def bounds(asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            top = (asked >> np.uint64(self.bits)).astype(np.int64)
            a = np.maximum(np.searchsorted(self.tops, top, "left") - 1, 0)
            b = np.minimum(np.searchsorted(self.tops, top, "right"), len(self.tops) - 1)
            return self.before[a], self.before[b]

        search = lambda asked, a, b: a + np.searchsorted(self.between(a, b), asked)
        return _in_order(x.astype(np.uint64), bounds, search, np.int64)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each x is, and whether it is there."""
        at = self.successor(x)
        there = at < self.n
        there[there] = self.at(at[there]) == x.astype(np.uint64)[there]
        return at, there


def _in_order(asked: np.ndarray, bounds, answer, kind) -> np.ndarray:
    """``answer`` over sorted stretches of what is asked whose window, by ``bounds``, is small, or that are one number."""
    if not len(asked):
        return np.zeros(0, kind)
    if (asked[1:] < asked[:-1]).any():
        order = np.argsort(asked, kind="stable")
        out = np.empty(len(asked), kind)
        out[order] = _in_order(asked[order], bounds, answer, kind)
        return out
    first, last = bounds(asked)
    out = np.empty(len(asked), kind)
    todo = [(a, min(a + CHUNK, len(asked))) for a in range(0, len(asked), CHUNK)]
    while todo:
        a, b = todo.pop()
        if b - a > 1 and last[b - 1] - first[a] > WINDOW:
            todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
        else:
            out[a:b] = answer(asked[a:b], int(first[a]), int(last[b - 1]))
    return out


def slices(buffer: np.ndarray) -> list[np.ndarray]:
    """The parts of an image, without copying."""
    n = int.from_bytes(buffer[:4].tobytes(), "little")
    sizes = np.frombuffer(buffer[4 : 4 + 8 * n].tobytes(), np.int64).tolist()
    out, at = [], 4 + 8 * n
    for size in sizes:
        out.append(buffer[at : at + size])
        at += size
    return out


class Level:
    """The successors of parents 0, 1, … with their codes."""

    def __init__(self, buffer: np.ndarray):
        head, pointers, items, self.codes = slices(buffer)
        self.parents, self.span = np.frombuffer(head.tobytes(), np.int64).tolist()
        self.pointers, self.items = EliasFano.open(pointers), EliasFano.open(items)

    @staticmethod
    def image(parents: int, span: int, keys: np.ndarray, codes: np.ndarray) -> bytes:
        """From distinct sorted keys ``parent * span + child``."""
        pointers = np.searchsorted(keys, np.arange(parents + 1) * span)
        return joined([
            np.array([parents, span], np.int64).tobytes(), EliasFano.image(pointers), EliasFano.image(keys),
            codes.astype(np.uint8).tobytes(),
        ])

    def find(self, parent: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each child among its parent's successors, and whether it is there."""
        at, there = self.items.place(parent * self.span + child)
        hit = np.flatnonzero(there)
        own = parent[hit]
        inside = (at[hit] >= self.pointers.at(own).astype(np.int64)) & (at[hit] < self.pointers.at(own + 1).astype(np.int64))
        there[hit[~inside]] = False
        return at, there

    def look_up(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """The codes; 0 for what the level does not have."""
        at, there = self.find(parent, child)
        out = np.zeros(len(at), np.uint8)
        out[there] = self.codes[at[there]]
        return out


class Trie:
    """Codes of pairs and triples of words; words go by their place in the trie's own list."""

    def __init__(self, buffer: np.ndarray):
        words, before, after, third = slices(buffer)
        self.words = EliasFano.open(words)
        self.before, self.after, self.third = Level(before), Level(after), Level(third)

    @staticmethod
    def image(
        words: np.ndarray, before: tuple[np.ndarray, np.ndarray], after: tuple[np.ndarray, np.ndarray],
        third: tuple[np.ndarray, np.ndarray],
    ) -> bytes:
        """From the sorted word numbers, and per level its sorted keys and codes.

        Keys are ``v * len(words) + u`` (``u`` before ``v``), ``v * len(words) + w`` (``w`` behind ``v``) and ``p *
        len(words) + w``, where ``p`` is the place of (v, u) in the first of these levels.
        """
        m = len(words)
        return joined([
            EliasFano.image(words), Level.image(m, m, *before), Level.image(m, m, *after), Level.image(len(before[0]), m, *third),
        ])

    @classmethod
    def mapped(cls, image: bytes, folder: str | None) -> Trie:
        """Over a map of the image: a file in ``folder`` that has no name any more and goes with its reader, else pages of the process."""
        if folder is None:
            pages = mmap.mmap(-1, max(1, len(image)))
            pages.write(image)
            return cls(np.frombuffer(pages, np.uint8))
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, uuid.uuid4().hex)
        try:
            with open(path, "xb") as file:
                file.write(image)
            return cls(np.memmap(path, np.uint8, "r"))
        finally:
            if os.path.exists(path):
                os.unlink(path)

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """The place of each word number; -1 for a word that the trie does not have."""
        at, there = self.words.place(numbers)
        return np.where(there, at, -1)
