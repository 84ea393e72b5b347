"""Ids of a word-level vocabulary file for whole Arrow batches, exactly as its library gives them.

The file's pattern never matches white space and no piece reaches over it, so the ids of a text are the ids
of its words, in order. Each worker keeps the ids of the words it has met, by their bytes; a batch looks
up each distinct word once. The file lower-cases all but its special strings, so words differ by case only where one
may be. A new word of Latin letters and common signs is cut by the file's pattern here and each
cut piece is merged by the library's model; any other word, and one that holds a special string, goes
through the library as a whole.
"""

from __future__ import annotations

import re

import numpy as np

from meterbook.llm.textnum import gathered, words_of

#: Fixed value: the pattern of the vocabulary file, for words of code points below U+0180.
_PATTERN = re.compile(r"[^\W\d_²³¹¼½¾]+|'(?:s|t|re|ve|m|ll|d)|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")
_LATER = re.compile(r"[^\x21-\x7e¡-ſ]|<\|")
#: Fixed value: how the file's special strings begin.
SPECIAL = b"<|"
#: Words whose ids a worker keeps; when the list is full, half of it stays: those met in most batches.
CACHE = 1 << 19
#: Pieces of words kept as Python lists, for new words only.
PARTS = 1 << 17
_OPEN: dict[str, "Pieces"] = {}


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable signs as they are, the rest from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(other)}


class Pieces:
    """Ids of words for one vocabulary file; one object per worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.letters = byte_letters()
        self.parts: dict[str, list[int]] = {}
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.begin, self.count, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.pool, self.parts = np.zeros(0, np.uint32), {}

    def make_room(self) -> None:
        stay = np.argsort(-self.met, kind="stable")[: CACHE // 2]
        names = list(self.place)  # in the order of their places
        self.place = {names[i]: k for k, i in enumerate(stay.tolist())}
        self.pool = gathered(self.pool, self.begin[stay], self.count[stay])
        self.count = self.count[stay]
        self.begin = np.cumsum(self.count) - self.count
        self.met = np.minimum(self.met[stay], 1)

    def part(self, part: str) -> list[int]:
        found = self.parts.get(part)
        if found is None:
            spelt = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
            if len(self.parts) >= PARTS:
                self.parts = {}
            found = self.parts[part] = [x.id for x in self.library.model.tokenize(spelt)]
        return found

    def word(self, raw: bytes) -> list[int]:
        """Ids of one word, given in UTF-8."""
        word = raw.decode()
        if _LATER.search(word) is not None:
            return self.library.encode(word, add_special_tokens=False).ids
        cut = _PATTERN.findall(word.lower())
        return self.part(cut[0]) if len(cut) == 1 else [x for c in cut for x in self.part(c)]

    def batch(self, column) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column in order, and where each row's begin; one more entry closes the last row."""
        found = words_of(column, SPECIAL)
        if len(self.place) + len(found.distinct) > CACHE:
            self.make_room()
        fresh = [w for w in found.distinct if w not in self.place]
        if fresh:
            new = [self.word(w) for w in fresh]
            count = np.fromiter(map(len, new), np.int64, len(new))
            begin = len(self.pool) + np.cumsum(count) - count
            self.pool = np.concatenate([self.pool, np.fromiter((x for ids in new for x in ids), np.uint32, int(count.sum()))])
            self.place.update(zip(fresh, range(len(self.begin), len(self.begin) + len(fresh)), strict=True))
            self.begin, self.count = np.concatenate([self.begin, begin]), np.concatenate([self.count, count])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        at = np.fromiter(map(self.place.__getitem__, found.distinct), np.int64, len(found.distinct))
        self.met[at] += 1
        each = at[found.code]
        ids = gathered(self.pool, self.begin[each], self.count[each])
        upto = np.concatenate([[0], np.cumsum(self.count[each])])
        return ids, upto[found.rows]


def pieces_of(path: str) -> Pieces:
    if path not in _OPEN:
        _OPEN[path] = Pieces(path)
    return _OPEN[path]
