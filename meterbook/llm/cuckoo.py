"""Cuckoo filters over arrays: bulk insertion, deletion and look-up of 128-bit keys.

A key's 16-bit fingerprint lies in one of two buckets of four slots; either bucket and the fingerprint give the other, so
entries can move, and be removed, without their keys. A filter never misses a key that it holds.
"""

from __future__ import annotations

import numpy as np

SLOTS, LOAD, ROUNDS = 4, 0.8, 500


class Full(RuntimeError):
    """No place found: build a larger filter from the exact table."""


class Cuckoo:
    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> Cuckoo:
        size = len(a)
        while True:
            try:
                made = cls.sized(size)
                made.insert(a, b)
                return made
            except Full:
                size = max(8, size * 2)

    @classmethod
    def load(cls, image: bytes) -> Cuckoo:
        return cls(np.frombuffer(image, np.uint16).reshape(-1, SLOTS).copy())

    def image(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = (b.astype(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        mark = np.where(mark == 0, np.uint16(1), mark)
        return (a.astype(np.uint64) % np.uint64(len(self.slots))).astype(np.int64), mark

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995) & (len(self.slots) - 1))

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        bucket, mark = self._places(a, b)
        one = (self.slots[bucket] == mark[:, None]).any(axis=1)
        return one | (self.slots[self._other(bucket, mark)] == mark[:, None]).any(axis=1)

    def _settle(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Fill free slots; which entries found none."""
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        taken = self.slots[at] != 0
        fits = rank < SLOTS - taken.sum(axis=1)
        free = np.argsort(taken[fits], axis=1, kind="stable")
        self.slots[at[fits], free[np.arange(len(free)), rank[fits]]] = mark[order][fits]
        left = np.ones(len(bucket), bool)
        left[order[fits]] = False
        return left

    def insert(self, a: np.ndarray, b: np.ndarray) -> None:
        bucket, mark = self._places(a, b)
        for turn in range(ROUNDS):
            left = self._settle(bucket, mark)
            bucket, mark = self._other(bucket[left], mark[left]), mark[left]
            if not len(bucket):
                return
            left = self._settle(bucket, mark)
            bucket, mark = bucket[left], mark[left]
            if not len(bucket):
                return
            # one entry of each full bucket changes places with an entry there, which moves on
            _, one = np.unique(bucket, return_index=True)
            slot = (turn * 2654435761 >> 8) % SLOTS
            out = self.slots[bucket[one], slot].copy()
            self.slots[bucket[one], slot] = mark[one]
            mark[one] = out
            bucket[one] = self._other(bucket[one], out)
        raise Full

    def delete(self, a: np.ndarray, b: np.ndarray) -> None:
        """Remove keys that were inserted."""
        bucket, mark = self._places(a, b)
        bucket = np.minimum(bucket, self._other(bucket, mark))
        while len(bucket):
            _, one = np.unique((bucket << 16) | mark, return_index=True)
            here = self.slots[bucket[one]] == mark[one][:, None]
            there_at = self._other(bucket[one], mark[one])
            there = self.slots[there_at] == mark[one][:, None]
            use = here.any(axis=1)
            self.slots[bucket[one][use], here[use].argmax(axis=1)] = 0
            rest = ~use & there.any(axis=1)
            self.slots[there_at[rest], there[rest].argmax(axis=1)] = 0
            keep = np.ones(len(bucket), bool)
            keep[one] = False
            bucket, mark = bucket[keep], mark[keep]
