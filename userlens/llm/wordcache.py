"""Results per distinct word, kept in a Python worker between batches.

``HashMap`` is a sorted array of 64-bit word hashes with an integer each. It holds at most ``limit``
entries and starts anew beyond that, so a worker's memory is bounded; entries are only saved work.
"""

from __future__ import annotations

import numpy as np


class HashMap:
    def __init__(self, limit: int = 3_000_000) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.values = np.zeros(0, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, found) of ascending keys."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[at], self.keys[at] == keys

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], np.concatenate([self.values, values])[order]


#: Words that are encoded at once; a tokenizer's result for a word takes many times the word's memory.
ENCODED = 4096


class IdCache:
    """Words -> their token ids, flat. ``encode`` gives the ids of each of a list of words."""

    def __init__(self, encode, limit: int = 3_000_000) -> None:
        self.encode, self.map = encode, HashMap(limit)
        self.clear()

    def clear(self) -> None:
        self.map.clear()
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.count = 0

    def _append(self, lists: list[list[int]]) -> None:
        n = np.array([len(x) for x in lists], dtype=np.int64)
        total = int(n.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + len(n) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        if total:
            self.flat[self.used:self.used + total] = np.fromiter((y for x in lists for y in x), dtype=np.uint32, count=total)
        self.start[self.count + 1:self.count + 1 + len(n)] = self.used + np.cumsum(n)
        self.used += total
        self.count += len(n)

    def ids(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has."""
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.map) > self.map.limit:
            self.clear()
        value, found = self.map.get(keys)
        if not found.all():
            new = np.flatnonzero(~found)
            at = first[new]
            data = raw.tobytes()
            value[new] = self.count + np.arange(len(new))
            for k in range(0, len(at), ENCODED):
                some = at[k:k + ENCODED]
                self._append(self.encode([data[a:b].decode("utf-8", "replace") for a, b in zip(start[some].tolist(), end[some].tolist(), strict=True)]))
            self.map.add(keys[new], value[new])
        entry = value[which]
        begin = self.start[entry]
        n = self.start[entry + 1] - begin
        stop = np.cumsum(n)
        total = int(stop[-1]) if len(stop) else 0
        take = np.arange(total) + np.repeat(begin - (stop - n), n)
        return self.flat[take], n
