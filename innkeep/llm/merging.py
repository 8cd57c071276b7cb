"""Merges of many words at a time.

A merge list says which two neighbours become one symbol, and which merges come
first. In each word the first of its merges is made, the leftmost among equals,
until none is left. Words are rows of a matrix; a step makes one merge in every row
that has one, and looks up the two new pairs beside it.
"""

from __future__ import annotations

import numpy as np

NEVER = np.iinfo(np.int32).max
ROWS = 4096  # words in a matrix
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Merges:
    """``left[i], right[i]`` become ``made[i]``; lower ``rank`` first. Symbols are numbers
    from 0; any number that is in no pair is joined with nothing."""

    def __init__(self, left, right, rank, made) -> None:
        self.key = self._keys(np.asarray(left, np.int64), np.asarray(right, np.int64))
        self.rank = np.append(np.asarray(rank, np.int32), np.int32(NEVER))
        self.made = np.append(np.asarray(made, np.int32), np.int32(-1))
        n = len(self.key)
        # Slots of a hash table, sixteen for each pair; the few pairs whose slot is taken are looked up in order.
        self.shift = np.uint64(64 - max(10, (16 * n).bit_length()))
        slot = self._slot(self.key)
        self.table = np.full(1 << int(64 - self.shift), n, np.int32)
        self.table[slot[::-1]] = np.arange(n - 1, -1, -1, dtype=np.int32)
        late = np.flatnonzero(self.table[slot] != np.arange(n))
        self.crowded = np.zeros(len(self.table), bool)
        self.crowded[slot[late]] = True
        self.late = late[np.argsort(self.key[late])]
        self.late_keys = self.key[self.late]
        self.none = n
        self.key = np.append(self.key, np.int64(-1))

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left << 32 | right

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * _FACTOR >> self.shift).view(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The numbers of pairs; ``none`` where there is no such pair. Negative symbols are no symbols."""
        key = self._keys(left.astype(np.int64), right.astype(np.int64) & 0xFFFFFFFF)
        slot = self._slot(key)
        found = self.table[slot]
        wrong = self.key[found] != key
        if len(self.late):
            again = np.flatnonzero(wrong & self.crowded[slot])
            if len(again):
                at = np.minimum(np.searchsorted(self.late_keys, key[again]), len(self.late) - 1)
                hit = self.late_keys[at] == key[again]
                found[again[hit]] = self.late[at[hit]]
                wrong[again[hit]] = False
        found[wrong] = self.none
        return found

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words laid end to end, and their numbers; the same after all merges."""
        lengths = np.asarray(lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(lengths, kind="stable")  # rows of a matrix are of about one length
        parts, counts = [], np.zeros(len(lengths), np.int64)
        for at in range(0, len(order), ROWS):
            rows = order[at:at + ROWS]
            out = self._matrix(symbols, starts[rows], lengths[rows])
            left = out >= 0
            parts.append(out[left])
            counts[rows] = left.sum(axis=1)
        if not parts:
            return np.zeros(0, np.int32), counts
        # Back into the order of the words.
        flat, sorted_counts = np.concatenate(parts), counts[order]
        began = np.empty(len(order), np.int64)
        began[order] = np.cumsum(sorted_counts) - sorted_counts
        ends = np.cumsum(counts)
        index = np.arange(len(flat)) + np.repeat(began - (ends - counts), counts)
        return flat[index], counts

    def _matrix(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        w, size = len(starts), int(lengths.max(initial=0)) + 1  # the last column holds nothing
        if size == 1:
            return np.full((w, 1), -1, np.int32)
        columns = np.arange(size)
        inside = columns < lengths[:, None]
        s = np.where(inside, symbols[np.where(inside, starts[:, None] + columns, 0)], -1).astype(np.int32)
        pair = np.full((w, size), self.none, np.int32)
        pair[:, :-1] = self.find(s[:, :-1].ravel(), s[:, 1:].ravel()).reshape(w, size - 1)
        pair[:, :-1][s[:, 1:] < 0] = self.none
        rank = self.rank[pair]
        after = np.tile(np.minimum(columns + 1, size - 1), (w, 1))
        before = np.tile(columns - 1, (w, 1))
        rows = np.arange(w)
        while True:
            some = rank if len(rows) == w else rank[rows]
            k = some.argmin(axis=1)
            live = some[np.arange(len(rows)), k] < NEVER
            rows, k = rows[live], k[live]
            if not len(rows):
                return s
            right = after[rows, k]
            z = self.made[pair[rows, k]]
            s[rows, k] = z
            s[rows, right] = -1
            rank[rows, right] = NEVER
            beyond = after[rows, right]
            after[rows, k] = beyond
            before[rows, beyond] = k
            self._offer(s, pair, rank, rows, k, z, s[rows, beyond])
            left = before[rows, k]
            # Left of the first column lies the last one, which holds nothing.
            self._offer(s, pair, rank, rows, left, s[rows, left], z)

    def _offer(self, s, pair, rank, rows, at, a, b) -> None:
        found = self.find(a, b)
        found[(a < 0) | (b < 0)] = self.none
        pair[rows, at] = found
        rank[rows, at] = self.rank[found]
