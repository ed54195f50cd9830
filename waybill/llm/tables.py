"""A literal table from whole numbers to whole numbers, read by arrays."""

from __future__ import annotations

import numpy as np


class Table:
    """Keys below 2**43 with values below 2**20, found by hash and displacement.

    Keys fall into buckets, and a bucket's displacement sends its keys to slots of their
    own, so a lookup reads two arrays and compares once.
    """

    def __init__(self, values: dict[int, int]):
        self.mask = (1 << max(4, int(len(values) * 1.6).bit_length())) - 1
        self.buckets = (self.mask + 1) // 4
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for key in values:
            groups[self._bucket(key)].append(key)
        entries, shifts = [-1] * (self.mask + 1), [0] * self.buckets
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            for shift in range(self.mask + 1 if groups[b] else 0):
                slots = [self._slot(key, shift) for key in groups[b]]
                if len(set(slots)) == len(slots) and all(entries[s] < 0 for s in slots):
                    for key, s in zip(groups[b], slots, strict=True):
                        entries[s] = (key << 20) + values[key]
                    shifts[b] = shift
                    break
            else:
                if groups[b]:
                    raise ValueError("no displacement")
        self.shifts, self.entries = np.array(shifts), np.array(entries)

    def _bucket(self, key):
        return (key * 40503 + (key >> 16)) % self.buckets

    def _slot(self, key, shift):
        return ((key * 7919 + (key >> 16)) % 1000003 + shift) & self.mask

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        entry = self.entries[self._slot(keys, self.shifts[self._bucket(keys)])]
        return np.where(entry >> 20 == keys, entry & 0xFFFFF, default)

    def one(self, key: int) -> int | None:
        entry = int(self.entries[self._slot(key, int(self.shifts[self._bucket(key)]))])
        return entry & 0xFFFFF if entry >> 20 == key else None


class Trie:
    """Words over numbered letters, walked from their last letter to their first.

    ``step`` leads from a node and a letter to the next node, and ``ends`` holds the number
    of the word that is complete at a node, or -1.
    """

    def __init__(self, words: list[tuple[tuple[int, ...], int]]):
        step: dict[int, int] = {}
        ends = [-1]
        for letters, number in words:
            node = 0
            for letter in reversed(letters):
                key = (node << 17) + letter
                if key not in step:
                    step[key] = len(ends)
                    ends.append(-1)
                node = step[key]
            ends[node] = number
        self.step, self.ends = Table(step), np.array(ends)
        self.longest = max((len(w) for w, _ in words), default=0)

    def walk(self, node: np.ndarray, letters: np.ndarray) -> np.ndarray:
        return self.step.get((node << 17) + letters, -1)
