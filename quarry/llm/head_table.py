"""A hash table of a vocabulary's strings and all their beginnings, for
looking up whole arrays of positions at once."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

U64 = np.uint64
STEP = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class HeadTable:
    """Built from ``(symbols, number)``: ``find`` tells for rolling hashes
    whether they are a string (its number), a beginning (-1) or neither (-2)."""

    def __init__(self, strings: Iterable[tuple[Sequence[int], int]]):
        known: dict[int, int] = {}
        self.longest = 0
        for symbols, number in strings:
            h = 0
            for c in symbols:
                h = (h * STEP + c + 1) & MASK
                known.setdefault(h, -1)
            known[h] = number
            self.longest = max(self.longest, len(symbols))
        keys = np.maximum(mix(np.array(list(known), U64)), U64(1))
        values = np.array(list(known.values()), np.int64)
        self.bits = max(8, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.zeros(size, U64), np.full(size, -2, np.int64)  # key 0: an empty slot
        slot = (keys >> U64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            self.keys[slot[free]] = keys[free]  # of several for one slot the last one stays
            placed = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[placed]]] = values[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    @staticmethod
    def extend(h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return h * U64(STEP) + symbols + U64(1)

    def find(self, h: np.ndarray) -> np.ndarray:
        keys = np.maximum(mix(h), U64(1))
        slot = (keys >> U64(64 - self.bits)).astype(np.int64)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], -2)
        todo = np.flatnonzero((held != keys) & (held != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (held != 0)]
        return out

    def matches(self, symbols: np.ndarray, end: np.ndarray):
        """Every string found in ``symbols`` (uint64), which is cut into words:
        ``end`` gives for each position where its word ends.  Positions,
        lengths and numbers, by length, then by position."""
        at, h, parts = np.arange(len(symbols)), np.zeros(len(symbols), U64), []
        for length in range(1, self.longest + 1):
            go = at + length <= end[at]
            at = at[go]
            h = self.extend(h[go], symbols[at + length - 1])
            found = self.find(h)
            whole = found >= 0
            parts.append((at[whole], np.full(int(whole.sum()), length), found[whole]))
            known = found >= -1
            at, h = at[known], h[known]
            if not len(at):
                break
        return tuple(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
