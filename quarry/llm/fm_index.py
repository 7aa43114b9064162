"""An FM-index over token sequences, all operations on whole arrays.

The sequences stand in a row, each ended by the symbol 0.  Their
Burrows-Wheeler transform is kept in a wavelet matrix, a bit for each symbol
and each bit of the alphabet, with counts for every 64 bits: about 1.5 bits
where the plain text takes 32.  A match is an interval of the sorted
suffixes; *backward search* puts a token in front of it with two ranks.  The
longest common prefixes of neighbouring suffixes give an interval's parent
(the shorter match from which it grew), and with it *matching statistics*:
for every position of a query the length of the longest match that starts
there, found from the query's end by extending where possible and going to
the parent where not.  Many queries take their steps at once.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks of symbols below ``2 ** bits`` in a sequence."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, n = bits, len(symbols)
        self.words, self.before, self.zeros = [], [], []
        now = symbols
        for level in range(bits - 1, -1, -1):
            bit = ((now >> level) & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[:len(raw)] = raw
            word = packed.view(np.uint64)
            self.words.append(word)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(word), dtype=np.int64)[:-1])).astype(
                np.int32))
            self.zeros.append(n - int(bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))
        self.origin = self._walk(np.arange(1 << bits, dtype=np.int32), np.zeros(1 << bits, np.int32))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            block = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[i][block] + np.bitwise_count(self.words[i][block] & below)
            at = np.where((symbol >> level) & 1, self.zeros[i] + ones, at - ones).astype(np.int32)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._walk(symbol, at) - self.origin[symbol]


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes of ``text`` sorted by their first ``depth`` symbols or
    more, and the ranks by the first 1, 2, 4, ... symbols."""
    n = len(text)
    ranks = [np.unique(text, return_inverse=True)[1].astype(np.int64)]
    step = 1
    while True:
        later = np.zeros(n, np.int64)
        later[:n - step] = ranks[-1][step:] + 1
        key = ranks[-1] * (n + 1) + later
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(key, prepend=key[:1]) != 0)
        ranks.append(rank)
        step *= 2
        if step >= depth or step >= n:
            return order, ranks


class FmIndex:
    """The index of some sequences of symbols from 1 on; ``place[i]`` is the
    sequence's position (of all of them in a row, ends included) of suffix i."""

    def __init__(self, sequences: np.ndarray, sizes: np.ndarray):
        n = len(sequences) + len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(n, np.int64)
        inner = np.ones(n, bool)
        inner[ends] = False
        text[inner] = sequences
        self.n, self.text, self.inner = n, text, inner
        self.start = ends - sizes
        top = int(text.max(initial=0))
        self.place, ranks = suffix_order(text, int(sizes.max(initial=0)) + 1)
        bwt = text[self.place - 1]  # the first sequence follows the last one's end
        self.wavelet = WaveletMatrix(bwt, max(1, top.bit_length()))
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1)))).astype(np.int32)
        left = np.repeat(ends, sizes + 1) - np.arange(n)  # symbols up to the end
        self.common = self._common_prefixes(ranks, left)
        self.shorter = self._nearest_smaller()

    def _common_prefixes(self, ranks: list[np.ndarray], left: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each suffix and the one before it."""
        a, b = self.place[:-1].copy(), self.place[1:].copy()
        out = np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            ok = (a < self.n) & (b < self.n)
            ok[ok] = ranks[level][a[ok]] == ranks[level][b[ok]]
            out += ok << level
            a, b = a + (ok << level), b + (ok << level)
        out = np.minimum(out, np.minimum(left[self.place[:-1]], left[self.place[1:]]))
        return np.concatenate(([0], out, [0])).astype(np.int32)

    def _nearest_smaller(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place of ``common``, the nearest ones before and after it with a smaller value."""
        before, after = np.zeros(self.n + 1, np.int32), np.full(self.n + 1, self.n, np.int32)
        place = np.arange(self.n + 1, dtype=np.int32)
        for value in np.unique(self.common)[1:]:
            here, low = self.common == value, self.common < value
            before[here] = np.maximum.accumulate(np.where(low, place, 0))[here]
            after[here] = np.minimum.accumulate(np.where(low, place, self.n)[::-1])[::-1][here]
        return before, after

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the intervals with a symbol in front."""
        both = self.wavelet.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        first = self.less[symbol]
        return first + both[:len(symbol)], first + both[len(symbol):]

    def parent(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next shorter matches: their intervals and lengths."""
        edge = np.where(self.common[low] >= self.common[high], low, high)
        size = self.common[edge]
        before, after = self.shorter
        return np.where(size > 0, before[edge], 0), np.where(size > 0, after[edge], self.n), size

    def matching_statistics(self, queries: np.ndarray, sizes: np.ndarray, order: np.ndarray | None = None,
                            limit: np.ndarray | None = None) -> np.ndarray:
        """For every position of the queries (symbols in a row, 0 or beyond
        the alphabet for unknown ones) the length of the longest match that
        starts there.  With ``order`` (a number for each indexed position,
        see :attr:`inner`) only matches that start at a position of an order
        below the query position's ``limit`` count."""
        out = np.zeros(len(queries), np.int32)
        stop = np.cumsum(sizes)
        begin = stop - sizes
        least = None if order is None else RangeMinimum(order[self.place])
        top = len(self.less) - 2
        low, high = np.zeros(len(sizes), np.int32), np.full(len(sizes), self.n, np.int32)
        size = np.zeros(len(sizes), np.int32)
        for back in range(1, int(sizes.max(initial=0)) + 1):
            rows = np.flatnonzero(sizes >= back)
            at = stop[rows] - back
            symbol = queries[at].astype(np.int32)
            known = (symbol > 0) & (symbol <= top)
            for r in (rows[~known],):
                low[r], high[r], size[r] = 0, self.n, 0
            rows, at, symbol = rows[known], at[known], symbol[known]
            while len(rows):
                lo, hi = self.extend(symbol, low[rows], high[rows])
                ok = lo < hi
                if least is not None:
                    ok[ok] = least(lo[ok], hi[ok]) < limit[at[ok]]
                good = rows[ok]
                low[good], high[good] = lo[ok], hi[ok]
                size[good] += 1
                out[at[ok]] = size[good]
                retry = ~ok & (size[rows] > 0)
                gone = rows[~ok & ~retry]
                low[gone], high[gone] = 0, self.n
                rows, at, symbol = rows[retry], at[retry], symbol[retry]
                low[rows], high[rows], size[rows] = self.parent(low[rows], high[rows])
        return out


class RangeMinimum:
    """Minima of ranges of an array, from minima of all ranges of 2^k."""

    def __init__(self, values: np.ndarray):
        self.rows = [values.astype(np.int32)]
        while 2 << len(self.rows) - 1 <= len(values):
            half, last = 1 << len(self.rows) - 1, self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima of ``values[low:high]``; no range is empty."""
        out = np.empty(len(low), np.int32)
        k = np.frexp((high - low).astype(np.float64))[1] - 1
        for level in np.unique(k):
            own = k == level
            row = self.rows[level]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << int(level))])
        return out


def intervals(statistics: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """The stretches covered by matches of at least ``threshold``: each match
    of that length reaches from its start over its whole length."""
    out: list[tuple[int, int]] = []
    for at in np.flatnonzero(statistics >= threshold).tolist():
        end = at + int(statistics[at])
        if out and at <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((at, end))
    return out
