"""FM-index of one shard of word codes: bounded suffix sorting, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE_RATE = 16


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Suffixes of `codes` in order. Code 0 ends a run of words, and the ends differ from each other
    by their place, so a comparison never goes past one. The last code has to be 0."""
    n = len(codes)
    ends = codes == 0
    first = np.where(ends, np.cumsum(ends) - 1, codes.astype(np.int64) + int(ends.sum()))
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)
    slots, keys, step = np.arange(n), first[order], 1
    members = order
    while len(slots):
        new = np.empty(len(slots), bool)
        new[0] = True
        np.not_equal(keys[1:], keys[:-1], out=new[1:])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(slots)))
        rank[members] = np.repeat(slots[starts], sizes)
        order[slots] = members
        open_ = np.repeat(sizes > 1, sizes)
        slots, members = slots[open_], members[open_]
        keys = rank[members] * n + rank[members + step] if len(slots) else keys[:0]
        again = np.argsort(keys, kind="stable")
        members, keys, step = members[again], keys[again], step * 2
    return order


class WaveletMatrix:
    """Counts of a symbol before a place, for many symbols and places at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((level, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, ones, zeros in self.levels:
            above = ones[at]
            at = np.where((symbols >> level) & 1, zeros + above, at - above)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbols, at) - self._down(symbols, np.zeros_like(at))


class FMIndex:
    def __init__(self, codes: np.ndarray, n_symbols: int, sample_rate: int = SAMPLE_RATE):
        """`codes`: words as 1 to n_symbols - 1, and 0 after each run of them."""
        order = suffix_order(codes)
        before = codes[order - 1]
        before[order == 0] = 0
        self.before, self.n = before, len(codes)
        self.tree = WaveletMatrix(before, max(1, int(n_symbols - 1).bit_length()))
        self.start = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=n_symbols))]).astype(np.int64)
        # a walk to the left has to end within its run: the first word of each run is sampled too
        self.sampled = (order % sample_rate == 0) | (before == 0)
        self.sample_no = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def _left(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.start[symbols] + self.tree.rank(symbols, rows)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of phrases of equal length (a row each): first row and row behind the last."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbols = phrases[live, column]
            low[live], high[live] = self._left(symbols, low[live]), self._left(symbols, high[live])
            live = live[high[live] > low[live]]
        high = np.maximum(low, high)
        dead = np.ones(len(phrases), bool)
        dead[live] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk left to a sampled row, and add the steps."""
        rows, found = rows.copy(), np.zeros(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            at = rows[open_]
            done = self.sampled[at]
            found[open_[done]] = self.samples[self.sample_no[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            rows[open_] = self._left(self.before[at], at)
            steps += 1
        return found
