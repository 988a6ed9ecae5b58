"""FM-index over a sequence of symbols: backward search on a wavelet matrix, sampled suffix positions.

The sequence consists of runs of positive symbols, each closed by 0. Runs end the comparison of suffixes:
every 0 counts as a symbol of its own, so sorting is no deeper than the longest run.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling."""
    size = len(symbols)
    ends = symbols == 0
    closing = int(ends.sum())
    rank = symbols.astype(np.int64) + closing
    rank[ends] = np.arange(closing)
    step = 1
    while True:
        ahead = np.zeros(size, dtype=np.int64)
        ahead[:-step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(key, kind="stable")
        fresh = np.empty(size, dtype=np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, step = fresh, 2 * step
        if rank[order[-1]] == size - 1 or step >= size:
            return order


class WaveletMatrix:
    """Counts of a symbol in any prefix of a sequence, a level per bit."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[int, int, np.ndarray]] = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            counts = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(ones, out=counts[1:])
            self.levels.append((bit, len(symbols) - int(counts[-1]), counts))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        begin = np.zeros_like(end)
        for bit, zeros, counts in self.levels:
            one = (symbol >> bit) & 1 == 1
            a, b = counts[begin], counts[end]
            begin, end = np.where(one, zeros + a, begin - a), np.where(one, zeros + b, end - b)
        return end - begin


class FMIndex:
    """Search for phrases in a sequence of runs; the last symbol must be 0."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        order = suffix_array(symbols)
        before = symbols[order - 1]
        before[order == 0] = 0
        self.size = len(symbols)
        self.before = before
        self.tree = WaveletMatrix(before, max(1, int(largest).bit_length()))
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=largest + 1))]).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(symbols == 0)[:-1] + 1])
        place = np.arange(self.size)
        inside = place - np.repeat(starts, np.diff(np.append(starts, self.size)))
        sampled = (inside % SAMPLE == 0)[order]
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, rows of symbols read from the right; 0 pads on the left."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        width = phrases.shape[1]
        for step in range(width):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, width - 1 - step]
            low[live] = self.smaller[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.smaller[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes: step back through the sequence until a sampled one."""
        place = np.empty(len(rows), dtype=np.int64)
        left, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            done = self.sampled[at]
            place[left[done]] = self.samples[self.sample_rank[at[done]]] + steps
            left, at = left[~done], at[~done]
            symbol = self.before[at]
            at = self.smaller[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return place
