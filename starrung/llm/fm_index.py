"""An FM-index over a sequence of small integers, searched for many patterns at once.

Ranks come from a wavelet matrix, one bit vector per bit of the symbols, and
positions from suffix positions sampled along the sequence.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by doubling the length they are ranked by."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    length = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: max(n - length, 0)] = rank[length:] + 1
        pair = rank * (n + 1) + follow
        order = np.argsort(pair, kind="stable")
        step = pair[order]
        new = np.concatenate([[0], np.cumsum(step[1:] != step[:-1])])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        length *= 2


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        words = np.packbits(np.concatenate([bits, np.zeros(-len(bits) % 64 + 64, bool)]), bitorder="little")
        self.words = words.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, mask = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class FMIndex:
    """Symbols are 1 and above; a 0 is put behind them."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        text = np.concatenate([symbols, [0]]).astype(np.int64)
        order = suffix_array(text)
        self.n = len(text)
        last = text[order - 1]
        self.levels = max(1, int(text.max()).bit_length())
        self.top = 1 << self.levels
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.top))])
        self.bits, self.zeros = [], []
        for level in range(self.levels):
            bit = (last >> (self.levels - 1 - level) & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            last = np.concatenate([last[~bit], last[bit]])
        marked = order % sample == 0
        self.marked, self.sampled = Bits(marked), order[marked]

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position ``i`` comes to be at the lowest level, going by the bits of ``symbol``."""
        for level in range(self.levels):
            ones = self.bits[level].rank(i)
            bit = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            i = np.where(bit, self.zeros[level] + ones, i - ones)
        return i

    def _rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._down(symbol, i) - self._down(symbol, np.zeros_like(i))

    def _symbol(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(i)
        for level in range(self.levels):
            bit, ones = self.bits[level].at(i), self.bits[level].rank(i)
            symbol = symbol * 2 + bit
            i = np.where(bit, self.zeros[level] + ones, i - ones)
        return symbol

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last rank of the suffixes that begin with each row of ``patterns``."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.flatnonzero(patterns.max(axis=1) < self.top)
        low[:], high[alive] = 0, self.n
        dead = np.ones(len(patterns), bool)
        dead[alive] = False
        for j in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, j]
            low[alive] = self.less[symbol] + self._rank(symbol, low[alive])
            high[alive] = self.less[symbol] + self._rank(symbol, high[alive])
            gone = low[alive] >= high[alive]
            dead[alive[gone]] = True
            alive = alive[~gone]
        high[dead] = low[dead]
        return low, high

    def locate(self, ranks: np.ndarray) -> np.ndarray:
        """Text position of each suffix rank: back to the next sampled position, counting the steps."""
        at, steps, out = ranks.copy(), np.zeros(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        open_ = np.arange(len(ranks))
        while len(open_):
            hit = self.marked.at(at[open_])
            done = open_[hit]
            out[done] = self.sampled[self.marked.rank(at[done])] + steps[done]
            open_ = open_[~hit]
            symbol = self._symbol(at[open_])
            at[open_] = self.less[symbol] + self._rank(symbol, at[open_])
            steps[open_] += 1
        return out
