"""An FM-index over an array of symbols: count and locate many phrases at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank: ones before a position."""

    def __init__(self, flags: np.ndarray):
        n = len(flags)
        packed = np.zeros((n // 64 + 1) * 8, np.uint8)
        body = np.packbits(flags, bitorder="little")
        packed[: len(body)] = body
        self.words = packed.view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """A wavelet tree by levels: symbol at a position, and rank of a symbol before a position."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.depth = max(1, int(alphabet - 1).bit_length())
        self.levels, self.zeros = [], []
        now = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = (now >> level) & 1 == 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(at), at
        for i, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (self.depth - 1 - i)) & 1 == 1
            a, b = bits.rank(low), bits.rank(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol, low, high = np.zeros(len(at), np.int64), np.zeros_like(at), at
        for bits, zeros in zip(self.levels, self.zeros):
            one = bits.get(high)
            a, b = bits.rank(low), bits.rank(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
            symbol = symbol * 2 + one
        return symbol, high - low


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling; every 0 is smaller than the zeros behind it."""
    n = len(symbols)
    zeros = int((symbols == 0).sum())
    rank = symbols.astype(np.int64) + zeros
    rank[symbols == 0] = np.arange(zeros)
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        ordered = rank[order]
        new = np.zeros(n, np.int64)
        np.cumsum(ordered[1:] != ordered[:-1], out=new[1:])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if not n or new[-1] == n - 1:
            return order
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        rank = rank * (n + 1) + after + 1
        order = np.argsort(rank, kind="stable")
        step *= 2


class FMIndex:
    """Index of runs of symbols 1..alphabet-1, each ended by a 0.

    Positions are sampled every `sample` symbols of a run, its first one included,
    so that locating never walks past the start of a run.
    """

    def __init__(self, symbols: np.ndarray, alphabet: int, sample: int = 8):
        symbols = symbols.astype(np.int64)
        order = suffix_order(symbols)
        self.n = len(symbols)
        self.bwt = Wavelet(symbols[order - 1], alphabet)
        self.first = np.zeros(alphabet + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=alphabet), out=self.first[1:])
        index = np.arange(self.n)
        start = np.zeros(self.n, np.int64)
        ends = np.flatnonzero(symbols == 0) + 1
        start[ends[ends < self.n]] = ends[ends < self.n]
        start = np.maximum.accumulate(start)
        kept = ((index - start) % sample == 0)[order]
        self.marked, self.sampled = Bits(kept), order[kept]

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases, right-aligned in a matrix of symbols, by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for step in range(width):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            c = phrases[live, width - 1 - step]
            low[live] = self.first[c] + self.bwt.rank(c, low[live])
            high[live] = self.first[c] + self.bwt.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in the given rows, walking back to the nearest sample."""
        rows, out, steps = rows.copy(), np.zeros(len(rows), np.int64), 0
        live = np.arange(len(rows))
        while len(live):
            done = self.marked.get(rows[live])
            hit = live[done]
            out[hit] = self.sampled[self.marked.rank(rows[hit])] + steps
            live = live[~done]
            symbol, rank = self.bwt.symbol_and_rank(rows[live])
            rows[live] = self.first[symbol] + rank
            steps += 1
        return out
