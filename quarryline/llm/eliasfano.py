"""Elias-Fano sequences and an n-gram trie made of them, in one memory-mapped file."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_ONE = np.uint64(1)


class PackedInts:
    """Integers of a fixed width in 64-bit words."""

    @staticmethod
    def pack(values: np.ndarray, width: int, chunk: int = 1 << 18) -> np.ndarray:
        """Words that hold the values one behind the other, and one spare word."""
        words = np.zeros(len(values) * width // 64 + 2, np.uint64)
        if width:
            for a in range(0, len(values), chunk):  # chunks end at word borders
                part = values[a : a + chunk].astype("<u8")
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :width]
                body = np.packbits(bits.reshape(-1), bitorder="little")
                words.view(np.uint8)[a * width // 8 : a * width // 8 + len(body)] = body
        return words

    @staticmethod
    def get(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
        if not width:
            return np.zeros(len(at), np.uint64)
        bit = at.astype(np.int64) * width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        low = words[word] >> shift
        high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (low | high) & ((_ONE << np.uint64(width)) - _ONE)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th set bit (from 0); before: set bits before each word."""
    word = np.searchsorted(before, k, side="right") - 1
    rest, body, at = k - before[word], words[word], word * 64
    for half in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count(body & ((_ONE << np.uint64(half)) - _ONE)).astype(np.int64)
        past = rest >= ones
        rest = rest - ones * past
        body = np.where(past, body >> np.uint64(half), body)
        at = at + half * past
    return at


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        count = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(count)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(n, width, low words, high words) of values below `universe`."""
        n = len(values)
        width = min(63, max(0, int(universe // max(1, n)).bit_length() - 1))
        values = values.astype(np.uint64)
        low = PackedInts.pack(values & ((_ONE << np.uint64(width)) - _ONE), width)
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        top = int(universe >> width) + n + 2
        bits = np.zeros((top // 64 + 1) * 64, np.uint8)
        bits[at] = 1
        return n, width, low, np.packbits(bits, bitorder="little").view("<u8")

    def get(self, at: np.ndarray) -> np.ndarray:
        top = _select(self.high, self.ones, at) - at
        return (top.astype(np.uint64) << np.uint64(self.width)) | PackedInts.get(self.low, self.width, at)

    def successor(self, values: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Index of the first element not below each value, within [begin, end) where given."""
        return self._search(values, begin, end)[0]

    def find(self, values: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Index of the first element equal to each value, within [begin, end) where given; -1 without one."""
        at, behind = self._search(values, begin, end)
        # Up to `behind` the top parts are equal, so the low bits tell.
        inside = np.flatnonzero(at < behind)
        same = inside[PackedInts.get(self.low, self.width, at[inside]) == values[inside].astype(np.uint64) & ((_ONE << np.uint64(self.width)) - _ONE)]
        out = np.full(len(at), -1, np.int64)
        out[same] = at[same]
        return out

    def _search(self, values: np.ndarray, begin: np.ndarray | None, end: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first element not below each value, and that behind the last one with its top part."""
        values = values.astype(np.uint64)
        top = (values >> np.uint64(self.width)).astype(np.int64)
        last = int(self.zeros[-1])
        # The elements with this top part lie between two zeros of the unary code.
        first = np.where(top > 0, _select(~self.high, self.zeros, np.clip(top - 1, 0, last - 1)) + 1 - top, 0)
        behind = _select(~self.high, self.zeros, np.clip(top, 0, last - 1)) - top
        low, high = np.clip(first, 0, self.n), np.clip(behind, 0, self.n)
        if begin is not None:
            low, high = np.clip(low, begin, end), np.clip(high, begin, end)
        behind = high.copy()
        wanted = values & ((_ONE << np.uint64(self.width)) - _ONE)
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low, behind
            middle = (low[live] + high[live]) >> 1
            small = PackedInts.get(self.low, self.width, middle) < wanted[live]
            low[live] = np.where(small, middle + 1, low[live])
            high[live] = np.where(small, high[live], middle)


class MappedArrays:
    """Arrays in a file without a name, mapped into memory; gone when the object is."""

    def __init__(self, arrays: list[np.ndarray]):
        self.file = tempfile.TemporaryFile()
        places = []
        for a in arrays:
            self.file.write(b"\0" * (-self.file.tell() % 8))
            places.append((self.file.tell(), a.dtype, len(a)))
            self.file.write(a.tobytes())
        self.file.write(b"\0" * 8)
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        self.views = [np.frombuffer(self.map, dtype, n, at) for at, dtype, n in places]


class NgramTrie:
    """Contexts, each with its successors and a whole number for each, such as a count.

    Level 1: the contexts' keys as one monotone sequence, and monotone pointers to
    where each context's successors begin.  Level 2: successors as fingerprints of 32
    bits relative to their context, one monotone sequence since the context's rank is
    put in front, and the place of each number among the distinct numbers.
    """

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, values: np.ndarray):
        """One entry for each n-gram, ordered by (context key, successor fingerprint)."""
        keys, begin = np.unique(contexts, return_index=True)
        rank = np.zeros(len(contexts), np.uint64)
        rank[begin[1:]] = 1
        rank = np.cumsum(rank).astype(np.uint64)
        parts = [
            EliasFano.encode(keys, 1 << 64),
            EliasFano.encode(np.append(begin, len(contexts)), len(contexts) + 1),
            EliasFano.encode((rank << np.uint64(32)) | successors.astype(np.uint64), max(1, len(keys)) << 32),
        ]
        distinct, place = np.unique(values.astype(np.uint64), return_inverse=True)
        self.width = max(0, len(distinct) - 1).bit_length()
        self.mapped = MappedArrays([a for _, _, low, high in parts for a in (low, high)] + [distinct, PackedInts.pack(place, self.width)])
        views = self.mapped.views
        self.keys, self.pointers, self.successors = (
            EliasFano(n, width, views[2 * i], views[2 * i + 1]) for i, (n, width, _, _) in enumerate(parts)
        )
        self.distinct, self.places = views[6:8]

    def value(self, contexts: np.ndarray, successors: np.ndarray, chunk: int = 1 << 17) -> np.ndarray:
        """The number of each n-gram; 0 for one that is not in the trie."""
        if len(contexts) > chunk:
            cuts = range(0, len(contexts), chunk)
            return np.concatenate([self.value(contexts[a : a + chunk], successors[a : a + chunk]) for a in cuts])
        out = np.zeros(len(contexts), np.uint64)
        if not self.keys.n or not len(contexts):
            return out
        # Equal contexts that follow each other are looked up once.
        new = np.ones(len(contexts), bool)
        new[1:] = contexts[1:] != contexts[:-1]
        rank = self.keys.find(contexts[new])
        met = np.flatnonzero(rank >= 0)
        begin, end = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        begin[met], end[met] = (self.pointers.get(rank[met] + i).astype(np.int64) for i in (0, 1))
        of = np.cumsum(new) - 1
        known = np.flatnonzero(rank[of] >= 0)
        of = of[known]
        wanted = (rank[of].astype(np.uint64) << np.uint64(32)) | successors[known].astype(np.uint64)
        at = self.successors.find(wanted, begin[of], end[of])
        same = np.flatnonzero(at >= 0)
        out[known[same]] = self.distinct[PackedInts.get(self.places, self.width, at[same]).astype(np.int64)]
        return out


class BigramTrie(NgramTrie):
    """A trie of quantised log probabilities: codes of 16 bits."""

    CODES = 65_535
    LOWEST = -20.0

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, log_p: np.ndarray):
        super().__init__(contexts, successors, np.round(np.clip(log_p / self.LOWEST, 0, 1) * self.CODES) + 1)

    def log_probability(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Quantised log10 probability of each n-gram; nan for one that is not in the trie."""
        code = self.value(contexts, successors)
        return np.where(code > 0, (code.astype(np.float64) - 1) / self.CODES * self.LOWEST, np.nan)
