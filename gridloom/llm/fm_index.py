"""FM-index of a shard's words: suffix order, wavelet matrix over the transform, sampled positions.

A shard is one Arrow batch. Its words become symbols; symbol 0 separates. Backward search
takes all phrases of one length at once, each step being a rank on every level of the
wavelet matrix.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


class Bits:
    """A bit vector with rank by counts of 64-bit words."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.total = int(counts.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of position ``i``."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class Wavelet:
    """Symbols by their bits, the highest first; each level is sorted stably by its bit."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(width - 1, -1, -1):
            bit = (symbols >> shift) & 1
            bits = Bits(bit.astype(np.uint8))
            zeros = len(symbols) - bits.total
            self.levels.append((shift, bits, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.n = len(symbols)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol comes in front of its position ``i``."""
        low, high = np.zeros_like(i), i
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.rank(low), bits.rank(high)
            low = np.where(one, zeros + a, low - a)
            high = np.where(one, zeros + b, high - b)
        return high - low

    def get(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for _, bits, zeros in self.levels:
            bit, a = bits.get(i), bits.rank(i)
            out = (out << 1) | bit
            i = np.where(bit == 1, zeros + a, i - a)
        return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in suffix order by prefix doubling; separators (0) differ by position and come first."""
    n = len(symbols)
    rank = symbols.astype(np.int64) + n
    zero = np.flatnonzero(symbols == 0)
    rank[zero] = zero
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    reach = 1
    order = np.argsort(rank, kind="stable")
    while n and rank.max() < n - 1:
        later = np.zeros(n, np.int64)
        later[: n - reach] = rank[reach:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        reach *= 2
    return order


class FmIndex:
    """Index of a symbol text that ends with a separator; symbols are below ``2**width``."""

    def __init__(self, symbols: np.ndarray, width: int):
        n = len(symbols)
        order = suffix_order(symbols)
        transform = symbols[order - 1]  # position 0 wraps to the last symbol, a separator
        self.n = n
        self.tree = Wavelet(transform.astype(np.int64), width)
        counts = np.bincount(symbols, minlength=1 << width)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        # run starts are sampled too, so that no walk steps over a separator
        marked = (order % SAMPLE == 0) | (transform == 0)
        self.marked = Bits(marked.astype(np.uint8))
        self.positions = order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``low .. high - 1`` of each phrase (a row of symbols)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for step in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, step].astype(np.int64)
            start = self.first[symbol]
            low[alive], high[alive] = (start + self.tree.rank(symbol, low[alive]),
                                       start + self.tree.rank(symbol, high[alive]))
            alive = alive[low[alive] < high[alive]]
        dead = low >= high
        low[dead] = high[dead] = 0
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to a sampled one."""
        out, steps = np.zeros(len(rows), np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            hit = self.marked.get(rows) == 1
            out[todo[hit]] = self.positions[self.marked.rank(rows[hit])] + steps
            todo, rows = todo[~hit], rows[~hit]
            symbol = self.tree.get(rows)
            rows = self.first[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return out
