"""A compressed full-text index over word sequences: Burrows-Wheeler transform, wavelet matrix, backward search.

The text of a shard is a row of segments, each a run of 64-bit word hashes, with an end mark (symbol 0) behind each.
Words are numbered in the shard. Suffixes are sorted by their first ``depth`` symbols, which is all that a
search of at most ``depth`` words can tell apart. The transform is kept as a wavelet matrix: one bit per
level and position, packed into 64-bit blocks with the count of ones before each block.
"""

from __future__ import annotations

import numpy as np

#: searches that advance side by side
BLOCK = 1 << 14


class Bits:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits) // 64 + 1
        padded = np.zeros(n * 64, np.uint8)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.blocks).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)


    def step(self, at: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Where places go on the next level, by the bit of the symbol that is followed."""
        ones = self.rank(at)
        return np.where(one, ones + self.zeros, at - ones)


class Index:
    """The index of the segments ``words[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, depth: int) -> None:
        self.known, number = np.unique(words, return_inverse=True)
        size = np.diff(bounds)
        text = np.zeros(len(words) + len(size), np.int64)
        body = np.ones(len(text), bool)
        body[bounds[1:] + np.arange(len(size))] = False
        text[body] = number + 1
        order = self._sorted(text, depth)
        last = text[order - 1]  # the first suffix is preceded by the last end mark
        self.first = np.searchsorted(text[order], np.arange(len(self.known) + 2))
        self.levels: list[tuple[int, Bits]] = []
        # where the symbols' own runs begin behind the last level
        begin = np.zeros(len(self.known) + 1, np.int64)
        symbols = np.arange(len(begin))
        for level in reversed(range(max(1, int(len(self.known)).bit_length()))):
            bit = (last >> level & 1).astype(np.uint8)
            bits = Bits(bit)
            self.levels.append((level, bits))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
            begin = bits.step(begin, (symbols >> level & 1).astype(bool))
        self.base = self.first[:-1] - begin

    @staticmethod
    def _sorted(text: np.ndarray, depth: int) -> np.ndarray:
        """Places of suffixes ordered by their first ``depth`` symbols at least, by prefix doubling."""
        rank, done = text, 1
        n = len(text)
        while done < depth:
            follow = np.zeros(n, np.int64)
            follow[: n - done] = rank[done:]
            key = rank * (n + 2) + follow
            order = np.argsort(key, kind="stable")
            fresh = np.append(0, np.cumsum(key[order][1:] != key[order][:-1]))
            rank = np.empty(n, np.int64)
            rank[order] = fresh + 1
            done *= 2
        return np.argsort(rank, kind="stable")

    def _back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The bounds of suffixes that go on with what stands at the given bounds, after a symbol."""
        for level, bits in self.levels:
            at = bits.step(at, (symbol >> level & 1).astype(bool))
        return self.base[symbol] + at

    def statistics(self, words: np.ndarray, bounds: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For streamed segments: the words that have ``depth`` words up to them, how far back from there, at most ``depth``, the
        index knows the sequence (matching statistics), and the first row of its suffixes."""
        found = np.searchsorted(self.known, words)
        number = np.where((found < len(self.known)) & (self.known[np.minimum(found, len(self.known) - 1)] == words), found + 1, 0)
        room = np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds)) + 1
        ends = np.flatnonzero(room >= depth)
        first, length = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        for a in range(0, len(ends), BLOCK):
            end = ends[a : a + BLOCK]
            lo, hi, known = np.zeros(len(end), np.int64), np.full(len(end), self.first[-1]), np.zeros(len(end), np.int64)
            live = np.arange(len(end))
            for step in range(depth):
                symbol = number[end[live] - step]
                if not symbol.all():
                    live, symbol = live[symbol > 0], symbol[symbol > 0]
                if step:
                    both = self._back(np.concatenate([symbol, symbol]), np.concatenate([lo[live], hi[live]]))
                    low, high = both[: len(live)], both[len(live) :]
                else:
                    low, high = self.first[symbol], self.first[symbol + 1]
                some = high > low
                live = live[some]
                lo[live], hi[live] = low[some], high[some]
                known[live] = step + 1
            first[a : a + BLOCK], length[a : a + BLOCK] = lo, known
        return ends, length, first
