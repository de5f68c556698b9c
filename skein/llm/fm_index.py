"""A full-text index over number sequences: suffix array, wavelet matrix, backward search.

``FMIndex`` holds the Burrows-Wheeler transform of a sequence as a wavelet
matrix (one bit vector with a rank directory for each bit of a symbol), the
number of smaller symbols for each symbol, and every ``step``-th suffix
position. Searches and lookups take many patterns or rows side by side.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of text in order, by doubling; the text must end with its unique least symbol."""
    n = len(text)
    # as many symbols as fit a number are compared at once; what lies beyond the end is never reached in a tie
    bits = max(1, int(text.max()).bit_length())
    width = 63 // bits
    key = np.zeros(n, np.int64)
    for k in range(width):
        key <<= bits
        key[: max(0, n - k)] |= text[k:]
    order = np.argsort(key)
    key, place = key[order], np.arange(n)
    # the rank of a group of equal suffixes is the place of its first
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), place, 0))
    while len(tied := np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)):
        # a tied suffix is longer than width: the shorter ones hold the last symbol
        by = tied[np.argsort(rank[tied] << 32 | rank[tied + width])]
        own, after, at = rank[by], rank[by + width], place[: len(by)]
        group = np.concatenate([[True], own[1:] != own[:-1]])
        change = group | np.concatenate([[True], after[1:] != after[:-1]])
        to = own + at - np.maximum.accumulate(np.where(group, at, 0))
        order[to] = by
        rank[by] = to[np.maximum.accumulate(np.where(change, at, 0))]
        width *= 2
    return order


class _Bits:
    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self._count(np.packbits(padded, bitorder="little").view("<u8"), len(bits))

    @classmethod
    def of_words(cls, words: np.ndarray, n: int) -> _Bits:
        """The n bits of these words."""
        self = cls.__new__(cls)
        self._count(words, n)
        return self

    def _count(self, words: np.ndarray, n: int) -> None:
        self.words = words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.zeros = n - int(counts.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, _Bits]] = []
        for bit in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, _Bits(ones)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    @classmethod
    def of_words(cls, levels: np.ndarray, n: int) -> WaveletMatrix:
        """The matrix of n symbols whose levels have these words."""
        self = cls.__new__(cls)
        self.levels = [(len(levels) - 1 - i, _Bits.of_words(words, n)) for i, words in enumerate(levels)]
        return self

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        begin, at = np.zeros_like(at), at.copy()
        for bit, bits in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            ones_begin, ones_at = bits.rank(begin), bits.rank(at)
            begin = np.where(one, bits.zeros + ones_begin, begin - ones_begin)
            at = np.where(one, bits.zeros + ones_at, at - ones_at)
        return at - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbol at each place."""
        at, out = at.copy(), np.zeros(len(at), np.int64)
        for bit, bits in self.levels:
            one, ones = bits.get(at), bits.rank(at)
            out |= one.astype(np.int64) << bit
            at = np.where(one, bits.zeros + ones, at - ones)
        return out


class FMIndex:
    """Index of a sequence of symbols 1 .. n_symbols - 1 (0 is put at its end).

    A sequence of several texts has their first places in ``texts``, and the
    symbol 1 after each text and nowhere else. No suffix is then compared, and no
    row is located, beyond its text; patterns do not hold that symbol.
    """

    def __init__(self, symbols: np.ndarray, n_symbols: int, step: int = 16, texts: np.ndarray | None = None):
        text = np.append(symbols, 0).astype(np.int64)
        key = text
        if texts is not None:
            ends = np.flatnonzero(text == 1)
            key = np.where(text > 1, text + len(ends), 0)
            key[ends] = 1 + np.arange(len(ends))
        order = suffix_array(key)
        self.n = len(text)
        self.transform = WaveletMatrix(text[order - 1], n_symbols)
        counts = np.bincount(text, minlength=n_symbols)
        self.smaller = np.cumsum(counts) - counts
        known = np.arange(self.n) % step == 0
        if texts is not None:
            known[texts] = True
        self.sampled = _Bits(known[order])
        self.samples = order[known[order]]

    def cells(self) -> dict[str, bytes | int]:
        """The parts of the index as values of a row; rank directories are counted again on loading."""
        bits = b"".join(bits.words.tobytes() for _, bits in self.transform.levels)
        return {"n": self.n, "bits": bits, "smaller": self.smaller.astype("<u4").tobytes(), "sampled": self.sampled.words.tobytes(), "samples": self.samples.astype("<u4").tobytes()}

    @classmethod
    def of_cells(cls, n: int, bits: bytes, smaller: bytes, sampled: bytes, samples: bytes) -> FMIndex:
        """The index that gave these cells."""
        self = cls.__new__(cls)
        self.n = n
        self.smaller = np.frombuffer(smaller, "<u4").astype(np.int64)
        self.transform = WaveletMatrix.of_words(np.frombuffer(bits, "<u8").reshape(-1, n // 64 + 1), n)
        self.sampled = _Bits.of_words(np.frombuffer(sampled, "<u8"), n)
        self.samples = np.frombuffer(samples, "<u4").astype(np.int64)
        return self

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of suffixes that begin with each pattern (patterns, length)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for t in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[live, t]
            base = self.smaller[symbol]
            low[live] = base + self.transform.rank(symbol, low[live])
            high[live] = base + self.transform.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the sequence of each row, stepping back to a sampled one."""
        out = np.zeros(len(rows), np.int64)
        left, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            known = self.sampled.get(row)
            out[left[known]] = self.samples[self.sampled.rank(row[known])] + steps
            left, row = left[~known], row[~known]
            symbol = self.transform.access(row)
            row = self.smaller[symbol] + self.transform.rank(symbol, row)
            steps += 1
        return out
