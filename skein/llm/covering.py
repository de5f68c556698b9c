"""Covering codes of 32-bit words: anchors that lie within a radius of every word.

A code is a direct sum over ranges of bits: the binary Golay code (23 bits,
covering radius 3), a Hamming code (2**r - 1 bits, radius 1), or all words
(radius 0). The anchors near a word y are y ^ v for the words v of low weight
with the syndrome of y. The finer a code, the more anchors it has for each
word to be replicated to, and the fewer words meet at one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

#: Generator polynomial of the Golay code.
GOLAY = 0b101011100011


@dataclass(frozen=True)
class Code:
    golay: bool
    hamming: int  # bits of the Hamming code's syndrome, 0 for none

    @property
    def radius(self) -> int:
        return 3 * self.golay + (self.hamming > 0)

    @property
    def checks(self) -> int:
        """Bits of a syndrome."""
        return 11 * self.golay + self.hamming

    def syndrome_of_bit(self, bit: int) -> int:
        if self.golay and bit < 23:
            rest = 1 << bit
            for k in range(bit, 10, -1):
                if rest >> k & 1:
                    rest ^= GOLAY << (k - 11)
            return rest
        place = bit - 23 * self.golay + 1
        return place << 11 * self.golay if place < 1 << self.hamming else 0


#: From coarse to fine: 2**18 anchors within 4 bits, 2**21 within 3, 2**27 within 1.
CODES = (Code(True, 3), Code(True, 0), Code(False, 5))
#: Words that may meet at an anchor on average before a finer code is taken.
LOAD = 4096


def code_for(words: int, distance: int) -> Code:
    """The coarsest code at whose anchors up to LOAD of the words meet on average; the finest if there is none."""
    for code in CODES:
        copies = len(near(code, code.radius + distance)[0]) / (1 << code.checks)
        if words * copies <= LOAD * 2 ** (32 - code.checks):
            return code
    return CODES[-1]


@cache
def _tables(code: Code) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for half in (0, 16):
        table = np.zeros(1 << 16, np.uint16)
        for bit in range(16):
            table[1 << bit : 2 << bit] = table[: 1 << bit] ^ np.uint16(code.syndrome_of_bit(half + bit))
        out.append(table)
    return out[0], out[1]


def syndromes(code: Code, words: np.ndarray) -> np.ndarray:
    low, high = _tables(code)
    return low[words & 0xFFFF] ^ high[words >> 16]


@cache
def near(code: Code, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of weight up to distance, by syndrome and then weight; and where each syndrome's begin."""
    by_weight = [np.zeros(1, np.uint32)] + [np.zeros(0, np.uint32)] * distance
    for bit in range(32):
        for w in range(distance, 0, -1):
            by_weight[w] = np.concatenate([by_weight[w], by_weight[w - 1] | np.uint32(1 << bit)])
    words = np.concatenate(by_weight)
    kinds = syndromes(code, words)
    order = np.lexsort((words, np.bitwise_count(words), kinds))
    return words[order], np.searchsorted(kinds[order], np.arange((1 << code.checks) + 1))


def anchors(code: Code, words: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, nearest): every anchor within the code's radius and distance of each word.

    nearest marks one anchor of each word, the nearest (of equals the first).
    """
    vectors, begin = near(code, code.radius + distance)
    kind = syndromes(code, words)
    first, counts = begin[kind], begin[kind.astype(np.int64) + 1] - begin[kind]
    row = np.repeat(np.arange(len(words)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, words[row] ^ vectors[first[row] + place], place == 0
