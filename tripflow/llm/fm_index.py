"""An FM-index over one shard of training text, with word numbers as symbols.

Symbol 0 stands for everything a phrase cannot hold: words that no phrase uses, and the
ends of documents. Each 0 sorts as a symbol of its own, so no comparison of suffixes goes
past one, and a phrase is never found across it.

``FMIndex.search`` walks phrases from their last word to their first: the rows whose
suffix starts with what was read so far are one range of the suffix order, and the ranks
of the next word in the wavelet tree give the range of the longer phrase.
``FMIndex.locate`` steps each row back through the text until it meets one whose position
was kept. All phrases, and all rows, go through these steps at once.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes that start there; ``symbols`` ends with 0.

    Doubling: ranks by the first h symbols give those by 2h. Only suffixes that still tie
    are sorted again; a tie ends before the next 0.
    """
    n = len(symbols)
    counts = np.bincount(symbols)
    first = np.cumsum(counts) - counts
    rank = first[symbols]
    rank[symbols == 0] = np.arange(counts[0])
    order = np.argsort(rank, kind="stable")
    slots = np.flatnonzero(counts[symbols[order]] * (symbols[order] > 0) > 1)
    h = 1
    while len(slots):
        at = order[slots]
        key = rank[at] * n + rank[at + h]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        new = np.ones(len(slots), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, len(slots)))
        order[slots] = at
        rank[at] = np.repeat(slots[begin], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order


class Bits:
    """A row of bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Ranks of symbols in a sequence, one row of bits a level, zeros before ones (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bits), len(bits) - int(np.count_nonzero(bits))))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))
        every = np.arange(alphabet)
        self.first = self._descend(every, np.zeros(alphabet, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where(symbol >> shift & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before place ``at``."""
        return self._descend(symbol, at) - self.first[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before it."""
        symbol = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            one = bits.get(at)
            ones = bits.ones(at)
            symbol |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - self.first[symbol]


class FMIndex:
    """Counts and finds phrases in ``symbols`` (0 to ``alphabet`` - 1, the last one 0)."""

    def __init__(self, symbols: np.ndarray, alphabet: int, sample: int = 8):
        symbols = symbols.astype(np.int64)
        order = suffix_order(symbols)
        last = symbols[order - 1]  # of position 0, the closing 0
        self.rows = len(symbols)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=alphabet))))
        self.tree = WaveletTree(last, alphabet)
        # kept positions: every ``sample``-th, and those after a 0, from which no step leads back
        kept = (order % sample == 0) | (last == 0)
        self.kept, self.positions = Bits(kept), order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and end of the rows of each phrase (a line of ``phrases``, aligned right); equal where it does not occur."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.rows, np.int64)
        width = phrases.shape[1]
        live = np.arange(len(phrases))
        for step in range(width):
            live = live[(lengths[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            word = phrases[live, width - 1 - step]
            low[live] = self.first[word] + self.tree.rank(word, low[live])
            high[live] = self.first[word] + self.tree.rank(word, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where in the text the suffix of each row starts."""
        found = np.empty(len(rows), np.int64)
        at, going, steps = rows.astype(np.int64), np.arange(len(rows)), 0
        while len(going):
            known = self.kept.get(at)
            found[going[known]] = self.positions[self.kept.ones(at[known])] + steps
            going, at = going[~known], at[~known]
            symbol, before = self.tree.access(at)
            at = self.first[symbol] + before
            steps += 1
        return found
