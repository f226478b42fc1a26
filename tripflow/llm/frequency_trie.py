"""Words at one edit from each other, by a trie over letter-group counts.

A word's path is how often it has letters of each of ``GROUPS`` groups, one group a level.
An inserted letter makes one count one higher, a deleted one makes it one lower, a replaced
one does both or neither. So the paths of two words one edit apart differ by a surplus of
at most one and a deficit of at most one in all. :func:`near_pairs` goes down two tries at
once with these two budgets, block by block, the last block first; where one word is left on
both sides, the rest of the path and then the words are compared.
"""

from __future__ import annotations

import numpy as np

GROUPS = 32
BLOCK = 500_000  # pairs of trie nodes, and pairs of words, handled at once
SHORT = 40  # letters; pairs with a longer word are verified one by one


def paths(words: list[bytes], levels: np.ndarray) -> np.ndarray:
    """The path of each word, one letter a byte: counts (255 and more as 255) of the letters whose code is
    ``levels[k]`` modulo ``GROUPS``, for k from 0."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64) % GROUPS
    place = np.empty(GROUPS, np.int64)
    place[levels] = np.arange(GROUPS)
    counts = np.bincount(np.repeat(np.arange(len(words)), sizes) * GROUPS + place[letters], minlength=len(words) * GROUPS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(len(words), GROUPS)


class Trie:
    """Words in the order of their paths; a node is a stretch of them that shares a beginning."""

    def __init__(self, words: list[bytes], levels: np.ndarray):
        own = paths(words, levels)
        self.order = np.lexsort(own.T[::-1]) if len(words) else np.zeros(0, np.int64)
        self.words = [words[i] for i in self.order]
        self.paths = own[self.order]
        turn = np.zeros(len(words) + 1, bool)
        turn[[0, -1]] = True
        self.begins = []  # of the nodes below each level
        for level in range(GROUPS):
            if len(words):
                turn[1:-1] |= self.paths[1:, level] != self.paths[:-1, level]
            self.begins.append(np.flatnonzero(turn))
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(words))
        self.letters = np.zeros((len(words), SHORT + 1), np.uint8)
        short = np.flatnonzero(self.sizes <= SHORT)
        flat = np.frombuffer(b"".join([self.words[i] for i in short]), np.uint8)
        inside = np.arange(len(flat)) - np.repeat(np.cumsum(self.sizes[short]) - self.sizes[short], self.sizes[short])
        self.letters[np.repeat(short, self.sizes[short]), inside] = flat
        # the first and last three letters, as numbers
        self.head = np.array([int.from_bytes(w[:3], "big") for w in self.words], np.int32)
        self.tail = np.array([int.from_bytes(w[-3:], "big") for w in self.words], np.int32)

    def children(self, level: int, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each node (``begin`` to ``end``), its first child's place among the nodes below ``level``, and how many it has."""
        first = np.searchsorted(self.begins[level], begin)
        return first, np.searchsorted(self.begins[level], end) - first


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one letter inserted, deleted or replaced makes b of a."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    low, high = 0, len(b)  # the longest common beginning, by halves: letters are compared in C
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return a[low + 1 :] == b[low + (len(a) == len(b)) :]


def _verified(x: Trie, y: Trie, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of words are one edit apart.

    What stands before the edit and what stands after it are the same in both, and one of
    the two has three letters or more in words of six or more."""
    out = (x.head[i] == y.head[j]) | (x.tail[i] == y.tail[j]) | (x.sizes[i] < 6) | (y.sizes[j] < 6)
    likely = np.flatnonzero(out)
    out[likely] = _one_edit(x, y, i[likely], j[likely])
    return out


def _one_edit(x: Trie, y: Trie, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    swap = x.sizes[i] < y.sizes[j]
    longer = np.where(swap, y.sizes[j], x.sizes[i])
    shorter = np.where(swap, x.sizes[i], y.sizes[j])
    out = longer - shorter <= 1
    easy = np.flatnonzero(out & (longer <= SHORT))
    a, b = x.letters[i[easy]], y.letters[j[easy]]
    a, b = np.where(swap[easy, None], b, a), np.where(swap[easy, None], a, b)
    differs = a != b
    first = differs.argmax(axis=1)
    after = np.arange(SHORT + 1) > first[:, None]
    replaced = (longer == shorter)[easy]
    ahead = (a[:, 1:] != b[:, :-1]) & (np.arange(SHORT) >= first[:, None])
    out[easy] = differs.any(axis=1) & np.where(replaced, ~(differs & after).any(axis=1), ~ahead.any(axis=1))
    for n in np.flatnonzero(out & (longer > SHORT)):
        out[n] = one_edit(x.words[i[n]], y.words[j[n]])
    return out


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` things: whose it is, and its number there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def near_pairs(x: Trie, y: Trie):
    """Blocks (i, j): words ``x.words[i]`` and ``y.words[j]`` are one edit apart, each such pair once."""
    if not len(x.words) or not len(y.words):
        return
    zero = np.zeros(1, np.int64)
    stack = [(0, zero, zero + len(x.words), zero, zero + len(y.words), zero, zero)]
    while stack:
        level, xb, xe, yb, ye, surplus, deficit = stack.pop()
        if len(xb) > BLOCK:
            half = len(xb) // 2
            stack.extend((level, *(v[part] for v in (xb, xe, yb, ye, surplus, deficit))) for part in (slice(half), slice(half, None)))
            continue
        leaf = (xe - xb) * (ye - yb) <= 2 if level < GROUPS else np.ones(len(xb), bool)
        for begin in range(0, int(np.count_nonzero(leaf)), BLOCK):
            yield from _leaves(x, y, *(v[leaf][begin : begin + BLOCK] for v in (xb, xe, yb, ye)), level)
        xb, xe, yb, ye, surplus, deficit = (v[~leaf] for v in (xb, xe, yb, ye, surplus, deficit))
        if not len(xb):
            continue
        first_x, many_x = x.children(level, xb, xe)
        first_y, many_y = y.children(level, yb, ye)
        node, n = _spread(many_x * many_y)
        cx, cy = first_x[node] + n // many_y[node], first_y[node] + n % many_y[node]
        bx, by = x.begins[level], y.begins[level]
        gap = x.paths[bx[cx], level].astype(np.int64) - y.paths[by[cy], level]
        surplus, deficit = surplus[node] + np.maximum(gap, 0), deficit[node] + np.maximum(-gap, 0)
        ok = (surplus <= 1) & (deficit <= 1)
        cx, cy = cx[ok], cy[ok]
        stack.append((level + 1, bx[cx], bx[cx + 1], by[cy], by[cy + 1], surplus[ok], deficit[ok]))


def _leaves(x: Trie, y: Trie, xb, xe, yb, ye, level: int):
    """Verified pairs of the words of paired leaves. A leaf of many words (equal paths) is taken in blocks."""
    many = (xe - xb) * (ye - yb)
    begin = 0
    while begin < len(many):
        upto = begin + max(1, int(np.searchsorted(np.cumsum(many[begin:]), BLOCK, "right")))
        for low in range(0, int(many[begin]) if upto == begin + 1 else 1, BLOCK):
            if upto == begin + 1:
                n = np.arange(low, min(low + BLOCK, int(many[begin])))
                leaf = np.full(len(n), begin)
            else:
                leaf, n = _spread(many[begin:upto])
                leaf += begin
            wide = (ye - yb)[leaf]
            i, j = xb[leaf] + n // wide, yb[leaf] + n % wide
            if level < GROUPS:
                gap = x.paths[i].astype(np.int16) - y.paths[j]
                ok = (np.maximum(gap, 0).sum(axis=1) <= 1) & (np.maximum(-gap, 0).sum(axis=1) <= 1)
                i, j = i[ok], j[ok]
            ok = _verified(x, y, i, j)
            yield i[ok], j[ok]
        begin = upto
