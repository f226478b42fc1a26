"""Word shingles of many texts at once, as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tripflow.llm.words import BLANK, LOWER, bytes_of, hashes, mix, stretches


Counts = tuple[np.ndarray, np.ndarray]  #: hashes, ascending, and the magnitude of their counts
NO_COUNTS: Counts = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))

CLASS_BITS = 5  # the highest bits of a shingle's hash tell how common its words are
HASH_BITS = np.uint64((1 << (64 - CLASS_BITS)) - 1)


def magnitudes(hashes: np.ndarray, counts: Counts) -> np.ndarray:
    """The magnitude of each hash's count, 0 for those that are not listed."""
    known, magnitude = counts
    if not len(known):
        return np.zeros(len(hashes), np.uint64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, magnitude[at], 0).astype(np.uint64)


def word_hashes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word; A-Z count as lower case, words are what white space parts."""
    raw, ends = bytes_of(texts)
    begin, end, text = stretches((~BLANK)[raw].view(np.uint8), ends)
    return hashes(LOWER[raw], begin, end), text


def shingle_sets(texts: pa.StringArray, words: int, common: Counts = NO_COUNTS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, ascending within a text, and where each text's begin, with the end.

    A text of fewer words than a shingle has its whole sequence as one; one without
    words has none. The highest bits of a shingle are the mean magnitude of its words'
    counts in ``common``, so shingles compare only if made with the same counts.
    """
    word, text = word_hashes(texts)
    weight = magnitudes(word, common)
    count = np.bincount(text, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    shingles, owners = [], []
    for n in range(1, words + 1):  # n < words: texts of exactly n words
        at = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.zeros(0, np.int64)
        if n < words:
            at = at[(count[text[at]] == n) & (at == first[text[at]])]
        h, heavy = np.full(len(at), n, np.uint64), np.zeros(len(at), np.uint64)
        for k in range(n):
            h = mix(h + word[at + k], 3)
            heavy += weight[at + k]
        level = np.minimum(heavy // np.uint64(n), np.uint64((1 << CLASS_BITS) - 1))
        shingles.append((h & HASH_BITS) | (level << np.uint64(64 - CLASS_BITS)))
        owners.append(text[at])
    h, owner = np.concatenate(shingles), np.concatenate(owners)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts)))))
