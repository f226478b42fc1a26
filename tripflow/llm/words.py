"""Words of many texts at once, as numpy arrays over an Arrow string column's bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

# White space of the word pattern [^\x20\x09-\x0D]+
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: Lower case for A-Z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_LONG = 256  # bytes
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after the other, and where each begins, with the end."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32  # of Spark's useLargeVarTypes, or not
    ends = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, width)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    return raw, (ends - ends[0]).astype(np.int64)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them (public splitmix64 finaliser)."""
    h = h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as the longest run needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 20)
            steps = np.full(size, _BASE, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = pow(int(_BASE), -1, 1 << 64)
            self.down = np.cumprod(steps)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def stretches(kinds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every longest stretch of one non-zero kind within one text."""
    if not len(kinds):
        none = np.zeros(0, np.int64)
        return none, none, none
    turn = np.ones(len(kinds) + 1, bool)
    np.not_equal(kinds[1:], kinds[:-1], out=turn[1:-1])
    turn[ends[(ends > 0) & (ends < len(kinds))]] = True
    at = np.flatnonzero(turn)
    keep = kinds[at[:-1]] != 0
    begin, end = at[:-1][keep], at[1:][keep]
    return begin, end, np.searchsorted(ends, begin, "right") - 1


def hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each stretch: equal bytes, equal hash, wherever they stand."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    out = mix((sums[end] - sums[begin]) * down[begin], 1) ^ mix((end - begin).astype(np.uint64), 2)
    # long stretches can be made to collide under any such sum
    for n in np.flatnonzero(end - begin > _LONG).tolist():
        out[n] = int.from_bytes(hashlib.blake2b(raw[begin[n] : end[n]].tobytes(), digest_size=8).digest(), "little")
    return out
