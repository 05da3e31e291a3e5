"""Vectorised hashing of text windows with numpy.

Every function works on a *block* of texts laid end to end as one array, so a
whole Arrow batch costs a fixed number of numpy passes and no Python loop over
characters. Blocks are bounded by ``BLOCK_CHARS``; a longer text is a block of
its own.
"""

from __future__ import annotations

import numpy as np

#: Characters laid end to end at a time; bounds a worker's memory (about 100 bytes a character).
BLOCK_CHARS = 1_000_000

#: Odd multipliers of the polynomial hashes and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return out[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits (a fresh array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Prefix sums of a block of symbols, from which the hash of any slice follows at once.

    The hash of ``x[i:j]`` is ``sum x[i+k] * B**k`` modulo 2**64, mixed: equal slices
    have equal hashes wherever they stand.
    """

    def __init__(self, symbols: np.ndarray, which: int = 0):
        n = len(symbols)
        base, inverse = BASES[which], INVERSES[which]
        self.down = powers(inverse, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(symbols.astype(np.uint64) + np.uint64(which * 977 + 1)) * powers(base, n), out=self.sums[1:])

    def fixed(self, width: int) -> np.ndarray:
        """The hash of every slice of ``width`` symbols."""
        if len(self.sums) <= width:
            return np.empty(0, np.uint64)
        m = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:m]) * self.down[:m])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each slice ``[starts, ends)``, its length included."""
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts laid end to end, and where each text starts (one more for the end)."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, starts


def blocks(sizes, limit: int = BLOCK_CHARS):
    """Ranges (from, to) of consecutive items whose sizes add up to ``limit`` at most, or one item."""
    at, total = 0, 0
    for k, n in enumerate(sizes):
        if k > at and total + n > limit:
            yield at, k
            at, total = k, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, in two passes (prefix and suffix minima of blocks)."""
    n = len(values)
    if n < width:
        return np.empty(0, values.dtype)
    pad = -n % width
    padded = np.concatenate((values, np.full(pad, np.iinfo(values.dtype).max, values.dtype))).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])
