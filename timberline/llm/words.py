"""Words of many texts at once, as hashes: numpy over the UTF-8 bytes of an Arrow batch.

A word's hash is a polynomial over its bytes, taken from prefix sums modulo 2**64 and moved to the word's
start, then mixed; equal words have equal hashes wherever they stand. Runs of words are hashed in the same way
over the hashes of the words. Characters outside of ASCII consist of bytes from 0x80 on, so that classes of
ASCII characters can be tested byte by byte.
"""

from __future__ import annotations

import numpy as np


def byte_class(ranges: list[tuple[int, int]], complement: bool = False) -> np.ndarray:
    """Bytes inside of the ranges, both ends included, or outside of them."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return ~out if complement else out


# Words are what is left between these characters.
SPACES = [(0x20, 0x20), (0x09, 0x0D)]
NO_LETTERS = [(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)]

SPACED = byte_class(SPACES, complement=True)
PLAIN = byte_class(NO_LETTERS, complement=True)

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well-spread bits of 64-bit numbers."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as far as they are needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.up.size <= n:
            size = max(n + 1, 1 << 16)
            for name, number in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, np.uint64(number))
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


class Words:
    """Splits and hashes. ``inside`` are the bytes of words, ``folded`` what a byte counts as."""

    def __init__(self, inside: np.ndarray, folded: np.ndarray = AS_IS, seed: int = 0):
        self.inside = inside[folded]
        self.bytes = Powers(0xD6E8FEB86659FD93 + 16 * seed)
        self.runs = Powers(0xA24BAED4963EE407 + 16 * seed)
        self.values = mixed(np.arange(1, 257, dtype=np.uint64), seed + 1)[folded]

    def split(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words in ``data``, and the first word of each row with their number at the end."""
        n = data.size
        inside = self.inside[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        breaks = at[(at > 0) & (at < n)]
        first[breaks] = inside[breaks]
        last[breaks - 1] = inside[breaks - 1]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self.bytes.to(data.size)
        sums = np.zeros(data.size + 1, np.uint64)
        np.cumsum(self.values[data] * up[: data.size], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts])

    def sums(self, hashes: np.ndarray) -> np.ndarray:
        """Prefix sums from which ``run`` takes the hash of any run of words."""
        up, _ = self.runs.to(hashes.size)
        out = np.zeros(hashes.size + 1, np.uint64)
        np.cumsum(hashes * up[: hashes.size], out=out[1:])
        return out

    def run(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the runs of words from ``start`` to before ``end``."""
        _, down = self.runs.to(sums.size)
        return mixed((sums[end] - sums[start]) * down[start])

    def windows(self, hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of ``length`` words inside of a row."""
        if hashes.size < length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        sums = self.sums(hashes)
        _, down = self.runs.to(hashes.size)
        row = np.repeat(np.arange(first.size - 1, dtype=np.int32), np.diff(first))
        begin = np.flatnonzero(row[: hashes.size - length + 1] == row[length - 1 :])
        return begin, mixed((sums[begin + length] - sums[begin]) * down[begin])
