"""Words, lines and their 64-bit codes for many texts at once, in numpy.

Codes are polynomial: with C the running sum of value(byte) * BASE**i modulo 2**64, any stretch of bytes has the code
(C[end] - C[start]) / BASE**start, so words, lines and n-grams all come from one pass. Two different stretches within one
comparison share a code with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 5
INVERSE = pow(BASE, -1, 1 << 64)
VALUES = np.random.default_rng(20240117).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size + 1, BASE, dtype=U64), np.full(size + 1, INVERSE, dtype=U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(16, int(size).bit_length()))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads small differences."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Packed:
    """Texts in one byte buffer, parted by line breaks. ``at`` has where each text starts, and the end of all."""

    buffer: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, texts: list[str], lower: bool = False) -> Packed:
        data = [x.encode("utf-8", "surrogatepass") for x in texts]
        at = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum([len(x) + 1 for x in data], out=at[1:])
        buffer = np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8)
        return cls(LOWER[buffer] if lower else buffer, at)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of anything but space, tab and the line and page breaks of ASCII."""
        inside = np.zeros(len(self.buffer) + 2, dtype=np.int8)
        inside[1:-1] = ~SPACES[self.buffer]
        step = np.diff(inside)
        return np.flatnonzero(step == 1), np.flatnonzero(step == -1)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        ends = np.flatnonzero(self.buffer == 10)
        return np.concatenate(([0], ends[:-1] + 1)), ends

    def codes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The code of each stretch of bytes."""
        up, down = powers(len(self.buffer))
        total = np.zeros(len(self.buffer) + 1, dtype=U64)
        np.cumsum(VALUES[self.buffer] * up[: len(self.buffer)], out=total[1:])
        return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """The number of the text that each position lies in."""
        return np.searchsorted(self.at, positions, side="right") - 1

    def count(self, flags: np.ndarray) -> np.ndarray:
        """How many positions of each text are flagged."""
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.at])


def grams(codes: np.ndarray, text: np.ndarray, n: int, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the windows of n words that lie in one text, and the first word of each; of those that start at one of
    the words ``first``, if given."""
    size = max(0, len(codes) - n + 1)
    first = np.arange(size) if first is None else first[first < size]
    first = first[text[first] == text[first + n - 1]]
    out = np.zeros(len(first), dtype=U64)
    for k in range(n):
        out = out * U64(BASE) + codes[first + k]
    return mixed(out), first


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, in the given order: whether it occurs twice or more, and whether it occurred before."""
    any_ = np.zeros(len(keys), dtype=bool)
    order = np.argsort(keys)
    placed = keys[order]
    same = placed[1:] == placed[:-1]
    if not same.any():
        return any_, any_.copy()
    member = np.concatenate((same, [False])) | np.concatenate(([False], same))
    inside = order[member]
    begins = np.flatnonzero(np.concatenate(([True], placed[member][1:] != placed[member][:-1])))
    any_[inside] = True
    again = any_.copy()
    again[np.minimum.reduceat(inside, begins)] = False
    return any_, again


def covered(first: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n words that starts at one of ``first``."""
    step = np.zeros(size + 1, dtype=np.int32)
    np.add.at(step, first, 1)
    np.add.at(step, first + n, -1)
    return np.cumsum(step[:-1]) > 0
