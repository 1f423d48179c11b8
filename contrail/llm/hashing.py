"""Vectorised rolling hashes of byte texts (64-bit, wrapping), shared by the duplicate finders."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
# The inverse of BASE modulo 2**64, by Newton's iteration: each step doubles the right bits.
INVERSE = 1
for _ in range(6):
    INVERSE = INVERSE * (2 - int(BASE) * INVERSE) % (1 << 64)
INVERSE = np.uint64(INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hashes of any slice of one byte array in constant time."""

    _powers: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls._powers is None or len(cls._powers[0]) <= n:
            size = 1 << max(16, (n + 1).bit_length())
            up, down = np.full(size, BASE), np.full(size, INVERSE)
            up[0] = down[0] = 1
            cls._powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return cls._powers

    def __init__(self, data: np.ndarray) -> None:
        self.up, self.down = self.powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        """The hash of each ``k`` bytes in a row."""
        n = max(0, len(self.sums) - k)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def concat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, a newline after each text; where each text begins, and the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return data, begins


def shingles(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each text's distinct shingles of ``size`` words, sorted by text, then hash.

    A text of fewer words has one shingle of them all; one without words has none.
    """
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not texts:
        return none
    data, begins = concat(texts)
    space = _SPACE[data]
    before = np.r_[True, space[:-1]]
    start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    if not len(start):
        return none
    word = Rolling(data).slices(start, end)
    text = np.searchsorted(begins, start, side="right") - 1
    factors = [np.uint64(pow(int(BASE), 3 * k + 1, 1 << 64)) for k in range(size)]
    n = len(word)
    full = np.zeros(0, np.int64)
    value = np.zeros(0, np.uint64)
    if n >= size:
        value = sum((word[k:n - size + 1 + k] * factors[k] for k in range(size)), np.zeros(n - size + 1, np.uint64))
        same = text[:n - size + 1] == text[size - 1:]
        full, value = text[:n - size + 1][same], mix(value[same])
    count = np.bincount(text, minlength=len(texts))
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(text, short)
        total = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            total[has] += word[first[has] + k] * factors[k]
        full, value = np.r_[full, short], np.r_[value, mix(total + count[short].astype(np.uint64))]
    order = np.lexsort((value, full))
    value, full = value[order], full[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (full[1:] != full[:-1])]
    return value[new], full[new]
