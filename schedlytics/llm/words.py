"""Words of whole texts as numpy arrays: boundaries and 64-bit hashes straight from the UTF-8 bytes, no string per word.

A word is a match of ``[^\\x20\\x09-\\x0D]+``. All the separators are single ASCII bytes, so the bytes can be cut without decoding.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Powers of the base, and of its inverse modulo 2^64, that are kept; a longer block has its own.
KEPT_POWERS = 1 << 18


@cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _series(BASE, KEPT_POWERS), _series(np.uint64(pow(int(BASE), -1, 1 << 64)), KEPT_POWERS)


def _series(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, or more."""
    return _kept_powers() if n <= KEPT_POWERS else (_series(BASE, n), _series(np.uint64(pow(int(BASE), -1, 1 << 64)), n))


@dataclass
class Words:
    """Words of several texts in order; ``bounds[i]:bounds[i + 1]`` are those of text ``i``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word: a polynomial in an odd base modulo 2^64 over its bytes and length, then mixed."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        # Sums over the bytes up to each place give every word times a power of the base, which its inverse takes away.
        powers, inverse = _powers(len(self.data))
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[:len(self.data)], out=sums[1:])
        lengths = (self.ends - self.starts).astype(np.uint64)
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + lengths * np.uint64(0xD6E8FEB86659FD93))

    def strings(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a:b].decode("utf-8") for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """Cut a ``large_string`` array without nulls into words; ``lower`` maps A-Z to a-z first."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None and len(offsets) > 1 else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, dtype=np.int64)
    if lower:
        data = LOWER[data]
    outside = SEPARATOR[data]
    first = np.ones(len(data) + 1, dtype=bool)
    first[1:] = np.append(outside[:-1], True) if len(data) else True
    inner = offsets[offsets < len(data)]
    first[inner] = True
    starts = np.flatnonzero(first[:-1] & ~outside) if len(data) else np.zeros(0, dtype=np.int64)
    last = np.ones(len(data), dtype=bool)
    if len(data):
        last[:-1] = outside[1:]
        last[inner[inner > 0] - 1] = True
    ends = np.flatnonzero(last & ~outside) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows of each text, and the bounds of the texts in them.

    A text with at least one but fewer than n words gives one hash of its whole sequence.
    """
    sizes = np.diff(bounds)
    counts = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    first = np.arange(out[-1], dtype=np.int64) + np.repeat(bounds[:-1] - out[:-1], counts)
    width = np.repeat(np.minimum(sizes, n), counts)
    value = np.zeros(len(first), dtype=np.uint64)
    factor = np.uint64(1)
    for k in range(n):
        factor = np.uint64((int(factor) * int(BASE) + 2) % (1 << 64) | 1)
        has = width > k
        if has.all():
            value += hashes[first + k] * factor
        else:
            value[has] += hashes[first[has] + k] * factor
    return mix(value + width.astype(np.uint64)), out
