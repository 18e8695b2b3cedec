"""Terms of whole texts, cut on bytes and kept as exact strings: A-Z is lower-cased, a table says which bytes a term is made of.

Both term classes here take every byte from 0x80 on, so a character of several bytes is never cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from schedlytics.llm.words import LOWER


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Bytes of a term: the given ranges (both ends included) and everything from 0x80 on."""
    inside = np.zeros(256, dtype=bool)
    for low, high in (*ranges, (0x80, 0xFF)):
        inside[low:high + 1] = True
    return inside


# [^\x00-\x40\x5B-\x60\x7B-\x7F]+ and, after lower-casing, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A))
LETTERS_DIGITS = byte_class((0x30, 0x39), (0x61, 0x7A))


@dataclass
class Terms:
    """Terms of several texts in order; ``bounds[i]:bounds[i + 1]`` are those of text ``i``."""

    strings: pa.Array
    bounds: np.ndarray

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a ``large_string`` array without nulls, and the offsets of its texts in them."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets - offsets[0]


def terms_of(column: pa.Array, inside: np.ndarray) -> Terms:
    """Cut a ``large_string`` array without nulls into its terms, A-Z lower-cased."""
    data, offsets = raw_bytes(column)
    data = LOWER[data]
    held = inside[data]
    opens = held.copy()
    opens[1:] &= ~held[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    opens[heads] = held[heads]
    starts = np.flatnonzero(opens)
    # Without the bytes between terms, a term ends where the next one starts.
    place = np.cumsum(held) - held
    ends = np.append(place[starts], np.count_nonzero(held)).astype(np.int64)
    strings = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[held].tobytes())])
    return Terms(strings, np.searchsorted(starts, offsets))


def runs_of(terms: Terms, n: int) -> Terms:
    """All runs of ``n`` consecutive terms of a text, joined by one space."""
    sizes = np.maximum(np.diff(terms.bounds) - n + 1, 0)
    bounds = np.append(0, np.cumsum(sizes))
    first = np.arange(bounds[-1]) + np.repeat(terms.bounds[:-1] - bounds[:-1], sizes)
    return Terms(pc.binary_join_element_wise(*[terms.strings.take(pa.array(first + k)) for k in range(n)], pa.scalar(" ", pa.large_string())), bounds)
