"""Words and windows of whole batches of texts as numpy arrays.

Texts are read as their UTF-8 bytes, so that finding and hashing words needs a few
passes over one byte array and no Python object per word. Hashes are 64 bits wide:
a polynomial over a table of random byte values, followed by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Texts are handled in chunks of about so many bytes, which bounds a task's memory.
CHUNK_BYTES = 2_000_000
BASE = 0x9E3779B97F4A7C13  # odd, and 3 modulo 4
WINDOW_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, modulo 2^64."""

    def powers(of: int) -> np.ndarray:
        values = np.full(size, of, dtype=np.uint64)
        values[0] = 1
        return np.cumprod(values, dtype=np.uint64)

    return powers(base), powers(pow(base, -1, 1 << 64))


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    held = 1 << max(16, (size - 1).bit_length())
    return _powers(base, held)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of each span ``values[start:end]``; equal spans have equal hashes."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    held = (sums[ends] - sums[starts]) * down[starts]
    return mix(held + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and the byte each one counts as."""

    inside: np.ndarray
    folded: np.ndarray


def _alphabet(separators: bytes | range, lower: bool) -> Alphabet:
    inside = np.ones(256, dtype=bool)
    inside[list(separators)] = False
    folded = np.arange(256)
    if lower:
        folded[65:91] += 32
        inside[65:91] = True
    return Alphabet(inside, BYTE_VALUES[folded])


# Letters, digits and everything beyond ASCII, with A-Z as a-z.
PLAIN_WORDS = _alphabet([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)], lower=True)
# Everything but the blank and the five control characters for white space, as it is.
BLANK_WORDS = _alphabet([0x20, *range(0x09, 0x0E)], lower=False)


@dataclass
class Words:
    """The words of a run of texts: hashes, byte spans, and where each text begins."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    texts: np.ndarray  # the text of each word, counted from 0
    firsts: np.ndarray  # first word of each text, and the number of words at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    @property
    def places(self) -> np.ndarray:
        """Each word's position in its text."""
        return np.arange(len(self.hashes)) - self.firsts[self.texts]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of ``size`` words inside one text."""
        last = self.firsts[1:][self.texts] - size
        first = np.flatnonzero(np.arange(len(self.hashes)) <= last)
        return first, span_hashes(self.hashes, first, first + size, WINDOW_BASE + 2 * size)


def words_of(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    """The words of texts whose bytes are ``data[offsets[i]:offsets[i + 1]]``."""
    inside = alphabet.inside[data]
    borders = np.zeros(len(data) + 1, dtype=bool)
    borders[offsets] = True
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    starts = np.flatnonzero(after & (~before | borders))
    ends = np.flatnonzero(before & (~after | borders))
    hashes = span_hashes(alphabet.folded[data], starts, ends, BASE)
    texts = np.searchsorted(offsets, starts, side="right") - 1
    firsts = np.searchsorted(starts, offsets, side="left")
    return Words(hashes, starts, ends, texts, firsts)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    batch: pa.RecordBatch | pa.Table, column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, end row, bytes, offsets.

    A text longer than the limit is a run of its own.
    """
    data, offsets = as_bytes(batch.column(column))
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = max(row + 1, min(end, rows))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def binary_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary cells that hold ``values[bounds[i]:bounds[i + 1]]`` as they lie in memory."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    held = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, held)


def list_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """List cells that hold ``values[bounds[i]:bounds[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def sorted_bounds(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array, and its length at the end."""
    if not len(values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
