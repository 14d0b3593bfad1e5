"""Words, hashes and content-defined cuts of whole columns of text, in numpy inside a task.

All functions work on a chunk: the UTF-8 bytes of some documents one after the other, with the documents' borders.
White space is ASCII, so bytes and code points agree on where words are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit values in which each input bit moves all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Chunk:
    """rows: the first row of the column and the row after the last; data: bytes; borders: offsets of documents in data."""

    rows: tuple[int, int]
    data: np.ndarray
    borders: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The documents of a string column in runs of about `limit` bytes, or one longer document; null counts as empty."""
    if len(column) == 0:
        return
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    borders = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(borders, borders[first] + limit, "right")) - 1)
        yield Chunk((first, last), data[borders[first] : borders[last]], borders[first : last + 1] - borders[first])
        first = last


def word_bounds(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in chunk.data, and the borders of documents among the words."""
    ink = ~_SPACES[chunk.data]
    start, end = ink.copy(), ink.copy()
    start[1:] &= ~ink[:-1]
    end[:-1] &= ~ink[1:]
    inner = np.unique(chunk.borders[(chunk.borders > 0) & (chunk.borders < len(ink))])
    start[inner] = ink[inner]
    end[inner - 1] = ink[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, chunk.borders)


def word_hashes(chunk: Chunk, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; lower: as if A-Z were a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    powers = np.cumprod(np.full(int(sizes.max()), _ODD, np.uint64))
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    letters = chunk.data[place + np.repeat(starts, sizes)]
    values = (_BYTE[_LOWER] if lower else _BYTE)[letters] * powers[place]
    return mix(np.add.reduceat(values, first) + sizes.astype(np.uint64) * _FACTORS[0])


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k values in a row, wherever they are; len(values) - k + 1 of them."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += values[j : j + n] * _FACTORS[1 + j]
    return mix(total)


def byte_gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """As gram_hashes over bytes, for k a power of two, by doubling."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    h, size = _BYTE[data], 1
    while size < k:
        h = h[: len(h) - size] * _FACTORS[2 * size % 61] + (h[size:] ^ (h[size:] >> np.uint64(29))) * _FACTORS[3]
        size *= 2
    return mix(h)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """The least of each w values in a row; len(values) - w + 1 of them."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // w) * w, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n], behind[w - 1 : w - 1 + n])
