"""Words, shingles and 64-bit hashes of whole Arrow batches, computed with numpy.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Those six bytes never occur inside a UTF-8
sequence, so words are found on the bytes and no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORDS = np.where(SPACE, 0, 1).astype(np.uint8)
# Letters and digits (all bytes above ASCII count as letters) apart from signs.
RUNS = WORDS.copy()
RUNS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
PLACE_VALUE = _rng.integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
SHINGLE_VALUE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
LENGTH_VALUE = np.uint64(0x9E3779B97F4A7C15)

# Bytes worked on at once; a longer text is worked on in stretches that end between words.
STRETCH = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins and ends. A null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def row_groups(places: np.ndarray, size: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``size`` bytes; a longer row stands alone."""
    low, n = 0, len(places) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(places, places[low] + size, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


def word_bounds(data: np.ndarray, places: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of bytes of one kind, kind 0 left out; no run reaches over the end of a row."""
    kind = np.zeros(len(data) + 2, np.uint8)
    kind[1:-1] = kinds[data]
    turn = kind[1:] != kind[:-1]
    turn[places[(places > 0) & (places < len(data))]] = True
    return np.flatnonzero(turn[:-1] & (kind[1:-1] > 0)), np.flatnonzero(turn[1:] & (kind[1:-1] > 0)) + 1


def _stretch_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - begins
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    at = np.repeat(begins, lengths) + inside
    values = BYTE_VALUE[data[at]] * PLACE_VALUE[inside & 4095]
    sums = np.add.reduceat(values, first) if len(first) else np.zeros(0, np.uint64)
    return mix(sums + lengths.astype(np.uint64) * LENGTH_VALUE)


def word_hashes(data: np.ndarray, places: np.ndarray, lower: bool = True, kinds: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word (``WORDS``) or each run of one kind (``RUNS``), and the range of them of each row."""
    return _words(data, places, lower, kinds)[:2]


def word_endings(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``word_hashes``, and the last two bytes of each lower-cased word as a number."""
    return _words(data, places, True, WORDS)


def _words(data: np.ndarray, places: np.ndarray, lower: bool, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    endings = [np.zeros(0, np.int64)]
    hashes, starts, low, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0, len(data)
    while low < n:
        high = min(low + STRETCH, n)
        while high < n:
            gap = np.flatnonzero(SPACE[data[high : high + STRETCH]])
            if len(gap):
                high += int(gap[0])
                break
            high = min(high + STRETCH, n)
        part = LOWER[data[low:high]] if lower else data[low:high]
        begins, ends = word_bounds(part, places - low, kinds)
        hashes.append(_stretch_hashes(part, begins, ends))
        starts.append(begins + low)
        before = np.where(ends - begins > 1, part[np.maximum(ends - 2, 0)], 0).astype(np.int64)
        endings.append(before << 8 | part[ends - 1])
        low = high
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), places), np.concatenate(endings)


def shingles(words: np.ndarray, places: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows row by row; a row with fewer words is one window, one without words none."""
    n = np.diff(places)
    windows = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    ends = np.cumsum(windows)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    first = np.concatenate([[0], ends])
    full = n >= size
    if full.any():
        count = windows[full]
        at = np.repeat(places[:-1][full], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        to = np.repeat(first[:-1][full], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        total = np.zeros(len(at), np.uint64)
        for j in range(size):
            total += words[at + j] * SHINGLE_VALUE[j]
        out[to] = mix(total)
    for few in range(1, size):
        rows = np.flatnonzero(n == few)
        total = np.full(len(rows), few * int(LENGTH_VALUE) % 2**64, np.uint64)
        for j in range(few):
            total += words[places[rows] + j] * SHINGLE_VALUE[j]
        out[first[rows]] = mix(total)
    return out, first


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted without repeats."""
    hashes = np.sort(hashes)
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])] if len(hashes) else hashes
