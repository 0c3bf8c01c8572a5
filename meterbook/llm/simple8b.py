"""Simple-8b: integers packed into 64-bit words, all with numpy.

The high four bits of a word select how many integers of how many bits share the other sixty. An integer
of more than sixty bits is an escape: a 0 stands in its place, and its place and value are listed. Words
are numbered in blocks; the number of integers before each block lets any block be decoded by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Integers in a word and bits of each, by selector.
COUNT = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
SELECTOR_SHIFT = np.uint64(60)
LIMIT = np.uint64(1 << 60)

BLOCK_WORDS = 1024


@dataclass(frozen=True)
class Packed:
    n: int  # integers
    words: np.ndarray  # uint64
    blocks: np.ndarray  # integers before each block, and n at the end
    escapes: np.ndarray  # rows of place and value, uint64


def _selectors(values: np.ndarray) -> np.ndarray:
    """For each place, the selector that takes the most integers from there on. Beyond the end stand zeros."""
    padded = np.concatenate([values, np.zeros(int(COUNT.max()), np.uint64)])
    best = np.full(len(values), len(COUNT) - 1, np.uint8)
    for s in range(len(COUNT) - 2, -1, -1):
        fits = np.flatnonzero(padded < np.uint64(1 << int(BITS[s])))
        n = int(COUNT[s])
        if len(fits) >= n:
            begin = fits[: len(fits) - n + 1]
            begin = begin[fits[n - 1 :] - begin == n - 1]
            best[begin[begin < len(values)]] = s
    return best


def _chain(step: list[int]) -> Iterator[int]:
    at, end = 0, len(step)
    while at < end:
        yield at
        at += step[at]


def pack(values: np.ndarray) -> Packed:
    values = values.astype(np.uint64)
    large = np.flatnonzero(values >= LIMIT)
    escapes = np.stack([large.astype(np.uint64), values[large]], axis=1)
    if len(large):
        values[large] = 0
    best = _selectors(values)
    starts = np.fromiter(_chain(COUNT[best].tolist()), np.int64)
    selectors = best[starts]
    words = selectors.astype(np.uint64) << SELECTOR_SHIFT
    padded = np.concatenate([values, np.zeros(int(COUNT.max()), np.uint64)])
    for s in np.unique(selectors):
        if BITS[s]:
            rows = np.flatnonzero(selectors == s)
            for j in range(int(COUNT[s])):
                words[rows] |= padded[starts[rows] + j] << np.uint64(j * int(BITS[s]))
    return Packed(len(values), words, np.append(starts[::BLOCK_WORDS], len(values)), escapes)


def unpack(words: np.ndarray, blocks: np.ndarray, escapes: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The integers of blocks ``first`` to ``last`` (exclusive; all by default)."""
    last = len(blocks) - 1 if last is None else last
    begin, end = int(blocks[first]), int(blocks[last])
    words = words[first * BLOCK_WORDS : last * BLOCK_WORDS]
    selectors = (words >> SELECTOR_SHIFT).astype(np.int64)
    at = np.cumsum(COUNT[selectors]) - COUNT[selectors]
    out = np.zeros(end - begin + int(COUNT.max()), np.uint64)
    for s in np.unique(selectors):
        if BITS[s]:
            rows = selectors == s
            places, of = at[rows], words[rows]
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for j in range(int(COUNT[s])):
                out[places + j] = (of >> np.uint64(j * int(BITS[s]))) & mask
    out = out[: end - begin]
    if len(escapes):
        place = escapes[:, 0].astype(np.int64)
        inside = (place >= begin) & (place < end)
        out[place[inside] - begin] = escapes[inside, 1]
    return out
