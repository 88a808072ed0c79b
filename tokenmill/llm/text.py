"""Words and shingles of Arrow text columns as 64-bit hashes, by whole-array operations.

A word is a run of bytes other than the ASCII white space ``\\x20 \\x09-\\x0D``;
A-Z count as a-z.  The hash of a word is a polynomial over a fixed random table
of its bytes, finished by a mixer, so equal words have equal hashes in every
task and every run.  Texts are handled in blocks of half a megabyte, so memory
does not depend on how many texts a batch holds; a text longer than a block is
a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 500_000

_BASE = 0x9E3779B97F4A7C15
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_PLACES = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the splitmix finaliser)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 2**64)
    with np.errstate(over="ignore"):
        return (
            np.cumprod(np.full(size, _BASE, np.uint64)),
            np.cumprod(np.full(size, inverse, np.uint64)),
        )


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(max(1 << 19, 1 << max(0, size - 1).bit_length()))
    return up[:size], down[:size]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    kind = np.dtype(np.int64 if wide else np.int32)
    count = len(column)
    if count == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind, count + 1, column.offset * kind.itemsize)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets.astype(np.int64)


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, end row, bytes, offsets)`` of blocks of whole texts."""
    raw, offsets = utf8(column)
    at, count = 0, len(offsets) - 1
    while at < count:
        end = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, at + 1), count)
        inside = offsets[at : end + 1]
        yield at, end, raw[inside[0] : inside[-1]], inside - inside[0]
        at = end


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the place of its first word."""
    space = _SPACE[raw]
    size = len(raw)
    after = np.ones(size, dtype=bool)
    after[1:] = space[:-1]
    firsts = offsets[:-1]
    after[firsts[firsts < size]] = True
    starts = np.flatnonzero(~space & after)
    before = np.ones(size, dtype=bool)
    before[:-1] = space[1:]
    lasts = offsets[1:] - 1
    before[lasts[lasts >= 0]] = True
    ends = np.flatnonzero(~space & before) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Spans:
    """Hashes of any spans of a byte array, without reading the bytes again."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[raw] * up[: len(raw)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = (self.sums[ends] - self.sums[starts]) * self.down[starts]
            return mix(value + (ends - starts).astype(np.uint64))


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block, and for each text the place of its first word."""
    raw = _LOWER[raw]
    starts, ends, firsts = word_bounds(raw, offsets)
    return Spans(raw)(starts, ends), firsts


def shingles(
    words: np.ndarray, firsts: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and for each text the place of its first.

    A text with fewer words, but not none, has one shingle: its whole sequence.
    """
    counts = np.diff(firsts)
    found = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    place = np.concatenate([[0], np.cumsum(found)])
    text = np.repeat(np.arange(len(counts)), found)
    start = firsts[:-1][text] + np.arange(place[-1]) - place[:-1][text]
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    short = counts < width
    with np.errstate(over="ignore"):
        total = np.zeros(len(start), np.uint64)
        for step in range(width):
            part = padded[start + step] * _PLACES[step]
            if short.any():
                part[short[text] & (step >= counts[text])] = np.uint64(0)
            total += part
        length = np.minimum(counts, width)[text].astype(np.uint64)
        return mix(total + length * _PLACES[15]), place
