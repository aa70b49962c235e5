"""Words and word shingles of whole Arrow batches as numpy arrays, inside tasks.

Texts stay UTF-8 bytes: letters A-Z are lower-cased and words end at the space and at
the bytes 0x09 to 0x0D, none of which occurs inside a longer UTF-8 sequence. A word is
a 64-bit hash of its bytes, a shingle a 64-bit hash of its words; equal hashes are
taken as equal shingles (two different ones agree once in 2**64).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from burstwatch.llm.shared import BITS

#: Bytes and rows of text handled at once; one longer text is handled alone.
CHUNK, ROWS = 2_000_000, 4096
#: The same where texts become shingles: arrays of a byte's, a word's or a signature's size take many times the text.
SHINGLED, SHINGLED_ROWS = 500_000, 512

U = np.uint64
_BASE = 0x9E3779B97F4A7C13  # odd, so that it has an inverse modulo 2**64
_UNBASE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer: a bijection that spreads every bit."""
    x = x + U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mixed(np.arange(256, dtype=U), 7)


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, U), np.full(size, _UNBASE, U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


@dataclass
class Chunk:
    """Consecutive texts of a batch: their bytes, lower-cased, and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(texts: pa.Array, target: int = CHUNK, rows: int = ROWS) -> Iterator[Chunk]:
    """The texts of an Arrow column in chunks of about ``target`` bytes; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + target, side="right")) - 1
        last = min(max(last, first + 1), first + rows, len(texts))
        yield Chunk(first, _LOWER[whole[ends[first] : ends[last]]], ends[first : last + 1] - ends[first])
        first = last


def shingled_chunks(texts: pa.Array) -> Iterator[Chunk]:
    """Chunks small enough to hold all arrays of their shingles beside each other."""
    return chunks(texts, SHINGLED, SHINGLED_ROWS)


def word_bounds(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word (one more at the end)."""
    inside = _IN_WORD[chunk.data]
    cut = np.zeros(len(inside) + 1, dtype=bool)
    cut[chunk.offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, chunk.offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, U)
    size = 1 << max(SHINGLED.bit_length(), int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(_BYTE[data] * up[: len(data)], dtype=U)])
    return mixed((sums[ends] - sums[starts]) * down[starts], 1)


def shingle_sets(chunk: Chunk, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, sorted, end to end, and where each text's begin.

    A text with fewer than ``width`` words has all its words as its one shingle; a text
    without words has none.
    """
    starts, ends, first = word_bounds(chunk)
    words = word_hashes(chunk.data, starts, ends)
    count = np.diff(first)
    many = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(many)])
    # the word at which each shingle begins
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], many)
    sums = np.zeros(len(at), U)
    own = np.minimum(np.repeat(count, many), width)
    whole = bool(len(own)) and int(own.min()) == width
    for i in range(width):
        step = mixed(words[np.minimum(at + i, len(words) - 1)] if len(words) else words, 11 + i)
        sums += step if whole else np.where(i < own, step, U(0))
    found = mixed(sums + own.astype(U), 3)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            found[a:b].sort()
    if not len(found):
        return found, bounds
    text = np.repeat(np.arange(len(chunk)), many)
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(chunk)))])


def summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of the values between successive bounds."""
    totals = np.concatenate([np.zeros(1, U), np.cumsum(values, dtype=U)])
    return totals[bounds[1:]] - totals[bounds[:-1]]


def marked(array: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set in an array of :func:`burstwatch.llm.shared.bit_array`."""
    at = (hashes >> U(64 - BITS)).astype(np.int64)
    return (np.frombuffer(array, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
