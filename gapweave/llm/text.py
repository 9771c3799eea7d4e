"""Array operations on the bytes of many texts at once: tokens and their hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts that are worked on together hold about so many bytes; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ONE = np.uint64(1)

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32
#: Separators of words: blank, tab, line feed, vertical tab, form feed, carriage return.
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers (the finalizer of splitmix64, a bijection)."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets in the bytes) of parts of a string array; null counts as empty."""
    data = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, data.offset * 8)
    content = data.buffers()[2]
    whole = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(data):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(data))
        yield first, last, whole[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial modulo 2**64 in the bytes, and what undoes the power of a place."""
    powers = np.full(len(data), _BASE, np.uint64)
    back = np.full(len(data) + 1, _INVERSE, np.uint64)
    if len(data):
        powers[0] = 1
    back[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _ONE) * powers, out=sums[1:])
    return sums, back


def range_hashes(sums: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges: equal for equal bytes, whatever their place."""
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the ranges of bytes, or of code points if `data` has such: equal for equal content.

    A range is taken in steps of 8 bytes or 3 code points, whose exact content is mixed into the state; so unlike with a
    polynomial no pattern of repetition makes different ranges meet. The cost is that of reading the ranges.
    """
    width, bits = (8, 8) if data.dtype == np.uint8 else (3, 21)
    padded = np.concatenate([data, np.zeros(width, data.dtype)])
    if width == 8:  # the 8 bytes from every place on
        padded = padded.astype(np.uint64)
        for k in (1, 2, 4):
            padded = padded[:-k] | padded[k:] << np.uint64(bits * k)
    content = np.array([(1 << bits * k) - 1 for k in range(9)], np.uint64) if width == 8 else None
    left = ends - starts
    state = mix(left.astype(np.uint64) + np.uint64(seed))
    at, live = starts, np.arange(len(starts))
    while len(live):
        if width == 8:
            step = padded[at] & content[np.minimum(left, width)]
        else:
            step = np.zeros(len(live), np.uint64)
            for k in range(width):
                step |= np.where(left > k, padded[at + k], 0).astype(np.uint64) << np.uint64(bits * k)
        state[live] = mix((state[live] ^ mix(step + _BASE)) * _BASE + _ONE)
        more = left > width
        live, at, left = live[more], at[more] + width, left[more] - width
    return state


def runs(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that do not cross the row offsets."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[rows] = True
    before = np.concatenate([[False], mask[:-1]]) if len(mask) else mask
    after = np.concatenate([mask[1:], [False]]) if len(mask) else mask
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends


def shingles(data: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all shingles of `size` words; a row with fewer words gives its whole sequence, one without none.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased.
    """
    lower = LOWER_ASCII[data]
    starts, ends = runs(IS_WORD[lower], rows)
    words = word_hashes(lower, starts, ends)
    row_of = np.searchsorted(rows, starts, "right") - 1
    per_row = np.bincount(row_of, minlength=len(rows) - 1)
    first = np.concatenate([[0], np.cumsum(per_row)])
    combined = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        combined += mix(words[k : len(words) - size + 1 + k] + np.uint64(k + 1)) if len(combined) else combined
    full = (row_of[: len(combined)] == row_of[size - 1 :]) if len(combined) else np.zeros(0, bool)
    short = np.flatnonzero((per_row > 0) & (per_row < size))
    whole = np.zeros(len(short), np.uint64)
    for i, row in enumerate(short):  # the number of words is part of the hash, so these never equal a full shingle
        own = words[first[row] : first[row + 1]]
        places = np.arange(1, len(own) + 1).astype(np.uint64)
        whole[i] = mix(mix(own + places).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
    return np.concatenate([row_of[: len(combined)][full], short]), np.concatenate([mix(combined[full]), whole])
