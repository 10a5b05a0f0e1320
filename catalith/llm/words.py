"""Hashes of words and word shingles of many texts at once, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The ASCII white space that separates words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

BLOCK = 1 << 20

# An odd base has an inverse modulo 2**64, so the hash of a slice follows from
# two running sums. Each byte stands for a fixed random number.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20_240_117).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            steps = np.full(size, _BASE, dtype=np.uint64)
            steps[0] = 1
            _powers = np.multiply.accumulate(steps)
            steps[1:] = np.uint64(_INVERSE)
            _inverses = np.multiply.accumulate(steps)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one UTF-8 text; ``A-Z`` count as ``a-z``.

    A long text is taken in blocks that end between words.
    """
    found, start = [], 0
    while start < len(data):
        end = min(start + BLOCK, len(data))
        size = BLOCK
        while end < len(data):
            gaps = np.flatnonzero(_IS_SPACE[data[start:end]])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
                break
            size *= 2
            end = min(start + size, len(data))
        found.append(_block_hashes(data[start:end]))
        start = end
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def _block_hashes(data: np.ndarray) -> np.ndarray:
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    powers, inverses = _powers_to(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate(
            (np.zeros(1, dtype=np.uint64), np.cumsum(_VALUES[_LOWER[data]] * powers[: len(data)], dtype=np.uint64))
        )
        return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def shingle_set(data: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row.

    Fewer words are one shingle; no word is the empty set.
    """
    words = word_hashes(data)
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n]
    # The count of words tells a short text from a part of a longer one.
    hashes = np.sort(mix(total + np.uint64(width)))
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))]


def texts_of(array: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of a string column, without copies; null is empty."""
    array = array.cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.zeros(0, dtype=np.uint8)
    valid = array.is_valid().to_numpy(zero_copy_only=False) if array.null_count else None
    for i in range(len(array)):
        known = valid is None or valid[i]
        yield data[offsets[i] : offsets[i + 1]] if known else data[:0]
