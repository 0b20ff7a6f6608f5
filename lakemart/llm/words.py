"""Words, word hashes and word shingles of Arrow text columns, as numpy kernels used inside Spark tasks.

A word is a maximal run of letters, digits, underscores and non-ASCII bytes of the lower-cased text; everything else
separates. A shingle is ``size`` consecutive words; a text with fewer words has one shingle of all its words, a text
without words has none. Null texts count as empty. Hashes do not depend on the batch, the partition or the process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
# Bytes hashed at a time; some five 64-bit numbers are held for each.
BLOCK_BYTES = 1 << 18

_U64 = np.uint64
_IS_WORD = np.array([b >= 128 or chr(b).isalnum() or b == 95 for b in range(256)])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = np.asarray(x, dtype=_U64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def seeded(seed: int, count: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, count + 1, dtype=_U64) + _U64(seed) * _U64(1 << 32)) * _U64(0x9E3779B97F4A7C15))


_BYTE = seeded(1, 256)
_POWER_COUNT = 1 << 12
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(_POWER_COUNT, 0x9E3779B97F4A7C15 | 1, dtype=_U64))


def text_buffer(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and the ``n + 1`` byte offsets of the texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a longer text stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, min(last, rows)
        first = last


def _hash_block(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of ``data``; no word goes over a cut."""
    inside = _IS_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    starts[cuts[cuts < len(data)]] = inside[cuts[cuts < len(data)]]
    first = np.flatnonzero(starts)
    if not len(first):
        return np.zeros(0, _U64), first
    at = np.cumsum(starts) - 1
    at = np.arange(len(data)) - first[np.maximum(at, 0)]
    with np.errstate(over="ignore"):
        values = _BYTE[data] * _POWERS[at & (_POWER_COUNT - 1)]
        values[~inside] = 0
        return mix64(np.add.reduceat(values, first)), first


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, their first bytes, and the ``n + 1`` offsets of the texts in words."""
    hashes, firsts, position = [], [], 0
    while position < len(data):
        end = position + BLOCK_BYTES
        if end < len(data):  # end the block between two words
            rest = np.flatnonzero(~_IS_WORD[data[end : end + BLOCK_BYTES]])
            while not len(rest) and end < len(data):
                end += BLOCK_BYTES
                rest = np.flatnonzero(~_IS_WORD[data[end : end + BLOCK_BYTES]])
            end = min(len(data), end + int(rest[0]) if len(rest) else end)
        end = min(end, len(data))
        cuts = offsets[(offsets >= position) & (offsets < end)] - position
        found, first = _hash_block(data[position:end], cuts)
        hashes.append(found)
        firsts.append(first + position)
        position = end
    if not hashes:
        return np.zeros(0, _U64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.concatenate(firsts)
    return np.concatenate(hashes), first, np.searchsorted(first, offsets)


def word_prefixes(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of the words that begin at ``first`` and are longer, and which words they are."""
    edge = np.minimum(first + size, len(data) - 1)
    text = np.searchsorted(offsets, first, side="right")
    longer = (first + size < offsets[text]) if len(first) else np.zeros(0, bool)
    for step in range(1, size + 1):
        longer &= _IS_WORD[data[np.minimum(first + step, len(data) - 1)]]
    kept = np.flatnonzero(longer & (edge == first + size))
    total = np.zeros(len(kept), _U64)
    with np.errstate(over="ignore"):
        for step in range(size):
            total += _BYTE[data[first[kept] + step]] * _POWERS[step]
    return mix64(total), kept


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes in text order, the word each begins at, and the ``n + 1`` offsets of the texts in shingles."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    firsts = np.repeat(offsets[:-1], np.diff(offsets))
    at = np.arange(len(words))
    kept = np.flatnonzero((at + size <= ends) | (at == firsts))
    total = np.zeros(len(kept), _U64)
    with np.errstate(over="ignore"):
        for step in range(size):
            there = kept + step
            value = np.where(there < ends[kept], words[np.minimum(there, len(words) - 1)], _U64(0))
            total = (total ^ value) * _U64(0xD6E8FEB86659FD93) + (total >> _U64(29))
    return mix64(total), kept, np.searchsorted(kept, offsets)


def text_shingles(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and shingle hashes of every text of a column, in order."""
    data, offsets = text_buffer(column)
    for low, high in text_slices(offsets):
        words, _, bounds = word_hashes(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        hashes, _, bounds = shingle_hashes(words, bounds, size)
        for row in range(high - low):
            yield low + row, hashes[bounds[row] : bounds[row + 1]]
