"""Benchmark items inside documents: SimHash windows, multi-index Hamming blocks, exact weighted-shingle similarity.

Every window of an item's length that can hold one of its shingles is fingerprinted from running sums of its shingles'
bits. The second, third, ... occurrence of a shingle in a window counts as another element, so that two bags share as
many elements as their weighted Jaccard similarity says, whatever repeats. The radius of an item follows from its number
of elements: what a window at the least similarity differs by, and five standard deviations. A fingerprint within the
radius of an item's agrees with it in at least one of radius + 1 bit blocks, so looking up the blocks finds all items
within the radius. Each find is verified by the weighted Jaccard similarity of the two bags of shingles. Skipping
windows without any of the item's shingles loses nothing: their similarity is zero.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.words import mix64, seeded, shingle_hashes, text_buffer, text_slices, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
FINGERPRINT_BITS = 128
# Standard deviations that the radius lies above the mean distance of a window at the least similarity.
MARGIN = 5.0
# Item texts held by one pass over the documents; a larger benchmark takes several passes.
ITEM_CHARS_PER_PASS = 8_000_000

_U64 = np.uint64
_SCREEN_BITS = 20
# Windows fingerprinted at a time: what bounds the memory of a text, however long.
_WINDOWS = 8192


@dataclass
class _Items:
    """The items of one pass whose shingles have ``words`` words."""

    words: int
    numbers: np.ndarray  # place of each item in the pass
    lengths: np.ndarray  # in words
    shingles: list[np.ndarray]  # sorted, distinct
    weights: list[np.ndarray]
    prints: np.ndarray  # items x bits
    screen: np.ndarray  # which low bits some shingle has
    known: np.ndarray  # all shingles, sorted, repeated for each item that has it
    owner: np.ndarray


def _bits(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each shingle and fingerprint bit."""
    with np.errstate(over="ignore"):
        halves = np.stack([mix64(shingles ^ seed) for seed in seeded(21, FINGERPRINT_BITS // 64)], axis=1)
    return np.unpackbits(halves.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


@cache
def radius_for(item: int, window: int, similarity: float, bits: int = FINGERPRINT_BITS) -> int:
    """The bits in which fingerprints of so many elements each may differ at ``similarity``; -1 if they cannot reach it.

    The chance that one bit differs is that of two sums of random signs which have all but a few of them in common; for
    many elements it is the angle between the bags.
    """
    shared = math.ceil(similarity * (item + window) / (1 + similarity) - 1e-9)
    if shared > min(item, window):
        return -1
    if max(item, window) > 400:
        chance = math.acos(min(1.0, shared / math.sqrt(item * window))) / math.pi
    else:

        def sums(count: int) -> np.ndarray:
            return np.array([math.comb(count, k) / 2**count for k in range(count + 1)])

        common, own, other = sums(shared), sums(item - shared), sums(window - shared)
        at = 2 * np.arange(shared + 1) - shared

        def positive(rest: np.ndarray) -> np.ndarray:
            value = 2 * np.arange(len(rest)) - (len(rest) - 1)
            return ((at[:, None] + value[None, :] > 0) * rest[None, :]).sum(axis=1)

        a, b = positive(own), positive(other)
        chance = float((common * (a * (1 - b) + b * (1 - a))).sum())
    return min(bits, math.ceil(bits * chance + MARGIN * math.sqrt(bits * chance * (1 - chance))))


def _window_prints(shingles: np.ndarray, span: int) -> np.ndarray:
    """Fingerprint bits of all windows of ``span`` shingles.

    A step adds the next shingle as its count in the new window and takes the first away as its count in the old one.
    """
    n = len(shingles)
    _, group = np.unique(shingles, return_inverse=True)
    place = np.arange(n)
    keys = group * (n + 1) + place
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    coming = rank - np.searchsorted(keys, group * (n + 1) + np.maximum(place - span + 1, 0)) + 1
    going = np.searchsorted(keys, group * (n + 1) + np.minimum(place + span - 1, n), side="right") - rank

    def running(count: np.ndarray, stop: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            again = mix64(shingles[:stop] + (count[:stop] - 1).astype(_U64) * _U64(0x9E3779B97F4A7C15))
        element = np.where(count[:stop] > 1, again, shingles[:stop])
        sums = np.zeros((stop + 1, FINGERPRINT_BITS), np.int32)
        np.cumsum(_bits(element), axis=0, out=sums[1:])
        return sums

    return (running(coming, n)[span:] - running(going, n - span)) > 0


def _block_values(prints: np.ndarray, radius: int) -> np.ndarray:
    """The radius + 1 blocks of each fingerprint as small numbers."""
    edges = np.linspace(0, prints.shape[1], radius + 2).astype(int)
    out = np.zeros((len(prints), radius + 1), np.int64)
    for block in range(radius + 1):
        for bit in range(edges[block], edges[block + 1]):
            out[:, block] = out[:, block] * 2 + prints[:, bit]
    return out


def _index(texts: list[str | None], size: int) -> list[_Items]:
    data, offsets = text_buffer(pa.array(texts, pa.large_string()))
    words, _, bounds = word_hashes(data, offsets)
    lengths = np.diff(bounds)
    found = []
    for words_each in sorted({min(size, int(n)) for n in lengths if n}):
        numbers = np.flatnonzero(np.minimum(lengths, size) == words_each)
        bags, weights, prints = [], [], []
        for number in numbers:
            own = words[bounds[number] : bounds[number + 1]]
            hashes, _, _ = shingle_hashes(own, np.array([0, len(own)]), words_each)
            bag, count = np.unique(hashes, return_counts=True)
            bags.append(bag)
            weights.append(count)
            prints.append(_window_prints(hashes, len(hashes))[0])
        known = np.concatenate(bags)
        owner = np.repeat(np.arange(len(numbers)), [len(b) for b in bags])
        order = np.argsort(known, kind="stable")
        screen = np.zeros(1 << _SCREEN_BITS, bool)
        screen[(known & _U64((1 << _SCREEN_BITS) - 1)).astype(np.int64)] = True
        found.append(_Items(words_each, numbers, lengths[numbers], bags, weights, np.array(prints), screen, known[order], owner[order]))
    return found


def _similarity(window: np.ndarray, bag: np.ndarray, weights: np.ndarray) -> float:
    """Weighted Jaccard: sum of the smaller weights by the sum of the larger ones."""
    own, counts = np.unique(window, return_counts=True)
    _, a, b = np.intersect1d(own, bag, assume_unique=True, return_indices=True)
    smaller = np.minimum(counts[a], weights[b]).sum()
    return float(smaller / (counts.sum() + weights.sum() - smaller))


def _stretches(places: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """First and last of runs of places no further than ``reach`` apart."""
    breaks = np.flatnonzero(np.diff(places) > reach)
    yield from zip(places[np.r_[0, breaks + 1]], places[np.r_[breaks, len(places) - 1]], strict=True)


def _in_text(shingles: np.ndarray, items: _Items, hits: np.ndarray, similarity: float, radius: int | None) -> Iterator[tuple[int, float, int, int]]:
    """Item, similarity, first word and words of the best window for each item that a text contains.

    ``hits`` are the places of shingles that some item has.
    """
    low = np.searchsorted(items.known, shingles[hits], side="left")
    high = np.searchsorted(items.known, shingles[hits], side="right")
    counts = high - low
    place = np.repeat(hits, counts)
    entry = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    owner = items.owner[entry]
    for item in np.unique(owner):
        span = min(int(items.lengths[item]) - items.words + 1, len(shingles))  # shingles in a window
        best = (0.0, 0)
        own = items.prints[item]
        reach = radius_for(int(items.weights[item].sum()), span, similarity) if radius is None else radius
        if reach < 0:
            continue
        for first, last in _stretches(place[owner == item], span):
            begin, end = max(0, first - span + 1), min(len(shingles) - span, last) + 1
            for start in range(begin, end, _WINDOWS):
                stop = min(start + _WINDOWS, end)
                prints = _window_prints(shingles[start : stop + span - 1], span)
                blocks = _block_values(prints, reach) == _block_values(own[None, :], reach)
                near = np.flatnonzero(blocks.any(axis=1))
                near = near[(prints[near] != own).sum(axis=1) <= reach]
                for window in near:
                    found = _similarity(shingles[start + window : start + window + span], items.shingles[item], items.weights[item])
                    if found > best[0]:
                        best = (found, int(start + window))
        if best[0] >= similarity:
            yield int(items.numbers[item]), best[0], best[1], min(int(items.lengths[item]), span + items.words - 1)


def _finds(column: pa.Array, index: list[_Items], similarity: float, radius: int | None) -> Iterator[tuple[int, int, float, int, int]]:
    """Row, item, similarity, first word and words of every find in a column of texts."""
    data, offsets = text_buffer(column)
    for low, high in text_slices(offsets):
        words, _, bounds = word_hashes(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        for items in index:
            shingles, _, spots = shingle_hashes(words, bounds, items.words)
            hits = np.flatnonzero(items.screen[(shingles & _U64((1 << _SCREEN_BITS) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(items.known, shingles[hits]), len(items.known) - 1)
            hits = hits[items.known[at] == shingles[hits]]
            rows = np.searchsorted(spots, hits, side="right") - 1
            for row in np.unique(rows):
                own = hits[rows == row] - spots[row]
                for find in _in_text(shingles[spots[row] : spots[row + 1]], items, own, similarity, radius):
                    yield (low + int(row), *find)


def _passes(items: DataFrame, item_id: str, text_col: str, chars: int) -> Iterator[list]:
    """The items, at most about ``chars`` characters at a time."""
    items = items.select(F.col(item_id).cast("long").alias("item"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // chars))
    for part in range(parts):
        found = items.where(F.pmod(F.xxhash64("text", "item"), F.lit(parts)) == part).orderBy("item", "text").collect()
        if found:
            yield found


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    radius: int | None = None,
    chars_per_pass: int = ITEM_CHARS_PER_PASS,
) -> DataFrame:
    """One row ``id, item_id, similarity, first_word, n_words`` for each document and item that it contains.

    The window is the best one of the item's length in words (of the document's, if that is shorter); ties go to the
    first. Long texts are gone through in pieces of bounded memory, and whole. Contained means a similarity of at least ``similarity``. Items of fewer than ``words`` words count as one
    shingle. Null or empty texts contain nothing and are contained in nothing; null ids are passed on; repeated rows
    give repeated finds; empty tables give an empty result; other columns are ignored. Documents are read once for
    every ``chars_per_pass`` characters of items and never shuffled.
    """
    schema = f"`{id_col}` long, item_id long, similarity double, first_word long, n_words long"
    result = docs.sparkSession.createDataFrame([], schema)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    for part in _passes(items, item_id, text_col, chars_per_pass):
        index, ids = _index([row["text"] for row in part], words), [row["item"] for row in part]

        def run(batches: Iterator[pa.RecordBatch], index=index, ids=ids) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                finds = list(_finds(batch.column("text"), index, similarity, radius))
                taken = batch.column("id").take(pa.array([f[0] for f in finds], pa.int64()))
                columns = [taken, pa.array([ids[f[1]] for f in finds], pa.int64()), pa.array([f[2] for f in finds], pa.float64())]
                columns += [pa.array([f[n] for f in finds], pa.int64()) for n in (3, 4)]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "item_id", "similarity", "first_word", "n_words"])

        result = result.union(source.mapInArrow(run, schema))
    return result


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    radius: int | None = None,
    chars_per_pass: int = ITEM_CHARS_PER_PASS,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, as :func:`leaks` defines it, with all their columns."""
    for part in _passes(items, item_id, item_text, chars_per_pass):
        index = _index([row["text"] for row in part], words)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad = {find[0] for find in _finds(batch.column(text_col), index, similarity, radius)}
                yield batch.filter(pa.array([row not in bad for row in range(batch.num_rows)], pa.bool_())) if bad else batch

        docs = docs.mapInArrow(run, docs.schema)
    return docs
