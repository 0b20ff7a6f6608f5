"""Hard negatives by exact integer inner products of packed candidates.

Vectors are turned into integers. Several candidates go into one wide integer: their components, made non-negative by a
bias, lie in separate fields, wide enough that a whole inner product cannot run over. One multiplication for each
component of the anchor then gives the products with all packed candidates at once; the fields are taken apart and
the biases' share is subtracted, which leaves the exact scores. While everything fits the 53 bits of a double's
significand, the wide integers are doubles, whose matrix product is then exact in any order; larger components are
packed into unbounded integers.

Rows are dealt out in blocks of bounded size, and each block's task takes in its rows first and then streams all anchors
past them. An anchor leaves a block with its best few rows, so what is exchanged grows with the anchors and the blocks.
The first pass finds each anchor's positives, the second the negatives within the bounds that the positives set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import apply_defaults, materialize

POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
SCALE = 256
BLOCK_ROWS = 16_384
ANCHORS_AT_ONCE = 128

_EXACT_BITS = 53
_LARGEST = 2.0**62
# Fields of one unbounded integer.
_WIDE_FIELDS = 16


class Packed:
    """Candidates packed for exact inner products; ``limit`` bounds the size of an anchor's components."""

    def __init__(self, rows: np.ndarray, limit: int):
        self.count, self.dimension = rows.shape
        self.bias = max(0, -int(rows.min(initial=0)))
        largest = (int(rows.max(initial=0)) + self.bias) * 2 * limit * max(1, self.dimension)
        self.limit, self.width = limit, max(1, largest.bit_length())
        self.fields = _EXACT_BITS // self.width or _WIDE_FIELDS
        self.kind = np.float64 if self.width <= _EXACT_BITS else object
        self.sums = rows.astype(object if self.kind is object else np.int64).sum(axis=1)
        packs = -(-self.count // self.fields)
        wide = np.zeros((packs, self.dimension), object if self.kind is object else np.int64)
        for field in range(self.fields):
            own = rows[field * packs : (field + 1) * packs].astype(wide.dtype) + self.bias
            wide[: len(own)] += own << field * self.width
        self.wide = wide.T.astype(self.kind)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner product of every anchor with every candidate."""
        exact = object if self.kind is object else np.int64
        shifted = anchors.astype(exact) + self.limit
        products = (shifted.astype(self.kind) @ self.wide).astype(exact)
        mask = (1 << self.width) - 1
        fields = [(products >> field * self.width) & mask for field in range(self.fields)]
        found = np.concatenate(fields, axis=1)[:, : self.count]
        return found - self.bias * shifted.sum(axis=1)[:, None] - self.limit * self.sums[None, :]


def _best(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``count`` highest allowed scores of each row; ties by smaller id."""
    height = scores.min(initial=0) - 1
    masked = np.where(allowed, scores, height)
    if masked.shape[1] > count:
        least = np.sort(masked, axis=1)[:, -count] if masked.dtype == object else np.partition(masked, -count, axis=1)[:, -count]
        allowed = allowed & (masked >= least[:, None])
    row, column = np.nonzero(allowed)
    falling = -np.unique(scores[row, column], return_inverse=True)[1]
    order = np.lexsort((ids[column], falling, row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < count], column[rank < count]


def _saturated(values: np.ndarray) -> pa.Array:
    """Scores as longs; one beyond the range of a long is written as its end."""
    return pa.array(np.clip(values, -(2**63), 2**63 - 1).astype(np.int64) if values.dtype == object else values)


def _matrix(vectors: pa.Array, dimension: int) -> np.ndarray:
    """Integer vectors as rows, filled up with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py() : vectors.offsets[-1].as_py()]
    found = np.zeros((len(lengths), dimension), np.int64)
    found[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return found


def _table(batches: list[pa.RecordBatch], column: str, dimension: int) -> np.ndarray:
    return np.concatenate([_matrix(b.column(column), dimension) for b in batches])


_PAIR = "anchor_id long, anchor_key long, positive_rank int, positive_id long, positive_score long, found_id long, found_score long"


def _passing(dimension: int, limit: int, positives: int, negatives: int, bounds: tuple[int, int], mining: bool):
    """Task over one partition of blocks: the rows of a block come before its anchors.

    Without ``mining``, the best rows of the anchor's label; with it, the best rows of other labels within the bounds of each
    of the anchor's positives.
    """
    lowest, highest = bounds

    def searched(anchors: list[pa.RecordBatch], rows: list[pa.RecordBatch], packed: Packed) -> Iterator[pa.RecordBatch]:
        batch = pa.Table.from_batches(anchors).combine_chunks()
        ids, labels = (np.concatenate([b.column(c).to_numpy() for b in rows]) for c in ("vec_id", "label"))
        for low in range(0, batch.num_rows, ANCHORS_AT_ONCE):
            part = batch.slice(low, ANCHORS_AT_ONCE).combine_chunks().to_batches()[0]
            scores = packed.scores(_matrix(part.column("vector"), dimension))
            anchor, key, label = (part.column(c).to_numpy() for c in ("vec_id", "key", "label"))
            alike = label[:, None] == labels[None, :]
            if not mining:
                row, column = _best(scores, alike & (anchor[:, None] != ids[None, :]), ids, positives)
                empty = pa.nulls(len(row), pa.int64())
                yield _found(anchor[row], key[row], 0, empty, empty, ids[column], _saturated(scores[row, column]))
                continue
            pairs = part.column("positives").to_pylist()
            for number in range(positives):
                has = np.array([i for i, p in enumerate(pairs) if len(p) > number], np.int64)
                if not len(has):
                    break
                ours = scores[has]
                base = np.array([pairs[i][number]["score"] for i in has], dtype=ours.dtype)
                # Whole numbers between the bounds: rounding up from below and down from above.
                within = (ours >= -(-base * lowest // 100)[:, None]) & (ours <= (base * highest // 100)[:, None])
                row, column = _best(ours, ~alike[has] & within, ids, negatives)
                positive = np.array([pairs[i][number]["id"] for i in has], np.int64)
                positive, score = pa.array(positive[row]), _saturated(base[row])
                yield _found(anchor[has][row], key[has][row], number + 1, positive, score, ids[column], _saturated(ours[row, column]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, packed = None, [], None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            kinds = batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                part = batch.slice(low, high - low)
                if not part.num_rows:
                    continue
                if blocks[low] != block:
                    block, rows, packed = blocks[low], [], None
                if kinds[low] == 0:
                    rows.append(part)
                elif rows:
                    packed = packed or Packed(_table(rows, "vector", dimension), limit)
                    yield from searched([part], rows, packed)

    return work


def _found(anchor, key, rank: int, positive, positive_score, ids, scores) -> pa.RecordBatch:
    ranks = pa.array(np.full(len(anchor), rank, np.int32))
    columns = [pa.array(anchor, pa.int64()), pa.array(key, pa.int64()), ranks, positive, positive_score, pa.array(ids, pa.int64()), scores]
    names = ["anchor_id", "anchor_key", "positive_rank", "positive_id", "positive_score", "found_id", "found_score"]
    return pa.RecordBatch.from_arrays(columns, names)


def _ranked(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("found_score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, vector, key``: components as whole numbers, equal rows once.

    Rows with a null id, label or vector, or with a null or non-finite component, are left out. A product beyond
    2 ** 62 in size counts as that.
    """
    values = F.col("embedding").cast("array<double>")
    kept = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), values.alias("_values"))
    kept = kept.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("_values").isNotNull())
    kept = kept.where(~F.exists("_values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    vector = F.transform("_values", lambda x: F.floor(F.greatest(F.least(x * float(scale), F.lit(_LARGEST)), F.lit(-_LARGEST))))
    kept = kept.select("vec_id", "label", vector.alias("vector")).distinct()
    return kept.withColumn("key", F.xxhash64("vec_id", "label", "vector"))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    bounds: tuple[int, int] = (LOWEST, HIGHEST),
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors' best positives.

    ``rows`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on ``vec_id``. Scores are exact
    inner products of the components times ``scale``, rounded down. Positives are the best rows of the anchor's label
    with another id, negatives the best of other labels whose score lies between ``bounds`` hundredths of the
    positive's; ties go to the smaller id. An anchor without positives, or a positive without such negatives, gives
    no rows.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part. A vector
    shorter than the longest counts as filled up with zeros. Equal rows count once; rows that share only their id are
    rows of their own, and each that is an anchor is searched for, but never finds its own id. Scores beyond a long
    are written as the long's end. Other columns are not read; an empty table gives no rows.
    """
    spark = apply_defaults(rows.sparkSession)
    every = materialize(quantised(rows, scale), "integers")
    sizes = every.agg(
        F.count(F.lit(1)),
        F.max(F.size("vector")),
        F.max(F.greatest(F.coalesce(F.array_max("vector"), F.lit(0)), F.coalesce(-F.array_min("vector"), F.lit(0)))),
    ).first()
    count, dimension, limit = sizes[0], max(sizes[1] or 0, 1), max(sizes[2] or 0, 1)
    blocks = max(1, -(-count // BLOCK_ROWS), min(count // 256, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    common = ["block", "kind", "vec_id", "label", "vector", "key", "positives"]
    kind = "array<struct<rank: int, id: bigint, score: bigint>>"

    def passed(anchors: DataFrame, mining: bool) -> DataFrame:
        held = every.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("kind", F.lit(0))
        held = held.withColumn("positives", F.lit(None).cast(kind)).select(common)
        dealt = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(1)).select(common)
        dealt = held.unionByName(dealt).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")
        return dealt.mapInArrow(_passing(dimension, limit, positives, negatives, bounds, mining), _PAIR)

    anchors = every.where(is_anchor)
    best = _ranked(passed(anchors.withColumn("positives", F.lit(None).cast(kind)), False), ["anchor_key"], positives)
    entry = F.struct("rank", F.col("found_id").alias("id"), F.col("found_score").alias("score"))
    best = best.groupBy("anchor_key").agg(F.sort_array(F.collect_list(entry)).alias("positives"))
    known = anchors.join(best, anchors["key"] == best["anchor_key"]).drop("anchor_key")
    known = materialize(known, "positives")
    found = _ranked(passed(known, True), ["anchor_key", "positive_rank"], negatives)
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("found_score").alias("negative_score")
    )
