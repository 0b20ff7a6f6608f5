"""Toxicity scores from non-negative positive-unlabelled learning.

Features are the presence of words and of word beginnings. Those that set confirmed toxic texts apart from unlabelled
ones are chosen by a likelihood-ratio test on a bounded sample; a linear model on them minimises the non-negative
risk estimate: prior * loss on positives as positive + max(0, loss on unlabelled as negative - prior * loss on
positives as negative). Where that difference falls below zero, the step undoes the overfitting instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.words import mix64, seeded, text_buffer, text_shingles, text_slices, word_hashes, word_prefixes
from lakemart.session import materialize

MAX_POSITIVE = 4000
MAX_UNLABELLED = 12000
MAX_FEATURES = 2048
# Bytes of the word beginnings used as features, besides the whole word.
BEGINNINGS = (4, 5, 6, 7, 8)
LEAST_GAIN = 30.0
LEAST_LIFT = 2.5
# A feature counts as so many inputs: that often at least, then at least once in so many words.
OFTEN = (1, 2, 4)
DENSE = (400, 150, 60)
LEVELS = len(OFTEN) + len(DENSE)
THRESHOLD = 0.7

_U64 = np.uint64
_SCREEN_BITS = 20


@dataclass
class ToxicityModel:
    """Sorted feature hashes, their weights (``LEVELS`` for each) and a bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def screen(self) -> np.ndarray:
        bits = np.zeros(1 << _SCREEN_BITS, bool)
        bits[(self.features & _U64((1 << _SCREEN_BITS) - 1)).astype(np.int64)] = True
        return bits


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature hash and text of every word, then of every word beginning."""
    words, first, bounds = word_hashes(data, offsets)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    yield words, rows
    for size in BEGINNINGS:
        hashes, long_enough = word_prefixes(data, offsets, first, size)
        yield mix64(hashes ^ seeded(31 + size, 1)[0]), rows[long_enough]


def _present(data: np.ndarray, offsets: np.ndarray, model: ToxicityModel, screen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and input number of every input that is on, ordered by text: how often and how densely a feature occurs."""
    rows, numbers, n_words = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], None
    for hashes, row in _features(data, offsets) if len(model.features) else ():
        if n_words is None:
            n_words = np.bincount(row, minlength=len(offsets) - 1)
        hit = np.flatnonzero(screen[(hashes & _U64((1 << _SCREEN_BITS) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(model.features, hashes[hit]), len(model.features) - 1)
        same = model.features[at] == hashes[hit]
        rows.append(row[hit[same]])
        numbers.append(at[same])
    width = max(1, len(model.features))
    pairs, counts = np.unique(np.concatenate(rows) * width + np.concatenate(numbers), return_counts=True)
    row, number = pairs // width, pairs % width
    on = [counts >= often for often in OFTEN] + [counts * dense >= n_words[row] for dense in DENSE] if len(row) else [counts > 0] * LEVELS
    text = np.concatenate([row[level] for level in on])
    order = np.argsort(text, kind="stable")
    return text[order], np.concatenate([number[level] * LEVELS + k for k, level in enumerate(on)])[order]


def _distinct_texts(sample: DataFrame) -> DataFrame:
    """One text of each group of near copies in ``positive, text``, so that copies don't count as evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [int(h.min().view(np.int64)) if len(h) else 0 for _, h in text_shingles(batch.column("text"), 5)]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), batch.column("text"), pa.array(least, pa.int64())], ["positive", "text", "least"])

    marked = sample.mapInArrow(run, "positive boolean, text string, least long")
    # The smallest text of a group, not whichever comes first: the model must not depend on how rows are partitioned.
    return marked.groupBy("positive", "least").agg(F.min("text").alias("text"))


def _counted(sample: DataFrame) -> DataFrame:
    """``feature, in_positive, in_other``: number of texts that have the feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            positive = np.asarray(batch.column("positive").to_numpy(zero_copy_only=False), bool)
            for low, high in text_slices(offsets):
                part, bounds = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                found = [np.unique(np.stack([h, row.astype(_U64)]), axis=1) for h, row in _features(part, bounds)]
                both = np.concatenate(found, axis=1)
                of = positive[low + both[1].astype(np.int64)]
                names, code = np.unique(both[0], return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(np.bincount(code, of).astype(np.int64)), pa.array(np.bincount(code, ~of).astype(np.int64))],
                    ["feature", "in_positive", "in_other"],
                )

    counts = sample.mapInArrow(run, "feature long, in_positive long, in_other long")
    return counts.groupBy("feature").agg(F.sum("in_positive").alias("in_positive"), F.sum("in_other").alias("in_other"))


def _gain(p: Column, u: Column, n_p: int, n_u: int) -> Column:
    """Likelihood-ratio statistic of the difference between the two rates."""
    rate = (p + u) / (n_p + n_u)

    def part(count: Column, n: int) -> Column:
        rest = n - count
        return F.when(count > 0, count * F.log(count / (n * rate))).otherwise(0.0) + F.when(rest > 0, rest * F.log(rest / (n * (1 - rate)))).otherwise(0.0)

    return F.when(rate < 1, 2 * (part(p, n_p) + part(u, n_u))).otherwise(0.0)


def fit_nnpu(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, n_features: int, prior: float, steps: int = 1500, rate: float = 0.05, penalty: float = 2e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on presence features.

    ``rows, columns`` list the present features of the sample's texts; ``positive`` marks the confirmed ones.
    """
    n = len(positive)
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)

    def gradient(of: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(columns, of[rows], n_features), of.sum()]

    for step in range(1, steps + 1):
        z = np.bincount(rows, theta[columns], n) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss = np.logaddexp(0, z)  # as negative
        slack = loss[~positive].sum() / n_u - prior * loss[positive].sum() / n_p
        negative = np.where(positive, -prior * p / n_p, p / n_u)
        if slack < 0:
            grad = -gradient(negative)
        else:
            grad = gradient(negative + np.where(positive, prior * (p - 1) / n_p, 0.0))
        grad[:-1] += penalty * theta[:-1]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(positives: DataFrame, unlabelled: DataFrame, prior: float, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES) -> ToxicityModel:
    """A model from two tables with a ``text`` column, each sampled to the given number of texts by a hash of the text.

    Equal texts count once, so a table never gives more than the bound, and none only if it has no row.

    Without positives or unlabelled rows the model has no feature and scores the prior.
    """

    def sampled(table: DataFrame, bound: int, positive: bool) -> DataFrame:
        table = table.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
        chosen = materialize(table.select("hash").distinct().orderBy(F.xxhash64("hash", F.lit(3)), "hash").limit(bound), "toxicity_hashes")
        table = table.join(F.broadcast(chosen), "hash").groupBy("hash").agg(F.min("text").alias("text"))
        return table.select(F.lit(positive).alias("positive"), "text")

    sample = sampled(positives, max_positive, True).union(sampled(unlabelled, max_unlabelled, False))
    sample = materialize(_distinct_texts(sample).select("positive", "text"), "toxicity_sample")
    sizes = {row["positive"]: row["count"] for row in sample.groupBy("positive").count().collect()}
    prior = min(max(prior, 1e-4), 0.9)
    if not sizes.get(True) or not sizes.get(False):
        return ToxicityModel(np.zeros(0, _U64), np.zeros(0), float(np.log(prior / (1 - prior))))
    n_p, n_u = sizes[True], sizes[False]
    gain = _gain(F.col("in_positive"), F.col("in_other"), n_p, n_u)
    lift = (F.col("in_positive") / n_p) / ((F.col("in_other") + 1) / n_u)
    chosen = _counted(sample).where(lift >= LEAST_LIFT).withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN)
    chosen = chosen.orderBy(F.desc("gain"), "feature").limit(max_features).select("feature").collect()
    features = np.sort(np.array([row["feature"] for row in chosen], np.int64).view(_U64))
    model = ToxicityModel(features, np.zeros(len(features) * LEVELS), 0.0)
    screen = model.screen()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers = _present(*text_buffer(batch.column("text")), model, screen)
            lists = np.split(numbers, np.searchsorted(rows, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))], ["positive", "present"])

    found = sample.mapInArrow(run, "positive boolean, present array<int>").orderBy("positive", "present").toPandas()
    sizes = found["present"].map(len).to_numpy()
    columns = np.concatenate([np.asarray(x, np.int64) for x in found["present"]])
    weights, bias = fit_nnpu(np.repeat(np.arange(len(found)), sizes), columns, found["positive"].to_numpy(bool), len(features) * LEVELS, prior)
    return ToxicityModel(features, weights, bias)


def _scores(column: pa.Array, model: ToxicityModel, screen: np.ndarray) -> np.ndarray:
    data, offsets = text_buffer(column)
    z = np.full(len(column), model.bias)
    for low, high in text_slices(offsets):
        rows, numbers = _present(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], model, screen)
        z[low:high] += np.bincount(rows, model.weights[numbers], high - low)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` for every row, over the whole text; null and empty texts get the score of a text without features."""
    screen = model.screen()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(_scores(batch.column("text"), model, screen))], [id_col, "score"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"`{id_col}` long, score double")


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    screen = model.screen()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(text_col), model, screen) < threshold))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def fit_on_labels(docs: DataFrame, labels: DataFrame, **bounds: int) -> ToxicityModel:
    """The model of documents whose fold of three is not 1: positives are those labelled toxic, all are unlabelled.

    The prior is the toxic share of the labelled ones. Null labels and null ids don't take part, repeated ones count
    once; a document counts as toxic if any of its labels says so.
    """
    train = docs.where(fold(F.col("doc_id"), 3) != 1).select("doc_id", "text")
    known = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), 3) != 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known, "toxicity_labels")
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    toxic = known.where("toxic = 1").select("doc_id")
    bound = bounds.get("max_positive", MAX_POSITIVE)
    toxic = toxic.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(2 * bound)  # twice the bound, as texts may be equal
    return fit(train.join(F.broadcast(toxic), "doc_id").select("text"), train.select("text"), prior, **bounds)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; a null id is not held out."""
    found = score(docs, fit_on_labels(docs, labels))
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
