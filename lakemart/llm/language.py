"""Language of a text by sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the lower-cased whole text fall into hashed buckets. Document frequencies come from all
training texts. Weights are learned by follow-the-regularised-leader with L1 and L2 penalties on a bounded sample,
one text at a time; a part of the sample that takes no part in this sets the temperature of the probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.toxicity import fold
from lakemart.session import materialize

BUCKETS = 1 << 14
ORDERS = 3
SAMPLE_TEXTS = 4000
EPOCHS = 3
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages, mostly zero
    bias: np.ndarray
    temperature: float


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur, ascending, and how often."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    total = np.zeros(BUCKETS, np.int64)
    with np.errstate(over="ignore"):
        gram = np.zeros(len(codes), np.uint64)
        for order in range(min(ORDERS, len(codes))):
            gram = (gram[: len(codes) - order] + codes[order:] + np.uint64(order + 1)) * _MULTIPLIER
            gram ^= gram >> np.uint64(29)
            total += np.bincount((gram * _MULTIPLIER >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def _features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and TF-IDF values of unit length."""
    found, counts = _counts(text)
    values = np.sqrt(counts) * idf[found]
    return found, values / max(np.sqrt((values**2).sum()), 1e-12)


def _document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts and, for each bucket, of texts that have it; one small table leaves each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total[_counts(text)[0]] += 1
                rows += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, used]), pa.array(np.r_[rows, total[used]])], ["bucket", "n"])

    summed = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out, rows = np.zeros(BUCKETS, np.int64), 0
    for row in summed:
        if row["bucket"] < 0:
            rows = row["n"]
        else:
            out[row["bucket"]] = row["n"]
    return rows, out


def _probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], languages: int, epochs: int = EPOCHS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.001, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from (buckets, values, language) examples by FTRL-proximal steps."""
    z, n = np.zeros((BUCKETS + 1, languages)), np.zeros((BUCKETS + 1, languages))

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        return np.where(np.abs(own) > l1, -(own - np.sign(own) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for number in order.permutation(len(examples)):
            found, values, language = examples[number]
            at, x = np.r_[found, BUCKETS], np.r_[values, 1.0]
            w = weights(at)
            p = _probabilities(x @ w)
            p[language] -= 1
            grad = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + grad**2) - np.sqrt(n[at])) / alpha
            z[at] += grad - sigma * w
            n[at] += grad**2
    all_ = weights(np.arange(BUCKETS + 1))
    return all_[:-1], all_[-1]


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of the smallest log loss, by golden-section search on its logarithm."""
    if not len(truth):
        return 1.0

    def loss(log_t: float) -> float:
        return -np.log(_probabilities(logits / np.exp(log_t))[np.arange(len(truth)), truth] + 1e-12).mean()

    low, high, golden = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(texts: DataFrame, sample: int = SAMPLE_TEXTS) -> LanguageModel | None:
    """A model from ``text, lang`` rows without nulls; None without a row.

    ``sample`` bounds the texts learned from: each language gives an equal number of different texts, those with the
    smallest hashes. Copies count once, so no text weighs more than another and no language is without an example.
    """
    rows, frequency = _document_frequencies(texts.select("text"))
    if not rows:
        return None
    idf = np.log((1 + rows) / (1 + frequency)) + 1
    hashed = texts.withColumn("hash", F.xxhash64("text"))
    pairs = materialize(hashed.select("lang", "hash").distinct(), "language_hashes")
    each = max(1, sample // pairs.select("lang").distinct().count())
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("hash", F.lit(9)), "hash")
    taken = materialize(pairs.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= each).drop("rank"), "language_sample")
    chosen = hashed.join(F.broadcast(taken), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_features(t, idf) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array([f.astype("<u2").tobytes() for f, _ in made], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())],
                ["lang", "found", "values"],
            )

    got = chosen.select("lang", "text").mapInArrow(run, "lang string, found binary, values binary").orderBy("lang", "found", "values").collect()
    languages = sorted({row["lang"] for row in got})
    number = {name: i for i, name in enumerate(languages)}
    examples = [(np.frombuffer(r["found"], "<u2").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float), number[r["lang"]]) for r in got]
    # Every fifth example of a language sets the temperature; the others, at least one of each language, the weights.
    place = np.arange(len(examples)) - np.searchsorted([e[2] for e in examples], [e[2] for e in examples])
    held, learned = ([e for e, p in zip(examples, place, strict=True) if bool(p % 5 == 4) is last] for last in (True, False))
    weights, bias = fit_ftrl(learned, len(languages))
    logits = np.array([v @ weights[f] + bias for f, v, _ in held]).reshape(-1, len(languages))
    return LanguageModel(languages, idf, weights, bias, _temperature(logits, np.array([t for _, _, t in held], int)))


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` for every row from its whole text.

    ``score`` is the calibrated probability of the predicted language, ties go to the first by name. Null texts, texts
    without a letter and all texts without a model are "und" with score 0. Null ids are passed on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text").to_pylist():
                if model is None or text is None or not _LETTER.search(text):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                found, values = _features(text, model.idf)
                p = _probabilities((values @ model.weights[found] + model.bias) / model.temperature)
                names.append(model.languages[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"`{id_col}` long, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; learned from documents with a language whose fold of five is not 0."""
    train = docs.where((fold(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return predict(docs, fit(train)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
