"""A training corpus from raw documents: five stages, each over all rows that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import decontaminate, near_dedup, pieces, pii, toxicity
from lakemart.session import BATCH_BYTES, apply_defaults, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit_on_labels(docs, labels))


def one_per_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dedup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind."""
    return pii.mask(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids, and whether decoding them gives the very text."""
    return pieces.encode(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """Texts go to Python tasks in batches of bounded bytes: an executor runs all stages and keeps what the largest took."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(apply_defaults(spark, BATCH_BYTES), docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _in_small_batches(drop_toxic)),
    ("near_dedup", _in_small_batches(one_per_class)),
    ("decontamination", _in_small_batches(drop_leaks)),
    ("pii", _in_small_batches(mask_personal_data)),
    ("pieces", _in_small_batches(encode_pieces)),
]

# Learned scores, hashed signatures and sampled segmentations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every other stage's result is written once to the shared scratch area."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
