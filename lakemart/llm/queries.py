"""The registered queries of this package and, where SQL can express them, the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import decontaminate, hard_negatives, html, language, licenses, near_dedup, neighbours, pieces, pii, prefix_trie, simhash
from lakemart.llm import sql, toxicity, urls


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: ``doc_id``, counts by kind, ``base_sha256``, ``spans``."""
    return pii.digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentation of every document: ``doc_id, piece_ids, n_pieces, lossless``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pieces.encode(docs).drop("text")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page: ``page_id, url, text, n_chars``."""
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: ``page_id, host, path, rule, verdict, score``."""
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License templates that documents hold: ``doc_id, license, containment, first_word``."""
    return licenses.find_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document: ``doc_id, held_out, score, predicted``."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return toxicity.judged(docs, labels)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: ``doc_id, held_out, lang_pred, score``."""
    return language.identified(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every twentieth vector: ``query_id, rank, vec_id, score``."""
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain: ``doc_id, item_id, similarity, first_word, n_words``."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return decontaminate.leaks(docs, items)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document: ``doc_id, class_id, n_copies``."""
    return near_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint class of every document: ``doc_id, fingerprint, component_id``."""
    found = simhash.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: ``conv_id, depth, parent_conv_id``, counts, ``ends_sha256``."""
    return prefix_trie.trie(*prefix_trie.regrafted(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector: ``anchor_id, positive_id, rank, negative_id`` and the two scores."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_pieces": op2_pieces,
    "op3_html": op3_html,
    "op4_urls": op4_urls,
    "op6_licenses": op6_licenses,
    "op5_toxicity": op5_toxicity,
    "op7_language": op7_language,
    "op10_neighbours": op10_neighbours,
    "op8_decontamination": op8_decontamination,
    "op9_near_dedup": op9_near_dedup,
    "op11_simhash": op11_simhash,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL: dict[str, str] = {
    "op1_pii": sql.PII,
    "op6_licenses": sql.LICENSES,
    "op12_prefix_trie": sql.PREFIX_TRIE,
    "op13_hard_negatives": sql.HARD_NEGATIVES,
}
