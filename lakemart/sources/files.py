"""Readers and writers of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakemart.sources.releases import Releases
from lakemart.sources.schemas import FREE_TEXT_TABLES, SCHEMAS


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Headed CSV; a cell that does not parse becomes NULL.

    ``multi_line`` allows line breaks inside quotes. Spark cannot split such a file, so each is read by one task: use
    it for tables that need it, delivered as many files.
    """
    reader = spark.read.schema(schema).options(header=True, mode="PERMISSIVE", escape='"')
    return reader.option("multiLine", multi_line).csv(path)


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    return read_csv(spark, path, SCHEMAS[table], multi_line=table in FREE_TEXT_TABLES)


def read_zone(spark: SparkSession, root: str, table: str, schema: StructType | None = None) -> DataFrame:
    """A date-partitioned bronze or silver table; only ``*.parquet`` files count."""
    declared = StructType(list((schema or SCHEMAS[table]).fields)).add("date", "date")
    return spark.read.schema(declared).option("pathGlobFilter", "*.parquet").parquet(f"{root}/{table}")


def write_days(df: DataFrame, root: str, table: str, rebalance: bool = True) -> None:
    """Replace exactly the ``date`` partitions present in ``df``; other days stay as they are.

    Rebalancing groups rows by day and lets adaptive execution split a large day into several files and pack small
    days together, so neither a hot day nor thousands of tiny ones decide the task count. Rows that come straight
    from per-day files are already grouped and need no shuffle.
    """
    sized = df.hint("rebalance", "date") if rebalance else df
    sized.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{root}/{table}")


def write_model(df: DataFrame, gold: str, model: str) -> None:
    """Replace one model of gold; readers see the old version until the new one is whole."""
    releases = Releases(df.sparkSession, gold)
    releases.release({model: releases.stage(df, model)})


def read_model(spark: SparkSession, gold: str, model: str) -> DataFrame:
    """A model as the newest release has it."""
    releases = Releases(spark, gold)
    return releases.read(releases.current()[1][model])
