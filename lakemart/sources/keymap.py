"""Surrogate keys that outlive a rebuild: a stored map from natural keys to dense numbers.

A key keeps the number it got first. New keys are numbered above the largest one, in the order of the key, so the numbers
of all keys ever seen are 1, 2, 3, ... without a gap. An extension sorts the new keys only and writes them to a folder of
its own; a commit adds the folder to the map. A run that dies before its commit has changed nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from lakemart.operators.ranking import global_row_number
from lakemart.sources.commits import CommitLog


class KeyMap:
    def __init__(self, spark: SparkSession, root: str, key: DataType | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = StructType([StructField("key", key or StringType()), StructField("number", LongType())])
        self.log = CommitLog(spark, f"{self.root}/_keys")

    def _state(self) -> tuple[int, list[str], int]:
        number, entry = self.log.latest()
        return (number, entry["folders"], entry["largest"]) if entry else (0, [], 0)

    def read(self) -> DataFrame:
        """``key, number`` of every key that was ever seen; NULL can be a key."""
        _, folders, _ = self._state()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{folder}" for folder in folders])

    def extend(self, keys: DataFrame) -> int:
        """Number the keys (of a one-column frame) that the map lacks; returns how many they were.

        Raises ``Conflict`` if another writer extends the map meanwhile.
        """
        commit, folders, largest = self._state()
        asked = keys.toDF("key").distinct()
        known = self.read().select(F.col("key").alias("known"), F.lit(True).alias("there"))
        fresh = asked.join(known, F.col("key").eqNullSafe(F.col("known")), "left_anti") if folders else asked
        numbered = global_row_number(fresh, "number", [F.col("key").asc_nulls_last()])
        folder = f"part-{uuid.uuid4().hex}"
        numbered.select("key", (F.col("number") + largest).alias("number")).write.parquet(f"{self.root}/{folder}")
        added = self.spark.read.schema(self.schema).parquet(f"{self.root}/{folder}").count()
        if added:
            self.log.commit(commit + 1, {"folders": [*folders, folder], "largest": largest + added})
        return added

    def numbered(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with the number of their ``key`` as ``name``; the map is extended by the keys it lacks."""
        self.extend(rows.select(key))
        known = self.read().select(F.col("key").alias("_key"), F.col("number").alias(name))
        return rows.join(known, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
