"""Key de-duplication and joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def first_per_key(df: DataFrame, key: str | Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``tie_break``, NULLs last.

    Written as ``row_number() = 1`` so that the optimizer adds a group limit *before* the shuffle: each map task
    sends one row per key, and a key with a third of all rows costs the reducer one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in tie_break])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def mark_first(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Adds ``name``: true for exactly one row of each combination of ``keys``, NULLs being equal.

    Counting the marks gives a distinct count next to other sums without a hash table of all combinations, which, where
    almost every row is one of its own, holds the sums of as many groups as there are rows, twice. Rows are sorted instead.
    """
    same = Window.partitionBy(*keys).orderBy(keys[0])
    return df.withColumn(name, F.lag(F.lit(1)).over(same).isNull())


def _rederived(df: DataFrame, key: str) -> DataFrame:
    """Same rows and key values, but the planner no longer sees that they are partitioned by the key."""
    column = F.col(key)
    same = F.concat(column, F.lit("")) if isinstance(df.schema[key].dataType, StringType) else column.bitwiseXOR(F.lit(0))
    return df.withColumn(key, same)


def join_to_grouped(many: DataFrame, grouped: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join fact rows to a frame that is already partitioned by the same (text or integer) key, e.g. an aggregate on it.

    The adaptive skew rule only splits a join whose inputs are both exchanges added for that join. An aggregate or
    window on the key leaves its output partitioned, so Spark adds none and a hot key would stay in one task.
    Re-deriving the key hides that partitioning: the smaller, grouped side is exchanged once more and a hot key of
    the fact side is split over many tasks. Costs nothing when the grouped side is small enough to broadcast.
    """
    return many.join(_rederived(grouped, key), key, how)
