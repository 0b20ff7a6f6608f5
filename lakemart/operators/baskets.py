"""Counting values that occur together in a basket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weighted_baskets(members: DataFrame, basket: str, value: str) -> DataFrame:
    """Distinct value sets and how many baskets hold exactly that set: (items, weight).

    Sets are built with map-side partial sets, so a basket with very many lines shrinks to its distinct values
    before the shuffle, and equal baskets become one weighted row before any pair is formed.
    """
    known = members.where(F.col(basket).isNotNull() & F.col(value).isNotNull())
    sets = known.groupBy(basket).agg(F.array_sort(F.collect_set(value)).alias("items"))
    return sets.groupBy("items").agg(F.count(F.lit(1)).alias("weight"))


def value_totals(baskets: DataFrame, name: str, total: str) -> DataFrame:
    """Number of baskets that hold each value."""
    return baskets.select(F.explode("items").alias(name), "weight").groupBy(name).agg(F.sum("weight").alias(total))


def pair_totals(baskets: DataFrame, left: str, right: str, total: str) -> DataFrame:
    """Number of baskets that hold both values, for each unordered pair (left < right)."""
    firsts = baskets.where(F.size("items") > 1).select("weight", "items", F.posexplode("items").alias("at", left))
    later = F.slice("items", F.col("at") + 2, F.size("items"))
    return firsts.select(left, F.explode(later).alias(right), "weight").groupBy(left, right).agg(F.sum("weight").alias(total))
