"""Exact distinct counts that merge: sets of dense numbers as bitmaps.

A bitmap row holds one group's members among 32,768 consecutive numbers, in at most 4 KB. Sets are merged by combining
rows, in any order and as often as one likes, and counted without looking at their members again; a distinct count over
many periods needs the periods' bitmaps, not their rows. Numbers begin at 1 (see ``sources.keymap``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, groups: Sequence[str], number: str) -> DataFrame:
    """``groups, bucket, bits``: the set of numbers of each group; NULL numbers are in no set."""
    known = rows.where(F.col(number).isNotNull())
    keyed = known.select(*groups, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("position"))
    return keyed.groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("position").alias("bits"))


def united(sets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The union of all sets of a group, e.g. after a column was dropped or two frames were put together."""
    return sets.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(sets: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """``groups, name``: how many numbers each group's set holds; sets that are not united yet are united first."""
    return united(sets, groups).groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(name))


def shared(left: DataFrame, right: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """``groups, name``: how many numbers the sets of both frames have in common, where they have any."""
    both = united(left, groups).unionByName(united(right, groups)).groupBy(*groups, "bucket")
    both = both.agg(F.count(F.lit(1)).alias("sides"), F.bitmap_and_agg("bits").alias("bits")).where("sides = 2")
    return both.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(name)).where(F.col(name) > 0)
