"""Bounded results for reports: top-k, repeatable samples, histograms, pivots, column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, by: str, tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` largest by ``by``; runs as a per-partition top-n merged once, never a full sort."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(n)


def repeatable_sample(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """``n`` rows in the order of a seeded hash of ``key``; equal hashes fall back to the other columns.

    The same rows come back however the input is partitioned, which ``sample(seed=...)`` does not promise.
    """
    mix = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    rest = [F.col(c).asc_nulls_last() for c in df.columns]
    return df.withColumn("_mix", mix).orderBy("_mix", *rest).limit(n).drop("_mix")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value: (bin 1..bins, rows). Empty bins are left out."""
    limits = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    known = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_v"), lo.alias("_lo"), hi.alias("_hi"))
    share = F.try_divide(F.lit(float(bins)) * (F.col("_v") - F.col("_lo")), F.col("_hi") - F.col("_lo"))
    number = F.least(F.floor(F.coalesce(share, F.lit(0.0))) + 1, F.lit(bins)).cast("bigint")
    return known.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


def value_counts(df: DataFrame, column: str, name: str, count: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.col(count).desc(), name)


def profile(df: DataFrame) -> DataFrame:
    """Per column: declared type, non-NULL count, distinct non-NULL count, plus the shape of the table.

    The columns are unpivoted to (name, value) rows, so one grouped distinct covers them all.
    """
    width = len(df.columns)
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    long = as_text.unpivot([], df.columns, "column_name", "value")
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    return long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("table_rows"),
        F.count("value").alias("non_null"),
        F.countDistinct("value").alias("distinct_values"),
    ).select(
        "column_name",
        types[F.col("column_name")].alias("column_type"),
        "table_rows",
        F.lit(width).cast("bigint").alias("table_columns"),
        "non_null",
        "distinct_values",
    )
