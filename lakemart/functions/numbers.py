"""Rounding, casting and division rules shared by the models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back - on the binary value.

    ``F.round(x, n)`` rounds the decimal rendering (1.005 -> 1.01); the models round the double (1.0).
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * scale) / scale


def to_int_half_even(value: Column) -> Column:
    """Numeric to INT, ties to even (Spark's cast truncates)."""
    return F.bround(value).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient, NULL when the denominator is 0 (ANSI mode would raise)."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def exact_mean(value: Column, digits: int = 2) -> Column:
    """AVG of a column that carries at most ``digits`` decimals, summed as DECIMAL.

    A double sum depends on the order in which partitions are merged; this one does not.
    """
    total = F.sum(value.cast(f"decimal(18,{digits})")).cast("double")
    return total / F.nullif(F.count(value).cast("double"), F.lit(0.0))


def money(value: Column) -> Column:
    """An amount as an exact decimal, so that sums do not depend on the order in which rows meet."""
    return value.cast("decimal(18,4)")


def money_sum(value: Column) -> Column:
    """Sum of amounts, added up exactly, as a double."""
    return F.sum(money(value)).cast("double")
