"""Daily state of open intervals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import materialize

# A key with more intervals than this is summed per day before all of it meets in one task.
MANY = 100_000


def _events(intervals: DataFrame, key: str) -> DataFrame:
    """(key, day, step, amount) of intervals ``opened, closed, amount``: one event where one opens, one where it closes."""
    closing = F.date_add("closed", 1)
    worth = F.coalesce(F.col("amount").cast("decimal(20,6)"), F.lit(0).cast("decimal(20,6)"))
    event = F.explode(
        F.array(
            F.struct(F.col("opened").alias("day"), F.lit(1).alias("step"), F.col("worth").alias("amount")),
            F.struct(closing.alias("day"), F.lit(-1).alias("step"), (-F.col("worth")).alias("amount")),
        )
    )
    events = intervals.withColumn("worth", worth).select(key, event.alias("event")).where("event.day is not null")
    return events.select(key, "event.day", "event.step", "event.amount")


def _spans(events: DataFrame, key: str, last_day: Column) -> DataFrame:
    """(key, day, last, open_count, open_amount) between events that follow each other: running sums of the events.

    Of several events of a day only the last is followed by a later day, so the others give no span.
    """
    by_day = Window.partitionBy(key).orderBy("day")
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    spans = events.select(
        key,
        "day",
        F.least(F.date_sub(F.lead("day").over(by_day), 1), last_day).alias("last"),
        F.sum("step").over(upto).alias("open_count"),
        F.sum("amount").over(upto).cast("double").alias("open_amount"),
    )
    return spans.where("open_count > 0 and day <= last")


def open_per_day(
    intervals: DataFrame, key: str, start: str, end: str, amount: str, shown: Callable[[Column], Column] = lambda total: total
) -> DataFrame:
    """For each key and day with open intervals: how many are open and their total amount.

    An interval is open from ``start`` to ``end`` inclusive, or to the last start day of the whole set when ``end``
    is NULL; one that ends before it starts is never open. Columns: key, day, open_count, open_amount. ``shown`` is
    applied to the total amount, once for all days on which nothing changes.

    Never pairs intervals with days. Each interval adds one event when it opens and one when it closes, and a running
    sum gives the open set at each change. Intervals move to their key before they are events. Those of a key with very
    many are summed per (key, day) on the way, which bounds a hot key by the number of days. Amounts are summed as
    decimals so that what opens cancels exactly when it closes.
    """
    started = intervals.where(F.col(start).isNotNull()).select(
        key, F.col(start).alias("opened"), F.col(end).alias("closed"), F.col(amount).alias("amount")
    )
    # Read several times (last start day, keys with many, running sums); as a table the join below it runs once.
    started = materialize(started, "intervals")
    last_day = started.agg(F.max("opened")).scalar()
    many = started.groupBy(F.col(key).alias("many")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MANY).drop("n")

    alive = started.where("closed is null or closed >= opened")
    # One row in more than MANY at most, whatever the keys.
    is_many = F.col(key).eqNullSafe(F.col("many"))
    few = alive.join(F.broadcast(many), is_many, "left_anti").repartition(key)
    summed = _events(alive.join(F.broadcast(many), is_many, "left_semi"), key).groupBy(key, "day").agg(
        F.sum("step").alias("step"), F.sum("amount").cast("decimal(30,6)").alias("amount")
    )
    spans = _spans(_events(few, key), key, last_day).union(_spans(summed, key, last_day))
    # Before the days, not in the last projection: that one runs for each of them.
    spans = spans.withColumn("open_amount", shown(F.col("open_amount")))
    return spans.select(key, F.explode(F.sequence("day", "last")).alias("day"), "open_count", "open_amount")
