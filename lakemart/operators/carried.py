"""Daily state of open intervals, carried from day to day instead of summed over all history again.

The same result as ``intervals.open_per_day``, kept in four tables of a day ledger:

* ``open`` - (key, open_count, open_amount) of each day: the result itself, amounts exact;
* ``balance`` - the same of the last day only: where the next day starts from;
* ``ahead`` - (key, day, step, amount) of known events after the last day, mostly ends;
* ``starts`` - (day, starts) of every day: the last one bounds intervals without an end.

A new day applies its own events and those that wait for it. A correction, intervals that come or go for days that are
done, changes these days from its first day on and nothing before. Every step is one commit, so readers see a day's
result with its corrections or without them, and a step that dies is taken again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakemart.session import materialize
from lakemart.streaming.ledger import DayLedger

TABLES = ("open", "balance", "ahead", "starts")
_AMOUNT = "decimal(30,6)"


def carried_ledger(spark: SparkSession, root: str, key: StructField) -> DayLedger:
    """The ledger of a carried result whose keys are ``key``."""

    def schema(columns: str) -> StructType:
        return StructType([key, *StructType.fromDDL(columns).fields])

    return DayLedger(spark, root, TABLES, {
        "open": schema(f"open_count bigint, open_amount {_AMOUNT}"),
        "balance": schema(f"open_count bigint, open_amount {_AMOUNT}"),
        "ahead": schema(f"day date, step bigint, amount {_AMOUNT}"),
        "starts": StructType.fromDDL("day date, starts bigint"),
    })


def _events(changes: DataFrame, key: str) -> DataFrame:
    """(key, day, step, amount, starts) of intervals ``opened, closed, worth`` that come (sign 1) or go (sign -1)."""
    alive = F.col("closed").isNull() | (F.col("closed") >= F.col("opened"))
    worth, sign = F.col("worth").cast("decimal(20,6)"), F.col("sign")
    closing = F.when(F.col("closed").isNotNull() & alive, F.date_add("closed", 1))

    def event(day: Column, step: Column, amount: Column, starts: Column) -> Column:
        return F.struct(day.alias("day"), step.alias("step"), amount.alias("amount"), starts.alias("starts"))

    opens = event(F.col("opened"), F.when(alive, sign).otherwise(0), F.when(alive, worth * sign), sign)
    closes = event(closing, F.when(closing.isNotNull(), -sign).otherwise(0), F.when(closing.isNotNull(), -worth * sign), F.lit(0))
    found = changes.select(key, F.explode(F.array(opens, closes)).alias("e")).where("e.day is not null")
    return found.groupBy(key, F.col("e.day").alias("day")).agg(
        F.sum("e.step").alias("step"), F.coalesce(F.sum("e.amount"), F.lit(0)).cast(_AMOUNT).alias("amount"), F.sum("e.starts").alias("starts")
    )


def _spread(events: DataFrame, key: str, last: Column) -> DataFrame:
    """(key, day, open_count, open_amount) of every day from a key's first event to ``last``: running sums of its events."""
    by_day = Window.partitionBy(key).orderBy("day")
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    spans = events.select(
        key, "day", F.coalesce(F.date_sub(F.lead("day").over(by_day), 1), last).alias("last"),
        F.sum("step").over(upto).alias("open_count"), F.sum("amount").over(upto).cast(_AMOUNT).alias("open_amount"),
    ).where((F.col("open_count") != 0) | (F.col("open_amount") != 0))
    return spans.where("day <= last").select(key, F.explode(F.sequence("day", "last")).alias("day"), "open_count", "open_amount")


def carry(state: DayLedger, changes: DataFrame, key: str, taken_from: dict[str, int]) -> list[str]:
    """Apply intervals that come or go; returns the days whose result is new or changed.

    ``changes`` has ``key, opened, closed, worth, sign``. ``taken_from`` says what they were read from and is kept in the
    commit. Rows of a day are those of ``open_per_day`` over all intervals applied so far, and days reach to the last day
    on which an interval starts. If corrections take away the last day's starts, ``ValueError`` asks for a new build.
    """
    spark, entries = state.spark, state.entries()
    done = max(state.days(entries), default=None)
    batch = state.pending()
    events = materialize(_events(changes, key), "events")
    starts = state.read("starts", None if done is None else [done], entries).drop("date") if done else None
    new_starts = events.groupBy("day").agg(F.sum("starts").alias("starts"))
    known = new_starts if starts is None else starts.union(new_starts).groupBy("day").agg(F.sum("starts").alias("starts"))
    last = known.where("starts > 0").agg(F.max("day")).first()[0]
    if done is not None and (last is None or str(last) < done):
        raise ValueError("the last day has lost its intervals: build the state anew")
    if last is None:
        return []
    last = str(last)

    late_from = None
    if done is None:
        first = str(events.agg(F.min("day")).first()[0])
        held = balance = None
    else:
        late_from = events.where(F.col("day") <= F.lit(done).cast("date")).agg(F.min("day")).first()[0]
        first = str(late_from) if late_from else done
        held = state.read("ahead", [done], entries).drop("date").withColumn("starts", F.lit(0).cast("long"))
        balance = state.read("balance", [done], entries).drop("date")
        events = held.unionByName(events).groupBy(key, "day").agg(*[F.sum(c).cast(k).alias(c) for c, k in (("step", "long"), ("amount", _AMOUNT))])
    if batch is None:
        span = [str(r[0]) for r in spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))).collect()]
        # The last day is written in any case: it holds the state that the next step starts from.
        batch = state.begin(span, taken_from)
    day, end = F.col("day"), F.lit(last).cast("date")

    parts = []
    fresh = events.where(day <= end)
    if done is not None:
        past = F.lit(done).cast("date")
        # Days that are done, from the first correction on: their result plus the running sum of the corrections.
        late = events.where(day <= past)
        if late_from is not None:
            old = state.read("open", batch.days, entries).withColumnRenamed("date", "day")
            both = old.unionByName(_spread(late, key, past).select(key, "open_count", "open_amount", "day"))
            parts.append(both)
        else:
            parts.append(state.read("open", [done], entries).withColumnRenamed("date", "day"))
        # New days go on from the balance, which the corrections changed as well.
        start = F.date_add(past, 1)
        moved = late.select(key, start.alias("day"), "step", "amount")
        carried = balance.select(key, start.alias("day"), F.col("open_count").alias("step"), F.col("open_amount").alias("amount"))
        fresh = carried.union(moved).union(events.where((day > past) & (day <= end)).select(key, "day", "step", "amount"))
        fresh = fresh.groupBy(key, "day").agg(F.sum("step").alias("step"), F.sum("amount").cast(_AMOUNT).alias("amount"))
    parts.append(_spread(fresh, key, end).select(key, "open_count", "open_amount", "day"))
    summed = reduce(DataFrame.unionByName, parts).groupBy(key, "day").agg(F.sum("open_count").alias("open_count"), F.sum("open_amount").cast(_AMOUNT).alias("open_amount"))
    result = batch.store("open", summed.where("open_count > 0").select(key, "open_count", "open_amount", day.alias("date")))

    batch.store("balance", result.where(F.col("date") == end))
    batch.store("ahead", events.where(day > end).where("step <> 0 or amount <> 0").select(key, "day", "step", "amount", end.alias("date")))
    batch.store("starts", known.where("starts <> 0").select("day", "starts", end.alias("date")))
    batch.commit()
    return batch.days
