"""Monthly sets of active persons and sold products, kept as bitmaps and carried over the days of a ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.functions.dates import month_start, months_crossed
from lakemart.functions.numbers import ratio, round_half_away
from lakemart.lake import Lake
from lakemart.operators.bitmaps import bitmaps, counted, shared, united
from lakemart.plans.facts import DELIVERED
from lakemart.session import materialize
from lakemart.sources.keymap import KeyMap
from lakemart.streaming.ledger import DayLedger

_SETS = "what string, bucket bigint, bits binary"


def key_maps(spark: SparkSession, root: str) -> dict[str, KeyMap]:
    """The stored numbers of persons and products, below one folder."""
    return {what: KeyMap(spark, f"{root}/{what}") for what in ("persons", "products")}


def month_members(lake: Lake, *parts: Column) -> DataFrame:
    """``what, month, key``, without repeats: the persons with delivered orders and the products sold in them, by month.

    ``parts`` are columns of the orders that tell deliveries apart; a member is listed for each of them.
    """
    orders = lake.model("fact_orders").where(F.col("order_status") == DELIVERED).select("*", *parts)
    extra = orders.columns[len(lake.model("fact_orders").columns) :]
    orders = orders.select("order_id", "customer_id", month_start(F.col("date_key")).alias("month"), *extra)
    persons = orders.join(lake.model("stg_customers").select("customer_id", F.col("customer_unique_id").alias("key")), "customer_id")
    products = orders.join(lake.model("fact_order_items").select("order_id", F.col("product_id").alias("key")), "order_id")
    found = [
        rows.where("key is not null").select(F.lit(what).alias("what"), "month", "key", *extra).distinct()
        for what, rows in (("persons", persons), ("products", products))
    ]
    return found[0].unionByName(found[1])


def sets_of(members: DataFrame, keys: dict[str, KeyMap]) -> DataFrame:
    """``month, what, bucket, bits`` of ``what, month, key``, which is read twice for each ``what``."""
    found = []
    for what, numbers in keys.items():
        own = members.where(F.col("what") == what).select("what", "month", "key")
        found.append(bitmaps(numbers.numbered(own, "key", "number"), ["month", "what"], "number"))
    return reduce(DataFrame.unionByName, found)


def month_sets(lake: Lake, keys: dict[str, KeyMap]) -> DataFrame:
    """``month, what, bucket, bits``: the persons with delivered orders and the products sold in them, by month.

    The members are written once: orders and lines are joined once for the new keys and for all numbers.
    """
    return sets_of(materialize(month_members(lake), "members"), keys)


def month_state(spark: SparkSession, root: str) -> DayLedger:
    """A ledger with one entry for each month, under its first day."""
    return DayLedger(spark, root, ["sets"], {"sets": StructType.fromDDL(_SETS)})


def carry_months(days: DayLedger, state: DayLedger, keys: dict[str, KeyMap]) -> list[str]:
    """Bring the months up to the ledger's days; returns the months that are new or changed.

    A month that only got new days unites its set with theirs. One of whose days a part was taken again is made anew from
    its days, as a set does not know which day a member came from. Other months are not touched.
    """
    pending, before, entries = state.pending(), state.taken(), days.entries()
    now = days.days(entries)
    changed = pending.taken_from if pending else {d: n for d, n in now.items() if before.get(d) != n}
    if not changed:
        return []
    months = sorted({f"{day[:7]}-01" for day in changed})
    anew = {f"{day[:7]}" for day in changed if day in before}
    versions = changed | {d: before[d] for d in before if d[:7] in anew and d not in changed}
    batch = pending or state.begin(months, changed)
    sets = month_sets(Lake(days.spark, lambda table: days.read_versions(table, versions, entries)), keys).withColumnRenamed("month", "date")
    grown = [m for m in months if m[:7] not in anew and m in state.days()]
    sets = united(sets.unionByName(state.read("sets", grown)), ["date", "what"]) if grown else sets
    batch.store("sets", sets.select("what", "bucket", "bits", "date"))
    batch.commit()
    return months


def monthly_counts(sets: DataFrame, what: str, name: str) -> DataFrame:
    """``month, name`` of ``month, what, bucket, bits``."""
    return counted(sets.where(F.col("what") == what), ["month"], name)


def retention(sets: DataFrame) -> DataFrame:
    """The model ``rpt_cohort_retention`` from the months' sets alone.

    The persons of cohort c active in month m are those of m who were active in c or before, less those who were active
    before c. Sets up to a month are unions; no person is looked at.
    """
    active = sets.where(F.col("what") == "persons").select("month", "bucket", "bits")
    ends = {"first_month": active.agg(F.min("month")).scalar(), "last_month": active.agg(F.max("month")).scalar()}
    spans = active.withColumns(ends)
    up_to = spans.select(F.explode(F.expr("sequence(month, last_month, interval 1 month)")).alias("cohort_month"), "bucket", "bits", "last_month")
    up_to = up_to.groupBy("cohort_month", "bucket", "last_month").agg(F.bitmap_or_agg("bits").alias("bits"))
    earlier = up_to.select("cohort_month", F.explode(F.expr("sequence(cohort_month, last_month, interval 1 month)")).alias("month"), "bucket", "bits")
    now = spans.select(F.explode(F.expr("sequence(first_month, month, interval 1 month)")).alias("cohort_month"), "month", "bucket", "bits")
    both = shared(earlier, now, ["cohort_month", "month"], "known")
    by_cohort = Window.partitionBy("month").orderBy("cohort_month")
    counts = both.withColumn("active_customers", F.col("known") - F.coalesce(F.lag("known").over(by_cohort), F.lit(0))).where("active_customers > 0")
    counts = counts.withColumn("months_since_first", months_crossed(F.col("cohort_month"), F.col("month")))
    at_start = F.when(F.col("months_since_first") == 0, F.col("active_customers"))
    counts = counts.withColumn("cohort_customers", F.max(at_start).over(Window.partitionBy("cohort_month")))
    return counts.select(
        "cohort_month", "months_since_first", "cohort_customers", "active_customers",
        round_half_away(ratio(F.col("active_customers") * 100, F.col("cohort_customers")), 2).alias("retention_pct"),
    )
