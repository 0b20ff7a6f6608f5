"""Cutting the nine source tables by order day, for one day or for a whole history in one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.sources.files import read_zone, write_days
from lakemart.sources.schemas import REFERENCE_TABLES


# Tables that hang on others: (table, parent, key).
HOPS = (
    ("order_items", "orders", "order_id"),
    ("order_payments", "orders", "order_id"),
    ("order_reviews", "orders", "order_id"),
    ("customers", "orders", "customer_id"),
    ("sellers", "order_items", "seller_id"),
    ("products", "order_items", "product_id"),
)


def order_day(orders: DataFrame) -> Column:
    """First ten characters of the purchase stamp; works on text and on timestamps. No date gives NULL."""
    return F.try_to_date(F.substring(orders["order_purchase_timestamp"].cast("string"), 1, 10))


def orders_between(orders: DataFrame, first: str, last: str) -> DataFrame:
    """Orders of the days ``first`` to ``last`` inclusive, with their ``date``; stamps that are no date are in no day."""
    dated = orders.withColumn("date", order_day(orders))
    return dated.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def orders_on(orders: DataFrame, day: str) -> DataFrame:
    return orders_between(orders, day, day)


def children(table: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows of ``table`` whose key occurs in ``parents``, once per day on which it occurs."""
    return table.join(parents.select(key, "date").distinct(), key)


def _as_is(_table: str, rows: DataFrame) -> DataFrame:
    return rows


def slice_days(
    source: Callable[[str], DataFrame], first: str, last: str, keep: Callable[[str, DataFrame], DataFrame] = _as_is
) -> dict[str, DataFrame]:
    """All nine tables for a range of days, each with a ``date`` column.

    One shuffle per table serves every day at once; a day without orders yields no rows anywhere. Sellers and
    products follow the items of the day. The two reference tables carry the first day only: a copy per day would
    multiply them by the number of days, and no model gains from equal copies. ``keep`` may store a slice and give
    back the stored form, on which the dependent slices then build.
    """
    slices = {"orders": keep("orders", orders_between(source("orders"), first, last))}
    for table, parent, key in HOPS:
        slices[table] = keep(table, children(source(table), slices[parent], key))
    for table in REFERENCE_TABLES:
        slices[table] = keep(table, source(table).withColumn("date", F.lit(first).cast("date")))
    return slices


def backfill(source: Callable[[str], DataFrame], first: str, last: str, root: str) -> dict[str, DataFrame]:
    """Write a range of days of every table under ``root/<table>/date=<day>``; running it again replaces them.

    Orders and items are needed by several tables; they are read back from the files just written instead of being
    cut from the raw data again.
    """

    def store(table: str, rows: DataFrame) -> DataFrame:
        write_days(rows, root, table)
        schema = StructType([f for f in rows.schema.fields if f.name != "date"])
        days = F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        return read_zone(rows.sparkSession, root, table, schema).where(days)

    return slice_days(source, first, last, store)
