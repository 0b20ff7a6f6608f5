"""Whether the models that join lines to orders have rows, read from one join.

All of them are inner joins, groupings and left joins on the way from lines and orders to the model, so a model has rows
exactly if some line, some order or some pair of both has the marks that the joins ask for. Lines are reduced to one row
of marks per order before they move, however many lines an order has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.keys import join_to_grouped
from lakemart.plans.facts import BACKLOG_STATUSES, DELIVERED, backlog_days

# Marks of a line or, after the exchange, of the lines and of the orders that share an order_id.
EVIDENCE = {
    "fact_shipping_network": "placed and spotted",
    "snapshot_daily_seller_backlog": "open and lines",
    "obt_sales_analytics": "bought and offered",
    "rpt_customer_rfm": "sold and lines",
    "rpt_seller_performance": "has_seller",
    "rpt_product_category_analysis": "has_product",
    "rpt_shipping_efficiency": "placed and spotted and delivered",
    "rpt_cohort_retention": "sold_on_a_day",
    "rpt_revenue_trends": "delivered and lines",
    "rpt_customer_ltv": "sold and lines",
}


def _any(**marks: Column) -> list[Column]:
    return [F.bool_or(F.coalesce(mark, F.lit(False))).alias(name) for name, mark in marks.items()]


def _spots(lake, name: str) -> DataFrame:
    zips = lake.model("stg_geolocation").select(F.col("geolocation_zip_code_prefix").alias("zip")).where("zip is not null").distinct()
    return zips.withColumn(name, F.lit(True))


def _order_marks(lake) -> DataFrame:
    """One row per order_id: whether any of its rows has a buyer, a buyer with coordinates, is delivered, and so on."""
    opened, closed = backlog_days()
    bought_on = F.col("order_purchase_timestamp").isNotNull()
    orders = lake.model("stg_orders").select(
        "order_id", "customer_id", (F.col("order_status") == DELIVERED).alias("delivered"), bought_on.alias("dated"),
        (F.col("order_status").isin(*BACKLOG_STATUSES) & (closed.isNull() | (closed >= opened))).alias("open"),
    )
    buyers = lake.model("stg_customers").where("customer_id is not null")
    buyers = buyers.select("customer_id", F.col("customer_unique_id").isNotNull().alias("named"), F.col("customer_zip_code_prefix").alias("zip"))
    buyers = join_to_grouped(buyers, _spots(lake, "spot"), "zip", "left")
    buyers = buyers.groupBy("customer_id").agg(*_any(bought=F.lit(True), named=F.col("named"), placed=F.col("spot")))
    marked = join_to_grouped(orders, buyers, "customer_id", "left")
    sold = F.col("delivered") & F.col("named")
    marks = {m: F.col(m) for m in ("delivered", "open", "bought", "placed")}
    return marked.groupBy("order_id").agg(*_any(**marks, sold=sold, sold_on_a_day=sold & F.col("dated")))


def _line_marks(lake) -> DataFrame:
    """One row per order_id of the lines: whether any of them has a known product, a known seller, and so on."""
    lines = lake.model("stg_order_items").select("order_id", "product_id", "seller_id")
    products = lake.source("products").where("product_id is not null").groupBy("product_id").agg(F.lit(True).alias("has_product"))
    sellers = lake.model("stg_sellers").where("seller_id is not null").select("seller_id", F.col("seller_zip_code_prefix").alias("zip"))
    sellers = join_to_grouped(sellers, _spots(lake, "spotted"), "zip", "left").select("seller_id", F.lit(True).alias("has_seller"), "spotted")
    marked = join_to_grouped(join_to_grouped(lines, products, "product_id", "left"), sellers, "seller_id", "left")
    marks = {m: F.col(m) for m in ("has_product", "has_seller", "spotted")}
    return marked.groupBy("order_id").agg(*_any(lines=F.lit(True), offered=F.col("has_product") & F.col("has_seller"), **marks))


def evidence(lake) -> DataFrame:
    """One row with a column for each model of ``EVIDENCE``: whether it has rows, NULL or false if it has none."""
    # Keys are not joined where they are NULL; their lines and orders still count for what needs no partner.
    both = _line_marks(lake).join(_order_marks(lake), "order_id", "full")
    return both.agg(*[F.bool_or(F.expr(marks)).alias(model) for model, marks in EVIDENCE.items()])
