"""Fact tables. Grains are stated per function; none is aggregated beyond them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.dates import days_crossed, hours_crossed
from lakemart.functions.geo import great_circle_km
from lakemart.functions.numbers import round_half_away
from lakemart.operators.intervals import open_per_day
from lakemart.operators.keys import join_to_grouped
from lakemart.plans.dims import zip_centroids

# Fixed values of the business rules.
DELIVERED = "delivered"
SLOW_APPROVAL_HOURS = 48
SLOW, FAST = "Slow Approval", "Fast Approval"
BACKLOG_STATUSES = ("shipped", "delivered", "invoiced", "processing")


def fact_orders(lake) -> DataFrame:
    """One row per order. ``is_late`` is NULL while either date is missing."""
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return lake.model("stg_orders").select(
        "order_id",
        "customer_id",
        F.col("order_purchase_timestamp").cast("date").alias("date_key"),
        "order_status",
        late.alias("is_late"),
    )


def fact_order_items(lake) -> DataFrame:
    """One row per order line."""
    return lake.model("stg_order_items").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("price").alias("item_price"),
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_line_value"),
    )


def fact_payments(lake) -> DataFrame:
    """One row per payment attempt."""
    return lake.model("stg_payments").withColumnRenamed("payment_installments", "installments").select(
        "order_id", "payment_sequential", "payment_type", "installments", "payment_value"
    )


def fact_reviews(lake) -> DataFrame:
    """One row per review."""
    waited = hours_crossed(F.col("review_creation_date"), F.col("review_answer_timestamp"))
    return lake.model("stg_reviews").withColumn("response_time_hours", waited)


def fact_order_lifecycle(lake) -> DataFrame:
    """One row per delivered order. An unknown approval lag counts as fast."""
    bought = F.col("order_purchase_timestamp")
    timed = lake.model("stg_orders").where(F.col("order_status") == DELIVERED).select(
        "order_id",
        hours_crossed(bought, F.col("order_approved_at")).alias("approval_lag_hours"),
        days_crossed(bought, F.col("order_delivered_customer_date")).alias("total_delivery_days"),
    )
    slow = F.col("approval_lag_hours") > SLOW_APPROVAL_HOURS
    return timed.withColumn("approval_efficiency", F.when(slow, SLOW).otherwise(FAST))


def fact_shipping_network(lake) -> DataFrame:
    """One row per order line whose buyer and seller zip both have coordinates.

    Coordinates are attached at order and at seller grain first; the lines themselves move once on order_id, or not at
    all where they are laid out by it.
    """
    spots = zip_centroids(lake)
    buyer_spot = spots.select(
        F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
        F.col("latitude").alias("cust_lat"),
        F.col("longitude").alias("cust_lng"),
    )
    seller_spot = spots.select(
        F.col("zip_code_prefix").alias("seller_zip_code_prefix"),
        F.col("latitude").alias("sell_lat"),
        F.col("longitude").alias("sell_lng"),
    )
    buyers = lake.model("stg_customers").select("customer_id", "customer_zip_code_prefix")
    order_spots = (
        lake.model("stg_orders")
        .select("order_id", "customer_id")
        .join(join_to_grouped(buyers, buyer_spot, "customer_zip_code_prefix"), "customer_id")
        .select("order_id", "cust_lat", "cust_lng")
    )
    sellers = lake.model("stg_sellers").select("seller_id", "seller_zip_code_prefix")
    seller_spots = join_to_grouped(sellers, seller_spot, "seller_zip_code_prefix").select("seller_id", "sell_lat", "sell_lng")
    # Once published, the fact is the narrower and, with buckets, the one laid out by order.
    items = "fact_order_items" if lake.is_written("fact_order_items") else "stg_order_items"
    lines = lake.model(items).select("order_id", "seller_id").join(order_spots, "order_id")
    routes = join_to_grouped(lines, seller_spots, "seller_id")
    distance = great_circle_km(F.col("sell_lat"), F.col("sell_lng"), F.col("cust_lat"), F.col("cust_lng"))
    return routes.select("order_id", "cust_lat", "cust_lng", "sell_lat", "sell_lng", distance.alias("distance_km"))


def backlog_days() -> tuple[Column, Column]:
    """First and last day on which the lines of an order are open, from the columns of ``stg_orders``."""
    return F.col("order_purchase_timestamp").cast("date"), F.col("order_delivered_customer_date").cast("date")


def backlog_lines(lake) -> DataFrame:
    """Order lines that are open at some time: seller, first day, last day or NULL, worth."""
    opened, closed = backlog_days()
    orders = lake.model("stg_orders").where(F.col("order_status").isin(*BACKLOG_STATUSES)).select(
        "order_id", opened.alias("opened"), closed.alias("closed")
    )
    lines = lake.model("stg_order_items").select(
        "order_id", "seller_id", (F.col("price") + F.col("freight_value")).alias("line_value")
    )
    return lines.join(orders, "order_id")


def snapshot_daily_seller_backlog(lake) -> DataFrame:
    """One row per seller and day with open order lines: how many, and what they are worth.

    A line is open from the purchase day to the delivery day inclusive; undelivered lines stay open to the last
    purchase day in the data.
    """
    backlog = open_per_day(
        backlog_lines(lake), "seller_id", "opened", "closed", "line_value", lambda total: round_half_away(total, 2)
    )
    return backlog.select(
        "seller_id",
        F.col("day").alias("snapshot_date"),
        F.col("open_count").alias("open_orders_count"),
        F.col("open_amount").alias("revenue_in_transit"),
    )
