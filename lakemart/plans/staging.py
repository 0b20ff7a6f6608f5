"""Staging models: projection, casts and key de-duplication over the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.numbers import to_int_half_even
from lakemart.functions.text import payment_label
from lakemart.operators.keys import first_per_key, join_to_grouped


def _stamp(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def stg_orders(lake) -> DataFrame:
    return lake.source("orders").select(
        "order_id",
        "customer_id",
        "order_status",
        _stamp("order_purchase_timestamp"),
        _stamp("order_approved_at"),
        _stamp("order_delivered_carrier_date"),
        _stamp("order_delivered_customer_date"),
        _stamp("order_estimated_delivery_date"),
    )


def stg_order_items(lake) -> DataFrame:
    return lake.source("order_items").select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
    )


def stg_customers(lake) -> DataFrame:
    return lake.source("customers").select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    )


def stg_sellers(lake) -> DataFrame:
    columns = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    return first_per_key(lake.source("sellers").select(*columns), "seller_id", columns[1:])


def stg_geolocation(lake) -> DataFrame:
    return lake.source("geolocation").select("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng")


def stg_payments(lake) -> DataFrame:
    return lake.source("order_payments").select(
        "order_id",
        "payment_sequential",
        payment_label(F.col("payment_type")).alias("payment_type"),
        "payment_installments",
        F.col("payment_value").cast("double").alias("payment_value"),
    )


def stg_products(lake) -> DataFrame:
    """English category names; the translation is reduced to one row per name before the join, not after it."""
    measures = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    rows = lake.source("products").select("product_id", "product_category_name", *measures)
    rows = first_per_key(rows, "product_id", ["product_category_name", *measures])
    english = lake.source("product_category_name_translation").groupBy("product_category_name").agg(
        F.min("product_category_name_english").alias("english")
    )
    return join_to_grouped(rows, english, "product_category_name", "left").select(
        "product_id",
        F.coalesce("english", F.lit("Unknown")).alias("product_category_name"),
        to_int_half_even(F.col("product_weight_g")).alias("product_weight_g"),
        *[F.col(c).cast("double").alias(c) for c in measures[1:]],
    )


def stg_reviews(lake) -> DataFrame:
    rows = lake.source("order_reviews").select(
        "review_id",
        "order_id",
        to_int_half_even(F.col("review_score")).alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        _stamp("review_creation_date"),
        _stamp("review_answer_timestamp"),
    )
    return first_per_key(rows, "review_id", rows.columns[1:])
