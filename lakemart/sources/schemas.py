"""Declared schemas of the nine source tables; no job infers a schema.

Time stamps are text up to the staging models, which are the one place where types are asserted.
"""

from __future__ import annotations

from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructField, StructType

_TYPES: dict[str, DataType] = {"string": StringType(), "int": IntegerType(), "double": DoubleType()}

# Table and column names of the raw data set.
_COLUMNS = {
    "orders": """
        order_id string, customer_id string, order_status string, order_purchase_timestamp string,
        order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string,
        order_estimated_delivery_date string""",
    "order_items": """
        order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string,
        price double, freight_value double""",
    "order_payments": """
        order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double""",
    "order_reviews": """
        review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date string, review_answer_timestamp string""",
    "customers": """
        customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string,
        customer_state string""",
    "products": """
        product_id string, product_category_name string, product_name_lenght int, product_description_lenght int,
        product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double,
        product_width_cm double""",
    "sellers": """
        seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string""",
    "geolocation": """
        geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string,
        geolocation_state string""",
    "product_category_name_translation": """
        product_category_name string, product_category_name_english string""",
}


def _struct(columns: str) -> StructType:
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, StructType] = {table: _struct(columns) for table, columns in _COLUMNS.items()}
SOURCE_TABLES = tuple(SCHEMAS)

# Copied whole into every delivery instead of being cut by order day.
REFERENCE_TABLES = ("geolocation", "product_category_name_translation")

# Hold text typed by buyers, with line breaks.
FREE_TEXT_TABLES = ("order_reviews",)
