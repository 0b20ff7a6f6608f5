"""Dimensions. The ``*_attributes`` functions give a dimension without its surrogate key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.dates import calendar_columns
from lakemart.functions.numbers import round_half_away
from lakemart.operators.keys import first_per_key
from lakemart.operators.ranking import global_row_number

# The calendar covered by the date dimension.
FIRST_DAY, LAST_DAY = "2016-01-01", "2018-12-31"


def customer_attributes(lake) -> DataFrame:
    """One row per person; a person with several addresses keeps the smallest (city, state)."""
    columns = ["customer_unique_id", "customer_city", "customer_state"]
    return first_per_key(lake.model("stg_customers").select(*columns), columns[0], columns[1:])


def seller_attributes(lake) -> DataFrame:
    # stg_sellers already holds one row per seller.
    return lake.model("stg_sellers").select("seller_id", "seller_city", "seller_state")


def product_attributes(lake) -> DataFrame:
    volume = F.col("product_length_cm") * F.col("product_width_cm") * F.col("product_height_cm")
    return lake.model("stg_products").select(
        "product_id", "product_category_name", volume.alias("volume_cm3"), "product_weight_g"
    )


def _with_surrogate(lake, dimension: str, surrogate: str, natural: str) -> DataFrame:
    """Dense numbers in the order of the natural key or, if the lake keeps keys, those that the keys got first."""
    attributes = lake.attributes(dimension)
    keys = lake.key_map(dimension)
    if keys is not None:
        numbered = keys.numbered(attributes, natural, surrogate)
    else:
        numbered = global_row_number(attributes, surrogate, [F.col(natural).asc_nulls_last()])
    return numbered.select(surrogate, *attributes.columns)


def dim_customers(lake) -> DataFrame:
    return _with_surrogate(lake, "dim_customers", "customer_sk", "customer_unique_id")


def dim_sellers(lake) -> DataFrame:
    return _with_surrogate(lake, "dim_sellers", "seller_sk", "seller_id")


def dim_products(lake) -> DataFrame:
    return _with_surrogate(lake, "dim_products", "product_sk", "product_id")


def zip_centroids(lake) -> DataFrame:
    """Mean coordinate per zip prefix."""
    return lake.model("stg_geolocation").groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.avg("geolocation_lat").alias("latitude"), F.avg("geolocation_lng").alias("longitude")
    )


def dim_geolocation(lake) -> DataFrame:
    rounded = [round_half_away(F.col(c), 6).alias(c) for c in ("latitude", "longitude")]
    return zip_centroids(lake).select("zip_code_prefix", *rounded)


def dim_date(lake) -> DataFrame:
    day_count = f"datediff(date'{LAST_DAY}', date'{FIRST_DAY}') + 1"
    days = lake.spark.range(1).select(
        F.explode(F.expr(f"transform(sequence(0, {day_count} - 1), i -> date_add(date'{FIRST_DAY}', i))")).alias("date_key")
    )
    return days.select("date_key", *calendar_columns(F.col("date_key")))
