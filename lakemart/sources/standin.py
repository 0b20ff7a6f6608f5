"""The nine source tables derived from a TPC-H-like star schema, for tests and benchmarks.

Prices, freight and coordinates are binary fractions, so double sums come out equal in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that building a plan never opens a file.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _orders(t):
    k = "o_orderkey"
    placed = t("orders").withColumn(
        "placed", F.expr(f"cast(o_orderdate as timestamp_ntz) + interval '1' minute * (({k} * 37) % 1440)")
    )
    delivered = "o_orderstatus in ('F', 'O')"
    return placed.selectExpr(
        f"concat('O', {k}) as order_id",
        f"concat('C', {k}) as customer_id",
        f"""case when {delivered} then 'delivered' when {k} % 4 = 0 then 'shipped' when {k} % 4 = 1 then 'processing'
            when {k} % 4 = 2 then 'invoiced' else 'canceled' end as order_status""",
        "placed as order_purchase_timestamp",
        f"case when {k} % 50 <> 0 then placed + interval '1' minute * (({k} * 53) % 6000) end as order_approved_at",
        "cast(o_orderdate as timestamp_ntz) + interval '2' day as order_delivered_carrier_date",
        f"""case when {delivered} and {k} % 97 <> 0 then placed + interval '1' minute * (({k} * 7919) % 44640) end
            as order_delivered_customer_date""",
        "cast(o_orderdate as timestamp_ntz) + interval '21' day as order_estimated_delivery_date",
    )


def _with_nation(t, df, nation_key):
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.join(places, F.col(nation_key) == F.col("n_nationkey"))


def _customers(t):
    buyers = _with_nation(t, t("customer"), "c_nationkey")
    return t("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "concat('C', o_orderkey) as customer_id",
        "concat('U', o_custkey) as customer_unique_id",
        "cast(1000 + o_custkey % 650 as int) as customer_zip_code_prefix",
        "case when o_orderkey % 10 = 0 then concat('MOVED_', n_name) else n_name end as customer_city",
        "r_name as customer_state",
    )


def _sellers(t):
    copies = _with_nation(t, t("supplier"), "s_nationkey").withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return copies.where("copy = 0 or s_suppkey % 3 = 0").selectExpr(
        "concat('S', s_suppkey) as seller_id",
        "cast(1000 + (s_suppkey * 7) % 600 as int) as seller_zip_code_prefix",
        "case when copy = 1 then concat('ALT_', n_name) else n_name end as seller_city",
        "r_name as seller_state",
    )


def _order_items(t):
    return t("lineitem").selectExpr(
        "concat('O', l_orderkey) as order_id",
        "l_linenumber as order_item_id",
        "concat('P', l_partkey) as product_id",
        "concat('S', l_suppkey) as seller_id",
        "l_quantity / 2 + cast(3 as double) / 4 as price",
        "cast(l_suppkey % 4 + 2 as double) / 4 as freight_value",
    )


def _products(t):
    return t("part").selectExpr(
        "concat('P', p_partkey) as product_id",
        "case when p_partkey % 61 <> 0 then concat(lower(p_type), '_', lower(p_brand)) end as product_category_name",
        "cast(p_size * 100 as int) as product_weight_g",
        "cast(p_size as double) as product_length_cm",
        "cast(p_size % 10 + 1 as double) as product_height_cm",
        "cast(p_size % 7 + 2 as double) as product_width_cm",
    )


def _translation(t):
    return t("part").where("p_brand <> 'Brand#7'").selectExpr(
        "concat(lower(p_type), '_', lower(p_brand)) as product_category_name",
        "concat(p_type, ' ', p_brand) as product_category_name_english",
    ).distinct()


def _geolocation(t):
    return t("part").selectExpr(
        "cast(1000 + p_partkey % 600 as int) as geolocation_zip_code_prefix",
        "cast((p_partkey * 17) % 3800 as double) / 128 - 33 as geolocation_lat",
        "cast((p_partkey * 29) % 3800 as double) / 128 - 73 as geolocation_lng",
    )


def _order_payments(t):
    return t("orders").selectExpr(
        "concat('O', o_orderkey) as order_id",
        "1 as payment_sequential",
        """case left(o_orderpriority, 1) when '1' then 'credit_card' when '2' then 'boleto' when '3' then 'VOUCHER'
           when '4' then 'debit_card' else 'not_defined' end as payment_type""",
        "cast(1 + o_orderkey % 12 as int) as payment_installments",
        "o_totalprice as payment_value",
    )


def _order_reviews(t):
    k = "o_orderkey"
    copies = t("orders").where(f"{k} % 5 <> 0").withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    created = copies.where(f"copy = 0 or {k} % 8 = 1").withColumn(
        "created", F.expr("cast(o_orderdate as timestamp_ntz) + interval '30' day")
    )
    return created.selectExpr(
        f"""concat(case when copy = 0 then 'R' else 'R2_' end,
            case when {k} % 33 = 0 and {k} > 0 then {k} - 1 else {k} end) as review_id""",
        f"concat('O', {k}) as order_id",
        f"cast(1 + ({k} * 31 + copy) % 5 as int) as review_score",
        "cast(null as string) as review_comment_title",
        "cast(null as string) as review_comment_message",
        "created as review_creation_date",
        f"created + interval '1' minute * (({k} * 101) % 10000) as review_answer_timestamp",
    )


_TABLES = {
    "orders": _orders,
    "order_items": _order_items,
    "order_payments": _order_payments,
    "order_reviews": _order_reviews,
    "customers": _customers,
    "products": _products,
    "sellers": _sellers,
    "geolocation": _geolocation,
    "product_category_name_translation": _translation,
}


def standin_source(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    @cache
    def table(name: str) -> DataFrame:
        return star_table(spark, sf_dir, name)

    return lambda name: _TABLES[name](table)
