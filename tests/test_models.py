"""Model rules on small literal tables."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from lakemart import Lake
from lakemart.plans import GOLD, MODELS, STAGING

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
    "order_estimated_delivery_date string"
)
ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"
REVIEWS = (
    "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date string, review_answer_timestamp string"
)
CUSTOMERS = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string"
)
SELLERS = "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
PRODUCTS = (
    "product_id string, product_category_name string, product_weight_g double, product_length_cm double, "
    "product_height_cm double, product_width_cm double"
)
TRANSLATION = "product_category_name string, product_category_name_english string"


def order(oid, status="delivered", bought="2017-05-01 10:30:00", approved=None, delivered=None, due="2017-05-20 00:00:00"):
    return (oid, f"c{oid}", status, bought, approved, None, delivered, due)


def item(oid, n, product="p1", seller="s1", price=10.0, freight=1.0):
    return (oid, n, product, seller, price, freight)


def review(rid, oid, score):
    return (rid, oid, score, None, None, "2017-06-01 00:00:00", "2017-06-02 01:00:00")


def buyer(oid, person, city="x"):
    return (f"c{oid}", person, 1, city, "SP")


def test_registry_is_complete():
    assert (len(STAGING), len(GOLD), len(MODELS)) == (8, 21, 29)


def test_text_stamps_are_cast_without_a_time_zone(tables):
    lake = tables(orders=(ORDERS, [order("1", delivered="2017-05-21 00:00:01")]))
    staged = lake.model("stg_orders")
    assert dict(staged.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    assert staged.first()["order_purchase_timestamp"] == dt.datetime(2017, 5, 1, 10, 30)


def test_is_late_is_null_until_delivered(tables):
    lake = tables(orders=(ORDERS, [order("1", delivered="2017-05-21 00:00:00"), order("2", delivered="2017-05-20 00:00:00"), order("3")]))
    assert rows(lake.model("fact_orders").select("order_id", "is_late")) == [("1", True), ("2", False), ("3", None)]


def test_lifecycle_of_unknown_lag_is_fast(tables):
    data = [
        order("1", approved="2017-05-03 10:59:00", delivered="2017-05-02 00:00:00"),
        order("2", approved="2017-05-03 11:00:00"),
        order("3"),
        order("4", status="shipped"),
    ]
    found = rows(tables(orders=(ORDERS, data)).model("fact_order_lifecycle"))
    assert found == [("1", 48, 1, "Fast Approval"), ("2", 49, None, "Slow Approval"), ("3", None, None, "Fast Approval")]


def test_products_use_one_translation_per_name(tables):
    lake = tables(
        products=(PRODUCTS, [("p1", "casa", 2.5, 2.0, 3.0, 4.0), ("p1", "casa", 2.5, 2.0, 3.0, 4.0), ("p2", None, None, 1.0, 1.0, 1.0), ("p3", "x", 3.5, 1.0, 1.0, None)]),
        product_category_name_translation=(TRANSLATION, [("casa", "home")] * 3),
    )
    assert rows(lake.model("stg_products").select("product_id", "product_category_name", "product_weight_g")) == [
        ("p1", "home", 2), ("p2", "Unknown", None), ("p3", "Unknown", 4),
    ]
    assert rows(lake.model("dim_products").select("product_sk", "product_id", "volume_cm3")) == [(1, "p1", 24.0), (2, "p2", 1.0), (3, "p3", None)]


def test_surrogate_keys_number_the_natural_keys(spark):
    lake = Lake.from_standin(spark, SF_DIR)
    keys = lake.model("dim_customers").orderBy("customer_unique_id").select("customer_sk").collect()
    assert [r[0] for r in keys] == list(range(1, len(keys) + 1))


def test_calendar(spark):
    calendar = Lake.from_standin(spark, SF_DIR).model("dim_date")
    assert calendar.count() == 1096
    assert calendar.agg(F.min("date_key"), F.max("date_key")).first()[:] == (dt.date(2016, 1, 1), dt.date(2018, 12, 31))
    weekend = calendar.where("date_key = date'2016-01-02'").first()
    assert weekend[1:] == (2016, 1, 1, 6, True)


def test_category_lines_fan_out_over_reviews(tables):
    lake = tables(
        order_items=(ITEMS, [item("1", 1), item("1", 2, price=30.0), item("2", 1, price=20.0), item("3", 1, "p2")]),
        order_reviews=(REVIEWS, [review("r1", "1", 1), review("r2", "1", 5), review("r2", "1", 5), review("r3", "3", 4)]),
        products=(PRODUCTS, [("p1", "a", 1.0, 1.0, 1.0, 1.0), ("p2", "b", 1.0, 1.0, 1.0, 1.0)]),
        product_category_name_translation=(TRANSLATION, [("a", "A"), ("b", "B")]),
    )
    assert rows(lake.model("rpt_product_category_analysis")) == [
        ("A", 2, 5, 105.0, 20.0, 3.0, 2, 4, 50.0),
        ("B", 1, 1, 11.0, 10.0, 4.0, 0, 1, 0.0),
    ]


def test_seller_figures_are_weighted_by_lines(tables):
    lake = tables(
        orders=(ORDERS, [order("1", approved="2017-05-09 00:00:00", delivered="2017-05-03 00:00:00"), order("2", delivered="2017-05-11 00:00:00"), order("3", status="shipped")]),
        order_items=(ITEMS, [item("1", 1), item("1", 2), item("2", 1), item("3", 1, seller="s2")]),
        order_reviews=(REVIEWS, [review("r1", "1", 1), review("r2", "1", 4), review("r3", "2", 5)]),
        sellers=(SELLERS, [("s1", 1, "b", "SP"), ("s1", 1, "a", "SP"), ("s2", 2, "c", "RJ")]),
    )
    assert rows(lake.model("rpt_seller_performance")) == [
        ("s1", "a", "SP", 2, 3, 33.0, 10.0, 4.7, 2, 3.0, 5),
        ("s2", "c", "RJ", 1, 1, 11.0, 10.0, None, None, None, None),
    ]


def test_rfm_and_ltv_leave_out_persons_without_delivered_sales(tables):
    lake = tables(
        orders=(ORDERS, [order("1"), order("2", bought="2017-09-01 00:00:00"), order("3", status="canceled"), order("4")]),
        order_items=(ITEMS, [item("1", 1, price=199.0), item("2", 1, price=299.0), item("3", 1)]),
        order_reviews=(REVIEWS, [review("r1", "1", 5), review("r3", "3", 1)]),
        customers=(CUSTOMERS, [buyer("1", "ann", "b"), buyer("2", "ann", "a"), buyer("3", "bob"), buyer("4", "cid")]),
    )
    assert rows(lake.model("rpt_customer_rfm")) == [("ann", "a", "SP", 0, 2, 500.0, 1, 1, 1, 1.0, "Lost")]
    (ann,) = rows(lake.model("rpt_customer_ltv"))
    assert ann[:3] == ("ann", "a", "SP")
    assert ann[5:] == (4, 2, 500.0, 250.0, 125.0, 5.0, "Medium Value", 1)


def test_cohort_counts_orders_without_lines(spark):
    cohorts = Lake.from_standin(spark, SF_DIR).model("rpt_cohort_retention")
    starts = cohorts.where("months_since_first = 0")
    assert starts.where("retention_pct <> 100 or active_customers <> cohort_customers").count() == 0
    assert cohorts.where("months_since_first < 0 or retention_pct > 100").count() == 0


def test_basket_similarity_is_a_share(spark):
    pairs = Lake.from_standin(spark, SF_DIR).model("rpt_market_basket")
    assert pairs.where("category_a >= category_b or co_occurrence_count < 5").count() == 0
    assert pairs.where("jaccard_similarity not between 0 and 1").count() == 0


def test_backlog_closes_what_it_opens(spark):
    """Line-days of the snapshot equal the summed durations of the lines."""
    lake = Lake.from_standin(spark, SF_DIR)
    total = lake.model("snapshot_daily_seller_backlog").agg(F.sum("open_orders_count")).first()[0]
    lines = lake.model("stg_order_items").join(lake.model("stg_orders"), "order_id").where("order_status <> 'canceled'")
    last = lines.agg(F.max("order_purchase_timestamp").cast("date")).first()[0]
    opened, closed = F.col("order_purchase_timestamp").cast("date"), F.col("order_delivered_customer_date").cast("date")
    length = F.greatest(F.datediff(F.least(closed, F.lit(last)), opened) + 1, F.lit(0))
    assert total == lines.agg(F.sum(length)).first()[0]


def test_money_and_tiles_do_not_depend_on_partitioning(spark, tables):
    """Two-decimal prices: equal spenders keep their tiles however the lines are spread."""
    people = range(60)
    orders = [(f"o{p}", f"c{p}", "delivered", "2017-01-01 00:00:00", None, None, "2017-01-05 00:00:00", None) for p in people]
    lines = [(f"o{p}", n, "p", "s", price, 0.1) for p in people for n, price in enumerate((0.1, 0.2, 0.3, 0.7, 1.1, 2.3), 1)]
    customers = [(f"c{p}", f"u{p:02d}", 1, "city", "XX") for p in people]
    results = []
    for parts in (1, 4, 13):
        lake = tables(
            orders=("order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, order_estimated_delivery_date string", orders),
            order_items=("order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double", lines),
            customers=("customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string", customers),
        )
        items = lake.source("order_items").repartition(parts, "price")
        lake._frames["source order_items"] = items
        results.append(rows(lake.model("rpt_customer_rfm").select("customer_id", "r_score", "f_score", "m_score", "monetary")))
    assert results[0] == results[1] == results[2]
    assert [sum(r[3] == tile for r in results[0]) for tile in range(1, 6)] == [12] * 5
    assert [r[3] for r in results[0]] == sorted(r[3] for r in results[0])  # equal money: by customer


def test_check_rules_agree_on_unknown_values():
    """The labels that the check SQL gives to NULLs are those of the models."""
    import duckdb

    from oracle.relations import RELATIONS

    days = RELATIONS["rpt_shipping_efficiency"].split("       case when total_delivery_days")[1].split(" as distance_bucket")[0]
    found = duckdb.sql(f"select case when total_delivery_days{days} as distance_bucket from (select null::int as total_delivery_days, null::double as distance_km)").fetchall()
    assert found == [("22+ days", "Very Long Distance (>1000km)")]
    tier = RELATIONS["rpt_customer_ltv"].split("       case when spend")[1].split(" as ltv_tier")[0]
    assert duckdb.sql(f"select case when spend{tier} from (select null::double as spend, 1 as orders_placed)").fetchall() == [("Low Value",)]
    assert "order_status in ('shipped', 'delivered', 'invoiced', 'processing')" in RELATIONS["open_lines"]
