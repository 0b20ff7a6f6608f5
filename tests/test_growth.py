"""What a task holds and what an exchange carries must not grow faster than the input."""

import datetime as dt
import re

import pytest

from conftest import SF_DIR, rows
from lakemart import Lake
from lakemart.operators import intervals
from lakemart.operators.keys import mark_first


def plan_of(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_one_row_of_each_combination_is_marked(spark):
    pairs = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), (None, "x"), (None, "x"), ("a", None), ("a", None), (None, None)]
    marked = mark_first(spark.createDataFrame(pairs, "k string, v string"), ["k", "v"], "first")
    assert sorted(marked.select("k", "v").collect(), key=str) == sorted(pairs, key=str)
    assert rows(marked.where("first").select("k", "v")) == sorted(set(pairs), key=str)


@pytest.mark.parametrize("model", ["rpt_seller_performance", "rpt_product_category_analysis"])
def test_distinct_orders_need_no_hash_table_of_lines(spark, model):
    """Orders of a seller or category are counted without sums being held for each (order, seller) or (order, category)."""
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan_of(Lake.from_standin(spark, SF_DIR).model(model)))
    assert keys and not [k for k in keys if "order_id" in k and "," in k]


def test_orders_without_a_key_are_not_counted(tables):
    line = "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"
    lines = [("O1", 1, "P", "S", 1.0, 0.5), ("O1", 2, "P", "S", 1.0, 0.5), ("O1", 2, "P", "S", 1.0, 0.5), (None, 1, "P", "S", 2.0, None), ("O2", 1, "P", "S", None, 0.5)]
    stamps = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]
    review = "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
    size = "product_weight_g int, product_length_cm double, product_height_cm double, product_width_cm double"
    lake = tables(
        orders=("order_id string, customer_id string, order_status string, " + ", ".join(f"{s} timestamp_ntz" for s in stamps), []),
        order_items=(line, lines),
        order_reviews=(review, []),
        sellers=("seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string", [("S", 1, "c", "s")]),
        products=(f"product_id string, product_category_name string, {size}", [("P", None, 1, 1.0, 1.0, 1.0)]),
        product_category_name_translation=("product_category_name string, product_category_name_english string", []),
    )
    assert rows(lake.model("rpt_seller_performance").select("total_orders", "total_items_sold", "total_revenue")) == [(2, 5, 4.5)]
    assert rows(lake.model("rpt_product_category_analysis").select("total_orders", "total_items_sold", "total_revenue")) == [(2, 5, 4.5)]


def test_lines_move_before_they_are_wide(spark, setting):
    """The columns of the order are joined after the exchanges by product and seller, and no sum of two columns is carried."""
    setting(autoBroadcastJoinThreshold=-1, adaptive__enabled="false")
    plan = plan_of(Lake.from_standin(spark, SF_DIR).model("obt_sales_analytics"))
    joins = re.findall(r"SortMergeJoin \[(\w+)\], \[\w+\], Inner", plan)
    assert joins[:3] == ["order_id", "seller_id", "product_id"]
    assert re.search(r"total_line_value", plan.split("SortMergeJoin", 1)[1]) is None


def test_a_model_is_checked_in_one_pass(spark, tables):
    """NULLs, emptiness and the first unique column come from one grouped count."""
    from lakemart.plans import checks

    frame = spark.createDataFrame([("R1", "O1", 5), ("R1", None, 4), (None, "O2", None), (None, None, 1)], "review_id string, order_id string, review_score int")
    found = checks._single_pass(frame, "fact_reviews", True)
    assert len(found) == 1
    assert rows(found[0].select("check", "column", "failures")) == sorted([("unique", "review_id", 1), ("not_null", "review_id", 2), ("not_null", "order_id", 2), ("not_null", "review_score", 1), ("not_empty", None, 0)], key=str)
    empty = checks._single_pass(frame.where("false"), "fact_reviews", True)[0]
    assert {r["check"]: r["failures"] for r in empty.collect()} == {"unique": 0, "not_null": 0, "not_empty": 1}
    assert [r["failures"] for r in checks._single_pass(frame.where("false"), "obt_sales_analytics", True)[0].collect()] == [1]


def test_emptiness_of_all_models_moves_lines_once(spark, setting):
    """The models that join lines to orders are looked at in one join; only baskets need another pass over the lines."""
    from lakemart.plans import GOLD, checks
    from lakemart.sources.standin import standin_source

    source = standin_source(spark, SF_DIR)
    setting(adaptive__enabled="false")
    found = checks.empty_models(Lake(spark, source), [m for m in GOLD if m != "rpt_market_basket"])
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan_of(found))
    assert len(scans) == 2 and len([s for s in scans if "l_suppkey" in s]) == 1  # the other: fact_order_items, its first row
    for lacking in ("order_items", "customers", "sellers", "geolocation", "orders"):
        lake = Lake(spark, lambda t, lacking=lacking: source(t).where("false") if t == lacking else source(t))
        models = [m for m in GOLD if m not in ("rpt_customer_rfm", "rpt_customer_ltv", "dim_date", "rpt_market_basket")]
        assert {r[0] for r in checks.empty_models(lake, models).collect()} == {m for m in models if lake.model(m).isEmpty()}


def test_marks_of_one_order_are_not_mixed_with_those_of_another(spark, tables):
    from lakemart.plans.evidence import evidence

    stamps = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]
    made = dict(
        orders=("order_id string, customer_id string, order_status string, " + ", ".join(f"{s} timestamp_ntz" for s in stamps), [("A", "C1", "delivered", *[None] * 5), ("B", "C2", "canceled", *[None] * 5), (None, "C3", "delivered", *[None] * 5)]),
        order_items=("order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double", [("B", 1, "P", "S", 1.0, 1.0), (None, 1, "P", None, 1.0, 1.0)]),
        customers=("customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string", [("C1", None, 1, "c", "s"), ("C2", "U", 2, "c", "s"), ("C3", "U", 1, "c", "s")]),
        sellers=("seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string", [("S", 1, "c", "s")]),
        products=("product_id string, product_category_name string, product_weight_g int, product_length_cm double, product_height_cm double, product_width_cm double", [("P", None, 1, 1.0, 1.0, 1.0)]),
        product_category_name_translation=("product_category_name string, product_category_name_english string", []),
        geolocation=("geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double", [(1, 0.0, 0.0)]),
        order_reviews=("review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz", []),
    )
    there = {m for m, found in evidence(tables(**made)).first().asDict().items() if found}
    assert there == {"obt_sales_analytics", "rpt_seller_performance", "rpt_product_category_analysis"}
    lake = tables(**made)
    assert there == {m for m in evidence(lake).columns if m not in ("rpt_customer_rfm", "rpt_customer_ltv") and not lake.model(m).isEmpty()}


def _days_by_hand(spans):
    """Count and total of ``open_per_day``, day by day."""
    spans = [(k, s and dt.date.fromisoformat(s), e and dt.date.fromisoformat(e), a) for k, s, e, a in spans if s]
    last, found = max(s for _, s, _, _ in spans), {}
    for key, start, end, amount in spans:
        for day in range((min(end or last, last) - start).days + 1):
            at = key, start + dt.timedelta(days=day)
            n, total = found.get(at, (0, 0.0))
            found[at] = n + 1, total + (amount or 0.0)
    return sorted(((*at, *open_) for at, open_ in found.items()), key=str)


SPANS = [
    ("a", "2020-01-01", "2020-01-03", 1.25), ("a", "2020-01-01", "2020-01-01", 2.5), ("a", "2020-01-02", None, 4.0), ("a", "2020-01-04", "2020-01-01", 8.0),
    ("a", "2020-01-02", None, 4.0), ("b", "2020-01-03", "2020-02-01", 1.0), ("b", "2020-01-04", "2020-01-04", None), ("c", "2020-01-05", "2020-01-02", 1.0),
    (None, "2020-01-01", "2020-01-02", 3.0), (None, "2020-01-02", "2020-01-02", 3.5), (None, "2020-01-04", None, None), ("a", None, "2020-01-03", 9.0), ("d", None, None, 1.0),
]


@pytest.mark.parametrize("many", [100, 3, 2, 0])
def test_open_days_of_keys_with_many_intervals(spark, monkeypatch, many):
    """Keys, NULL as well, give the same days whether they are summed per day on the way (more than ``many``) or not."""
    monkeypatch.setattr(intervals, "MANY", many)
    frame = spark.createDataFrame(SPANS, "k string, s string, e string, a double").selectExpr("k", "cast(s as date) s", "cast(e as date) e", "a")
    assert rows(intervals.open_per_day(frame, "k", "s", "e", "a")) == _days_by_hand(SPANS)
    assert rows(intervals.open_per_day(frame.where("k = 'd'"), "k", "s", "e", "a")) == []


def test_intervals_move_once_and_are_not_written_as_events(spark, setting, monkeypatch):
    """What is written has a row for an interval, not one for each of its ends; one exchange then brings it to its key."""
    written, write = [], intervals.materialize
    monkeypatch.setattr(intervals, "materialize", lambda df, label: written.append(df.count()) or write(df, label))
    setting(adaptive__enabled="false")
    frame = spark.range(200).selectExpr("cast(id % 5 as string) as k", "date_add(date'2020-01-01', cast(id as int)) as s", "date_add(date'2020-01-04', cast(id as int)) as e", "1.0D as a")
    found = intervals.open_per_day(frame, "k", "s", "e", "a")
    assert sum(written) <= 200
    few = plan_of(found).split("Union", 1)[1].split("Exchange hashpartitioning", 1)[0]  # from the days down to the first exchange
    assert "Window" in few and "explode(array(struct(day" in few and "Aggregate" not in few.split("+- Window", 1)[1]


def test_backlog_is_rounded_before_its_days(spark):
    """A total is rounded once for all days on which it stays."""
    plan = plan_of(Lake.from_standin(spark, SF_DIR).model("snapshot_daily_seller_backlog"))
    above, below = plan.split("explode(sequence", 1)
    assert "round(" in below and "round(" not in above
