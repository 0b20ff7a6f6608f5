"""Raw rows that cannot be used: every row read is kept or counted under one reason."""

import json

import pytest

from conftest import rows
from lakemart.sources import quarantine
from lakemart.sources.quarantine import counts, in_no_day, read_raw_rescued, split, take_csv
from lakemart.sources.schemas import SOURCE_TABLES

ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
ORDERS = (
    "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
    "order_delivered_customer_date,order_estimated_delivery_date\n"
)


def test_rows_in_are_rows_out_and_rows_set_aside(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(ITEMS + "a,1,p,s,d,1.5,2\nb,one,p,s,d,x,2\nc,1,p\nd,1,p,s,d,1,2,3\ne,,p,s,d,,2\n")
    read = {r["order_id"]: r for r in read_raw_rescued(spark, "order_items", str(path)).collect()}
    assert read["a"]["_rescued"] is None and read["e"]["_rescued"] is None and read["e"]["price"] is None
    assert read["b"]["_rescued"]["cells"] == {"order_item_id": "one", "price": "x"} and read["b"]["freight_value"] == 2.0
    assert read["c"]["_rescued"]["line"] == "c,1,p" and read["d"]["_rescued"]["line"] == "d,1,p,s,d,1,2,3"

    kept = take_csv(spark, "order_items", str(path), str(tmp_path / "aside"), "one")
    assert rows(kept.select("order_id")) == [("a",), ("e",)]
    assert rows(counts(spark, str(tmp_path / "aside"), "order_items")) == [("one", "cell", 1), ("one", "shape", 2)]
    # Taken again, the delivery replaces what it set aside.
    take_csv(spark, "order_items", str(path), str(tmp_path / "aside"), "one")
    assert sum(r[2] for r in rows(counts(spark, str(tmp_path / "aside"), "order_items"))) == 3
    stored = spark.read.parquet(str(tmp_path / "aside" / "order_items")).where("reason = 'cell'").first()
    assert json.loads(stored["row"])["_rescued"]["cells"]["price"] == "x"


def test_lenient_reading_keeps_rows_with_null_cells(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(ITEMS + "a,1,p,s,d,1.5,2\nb,one,p,s,d,x,2\nc,1,p\n")
    kept, refused = split(read_raw_rescued(spark, "order_items", str(path)), refuse=["shape"])
    assert rows(kept.select("order_id", "price")) == [("a", 1.5), ("b", None)]
    assert rows(refused.select("order_id", "reason")) == [("c", "shape")]


def test_one_reason_for_a_row_with_several_faults(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(ORDERS + "a,c,s,2017-01-01 00:00:00,,,,\nb,c,s,n/a,,,,\nc,c,s,,,,,\nd,c,s,bad\ne,c,s,2017-02-30 10:00:00,,,,\n")
    kept, refused = split(read_raw_rescued(spark, "orders", str(path)), stamped=True)
    assert rows(kept.select("order_id")) == [("a",)]
    assert rows(refused.select("order_id", "reason")) == [("b", "stamp"), ("c", "stamp"), ("d", "shape"), ("e", "stamp")]


def test_quotes_and_line_breaks_are_no_faults(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,t,"one, ""two""\nthree",2017-01-01 00:00:00,\nr2,o2,five,t,"x\ny",2017-01-01 00:00:00,\n'
    )
    kept, refused = split(read_raw_rescued(spark, "order_reviews", str(path)))
    assert rows(kept.select("review_id", "review_comment_message")) == [("r1", 'one, "two"\nthree')]
    assert rows(refused.selectExpr("review_id", "reason", "_rescued.cells['review_score']")) == [("r2", "cell", "five")]


def test_empty_file_and_empty_sink(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(ITEMS)
    assert take_csv(spark, "order_items", str(path), str(tmp_path / "aside"), "d").count() == 0
    assert counts(spark, str(tmp_path / "aside"), "order_items").count() == 0


@pytest.fixture
def half_dated(tables):
    orders = [("o1", "c1", "2017-01-01 00:00:00"), ("o2", "c2", "never"), ("o3", "c3", None)]
    items = [("o1", "p1", "s1"), ("o2", "p2", "s2"), ("o2", "p1", "s1"), ("o9", "p3", "s3"), (None, "p1", "s1")]
    return tables(
        orders=("order_id string, customer_id string, order_purchase_timestamp string", orders),
        order_items=("order_id string, product_id string, seller_id string", items),
        order_payments=("order_id string", [("o1",), ("o3",)]),
        order_reviews=("order_id string", [("o1",)]),
        customers=("customer_id string", [("c1",), ("c2",), ("c4",)]),
        sellers=("seller_id string", [("s1",), ("s2",)]),
        products=("product_id string", [("p1",), ("p3",)]),
    )


def test_what_no_day_holds_is_listed(half_dated):
    found = in_no_day(half_dated.source)
    assert set(found) == set(SOURCE_TABLES) - {"geolocation", "product_category_name_translation"}
    assert rows(found["orders"].select("order_id", "reason")) == [("o2", "stamp"), ("o3", "stamp")]
    listed = {t: [r[0] for r in rows(f.select(f.columns[0]))] for t, f in found.items() if t != "orders"}
    assert listed == {
        "order_items": ["o2", "o2", "o9", None],
        "order_payments": ["o3"],
        "order_reviews": [],
        "customers": ["c2", "c4"],
        "sellers": ["s2"],
        "products": ["p3"],
    }
    assert quarantine.REASONS == ("shape", "cell", "stamp", "parent")
