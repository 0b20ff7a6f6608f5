"""Facts laid out by order: joined without moving the lines."""

import re

from conftest import SF_DIR, rows
from lakemart import Lake
from lakemart.sources.buckets import is_bucketed, read_bucketed, write_bucketed


def exchanges(df):
    """The hash exchanges of a plan, by their key."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def test_tables_of_one_layout_are_joined_in_place(spark, tmp_path, setting):
    setting(autoBroadcastJoinThreshold=-1)
    for name, step in (("a", 1), ("b", 3)):
        frame = spark.range(0, 3000, step).selectExpr("concat('o', id) as order_id", f"id * 2 as {name}")
        write_bucketed(frame, f"{tmp_path}/{name}", "order_id", 4)
    a, b = (read_bucketed(spark, f"{tmp_path}/{n}") for n in "ab")
    joined = a.join(b, "order_id")
    assert exchanges(joined) == [] and joined.count() == 1000
    assert exchanges(a.groupBy("order_id").count()) == []
    # Another session knows the folder only.
    other = spark.newSession()
    for name in spark.catalog.listTables():
        if name.name.startswith("lakemart_"):
            spark.sql(f"drop table {name.name}")
    assert is_bucketed(other, f"{tmp_path}/a") and not is_bucketed(other, str(tmp_path))
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    again = read_bucketed(other, f"{tmp_path}/a").join(read_bucketed(other, f"{tmp_path}/b"), "order_id")
    assert exchanges(again) == [] and again.count() == 1000


def test_lines_stay_where_they_are(spark, tmp_path, setting):
    plain = Lake.from_standin(spark, SF_DIR)
    expected = {m: rows(plain.model(m)) for m in ("obt_sales_analytics", "fact_shipping_network")}
    lake = Lake(spark, plain.source, str(tmp_path), buckets=4)
    for model in ("fact_orders", "fact_order_items"):
        lake.publish(model)
    reader = Lake(spark, plain.source, str(tmp_path), buckets=4)
    for model in ("fact_orders", "fact_order_items"):
        assert rows(reader.open_published(model)) == rows(plain.model(model))
    assert all(rows(reader.model(m)) == found for m, found in expected.items())
    setting(autoBroadcastJoinThreshold=-1)
    for model in ("obt_sales_analytics", "fact_shipping_network"):
        bare, laid = (exchanges(Lake.model(x, model)) for x in (Lake.from_standin(spark, SF_DIR), _reader(spark, plain, tmp_path)))
        # Both sides of the join by order move in one plan; only the orders' side, which comes from other joins, in the other.
        assert bare.count("order_id") == 2 and laid.count("order_id") == 1


def _reader(spark, plain, gold):
    reader = Lake(spark, plain.source, str(gold), buckets=4)
    for model in ("fact_orders", "fact_order_items"):
        reader.open_published(model)
    return reader
