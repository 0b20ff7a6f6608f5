"""Files: CSV, day slices, landing -> bronze -> silver, gold."""

import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SF_DIR, rows
from lakemart import Lake
from lakemart.plans import GOLD
from lakemart.plans.checks import ChecksFailed, duplicate_values, empty_models, gate, not_empty, null_counts, run_checks
from lakemart.plans.pipeline import build_gold, check_gold, rebuild
from lakemart.sources import slicing
from lakemart.sources.files import read_model, read_raw, read_zone, write_days, write_model
from lakemart.sources.schemas import SCHEMAS, SOURCE_TABLES
from lakemart.sources.standin import standin_source
from lakemart.streaming import zones


def test_bad_cells_become_null_and_quotes_may_span_lines(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,five,,"good ""stuff""\nreally",2017-01-01 00:00:00,\n'
        "r2,o2,4,t,m,2017-01-01 00:00:00,2017-01-02 00:00:00\n"
    )
    first, second = read_raw(spark, "order_reviews", str(path)).orderBy("review_id").collect()
    assert (first["review_score"], first["review_comment_message"]) == (None, 'good "stuff"\nreally')
    assert second["review_score"] == 4


def test_slices_of_all_days_make_up_the_table(spark):
    source = standin_source(spark, SF_DIR)
    slices = slicing.slice_days(source, "1995-01-01", "2001-12-31")
    assert set(slices) == set(SOURCE_TABLES)
    for table in ("orders", "order_items", "order_payments", "order_reviews", "customers"):
        assert slices[table].count() == source(table).count()


def test_one_day_slice(spark):
    source = standin_source(spark, SF_DIR)
    day = str(source("orders").selectExpr("to_date(order_purchase_timestamp) d").groupBy("d").count().orderBy("count", "d").tail(1)[0][0])
    slices = slicing.slice_days(source, day, day)
    keys = {r[0] for r in slices["orders"].select("order_id").collect()}
    items = [r for r in source("order_items").collect() if r["order_id"] in keys]
    assert keys and slices["order_items"].count() == len(items)
    sellers = {r["seller_id"] for r in items}
    assert {r["seller_id"] for r in slices["sellers"].collect()} == sellers
    assert slicing.slice_days(source, "1980-01-01", "1980-01-01")["order_items"].count() == 0


def write_records(path, table, records):
    schema = pa.schema([(f.name, {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}[f.dataType.simpleString()]) for f in SCHEMAS[table]])
    pq.write_table(pa.Table.from_pylist(records, schema), path)


def land(root, day, table, records):
    os.makedirs(f"{root}/{day}", exist_ok=True)
    write_records(f"{root}/{day}/{table}.parquet", table, records)


def payment(n, value=1.0):
    return {"order_id": f"o{n}", "payment_sequential": 1, "payment_type": "boleto", "payment_installments": 1, "payment_value": value}


@pytest.fixture
def lake_dirs(tmp_path):
    return [str(tmp_path / d) for d in ("landing", "bronze", "silver", "seen-landing", "seen-bronze")]


def run_zones(spark, dirs, **options):
    landing, bronze, silver, seen_landing, seen_bronze = dirs
    zones.landing_to_bronze(spark, landing, bronze, "order_payments", seen_landing, **options).awaitTermination()
    zones.bronze_to_silver(spark, bronze, silver, "order_payments", seen_bronze).awaitTermination()
    return [
        rows(read_zone(spark, root, "order_payments").selectExpr("order_id", "payment_value", "cast(date as string)"))
        for root in (bronze, silver)
    ]


def test_new_days_flow_through_once(spark, lake_dirs):
    land(lake_dirs[0], "2017-01-01", "order_payments", [payment(1), payment(1), payment(2)])
    land(lake_dirs[0], "2017-01-01", "customers", [])
    land(lake_dirs[0], "2017-01-02", "order_payments", [payment(1)])
    bronze, silver = run_zones(spark, lake_dirs)
    assert len(bronze) == 4
    expected = [("o1", 1.0, "2017-01-01"), ("o1", 1.0, "2017-01-02"), ("o2", 1.0, "2017-01-01")]
    assert silver == expected

    files = sorted(glob.glob(f"{lake_dirs[2]}/**/*.parquet", recursive=True))
    assert run_zones(spark, lake_dirs)[1] == expected
    assert sorted(glob.glob(f"{lake_dirs[2]}/**/*.parquet", recursive=True)) == files

    land(lake_dirs[0], "2017-01-03", "order_payments", [payment(3)])
    assert run_zones(spark, lake_dirs)[1] == expected + [("o3", 1.0, "2017-01-03")]
    batch = read_zone(spark, lake_dirs[1], "order_payments").distinct()
    assert rows(batch) == rows(read_zone(spark, lake_dirs[2], "order_payments"))


def test_paced_replay_gives_the_same_files(spark, lake_dirs):
    for day in ("2017-01-01", "2017-01-02", "2017-01-03"):
        land(lake_dirs[0], day, "order_payments", [payment(1), payment(1)])
    bronze, silver = run_zones(spark, lake_dirs, files_per_trigger=1)
    assert (len(bronze), len(silver)) == (6, 3)


def test_a_day_written_again_is_replaced(spark, lake_dirs):
    land(lake_dirs[0], "2017-01-01", "order_payments", [payment(1)])
    land(lake_dirs[0], "2017-01-02", "order_payments", [payment(2)])
    run_zones(spark, lake_dirs)
    land(lake_dirs[0], "2017-01-01", "order_payments", [payment(1, 5.0), payment(1, 5.0)])
    zones.replace_day(spark, *lake_dirs[:3], "order_payments", "2017-01-01")
    silver = read_zone(spark, lake_dirs[2], "order_payments").select("order_id", "payment_value")
    assert rows(silver) == [("o1", 5.0), ("o2", 1.0)]


def land_piece(root, day, name, records):
    path = f"{root}/{day}/order_payments.parquet"
    os.makedirs(path, exist_ok=True)
    write_records(f"{path}/{name}.parquet", "order_payments", records)


@pytest.mark.parametrize("archived", [False, True])
@pytest.mark.parametrize("paced", [None, 1])
def test_pieces_of_a_day_all_reach_bronze(spark, lake_dirs, tmp_path, archived, paced):
    options = {"archive": str(tmp_path / "archive") if archived else None, "files_per_trigger": paced}
    for n in (1, 2, 3):
        land_piece(lake_dirs[0], "2017-01-01", f"first{n}", [payment(n)])
    land_piece(lake_dirs[0], "2017-01-02", "other", [payment(9)])
    assert [r[0] for r in run_zones(spark, lake_dirs, **options)[0]] == ["o1", "o2", "o3", "o9"]
    for n in (4, 5):  # one piece for each later run
        land_piece(lake_dirs[0], "2017-01-01", f"later{n}", [payment(n)])
        bronze, silver = run_zones(spark, lake_dirs, **options)
    assert [r[0] for r in bronze] == [r[0] for r in silver] == ["o1", "o2", "o3", "o4", "o5", "o9"]
    assert bool(glob.glob(f"{lake_dirs[0]}/**/*.parquet", recursive=True)) != archived or os.path.isdir(lake_dirs[0])


def test_a_failed_batch_is_repeated_without_loss(spark, lake_dirs, tmp_path, monkeypatch):
    archive = str(tmp_path / "archive")
    for n in (1, 2):
        land_piece(lake_dirs[0], "2017-01-01", f"piece{n}", [payment(n)])
    move, calls = zones._move, []

    def broken(spark_, landing, to, names):
        move(spark_, landing, to, sorted(names)[:1])  # one file is gone, then the run dies
        calls.append(names)
        raise RuntimeError("lost")

    monkeypatch.setattr(zones, "_move", broken)
    with pytest.raises(Exception, match="lost"):
        run_zones(spark, lake_dirs, archive=archive)
    monkeypatch.setattr(zones, "_move", move)
    bronze, silver = run_zones(spark, lake_dirs, archive=archive)
    assert calls and [r[0] for r in bronze] == [r[0] for r in silver] == ["o1", "o2"]
    land_piece(lake_dirs[0], "2017-01-01", "piece2", [payment(7)])  # the same name again: the newer file counts
    zones.replace_day(spark, *lake_dirs[:3], "order_payments", "2017-01-01", archive=archive)
    assert rows(read_zone(spark, lake_dirs[2], "order_payments").select("order_id")) == [("o1",), ("o7",)]


def test_a_stamp_that_is_no_date_is_in_no_day(spark):
    orders = spark.createDataFrame([("a", "2017-01-01 10:00:00"), ("b", "n/a"), ("c", None), ("d", "2017-02-30 00:00:00")], "order_id string, order_purchase_timestamp string")
    assert rows(slicing.orders_between(orders, "2017-01-01", "2017-12-31").select("order_id")) == [("a",)]


def test_consumed_files_are_archived(spark, lake_dirs, tmp_path):
    archive = str(tmp_path / "archive")
    for day in ("2017-01-01", "2017-01-02"):
        land(lake_dirs[0], day, "order_payments", [payment(1)])
        run_zones(spark, lake_dirs, archive=archive)
    assert len(glob.glob(f"{archive}/**/order_payments.parquet", recursive=True)) >= 1


def test_backfill_fills_every_table_and_can_run_twice(spark, tmp_path):
    source = standin_source(spark, SF_DIR)
    first, last = "1997-03-01", "1997-03-10"
    for _ in range(2):
        slicing.backfill(source, first, last, str(tmp_path))
    slices = slicing.slice_days(source, first, last)
    for table in SOURCE_TABLES:
        stored = read_zone(spark, str(tmp_path), table, source(table).schema)
        assert stored.count() == slices[table].count() > 0
    lake = Lake(spark, lambda table: read_zone(spark, str(tmp_path), table, source(table).schema))
    assert lake.model("fact_shipping_network").count() > 0


def test_writing_days_leaves_other_days_alone(spark, tmp_path):
    frame = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-02")], "v int, d string").selectExpr("v", "cast(d as date) as date")
    write_days(frame, str(tmp_path), "t")
    write_days(frame.where("v = 2").selectExpr("v + 10 as v", "date"), str(tmp_path), "t")
    assert rows(spark.read.parquet(f"{tmp_path}/t").select("v")) == [(1,), (12,)]


def test_gold_from_silver_passes_its_checks(spark, tmp_path):
    """Build all 21 models, read them back, check them, then break one and see the gate close."""
    gold = str(tmp_path / "gold")
    lake = Lake.from_standin(spark, SF_DIR, gold)
    build_gold(lake)
    assert {os.path.basename(p) for p in glob.glob(f"{gold}/*")} == set(GOLD) | {"_releases"}
    direct = Lake.from_standin(spark, SF_DIR)
    for model in ("rpt_customer_rfm", "rpt_seller_performance", "rpt_market_basket", "obt_sales_analytics"):
        assert rows(read_model(spark, gold, model)) == rows(direct.model(model))

    results = check_gold(lake)
    assert results.count() == 17 + 39 + 21
    # The calendar, routes and all others hold; nothing is violated.
    gate(results)
    counted = lake.sql("select (select count(*) from dim_sellers) + (select count(*) from dim_products)", "dim_sellers", "dim_products")
    assert counted.first()[0] == 210

    broken = spark.createDataFrame([(1, "s", "c", "x"), (1, None, "c", "x")], "seller_sk long, seller_id string, seller_city string, seller_state string")
    write_model(broken, gold, "dim_sellers")
    with pytest.raises(ChecksFailed, match=r"dim_sellers.seller_sk: unique \(1\)"):
        gate(run_checks(Lake.from_gold(spark, gold), ["dim_sellers", "dim_date"]))


def test_rebuild_fails_on_bad_data(tables, tmp_path, spark):
    source = standin_source(spark, SF_DIR)
    broken = Lake(spark, lambda t: source(t).where("false") if t == "order_payments" else source(t), str(tmp_path / "gold"))
    with pytest.raises(ChecksFailed, match=r"fact_payments.\*: not_empty"):
        rebuild(broken)
    assert rows(empty_models(broken, ["fact_orders", "fact_payments"])) == [("fact_payments", 0)]


def test_checks_find_seeded_faults(spark):
    frame = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3)], "k string, v int")
    assert rows(duplicate_values(frame, "k")) == [("a", 2)]
    assert rows(null_counts(frame, ["k", "v"])) == [("k", 2), ("v", 1)]
    assert not_empty(frame).count() == 0 and not_empty(frame.where("v > 9")).count() == 1
