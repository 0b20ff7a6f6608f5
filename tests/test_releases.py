"""Day ledger, releases of gold, and checks measured while a model is written."""

import glob
import os

import pytest

from conftest import SF_DIR, rows
from lakemart import Lake
from lakemart.plans import GOLD, checks
from lakemart.plans.checks import ChecksFailed, gate, run_checks
from lakemart.plans.pipeline import build_gold, rebuild, stage_gold
from lakemart.session import materialize, scratch_root, scratch_scope
from lakemart.sources import slicing
from lakemart.sources.commits import CommitLog, Conflict
from lakemart.sources.files import read_model, write_model
from lakemart.sources.releases import Releases
from lakemart.sources.schemas import REFERENCE_TABLES, SOURCE_TABLES
from lakemart.sources.standin import standin_source
from lakemart.streaming import ledger as days
from lakemart.streaming.ledger import Batch, DayLedger


def test_commits_are_whole_numbered_and_never_replaced(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() == (0, None) and log.entries() == []
    for n in (1, 2):
        assert log.commit(n, {"n": n, "text": 'ä"'}) == n
    with pytest.raises(Conflict):
        log.commit(2, {"n": 9})
    assert log.latest() == (2, {"n": 2, "text": 'ä"'}) and [n for n, _ in log.entries()] == [1, 2]
    assert sorted(p for p in os.listdir(tmp_path / "log") if not p.startswith(".")) == ["000000000001.json", "000000000002.json"]


# --- days -----------------------------------------------------------------------------------------------------------


@pytest.fixture
def source(spark):
    return standin_source(spark, SF_DIR)


def ledger_at(spark, path, source):
    return DayLedger(spark, str(path), schemas={t: source(t).schema for t in SOURCE_TABLES})


def all_days(source):
    orders = source("orders")
    return [str(r[0]) for r in orders.select(slicing.order_day(orders).alias("d")).distinct().orderBy("d").collect()]


def changed(source, table, change):
    """The same source but for one table."""
    return lambda t: change(source(t)) if t == table else source(t)


def files_of(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_a_run_that_dies_between_tables_shows_no_half_day(spark, tmp_path, source, monkeypatch):
    ledger = ledger_at(spark, tmp_path / "bronze", source)
    known = all_days(source)
    assert days.advance(ledger, source, days=2) == known[:2] and ledger.cursor() == known[1]
    before = rows(ledger.read("order_items"))

    store, calls = Batch.store, []

    def dies(batch, table, frame):
        if len(calls) == 5:
            raise RuntimeError("lost")
        calls.append(table)
        return store(batch, table, frame)

    monkeypatch.setattr(Batch, "store", dies)
    with pytest.raises(RuntimeError, match="lost"):
        days.advance(ledger, source, days=2)
    monkeypatch.setattr(Batch, "store", store)
    # Five of nine tables are there, and nobody sees them.
    assert ledger.cursor() == known[1] and rows(ledger.read("order_items")) == before
    assert set(ledger.pending().stored()) == set(calls)
    assert rows(Lake.from_days(ledger).model("fact_orders").select("date_key").distinct()) == rows(
        spark.createDataFrame([(d,) for d in known[:2]], "d string").selectExpr("cast(d as date)")
    )
    with pytest.raises(ValueError, match="lacks"):
        ledger.pending().commit()
    with pytest.raises(Conflict):
        ledger.begin([known[9]])

    written = files_of(tmp_path / "bronze")
    # Another process goes on: the days of the lost run come first, and its tables are not written again.
    assert days.advance(ledger_at(spark, tmp_path / "bronze", source), source, days=1) == known[2:4]
    after = files_of(tmp_path / "bronze")
    assert all(after[p] == written[p] for p in written) and len(after) > len(written)
    assert ledger.cursor() == known[3] and ledger.pending() is None
    expected = slicing.slice_days(source, known[0], known[3])
    for table in SOURCE_TABLES:
        stored = ledger.read(table)
        if table in REFERENCE_TABLES:
            assert rows(stored.drop("date")) == rows(source(table))
        else:
            assert rows(stored.select(sorted(stored.columns))) == rows(expected[table].select(sorted(stored.columns)))


def test_the_cursor_passes_days_without_orders_and_stops_at_the_end(spark, tmp_path, source):
    known = all_days(source)
    few = changed(source, "orders", lambda o: o.where(slicing.order_day(o).cast("string").isin(known[0], known[7])))
    ledger = ledger_at(spark, tmp_path, source)
    assert [days.advance(ledger, few) for _ in range(3)] == [[known[0]], [known[7]], []]
    assert list(ledger.days()) == [known[0], known[7]]
    assert not glob.glob(f"{tmp_path}/orders/*/date={known[1]}")
    assert days.advance(ledger_at(spark, tmp_path / "none", source), lambda t: source(t).where("false")) == []


def test_a_day_taken_again_is_replaced_as_a_whole_and_reaches_the_next_zone(spark, tmp_path, source):
    known = all_days(source)
    twice = changed(source, "order_items", lambda i: i.union(i))
    bronze, silver = (ledger_at(spark, tmp_path / z, source) for z in ("bronze", "silver"))
    days.advance(bronze, twice, days=2)
    assert days.promote(bronze, silver) == known[:2] and days.promote(bronze, silver) == []
    assert rows(silver.read("order_items").select("order_id")) == rows(bronze.read("order_items").distinct().select("order_id"))

    reader = bronze.source()  # knows the days as they are now
    old = rows(reader("order_items"))
    cheaper = changed(source, "order_items", lambda i: i.withColumn("price", i["price"] * 0 + 1.0))
    assert days.retake(bronze, cheaper, known[1]) == [known[1]]
    assert rows(reader("order_items")) == old
    again = bronze.read("order_items", days=[known[1]])
    assert rows(again.select("price").distinct()) == [(1.0,)] and len(rows(bronze.read("order_items"))) < len(old)
    assert days.promote(bronze, silver) == [known[1]]
    assert rows(silver.read("order_items").where("price = 1.0").select("date").distinct()) == rows(again.select("date").distinct())
    assert bronze.vacuum() and rows(bronze.read("order_items", days=[known[1]])) == rows(again)
    assert bronze.vacuum() == [] and bronze.cursor() == known[1]


# --- releases -------------------------------------------------------------------------------------------------------


def test_a_failed_publish_leaves_the_last_version(spark, tmp_path):
    gold = str(tmp_path)
    one, two = (spark.range(n).toDF("k") for n in (3, 5))
    write_model(one, gold, "m")
    with pytest.raises(Exception, match="DIVIDE|divide"):
        write_model(two.selectExpr("k div (k - 4) as k"), gold, "m")
    assert read_model(spark, gold, "m").count() == 3
    releases = Releases(spark, gold)
    assert releases.current()[0] == 1 and len(releases.abandoned()) == 1


def test_a_reader_sees_one_release_during_a_publish(spark, tmp_path):
    gold = str(tmp_path)
    releases = Releases(spark, gold)
    for version in (1, 2):
        staged = {name: releases.stage(spark.range(version).toDF("k"), name) for name in ("a", "b")}
        if version == 2:
            # Both are written, neither is visible, to old readers and new ones.
            assert [Lake.from_gold(spark, gold).model(m).count() for m in ("a", "b")] == [1, 1]
        releases.release(staged)
        if version == 1:
            reader = Lake.from_gold(spark, gold)
    assert [reader.model(m).count() for m in ("a", "b")] == [1, 1]
    assert [Lake.from_gold(spark, gold).model(m).count() for m in ("a", "b")] == [2, 2]
    releases.release({"a": releases.stage(spark.range(7).toDF("k"), "a")})
    assert [Lake.from_gold(spark, gold).model(m).count() for m in ("a", "b")] == [7, 2]
    with pytest.raises(Conflict):
        releases.release({}, after=1)
    # Two releases stay; only the folders of the first that no other names go.
    assert sorted(f.split("/")[0] for f in releases.expire(keep=2)) == ["a", "b"]
    assert [releases.read(f).count() for f in releases.current()[1].values()] == [7, 2]
    assert [n for n, _ in releases.log.entries()] == [2, 3] and releases.expire(keep=2) == []


def test_a_rebuild_that_fails_its_checks_changes_nothing(spark, tmp_path):
    gold = str(tmp_path)
    source = standin_source(spark, SF_DIR)
    write_model(spark.range(2).toDF("k"), gold, "fact_payments")
    broken = Lake(spark, lambda t: source(t).where("false") if t == "order_payments" else source(t), gold)
    scratch = set(os.listdir(scratch_root(spark)))
    with pytest.raises(ChecksFailed, match=r"fact_payments.\*: not_empty \(1\)"):
        rebuild(broken)
    assert set(os.listdir(scratch_root(spark))) <= scratch  # no scratch tables are left
    assert read_model(spark, gold, "fact_payments").count() == 2 and set(Releases(spark, gold).current()[1]) == {"fact_payments"}
    assert len(Releases(spark, gold).abandoned()) == len(GOLD)
    # What it has not written it can still build.
    assert broken.model("stg_orders").count() > 0


def test_a_build_that_lost_a_race_publishes_nothing(spark, tmp_path, monkeypatch):
    gold = str(tmp_path)
    monkeypatch.setattr("lakemart.plans.pipeline.GOLD", ["dim_geolocation"])
    lake = Lake.from_standin(spark, SF_DIR, gold)
    lake.release_read()
    stage_gold(lake)
    write_model(spark.range(1).toDF("k"), gold, "other")
    with pytest.raises(Conflict):
        lake.release()
    assert set(Releases(spark, gold).current()[1]) == {"other"}
    fresh = Lake.from_standin(spark, SF_DIR, gold)
    build_gold(fresh)
    assert set(Releases(spark, gold).current()[1]) == {"other", "dim_geolocation"}


# --- checks measured by the write -----------------------------------------------------------------------------------


def test_writes_measure_nulls_and_rows(spark, tmp_path, tables, monkeypatch):
    lake = tables(str(tmp_path), order_payments=("order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double", [("a", 1, "x", 1, 2.0), (None, 1, "x", 1, None), (None, 1, "x", 1, 1.0)]))
    lake.stage("fact_payments")
    assert lake.measured["fact_payments"] == {"rows": 3, "order_id": 2, "payment_value": 1}
    # No second look at the rows: the results come from the write.
    monkeypatch.setattr(checks, "_single_pass", lambda *_: pytest.fail("scanned"))
    found = rows(run_checks(lake, ["fact_payments"]))
    assert found == [("fact_payments", "not_empty", None, 0), ("fact_payments", "not_null", "order_id", 2), ("fact_payments", "not_null", "payment_value", 1)]
    with pytest.raises(ChecksFailed, match=r"fact_payments.order_id: not_null \(2\)"):
        gate(run_checks(lake, ["fact_payments"]))


def test_emptiness_builds_no_ranked_model(spark, monkeypatch):
    lake = Lake.from_standin(spark, SF_DIR)
    for name in ("lakemart.plans.products.global_ntiles", "lakemart.plans.products.global_ntile", "lakemart.plans.dims.global_row_number", "lakemart.plans.facts.open_per_day"):
        monkeypatch.setattr(name, lambda *_: pytest.fail("ranked"))
    assert rows(checks.empty_models(lake, list(GOLD))) == []
    source = standin_source(spark, SF_DIR)
    bare = Lake(spark, lambda t: source(t).where("false") if t == "order_items" else source(t))
    empty = {r[0] for r in rows(checks.empty_models(bare, list(GOLD)))}
    assert {"rpt_customer_rfm", "rpt_customer_ltv", "snapshot_daily_seller_backlog", "fact_order_items"} <= empty and "fact_orders" not in empty


def test_scratch_scopes_delete_their_own_tables_only(spark):
    outer = materialize(spark.range(3), "outer")
    with pytest.raises(RuntimeError), scratch_scope(spark):
        inner = materialize(spark.range(4), "inner")
        assert inner.count() == 4
        raise RuntimeError
    assert outer.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FAILED_READ|not exist"):
        inner.count()
