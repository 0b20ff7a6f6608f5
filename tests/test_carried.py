"""State carried over days equals a build from all of history."""

import random

import pytest
from pyspark.sql.types import LongType, StructField

from conftest import SF_DIR, rows
from lakemart import Lake
from lakemart.operators.carried import carried_ledger, carry
from lakemart.operators.intervals import open_per_day
from lakemart.plans.backlog import backlog_state, carried_backlog, carry_backlog
from lakemart.sources.schemas import SOURCE_TABLES
from lakemart.sources.standin import standin_source
from lakemart.streaming import ledger as days
from lakemart.streaming.ledger import Batch, DayLedger

INTERVALS = "k long, opened date, closed date, worth double, sign int"


def test_steps_with_corrections_equal_one_sum(spark, tmp_path):
    """Random intervals come day by day, some late, some are taken back; after every step the result is the whole sum."""
    draw = random.Random(3)
    state = carried_ledger(spark, str(tmp_path), StructField("k", LongType()))
    every, today = [], 3
    for step in range(5):
        today += draw.choice([1, 1, 4])
        come = [(draw.randint(1, 3), today, draw.choice([None, today - 2, today, today + draw.randint(1, 6)])) for _ in range(draw.randint(1, 4))]
        come += [(draw.randint(1, 4), draw.randint(1, today), draw.choice([None, today - 1, today + 2])) for _ in range(step % 3)]
        go = draw.sample(every, min(len(every), step % 2 + 1)) if step else []
        go = [g for g in go if g[1] != today]
        made = [(k, f"2020-01-{a:02d}", b and f"2020-01-{b:02d}", k + 0.25, 1) for k, a, b in come]
        made += [(k, f"2020-01-{a:02d}", b and f"2020-01-{b:02d}", k + 0.25, -1) for k, a, b in go]
        for g in go:
            every.remove(g)
        every += come
        text = INTERVALS.replace("opened date, closed date", "opened string, closed string")
        changes = spark.createDataFrame(made, text).selectExpr("k", "cast(opened as date) opened", "cast(closed as date) closed", "worth", "sign")
        assert carry(state, changes, "k", {str(step): 1})[-1] == f"2020-01-{today:02d}"
        whole = spark.createDataFrame([(k, f"2020-01-{a:02d}", b and f"2020-01-{b:02d}", k + 0.25) for k, a, b in every], "k long, opened string, closed string, worth double")
        whole = whole.selectExpr("k", "cast(opened as date) opened", "cast(closed as date) closed", "worth")
        found = state.read("open").selectExpr("k", "date as day", "open_count", "cast(open_amount as double) as open_amount")
        assert rows(found) == rows(open_per_day(whole, "k", "opened", "closed", "worth")), step


def test_losing_the_last_day_asks_for_a_new_build(spark, tmp_path):
    state = carried_ledger(spark, str(tmp_path), StructField("k", LongType()))
    one = spark.sql("select 1L as k, date'2020-01-05' as opened, cast(null as date) as closed, 1.0D as worth, 1 as sign")
    assert carry(state, one.where("false"), "k", {}) == []
    carry(state, one, "k", {})
    with pytest.raises(ValueError, match="anew"):
        carry(state, one.selectExpr("k", "opened", "closed", "worth", "-1 as sign"), "k", {})


def test_backlog_carried_over_days_equals_a_full_build(spark, tmp_path, monkeypatch):
    source = standin_source(spark, SF_DIR)
    ledger = DayLedger(spark, str(tmp_path / "days"), schemas={t: source(t).schema for t in SOURCE_TABLES})
    state = backlog_state(spark, str(tmp_path / "state"))

    def full():
        return rows(Lake.from_days(ledger).model("snapshot_daily_seller_backlog"))

    for _ in range(2):
        days.advance(ledger, source, days=3)
        assert carry_backlog(ledger, state) and rows(carried_backlog(state)) == full()
    assert carry_backlog(ledger, state) == []

    # A day is taken again with other prices and one seller less.
    items = source("order_items")
    changed = items.withColumn("price", items["price"] + 1).where(items["order_item_id"] != 2)
    day = list(ledger.days())[1]
    days.retake(ledger, lambda t: changed if t == "order_items" else source(t), day)
    store, calls = Batch.store, []

    def dies(batch, table, frame):
        if calls:
            raise RuntimeError("lost")
        calls.append(table)
        return store(batch, table, frame)

    before = rows(carried_backlog(state))
    monkeypatch.setattr(Batch, "store", dies)
    with pytest.raises(RuntimeError, match="lost"):
        carry_backlog(ledger, state)
    monkeypatch.setattr(Batch, "store", store)
    assert rows(carried_backlog(state)) == before
    assert min(carry_backlog(ledger, state)) == day
    assert rows(carried_backlog(state)) == full() != before
