"""Keys and sets that are kept: surrogate keys across rebuilds, distinct counts that merge."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from conftest import SF_DIR, rows
from lakemart import Lake
from lakemart.operators import ranking
from lakemart.operators.bitmaps import bitmaps, counted, shared, united
from lakemart.plans import actives
from lakemart.sources import keymap
from lakemart.sources.commits import Conflict
from lakemart.sources.keymap import KeyMap
from lakemart.sources.schemas import SOURCE_TABLES
from lakemart.sources.standin import standin_source
from lakemart.streaming import ledger as days
from lakemart.streaming.ledger import DayLedger


def test_keys_keep_their_numbers_and_new_ones_come_above(spark, tmp_path, monkeypatch):
    keys = KeyMap(spark, str(tmp_path))
    assert keys.read().count() == 0
    first = spark.createDataFrame([(c,) for c in ["m", "b", "x", "b", None]], "k string")
    assert keys.extend(first) == 4 and keys.extend(first) == 0
    assert rows(keys.read()) == rows(spark.createDataFrame([("b", 1), ("m", 2), ("x", 3), (None, 4)], "k string, n long"))
    sorted_rows = []
    monkeypatch.setattr(keymap, "global_row_number", lambda df, *a: sorted_rows.append(df.count()) or ranking.global_row_number(df, *a))
    more = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "k string")
    found = KeyMap(spark, str(tmp_path)).numbered(more, "k", "sk")
    assert rows(found) == [("a", 5), ("b", 1), ("z", 6), (None, 4)] and sorted_rows == [2]  # old keys are not sorted again


def test_a_lost_extension_changes_nothing(spark, tmp_path, monkeypatch):
    keys = KeyMap(spark, str(tmp_path), LongType())
    keys.extend(spark.range(1, 4))
    monkeypatch.setattr(keys.log, "commit", lambda *_: pytest.fail("lost"))
    with pytest.raises(pytest.fail.Exception):
        keys.extend(spark.range(1, 9))
    again = KeyMap(spark, str(tmp_path), LongType())
    assert again.read().count() == 3 and again.extend(spark.range(1, 6)) == 2
    assert sorted(r["number"] for r in again.read().collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(Conflict):
        again.log.commit(2, {})


def test_a_rebuild_with_more_persons_leaves_old_keys(spark, tmp_path):
    source = standin_source(spark, SF_DIR)
    late = F.regexp_extract("customer_unique_id", "[0-9]+", 0).cast("long") % 10 == 0
    few = Lake(spark, lambda t: source(t).where(~late) if t == "customers" else source(t), keys=str(tmp_path)).model("dim_customers")
    before = {r["customer_unique_id"]: r["customer_sk"] for r in few.collect()}
    after = {r["customer_unique_id"]: r["customer_sk"] for r in Lake(spark, source, keys=str(tmp_path)).model("dim_customers").collect()}
    assert len(after) > len(before) and all(after[k] == n for k, n in before.items())
    assert sorted(after.values()) == list(range(1, len(after) + 1))


def test_sets_merge_in_any_order_and_count_exactly(spark):
    draw = random.Random(1)
    made = [(draw.choice("ab"), draw.randint(1, 12), draw.choice([1, 5, 32768, 32769, 65536, 65537, 10**6, draw.randint(1, 200_000)])) for _ in range(400)]
    frame = spark.createDataFrame([*made, ("a", 1, None)], "g string, month int, n long")
    months = bitmaps(frame, ["g", "month"], "n")
    parts = [months.where(f"month % 3 = {p}") for p in (2, 0, 1)]
    merged = united(united(parts[0].unionByName(parts[1]), ["g", "month"]).unionByName(parts[2]).unionByName(parts[0]), ["g", "month"])
    exact = frame.groupBy("g").agg(F.countDistinct("n").alias("c"))
    assert rows(counted(merged, ["g"], "c")) == rows(exact)
    assert rows(counted(merged, ["g", "month"], "c")) == rows(frame.groupBy("g", "month").agg(F.countDistinct("n").alias("c")))
    halves = [merged.where(c).drop("month") for c in ("month <= 6", "month > 6")]
    both = {g: len({n for h, m, n in made if h == g and m <= 6} & {n for h, m, n in made if h == g and m > 6}) for g in "ab"}
    assert dict(rows(shared(*halves, ["g"], "c"))) == both


def test_orders_and_lines_are_joined_once_for_all_numbers(spark, tmp_path):
    """What the key maps number is read from one written table; deliveries told apart give the same sets."""
    lake = Lake.from_standin(spark, SF_DIR)
    sets = actives.month_sets(lake, actives.key_maps(spark, str(tmp_path / "one")))
    scans = re.findall(r"(\w+)\.parquet", sets._jdf.queryExecution().optimizedPlan().toString() + str(sets.inputFiles()))
    assert not {"orders", "lineitem", "customer"} & set(scans)
    members = actives.month_members(lake, (F.length("order_id") % 2).alias("part")).cache()
    keys = actives.key_maps(spark, str(tmp_path / "two"))
    parts = [actives.sets_of(members.where(F.col("part") == p), keys) for p in (1, 0)]
    both = united(parts[0].unionByName(parts[1]), ["month", "what"])
    for what in ("persons", "products"):
        assert rows(actives.monthly_counts(both, what, "n")) == rows(actives.monthly_counts(sets, what, "n")) != []
    assert members.count() > members.drop("part").distinct().count()


def test_months_carried_over_days_equal_a_recount(spark, tmp_path):
    source = standin_source(spark, SF_DIR)
    ledger = DayLedger(spark, str(tmp_path / "days"), schemas={t: source(t).schema for t in SOURCE_TABLES})
    orders = source("orders")
    # Days around the end of a month, so that one month grows and the next begins.
    window = lambda t: orders.where("to_date(order_purchase_timestamp) between '1997-01-27' and '1997-02-06'") if t == "orders" else source(t)
    state, keys = actives.month_state(spark, str(tmp_path / "state")), actives.key_maps(spark, str(tmp_path / "keys"))

    def recount():
        lake = Lake.from_days(ledger)
        months = lake.model("rpt_revenue_trends").select("month", "unique_products_sold")
        return rows(months), rows(lake.model("rpt_cohort_retention"))

    def carried():
        sets = state.read("sets").withColumnRenamed("date", "month")
        return rows(actives.monthly_counts(sets, "products", "n")), rows(actives.retention(sets))

    while days.advance(ledger, window, days=4):
        assert actives.carry_months(ledger, state, keys) and carried() == recount()
    assert actives.carry_months(ledger, state, keys) == []
    day = list(ledger.days())[0]
    fewer = lambda t: source(t).where("order_item_id <> 1") if t == "order_items" else source(t)
    days.retake(ledger, fewer, day)
    assert actives.carry_months(ledger, state, keys) == [f"{day[:7]}-01"] and carried() == recount()
