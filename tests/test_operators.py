"""Operators against brute force, with one key holding a third of the rows where that matters."""

import datetime as dt
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakemart.operators import baskets, intervals, keys, ranking, report


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_first_per_key_takes_the_smallest_with_nulls_last(spark):
    frame = spark.createDataFrame([("a", None), ("a", "z"), ("a", "b"), ("b", None)], "k string, v string")
    assert rows(keys.first_per_key(frame, "k", ["v"])) == [("a", "b"), ("b", None)]


def test_first_per_key_reduces_before_the_shuffle(spark):
    frame = spark.range(10000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id")
    plan = final_plan(keys.first_per_key(frame, "k", ["id"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("how, key_type", [("inner", "string"), ("left", "string"), ("inner", "int")])
def test_hot_key_join_is_split(spark, setting, how, key_type):
    setting(
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes=20000,
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes=20000,
        adaptive__forceOptimizeSkewedJoin="true",
    )
    facts = spark.range(120000).selectExpr(f"cast(if(id % 3 = 0, 7, id % 4000) as {key_type}) as k", "id", "hash(id) as v").repartition(16)
    grouped = spark.range(8000).selectExpr(f"cast(id % 4000 as {key_type}) as k").groupBy("k").count()
    joined = keys.join_to_grouped(facts, grouped, "k", how)
    totals = joined.groupBy((F.col("id") % 7).alias("g")).agg(F.countDistinct("k").alias("n"), F.sum("count").alias("s"))
    assert "skew=true" in final_plan(totals)
    plain = facts.join(grouped, "k", how).groupBy((F.col("id") % 7).alias("g")).agg(F.countDistinct("k"), F.sum("count"))
    assert rows(totals) == rows(plain)


@pytest.mark.parametrize("size, tiles", [(1, 5), (4, 5), (13, 5), (1000, 7)])
def test_ntile_with_heavy_ties_and_nulls(spark, size, tiles):
    random.seed(size)
    data = [(f"id{i:05d}", None if i % 11 == 0 else 1 if i % 10 else random.randint(0, 50)) for i in range(size)]
    frame = spark.createDataFrame(data, "id string, v int").repartition(8)
    found = dict(rows(ranking.global_ntile(frame, "t", tiles, [F.col("v").asc_nulls_last(), F.col("id")]).select("id", "t")))
    ordered = [k for k, _ in sorted(data, key=lambda r: (r[1] is None, r[1] or 0, r[0]))]
    base, extra = divmod(size, tiles)
    expected, at = {}, 0
    for tile in range(1, tiles + 1):
        for _ in range(base + (tile <= extra)):
            expected[ordered[at]] = tile
            at += 1
    assert found == expected


def test_row_numbers_are_dense_over_many_partitions(spark, setting):
    setting(adaptive__coalescePartitions__enabled="false")
    frame = spark.range(5000).selectExpr("cast(id as string) as k", "if(id % 10 < 9, 1, id) as v")
    numbered = ranking.global_row_number(frame, "n", [F.col("v").asc(), F.col("k").asc()]).collect()
    assert [r["n"] for r in sorted(numbered, key=lambda r: (r["v"], r["k"]))] == list(range(1, 5001))


def test_ranking_never_collects_into_one_task(spark):
    frame = spark.range(1000).selectExpr("cast(id as string) as k", "id % 3 as v")
    plan = final_plan(ranking.global_ntile(frame, "t", 5, [F.col("v").asc(), F.col("k").asc()]))
    # The only single-task window runs over the per-partition counts.
    assert plan.count("SinglePartition") == 1 and "_size" in plan


def test_open_per_day_equals_brute_force(spark):
    random.seed(3)
    base = dt.date(2020, 2, 20)
    spans = []
    for i in range(300):
        start = base + dt.timedelta(days=random.randint(0, 30))
        end = None if i % 7 == 0 else start + dt.timedelta(days=random.randint(-3, 12))
        spans.append(("hot" if i % 3 == 0 else f"k{i % 20}", start, end, random.randint(1, 9999) / 100))
    last = max(s[1] for s in spans)
    expected = {}
    for key, start, end, amount in spans:
        day = start
        while day <= min(end or last, last):
            n, total = expected.get((key, day), (0, 0))
            expected[key, day] = (n + 1, total + round(amount * 100))
            day += dt.timedelta(days=1)
    frame = spark.createDataFrame(spans, "k string, s date, e date, a double")
    found = intervals.open_per_day(frame, "k", "s", "e", "a").collect()
    assert {(r["k"], r["day"]): (r["open_count"], round(r["open_amount"] * 100)) for r in found} == expected
    assert len(found) == len(expected)


def test_pairs_equal_brute_force(spark):
    random.seed(5)
    lines = [(f"o{random.randint(0, 60)}" if i % 3 else "hot", random.choice("abcdefgh")) for i in range(900)]
    lines += [(None, "a"), ("o1", None)]
    orders = {}
    for order, value in lines:
        if order and value:
            orders.setdefault(order, set()).add(value)
    expected = Counter(p for values in orders.values() for p in combinations(sorted(values), 2))
    made = baskets.weighted_baskets(spark.createDataFrame(lines, "o string, v string"), "o", "v")
    assert {(r[0], r[1]): r[2] for r in baskets.pair_totals(made, "l", "r", "n").collect()} == expected
    singles = Counter(v for values in orders.values() for v in values)
    assert dict(rows(baskets.value_totals(made, "v", "n"))) == singles


def test_histogram_edges(spark):
    frame = spark.createDataFrame([(0.0,), (9.99,), (10.0,), (100.0,), (None,)], "v double")
    assert rows(report.histogram(frame, "v", 10)) == [(1, 2), (10, 1), (2, 1)]
    same = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert rows(report.histogram(same, "v", 10)) == [(1, 2)]


def test_sample_does_not_depend_on_partitioning(spark):
    frame = spark.range(1000).selectExpr("id", "id % 7 as v")
    few, many = (report.repeatable_sample(frame.repartition(n), 50, "id", 42) for n in (1, 13))
    assert rows(few) == rows(many) and few.count() == 50
    assert rows(report.repeatable_sample(frame, 50, "id", 43)) != rows(few)


def test_top_n_puts_nulls_last(spark):
    frame = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 3)], "k string, v int")
    assert [r["k"] for r in report.top_n(frame, 3, "v", ["k"]).collect()] == ["c", "d", "a"]


def test_profile_counts(spark):
    frame = spark.createDataFrame([("a", 1), ("a", None), (None, None)], "k string, v int")
    assert rows(report.profile(frame)) == [("k", "string", 3, 2, 2, 1), ("v", "int", 3, 2, 1, 1)]


@pytest.mark.parametrize(("count", "tiles"), [(0, 5), (3, 5), (5, 5), (47, 5), (200, 7)])
def test_several_tiles_equal_single_ones(spark, count, tiles):
    """Ties, NULLs, one value that holds nearly all rows, fewer rows than tiles, and an empty frame."""
    draw = random.Random(count)
    made = [(f"k{i * 7919 % 1000:03d}", draw.choice([1, 1, 1, 1, 1, 1, 2, 3, None]), draw.choice([10, 11, 12, None]), draw.choice([0.25, 1.5, draw.random(), None])) for i in range(count)]
    frame = spark.createDataFrame(made, "k string, often int, day int, money double")
    columns = {"often": F.col("often"), "day": -F.col("day")}
    found = ranking.global_ntiles(frame, "k", tiles, {f"{c}_tile": v for c, v in columns.items()}, {"money_tile": F.col("money").cast("decimal(18,4)")})
    expected = {}
    for name, place in (("often_tile", lambda r: r[1]), ("day_tile", lambda r: None if r[2] is None else -r[2]), ("money_tile", lambda r: None if r[3] is None else round(r[3], 4))):
        order = sorted(made, key=lambda r, place=place: (place(r) is None, place(r) or 0, r[0]))
        for index, row in enumerate(order):
            small, large = divmod(len(order), tiles)
            tile = index // (small + 1) if index < large * (small + 1) else large + (index - large * (small + 1)) // small
            expected.setdefault(row[0], {})[name] = tile + 1
    assert {r["k"]: {n: r[n] for n in ("often_tile", "day_tile", "money_tile")} for r in found.collect()} == expected
    assert found.columns[:4] == frame.columns
