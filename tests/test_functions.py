import datetime as dt
import math

from pyspark.sql import functions as F

from lakemart.functions import dates, geo, numbers, text


def one(spark, column, **values):
    kinds = {k: ("timestamp_ntz" if isinstance(v, dt.datetime) else "date" if isinstance(v, dt.date) else None) for k, v in values.items()}
    frame = spark.range(1).select(*[F.lit(str(v)).cast(kinds[k]).alias(k) if kinds[k] else F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first()["x"]


def test_hours_count_boundaries(spark):
    early, late = dt.datetime(2020, 1, 1, 0, 59), dt.datetime(2020, 1, 1, 1, 1)
    hours = dates.hours_crossed(F.col("a"), F.col("b"))
    assert one(spark, hours, a=early, b=late) == 1
    assert one(spark, hours, a=late, b=early) == -1
    assert one(spark, hours, a=dt.datetime(2020, 1, 1, 23, 59), b=dt.datetime(2020, 1, 3, 0, 1)) == 25


def test_days_and_months_count_boundaries(spark):
    assert one(spark, dates.days_crossed(F.col("a"), F.col("b")), a=dt.datetime(2020, 1, 1, 23, 59), b=dt.datetime(2020, 1, 2, 0, 1)) == 1
    assert one(spark, dates.months_crossed(F.col("a"), F.col("b")), a=dt.date(2020, 1, 31), b=dt.date(2020, 2, 1)) == 1
    assert one(spark, dates.months_crossed(F.col("a"), F.col("b")), a=dt.date(2020, 2, 1), b=dt.date(2018, 12, 31)) == -14


def test_weekday_starts_on_sunday(spark):
    assert one(spark, dates.weekday_from_sunday(F.col("d")), d=dt.date(2026, 11, 29)) == 0
    assert one(spark, dates.weekday_from_sunday(F.col("d")), d=dt.date(2026, 12, 5)) == 6


def test_rounding_works_on_the_binary_value(spark):
    assert one(spark, numbers.round_half_away(F.col("x"), 2), x=1.005) == 1.0
    assert one(spark, numbers.round_half_away(F.col("x"), 1), x=-0.25) == -0.3
    assert one(spark, numbers.round_half_away(F.col("x"), 0), x=2.5) == 3.0


def test_int_cast_rounds_ties_to_even(spark):
    assert [one(spark, numbers.to_int_half_even(F.col("x")), x=x) for x in (2.5, 3.5, -2.5, 2.6)] == [2, 4, -2, 3]


def test_ratio_by_zero_is_null(spark):
    assert one(spark, numbers.ratio(F.col("a"), F.col("b")), a=1, b=0) is None
    assert one(spark, numbers.ratio(F.col("a"), F.col("b")), a=1, b=4) == 0.25


def test_payment_labels(spark):
    label = text.payment_label(F.col("c"))
    assert one(spark, label, c="CREDIT_card") == "Credit Card"
    assert one(spark, label, c="not_DEFINED here") == "Not_defined here"
    assert one(spark, label, c="") == ""


def test_great_circle(spark):
    km = geo.great_circle_km(*[F.col(c) for c in "abcd"])
    assert one(spark, km, a=0.0, b=0.0, c=0.0, d=180.0) == 6371 * math.pi
    same = one(spark, km, a=-23.55, b=-46.63, c=-23.55, d=-46.63)
    assert not math.isnan(same) and abs(same) < 0.001


def test_exact_mean_ignores_nulls(spark):
    frame = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    assert frame.agg(numbers.exact_mean(F.col("v"))).first()[0] == 0.15
    assert frame.where("v > 1").agg(numbers.exact_mean(F.col("v"))).first()[0] is None
