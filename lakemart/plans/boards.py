"""Report-page aggregates on top of the gold models. Every result is a bounded frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.numbers import exact_mean, money_sum, ratio
from lakemart.operators.report import histogram, profile, repeatable_sample, top_n, value_counts

# Fixed values of the report pages.
GROWTH_FROM_MONTH = "2017-02"
SPEND_BINS = 50
TOP_STATES, TOP_SELLERS, TREEMAP_CATEGORIES, TOP_CATEGORIES = 15, 15, 30, 15
RISKY_CATEGORIES, RISKY_MIN_REVIEWS = 15, 10
TOP_PAIRS = 20
SEGMENT_PREVIEW = 100
SAMPLE_ROWS, SAMPLE_SEED, ROUTE_ROWS = 2000, 42, 2000


def _month_label(column: str) -> Column:
    return F.date_format(column, "yyyy-MM")


# --- executive overview --------------------------------------------------------------------------------------------


def kpi_executive(lake) -> DataFrame:
    """Headline figures in one row. The late rate is over all orders, undelivered ones included."""
    orders = lake.model("fact_orders").agg(
        F.countDistinct("order_id").alias("total_orders"),
        (ratio(F.sum(F.col("is_late").cast("int")), F.count(F.lit(1))) * 100).alias("late_rate"),
    )
    items = lake.model("fact_order_items").agg(
        money_sum(F.col("total_line_value")).alias("revenue"),
        ratio(money_sum(F.col("total_line_value")), F.count("total_line_value")).alias("mean_line"),
    )
    days = lake.model("fact_order_lifecycle").agg(exact_mean(F.col("total_delivery_days"), 0).alias("mean_days"))
    # A surrogate key is one number per natural key, so the keys are counted without building the dimensions.
    customers = lake.model("stg_customers").agg(F.countDistinct("customer_unique_id").alias("n"))
    sellers = lake.source("sellers").agg(F.countDistinct("seller_id").alias("n"))
    return orders.select(
        "total_orders",
        "late_rate",
        days.scalar().alias("avg_delivery_days"),
        items.select("revenue").scalar().alias("total_revenue"),
        items.select("mean_line").scalar().alias("avg_order_value"),
        customers.scalar().alias("total_customers"),
        sellers.scalar().alias("total_sellers"),
    )


def revenue_trend_series(lake) -> DataFrame:
    return (
        lake.model("rpt_revenue_trends")
        .orderBy("month")
        .select(
            _month_label("month").alias("month_label"),
            "total_revenue",
            "revenue_growth_pct",
            "rolling_3m_avg_revenue",
            "cumulative_revenue",
            "total_orders",
            "unique_customers",
        )
    )


def revenue_growth_series(lake, from_month: str = GROWTH_FROM_MONTH) -> DataFrame:
    """Growth without the first months, whose tiny base distorts it."""
    series = revenue_trend_series(lake).where(F.col("month_label") >= from_month)
    return series.select("month_label", "revenue_growth_pct")


# --- customers -----------------------------------------------------------------------------------------------------


def rfm_segment_counts(lake) -> DataFrame:
    return value_counts(lake.model("rpt_customer_rfm"), "rfm_segment", "segment", "customers")


def rfm_scatter_points(lake) -> DataFrame:
    points = lake.model("rpt_customer_rfm").dropna(subset=["monetary", "frequency", "rfm_avg"])
    return points.select("customer_id", "recency_days", "monetary", "frequency", "rfm_avg", "rfm_segment")


def rfm_segment_table(lake, segment: str | None = None, rows: int = SEGMENT_PREVIEW) -> DataFrame:
    """First rows of one segment, or of all."""
    table = lake.model("rpt_customer_rfm")
    if segment is not None:
        table = table.where(F.col("rfm_segment") == segment)
    return table.orderBy("customer_id").limit(rows)


def ltv_kpis(lake) -> DataFrame:
    return lake.model("rpt_customer_ltv").agg(
        exact_mean(F.col("total_spend")).alias("avg_ltv"),
        exact_mean(F.col("tenure_months"), 0).alias("avg_tenure_months"),
        F.count_if(F.col("ltv_tier") == "High Value").alias("high_value_customers"),
    )


def ltv_tier_counts(lake) -> DataFrame:
    return value_counts(lake.model("rpt_customer_ltv"), "ltv_tier", "tier", "customers")


def spend_histogram(lake, bins: int = SPEND_BINS) -> DataFrame:
    return histogram(lake.model("rpt_customer_ltv"), "total_spend", bins)


def ltv_by_state(lake, states: int = TOP_STATES) -> DataFrame:
    known = lake.model("rpt_customer_ltv").where(F.col("customer_state").isNotNull())
    means = known.groupBy("customer_state").agg(
        exact_mean(F.col("total_spend")).alias("avg_spend"), F.count("customer_id").alias("customers")
    )
    return top_n(means, states, "avg_spend", ["customer_state"])


def cohort_matrix(lake, offsets: list[int] | None = None) -> DataFrame:
    """Cohorts by month offset. Without ``offsets`` the ones present are looked up first (bounded by the calendar)."""
    cohorts = lake.model("rpt_cohort_retention").withColumn("offset", F.format_string("m%02d", "months_since_first"))
    labels = None if offsets is None else [f"m{offset:02d}" for offset in offsets]
    return (
        cohorts.groupBy(_month_label("cohort_month").alias("cohort"))
        .pivot("offset", labels)
        .agg(F.first("retention_pct", ignorenulls=True))
        .orderBy("cohort")
    )


def cohort_sizes(lake) -> DataFrame:
    starts = lake.model("rpt_cohort_retention").where(F.col("months_since_first") == 0)
    return starts.select(_month_label("cohort_month").alias("cohort"), "cohort_customers")


# --- sellers -------------------------------------------------------------------------------------------------------


def seller_kpis(lake) -> DataFrame:
    return lake.model("rpt_seller_performance").agg(
        F.count(F.lit(1)).alias("sellers"),
        exact_mean(F.col("total_revenue")).alias("avg_revenue"),
        exact_mean(F.col("avg_review_score")).alias("avg_review_score"),
        exact_mean(F.col("avg_delivery_days"), 1).alias("avg_delivery_days"),
    )


def top_sellers(lake, n: int = TOP_SELLERS) -> DataFrame:
    return top_n(lake.model("rpt_seller_performance"), n, "total_revenue", ["seller_id"])


def seller_state_rollup(lake) -> DataFrame:
    known = lake.model("rpt_seller_performance").where(F.col("seller_state").isNotNull())
    return (
        known.groupBy("seller_state")
        .agg(
            F.sum("total_revenue").alias("revenue"),
            F.count("seller_id").alias("sellers_count"),
            exact_mean(F.col("avg_review_score")).alias("avg_score"),
        )
        .orderBy(F.col("revenue").desc(), "seller_state")
    )


# --- categories ----------------------------------------------------------------------------------------------------


def category_kpis(lake) -> DataFrame:
    return lake.model("rpt_product_category_analysis").agg(
        F.count(F.lit(1)).alias("categories"),
        F.sum("total_revenue").alias("total_revenue"),
        exact_mean(F.col("avg_review_score")).alias("avg_review_score"),
    )


def top_categories(lake, n: int = TREEMAP_CATEGORIES) -> DataFrame:
    return top_n(lake.model("rpt_product_category_analysis"), n, "total_revenue", ["product_category_name"])


def risky_categories(lake, n: int = RISKY_CATEGORIES, min_reviews: int = RISKY_MIN_REVIEWS) -> DataFrame:
    reviewed = lake.model("rpt_product_category_analysis").where(F.col("total_reviews") >= min_reviews)
    return top_n(reviewed, n, "low_review_pct", ["product_category_name"])


# --- shipping ------------------------------------------------------------------------------------------------------


def shipping_kpis(lake) -> DataFrame:
    return lake.model("rpt_shipping_efficiency").agg(
        F.count(F.lit(1)).alias("deliveries"),
        (ratio(F.count_if("is_late"), F.count(F.lit(1))) * 100).alias("late_rate"),
        exact_mean(F.col("total_delivery_days"), 0).alias("avg_delivery_days"),
        F.avg("distance_km").alias("avg_distance_km"),
    )


def delivery_bucket_counts(lake) -> DataFrame:
    return value_counts(lake.model("rpt_shipping_efficiency"), "delivery_bucket", "bucket", "deliveries")


def distance_bucket_counts(lake) -> DataFrame:
    return value_counts(lake.model("rpt_shipping_efficiency"), "distance_bucket", "bucket", "deliveries")


def distance_vs_days_sample(lake, rows: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED) -> DataFrame:
    points = lake.model("rpt_shipping_efficiency").select("order_id", "distance_km", "total_delivery_days", "is_late")
    return repeatable_sample(points, rows, "order_id", seed)


def longest_route(lake) -> DataFrame:
    return lake.model("fact_shipping_network").agg(F.max("distance_km").alias("max_distance_km"))


def routes_within(lake, max_km: float, rows: int = ROUTE_ROWS) -> DataFrame:
    """Coordinates of routes up to a distance; the first ``rows`` in coordinate order."""
    near = lake.model("fact_shipping_network").where(F.col("distance_km") <= max_km)
    spots = ["cust_lng", "cust_lat", "sell_lng", "sell_lat"]
    return near.select(*spots).orderBy(*spots).limit(rows)


# --- market basket -------------------------------------------------------------------------------------------------


def _pair_label() -> Column:
    return F.concat_ws(" + ", "category_a", "category_b").alias("pair")


def basket_kpis(lake) -> DataFrame:
    """Number of pairs, the strongest one (first by name on a tie) and its count."""
    pairs = lake.model("rpt_market_basket")
    by_count = pairs.groupBy("co_occurrence_count").agg(
        F.count(F.lit(1)).alias("pairs"), F.min(F.struct("category_a", "category_b")).alias("first")
    )
    label = F.concat_ws(" + ", "best.category_a", "best.category_b")
    return by_count.agg(
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs_found"),
        F.max_by("first", "co_occurrence_count").alias("best"),
        F.max("co_occurrence_count").alias("top_co_occurrences"),
    ).select("pairs_found", F.when(F.col("best").isNotNull(), label).alias("strongest_pair"), "top_co_occurrences")


def top_pairs(lake, n: int = TOP_PAIRS) -> DataFrame:
    """The ``n`` most frequent pairs, listed by similarity."""
    best = top_n(lake.model("rpt_market_basket"), n, "co_occurrence_count", ["category_a", "category_b"])
    ranked = best.select(_pair_label(), "co_occurrence_count", "jaccard_similarity")
    return ranked.orderBy(F.col("jaccard_similarity").desc(), "pair")


# --- data explorer -------------------------------------------------------------------------------------------------


def table_preview(lake, model: str, rows: int = 100) -> DataFrame:
    """First rows of a model in the order of its columns."""
    table = lake.model(model)
    return table.orderBy(*table.columns).limit(rows)


def table_profile(lake, model: str, rows: int | None = None) -> DataFrame:
    """Column types and counts of a model, or of its preview when ``rows`` is given."""
    return profile(lake.model(model) if rows is None else table_preview(lake, model, rows))
