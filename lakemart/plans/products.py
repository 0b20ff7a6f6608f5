"""Data products: the wide sales table and eight reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.dates import days_crossed, month_start, months_crossed
from lakemart.functions.numbers import money, money_sum, ratio, round_half_away
from lakemart.operators.baskets import pair_totals, value_totals, weighted_baskets
from lakemart.operators.keys import join_to_grouped, mark_first
from lakemart.operators.ranking import global_ntile, global_ntiles
from lakemart.plans.facts import DELIVERED, SLOW

# Fixed values of the business rules.
RFM_TILES, LTV_TILES = 5, 10
MIN_CO_OCCURRENCE = 5
LOW_SCORE = 2
ROLLING_MONTHS = 3


def _delivered_orders(lake) -> DataFrame:
    return lake.model("fact_orders").where(F.col("order_status") == DELIVERED)


def _persons(lake) -> DataFrame:
    """customer_id is issued per order; the person behind it is customer_unique_id."""
    return lake.model("stg_customers").select("customer_id", F.col("customer_unique_id").alias("person"))


def _places(lake) -> DataFrame:
    return lake.attributes("dim_customers").withColumnRenamed("customer_unique_id", "customer_id")


def _sales_per_order(lake) -> DataFrame:
    """Line values summed per order before any join, so that an order with very many lines joins as one row."""
    return lake.model("fact_order_items").groupBy("order_id").agg(
        F.sum(money(F.col("total_line_value"))).alias("line_sum"), F.count("total_line_value").alias("line_count")
    )


def delivered_sales(lake) -> DataFrame:
    """One row per delivered order with lines, its person and the sums of its lines."""
    return _delivered_orders(lake).join(_persons(lake), "customer_id").join(_sales_per_order(lake), "order_id")


def _reviews_per_order(lake) -> DataFrame:
    return lake.model("fact_reviews").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_rows"),
        F.count("review_id").alias("reviews"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_count"),
        F.count_if(F.col("review_score") <= LOW_SCORE).alias("low_scores"),
    )


def obt_sales_analytics(lake) -> DataFrame:
    """One row per order line with everything known about its order, buyer, product and seller."""
    buyers = lake.model("stg_customers").select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    orders = lake.model("fact_orders").withColumnRenamed("date_key", "order_date").join(buyers, "customer_id")
    lines = lake.model("fact_order_items").drop("total_line_value")
    products, sellers = lake.attributes("dim_products"), lake.attributes("dim_sellers")
    if lake.buckets and lake.is_written("fact_order_items"):
        # Lines that are laid out by order stay where they are for the order's columns; products, the widest, come last.
        lines = join_to_grouped(join_to_grouped(lines.join(orders, "order_id"), sellers, "seller_id"), products, "product_id")
    else:
        # The order's columns are the most: lines move for products and sellers while they are narrow.
        lines = join_to_grouped(join_to_grouped(lines, products, "product_id"), sellers, "seller_id").join(orders, "order_id")
    return lines.withColumn("total_line_value", F.col("item_price") + F.col("freight_value")).select(
        "order_id", "order_item_id", "product_id", "seller_id", "item_price", "freight_value", "total_line_value",
        "customer_id", "order_status", "order_date", "is_late",
        "customer_unique_id", "customer_city", "customer_state",
        "product_category_name", "volume_cm3", "product_weight_g",
        "seller_city", "seller_state",
    )


def rpt_customer_rfm(lake) -> DataFrame:
    """Recency, frequency and money quintiles per person with delivered sales, and the segment they imply."""
    scored = delivered_sales(lake).groupBy(F.col("person").alias("customer_id")).agg(
        F.countDistinct("order_id").alias("frequency"),
        F.max("date_key").alias("last_order_date"),
        F.sum("line_sum").alias("monetary"),
    )
    # The longest silence comes first, i.e. the oldest last order: no need to know the newest date for the tiles. Days
    # and order counts take few values; only money needs a rank for every person.
    few = {"r_score": F.unix_date("last_order_date"), "f_score": F.col("frequency")}
    scored = global_ntiles(scored, "customer_id", RFM_TILES, few, {"m_score": F.col("monetary")})

    newest = scored.agg(F.max("last_order_date")).scalar()
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "New Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("Other")
    )
    return scored.join(_places(lake), "customer_id").select(
        "customer_id",
        "customer_city",
        "customer_state",
        days_crossed(F.col("last_order_date"), newest).alias("recency_days"),
        "frequency",
        round_half_away(F.col("monetary").cast("double"), 2).alias("monetary"),
        r,
        f,
        m,
        round_half_away((r + f + m) / F.lit(3.0), 2).alias("rfm_avg"),
        segment.alias("rfm_segment"),
    )


def rpt_seller_performance(lake) -> DataFrame:
    """Sales, delivery and review figures per seller; delivery and reviews are weighted by order lines."""
    deliveries = lake.model("fact_order_lifecycle").select(
        "order_id",
        "total_delivery_days",
        F.when(F.col("approval_efficiency") == SLOW, 1).otherwise(0).alias("slow"),
    )
    reviews = lake.model("fact_reviews").select(
        "order_id", "review_score", F.when(F.col("review_id").isNotNull(), 1).otherwise(0).alias("review")
    )
    # One row per order with both sets of figures, from one exchange. A figure stays NULL where its side has no row.
    per_order = deliveries.unionByName(reviews, allowMissingColumns=True).groupBy("order_id").agg(
        F.sum("total_delivery_days").alias("days_sum"),
        F.count("total_delivery_days").alias("days_count"),
        F.sum("slow").alias("slow"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_count"),
        F.sum("review").alias("reviews"),
    )
    lines = lake.model("fact_order_items").select("order_id", "seller_id", "item_price", "total_line_value")
    lines = join_to_grouped(mark_first(lines, ["order_id", "seller_id"], "first"), per_order, "order_id", "left")
    totals = lines.groupBy("seller_id").agg(
        F.count_if(F.col("first") & F.col("order_id").isNotNull()).alias("total_orders"),
        F.count(F.lit(1)).alias("total_items_sold"),
        round_half_away(money_sum(F.col("total_line_value")), 2).alias("total_revenue"),
        round_half_away(ratio(money_sum(F.col("item_price")), F.count("item_price")), 2).alias("avg_item_price"),
        round_half_away(ratio(F.sum("days_sum"), F.sum("days_count")), 1).alias("avg_delivery_days"),
        F.sum("slow").alias("slow_approvals"),
        round_half_away(ratio(F.sum("score_sum"), F.sum("score_count")), 2).alias("avg_review_score"),
        F.sum("reviews").alias("total_reviews"),
    )
    figures = [c for c in totals.columns if c != "seller_id"]
    return totals.join(lake.attributes("dim_sellers"), "seller_id").select(
        "seller_id", "seller_city", "seller_state", *figures
    )


def rpt_product_category_analysis(lake) -> DataFrame:
    """Sales and review figures per category. A line counts once per review of its order, or once without any."""
    categories = lake.attributes("dim_products").select("product_id", "product_category_name")
    lines = lake.model("fact_order_items").select("order_id", "product_id", "item_price", "total_line_value")
    lines = join_to_grouped(lines, categories, "product_id").drop("product_id")
    lines = mark_first(lines, ["order_id", "product_category_name"], "first")
    # Reviews are counted per order first: the fan-out becomes a weight instead of extra rows.
    lines = join_to_grouped(lines, _reviews_per_order(lake), "order_id", "left")
    copies = F.coalesce("review_rows", F.lit(1))
    priced = F.when(F.col("item_price").isNotNull(), copies)
    reviews = F.coalesce(F.sum("reviews"), F.lit(0))
    low = F.coalesce(F.sum("low_scores"), F.lit(0))
    return lines.groupBy("product_category_name").agg(
        F.count_if(F.col("first") & F.col("order_id").isNotNull()).alias("total_orders"),
        F.sum(copies).alias("total_items_sold"),
        round_half_away(F.sum(money(F.col("total_line_value")) * copies).cast("double"), 2).alias("total_revenue"),
        round_half_away(ratio(F.sum(money(F.col("item_price")) * copies).cast("double"), F.sum(priced)), 2).alias("avg_price"),
        round_half_away(ratio(F.sum("score_sum"), F.sum("score_count")), 2).alias("avg_review_score"),
        low.alias("low_reviews"),
        reviews.alias("total_reviews"),
        round_half_away(ratio(low * 100, reviews), 2).alias("low_review_pct"),
    )


def rpt_shipping_efficiency(lake) -> DataFrame:
    """One row per delivered order line with a route: time, distance, pace, and the buckets they fall in."""
    orders = lake.model("fact_orders").select("order_id", "order_status", "date_key", "is_late")
    timed = orders.join(lake.model("fact_order_lifecycle"), "order_id")
    routes = lake.model("fact_shipping_network").select("order_id", "distance_km")
    days, km = F.col("total_delivery_days"), F.col("distance_km")
    # An unknown duration falls through every comparison into the last bucket.
    delivery = F.when(days <= 7, "0-7 days").when(days <= 14, "8-14 days").when(days <= 21, "15-21 days")
    reach = (
        F.when(km <= 100, "Local (<100km)")
        .when(km <= 500, "Regional (100-500km)")
        .when(km <= 1000, "Long Distance (500-1000km)")
    )
    return join_to_grouped(routes, timed, "order_id").select(
        "order_id",
        "order_status",
        F.col("date_key").alias("order_date"),
        "is_late",
        "total_delivery_days",
        "approval_lag_hours",
        "approval_efficiency",
        "distance_km",
        round_half_away(ratio(km, days), 2).alias("km_per_day"),
        delivery.otherwise("22+ days").alias("delivery_bucket"),
        reach.otherwise("Very Long Distance (>1000km)").alias("distance_bucket"),
    )


def rpt_cohort_retention(lake) -> DataFrame:
    """Persons active per acquisition month and month offset.

    A person's active months are a set bounded by the calendar, so one exchange on the person gives the cohort (the
    first month) and the activity together, and the cohort size is its own activity at offset 0.
    """
    bought = _delivered_orders(lake).join(_persons(lake), "customer_id").where(F.col("person").isNotNull())
    months = bought.groupBy("person").agg(F.collect_set(month_start(F.col("date_key"))).alias("months"))
    active = months.select(F.array_min("months").alias("cohort_month"), F.explode("months").alias("activity_month"))
    counts = active.groupBy("cohort_month", "activity_month").agg(F.count(F.lit(1)).alias("active_customers"))
    counts = counts.withColumn("months_since_first", months_crossed(F.col("cohort_month"), F.col("activity_month")))
    at_start = F.when(F.col("months_since_first") == 0, F.col("active_customers"))
    counts = counts.withColumn("cohort_customers", F.max(at_start).over(Window.partitionBy("cohort_month")))
    return counts.select(
        "cohort_month",
        "months_since_first",
        "cohort_customers",
        "active_customers",
        round_half_away(ratio(F.col("active_customers") * 100, F.col("cohort_customers")), 2).alias("retention_pct"),
    ).orderBy("cohort_month", "months_since_first")


def rpt_revenue_trends(lake) -> DataFrame:
    """Monthly sales of delivered orders with growth, rolling mean and running total."""
    orders = _delivered_orders(lake).select("order_id", "customer_id", month_start(F.col("date_key")).alias("month"))
    # Orders and customers are counted on one row per order; only the distinct products need the lines.
    revenue = F.sum("line_sum").cast("double")
    totals = _sales_per_order(lake).join(orders, "order_id").groupBy("month").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        round_half_away(revenue, 2).alias("total_revenue"),
        round_half_away(ratio(revenue, F.sum("line_count")), 2).alias("avg_order_value"),
    )
    lines = lake.model("fact_order_items").select("order_id", "product_id")
    sold = lines.join(orders.select("order_id", "month"), "order_id").select("month", "product_id").distinct()
    products = sold.groupBy(F.col("month").alias("sold_month")).agg(F.count("product_id").alias("unique_products_sold"))
    monthly = totals.join(products, F.col("month").eqNullSafe(F.col("sold_month"))).drop("sold_month")
    # One row per month: an unpartitioned window is bounded by the calendar.
    by_month = Window.orderBy(F.col("month").asc_nulls_last())
    recent = by_month.rowsBetween(1 - ROLLING_MONTHS, Window.currentRow)
    so_far = by_month.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    revenue, previous = F.col("total_revenue"), F.col("prev_month_revenue")
    return (
        monthly.withColumn("prev_month_revenue", F.lag("total_revenue").over(by_month))
        .withColumn("revenue_growth_pct", round_half_away(ratio((revenue - previous) * F.lit(100.0), previous), 2))
        .withColumn("rolling_3m_avg_revenue", round_half_away(F.avg("total_revenue").over(recent), 2))
        .withColumn("cumulative_revenue", F.sum("total_revenue").over(so_far))
        .orderBy(F.col("month").asc_nulls_last())
    )


def rpt_customer_ltv(lake) -> DataFrame:
    """Lifetime value per person with delivered sales: span, spend, reviews given, tier and decile.

    Sales (delivered orders only) and reviews (any order) come from one pass over the person's orders.
    """
    orders = lake.model("fact_orders").select("order_id", "customer_id", "date_key", "order_status")
    placed = orders.join(_persons(lake), "customer_id")
    placed = placed.join(_sales_per_order(lake), "order_id", "left").join(_reviews_per_order(lake), "order_id", "left")
    sold = (F.col("order_status") == DELIVERED) & F.col("line_count").isNotNull()
    spend = F.sum(F.when(sold, F.col("line_sum"))).cast("double")
    persons = placed.groupBy(F.col("person").alias("customer_id")).agg(
        F.count_if(sold).alias("sold_orders"),
        F.min(F.when(sold, F.col("date_key"))).alias("first_order_date"),
        F.max(F.when(sold, F.col("date_key"))).alias("last_order_date"),
        F.countDistinct(F.when(sold, F.col("order_id"))).alias("total_orders"),
        round_half_away(spend, 2).alias("total_spend"),
        round_half_away(ratio(spend, F.sum(F.when(sold, F.col("line_count")))), 2).alias("avg_order_value"),
        round_half_away(ratio(F.sum("score_sum"), F.sum("score_count")), 2).alias("avg_review_given"),
    )
    persons = persons.where("sold_orders > 0").join(_places(lake), "customer_id")
    persons = global_ntile(
        persons, "ltv_decile", LTV_TILES, [F.col("total_spend").asc_nulls_last(), F.col("customer_id").asc_nulls_last()]
    )
    persons = persons.withColumn("tenure_months", months_crossed(F.col("first_order_date"), F.col("last_order_date")))
    spent, ordered = F.col("total_spend"), F.col("total_orders")
    tier = (
        F.when((spent >= 500) & (ordered >= 3), "High Value")
        .when((spent >= 200) | (ordered >= 2), "Medium Value")
        .otherwise("Low Value")
    )
    return persons.select(
        "customer_id",
        "customer_city",
        "customer_state",
        "first_order_date",
        "last_order_date",
        "tenure_months",
        "total_orders",
        "total_spend",
        "avg_order_value",
        round_half_away(ratio(spent, F.col("tenure_months")), 2).alias("monthly_spend_rate"),
        "avg_review_given",
        tier.alias("ltv_tier"),
        "ltv_decile",
    )


def _category_baskets(lake) -> DataFrame:
    categories = lake.attributes("dim_products").select("product_id", "product_category_name")
    lines = lake.model("fact_order_items").select("order_id", "product_id")
    return weighted_baskets(join_to_grouped(lines, categories, "product_id"), "order_id", "product_category_name")


def _frequent_pairs(baskets: DataFrame) -> DataFrame:
    pairs = pair_totals(baskets, "category_a", "category_b", "co_occurrence_count")
    return pairs.where(F.col("co_occurrence_count") >= MIN_CO_OCCURRENCE)


def frequent_pairs(lake) -> DataFrame:
    """The category pairs of ``rpt_market_basket`` without the totals of their categories."""
    return _frequent_pairs(_category_baskets(lake))


def rpt_market_basket(lake) -> DataFrame:
    """Category pairs bought in the same order, for pairs seen in at least five orders."""
    baskets = _category_baskets(lake)
    pairs = _frequent_pairs(baskets)
    together, a, b = F.col("co_occurrence_count"), F.col("category_a_orders"), F.col("category_b_orders")
    return (
        pairs.join(value_totals(baskets, "category_a", "category_a_orders"), "category_a")
        .join(value_totals(baskets, "category_b", "category_b_orders"), "category_b")
        .select(
            "category_a",
            "category_b",
            together,
            a,
            b,
            round_half_away(ratio(together * 100, a), 2).alias("pct_of_category_a"),
            round_half_away(ratio(together * 100, b), 2).alias("pct_of_category_b"),
            round_half_away(ratio(together, a + b - together), 4).alias("jaccard_similarity"),
        )
        .orderBy(together.desc(), "category_a", "category_b")
    )
