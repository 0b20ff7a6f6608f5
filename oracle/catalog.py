"""Every registered query next to the SQL that must give the same rows.

Models and report pages run on the stand-in source tables, the operator queries on the star-schema tables
themselves; all of them over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import Lake
from lakemart.functions import dates, numbers, text
from lakemart.operators import baskets, bitmaps, intervals, keys, ranking, report
from lakemart.plans import GOLD, STAGING, actives, backlog, boards, checks
from lakemart.session import materialize, scratch_path
from lakemart.sources import quarantine, reconcile, slicing
from lakemart.sources.files import read_model, read_raw, read_zone, write_days
from lakemart.sources.schemas import REFERENCE_TABLES, SCHEMAS, SOURCE_TABLES
from lakemart.sources.standin import standin_source, star_table
from lakemart.streaming import ledger, pieces, zones
from oracle.relations import RELATIONS, with_relations

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        SQL[name] = with_relations(sql)


def on_lake(name: str, build: Callable[[Lake], DataFrame], sql: str | None) -> None:
    register(name, lambda spark, sf_dir: build(Lake.from_standin(spark, sf_dir)), sql)


def on_tables(name: str, build: Callable[[Callable[[str], DataFrame]], DataFrame], sql: str | None) -> None:
    register(name, lambda spark, sf_dir: build(lambda t: star_table(spark, sf_dir, t)), sql)


# --- models --------------------------------------------------------------------------------------------------------

# acos() differs in the last bits between the two engines, most of all at zero, so distances are compared to the metre.
_KM_DIGITS = 3

for _name in [*STAGING, *GOLD]:
    if _name == "dim_date":
        continue  # reads no table; its columns are checked on the order dates below
    if _name in ("fact_shipping_network", "rpt_shipping_efficiency"):
        on_lake(
            _name,
            lambda lake, m=_name: lake.model(m).withColumn(
                "distance_km", numbers.round_half_away(F.col("distance_km"), _KM_DIGITS)
            ),
            f"select * replace (round(distance_km, {_KM_DIGITS}) as distance_km) from {_name}",
        )
    else:
        on_lake(_name, lambda lake, m=_name: lake.model(m), f"select * from {_name}")

on_lake(
    "dim_date_columns",
    lambda lake: lake.model("fact_orders").select("date_key").distinct().select(
        "date_key", *dates.calendar_columns(F.col("date_key"))
    ),
    """select distinct date_key, year(date_key) as year, month(date_key) as month, quarter(date_key) as quarter,
              dayofweek(date_key) as day_of_week, isodow(date_key) >= 6 as is_weekend from fact_orders""",
)

# --- report pages --------------------------------------------------------------------------------------------------

on_lake(
    "kpi_executive",
    boards.kpi_executive,
    """select count(distinct order_id) as total_orders,
              count(*) filter (is_late)::double / count(*) * 100 as late_rate,
              (select avg(total_delivery_days) from fact_order_lifecycle) as avg_delivery_days,
              (select sum(total_line_value) from fact_order_items) as total_revenue,
              (select avg(total_line_value) from fact_order_items) as avg_order_value,
              (select count(distinct customer_sk) from dim_customers) as total_customers,
              (select count(distinct seller_sk) from dim_sellers) as total_sellers
       from fact_orders""",
)
on_lake(
    "revenue_trend_series",
    boards.revenue_trend_series,
    """select strftime(month, '%Y-%m') as month_label, total_revenue, revenue_growth_pct, rolling_3m_avg_revenue,
              cumulative_revenue, total_orders, unique_customers from rpt_revenue_trends""",
)
on_lake(
    "revenue_growth_series",
    lambda lake: boards.revenue_growth_series(lake, from_month="1995-06"),
    """select strftime(month, '%Y-%m') as month_label, revenue_growth_pct from rpt_revenue_trends
       where month >= date '1995-06-01'""",
)
on_lake(
    "rfm_segment_counts",
    boards.rfm_segment_counts,
    "select rfm_segment as segment, count(*) as customers from rpt_customer_rfm group by 1",
)
on_lake(
    "rfm_scatter_points",
    boards.rfm_scatter_points,
    """select customer_id, recency_days, monetary, frequency, rfm_avg, rfm_segment from rpt_customer_rfm
       where monetary + frequency + rfm_avg is not null""",
)
on_lake(
    "rfm_segment_table",
    lambda lake: boards.rfm_segment_table(lake, "Champions"),
    "select * from rpt_customer_rfm where rfm_segment = 'Champions' order by customer_id limit 100",
)
on_lake(
    "ltv_kpis",
    boards.ltv_kpis,
    """select sum(total_spend::decimal(18, 2))::double / count(total_spend) as avg_ltv,
              avg(tenure_months) as avg_tenure_months,
              count(*) filter (ltv_tier = 'High Value') as high_value_customers from rpt_customer_ltv""",
)
on_lake("ltv_tier_counts", boards.ltv_tier_counts, "select ltv_tier as tier, count(*) as customers from rpt_customer_ltv group by 1")
on_lake(
    "spend_histogram",
    boards.spend_histogram,
    """select least(floor(50::double * (total_spend - lo) / (hi - lo)) + 1, 50)::bigint as bin, count(*) as rows
       from rpt_customer_ltv, (select min(total_spend) as lo, max(total_spend) as hi from rpt_customer_ltv) limits
       group by 1""",
)
on_lake(
    "ltv_by_state",
    boards.ltv_by_state,
    """select customer_state, sum(total_spend::decimal(18, 2))::double / count(total_spend) as avg_spend,
              count(*) as customers
       from rpt_customer_ltv group by 1 order by 2 desc, 1 limit 15""",
)


def _matrix_cells(lake: Lake) -> DataFrame:
    """The cells of the cohort matrix: a column for every offset is no fixed schema to compare."""
    matrix = boards.cohort_matrix(lake)
    offsets = [c for c in matrix.columns if c != "cohort"]
    return matrix.unpivot("cohort", offsets, "month_offset", "retention_pct").where("retention_pct is not null")


on_lake(
    "cohort_matrix",
    _matrix_cells,
    """select strftime(cohort_month, '%Y-%m') as cohort, printf('m%02d', months_since_first) as month_offset, retention_pct
       from rpt_cohort_retention where retention_pct is not null""",
)
on_lake(
    "cohort_sizes",
    boards.cohort_sizes,
    """select strftime(cohort_month, '%Y-%m') as cohort, cohort_customers from rpt_cohort_retention
       where months_since_first = 0""",
)
on_lake(
    "seller_kpis",
    boards.seller_kpis,
    """select count(*) as sellers, sum(total_revenue::decimal(18, 2))::double / count(total_revenue) as avg_revenue,
              sum(avg_review_score::decimal(18, 2))::double / count(avg_review_score) as avg_review_score,
              sum(avg_delivery_days::decimal(18, 1))::double / count(avg_delivery_days) as avg_delivery_days
       from rpt_seller_performance""",
)
on_lake("top_sellers", boards.top_sellers, "select * from rpt_seller_performance order by total_revenue desc, seller_id limit 15")
on_lake(
    "seller_state_rollup",
    boards.seller_state_rollup,
    """select seller_state, sum(total_revenue) as revenue, count(*) as sellers_count,
              sum(avg_review_score::decimal(18, 2))::double / count(avg_review_score) as avg_score
       from rpt_seller_performance group by 1""",
)
on_lake(
    "category_kpis",
    boards.category_kpis,
    """select count(*) as categories, sum(total_revenue) as total_revenue,
              sum(avg_review_score::decimal(18, 2))::double / count(avg_review_score) as avg_review_score
       from rpt_product_category_analysis""",
)
for _name, _n in (("top_categories_treemap", boards.TREEMAP_CATEGORIES), ("top_categories", boards.TOP_CATEGORIES)):
    on_lake(
        _name,
        lambda lake, n=_n: boards.top_categories(lake, n),
        f"select * from rpt_product_category_analysis order by total_revenue desc, product_category_name limit {_n}",
    )
on_lake(
    "risky_categories",
    boards.risky_categories,
    """select * from rpt_product_category_analysis where total_reviews >= 10
       order by low_review_pct desc nulls last, product_category_name limit 15""",
)



def _to_the_metre(build: Callable[[Lake], DataFrame], column: str) -> Callable[[Lake], DataFrame]:
    return lambda lake: (frame := build(lake)).withColumn(column, numbers.round_half_away(frame[column], _KM_DIGITS))


on_lake(
    "shipping_kpis",
    _to_the_metre(boards.shipping_kpis, "avg_distance_km"),
    """select count(*) as deliveries, count(*) filter (is_late)::double / count(*) * 100 as late_rate,
              avg(total_delivery_days) as avg_delivery_days,
              round(avg(distance_km), 3) as avg_distance_km
       from rpt_shipping_efficiency""",
)
for _bucket in ("delivery_bucket", "distance_bucket"):
    on_lake(
        f"{_bucket}_counts",
        getattr(boards, f"{_bucket}_counts"),
        f"select {_bucket} as bucket, count(*) as deliveries from rpt_shipping_efficiency group by 1",
    )
on_lake(
    "distance_vs_days_sample",
    _to_the_metre(boards.distance_vs_days_sample, "distance_km"),
    """select order_id, round(distance_km, 3) as distance_km, total_delivery_days, is_late from rpt_shipping_efficiency
       order by md5(order_id || '#42'), 1, 2, 3, 4 limit 2000""",
)
on_lake(
    "longest_route", _to_the_metre(boards.longest_route, "max_distance_km"), "select round(max(distance_km), 3) as max_distance_km from fact_shipping_network"
)
on_lake(
    "routes_within",
    lambda lake: boards.routes_within(lake, 1500.0),
    """select cust_lng, cust_lat, sell_lng, sell_lat from fact_shipping_network where distance_km <= 1500
       order by 1, 2, 3, 4 limit 2000""",
)
on_lake(
    "basket_kpis",
    boards.basket_kpis,
    """select count(*) as pairs_found, arg_max(category_a || ' + ' || category_b, strength) as strongest_pair,
              max(co_occurrence_count) as top_co_occurrences
       from (select *, co_occurrence_count * 1000000000
                       - row_number() over (order by category_a, category_b) as strength from rpt_market_basket) ranked""",
)
on_lake(
    "top_pairs",
    boards.top_pairs,
    """select category_a || ' + ' || category_b as pair, co_occurrence_count, jaccard_similarity from rpt_market_basket
       order by co_occurrence_count desc, category_a, category_b limit 20""",
)
on_lake(
    "table_preview",
    lambda lake: boards.table_preview(lake, "rpt_seller_performance", 1000),
    "select * from rpt_seller_performance order by all limit 1000",
)
on_lake(
    "table_profile",
    lambda lake: boards.table_profile(lake, "fact_orders"),
    " union all ".join(
        f"""select '{column}' as column_name, '{kind}' as column_type, count(*) as table_rows,
                   5::bigint as table_columns, count({column}) as non_null, count(distinct {column}) as distinct_values
            from fact_orders"""
        for column, kind in (
            ("order_id", "string"),
            ("customer_id", "string"),
            ("date_key", "date"),
            ("order_status", "string"),
            ("is_late", "boolean"),
        )
    ),
)

# --- sources and zones ---------------------------------------------------------------------------------------------

_DAY_SQL = "order_purchase_timestamp::date"
_RANGE_COLUMN = "to_date(order_purchase_timestamp)"
# A range that leaves out days at either end.
_FROM, _TO = "1997-03-10", "1997-04-20"
_RANGE_SQL = f"{_DAY_SQL} between date '{_FROM}' and date '{_TO}'"


def _raw(rows: DataFrame, table: str) -> DataFrame:
    """All declared columns in their order and raw type (stamps are text); those the stand-in lacks are NULL."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields])


def _from_csv(model: str) -> Query:
    """A staging model over raw tables that were delivered as CSV."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "csv")

        def source(table: str) -> DataFrame:
            raw = standin_source(spark, sf_dir)(table)
            raw = _raw(raw, table)
            raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).write.csv(f"{root}/{table}", header=True, escape='"')
            return read_raw(spark, table, f"{root}/{table}")

        return Lake(spark, source).model(model)

    return build


def _lines(rows: DataFrame) -> DataFrame:
    """Rows as CSV lines, without a header."""
    return rows.select(F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns]), {"escape": '"', "quote": '"'}).alias("line"))


def _faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines delivered with short lines, bad cells and bad stamps: rows kept and set aside, by reason."""
    source, root = standin_source(spark, sf_dir), scratch_path(spark, "faulty")
    key = F.regexp_extract("order_id", "[0-9]+", 0).cast("long")
    orders = _raw(source("orders"), "orders")
    orders = orders.withColumn("order_purchase_timestamp", F.when(key % 11 == 0, "soon").otherwise(F.col("order_purchase_timestamp")))
    short = F.col("line").rlike(r"^O(\d+),") & (F.regexp_extract("line", "[0-9]+", 0).cast("long") % 13 == 0)
    orders = _lines(orders).withColumn("line", F.when(short, F.regexp_replace("line", ",[^,]*,[^,]*$", "")).otherwise(F.col("line")))
    items = _raw(source("order_items"), "order_items").withColumn("price", F.col("price").cast("string"))
    items = _lines(items.withColumn("price", F.when(F.col("order_item_id") == 3, "free").otherwise(F.col("price"))))
    found = []
    for table, lines in (("orders", orders), ("order_items", items)):
        lines.write.text(f"{root}/raw/{table}")
        kept = quarantine.take_csv(spark, table, f"{root}/raw/{table}", f"{root}/aside", "one", header=False)
        kept = kept.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("rows"))
        both = kept.union(quarantine.counts(spark, f"{root}/aside", table).select("reason", "rows"))
        found.append(both.select(F.lit(table).alias("name"), "reason", "rows"))
    return reduce(DataFrame.union, found)


def _odd_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews delivered as CSV with quotes, commas and line breaks in their text and words for some scores."""
    root = scratch_path(spark, "odd")
    raw = _raw(standin_source(spark, sf_dir)("order_reviews"), "order_reviews")
    message = F.concat(F.lit('said "no", then\nleft '), "order_id")
    score = F.when(F.col("review_score") == 2, "two").otherwise(F.col("review_score").cast("string"))
    raw = raw.withColumn("review_comment_message", message).withColumn("review_score", score)
    raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).write.csv(f"{root}/order_reviews", header=True, escape='"')
    return read_raw(spark, "order_reviews", f"{root}/order_reviews").select("review_id", "order_id", "review_score", "review_comment_message")


def _in_no_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that no day holds when the stamps of some orders are lost."""
    source = standin_source(spark, sf_dir)
    stamp = F.when(F.regexp_extract("order_id", "[0-9]+", 0).cast("long") % 9 != 0, F.col("order_purchase_timestamp"))

    def undated(table: str) -> DataFrame:
        return source(table).withColumn("order_purchase_timestamp", stamp) if table == "orders" else source(table)

    found = quarantine.in_no_day(undated).items()
    return reduce(DataFrame.union, [rows.groupBy(F.lit(t).alias("name"), "reason").agg(F.count(F.lit(1)).alias("rows")) for t, rows in found])


def _sliced(table: str, first: str | None = None, last: str | None = None) -> Query:
    """Slices of a range of days, or of all days that the orders have."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = standin_source(spark, sf_dir)
        orders = source("orders")
        day = slicing.order_day(orders)
        ends = orders.agg(F.min(day), F.max(day)).first()
        return slicing.slice_days(source, first or str(ends[0]), last or str(ends[1]))[table]

    return build


# The zones keep one folder per day. ``events`` covers a month of days, so its folders grow with the data instead of
# splitting it into thousands of tiny ones.
def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_table(spark, sf_dir, "events").withColumnRenamed("ts", "order_purchase_timestamp")


def _bronze(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Deliver every event twice, as a landing zone with repeated rows would, and ingest it."""
    events = _events(spark, sf_dir)
    twice = events.unionByName(events)
    write_days(twice.withColumn("date", slicing.order_day(twice)), f"{root}/landing", "events")
    zones.landing_to_bronze(
        spark,
        f"{root}/landing",
        f"{root}/bronze",
        "events",
        f"{root}/seen-landing",
        schema=events.schema,
        layout=zones.TABLE_FOLDERS,
    ).awaitTermination()


def _bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "zones")
    _bronze(spark, sf_dir, root)
    return read_zone(spark, f"{root}/bronze", "events", _events(spark, sf_dir).schema)


def _silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "zones")
    _bronze(spark, sf_dir, root)
    schema = _events(spark, sf_dir).schema
    zones.bronze_to_silver(
        spark, f"{root}/bronze", f"{root}/silver", "events", f"{root}/seen-bronze", schema=schema
    ).awaitTermination()
    return read_zone(spark, f"{root}/silver", "events", schema)


def _late_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day in three pieces that overlap, each taken by a run of its own into silver that is never rewritten."""
    root, events = scratch_path(spark, "late"), _events(spark, sf_dir)
    dated = events.withColumn("date", slicing.order_day(events))
    for held in ((0,), (0, 1), (1, 2)):
        part = dated.where((F.col("event_id") % 3).isin(*held)).hint("rebalance", "date")
        part.write.mode("append").partitionBy("date").parquet(f"{root}/landing/events")
        pieces.landing_pieces_to_bronze(
            spark, f"{root}/landing", f"{root}/bronze", "events", f"{root}/seen-landing", events.schema, zones.TABLE_FOLDERS
        ).awaitTermination()
        pieces.bronze_pieces_to_silver(spark, f"{root}/bronze", f"{root}/silver", "events", f"{root}/seen-bronze", events.schema).awaitTermination()
    return pieces.read_pieces(spark, f"{root}/silver", "events", events.schema)


def _mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose files lack a column, hold narrower types, or have a column more, read as one table."""
    root, events = scratch_path(spark, "mixed"), _events(spark, sf_dir)
    dated = events.withColumn("date", slicing.order_day(events))
    kinds = (
        dated.drop("props"),
        dated.withColumns({"user_id": F.col("user_id").cast("int"), "value": F.floor("value").cast("int")}),
        dated.select(F.lit("more").alias("added"), *reversed(dated.columns)),
    )
    for number, rows in enumerate(kinds):
        rows.where(F.dayofmonth("date") % 3 == number).hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(f"{root}/events")
    return reconcile.read_reconciled(spark, root, "events", events.schema)


def _pieces_in_archive(files_per_trigger: int | None) -> Query:
    """Every day in three pieces, two of them in a first run and one in a second, consumed files moved to an archive."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, events = scratch_path(spark, "pieces"), _events(spark, sf_dir)
        dated = events.withColumn("date", slicing.order_day(events)).withColumn("piece", F.col("event_id") % 3)
        for pieces in ((0, 1), (2,)):
            for piece in pieces:
                part = dated.where(F.col("piece") == piece).drop("piece").hint("rebalance", "date")
                part.write.mode("append").partitionBy("date").parquet(f"{root}/landing/events")
            zones.landing_to_bronze(
                spark, f"{root}/landing", f"{root}/bronze", "events", f"{root}/seen", schema=events.schema,
                layout=zones.TABLE_FOLDERS, archive=f"{root}/archive", files_per_trigger=files_per_trigger,
            ).awaitTermination()
        return read_zone(spark, f"{root}/bronze", "events", events.schema)

    return build


_BACKFILL_KEYS = {
    "orders": "order_id",
    "order_items": "order_id",
    "order_payments": "order_id",
    "order_reviews": "review_id",
    "customers": "customer_id",
    "sellers": "seller_id",
    "products": "product_id",
    "geolocation": "geolocation_zip_code_prefix",
    "product_category_name_translation": "product_category_name",
}


def _per_day(read: Callable[[str], DataFrame]) -> DataFrame:
    """Rows, smallest and largest key of each table and day."""
    parts = []
    for table, column in _BACKFILL_KEYS.items():
        key = F.col(column).cast("string")
        parts.append(
            read(table).groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
            .select(F.lit(table).alias("name"), "date", "n", "first_key", "last_key")
        )
    return reduce(DataFrame.union, parts)


def _backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables of a range written and read back."""
    source, root = standin_source(spark, sf_dir), scratch_path(spark, "backfill")
    slicing.backfill(source, _FROM, _TO, root)
    return _per_day(lambda table: read_zone(spark, root, table, source(table).schema))


def _only_orders(source: Callable[[str], DataFrame], condition: str) -> Callable[[str], DataFrame]:
    return lambda table: source(table).where(condition) if table == "orders" else source(table)


def _sparse_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written for a range in which most days have no order."""
    source, root = _only_orders(standin_source(spark, sf_dir), "order_status = 'canceled'"), scratch_path(spark, "sparse")
    slicing.backfill(source, _FROM, _TO, root)
    tables = ("orders", "order_items", "customers")
    found = [read_zone(spark, root, t, source(t).schema).groupBy(F.lit(t).alias("name"), "date").agg(F.count(F.lit(1)).alias("n")) for t in tables]
    return reduce(DataFrame.union, found)


_BATCH_DAYS = 14


class _Lost(Exception):
    pass


def _day_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of all tables in batches; the second run is lost after five of nine tables and a later one goes on.

    What readers see after the loss and at the end.
    """
    source = _only_orders(standin_source(spark, sf_dir), f"{_RANGE_COLUMN} between '{_FROM}' and '{_TO}'")
    root, schemas = scratch_path(spark, "days"), {t: source(t).schema for t in SOURCE_TABLES}
    ledger.advance(ledger.DayLedger(spark, root, schemas=schemas), source, _BATCH_DAYS)

    def dies(table: str) -> DataFrame:
        if table == "sellers":
            raise _Lost
        return source(table)

    days = ledger.DayLedger(spark, root, schemas=schemas)
    try:
        ledger.advance(days, dies, _BATCH_DAYS)
    except _Lost:
        seen = _per_day(days.source())
    days = ledger.DayLedger(spark, root, schemas=schemas)
    while ledger.advance(days, source, _BATCH_DAYS):
        pass
    phases = (("after the loss", seen), ("at the end", _per_day(days.source())))
    return reduce(DataFrame.union, [rows.select(F.lit(phase).alias("phase"), "*") for phase, rows in phases])


def _carried_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backlog carried over batches of days, the first of which is delivered wrong, taken again and corrected."""
    source = _only_orders(standin_source(spark, sf_dir), f"{_RANGE_COLUMN} between '{_FROM}' and '{_TO}'")
    root, schemas = scratch_path(spark, "carried"), {t: source(t).schema for t in SOURCE_TABLES}
    days, state = ledger.DayLedger(spark, f"{root}/days", schemas=schemas), backlog.backlog_state(spark, f"{root}/state")

    def wrong(table: str) -> DataFrame:
        rows = source(table)
        return rows.where("order_item_id <> 2").withColumn("price", F.col("price") + 1) if table == "order_items" else rows

    taken = ledger.advance(days, wrong, _BATCH_DAYS)
    while taken:
        backlog.carry_backlog(days, state)
        taken = ledger.advance(days, source, _BATCH_DAYS)
    first, *rest = list(days.days())[:_BATCH_DAYS]
    for again in ([first], rest):
        ledger.retake(days, source, *again)
        backlog.carry_backlog(days, state)
    return backlog.carried_backlog(state)


def _days_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole days from the raw tables to bronze (one of them taken twice), to silver, and a model of them in gold."""
    source = _only_orders(standin_source(spark, sf_dir), f"{_RANGE_COLUMN} between '{_FROM}' and '{_TO}'")
    twice = lambda table: source(table).union(source(table)) if table == "order_items" else source(table)
    root, schemas = scratch_path(spark, "zones"), {t: source(t).schema for t in SOURCE_TABLES}
    bronze, silver = (ledger.DayLedger(spark, f"{root}/{zone}", schemas=schemas) for zone in ("bronze", "silver"))
    ledger.advance(bronze, twice, 1000)
    ledger.promote(bronze, silver)
    ledger.retake(bronze, twice, _FROM)
    ledger.promote(bronze, silver)
    lake = Lake.from_days(silver, gold=f"{root}/gold")
    lake.publish("fact_order_items")
    return Lake.from_gold(spark, lake.gold).model("fact_order_items")


def _silver_lake(spark: SparkSession, sf_dir: str, *published: str) -> Lake:
    """All nine tables in silver, each whole, and some models in gold built on them."""
    root = scratch_path(spark, "lake")
    for table in SOURCE_TABLES:
        rows = standin_source(spark, sf_dir)(table)
        write_days(_raw(rows, table).withColumn("date", F.lit("2000-01-01").cast("date")), f"{root}/silver", table)
    lake = Lake.from_silver(spark, f"{root}/silver", gold=f"{root}/gold")
    for model in published:
        lake.publish(model)
    return lake


def _gold(model: str, *before: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _silver_lake(spark, sf_dir, *before, model)
        return read_model(spark, lake.gold, model)

    return build


register("src_read_csv", _from_csv("stg_orders"), "select * from stg_orders")
for _name in STAGING:
    if _name != "stg_orders":
        register(f"src_read_csv_{_name.removeprefix('stg_')}", _from_csv(_name), f"select * from {_name}")
_ODD = "substr(o.order_id, 2)::bigint"
register(
    "src_csv_quarantine",
    _faulty_orders,
    f"""select 'orders' as name, case when {_ODD} % 13 = 0 then 'shape' when {_ODD} % 11 = 0 then 'stamp' else 'kept' end as reason, count(*) as rows
        from src_orders o group by all
        union all select 'order_items', if(order_item_id = 3, 'cell', 'kept'), count(*) from src_order_items group by all""",
)
register(
    "src_csv_odd_cells",
    _odd_reviews,
    """select review_id, order_id, if(review_score = 2, null, review_score)::int as review_score,
              'said "no", then' || chr(10) || 'left ' || order_id as review_comment_message from src_reviews""",
)
_DATED = f"(select o.* from src_orders o where {_ODD} % 9 <> 0)"
_DATED_ITEMS = f"(select i.* from src_order_items i where order_id in (select order_id from {_DATED} d))"
_LEFT_OUT = [("order_items", "src_order_items", "order_id", _DATED), ("order_payments", "src_payments", "order_id", _DATED), ("order_reviews", "src_reviews", "order_id", _DATED),
             ("customers", "src_customers", "customer_id", _DATED), ("sellers", "src_sellers", "seller_id", _DATED_ITEMS), ("products", "src_products", "product_id", _DATED_ITEMS)]
register(
    "src_in_no_day",
    _in_no_day,
    f"select 'orders' as name, 'stamp' as reason, count(*) as rows from src_orders o where {_ODD} % 9 = 0 union all "
    + " union all ".join(
        f"select '{t}', 'parent', count(*) from {r} where {k} not in (select {k} from {p} p) having count(*) > 0" for t, r, k, p in _LEFT_OUT
    ),
)
register("src_day_slice", _sliced("orders"), f"select *, {_DAY_SQL} as date from src_orders")
register(
    "src_single_day",
    lambda spark, sf_dir: slicing.orders_on(standin_source(spark, sf_dir)("orders"), "1998-03-15"),
    f"select *, {_DAY_SQL} as date from src_orders where {_DAY_SQL} = date '1998-03-15'",
)
for _table, _relation in (("order_items", "src_order_items"), ("order_payments", "src_payments"), ("order_reviews", "src_reviews")):
    register(
        f"src_slice_{_table}",
        _sliced(_table),
        f"select c.*, {_DAY_SQL} as date from {_relation} c join src_orders o on o.order_id = c.order_id",
    )
register(
    "src_slice_customers",
    _sliced("customers"),
    f"select c.*, {_DAY_SQL} as date from src_customers c join src_orders o on o.customer_id = c.customer_id",
)
for _table, _key in (("sellers", "seller_id"), ("products", "product_id")):
    register(
        f"src_second_hop_{_table}",
        _sliced(_table),
        f"""select t.*, unnest(days.dates) as date from src_{_table} t
            join (select {_key}, list(distinct {_DAY_SQL}) as dates
                  from src_order_items join src_orders using (order_id) group by 1) days on days.{_key} = t.{_key}""",
    )
on_lake(
    "src_silver_distinct",
    lambda lake: lake.source("order_items").unionByName(lake.source("order_items")).distinct(),
    "select distinct * from src_order_items",
)
_EVENTS_SQL = "select * rename (ts as order_purchase_timestamp), ts::date as date from events"
register("str_landing_to_bronze", _bronze_events, f"{_EVENTS_SQL} union all {_EVENTS_SQL}")
register("str_bronze_to_silver", _silver_events, _EVENTS_SQL)
register("str_landing_archive", _pieces_in_archive(None), _EVENTS_SQL)
register("str_paced_replay", _pieces_in_archive(7), _EVENTS_SQL)
_IN_RANGE = f"(select *, {_DAY_SQL} as date from src_orders where {_RANGE_SQL})"
register("src_slice_range", _sliced("order_items", _FROM, _TO), f"select c.*, o.date from src_order_items c join {_IN_RANGE} o on o.order_id = c.order_id")
_RANGE_TABLES = {
    "orders": f"select * from {_IN_RANGE} o",
    "order_items": f"select c.*, o.date from src_order_items c join {_IN_RANGE} o on o.order_id = c.order_id",
    "order_payments": f"select c.*, o.date from src_payments c join {_IN_RANGE} o on o.order_id = c.order_id",
    "order_reviews": f"select c.*, o.date from src_reviews c join {_IN_RANGE} o on o.order_id = c.order_id",
    "customers": f"select c.*, o.date from src_customers c join {_IN_RANGE} o on o.customer_id = c.customer_id",
    "geolocation": f"select *, date '{_FROM}' as date from src_geolocation",
    "product_category_name_translation": f"select *, date '{_FROM}' as date from src_translation",
    **{
        t: f"select t.*, d.date from src_{t} t join (select distinct i.{k}, o.date from src_order_items i join {_IN_RANGE} o "
        f"on o.order_id = i.order_id) d on d.{k} = t.{k}"
        for t, k in (("sellers", "seller_id"), ("products", "product_id"))
    },
}
register(
    "str_backfill_range",
    _backfilled,
    " union all ".join(
        f"select '{t}' as name, date, count(*) as n, min({k}::varchar) as first_key, max({k}::varchar) as last_key from ({_RANGE_TABLES[t]}) r group by date"
        for t, k in _BACKFILL_KEYS.items()
    ),
)
register(
    "src_sparse_days",
    _sparse_days,
    " union all ".join(
        f"""select '{t}' as name, o.date, count(*) as n from ({_IN_RANGE}) o {j}
            where o.order_status = 'canceled' group by o.date"""
        for t, j in (
            ("orders", ""),
            ("order_items", "join src_order_items i on i.order_id = o.order_id"),
            ("customers", "join src_customers c on c.customer_id = o.customer_id"),
        )
    ),
)
_NUMBERED_DAYS = f"(select date, row_number() over (order by date) - 1 as number from (select distinct date from {_IN_RANGE} o) d)"


def _cursor_sql() -> str:
    """The first batch after the loss, all days at the end; reference tables stand on the newest batch's first day."""
    parts = []
    for phase, condition in (("after the loss", f"number < {_BATCH_DAYS}"), ("at the end", "true")):
        for table, key in _BACKFILL_KEYS.items():
            rows = f"(select * from ({_RANGE_TABLES[table]}) a where date in (select date from {_NUMBERED_DAYS} b where {condition}))"
            if table in REFERENCE_TABLES:
                newest = f"(select max(date) from {_NUMBERED_DAYS} b where {condition} and number % {_BATCH_DAYS} = 0)"
                rows = f"(select * replace ({newest} as date) from ({_RANGE_TABLES[table]}) a)"
            parts.append(
                f"select '{phase}' as phase, '{table}' as name, date, count(*) as n, min({key}::varchar) as first_key, "
                f"max({key}::varchar) as last_key from {rows} r group by date"
            )
    return " union all ".join(parts)


register("str_day_cursor", _day_cursor, _cursor_sql())
register("str_days_to_gold", _days_to_gold, f"select i.* from fact_order_items i join {_IN_RANGE} o on o.order_id = i.order_id")
register(
    "snapshot_backlog_carried",
    _carried_backlog,
    f"""select seller_id, day as snapshot_date, count(*) as open_orders_count, round(sum(worth), 2) as revenue_in_transit
        from (select seller_id, price + freight_value as worth, order_purchase_timestamp::date as opened, order_delivered_customer_date::date as closed
              from stg_orders join src_order_items using (order_id)
              where order_status in ('shipped', 'delivered', 'invoiced', 'processing') and {_RANGE_SQL}) line
        join (select unnest(generate_series(min({_DAY_SQL}), max({_DAY_SQL}), interval 1 day))::date as day from stg_orders
              where order_status in ('shipped', 'delivered', 'invoiced', 'processing') and {_RANGE_SQL}) spine
          on day >= opened and (closed is null or day <= closed)
        group by 1, 2""",
)
register("str_late_pieces", _late_pieces, _EVENTS_SQL)
register(
    "src_mixed_files",
    _mixed_files,
    """select event_id, ts as order_purchase_timestamp, user_id, event_type,
              if(day(ts) % 3 = 1, floor(value), value) as value, if(day(ts) % 3 = 0, null, props) as props, ts::date as date from events""",
)


def _by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide sales table over facts that are laid out by order, opened again from their folders."""
    source, gold = standin_source(spark, sf_dir), scratch_path(spark, "by-order")
    for model in ("fact_orders", "fact_order_items"):
        Lake(spark, source, gold, buckets=8).publish(model)
    lake = Lake(spark, source, gold, buckets=8)
    for model in ("fact_orders", "fact_order_items"):
        lake.open_published(model)
    return lake.model("obt_sales_analytics")


register("gold_facts_by_order", _by_order, "select * from obt_sales_analytics")
register("gold_fact_orders", _gold("fact_orders"), "select * from fact_orders")
register("gold_rpt_cohort_retention", _gold("rpt_cohort_retention", "fact_orders"), "select * from rpt_cohort_retention")
register(
    "sql_over_gold",
    lambda spark, sf_dir: _silver_lake(spark, sf_dir, "dim_products", "fact_order_items").sql(
        "select product_category_name, count(*) as n from fact_order_items join dim_products using (product_id) group by 1",
        "dim_products", "fact_order_items",
    ),
    "select product_category_name, count(*) as n from fact_order_items join dim_products using (product_id) group by 1",
)

# --- checks --------------------------------------------------------------------------------------------------------

on_lake(
    "dq_unique",
    lambda lake: checks.duplicate_values(lake.source("order_reviews"), "review_id"),
    "select review_id as value, count(*) as copies from src_reviews group by 1 having count(*) > 1",
)
_STAMPS = ["order_id", "order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date"]
on_lake(
    "dq_not_null",
    lambda lake: checks.null_counts(lake.model("stg_orders"), _STAMPS),
    " union all ".join(
        f"""select '{c}' as "column", count(*) filter ({c} is null) as failures from stg_orders""" for c in _STAMPS
    ),
)
on_lake(
    "dq_not_empty",
    lambda lake: checks.not_empty(lake.model("fact_orders").where("order_status = 'lost'")),
    "select 0::bigint as row_count where not exists (select 1 from fact_orders where order_status = 'lost')",
)
def _without_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake whose payments are missing: exactly the models made of them are empty."""
    source = standin_source(spark, sf_dir)
    lake = Lake(spark, lambda table: source(table).where("false") if table == "order_payments" else source(table))
    return checks.empty_models(lake, _CHECKED_GOLD)


# The calendar reads no table.
_CHECKED_GOLD = [m for m in GOLD if m != "dim_date"]
register("dq_models_not_empty", _without_payments, "select 'fact_payments' as model_name, 0::bigint as row_count")

_CHECKED = [m for m in [*STAGING, *GOLD] if m != "dim_date"]


def _gate_sql() -> str:
    parts = []
    for model in _CHECKED:
        head = f"select '{model}' as model"
        for column in checks.UNIQUE.get(model, []):
            parts.append(
                f"""{head}, 'unique' as "check", '{column}' as "column",
                    (select count(*) from (select {column} from {model} where {column} is not null
                     group by 1 having count(*) > 1) twice) as failures"""
            )
        for column in checks.NOT_NULL.get(model, []):
            parts.append(
                f"""{head}, 'not_null' as "check", '{column}' as "column",
                    (select count(*) from {model} where {column} is null) as failures"""
            )
        if model in GOLD:
            parts.append(
                f"""{head}, 'not_empty' as "check", null::varchar as "column",
                    if(exists (select 1 from {model}), 0, 1)::bigint as failures"""
            )
    return " union all ".join(parts)


on_lake("dq_gate", lambda lake: checks.run_checks(lake, _CHECKED), _gate_sql())



def _gate_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build whose payments lost some keys: what the gate says, and how many rows gold's readers still see."""
    source, gold = standin_source(spark, sf_dir), scratch_path(spark, "gated")
    Lake(spark, source, gold).publish("fact_payments")
    key = F.when(F.col("payment_installments") != 7, F.col("order_id")).alias("order_id")

    def faulty(table: str) -> DataFrame:
        rows = source(table)
        return rows.select(key, *[c for c in rows.columns if c != "order_id"]) if table == "order_payments" else rows

    lake = Lake(spark, faulty, gold)
    lake.stage("fact_payments")
    said = "open"
    try:
        checks.gate(checks.run_checks(lake, ["fact_payments"]))
        lake.release()
    except checks.ChecksFailed as failed:
        said = str(failed)
    return read_model(spark, gold, "fact_payments").agg(
        F.lit(said).alias("said"), F.count(F.lit(1)).alias("rows_seen"), F.count("order_id").alias("keys_seen")
    )


register(
    "dq_gate_closes",
    _gate_closes,
    """select if(faults = 0, 'open', 'fact_payments.order_id: not_null (' || faults || ')') as said, n as rows_seen, n as keys_seen
       from (select count(*) filter (installments = 7) as faults, count(*) as n from fact_payments) counted""",
)

# --- kept keys and sets --------------------------------------------------------------------------------------------


def _kept_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons numbered by a build that lacked a tenth of the orders, then by one that has them all."""
    source, keys = standin_source(spark, sf_dir), scratch_path(spark, "keys")
    late = F.regexp_extract("customer_unique_id", "[0-9]+", 0).cast("long") % 10 == 0

    def early(table: str) -> DataFrame:
        return source(table).where(~late) if table == "customers" else source(table)

    Lake(spark, early, keys=keys).model("dim_customers")
    return Lake(spark, source, keys=keys).model("dim_customers")


def _month_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months' sets, made in three parts of the orders that share all months, and put together."""
    lake, keys = Lake.from_standin(spark, sf_dir), actives.key_maps(spark, scratch_path(spark, "keys"))
    part = F.regexp_extract("order_id", "[0-9]+", 0).cast("long") % 3
    members = materialize(actives.month_members(lake, part.alias("part")), "members")
    parts = [materialize(actives.sets_of(members.where(F.col("part") == p), keys), "sets") for p in (2, 0, 1)]
    return bitmaps.united(reduce(DataFrame.unionByName, parts), ["month", "what"])


def _quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct persons and products by quarter, from the months' sets."""
    by_quarter = _month_sets(spark, sf_dir).withColumn("quarter", F.trunc("month", "quarter"))
    return bitmaps.counted(by_quarter, ["quarter", "what"], "members")


register(
    "dim_customers_kept_keys",
    _kept_keys,
    """select * replace (row_number() over (order by substr(customer_unique_id, 2)::bigint % 10 = 0, customer_unique_id) as customer_sk)
       from dim_customers""",
)
register(
    "agg_sets_by_quarter",
    _quarters,
    """select date_trunc('quarter', active_month)::date as quarter, 'persons' as what, count(distinct person) as members
       from person_months group by 1
       union all select date_trunc('quarter', date_key)::date, 'products', count(distinct product_id) from delivered_lines group by 1""",
)
register(
    "rpt_cohort_retention_from_sets",
    lambda spark, sf_dir: actives.retention(_month_sets(spark, sf_dir)),
    "select * from rpt_cohort_retention",
)

# --- operators on the star-schema tables ---------------------------------------------------------------------------



def _boundaries(t) -> DataFrame:
    stamp = F.lit("2024-01-15 12:34:56").cast("timestamp_ntz")
    return t("events").select(
        "event_id",
        dates.hours_crossed(F.col("ts"), stamp).alias("hours"),
        dates.days_crossed(F.col("ts"), stamp).alias("days"),
        dates.months_crossed(F.lit("2023-11-30").cast("date"), F.col("ts")).alias("months"),
        dates.month_start(F.col("ts").cast("date")).alias("month"),
    )


on_tables(
    "fn_boundaries_crossed",
    _boundaries,
    """select event_id, datediff('hour', ts, timestamp '2024-01-15 12:34:56') as hours,
              datediff('day', ts, timestamp '2024-01-15 12:34:56') as days,
              datediff('month', timestamp '2023-11-30', ts) as months, date_trunc('month', ts)::date as month
       from events""",
)
on_tables(
    "fn_cast_timestamp",
    lambda t: t("events").select("event_id", F.col("ts").cast("string").cast("timestamp_ntz").alias("ts")),
    "select event_id, ts from events",
)


def _rounded(t) -> DataFrame:
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    rounded = [numbers.round_half_away(net, n).alias(f"net_{n}") for n in (1, 2, 4, 6)]
    return t("lineitem").select("l_orderkey", "l_linenumber", *rounded)


on_tables(
    "fn_round_half_away",
    _rounded,
    "select l_orderkey, l_linenumber, "
    + ", ".join(f"round(l_extendedprice * (1.0::double - l_discount), {n}) as net_{n}" for n in (1, 2, 4, 6))
    + " from lineitem",
)
on_tables(
    "fn_int_half_even",
    lambda t: t("lineitem").select(
        "l_orderkey", "l_linenumber", numbers.to_int_half_even(F.col("l_quantity") / 2).alias("half")
    ),
    "select l_orderkey, l_linenumber, cast(l_quantity / 2 as int) as half from lineitem",
)
on_tables(
    "fn_ratio",
    lambda t: t("lineitem").select(
        "l_orderkey", "l_linenumber", numbers.ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("per_discount")
    ),
    "select l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) as per_discount from lineitem",
)
on_tables(
    "fn_sentence_case",
    lambda t: t("part").select("p_partkey", text.sentence_case(F.col("p_name")).alias("name")),
    "select p_partkey, upper(p_name[1]) || lower(p_name[2:]) as name from part",
)
on_lake(
    "flt_open_interval",
    lambda lake: lake.model("stg_orders")
    .where("order_purchase_timestamp <= timestamp_ntz'1998-06-30 00:00:00'")
    .where(
        "order_delivered_customer_date is null or order_delivered_customer_date >= timestamp_ntz'1998-06-30 00:00:00'"
    )
    .select("order_id"),
    """select order_id from stg_orders where timestamp '1998-06-30' between order_purchase_timestamp
       and coalesce(order_delivered_customer_date, timestamp '9999-12-31')""",
)
on_tables(
    "join_semi",
    lambda t: t("orders").join(
        t("lineitem").where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left_semi"
    ),
    "select * from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')",
)
on_tables(
    "join_basket_pairs",
    lambda t: baskets.pair_totals(
        baskets.weighted_baskets(
            t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")), "l_orderkey", "p_brand"
        ),
        "brand_a",
        "brand_b",
        "orders",
    ),
    """select a.p_brand as brand_a, b.p_brand as brand_b, count(*) as orders
       from (select distinct l_orderkey, p_brand from lineitem join part on p_partkey = l_partkey) a
       join (select distinct l_orderkey, p_brand from lineitem join part on p_partkey = l_partkey) b
         on a.l_orderkey = b.l_orderkey and a.p_brand < b.p_brand group by 1, 2""",
)
on_tables(
    "join_open_per_day",
    lambda t: intervals.open_per_day(
        t("orders").select(
            "o_orderpriority",
            F.col("o_orderdate").cast("date").alias("opened"),
            F.when(
                F.col("o_orderkey") % 9 != 0, F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 40).cast("int") - 3)
            ).alias("closed"),
            (F.col("o_orderkey") % 1000).cast("double").alias("worth"),
        ),
        "o_orderpriority",
        "opened",
        "closed",
        "worth",
    ),
    """select o_orderpriority, day, count(*) as open_count, sum(worth) as open_amount
       from (select o_orderpriority, o_orderdate::date as opened,
                    if(o_orderkey % 9 <> 0, o_orderdate::date + (o_orderkey % 40 - 3)::int, null) as closed,
                    (o_orderkey % 1000)::double as worth from orders) spans
       join (select distinct unnest(generate_series(lo, hi, interval 1 day))::date as day
             from (select min(o_orderdate::date) as lo, max(o_orderdate::date) as hi from orders) ends) spine
         on day >= opened and (closed is null or day <= closed)
       group by 1, 2""",
)
on_tables(
    "agg_distinct_and_conditional",
    lambda t: t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct("l_partkey").alias("parts"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.min("l_shipdate").alias("first_shipped"),
        F.max("l_shipdate").alias("last_shipped"),
    ),
    """select l_returnflag, l_linestatus, count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts,
              count(distinct l_suppkey) as suppliers, count(case when l_discount > 0.05 then 1 end) as discounted,
              min(l_shipdate) as first_shipped, max(l_shipdate) as last_shipped
       from lineitem group by all""",
)
on_tables(
    "agg_pivot",
    lambda t: t("orders")
    .groupBy(F.year("o_orderdate").cast("bigint").alias("year"))
    .pivot("o_orderstatus", ["F", "O", "P"])
    .agg(F.count(F.lit(1))),
    """select year(o_orderdate) as year, count(*) filter (o_orderstatus = 'F') as "F",
              count(*) filter (o_orderstatus = 'O') as "O", count(*) filter (o_orderstatus = 'P') as "P"
       from orders group by 1""",
)
on_tables(
    "agg_histogram",
    lambda t: report.histogram(t("orders"), "o_totalprice", 50),
    """select least(floor(50::double * (o_totalprice - lo) / (hi - lo)) + 1, 50)::bigint as bin, count(*) as rows
       from orders, (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders) limits group by 1""",
)
on_tables(
    "agg_value_counts",
    lambda t: report.value_counts(t("events"), "event_type", "event_type", "events"),
    "select event_type, count(*) as events from events group by 1",
)
on_tables(
    "win_first_per_key",
    lambda t: keys.first_per_key(
        t("lineitem"), ["l_orderkey", "l_linenumber"], [c for c in t("lineitem").columns if c not in ("l_orderkey", "l_linenumber")]
    ),
    """select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
       order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                l_shipdate) = 1""",
)
on_tables(
    "win_row_number",
    lambda t: ranking.global_row_number(
        t("customer").select("c_custkey", "c_acctbal"), "place", [F.col("c_acctbal").asc_nulls_last(), F.col("c_custkey")]
    ),
    "select c_custkey, c_acctbal, row_number() over (order by c_acctbal, c_custkey) as place from customer",
)
on_tables(
    "win_ntile",
    lambda t: ranking.global_ntile(
        t("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity")),
        "tile",
        7,
        [F.col("quantity").desc_nulls_last(), F.col("l_orderkey")],
    ),
    """select l_orderkey, quantity, ntile(7) over (order by quantity desc, l_orderkey) as tile
       from (select l_orderkey, sum(l_quantity) as quantity from lineitem group by 1) totals""",
)
on_tables(
    "top_orders",
    lambda t: report.top_n(t("orders"), 25, "o_totalprice", ["o_orderkey"]),
    "select * from orders order by o_totalprice desc, o_orderkey limit 25",
)
on_tables(
    "smp_repeatable",
    lambda t: report.repeatable_sample(t("orders"), 500, "o_orderkey", 42),
    "select * from orders order by md5(o_orderkey || '#42') limit 500",
)

assert set(SQL) == set(QUERIES) and "dim_date" not in RELATIONS
