"""Data-quality checks: declared constraints, emptiness, and the gate that fails a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The declared constraints, model -> columns.
UNIQUE = {
    "stg_orders": ["order_id"],
    "stg_customers": ["customer_id"],
    "stg_sellers": ["seller_id"],
    "stg_products": ["product_id"],
    "stg_reviews": ["review_id"],
    "dim_customers": ["customer_sk"],
    "dim_sellers": ["seller_sk"],
    "dim_products": ["product_sk", "product_id"],
    "dim_geolocation": ["zip_code_prefix"],
    "dim_date": ["date_key"],
    "fact_reviews": ["review_id"],
    "rpt_customer_rfm": ["customer_id"],
    "rpt_seller_performance": ["seller_id"],
    "rpt_product_category_analysis": ["product_category_name"],
    "rpt_revenue_trends": ["month"],
    "rpt_customer_ltv": ["customer_id"],
}
NOT_NULL = {
    "stg_orders": ["order_id"],
    "stg_order_items": ["order_id", "product_id"],
    "stg_customers": ["customer_id"],
    "stg_sellers": ["seller_id"],
    "stg_geolocation": ["geolocation_zip_code_prefix"],
    "stg_payments": ["order_id", "payment_value"],
    "stg_products": ["product_id"],
    "stg_reviews": ["review_id", "order_id", "review_score"],
    "dim_customers": ["customer_sk"],
    "dim_sellers": ["seller_sk"],
    "dim_products": ["product_sk", "product_id"],
    "dim_geolocation": ["zip_code_prefix"],
    "dim_date": ["date_key"],
    "fact_orders": ["order_id"],
    "fact_order_lifecycle": ["order_id"],
    "fact_shipping_network": ["order_id", "distance_km"],
    "fact_order_items": ["order_id", "product_id", "seller_id"],
    "fact_payments": ["order_id", "payment_value"],
    "fact_reviews": ["review_id", "order_id", "review_score"],
    "snapshot_daily_seller_backlog": ["seller_id", "snapshot_date"],
    "rpt_customer_rfm": ["customer_id"],
    "rpt_seller_performance": ["seller_id"],
    "rpt_product_category_analysis": ["product_category_name"],
    "rpt_shipping_efficiency": ["order_id"],
    "rpt_cohort_retention": ["cohort_month"],
    "rpt_revenue_trends": ["month"],
    "rpt_customer_ltv": ["customer_id"],
}


class ChecksFailed(Exception):
    """Raised by the gate; the message lists each violated check."""


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Each non-NULL value that occurs more than once, with its count: the rows a uniqueness check fails with."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("copies"))
    return counts.where("copies > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, failures) for all ``columns`` from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "failures")


def not_empty(df: DataFrame) -> DataFrame:
    """No row when ``df`` has rows, one row when it has none."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).where("row_count = 0")


def measures(model: str) -> list[Column]:
    """What a publishing write counts of a model: its rows, and the NULLs of each column that must have none."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL.get(model, [])]
    return [F.count(F.lit(1)).alias("rows"), *nulls]


def empty_models(lake, models: list[str]) -> DataFrame:
    """(model_name, row_count) of each empty model.

    Models written by this lake were counted as they were written. Of others one row is enough to know, and a model is
    asked for the rows that it would rank or sum up. Those that join lines to orders are all read from one such join.
    """
    from lakemart.plans import presence
    from lakemart.plans.evidence import EVIDENCE, evidence

    written = [(m, lake.measured[m]["rows"]) for m in models if m in lake.measured]
    found = [lake.spark.createDataFrame([w for w in written if w[1] == 0], "model_name string, row_count long")]
    others = [m for m in models if m not in lake.measured]
    joined = [m for m in others if m in EVIDENCE and not lake.is_written(m)]
    for model in others:
        if model not in joined:
            one = not_empty(presence(lake, model).limit(1))
            found.append(one.select(F.lit(model).alias("model_name"), "row_count"))
    if joined:
        there = F.array(*[F.struct(F.lit(m).alias("model_name"), F.coalesce(F.col(m), F.lit(False)).alias("there")) for m in joined])
        empty = evidence(lake).select(F.inline(there)).where("not there")
        found.append(empty.select("model_name", F.lit(0).cast("long").alias("row_count")))
    return reduce(DataFrame.unionByName, found)


def _result(check: str, column: str | None, failures: Column) -> Column:
    label = F.lit(column).cast("string").alias("column")
    return F.struct(F.lit(check).alias("check"), label, failures.cast("bigint").alias("failures"))


def _inline(found: DataFrame, model: str) -> DataFrame:
    return found.select(F.inline("results")).select(F.lit(model).alias("model"), "*")


def _uniqueness(table: DataFrame, model: str, columns: list[str]) -> list[DataFrame]:
    """One grouped count per unique column."""
    checks = []
    for column in columns:
        found = duplicate_values(table, column)
        checks.append(_inline(found.agg(F.array(_result("unique", column, F.count(F.lit(1)))).alias("results")), model))
    return checks


def _single_pass(table: DataFrame, model: str, must_have_rows: bool) -> list[DataFrame]:
    """All checks of a table that was not measured as it was written, from one pass.

    The rows are counted per value of the first unique column, NULL included; these counts hold what the NULL and
    emptiness checks need as well. Only a second unique column takes another pass.
    """
    unique, required = UNIQUE.get(model, []), NOT_NULL.get(model, [])
    nulls = {f"nulls_{i}": column for i, column in enumerate(required)}
    counts = [F.count(F.lit(1)).alias("copies"), *[F.count_if(F.col(c).isNull()).alias(name) for name, c in nulls.items()]]
    groups = table.groupBy(*[F.col(c).alias("value") for c in unique[:1]]).agg(*counts)
    checks = [_result("unique", c, F.count_if(F.col("value").isNotNull() & (F.col("copies") > 1))) for c in unique[:1]]
    checks += [_result("not_null", c, F.coalesce(F.sum(name), F.lit(0))) for name, c in nulls.items()]
    if must_have_rows:
        checks.append(_result("not_empty", None, F.coalesce(F.sum("copies"), F.lit(0)) == 0))
    if not checks:
        return []
    return [_inline(groups.agg(F.array(*checks).alias("results")), model), *_uniqueness(table, model, unique[1:])]


def _measured(lake, models: list[str]) -> DataFrame:
    """The results that the publishing writes have measured: a few rows, no scan."""
    found = []
    for model in models:
        seen = lake.measured[model]
        found += [(model, "not_null", column, seen[column]) for column in NOT_NULL.get(model, [])]
        found.append((model, "not_empty", None, int(seen["rows"] == 0)))
    return lake.spark.createDataFrame(found, "model string, check string, column string, failures long")


def run_checks(lake, models: list[str]) -> DataFrame:
    """(model, check, column, failures) for every declared constraint of ``models``; failures = 0 is a pass.

    NULLs and emptiness of models this lake has written were measured by the write itself; only uniqueness reads their
    files. Other models are read in one pass for all three.
    """
    from lakemart.plans import GOLD

    written = [m for m in models if m in lake.measured]
    checks = [_measured(lake, written)]
    for model in models:
        table = lake.model(model)
        if model in lake.measured:
            checks += _uniqueness(table, model, UNIQUE.get(model, []))
        else:
            checks += _single_pass(table, model, model in GOLD)
    return reduce(DataFrame.unionByName, checks)


def gate(results: DataFrame) -> None:
    """Fail the run if any check failed. Reads only violated checks: at most one row per declared constraint."""
    failed = results.where("failures > 0").orderBy("model", "check", "column").collect()
    if failed:
        lines = [f"{r['model']}.{r['column'] or '*'}: {r['check']} ({r['failures']})" for r in failed]
        raise ChecksFailed("; ".join(lines))
