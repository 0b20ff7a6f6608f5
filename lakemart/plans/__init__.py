"""Model registry. A model is a function from a lake to a DataFrame."""

from lakemart.plans import dims, facts, products, staging

STAGING = {
    f.__name__: f
    for f in (
        staging.stg_orders,
        staging.stg_order_items,
        staging.stg_customers,
        staging.stg_sellers,
        staging.stg_geolocation,
        staging.stg_payments,
        staging.stg_products,
        staging.stg_reviews,
    )
}

# Gold models, dependencies first.
GOLD = {
    f.__name__: f
    for f in (
        dims.dim_customers,
        dims.dim_sellers,
        dims.dim_products,
        dims.dim_geolocation,
        dims.dim_date,
        facts.fact_orders,
        facts.fact_order_items,
        facts.fact_payments,
        facts.fact_reviews,
        facts.fact_order_lifecycle,
        facts.fact_shipping_network,
        facts.snapshot_daily_seller_backlog,
        products.obt_sales_analytics,
        products.rpt_customer_rfm,
        products.rpt_seller_performance,
        products.rpt_product_category_analysis,
        products.rpt_shipping_efficiency,
        products.rpt_cohort_retention,
        products.rpt_revenue_trends,
        products.rpt_customer_ltv,
        products.rpt_market_basket,
    )
}

MODELS = {**STAGING, **GOLD}

ATTRIBUTES = {
    "dim_customers": dims.customer_attributes,
    "dim_sellers": dims.seller_attributes,
    "dim_products": dims.product_attributes,
}
SURROGATE_KEYS = {"dim_customers": "customer_sk", "dim_sellers": "seller_sk", "dim_products": "product_sk"}

# Facts that are joined by order, and the column that a lake with buckets lays them out by.
LAID_OUT = dict.fromkeys(("fact_orders", "fact_order_items", "fact_payments", "fact_reviews", "fact_order_lifecycle", "fact_shipping_network"), "order_id")

# Rows that exist exactly if a model has rows, without what the model does to them. A choice of one row per key, a left
# join or a grouping takes no last row away.
_BEFORE_RANKING = {
    "dim_customers": lambda lake: lake.model("stg_customers"),
    "dim_sellers": lambda lake: lake.source("sellers"),
    "dim_products": lambda lake: lake.source("products"),
    "dim_geolocation": lambda lake: lake.model("stg_geolocation"),
    "fact_reviews": lambda lake: lake.source("order_reviews"),
    "rpt_market_basket": products.frequent_pairs,
}


def presence(lake, model: str):
    """A frame that is empty exactly if the model is."""
    if lake.is_written(model):
        return lake.model(model)
    return _BEFORE_RANKING.get(model, lambda lake: lake.model(model))(lake)
