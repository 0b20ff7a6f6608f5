"""Models on data where one order, product, seller, buyer and zip hold about a third of the rows each.

Broadcasts are off and the skew thresholds low, so the joins take the shuffled, split path they take at scale.
"""

import glob
import os

import duckdb
import pytest

from conftest import SF_DIR
from lakemart import Lake
from oracle.relations import with_relations
from test_queries import _canonical

HOT = {
    "lineitem": """select * replace (if(n % 3 = 0, 1, l_orderkey) as l_orderkey, if(n % 3 = 1, 1, l_partkey) as l_partkey,
                     if(n % 3 = 2, 1, l_suppkey) as l_suppkey) from (select *, row_number() over () as n from lineitem)""",
    "orders": "select * replace (if(o_orderkey % 3 = 0, 1, o_custkey) as o_custkey) from orders",
    "part": "select * replace (if(p_partkey % 3 = 0, 600, p_partkey) as p_partkey) from part",
}
MODELS = [
    "stg_products",
    "dim_customers",
    "dim_geolocation",
    "fact_shipping_network",
    "snapshot_daily_seller_backlog",
    "obt_sales_analytics",
    "rpt_customer_rfm",
    "rpt_seller_performance",
    "rpt_product_category_analysis",
    "rpt_shipping_efficiency",
    "rpt_cohort_retention",
    "rpt_revenue_trends",
    "rpt_customer_ltv",
    "rpt_market_basket",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """Copies of the tables with hot keys, and a DuckDB connection over them."""
    root = tmp_path_factory.mktemp("hot")
    source, target = duckdb.connect(), duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        source.execute(f"create view {name} as select * from read_parquet('{path}')")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        query = HOT.get(name, f"select * from {name}")
        columns = ", ".join(c[0] for c in source.execute(f"describe {name}").fetchall())
        source.execute(f"copy (select {columns} from ({query})) to '{root}/{name}.parquet' (format parquet)")
        target.execute(f"create view {name} as select * from read_parquet('{root}/{name}.parquet')")
    return str(root), target


@pytest.mark.parametrize("model", MODELS)
def test_model_with_hot_keys(spark, setting, skewed, model):
    setting(
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes=4000,
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes=4000,
    )
    root, duck = skewed
    columns = "*"
    if "shipping" in model:
        columns = "* replace (round(distance_km, 3) as distance_km)"
    result = Lake.from_standin(spark, root).model(model)
    if "shipping" in model:
        result = result.selectExpr(*[f"round({c}, 3) as {c}" if c == "distance_km" else c for c in result.columns])
    cursor = duck.execute(with_relations(f"select {columns} from {model}"))
    names = [d[0] for d in cursor.description]
    assert _canonical(result.collect(), result.columns) == _canonical(cursor.fetchall(), names)
