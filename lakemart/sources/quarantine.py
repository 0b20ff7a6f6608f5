"""Raw rows that cannot be used as they are: kept aside with their reason instead of vanishing.

A row is refused for one reason, the first that holds of

* ``shape``: the line has fewer or more cells than the table has columns;
* ``cell``: a cell does not parse as its column's type;
* ``stamp``: an order whose purchase stamp is no date, which belongs to no day;
* ``parent``: a row that hangs on no order of any day.

So every row that is read is either kept or counted under exactly one reason. The sink has one folder for each delivery
and reason; a delivery that is taken again replaces its folders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakemart.sources.schemas import FREE_TEXT_TABLES, SCHEMAS
from lakemart.sources.slicing import HOPS, order_day

REASONS = ("shape", "cell", "stamp", "parent")

_LINE = "_line"
RESCUED = "_rescued"


def read_rescued(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, header: bool = True) -> DataFrame:
    """CSV, cells that do not parse as NULL, and ``_rescued``: what a typed row cannot hold.

    ``_rescued`` is NULL for a sound row. Else it has the row's ``line`` if its number of cells is wrong, and the text of
    all ``cells`` that did not parse, by column. Cells are read as text and cast, so one bad cell costs no other.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField(_LINE, StringType())])
    reader = spark.read.schema(text).options(header=header, mode="PERMISSIVE", escape='"', columnNameOfCorruptRecord=_LINE)
    # All columns are parsed whatever a query needs: only then is a line's number of cells known.
    rows = reader.option("columnPruning", False).option("multiLine", multi_line).csv(path)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    lost = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.struct(F.lit(f.name).alias("key"), F.col(f.name).alias("value")))
        for f in schema.fields
        if not isinstance(f.dataType, StringType)
    ]
    cells = F.map_from_entries(F.array_compact(F.array(*lost))) if lost else F.create_map().cast("map<string,string>")
    rescued = F.struct(F.col(_LINE).alias("line"), cells.alias("cells"))
    rows = rows.select(*typed, rescued.alias(RESCUED))
    sound = F.col(RESCUED)["line"].isNull() & (F.size(F.col(RESCUED)["cells"]) == 0)
    return rows.withColumn(RESCUED, F.when(~sound, F.col(RESCUED)))


def read_raw_rescued(spark: SparkSession, table: str, path: str, header: bool = True) -> DataFrame:
    return read_rescued(spark, path, SCHEMAS[table], table in FREE_TEXT_TABLES, header)


def reason(rows: DataFrame, stamped: bool = False) -> Column:
    """Why a row of ``read_rescued`` is refused, or NULL. ``stamped`` also asks that it has an order day."""
    found = F.when(F.col(RESCUED)["line"].isNotNull(), "shape").when(F.size(F.col(RESCUED)["cells"]) > 0, "cell")
    return found.when(order_day(rows).isNull(), "stamp") if stamped else found


def split(rows: DataFrame, stamped: bool = False, refuse: Sequence[str] = REASONS) -> tuple[DataFrame, DataFrame]:
    """(kept, refused) of ``read_rescued``: the rows as the table has them, and the others with ``reason`` and ``_rescued``.

    A reason that is not in ``refuse`` lets its rows pass, with NULL for what did not parse.
    """
    marked = rows.withColumn("reason", reason(rows, stamped))
    refused = F.col("reason").isNotNull() & F.col("reason").isin(*refuse)
    return marked.where(~F.coalesce(refused, F.lit(False))).drop("reason", RESCUED), marked.where(refused)


def in_no_day(source: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """The rows of each table that no day will ever hold, with their ``reason``: ``stamp`` or ``parent``.

    What day slices of all days leave out, and nothing else. Reference tables are in every delivery and not listed.
    """
    orders = source("orders")
    dated = {"orders": orders.where(order_day(orders).isNotNull())}
    found = {"orders": orders.where(order_day(orders).isNull()).withColumn("reason", F.lit("stamp"))}
    for table, parent, key in HOPS:
        keys = dated[parent].select(key).where(F.col(key).isNotNull()).distinct()
        dated[table] = source(table).join(keys, key, "left_semi")
        found[table] = source(table).join(keys, key, "left_anti").withColumn("reason", F.lit("parent"))
    return found


def set_aside(refused: DataFrame, root: str, table: str, delivery: str) -> None:
    """Write refused rows of one delivery to ``<root>/<table>/delivery=<delivery>/reason=<reason>``, as text for people.

    The row is one JSON text, so rows of any table and schema lie side by side and can be mended and delivered again.
    """
    columns = [c for c in refused.columns if c != "reason"]
    rows = refused.select(F.to_json(F.struct(*columns)).alias("row"), "reason")
    rows.write.mode("overwrite").partitionBy("reason").parquet(f"{root}/{table}/delivery={delivery}")


def counts(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(delivery, reason, rows) of everything set aside of a table."""
    schema = "row string, delivery string, reason string"
    return spark.read.schema(schema).parquet(f"{root}/{table}").groupBy("delivery", "reason").agg(F.count(F.lit(1)).alias("rows"))


def take_csv(
    spark: SparkSession, table: str, path: str, root: str, delivery: str, refuse: Sequence[str] = REASONS, header: bool = True
) -> DataFrame:
    """Rows of a raw table that can be used; the others are set aside under ``root`` first."""
    kept, refused = split(read_raw_rescued(spark, table, path, header), stamped=table == "orders", refuse=refuse)
    set_aside(refused, root, table, delivery)
    return kept
