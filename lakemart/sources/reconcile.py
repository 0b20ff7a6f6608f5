"""Files of one table with different columns, read as one declared table.

Columns are matched by name, whatever their order. A column that a file lacks is NULL; a column that is not declared is
left out and reported. A type may be widened as ``WIDENINGS`` says. Everything else, above all a file that is wider
than the declared type, is refused with its name: no value is cut or rounded without a word.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructType

from lakemart.sources.commits import Folder
from lakemart.sources.schemas import SCHEMAS

# From the type in a file to the declared one; every value of the first is one of the second.
WIDENINGS = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"),
    ("tinyint", "double"), ("smallint", "double"), ("int", "double"), ("float", "double"), ("date", "timestamp_ntz"),
}


class NotReconcilable(Exception):
    """A file does not fit the declared schema; the message names the file, its column and both types."""


def widens(found: DataType, declared: DataType) -> bool:
    """Whether every value of ``found`` is one of ``declared``."""
    if found == declared or (found.simpleString(), declared.simpleString()) in WIDENINGS:
        return True
    if isinstance(found, DecimalType) and isinstance(declared, DecimalType):
        return declared.scale >= found.scale and declared.precision - declared.scale >= found.precision - found.scale
    return False


def undeclared(found: StructType, declared: StructType) -> list[str]:
    """Columns of a file that the table does not have."""
    return [f.name for f in found.fields if f.name not in declared.names]


def _fits(path: str, found: StructType, declared: StructType) -> None:
    for field in declared.fields:
        if field.name in found.names and not widens(found[field.name].dataType, field.dataType):
            kinds = f"{found[field.name].dataType.simpleString()}, declared {field.dataType.simpleString()}"
            raise NotReconcilable(f"{path}: column {field.name} is {kinds}")


def _schema_of(spark: SparkSession, path: str) -> StructType | None:
    """The schema of a file, or of a folder whose files agree; None if they do not. Footers are read by a Spark job."""
    try:
        return spark.read.option("mergeSchema", True).option("pathGlobFilter", "*.parquet").parquet(path).schema
    except Exception as conflict:
        if "CANNOT_MERGE_SCHEMAS" in str(conflict):
            return None
        if "UNABLE_TO_INFER_SCHEMA" in str(conflict):  # no file in it
            return StructType([])
        raise


def file_schemas(spark: SparkSession, root: str, table: str, days: list[str] | None = None) -> dict[str, StructType]:
    """The schema of each day folder of a zone; of each file in it where the folder's files contradict each other.

    One footer job for a day. Where days come in batches, keep what was found and ask for the new days only.
    """
    folder = f"{root}/{table}"
    names = [n for n in Folder(spark, folder).names() if n.startswith("date=")] if days is None else [f"date={d}" for d in days]
    found = {}
    for name in names:
        schema = _schema_of(spark, f"{folder}/{name}")
        if schema is not None:
            found[f"{folder}/{name}"] = schema
            continue
        for file in Folder(spark, f"{folder}/{name}").names():
            if file.endswith(".parquet"):
                found[f"{folder}/{name}/{file}"] = _schema_of(spark, f"{folder}/{name}/{file}")
    return {path: schema for path, schema in found.items() if schema.fields}


def read_reconciled(spark: SparkSession, root: str, table: str, schema: StructType | None = None, schemas: dict[str, StructType] | None = None) -> DataFrame:
    """A date-partitioned table as it is declared, whatever columns and types its files have.

    All files of one kind are one scan, so filters and the choice of columns still reach every file; the scans are put
    together. Raises ``NotReconcilable`` before anything is read if some file does not fit.
    """
    declared = schema or SCHEMAS[table]
    schemas = file_schemas(spark, root, table) if schemas is None else schemas
    kinds: dict[str, list[str]] = {}
    for path, found in sorted(schemas.items()):
        _fits(path, found, declared)
        kinds.setdefault(StructType(sorted(found.fields, key=lambda f: f.name)).json(), []).append(path)
    parts = []
    for kind, paths in kinds.items():
        found = StructType([f for f in StructType.fromJson(json.loads(kind)).fields if f.name in declared.names])
        rows = spark.read.schema(StructType([*found.fields]).add("date", "date")).option("basePath", f"{root}/{table}")
        rows = rows.option("pathGlobFilter", "*.parquet").parquet(*paths)
        columns = [(F.col(f.name) if f.name in found.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared.fields]
        parts.append(rows.select(*columns, "date"))
    if not parts:
        return spark.createDataFrame([], StructType([*declared.fields]).add("date", "date"))
    return reduce(DataFrame.unionByName, parts)
