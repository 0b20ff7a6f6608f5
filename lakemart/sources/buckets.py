"""Tables whose files are laid out by a key, so that joins and groupings on it need no exchange.

Rows of a key lie in the bucket that the key's hash names, sorted by key. Two tables with the same key and number of
buckets are joined bucket by bucket; a plan shows no exchange on either side. What a reader must know beside the files, the
schema, the key and the number of buckets, lies in a note next to them, so a table outlives the session that wrote it.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakemart.sources.commits import Folder

_NOTE = "_buckets.json"


def _table(path: str) -> str:
    """The name under which this session's catalogue knows the folder."""
    return f"lakemart_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a table to a new folder, one file for each bucket."""
    laid_out = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    laid_out.option("path", path).saveAsTable(_table(path))
    Folder(df.sparkSession, path).create(_NOTE, {"schema": df.schema.json(), "key": key, "buckets": buckets})


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return Folder(spark, path).exists(_NOTE)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``write_bucketed`` wrote, in this session or any other."""
    name = _table(path)
    if not spark.catalog.tableExists(name):
        note = Folder(spark, path).read(_NOTE)
        schema = StructType.fromJson(json.loads(note["schema"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        layout = f"clustered by (`{note['key']}`) sorted by (`{note['key']}`) into {note['buckets']} buckets"
        spark.sql(f"create table {name} ({columns}) using parquet {layout} location '{path}'")
    return spark.table(name)
