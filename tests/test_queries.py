"""Every registered query against its SQL, run by DuckDB on the same files."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from conftest import SF_DIR
from __spark_entry__ import entry
from oracle.catalog import QUERIES, SQL

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _canonical(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in records), key=lambda r: tuple((v is None, str(type(v)), v or 0) for v in r))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: KINDS[t] for c, t in result.dtypes} == kinds
    assert _canonical(result.collect(), result.columns) == _canonical(cursor.fetchall(), names)


@pytest.mark.parametrize("name", list(SQL))
def test_sql_can_be_stored_as_a_view(duck, name):
    duck.execute(f"create or replace view checked as {SQL[name]}")


def test_entry_has_rows(spark):
    assert entry(spark).count() > 12
