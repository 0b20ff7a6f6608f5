"""Files of one table that differ in their columns, and days that come in pieces."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakemart import Lake
from lakemart.sources import reconcile
from lakemart.sources.reconcile import NotReconcilable, file_schemas, read_reconciled, undeclared
from lakemart.sources.schemas import SCHEMAS
from lakemart.streaming import pieces

DECLARED = "k bigint, name string, price double, at timestamp_ntz, n decimal(12,2)"


def day(spark, root, date, sql, append=False):
    spark.sql(sql).write.mode("append" if append else "overwrite").parquet(f"{root}/t/date={date}")


@pytest.fixture
def declared(spark):
    return spark.createDataFrame([], DECLARED).schema


def test_added_missing_and_widened_columns(spark, tmp_path, declared):
    root = str(tmp_path)
    day(spark, root, "2020-01-01", "select 1L as k, 'a' as name, 1.5D as price, timestamp_ntz'2020-01-01 05:00:00' as at, cast(1 as decimal(12,2)) as n")
    day(spark, root, "2020-01-02", "select 'later' as added, 2L as k, 2.5D as price")
    day(spark, root, "2020-01-03", "select 3 as price, date'2020-01-03' as at, cast(7 as smallint) as k, 'c' as name, cast(2.5 as decimal(8,1)) as n")
    # One folder whose files contradict each other.
    day(spark, root, "2020-01-04", "select 4L as k, 'd' as name")
    day(spark, root, "2020-01-04", "select 5 as k, 'e' as name", append=True)
    found = read_reconciled(spark, root, "t", declared)
    assert found.schema.names == [*declared.names, "date"]
    picked = found.selectExpr("k", "name", "price", "cast(at as string)", "cast(n as string)", "cast(date as string)")
    assert rows(picked) == [
        (1, "a", 1.5, "2020-01-01 05:00:00", "1.00", "2020-01-01"),
        (2, None, 2.5, None, None, "2020-01-02"),
        (4, "d", None, None, None, "2020-01-04"),
        (5, "e", None, None, None, "2020-01-04"),
        (7, "c", 3.0, "2020-01-03 00:00:00", "2.50", "2020-01-03"),
    ]
    schemas = file_schemas(spark, root, "t")
    assert len(schemas) == 5 and [undeclared(s, declared) for p, s in schemas.items() if "01-02" in p] == [["added"]]
    # A filter on the day keeps the other folders closed, one on a column reaches the files.
    plan = found.where("date = '2020-01-03' and k > 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "IsNotNull(k)" in plan
    assert read_reconciled(spark, root, "nothing", declared).count() == 0
    assert read_reconciled(spark, root, "t", declared, {p: s for p, s in schemas.items() if "01-01" in p}).count() == 1


@pytest.mark.parametrize(
    ("column", "message"),
    [("cast(1.5 as decimal(14,4)) as n", r"n is decimal\(14,4\), declared decimal\(12,2\)"), ("'7' as k", "k is string, declared bigint"),
     ("1L as price", "price is bigint, declared double"), ("timestamp'2020-01-01 00:00:00' as at", "at is timestamp, declared timestamp_ntz")],
)
def test_narrowing_is_refused_with_the_files_name(spark, tmp_path, declared, column, message):
    day(spark, str(tmp_path), "2020-01-01", "select 1L as k")
    day(spark, str(tmp_path), "2020-01-02", f"select {column}")
    with pytest.raises(NotReconcilable, match=f"date=2020-01-02: column {message}"):
        read_reconciled(spark, str(tmp_path), "t", declared)


def test_a_lake_over_files_that_differ(spark, tmp_path):
    columns = ", ".join(f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in SCHEMAS["order_payments"].fields if f.name not in ("order_id", "payment_installments"))
    for date, more in (("2020-01-01", "'a' as order_id, cast(2 as smallint) as payment_installments"), ("2020-01-02", "'b' as order_id, true as gift")):
        spark.sql(f"select {columns}, {more}").write.parquet(f"{tmp_path}/order_payments/date={date}")
    found = Lake.from_silver(spark, str(tmp_path), reconcile=True).model("stg_payments").select("order_id", "payment_installments")
    assert rows(found) == [("a", 2), ("b", None)]
    assert reconcile.widens(SCHEMAS["orders"][0].dataType, SCHEMAS["orders"][0].dataType)


# --- pieces ---------------------------------------------------------------------------------------------------------

EVENT = "id long, note string, v double"


def land(spark, root, date, name, made):
    frame = spark.createDataFrame(made, EVENT).coalesce(1)
    frame.write.mode("append").parquet(f"{root}/{date}/events.parquet")
    return name


def run(spark, root, schema, seen="seen"):
    pieces.landing_pieces_to_bronze(spark, f"{root}/landing", f"{root}/bronze", "events", f"{root}/{seen}-landing", schema).awaitTermination()
    pieces.bronze_pieces_to_silver(spark, f"{root}/bronze", f"{root}/silver", "events", f"{root}/{seen}-bronze", schema).awaitTermination()
    return rows(pieces.read_pieces(spark, f"{root}/silver", "events", schema).selectExpr("id", "note", "v", "cast(date as string)"))


def files(root):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/silver/events/**/*.parquet", recursive=True)}


def test_ten_pieces_cost_one_day_of_writes(spark, tmp_path):
    root, schema = str(tmp_path), spark.createDataFrame([], EVENT).schema
    expected, written = set(), {}
    for n in range(10):
        # Each piece brings new rows, rows of earlier pieces, rows twice, and rows with NULLs.
        made = [(n, "new", 1.0), (n, "new", 1.0), (max(0, n - 2), "new", 1.0), (0, None, None), (0, "", None), (n, None, 2.0)]
        land(spark, f"{root}/landing", "2020-01-01", n, made)
        if n == 4:
            land(spark, f"{root}/landing", "2020-01-02", n, made[:1])
        expected |= {(*m, "2020-01-01") for m in made} | ({(*made[0], "2020-01-02")} if n == 4 else set())
        assert run(spark, root, schema) == sorted(expected, key=str)
        now = files(root)
        assert all(now[p] == t for p, t in written.items())  # what is there stays as it is
        written = now
    stored = spark.read.parquet(f"{root}/silver/events")
    assert stored.count() == len(expected)
    # All batches again, as after a lost checkpoint: same silver.
    assert run(spark, root, schema, "again") == sorted(expected, key=str) and spark.read.parquet(f"{root}/silver/events").count() == len(expected)
    for _ in range(2):
        pieces.compact(spark, f"{root}/silver", "events", "2020-01-01", schema)
        assert os.listdir(f"{root}/silver/events/date=2020-01-01") == ["piece=whole"]
    land(spark, f"{root}/landing", "2020-01-01", 99, [(3, "new", 1.0), (99, "last", 1.0)])
    assert run(spark, root, schema) == sorted(expected | {(99, "last", 1.0, "2020-01-01")}, key=str)


def test_equal_digests_are_not_taken_for_equal_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pieces, "_digest", lambda columns: [F.lit(1).cast("long").alias("digest_a"), F.lit(1).cast("long").alias("digest_b")])
    schema = spark.createDataFrame([], EVENT).schema
    for piece, made in (("a", [(1, "x", None), (2, None, 0.5)]), ("b", [(1, "x", None), (1, "y", None), (2, None, 0.5), (3, None, None)])):
        frame = spark.createDataFrame(made, EVENT).withColumn("date", F.lit(datetime.date(2020, 1, 1)))
        for _ in range(2):  # a batch that is repeated
            pieces.add_unseen(spark, frame, str(tmp_path), "t", piece, schema)
    stored = spark.read.parquet(f"{tmp_path}/t").select("id", "note", "v")
    assert rows(stored) == sorted([(1, "x", None), (2, None, 0.5), (1, "y", None), (3, None, None)], key=str)


def test_a_piece_that_dies_between_rows_and_digests(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], EVENT).schema
    frame = spark.createDataFrame([(1, "x", None), (1, "x", None)], EVENT).withColumn("date", F.lit(datetime.date(2020, 1, 1)))
    write, calls = pieces._write_piece, []

    def dies(rows_, root, table, piece):
        if table.endswith("digests") and not calls:
            calls.append(table)
            raise RuntimeError("lost")
        write(rows_, root, table, piece)

    monkeypatch.setattr(pieces, "_write_piece", dies)
    with pytest.raises(RuntimeError, match="lost"):
        pieces.add_unseen(spark, frame, str(tmp_path), "t", "a", schema)
    pieces.add_unseen(spark, frame, str(tmp_path), "t", "a", schema)
    assert spark.read.parquet(f"{tmp_path}/t").count() == spark.read.parquet(f"{tmp_path}/t-digests").count() == 1
