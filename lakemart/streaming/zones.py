"""Landing -> bronze -> silver as file-source streams.

The unit of work is a day. A micro-batch only tells *which* days got new files; the days are then read whole and
their target partitions replaced. Running a batch twice, or losing executors half way, gives the same files, and a
day that arrives in several pieces ends up complete. Days are few (one row per calendar day), files and rows never
pass through the driver. The checkpoint remembers the files already seen, so each day folder is taken once; a day
written again under a new file name is picked up again, and ``replace_day`` covers one re-written in place.

With an archive, a day is what landing and archive hold of it together. Files are moved only after their days are
written, so a batch that is repeated finds every file in one place or the other; of two files with the same name
landing's is the newer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakemart.sources.files import read_zone, write_days
from lakemart.sources.schemas import SCHEMAS

# Where a landing zone keeps one table of one day: a file, or a folder of part files.
DAY_FOLDERS = "{day}/{table}.parquet"
TABLE_FOLDERS = "{table}/date={day}"

_DAY_IN_PATH = r".*[/=](\d{4}-\d{2}-\d{2})/"


def _folder_day() -> Column:
    return F.to_date(F.regexp_extract(F.col("_metadata.file_path"), _DAY_IN_PATH, 1))


def _days(rows: DataFrame) -> list[str]:
    return [str(r[0]) for r in rows.select("date").distinct().where("date is not null").collect()]


def _run(stream: DataFrame, work: Callable[[list[str]], None], checkpoint: str) -> StreamingQuery:
    def handle(batch: DataFrame, _batch_id: int) -> None:
        days = _days(batch)
        if days:
            work(days)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _day_files(spark: SparkSession, root: str, entry: str) -> dict[str, str]:
    """Data files of one table and day, by their path below ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{entry}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return {}
    if files.getFileStatus(path).isFile():
        return {entry: str(path)}
    found = [f.getPath() for f in files.listStatus(path) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    return {f"{entry}/{f.getName()}": str(f) for f in found}


def _move(spark: SparkSession, landing: str, archive: str, names: list[str]) -> None:
    """Move files from landing to the same place in the archive, over an older file of the same name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(archive).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        source, target = path(f"{landing}/{name}"), path(f"{archive}/{name}")
        if not files.exists(source):
            continue  # moved by the run that this one repeats
        files.mkdirs(target.getParent())
        files.delete(target, False)
        if not files.rename(source, target):
            raise OSError(f"could not move {source} to {target}")


def read_landing(
    spark: SparkSession,
    landing: str,
    table: str,
    days: list[str],
    schema: StructType | None = None,
    layout: str = DAY_FOLDERS,
    archive: str | None = None,
) -> DataFrame:
    """All rows of a table for some days: of the landing zone and, if there is one, of its archive."""
    entries = [layout.format(day=day, table=table) for day in days]
    paths = [f"{landing}/{entry}" for entry in entries]
    if archive is not None:
        paths = [p for e in entries for p in (_day_files(spark, archive, e) | _day_files(spark, landing, e)).values()]
    return spark.read.schema(schema or SCHEMAS[table]).parquet(*paths).withColumn("date", _folder_day())


def landing_to_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    table: str,
    checkpoint: str,
    schema: StructType | None = None,
    layout: str = DAY_FOLDERS,
    archive: str | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Take every new landing file of a table into ``<bronze>/<table>/date=<day>/``, then stop.

    ``archive`` moves consumed files away, which also keeps the listing of the landing zone short; landing and archive
    must be on one file system. ``files_per_trigger`` sets the replay pace. Neither changes what bronze holds in the end.
    """
    source = spark.readStream.schema(schema or SCHEMAS[table])
    if files_per_trigger is not None:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    if archive is not None:
        source = source.option("ignoreMissingFiles", True)  # files that the run before a failure has moved already
    arrived = source.parquet(f"{landing}/{layout.format(day='*', table=table)}").select(_folder_day().alias("date"))

    def ingest(days: list[str]) -> None:
        here = [name for day in days for name in _day_files(spark, landing, layout.format(day=day, table=table))] if archive else []
        write_days(read_landing(spark, landing, table, days, schema, layout, archive), bronze, table, rebalance=False)
        if archive is not None:
            _move(spark, landing, archive, here)

    return _run(arrived, ingest, f"{checkpoint}/{table}")


def promote_days(
    spark: SparkSession, bronze: str, silver: str, table: str, days: list[str], schema: StructType | None = None
) -> None:
    """Rewrite the silver partitions of ``days`` as the distinct rows of bronze.

    ``date`` is among the compared columns, so duplicates are removed within a day and never across days. Equal rows
    collapse before the shuffle, however many copies there are.
    """
    rows = read_zone(spark, bronze, table, schema).where(F.col("date").isin([F.lit(d).cast("date") for d in days]))
    write_days(rows.distinct(), silver, table)


def bronze_to_silver(
    spark: SparkSession, bronze: str, silver: str, table: str, checkpoint: str, schema: StructType | None = None
) -> StreamingQuery:
    """De-duplicate every day whose bronze files changed, then stop."""
    declared = StructType(list((schema or SCHEMAS[table]).fields)).add("date", "date")
    source = spark.readStream.schema(declared).option("pathGlobFilter", "*.parquet").option("ignoreMissingFiles", True)
    changed = source.parquet(f"{bronze}/{table}").select("date")

    def promote(days: list[str]) -> None:
        promote_days(spark, bronze, silver, table, days, schema)

    return _run(changed, promote, f"{checkpoint}/{table}")


def replace_day(
    spark: SparkSession,
    landing: str,
    bronze: str,
    silver: str,
    table: str,
    day: str,
    schema: StructType | None = None,
    layout: str = DAY_FOLDERS,
    archive: str | None = None,
) -> None:
    """Take one day again, e.g. after its landing file was re-written under the same name."""
    write_days(read_landing(spark, landing, table, [day], schema, layout, archive), bronze, table, rebalance=False)
    promote_days(spark, bronze, silver, table, [day], schema)
