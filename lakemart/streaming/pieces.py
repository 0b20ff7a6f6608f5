"""Late pieces of a day: silver grows by the rows it lacks, and nothing it holds is written again.

A piece is what one micro-batch brings. Its files lie in a folder of its own below their day, in bronze and in silver, so
a batch that is repeated replaces its own files and no others. Beside silver lies a table of digests, two 64-bit hashes of
every row. A piece is compared with the digests of its days; rows whose digest is there are compared with the stored
rows themselves, and only rows that are really there are left out. Ten pieces of a day cost one day of writes.

``zones`` rewrites a day for every piece of it, which leaves fewer and larger files; take this module where pieces are
many and days are large, and ``compact`` a day when its last piece is in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, StructType

from lakemart.session import materialize, scratch_scope
from lakemart.sources.commits import Folder
from lakemart.sources.schemas import SCHEMAS
from lakemart.streaming.zones import DAY_FOLDERS, _folder_day

_DIGESTS = StructType().add("digest_a", LongType()).add("digest_b", LongType()).add("date", DateType()).add("piece", StringType())


def _declared(table: str, schema: StructType | None) -> StructType:
    return StructType(list((schema or SCHEMAS[table]).fields)).add("date", "date")


def read_pieces(spark: SparkSession, root: str, table: str, schema: StructType | None = None) -> DataFrame:
    """All rows of a table whose days are kept in pieces, with their ``date``."""
    declared = _declared(table, schema)
    if not Folder(spark, f"{root}/{table}").names():
        return spark.createDataFrame([], declared)
    with_piece = StructType(list(declared.fields)).add("piece", "string")
    return spark.read.schema(with_piece).option("pathGlobFilter", "*.parquet").parquet(f"{root}/{table}").select(declared.names)


def _write_piece(rows: DataFrame, root: str, table: str, piece: str) -> None:
    """Replace this piece's files of the days it has rows for."""
    sized = rows.withColumn("piece", F.lit(piece)).hint("rebalance", "date")
    sized.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "piece").parquet(f"{root}/{table}")


def _digest(columns: list[str]) -> list[Column]:
    """Two hashes of a row; NULL and an empty text differ, as do equal texts of different columns."""
    marked = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return [F.xxhash64(F.lit(seed), *marked).alias(name) for seed, name in ((1, "digest_a"), (2, "digest_b"))]


def add_unseen(spark: SparkSession, rows: DataFrame, silver: str, table: str, piece: str, schema: StructType | None = None) -> None:
    """Append the distinct rows that silver does not hold yet. Taking a piece again gives the same files."""
    declared = _declared(table, schema)
    columns, keys = declared.names, ["date", "digest_a", "digest_b"]
    with scratch_scope(spark):
        came = materialize(rows.select(columns).distinct().select("*", *_digest(columns)), "piece")
        days = [r[0] for r in came.select("date").distinct().where("date is not null").collect()]
        digests, own = f"{table}-digests", F.col("piece") == piece
        in_days = F.col("date").isin(days)
        if Folder(spark, f"{silver}/{digests}").names():
            known = spark.read.schema(_DIGESTS).parquet(f"{silver}/{digests}").where(in_days & ~own).drop("piece")
        else:
            known = spark.createDataFrame([], _DIGESTS).drop("piece")
        known = known.distinct()
        fresh = came.join(known, keys, "left_anti")
        seen = materialize(came.join(known, keys, "left_semi"), "seen")
        if not seen.isEmpty():
            # A digest is a hint. Rows count as there if a stored row of their digest equals them.
            stored = spark.read.schema(StructType(list(declared.fields)).add("piece", "string")).parquet(f"{silver}/{table}")
            stored = stored.where(in_days & ~own).select(*columns, *_digest(columns)).join(seen.select(keys).distinct(), keys, "left_semi")
            same = [seen[c].eqNullSafe(stored[c]) for c in [*keys, *[c for c in columns if c != "date"]]]
            fresh = fresh.unionByName(seen.join(stored, same, "left_anti"))
        fresh = materialize(fresh.where("date is not null"), "fresh")
        # Rows first: a piece that dies in between is taken again, and its own digests do not count against it.
        _write_piece(fresh.select(columns), silver, table, piece)
        _write_piece(fresh.select(keys), silver, digests, piece)


def _each_batch(stream: DataFrame, work, checkpoint: str) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            work(batch, f"{batch_id:06d}")

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landing_pieces_to_bronze(
    spark: SparkSession, landing: str, bronze: str, table: str, checkpoint: str, schema: StructType | None = None, layout: str = DAY_FOLDERS,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Take every new landing file of a table into a piece of its day, then stop. Files that came before are not read."""
    source = spark.readStream.schema(schema or SCHEMAS[table])
    if files_per_trigger is not None:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    arrived = source.parquet(f"{landing}/{layout.format(day='*', table=table)}").withColumn("date", _folder_day())
    return _each_batch(arrived, lambda rows, piece: _write_piece(rows.where("date is not null"), bronze, table, piece), f"{checkpoint}/{table}")


def bronze_pieces_to_silver(
    spark: SparkSession, bronze: str, silver: str, table: str, checkpoint: str, schema: StructType | None = None
) -> StreamingQuery:
    """Add the rows of every new bronze file that silver lacks, then stop."""
    declared = _declared(table, schema)
    arrived = spark.readStream.schema(StructType(list(declared.fields)).add("piece", "string")).option("pathGlobFilter", "*.parquet")
    arrived = arrived.parquet(f"{bronze}/{table}").select(declared.names)
    return _each_batch(arrived, lambda rows, piece: add_unseen(spark, rows, silver, table, piece, schema), f"{checkpoint}/{table}")


def compact(spark: SparkSession, silver: str, table: str, day: str, schema: StructType | None = None) -> None:
    """Put the pieces of one day together, rows and digests; run it when nobody reads the day.

    The whole is written as one more piece first and the others go afterwards. If it dies in between, run it again.
    """
    for name, declared in ((table, _declared(table, schema)), (f"{table}-digests", StructType(_DIGESTS.fields[:3]))):
        folder = Folder(spark, f"{silver}/{name}/date={day}")
        pieces = [p for p in folder.names() if p.startswith("piece=") and p != "piece=whole"]
        if pieces:
            read = spark.read.schema(StructType(list(declared.fields)).add("piece", "string")).option("basePath", f"{silver}/{name}")
            held = [f"{silver}/{name}/date={day}/{p}" for p in folder.names() if p.startswith("piece=")]
            with scratch_scope(spark):
                rows = materialize(read.parquet(*held).select(declared.names).distinct(), "whole")
                _write_piece(rows, silver, name, "whole")
            for piece in pieces:
                folder.delete(piece)
