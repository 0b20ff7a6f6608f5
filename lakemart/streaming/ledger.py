"""A day ledger: days of several tables that are in as a whole or not in at all.

A batch is a few days of all tables. Each table of it is written to a folder of the batch, and a note is left with the
rows of each day once the table is whole. When all tables have their notes, one commit names the batch's days; readers
know days through commits only. A run that dies leaves a batch without commit: the next run takes the same days, keeps
the tables that have notes, writes the rest and commits. The cursor is the last day committed.

A day that is taken again goes to a later batch, whose commit replaces it for all tables at once; readers that have read
the ledger before go on with the older folders until ``vacuum`` deletes them. Zones follow each other the same way: a
ledger of the zone behind takes whole days of the zone before it, once for each batch.

One writer at a time. Days are one entry each on the driver, rows and files never are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.sources.commits import CommitLog, Conflict, Folder
from lakemart.sources.schemas import REFERENCE_TABLES, SCHEMAS, SOURCE_TABLES
from lakemart.sources.slicing import order_day, slice_days


class Batch:
    """Days on their way in. ``store`` is called once for each table; what a lost run has stored is not written again."""

    def __init__(self, ledger: DayLedger, number: int, days: list[str], taken_from: dict[str, int]):
        self.ledger, self.number, self.days, self.taken_from = ledger, number, days, taken_from
        self._notes = Folder(ledger.spark, f"{ledger.root}/_pending/{number:012d}")

    def stored(self) -> dict[str, dict[str, int]]:
        """Rows of each day of the tables that are whole already."""
        return {name.removesuffix(".json"): self._notes.read(name) for name in self._notes.names() if name != "days.json"}

    def store(self, table: str, rows: DataFrame) -> DataFrame:
        """Write a table's rows (with their ``date``) unless that is done, and return them as stored."""
        ledger, name = self.ledger, f"{table}.json"
        path = f"{ledger.root}/{table}/batch={self.number}"
        if not self._notes.exists(name):
            schema = StructType([f for f in rows.schema.fields if f.name != "date"])
            rows.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(path)
            counts = ledger.spark.read.schema(schema.add("date", "date")).parquet(path).groupBy("date").count()
            self._notes.create(name, {str(day): n for day, n in counts.collect()})
        return ledger.spark.read.schema(rows.schema).parquet(path)

    def commit(self) -> int:
        """Make the days known; every table must have been stored."""
        stored = self.stored()
        missing = [t for t in self.ledger.tables if t not in stored]
        if missing:
            raise ValueError(f"batch {self.number} lacks {', '.join(missing)}")
        entry = {"days": self.days, "rows": {t: stored[t] for t in self.ledger.tables}, "taken_from": self.taken_from}
        return self.ledger.log.commit(self.number, entry)


class DayLedger:
    def __init__(self, spark: SparkSession, root: str, tables: Sequence[str] = SOURCE_TABLES, schemas: dict[str, StructType] | None = None):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), list(tables)
        self.schemas = SCHEMAS | (schemas or {})
        self.log = CommitLog(spark, f"{self.root}/_days")

    # --- writing ----------------------------------------------------------------------------------------------------

    def pending(self) -> Batch | None:
        """The batch that a lost run has begun, if there is one."""
        number = self.log.latest()[0] + 1
        notes = Folder(self.spark, f"{self.root}/_pending/{number:012d}")
        if not notes.exists("days.json"):
            return None
        begun = notes.read("days.json")
        return Batch(self, number, begun["days"], begun["taken_from"])

    def begin(self, days: Sequence[str], taken_from: dict[str, int] | None = None) -> Batch:
        """Start a batch. Raises ``Conflict`` while another one is pending: finish that first."""
        if self.pending() is not None:
            raise Conflict("a batch is pending")
        number = self.log.latest()[0] + 1
        Folder(self.spark, f"{self.root}/_pending/{number:012d}").create("days.json", {"days": sorted(days), "taken_from": taken_from or {}})
        return self.pending()

    # --- reading ----------------------------------------------------------------------------------------------------

    def entries(self) -> list[tuple[int, dict]]:
        """All commits, for readers that want to keep to what they saw."""
        return self.log.entries()

    def days(self, entries: list[tuple[int, dict]] | None = None) -> dict[str, int]:
        """Every whole day and the batch that holds it."""
        known = self.entries() if entries is None else entries
        return dict(sorted({day: number for number, entry in known for day in entry["days"]}.items()))

    def cursor(self) -> str | None:
        """The last whole day."""
        return max(self.days(), default=None)

    def read(self, table: str, days: Sequence[str] | None = None, entries: list[tuple[int, dict]] | None = None) -> DataFrame:
        """A table's rows of whole days, with their ``date``. Only the folders of these days are listed.

        A reference table, which a batch holds whole on its first day, is read from the newest such batch.
        """
        known = self.entries() if entries is None else entries
        chosen = None if days is None else set(days)
        return self.read_versions(table, {d: n for d, n in self.days(known).items() if chosen is None or d in chosen}, known)

    def read_versions(self, table: str, versions: dict[str, int], entries: list[tuple[int, dict]] | None = None) -> DataFrame:
        """As ``read``, of days as given batches hold them, current or replaced (but not yet deleted)."""
        rows = {number: entry["rows"][table] for number, entry in (self.entries() if entries is None else entries)}
        held = [(day, number) for day, number in versions.items() if rows[number].get(day)]
        if table in REFERENCE_TABLES:
            held = [max(held, key=lambda d: d[1])] if held else []
        schema = StructType(list(self.schemas[table].fields)).add("date", "date")
        if not held:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{table}/batch={number}/date={day}" for day, number in held]
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return found.select([f.name for f in schema.fields])

    def source(self) -> Callable[[str], DataFrame]:
        """A reader of all tables that keeps to the days known now, e.g. for a ``Lake``."""
        entries = self.entries()
        return lambda table: self.read(table, entries=entries)

    def taken(self) -> dict[str, int]:
        """What this ledger was made from: each day of the zone before and the batch that held it."""
        return reduce(lambda seen, e: seen | e[1]["taken_from"], self.entries(), {})

    # --- cleaning ---------------------------------------------------------------------------------------------------

    def vacuum(self) -> list[str]:
        """Delete folders of days that a later batch has replaced, and notes of committed batches."""
        known = self.entries()
        current, gone = self.days(known), []
        for number, entry in known:
            for day in entry["days"]:
                if current[day] != number:
                    for table in self.tables:
                        if table not in REFERENCE_TABLES:
                            gone.append(f"{table}/batch={number}/date={day}")
        files = Folder(self.spark, self.root)
        gone = [folder for folder in gone if files.delete(folder)]
        for number, _ in known:
            files.delete(f"_pending/{number:012d}")
        return gone


def next_days(source: Callable[[str], DataFrame], after: str | None, count: int) -> list[str]:
    """The next days that have orders; a day without orders is never written, and never stops the cursor."""
    orders = source("orders")
    found = orders.select(order_day(orders).alias("day")).where("day is not null")
    if after is not None:
        found = found.where(F.col("day") > F.lit(after).cast("date"))
    return [str(r[0]) for r in found.distinct().orderBy("day").limit(count).collect()]


def _taken(ledger: DayLedger, source: Callable[[str], DataFrame], batch: Batch) -> list[str]:
    slices = slice_days(source, batch.days[0], batch.days[-1], batch.store)
    assert set(slices) == set(ledger.tables)
    batch.commit()
    return batch.days


def advance(ledger: DayLedger, source: Callable[[str], DataFrame], days: int = 1) -> list[str]:
    """Cut the next days out of the raw tables; returns the days that came in, none when there are no more.

    If a batch is pending, its days come first, however many this call asks for.
    """
    batch = ledger.pending()
    if batch is None:
        chosen = next_days(source, ledger.cursor(), days)
        if not chosen:
            return []
        batch = ledger.begin(chosen)
    return _taken(ledger, source, batch)


def retake(ledger: DayLedger, source: Callable[[str], DataFrame], *days: str) -> list[str]:
    """Cut some days again, e.g. after late corrections; they are replaced in all tables at once."""
    return _taken(ledger, source, ledger.begin(days))


def promote(before: DayLedger, behind: DayLedger) -> list[str]:
    """Take every day that is new in the zone before, or was taken again there, into the zone behind, without duplicate rows.

    Rows are compared with their ``date``, so equal rows of different days stay.
    """
    entries = before.entries()
    current = before.days(entries)
    batch = behind.pending()
    if batch is None:
        known = behind.taken()
        outstanding = {day: number for day, number in current.items() if known.get(day) != number}
        if not outstanding:
            return []
        batch = behind.begin(list(outstanding), outstanding)
    # A batch that goes on after a failure reads what it began with, even if a day was taken again in between.
    entries = [e for e in entries if e[0] <= max(batch.taken_from.values())]
    for table in behind.tables:
        batch.store(table, before.read(table, batch.days, entries).distinct())
    batch.commit()
    return batch.days
