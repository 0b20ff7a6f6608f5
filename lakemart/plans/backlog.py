"""The daily backlog per seller, carried over the days of a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from lakemart.functions.numbers import round_half_away
from lakemart.lake import Lake
from lakemart.operators.carried import carried_ledger, carry
from lakemart.plans.facts import backlog_lines
from lakemart.streaming.ledger import DayLedger

_KEY = StructField("seller_id", StringType())


def backlog_state(spark: SparkSession, root: str) -> DayLedger:
    return carried_ledger(spark, root, _KEY)


def _lines(days: DayLedger, versions: dict[str, int], sign: int) -> DataFrame:
    """Order lines of whole days as given batches hold them: they come, or they go."""
    entries = days.entries()
    lines = backlog_lines(Lake(days.spark, lambda table: days.read_versions(table, versions, entries)))
    return lines.select("seller_id", "opened", "closed", F.col("line_value").alias("worth"), F.lit(sign).alias("sign"))


def carry_backlog(days: DayLedger, state: DayLedger) -> list[str]:
    """Bring the state up to the ledger's days; returns the days whose backlog is new or changed.

    Reads the days that came in or were taken again since the last step, and of the latter also the rows they replaced,
    so vacuum the ledger after its state has followed. A step that died goes on with the batches it began with.
    """
    pending, before = state.pending(), state.taken()
    changed = pending.taken_from if pending else {d: n for d, n in days.days().items() if before.get(d) != n}
    if not changed:
        return []
    changes = _lines(days, changed, 1)
    replaced = {d: before[d] for d in changed if d in before}
    if replaced:
        changes = changes.unionByName(_lines(days, replaced, -1))
    return carry(state, changes, "seller_id", changed)


def carried_backlog(state: DayLedger) -> DataFrame:
    """The model ``snapshot_daily_seller_backlog``, read from its state."""
    return state.read("open").select(
        "seller_id",
        F.col("date").alias("snapshot_date"),
        F.col("open_count").alias("open_orders_count"),
        round_half_away(F.col("open_amount").cast("double"), 2).alias("revenue_in_transit"),
    )
