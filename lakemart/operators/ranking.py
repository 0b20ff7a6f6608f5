"""Global row numbers and tiles without a single-task window.

``row_number() over (order by ...)`` moves the whole input into one task. Here the rows are range-partitioned,
sorted inside each partition, and stamped with their (partition, position); the per-partition counts - one row per
partition - then turn positions into global numbers. The stamped rows are written once, because a second evaluation
could sample other range limits.

The last sort column must be unique: it is part of the range key, so a run of equal values (most customers order
once) spreads over partitions like any other data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import materialize

# monotonically_increasing_id() keeps the partition above this bit and the row position below it.
_POSITION_BITS = 33
_NUMBER = "decimal(38,4)"


def _numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    stamped = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_stamp", F.monotonically_increasing_id())
    stamped = materialize(stamped, "ranked").withColumn("_slot", F.shiftright("_stamp", _POSITION_BITS))

    # At most spark.sql.shuffle.partitions rows: safe for an ordered window and for a broadcast.
    sizes = stamped.groupBy("_slot").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "_slot",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(whole).alias("_total"),
    )
    position = F.col("_stamp").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return stamped.join(F.broadcast(offsets), "_slot").withColumn("_number", F.col("_before") + position + 1)


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop("_slot", "_stamp", "_before", "_total", "_number")


def global_row_number(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Adds ``name`` = dense 1..n in ``order``."""
    return _drop_helpers(_numbered(df, order).withColumn(name, F.col("_number")))


def _tile(index: Column, total: Column, tiles: int) -> Column:
    """NTILE of the row with this index, from 0, among ``total`` rows."""
    small = F.floor(total / tiles)
    large_tiles = total % tiles
    in_large = large_tiles * (small + 1)
    tile = F.when(index < in_large, F.floor(index / (small + 1))).otherwise(
        large_tiles + F.floor(F.try_divide(index - in_large, small))
    )
    return (tile + 1).cast("bigint")


def global_ntile(df: DataFrame, name: str, tiles: int, order: Sequence[Column]) -> DataFrame:
    """Adds ``name`` = NTILE(tiles) in ``order``: the first ``n mod tiles`` tiles hold one row more."""
    numbered = _numbered(df, order)
    return _drop_helpers(numbered.withColumn(name, _tile(F.col("_number") - 1, F.col("_total"), tiles)))


def _order(value: Column, key: Column) -> Column:
    """A value that compares as its row sorts: by number, NULL last, then by key."""
    return F.struct(value.isNull().alias("n"), F.coalesce(value, F.lit(0).cast(_NUMBER)).alias("v"), key.isNull().alias("k"), F.coalesce(key, F.lit("")).alias("s"))


def global_ntiles(df: DataFrame, key: str, tiles: int, few: dict[str, Column], many: dict[str, Column]) -> DataFrame:
    """Adds several NTILE columns at once, each in the order of a number and then of ``key``, a text; NULLs come last.

    A tile is known by its first row, so all that is looked for are the ``tiles - 1`` first rows of each column. Those of
    the numbers in ``few`` (days, small counts), which take few values, lie in at most as many values: rows are counted
    per value, and only the rows of these values are sorted, by key. The numbers in ``many`` are sorted whole. All sorts
    are one range exchange of numbers and keys. Every row then compares itself with the first rows: ``df`` is written
    once and neither exchanged nor joined. The driver sees the first rows, and the counts per value see a single-task window.
    """
    rows = materialize(df, "tiled")
    total = rows.count()
    cuts = [c for t in range(1, tiles) if (c := t * (total // tiles) + min(t, total % tiles)) < total]
    numbers = {name: number.cast(_NUMBER) for name, number in (few | many).items()}
    # (column, value or None for all rows, place among its rows) of the first row of each tile but the first.
    firsts: dict[str, list[tuple]] = {name: [] for name in numbers}
    looked, narrow = [], []
    for name in few if cuts else ():
        values = rows.groupBy(numbers[name].alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
        values = values.withColumn("_first", F.sum("_rows").over(Window.orderBy(F.col("_value").asc_nulls_last())) - F.col("_rows"))
        within = F.filter(F.array(*map(F.lit, cuts)), lambda c: (c >= F.col("_first")) & (c < F.col("_first") + F.col("_rows")))
        found = values.select("_value", "_first", F.explode(within).alias("_cut")).collect()
        for value, first, cut in found:
            if cut == first:
                firsts[name].append((value, None))
            else:
                looked.append((name, value, cut - first))
        edges = {value for _, value, _ in (e for e in looked if e[0] == name)}
        if edges:
            own = reduce(Column.__or__, [numbers[name].eqNullSafe(F.lit(v).cast(_NUMBER)) for v in edges])
            narrow.append(rows.where(own).select(F.lit(name).alias("_name"), numbers[name].alias("_value"), F.col(key).alias("_key")))
    for name in many if cuts else ():
        looked += [(name, None, cut) for cut in cuts]
        narrow.append(rows.select(F.lit(name).alias("_name"), numbers[name].alias("_value"), F.col(key).alias("_key")))
    if narrow:
        numbered = _numbered(reduce(DataFrame.union, narrow), [F.col("_name"), F.col("_value").asc_nulls_last(), F.col("_key").asc_nulls_last()])
        # Within a column or, for the few, a value, the numbers run on without a gap: one row for each.
        group = F.when(F.col("_name").isin(list(few)), F.col("_value"))
        begins = {(r[0], r[1]): r[2] for r in numbered.groupBy("_name", group.alias("_group")).agg(F.min("_number")).collect()}
        wanted = [begins[name, value if name in few else None] + place for name, value, place in looked]
        for name, value, own in numbered.where(F.col("_number").isin(wanted)).select("_name", "_value", "_key").collect():
            firsts[name].append((value, (own,)))
    for name, number in numbers.items():
        tile = F.lit(1).cast("bigint")
        for value, own in firsts[name]:
            # A tile that begins with a value's first row begins before every key.
            start = F.lit(own[0] if own else "").cast("string")
            begin = F.struct(F.lit(value is None).alias("n"), F.lit(value or 0).cast(_NUMBER).alias("v"), F.lit(bool(own) and own[0] is None).alias("k"), F.coalesce(start, F.lit("")).alias("s"))
            tile = tile + F.when(_order(number, F.col(key)) >= begin, 1).otherwise(0)
        rows = rows.withColumn(name, tile)
    return rows
