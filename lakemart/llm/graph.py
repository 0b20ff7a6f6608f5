"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node that has an edge; the component is its smallest node.

    ``edges`` has long columns ``a`` and ``b``; direction, repeats and loops do not matter, null ends are ignored.
    Alternating star contraction: a node's larger neighbours, then its smaller ones, are tied to its smallest
    neighbour, so the rounds grow with the logarithm of the longest path. Each round is written to the shared
    scratch area; the only values on the driver are an edge count and a checksum.
    """
    current = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        both = current.union(current.select("v", "u"))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        current = materialize(
            both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "edges",
        )
        least = materialize(current.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = current.join(least, "u")
        current = materialize(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m")).distinct(),
            "edges",
        )
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
