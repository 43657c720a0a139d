"""Connected components by alternating large-star and small-star rounds.

Every step is a grouped minimum (combined map-side) and an equi-join, so a node
with very many links is split by the adaptive skew join. Each round is cut with
a checkpoint in the shared folder. No link or label reaches the driver: only a
row count and a checksum do, to see when nothing changes any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every linked node that is not its component's smallest.

    ``a`` and ``b`` are long columns. Repeated links, links in both directions
    and links of a node to itself are allowed; links with a null end are left
    out. No links give no rows.
    """
    now = materialize(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    seen = _checksum(now)
    while seen[0]:
        now = materialize(_small_star(_large_star(now).distinct()).distinct())
        new = _checksum(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
