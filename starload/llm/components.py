"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.tables import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (u, v); root is the smallest node.

    Each half round takes the minimum per node (map-side combined), writes it, and joins it back;
    as both sides of that join are scans, a hot node is split by adaptive execution. Rounds grow
    with the logarithm of the longest path. Only a count and a checksum reach the driver.
    """
    big, small = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = materialize(edges.where("u <> v").select(big, small).distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        lowest = materialize(lowest.select("u", F.least("u", "m").alias("m")), "lowest")
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), "m").distinct()
        large = materialize(large.toDF("u", "v"), "large")
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        tied = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), "m")
        now = materialize(tied.unionByName(lowest).distinct().toDF("u", "v"), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return materialize(now.unionByName(roots).toDF("node", "root"), "roots")
