"""Rows counted instead of repeated, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 20


def expand_copies(df: DataFrame, copies: str, place: str, chunk: int = CHUNK) -> DataFrame:
    """Each row ``copies`` times, with ``place`` running from 0 within the copies.

    Every row is cut into chunks of copies (a small one is one chunk), and the chunks are dealt
    out by their whole content over a fixed number of tasks (one that is not shrunk for holding
    few bytes), so no task writes all copies of a row.
    """
    zero, count = F.lit(0).cast("bigint"), F.col(copies).cast("bigint")
    step = F.lit(chunk).cast("bigint")
    cut = df.where(count > 0).withColumn("_from", F.explode(F.sequence(zero, count - 1, step)))
    last = F.least(F.col("_from") + step, count) - 1
    dealt = cut.repartition(_tasks(df), *cut.columns)
    return dealt.withColumn(place, F.explode(F.sequence(F.col("_from"), last))).drop("_from")


def _tasks(df: DataFrame) -> int:
    """The shuffle partitions, or the cluster's cores where that setting is not a number."""
    setting = str(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(setting) if setting.isdigit() else df.sparkSession.sparkContext.defaultParallelism
