"""Distinct rows, one row per key, and the rows left over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starload.operators.copies import expand_copies


def dedupe(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str] | None = None,
    collation: str | None = None,
) -> DataFrame:
    """The lowest row per key by ``order`` and then all other columns, nulls last.

    The filter on the row number lets Spark keep one row per key before the shuffle, so a hot
    key sends at most one row per map task. With a ``collation`` keys are equal that it holds for
    equal, and the key's own text decides after all other columns.
    """
    order = list(order or [])
    rest = [c for c in df.columns if c not in key and c not in order]
    if not order and not rest and not collation:
        return df.dropDuplicates()
    equal = [F.collate(F.col(c), collation) for c in key] if collation else list(key)
    rest += key if collation else []
    lowest = [F.col(c).asc_nulls_last() for c in (*order, *rest)]
    window = Window.partitionBy(*equal).orderBy(*lowest)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def duplicate_rejects(
    df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """The rows ``dedupe`` leaves out, each as often as it occurs.

    A bag difference on whole rows: equal rows are counted before the shuffle, the rows of a hot
    key stay spread out, and many copies of one row are written by many tasks.
    """
    rows = df.withColumn("_copies", F.lit(1))
    kept = dedupe(df, key, order).withColumn("_copies", F.lit(-1))
    left = rows.unionByName(kept).groupBy(*df.columns).agg(F.sum("_copies").alias("_copies"))
    copies = expand_copies(left.where("_copies > 0"), "_copies", "_copy")
    return copies.select(*df.columns)
