"""Distinct counts that are kept per load and merged, so that a load reads only its own rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sketch has 2 ** PRECISION registers; its relative error is about 1 / sqrt(2 ** PRECISION).
PRECISION = 14


def distinct_sketches(
    df: DataFrame, columns: Sequence[str], load: str, precision: int = PRECISION
) -> DataFrame:
    """(load_name, column_name, sketch), a line per column; all in one pass with narrow buffers.

    Append the lines of each load to one table. Nulls are not counted.
    """
    sketched = df.agg(
        *[
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(precision)).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ]
    return sketched.select(F.lit(load).alias("load_name"), F.inline(F.array(*lines)))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(column_name, n_distinct) over all loads of the table, whose rows are not read."""
    merged = sketches.groupBy("column_name").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(
        "column_name",
        F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).cast("bigint").alias("n_distinct"),
    )
