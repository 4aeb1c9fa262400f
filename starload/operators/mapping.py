"""Code to name mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.text import ColumnLike, as_column
from starload.tables import materialize


def map_codes(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    code: str = "code",
    name: str = "name",
    keep_unmapped: bool = True,
    order: str | None = None,
    out: str | None = None,
) -> DataFrame:
    """Put the name in place of the code (or in ``out``).

    A code listed twice takes the name with the highest ``order``. The reduced mapping is written
    once, so that Spark knows its size: it broadcasts a small one, and joins a large one by
    sort-merge where hot codes can be split.
    """
    if order is None:
        winner = F.min(F.col(name))
    else:
        winner = F.max(F.struct(F.col(order), F.col(name))).getField(name)
    names = (
        mapping.where(F.col(code).isNotNull())
        .groupBy(F.col(code).alias("_code"))
        .agg(winner.alias("_name"))
    )
    names = materialize(names, "codes")
    joined = df.join(names, F.col(column) == F.col("_code"), "left")
    mapped = F.coalesce(F.col("_name"), F.col(column)) if keep_unmapped else F.col("_name")
    return joined.withColumn(out or column, mapped).drop("_code", "_name")


def map_literal(c: ColumnLike, names: Mapping[str, str], keep_unmapped: bool = True) -> Column:
    """Same for a short fixed map: no join, the map is one constant in the plan."""
    c = as_column(c)
    constant = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    found = F.try_element_at(constant, c)
    return F.coalesce(found, c) if keep_unmapped else found
