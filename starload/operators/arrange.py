"""Unions and ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(sources: Sequence[DataFrame], ordinal: str | None = None) -> DataFrame:
    """Bag union by column name; ``ordinal`` names a column that tells the sources apart."""
    parts = list(sources)
    if ordinal:
        parts = [part.withColumn(ordinal, F.lit(i)) for i, part in enumerate(parts)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def sort_keys(
    columns: Sequence[str], case_sensitive: bool = True, collation: str | None = None
) -> list[Column]:
    """Ascending sort keys; case-insensitive and collated ones fall back on the text itself for ties.

    ``collation`` is one of Spark's ("UNICODE_CI", "UNICODE_AI", "de_CI_AI", ...) for text columns.
    """
    keys: list[Column] = []
    for c in columns:
        if collation:
            keys.append(F.collate(F.col(c), collation))
        elif not case_sensitive:
            keys.append(F.lower(c))
        keys.append(F.col(c))
    return keys


def sorted_rows(
    df: DataFrame,
    columns: Sequence[str],
    case_sensitive: bool = True,
    collation: str | None = None,
) -> DataFrame:
    return df.orderBy(*sort_keys(columns, case_sensitive, collation))


def merge_sorted(
    sources: Sequence[DataFrame],
    columns: Sequence[str],
    case_sensitive: bool = True,
    collation: str | None = None,
) -> DataFrame:
    """Several inputs as one sorted output."""
    return sorted_rows(union_all(sources), columns, case_sensitive, collation)
