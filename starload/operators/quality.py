"""Checks. Each returns a DataFrame and scans its input once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows), one line per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in tables.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def unknown_report(fact: DataFrame, keys: Sequence[str], unknown: int = 0) -> DataFrame:
    """Row count and, per foreign key, how many rows point at the unknown member: one pass."""
    return fact.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(k) == unknown).alias(f"unknown_{k}") for k in keys],
    )


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, ``n_groups``: how many values of ``columns`` occur more than once."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .agg(F.count(F.lit(1)).alias("n_groups"))
    )


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("n_distinct"))


def pk_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that are null in part or occur more than once, with their row count."""
    has_null = F.lit(False)
    for c in columns:
        has_null |= F.col(c).isNull()
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | has_null)


def constraint_violations(
    df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()
) -> DataFrame:
    """(column_name, constraint_name, n_violations) for single-column constraints.

    not_null counts null rows. unique counts the rows beyond the first of each value; nulls do
    not collide. All counts come from one aggregate.
    """
    checks = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in not_null]
    checks += [(c, "unique", F.count(c) - F.count_distinct(c)) for c in unique]
    wide = df.agg(*[check.alias(f"_{i}") for i, (_, _, check) in enumerate(checks)])
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kind).alias("constraint_name"),
                F.col(f"_{i}").alias("n_violations"),
            )
            for i, (c, kind, _) in enumerate(checks)
        ]
    )
    return wide.select(F.inline(lines))


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign keys without a parent, with their row count. Null keys refer to nothing.

    Child rows are counted per key before the join, so a hot key crosses the network once per
    task and not once per row.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.join(parent.select(F.col(pk).alias("_pk")), F.col(fk) == F.col("_pk"), "left_anti")


def rows_for_member(fact: DataFrame, tk: str, value: int) -> DataFrame:
    return fact.where(F.col(tk) == value)


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """``df`` itself; raises if it has no row. Stops at the first row found."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty, nothing is written")
    return df
