"""Flat rows to keyed tables and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.cleanse import drop_null_keys
from starload.operators.dedupe import dedupe
from starload.operators.keys import append_keys, dense_key, dense_key_bag


def keyed_members(
    df: DataFrame,
    columns: Sequence[str],
    id: str = "id",
    distinct: bool = True,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Table of the values of ``columns`` with ids 1..n in their order.

    ``distinct=False`` keeps one row per input row; ``ties`` then fixes the order of equals, and
    without them equal rows are numbered as a bag.
    """
    rows = drop_null_keys(df.select(*columns, *ties), columns)
    if distinct:
        rows = rows.distinct()
    elif not ties:
        return dense_key_bag(rows, list(columns), id).select(id, *columns)
    return dense_key(rows, list(columns), id, ties=list(ties)).select(id, *columns)


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], id: str = "id"
) -> DataFrame:
    """``existing`` plus one row (the lowest) per key of ``incoming`` that it lacks, ids going on."""
    columns = [c for c in existing.columns if c != id]
    rows = dedupe(drop_null_keys(incoming.select(*columns), key), key)
    absent = rows.join(existing.select(*key), list(key), "left_anti")
    added = append_keys(existing, absent, list(key), id)
    return existing.unionByName(added.select(*existing.columns))


def denormalize(
    child: DataFrame,
    parents: Sequence[tuple[DataFrame, str, str]],
    hints: Mapping[str, str] | None = None,
) -> DataFrame:
    """Chain of left joins ``(parent, foreign key, parent id)``; the keys are used up.

    ``hints`` names a join strategy for the parents of some foreign keys (``{"county_fk":
    "merge"}``); without one Spark chooses by size.
    """
    for parent, fk, id in parents:
        right = parent.withColumnRenamed(id, "_parent_id")
        if fk in (hints or {}):
            right = right.hint(hints[fk])
        child = child.join(right, F.col(fk) == F.col("_parent_id"), "left")
        child = child.drop("_parent_id", fk)
    return child
