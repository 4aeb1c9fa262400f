"""Staging rows and the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.keys import dense_key, dense_key_bag
from starload.operators.lookup import resolve_key
from starload.tables import materialize


@dataclass(frozen=True)
class Lookup:
    """One foreign key of the fact: which dimension, matched on which staging columns."""

    dim: DataFrame
    tk: str
    on: Sequence[str]
    null_safe: Sequence[str] = ()
    on_miss: str = "default"
    unique: bool = False
    normalized: Sequence[str] = ()


def resolve_all(staging: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Apply the lookups in order. Put small dimensions first: their joins need no shuffle."""
    for lookup in lookups:
        staging = resolve_key(
            staging,
            lookup.dim,
            lookup.on,
            lookup.tk,
            null_safe=lookup.null_safe,
            on_miss=lookup.on_miss,
            unique=lookup.unique,
            normalized=lookup.normalized,
        )
    return staging


def build_fact(
    staging: DataFrame,
    lookups: Sequence[Lookup],
    fact_tk: str,
    keys: Sequence[str],
    measures: Sequence[str],
    tie_break: Sequence[str] | None = None,
    start: int = 1,
) -> DataFrame:
    """Resolve every key and number the rows by keys, tie-break and measures.

    ``tie_break`` names staging columns that, with the keys, tell rows apart; they are not
    kept. Without it rows may be equal in every column and are numbered as a bag. ``start``
    continues an earlier load.
    """
    resolved = resolve_all(staging, lookups)
    if tie_break is None:
        rows = resolved.select(*keys, *measures)
        keyed = dense_key_bag(rows, list(keys), fact_tk, start=start)
    else:
        rows = resolved.select(*keys, *measures, *[F.col(c).alias(f"_{c}") for c in tie_break])
        ties = [*[f"_{c}" for c in tie_break], *measures]
        # A range sort reads its input twice; the lookups are done once, for these few columns.
        rows = materialize(rows, "resolved")
        keyed = dense_key(rows, list(keys), fact_tk, start=start, ties=ties)
    return keyed.select(fact_tk, *keys, *measures)
