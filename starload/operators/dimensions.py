"""Dimensions: surrogate key, version and validity columns, unknown member 0."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.text import norm_str
from starload.operators.cleanse import drop_null_keys
from starload.operators.dedupe import dedupe
from starload.operators.keys import append_keys, dense_key

# First version, open end of validity, key of the unknown member.
FIRST_VERSION = 1
OPEN_END = "2200-01-01 00:00:00"
UNKNOWN_KEY = 0


@dataclass(frozen=True)
class Dimension:
    """What identifies a member, what describes it, and what the unknown member shows."""

    tk: str
    natural_key: Sequence[str]
    attributes: Sequence[str] = ()
    normalized: Sequence[str] = ()
    nullable_key: Sequence[str] = ()
    unknown: Mapping[str, Any] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.natural_key, *self.attributes]

    @property
    def layout(self) -> list[str]:
        return [self.tk, "version", "date_from", "date_to", *self.columns]


def member_rows(
    sources: Sequence[DataFrame], spec: Dimension, more: Sequence[str] = ()
) -> DataFrame:
    """Key, attributes and the columns ``more`` of all rows of all sources that name a member.

    Null keys are dropped on the raw column, before normalising, so that scans can skip them.
    The natural key of the unknown member is not a member of its own.
    """
    required = [c for c in spec.natural_key if c not in spec.nullable_key]
    further = [c for c in more if c not in spec.columns]
    parts = [
        drop_null_keys(source.select(*spec.columns, *further), required).withColumns(
            {c: norm_str(c) for c in spec.normalized}
        )
        for source in sources
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    named = {c: spec.unknown[c] for c in spec.natural_key if spec.unknown.get(c) is not None}
    if set(named) == set(spec.natural_key):
        is_unknown = F.lit(True)
        for c, value in named.items():
            is_unknown &= F.col(c).eqNullSafe(F.lit(value))
        rows = rows.where(~is_unknown)
    return rows


def members(sources: Sequence[DataFrame], spec: Dimension) -> DataFrame:
    """One row per natural key over all sources, without keys."""
    return dedupe(member_rows(sources, spec), spec.natural_key)


def with_validity(
    df: DataFrame, spec: Dimension, load_ts: datetime | str | None = None
) -> DataFrame:
    """Add version, date_from, date_to and put the columns in order."""
    loaded = F.current_timestamp() if load_ts is None else F.lit(load_ts)
    return df.withColumns(
        {
            "version": F.lit(FIRST_VERSION),
            "date_from": loaded.cast("timestamp"),
            "date_to": F.lit(OPEN_END).cast("timestamp"),
        }
    ).select(*spec.layout)


def unknown_member(
    like: DataFrame, spec: Dimension, load_ts: datetime | str | None = None
) -> DataFrame:
    """The single row of member 0 in the schema of ``like``."""
    types = {f.name: f.dataType for f in like.schema.fields}
    row = like.sparkSession.range(1).select(
        F.lit(UNKNOWN_KEY).cast(types[spec.tk]).alias(spec.tk),
        *[F.lit(spec.unknown.get(c)).cast(types[c]).alias(c) for c in spec.columns],
    )
    return with_validity(row, spec, load_ts)


def with_unknown(
    dim: DataFrame, spec: Dimension, load_ts: datetime | str | None = None
) -> DataFrame:
    return unknown_member(dim, spec, load_ts).unionByName(dim)


def without_unknown(dim: DataFrame, tk: str) -> DataFrame:
    return dim.where(F.col(tk) != UNKNOWN_KEY)


def build_dimension(
    sources: Sequence[DataFrame], spec: Dimension, load_ts: datetime | str | None = None
) -> DataFrame:
    """Members of all sources, keyed 1..n in the order of the natural key, plus member 0."""
    keyed = dense_key(members(sources, spec), list(spec.natural_key), spec.tk)
    return with_unknown(with_validity(keyed, spec, load_ts), spec, load_ts)


def missing_members(
    rows: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Distinct keys of ``rows`` that ``dim`` lacks. Keys are made distinct before the join."""
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    names = {left: f"_member_{i}" for i, left in enumerate(pairs)}
    keys = drop_null_keys(rows.select(*pairs), [c for c in pairs if c not in null_safe]).distinct()
    known = dim.select(*[F.col(right).alias(names[left]) for left, right in pairs.items()])
    condition = F.lit(True)
    for left, member in names.items():
        if left in null_safe:
            condition &= F.col(left).eqNullSafe(F.col(member))
        else:
            condition &= F.col(left) == F.col(member)
    return keys.join(known, condition, "left_anti")


def _absent(incoming: DataFrame, dim: DataFrame, spec: Dimension) -> DataFrame:
    """The members of ``incoming`` whose natural key ``dim`` lacks."""
    known = dim.select(*[F.col(c).alias(f"_known_{c}") for c in spec.natural_key])
    condition = F.lit(True)
    for c in spec.natural_key:
        if c in spec.nullable_key:
            condition &= F.col(c).eqNullSafe(F.col(f"_known_{c}"))
        else:
            condition &= F.col(c) == F.col(f"_known_{c}")
    return incoming.join(known, condition, "left_anti")


def new_members(
    dim: DataFrame,
    sources: Sequence[DataFrame],
    spec: Dimension,
    load_ts: datetime | str | None = None,
) -> DataFrame:
    """Rows to append to ``dim``: members of ``sources`` it lacks, keyed on from its highest.

    Like ``backfill_rows`` they are written already.
    """
    absent = _absent(members(sources, spec), dim, spec)
    return with_validity(append_keys(dim, absent, list(spec.natural_key), spec.tk), spec, load_ts)


def upsert_dimension(
    dim: DataFrame,
    sources: Sequence[DataFrame],
    spec: Dimension,
    load_ts: datetime | str | None = None,
) -> DataFrame:
    """``dim`` plus its new members. Existing rows keep key, version and dates."""
    return dim.unionByName(new_members(dim, sources, spec, load_ts))


def backfill_rows(
    dim: DataFrame,
    rows: DataFrame,
    spec: Dimension,
    load_ts: datetime | str | None = None,
) -> DataFrame:
    """Rows to append to ``dim``: the key combinations of ``rows`` it lacks.

    Attributes that ``rows`` have are taken from the lowest row of a key; others stay empty.
    They are already written to the shared folder, so they may be appended to the very table
    ``dim`` was read from.
    """
    carried = [c for c in spec.attributes if c in rows.columns]
    required = [c for c in spec.natural_key if c not in spec.nullable_key]
    incoming = drop_null_keys(rows.select(*spec.natural_key, *carried), required)
    absent = _absent(dedupe(incoming, spec.natural_key), dim, spec)
    keyed = append_keys(dim, absent, list(spec.natural_key), spec.tk)
    types = {f.name: f.dataType for f in dim.schema.fields}
    empty = [c for c in spec.attributes if c not in carried]
    filled = keyed.withColumns({c: F.lit(None).cast(types[c]) for c in empty})
    return with_validity(filled, spec, load_ts)


def backfill_dimension(
    dim: DataFrame,
    rows: DataFrame,
    spec: Dimension,
    load_ts: datetime | str | None = None,
) -> DataFrame:
    """``dim`` plus its backfilled rows."""
    return dim.unionByName(backfill_rows(dim, rows, spec, load_ts))
