"""Column and row clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop named columns; a name that is missing is an error, not a silent no-op."""
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every key column is known.

    One plain test per column, which Spark hands to the scan; ``dropna`` is not pushed down.
    """
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def fill_unknown(
    df: DataFrame, columns: Sequence[str] | None = None, value: str = "unknown"
) -> DataFrame:
    """Replace nulls by ``value`` in the given columns, or in every text column."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.fillna(value, subset=list(columns))


def first_existing_column(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-null value among those of ``names`` that ``df`` has."""
    present = [F.col(n) for n in names if n in df.columns]
    if not present:
        raise ValueError(f"none of {list(names)} in {df.columns}")
    return F.coalesce(*present)


def to_flag(c: Column) -> Column:
    """0/1, true/false or their text to boolean; null where it is neither."""
    return c.cast("string").try_cast("boolean")


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by name; values that do not fit become null."""
    casts = {
        name: to_flag(F.col(name)) if kind == "boolean" else F.col(name).try_cast(kind)
        for name, kind in types.items()
    }
    return df.withColumns(casts)
