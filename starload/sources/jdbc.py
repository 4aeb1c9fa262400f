"""JDBC. Connection details always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Partitioning:
    """Split of a table read over executors: ranges of a numeric, date or timestamp column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partitioning: Partitioning | None = None,
    fetchsize: int | None = None,
) -> DataFrame:
    """Table or parenthesised subquery. Without ``partitioning`` one task reads it all."""
    reader = spark.read.format("jdbc").options(**dict(properties or {})).option("url", url)
    reader = reader.option("dbtable", table)
    if fetchsize is not None:
        reader = reader.option("fetchsize", fetchsize)
    if partitioning is not None:
        reader = reader.options(
            partitionColumn=partitioning.column,
            lowerBound=partitioning.lower,
            upperBound=partitioning.upper,
            numPartitions=partitioning.partitions,
        )
    return reader.load()


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    partitioning: Partitioning | None = None,
    fetchsize: int | None = None,
) -> DataFrame:
    """SQL text run by the database: projection, alias, DISTINCT and aggregates stay there."""
    return read_jdbc(spark, url, f"({query}) q", properties, partitioning, fetchsize)


def max_key_query(table: str, tk: str) -> str:
    """SQL for the highest key. Spark does not push MAX through a JDBC read by itself."""
    return f'select coalesce(max("{tk}"), 0) as "max_key" from {table}'


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    truncate: bool = False,
    column_types: Mapping[str, str] | None = None,
    batchsize: int = 10_000,
    partitions: int | None = None,
) -> None:
    """Write over JDBC. ``mode``: overwrite (drop and create), append.

    ``truncate`` empties the table instead of dropping it, ``column_types`` declares types for a
    new table, ``partitions`` bounds the number of open connections.
    """
    writer = df.write.format("jdbc").mode(mode).options(**dict(properties or {}))
    writer = writer.options(url=url, dbtable=table, batchsize=batchsize, truncate=truncate)
    if column_types:
        types = ", ".join(f"{name} {kind}" for name, kind in column_types.items())
        writer = writer.option("createTableColumnTypes", types)
    if partitions is not None:
        writer = writer.option("numPartitions", partitions)
    writer.save()
