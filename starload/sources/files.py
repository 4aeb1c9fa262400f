"""CSV and Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starload.tables import materialize


#: How null is written where the whole text has to survive: an empty field is then empty text.
NULL_TEXT = "\\N"
_REJECT = "_reject"


def _options(delimiter: str, quote: str, whole_text: bool) -> dict[str, object]:
    options: dict[str, object] = {"header": True, "sep": delimiter, "quote": quote, "escape": quote}
    if whole_text:
        options |= {"nullValue": NULL_TEXT, "emptyValue": ""}
    return options


def as_schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    delimiter: str = ",",
    quote: str = '"',
    trim: bool = False,
    date_format: str = "yyyy-MM-dd",
    whole_text: bool = False,
    on_bad: str = "fail",
    **options: str,
) -> DataFrame:
    """CSV with a header and declared types: no inference pass, codes keep leading zeros.

    Columns are found by the names in the header, in whatever order they stand; a missing one is
    an error, further ones are left out. All files of ``path`` must have the same header.

    A value that does not fit its type raises when the row is read; ``on_bad="keep"`` reads it as
    null and keeps the line in the column ``_reject`` (null for good rows), see ``split_rejects``.

    ``whole_text`` reads what ``write_csv(whole_text=True)`` wrote: line breaks inside texts, and
    empty texts apart from null. Such a file cannot be split, so write it in many parts.
    """
    if on_bad not in ("fail", "keep"):
        raise ValueError(f"on_bad: {on_bad}")
    reading = _options(delimiter, quote, whole_text) | {
        "dateFormat": date_format,
        "ignoreLeadingWhiteSpace": trim,
        "ignoreTrailingWhiteSpace": trim,
        "multiLine": whole_text,
        "enforceSchema": False,
        "mode": "FAILFAST" if on_bad == "fail" else "PERMISSIVE",
        **options,
    }
    declared = as_schema(schema)
    header = spark.read.options(**reading).csv(path).columns
    missing = [f.name for f in declared.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    wanted = {f.name: f for f in declared.fields}
    there = [wanted.get(name, StructField(name, StringType())) for name in header]
    names = declared.names
    if on_bad == "keep":
        there.append(StructField(_REJECT, StringType()))
        names = [*names, _REJECT]
        reading["columnNameOfCorruptRecord"] = _REJECT
    rows = spark.read.schema(StructType(there)).options(**reading).csv(path)
    return rows.select(*[F.col(f"`{name}`") for name in names])


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, lines that did not fit) of ``read_csv(on_bad="keep")``, read once."""
    saved = materialize(rows, "read")
    good = saved.where(F.col(_REJECT).isNull()).drop(_REJECT)
    return good, saved.where(F.col(_REJECT).isNotNull()).select(F.col(_REJECT).alias("line"))


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    delimiter: str = ",",
    whole_text: bool = False,
) -> None:
    """CSV parts with a header and no index column. Outer spaces and quotes survive;
    with ``whole_text`` also line breaks and the difference between empty and null."""
    writing = _options(delimiter, '"', whole_text) | {
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    if whole_text:
        writing |= {"quoteAll": True, "emptyValue": '""'}
    df.write.mode(mode).options(**writing).csv(path)


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def create_table(
    spark: SparkSession, path: str, schema: StructType, overwrite: bool = False
) -> DataFrame:
    """Empty Parquet table with the declared columns; ``overwrite`` resets an existing one."""
    mode = "overwrite" if overwrite else "errorifexists"
    spark.createDataFrame([], schema).write.mode(mode).parquet(path)
    return read_parquet(spark, path, schema)


def overwrite_table(df: DataFrame, path: str, reads_target: bool = False) -> DataFrame:
    """Replace the table at ``path``. Say ``reads_target`` if ``df`` is computed from it."""
    if reads_target:
        df = materialize(df, "overwrite")
    df.write.mode("overwrite").parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)


def append_table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)


def _same_schema(written: DataFrame, read: DataFrame) -> Column:
    def shape(df: DataFrame) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

    return F.lit(shape(written) == shape(read)).alias("same_schema")


def readback_count(written: DataFrame, read: DataFrame) -> DataFrame:
    """One row: rows written, rows read back, and whether column names and types agree."""

    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
        for side, df in (("written", written), ("read", read))
    ]
    return (
        counts[0]
        .unionByName(counts[1])
        .agg(
            F.sum(F.when(F.col("side") == "written", F.col("n"))).alias("rows_written"),
            F.sum(F.when(F.col("side") == "read", F.col("n"))).alias("rows_read"),
        )
        .withColumn("same_schema", _same_schema(written, read))
    )


def table_checksum(df: DataFrame) -> DataFrame:
    """One row, ``n_rows``, ``sum_1``, ``sum_2``: equal for tables with the same rows, each as often,
    in any order, and (but for a chance of 2 ** -64 and less) for no others.

    One pass, summed in each task. Columns count in their order, a null apart from every value.
    """
    nulls = F.concat(F.lit(""), *[F.col(f"`{c}`").isNull().cast("string") for c in df.columns])
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.select(
        *[F.xxhash64(F.lit(i), nulls, *columns).cast("decimal(38,0)").alias(f"h{i}") for i in (1, 2)]
    )
    return hashed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("h1"), F.lit(0)).alias("sum_1"),
        F.coalesce(F.sum("h2"), F.lit(0)).alias("sum_2"),
    )


def readback_content(written: DataFrame, read: DataFrame) -> DataFrame:
    """``readback_count``, and whether all rows came back as they were (``same_content``)."""
    if set(written.columns) != set(read.columns):
        return readback_count(written, read).withColumn("same_content", F.lit(False))
    again = read.select(*[F.col(f"`{c}`") for c in written.columns])
    sides = [
        table_checksum(df).withColumn("side", F.lit(side))
        for side, df in (("written", written), ("read", again))
    ]

    def rows(side: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col("n_rows")))

    same = [F.min(c) == F.max(c) for c in ("n_rows", "sum_1", "sum_2")]
    return (
        sides[0]
        .unionByName(sides[1])
        .agg(
            rows("written").alias("rows_written"),
            rows("read").alias("rows_read"),
            (same[0] & same[1] & same[2]).alias("same_content"),
        )
        .select("rows_written", "rows_read", _same_schema(written, read), "same_content")
    )
