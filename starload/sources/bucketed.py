"""Tables that are written in buckets of a key, so that joins on it need no exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.sources.files import as_schema


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    keys: Sequence[str],
    buckets: int,
    files_per_bucket: int = 1,
    mode: str = "errorifexists",
) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` buckets of ``keys``, sorted by them, as the
    catalog table ``name``, and read it back.

    Tables with the same number of buckets and key types join on the keys bucket by bucket: the
    exchange and the sort are paid once here, not in every join. One task writes each file;
    ``files_per_bucket`` spreads a bucket that is too large for one (joins then sort its files
    again, but still need no exchange). A hot key stays in one bucket: look it up with
    ``resolve_hot_key``.
    """
    if files_per_bucket > 1:
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_bucket))
        dealt = df.repartition(buckets * files_per_bucket, *keys, salt)
    else:
        dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    writer.format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def declare_bucketed(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType | str,
    keys: Sequence[str],
    buckets: int,
) -> DataFrame:
    """The files that ``write_bucketed`` left under ``path``, in a session that does not know them."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in as_schema(schema).fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
