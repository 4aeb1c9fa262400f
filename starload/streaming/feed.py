"""A folder of arriving increments feeds the stored star."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from starload.plans.declarations import apply_increment


def feed_increments(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    folder: str,
    checkpoint: str,
    load_ts: datetime | str | None = None,
    tie_break: Sequence[str] | None = None,
    files_per_batch: int | None = None,
    name: str = "feed",
) -> StreamingQuery:
    """Add the Parquet files in ``source`` that are not in yet to the star under ``folder``.

    Takes what is there in batches of ``files_per_batch`` files and returns the ended query. Run
    again (by a scheduler) it takes what has come since. ``checkpoint`` remembers the files that
    were read; a batch that broke off is planned again with the same files and number, and
    ``apply_increment`` lets each number of ``name`` in once, so no row is lost or doubled.
    ``checkpoint`` and ``name`` belong together: give both anew, or neither.
    """

    def add(batch: DataFrame, number: int) -> None:
        apply_increment(
            batch.sparkSession, folder, batch, f"{name}-{number}", load_ts, tie_break
        )

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = reader.parquet(source).writeStream.foreachBatch(add)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
