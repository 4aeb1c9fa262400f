"""Checks of integer keys by exact bitmaps.

Keys are set as bits in buckets of 32,768, first within each task and then merged, so that what is
shuffled is a bitmap per task and bucket instead of a row per key. That is the cheaper way for keys
that are dense and lie together, like surrogate keys in the order they were given out. A bucket
whose counts do not add up holds the violations; only rows of such buckets are grouped and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.tables import materialize


def _bucket(key: str) -> Column:
    return F.bitmap_bucket_number(F.col(key))


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(bucket, bits, n_rows) of the keys that are not null."""
    rows = df.where(F.col(key).isNotNull())
    return rows.groupBy(_bucket(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bits"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """One row, ``n_distinct``: exact, nulls not counted."""
    counted = key_bitmaps(df, key).select(F.bitmap_count("bits").alias("n"))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_distinct"))


def _in_buckets(df: DataFrame, key: str, buckets: DataFrame) -> DataFrame:
    rows = df.where(F.col(key).isNotNull()).withColumn("_bucket", _bucket(key))
    chosen = buckets.select(F.col("bucket").alias("_bucket"))
    return rows.join(chosen, "_bucket", "left_semi").drop("_bucket")


def pk_violations_dense(df: DataFrame, key: str) -> DataFrame:
    """``pk_violations`` of one integer column: keys that occur more than once, and null."""
    narrow = df.select(key)
    marked = key_bitmaps(narrow, key).where(F.col("n_rows") > F.bitmap_count("bits"))
    doubled = materialize(marked.select("bucket"), "doubled")
    counts = _in_buckets(narrow, key, doubled).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    nulls = narrow.where(F.col(key).isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where("n_rows > 1").unionByName(nulls)


def fk_orphans_dense(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """``fk_orphans`` of one integer column: foreign keys without a parent, with their row count.

    A bucket has orphans if the bits of both sides together are more than the parent's.
    """
    sides = key_bitmaps(child.select(fk), fk).withColumn("known", F.lit(None).cast("binary"))
    parents = key_bitmaps(parent.select(pk), pk).withColumn("known", F.col("bits"))
    both = sides.unionByName(parents).groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"),
        F.max(F.coalesce(F.bitmap_count("known"), F.lit(0))).alias("known"),
    )
    broken = materialize(both.where("either > known").select("bucket"), "orphaned")
    keys = _in_buckets(child.select(fk), fk, broken)
    counts = keys.groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    members = _in_buckets(parent.select(F.col(pk).alias("_pk")), "_pk", broken)
    return counts.join(members, F.col(fk) == F.col("_pk"), "left_anti")
