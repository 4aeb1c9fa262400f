"""Checks by bitmaps, sketches and checksums equal those that read every key."""

import pytest
from frames import rows
from pyspark.sql import functions as F

from starload.operators.bitmaps import distinct_keys, fk_orphans_dense, pk_violations_dense
from starload.operators.quality import fk_orphans, pk_violations
from starload.operators.sketches import distinct_estimates, distinct_sketches
from starload.operators.split import split_exact_bag
from starload.sources import readback_content, table_checksum

KEYS = [0, 1, 32767, 32768, 32769, 65536, -1, -32768, -32769, 2**62, -(2**62)]


def keys(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint").repartition(3)


@pytest.mark.parametrize("values", [[], KEYS, KEYS * 2, KEYS + [None, None, 1, 1], [None]])
def test_keys_that_repeat(spark, values):
    df = keys(spark, values)
    assert rows(pk_violations_dense(df, "k")) == rows(pk_violations(df, ["k"]))
    assert rows(distinct_keys(df, "k")) == [(len({v for v in values if v is not None}),)]


@pytest.mark.parametrize("known", [[], KEYS, KEYS[:4], KEYS[3:] + [None]])
@pytest.mark.parametrize("values", [[], KEYS + [7, 7, 65537], KEYS[:4] * 3, [None, None, 5]])
def test_keys_without_a_parent(spark, values, known):
    child, parent = keys(spark, values), keys(spark, known, "p")
    assert rows(fk_orphans_dense(child, parent, "k", "p")) == rows(fk_orphans(child, parent, "k", "p"))


def test_dense_keys_send_bitmaps_only(spark):
    """Where nothing is wrong, no key leaves its task."""
    parent = spark.range(100_000).select(F.col("id").alias("p"))
    child = spark.range(300_000).select((F.col("id") % 100_000).alias("k"))
    assert fk_orphans_dense(child, parent, "k", "p").isEmpty()
    assert pk_violations_dense(parent, "p").isEmpty()
    assert rows(fk_orphans_dense(child, parent.where("p <> 99999"), "k", "p")) == [(99999, 3)]


def test_sketches_of_loads_add_up(spark, tmp_path):
    df = spark.range(50_000).select(
        (F.col("id") % 20_000).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 10).alias("b"),
        F.lit(None).cast("date").alias("c"),
    )
    path = str(tmp_path / "sketches")
    for load in range(3):
        part = df.where(F.col("a") % 3 == load)
        distinct_sketches(part, df.columns, str(load)).write.mode("append").parquet(path)
    found = dict(rows(distinct_estimates(spark.read.parquet(path))))
    assert abs(found["a"] - 20_000) < 600 and found["b"] == 5 and found["c"] == 0
    # A load done twice counts once.
    distinct_sketches(df.where("a % 3 = 0"), df.columns, "0").write.mode("append").parquet(path)
    assert dict(rows(distinct_estimates(spark.read.parquet(path)))) == found


@pytest.mark.parametrize("fraction", [0, 0.1, 0.37, 0.5, 0.999, 1])
def test_exact_sample_of_rows_that_repeat(spark, fraction):
    id = F.col("id")
    df = spark.range(1000).select(
        F.when(id < 600, F.lit(None)).otherwise(id % 7).alias("a"), F.lit("x").alias("b")
    )
    sample, rest = split_exact_bag(df, fraction, 3)
    assert sample.count() == round(fraction * 1000)
    assert rows(sample.unionByName(rest)) == rows(df)
    again, _ = split_exact_bag(df.repartition(5), fraction, 3)
    assert rows(again) == rows(sample)
    assert split_exact_bag(df.limit(0), fraction, 3)[0].count() == 0


def test_content_that_changed(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (2, None, "a")], "i int, s string, t string")

    def same(other):
        return readback_content(df, other).first()["same_content"]

    assert same(df.repartition(3)) and same(df.select("t", "s", "i"))
    assert not same(df.select("i", F.col("t").alias("s"), F.col("s").alias("t")))
    assert not same(df.distinct()) and not same(df.limit(0))
    assert not same(df.unionByName(df.limit(1)))
    assert not same(df.withColumn("i", F.lit(2))) and not same(df.drop("t"))
    none = df.limit(0)
    assert readback_content(none, none).first()["same_content"]
    assert table_checksum(none).first()["n_rows"] == 0
