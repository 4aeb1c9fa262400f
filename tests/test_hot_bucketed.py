"""Lookups that hot keys do not slow down, and those that need no exchange."""

from uuid import uuid4

import pytest
from frames import rows
from pyspark.sql import functions as F

from starload.operators.hot import hot_hashes, resolve_hot_key
from starload.operators.lookup import resolve_key
from starload.sources import declare_bucketed, write_bucketed
from starload.tables import fresh_path, materialize


def facts(spark):
    """A third of the rows on one key, a third without a key, the rest spread, some unknown."""
    id = F.col("id")
    key = F.when(id % 3 == 0, 5).when(id % 3 == 1, F.lit(None)).otherwise(id % 2000)
    name = F.when(id % 5 == 0, F.lit(None)).otherwise((id % 2).cast("string"))
    return materialize(
        spark.range(12_000).select("id", key.cast("bigint").alias("key"), name.alias("name")), "facts"
    )


def members(spark):
    id = F.col("id")
    name = F.when(id % 2 == 0, F.lit(None)).otherwise(F.floor(id % 4 / 2).cast("string"))
    every = spark.range(1500).where("id % 7 <> 0").select(
        id.alias("key"), name.alias("name"), (id + 10).alias("tk")
    )
    return every.unionByName(every.withColumn("tk", F.col("tk") + 5000))


@pytest.mark.parametrize("on_miss", ["default", "null", "drop"])
@pytest.mark.parametrize("null_safe", [[], ["name"], ["key", "name"]])
@pytest.mark.parametrize("share", [0.01, 0.9])
def test_equals_the_plain_lookup(spark, on_miss, null_safe, share):
    df, dim = facts(spark), members(spark)
    on = ["key", "name"]
    expected = resolve_key(df, dim, on, "tk", null_safe, on_miss)
    got = resolve_hot_key(df, dim, on, "tk", null_safe, on_miss, share=share)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)


def test_each_branch_in_the_plan(spark, settings, plan):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    df = facts(spark)
    dim = materialize(members(spark).where("tk < 5000"), "dim")
    got = resolve_hot_key(df, dim, ["key"], "tk", unique=True)
    text = plan(got)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" in text and text.count("Union") > 0
    # Nothing is found twice and nothing is lost.
    assert got.count() == df.count() == got.select("id").distinct().count()
    assert rows(got) == rows(resolve_key(df, dim, ["key"], "tk", unique=True))


def test_hot_keys_are_found(spark):
    df = facts(spark).where("key is not null")
    five = df.where("key = 5").select(F.xxhash64("key")).first()[0]
    assert hot_hashes(df, ["key"], 0.05) == [five]
    assert hot_hashes(df.limit(0), ["key"], 0.05) == []
    with pytest.raises(ValueError):
        hot_hashes(df, ["key"], 0)


def test_types_must_agree(spark):
    dim = members(spark)
    for wrong in ("int", "double"):
        with pytest.raises(ValueError):
            resolve_hot_key(facts(spark).withColumn("key", F.col("key").cast(wrong)), dim, ["key"], "tk")
    doubles = dim.withColumn("key", F.col("key").cast("double"))
    with pytest.raises(ValueError):
        resolve_hot_key(facts(spark).withColumn("key", F.col("key").cast("double")), doubles, ["key"], "tk")


@pytest.mark.parametrize("files", [1, 3])
def test_bucketed_tables_join_without_an_exchange(spark, settings, plan, files):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    df, dim = facts(spark), members(spark).where("tk < 5000")
    label = uuid4().hex
    stored, paths = [], []
    for name, table in (("facts", df), ("members", dim)):
        paths.append(fresh_path(spark, name))
        stored.append(write_bucketed(table, f"{name}_{label}", paths[-1], ["key"], 4, files))
    got = resolve_key(*stored, ["key"], "tk", unique=True)
    assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got)
    expected = rows(resolve_key(df, dim, ["key"], "tk", unique=True))
    assert rows(got) == expected

    # Another session knows the files only.
    again = [
        declare_bucketed(spark, f"again_{name}_{label}", path, table.schema, ["key"], 4)
        for name, path, table in zip(("facts", "members"), paths, (df, dim))
    ]
    got = resolve_key(*again, ["key"], "tk", unique=True)
    assert "Exchange" not in plan(got)
    assert rows(got) == expected
    with pytest.raises(Exception, match="exists"):
        write_bucketed(df, f"facts_{label}", paths[0], ["key"], 4)
    for name in ("facts", "members", "again_facts", "again_members"):
        spark.sql(f"DROP TABLE {name}_{label}")
