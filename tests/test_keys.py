import pytest
from frames import rows
from hypothesis import HealthCheck, given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from starload.operators.copies import expand_copies
from starload.operators.keys import append_keys, dense_key, dense_key_bag, max_key, next_key


def test_dense_key_is_the_global_row_number(spark):
    df = spark.range(5000).select(
        F.expr("id * 7919 % 5003").alias("k"), F.expr("id % 3").alias("hot")
    )
    keyed = dense_key(df.repartition(9), ["hot"], "tk", ties=["k"]).orderBy("tk").collect()
    assert [r["tk"] for r in keyed] == list(range(1, 5001))
    pairs = [(r["hot"], r["k"]) for r in keyed]
    assert pairs == sorted(pairs)


def test_dense_key_splits_a_hot_value(spark, settings):
    """Every row has the same leading value: the ties still spread it over partitions."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(8000).select(F.lit("x").alias("hot"), "id")
    keyed = dense_key(df, ["hot"], "tk", ties=["id"])
    sizes = [r["count"] for r in keyed.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4000


def test_dense_key_start_step_maximum(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert rows(dense_key(df, ["k"], "tk", start=5, step=10), "tk", "k") == [
        (5, None),
        (15, "a"),
        (25, "b"),
    ]
    with pytest.raises(OverflowError):
        dense_key(df, ["k"], "tk", maximum=2)
    assert dense_key(df, ["k"], "tk", maximum=3).count() == 3


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    keyed = dense_key(empty, ["k"], "tk")
    assert keyed.columns == ["k", "tk"] and keyed.count() == 0
    assert dense_key_bag(empty, ["k"], "tk").count() == 0


def test_the_result_is_a_projection_of_a_scan(spark, plan):
    keyed = dense_key(spark.range(100), ["id"], "tk")
    physical = plan(keyed).split("== Physical Plan ==")[1]
    assert "Exchange" not in physical and "Join" not in physical and "Window" not in physical


@hyp(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 2)), min_size=1))
def test_bag_keys_are_a_permutation(spark, values):
    df = spark.createDataFrame(values, "a int, b int")
    got = dense_key_bag(df, ["a"], "tk", chunk=2).orderBy("tk").collect()
    assert [r["tk"] for r in got] == list(range(1, len(values) + 1))
    assert [(r["a"], r["b"]) for r in got] == sorted(
        values, key=lambda t: [(v is not None, v) for v in t]
    )


def test_bag_splits_many_copies(spark):
    df = spark.range(10_000).select(F.lit(0).alias("a"))
    keyed = dense_key_bag(df, ["a"], "tk", chunk=100)
    spread = keyed.groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 4
    assert keyed.agg(F.count("tk"), F.count_distinct("tk"), F.max("tk")).first() == (10_000,) * 3


def test_expand_copies(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 4), ("d", 12)], "k string, n int")
    out = expand_copies(df, "n", "i", chunk=4)
    expected = [(k, n, i) for k, n in (("a", 1), ("b", 7), ("c", 4), ("d", 12)) for i in range(n)]
    assert rows(out) == expected


def test_next_and_append(spark):
    existing = spark.createDataFrame([(0,), (7,)], "tk bigint")
    empty = spark.createDataFrame([], "tk bigint")
    assert next_key(empty, "tk").first()["max_key"] == 0 == max_key(empty, "tk")
    new = spark.createDataFrame([("y",), ("x",)], "k string")
    assert rows(append_keys(existing, new, ["k"], "tk"), "k", "tk") == [("x", 8), ("y", 9)]
    assert rows(append_keys(empty, new, ["k"], "tk"), "k", "tk") == [("x", 1), ("y", 2)]
