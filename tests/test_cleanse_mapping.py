import pytest
from frames import rows
from pyspark.sql import functions as F

from starload.operators.cleanse import (
    cast_columns,
    drop_columns,
    drop_null_keys,
    fill_unknown,
    first_existing_column,
    rename_columns,
)
from starload.operators.mapping import map_codes, map_literal


def test_drop_and_rename(spark):
    df = spark.sql("select 1 a, 2 b, 3 c")
    assert rename_columns(drop_columns(df, ["b"]), {"c": "d"}).columns == ["a", "d"]
    with pytest.raises(ValueError):
        drop_columns(df, ["b", "x"])


def test_drop_null_keys_reaches_the_scan(spark, plan, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k int, v string")
    df.write.parquet(str(tmp_path / "t"))
    kept = drop_null_keys(spark.read.parquet(str(tmp_path / "t")), ["k"])
    assert rows(kept, "k") == [(1,), (3,)]
    assert "PushedFilters: [IsNotNull(k)]" in plan(kept)


def test_fill_unknown_fills_text_only(spark):
    df = spark.createDataFrame([(None, None, "x")], "n int, a string, b string")
    assert fill_unknown(df).first() == (None, "unknown", "x")
    assert fill_unknown(df, ["a"], "?").first() == (None, "?", "x")


def test_first_existing_column(spark):
    df = spark.createDataFrame([(None, "x"), ("s", "y")], "state string, state_name string")
    picked = df.select(first_existing_column(df, ["name", "state", "state_name"]).alias("n"))
    assert rows(picked) == [("s",), ("x",)]
    with pytest.raises(ValueError):
        first_existing_column(df, ["name"])


def test_cast_columns_never_raises(spark):
    df = spark.createDataFrame(
        [("7", "1", "2020-01-02"), ("x", "true", "no date"), (None, "maybe", None)],
        "n string, f string, d string",
    )
    out = cast_columns(df, {"n": "int", "f": "boolean", "d": "date"})
    assert rows(out.select("n", "f", F.col("d").cast("string"))) == [
        (None, None, None),
        (None, True, None),
        (7, True, "2020-01-02"),
    ]


def test_flags_from_numbers(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "f int")
    assert rows(cast_columns(df, {"f": "boolean"})) == [(None,), (False,), (True,)]


CODES = [(1, "01", "Autauga"), (2, "02", "old"), (3, "02", "Baldwin"), (4, None, "nobody")]


def test_map_codes(spark):
    df = spark.createDataFrame([("01",), ("02",), ("99",), (None,)], "fips string")
    codes = spark.createDataFrame(CODES, "line int, code string, name string")
    mapped = map_codes(df, "fips", codes, order="line")
    assert rows(mapped) == [(None,), ("99",), ("Autauga",), ("Baldwin",)]
    strict = map_codes(df, "fips", codes, order="line", keep_unmapped=False, out="name")
    assert rows(strict) == [(None, None), ("01", "Autauga"), ("02", "Baldwin"), ("99", None)]
    # Without an order a double code still yields one row.
    assert map_codes(df, "fips", codes).count() == 4


def test_map_codes_shuffles_a_large_mapping(spark, settings, plan):
    df = spark.createDataFrame([("01",)], "fips string")
    codes = spark.createDataFrame(CODES, "line int, code string, name string")
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    mapped = map_codes(df, "fips", codes, order="line")
    assert "SortMergeJoin" in plan(mapped) and "Broadcast" not in plan(mapped)
    assert rows(mapped) == [("Autauga",)]


def test_map_literal(spark):
    df = spark.createDataFrame([("DR",), ("XX",), (None,)], "t string")
    assert rows(df.select(map_literal("t", {"DR": "disaster"}))) == [(None,), ("XX",), ("disaster",)]
    strict = df.select(map_literal("t", {"DR": "disaster"}, keep_unmapped=False))
    assert rows(strict) == [(None,), (None,), ("disaster",)]
