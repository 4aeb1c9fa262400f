import pytest
from frames import rows
from pyspark.sql import functions as F

from starload.operators.dimensions import (
    Dimension,
    backfill_dimension,
    build_dimension,
    missing_members,
    upsert_dimension,
    without_unknown,
)
from starload.operators.lookup import fk_first_match, resolve_key
from starload.operators.mapping import map_codes
from starload.plans.declarations import (
    DATES_DIM,
    DATES_PAIR_DIM,
    DECLARATION_DIM,
    STATE_DIM,
)

LOADED = "2024-01-01 00:00:00"

# Small limits, so that test data counts as skewed.
SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "20",
}


def states(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "state_name string")


def dates(spark, *values):
    df = spark.createDataFrame(list(values), "b string, e string, d bigint")
    return df.select(
        F.col("b").cast("date").alias("incident_begin_date"),
        F.col("e").cast("date").alias("incident_end_date"),
        F.col("d").alias("incident_duration"),
    )


def test_build_dimension(spark):
    first = states(spark, " Texas", "texas ", None, "unknown", "Ohio")
    second = states(spark, "OHIO", "Guam", "\tGuam")
    dim = build_dimension([first, second], STATE_DIM, LOADED)
    assert dim.columns == ["state_tk", "version", "date_from", "date_to", "state_name"]
    assert rows(dim, "state_tk", "state_name") == [
        (0, "UNKNOWN"),
        (1, "\tGUAM"),
        (2, "GUAM"),
        (3, "OHIO"),
        (4, "TEXAS"),
    ]
    stamps = dim.select("version", F.col("date_from").cast("string"), F.col("date_to").cast("string"))
    assert rows(stamps.distinct()) == [(1, LOADED, "2200-01-01 00:00:00")]
    assert without_unknown(dim, "state_tk").count() == 4


def test_unknown_member_of_each_dimension(spark):
    empty = spark.createDataFrame(
        [],
        """declaration_request_number bigint, declaration_title string, declaration_type string,
        declaration_date date, ih_program_declared boolean, ia_program_declared boolean,
        hm_program_declared boolean, pa_program_declared boolean""",
    )
    only = build_dimension([empty], DECLARATION_DIM, LOADED).first()
    assert only["declaration_tk"] == 0 and only["ih_program_declared"] is False
    assert only["declaration_title"] is None and only["date_to"] is not None
    row = build_dimension([dates(spark)], DATES_DIM, LOADED).first()
    assert (row["incident_dates_tk"], row["incident_begin_date"], row["incident_duration"]) == (0, None, 0)


def test_grain_of_the_dates_dimension(spark):
    df = dates(
        spark,
        ("2020-01-01", "2020-01-02", 24),
        ("2020-01-01", "2020-01-02", 7),
        ("2020-01-01", "2020-01-02", None),
        ("2020-01-01", None, 3),
    )
    triples = build_dimension([df], DATES_DIM, LOADED)
    assert rows(triples, "incident_dates_tk", "incident_duration") == [(0, 0), (1, None), (2, 7), (3, 24)]
    assert build_dimension([df], DATES_PAIR_DIM, LOADED).count() == 2


def test_current_timestamp_by_default(spark):
    assert build_dimension([states(spark, "A")], STATE_DIM).where("date_from is null").count() == 0


def test_upsert_twice_is_once(spark):
    dim = build_dimension([states(spark, "Ohio", "Utah")], STATE_DIM, LOADED)
    incoming = states(spark, "utah", "Guam", "unknown", None)
    once = upsert_dimension(dim, [incoming], STATE_DIM, LOADED)
    assert rows(once, "state_tk", "state_name") == [(0, "UNKNOWN"), (1, "OHIO"), (2, "UTAH"), (3, "GUAM")]
    assert rows(upsert_dimension(once, [incoming], STATE_DIM, LOADED)) == rows(once)


def test_backfill_and_missing(spark):
    dim = build_dimension([dates(spark, ("2020-01-01", "2020-01-02", 24))], DATES_DIM, LOADED)
    new = dates(
        spark,
        ("2020-01-01", "2020-01-02", 24),
        ("2020-01-01", "2020-01-02", None),
        ("2019-01-01", "2019-01-02", 5),
        ("2019-01-01", "2019-01-02", 5),
        (None, "2019-01-02", 5),
    )
    missing = missing_members(new, dim, DATES_DIM.natural_key, DATES_DIM.nullable_key)
    assert missing.count() == 2
    filled = backfill_dimension(dim, new, DATES_DIM, LOADED)
    assert rows(filled, "incident_dates_tk", "incident_duration") == [(0, 0), (1, 24), (2, 5), (3, None)]
    again = backfill_dimension(filled, new, DATES_DIM, LOADED)
    assert rows(again) == rows(filled)


def test_backfill_of_a_dimension_with_attributes(spark):
    spec = Dimension(tk="tk", natural_key=["n"], attributes=["a"])
    dim = build_dimension([spark.sql("select 1 n, 'x' a")], spec, LOADED)
    filled = backfill_dimension(dim, spark.sql("select 2 n"), spec, LOADED)
    assert rows(filled, "tk", "n", "a") == [(0, None, None), (1, 1, "x"), (2, 2, None)]


DIM = [(0, "UNKNOWN"), (1, "OHIO"), (2, "UTAH"), (5, "UTAH")]


def test_resolve_key_on_hit_miss_and_null(spark):
    dim = spark.createDataFrame(DIM, "tk bigint, name string")
    df = spark.createDataFrame([(1, "OHIO"), (2, "UTAH"), (3, "GUAM"), (4, None), (5, "UNKNOWN")], "id int, name string")
    assert rows(resolve_key(df, dim, ["name"], "tk"), "id", "tk") == [(1, 1), (2, 2), (3, 0), (4, 0), (5, 0)]
    assert rows(resolve_key(df, dim, ["name"], "tk", on_miss="drop"), "id", "tk") == [(1, 1), (2, 2), (5, 0)]
    assert rows(fk_first_match(df, dim, ["name"], id="tk"), "id", "fk")[3] == (4, None)
    with pytest.raises(ValueError):
        resolve_key(df, dim, ["name"], "tk", on_miss="?")


def test_resolve_key_by_other_names_and_null_safe(spark):
    dim = dates(spark, ("2020-01-01", "2020-01-02", None), ("2020-01-01", "2020-01-02", 0))
    dim = dim.withColumn("tk", F.when(F.col("incident_duration").isNull(), 1).otherwise(2))
    df = dates(spark, ("2020-01-01", "2020-01-02", None), ("2020-01-01", "2020-01-02", 0), (None, None, None)).toDF("b", "e", "d")
    on = {"b": "incident_begin_date", "e": "incident_end_date", "d": "incident_duration"}
    assert rows(resolve_key(df, dim, on, "tk", null_safe=["d"]), "d", "tk") == [(None, 0), (None, 1), (0, 2)]
    assert rows(resolve_key(df, dim, on, "tk"), "d", "tk") == [(None, 0), (None, 0), (0, 2)]


def test_small_dimension_is_broadcast_and_large_one_is_not(spark, settings, plan):
    dim = build_dimension([states(spark, "Ohio", "Utah")], STATE_DIM, LOADED)
    df = states(spark, "OHIO")
    assert "BroadcastHashJoin" in plan(resolve_key(df, dim, ["state_name"], "state_tk", unique=True))
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    large = resolve_key(df, dim, ["state_name"], "state_tk", unique=True)
    assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)


HOT = """case id % 3 when 0 then 'HOT' when 1 then null else 'N' || id end"""


@pytest.mark.parametrize("unique", [True, False])
def test_hot_and_null_keys_are_split(spark, settings, plan, unique):
    """A third of the rows have one name and a third have none."""
    df = spark.range(0, 90_000, 1, 12).select("id", F.expr(HOT).alias("state_name"))
    dim = build_dimension([df], STATE_DIM, LOADED)
    settings(**SKEW)
    resolved = resolve_key(df, dim, ["state_name"], "state_tk", unique=unique)
    assert resolved.count() == 90_000
    counts = resolved.groupBy("state_tk").count().orderBy(F.desc("count")).take(3)
    assert [r["count"] for r in counts] == [30_000, 30_000, 1]
    resolved.collect()
    assert "skew=true" in plan(resolved)


def test_hot_codes_are_split(spark, settings, plan):
    df = spark.range(0, 90_000, 1, 12).select("id", F.expr(HOT).alias("code"))
    codes = df.where("code is not null").select("code", F.lower("code").alias("name"))
    settings(**SKEW)
    mapped = map_codes(df, "code", codes)
    assert mapped.where("code = 'hot'").count() == 30_000
    mapped.collect()
    assert "skew=true" in plan(mapped)


def test_null_safe_key_stays_a_join_key(spark, settings, plan):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    df = dates(spark, ("2020-01-01", "2020-01-02", None))
    dim = df.withColumn("tk", F.lit(1))
    text = plan(resolve_key(df, dim, DATES_DIM.natural_key, "tk", null_safe=["incident_duration"]))
    join = next(line for line in text.splitlines() if "SortMergeJoin" in line)
    assert "isnull(incident_duration" in join
