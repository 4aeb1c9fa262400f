import pytest
from frames import rows
from pyspark.sql import functions as F

from starload.operators.arrange import merge_sorted, sorted_rows, union_all
from starload.operators.dedupe import dedupe, duplicate_rejects
from starload.operators.split import complement, split_exact, split_hash

REQUESTS = [
    (7, "flood", None),
    (7, "fire", 2),
    (7, "fire", 1),
    (7, "fire", 1),
    (8, "storm", 5),
    (None, "wind", 1),
    (None, "hail", 2),
]


@pytest.fixture
def requests(spark):
    return spark.createDataFrame(REQUESTS, "request int, title string, n int")


def test_dedupe_keeps_the_lowest_row(requests):
    expected = [(None, "hail", 2), (7, "fire", 1), (8, "storm", 5)]
    assert rows(dedupe(requests, ["request"])) == expected
    assert rows(dedupe(requests.repartition(4), ["request"])) == expected
    assert rows(dedupe(requests, ["request"], ["n"])) == [
        (None, "wind", 1),
        (7, "fire", 1),  # a missing value comes last
        (8, "storm", 5),
    ]


def test_rejects_and_kept_make_up_the_input(requests):
    kept, rejects = dedupe(requests, ["request"]), duplicate_rejects(requests, ["request"])
    assert rejects.count() == 4
    assert rows(kept.unionByName(rejects)) == rows(requests)


def test_whole_row_dedupe(requests):
    assert dedupe(requests, requests.columns).count() == 6


def test_hot_key_is_reduced_before_the_shuffle(requests, plan):
    assert "WindowGroupLimit" in plan(dedupe(requests, ["request"])).split("Exchange")[1]


def test_split_hash_is_a_partition(spark):
    df = spark.range(1000)
    sample, rest = split_hash(df, ["id"], 0.2, 1)
    assert 150 < sample.count() < 250
    assert rows(sample.unionByName(rest)) == rows(df)
    everything, nothing = split_hash(df, ["id"], 1.0, 1)
    assert (everything.count(), nothing.count()) == (1000, 0)
    nothing, everything = split_hash(df, ["id"], 0.0, 1)
    assert (nothing.count(), everything.count()) == (0, 1000)


@pytest.mark.parametrize("n, fraction", [(0, 0.2), (1, 0.2), (5, 0.2), (1003, 0.2), (10, 1.0), (997, 0.5)])
def test_split_exact_has_the_exact_size(spark, n, fraction):
    df = spark.range(n)
    sample, rest = split_exact(df, ["id"], fraction, 1)
    assert sample.count() == round(fraction * n)
    assert rows(sample.unionByName(rest)) == rows(df)
    assert rows(complement(df, sample, ["id"])) == rows(rest)


def test_split_exact_refines_a_large_prefix(spark, monkeypatch):
    monkeypatch.setattr("starload.operators.split._REFINE", 1)
    sample, rest = split_exact(spark.range(500), ["id"], 0.3, 1)
    assert (sample.count(), rest.count()) == (150, 350)


def test_split_exact_refuses_an_ambiguous_key(spark, monkeypatch):
    df = spark.range(100).select(F.lit(1).alias("k"))
    with pytest.raises(ValueError):
        split_exact(df, ["k"], 0.2, 1)
    monkeypatch.setattr("starload.operators.split._REFINE", 7)
    with pytest.raises(ValueError):
        split_exact(df, ["k"], 0.2, 1)


@pytest.mark.parametrize("split", [split_exact, split_hash])
def test_fractions_beyond_the_range_are_refused(spark, split):
    for fraction in (-0.1, 1.1):
        with pytest.raises(ValueError):
            split(spark.range(3), ["id"], fraction, 1)


def test_a_fraction_just_below_one_takes_nearly_all(spark):
    assert split_hash(spark.range(10_000), ["id"], 0.9999999999, 1)[0].count() == 10_000


def test_null_parts_of_a_key_stay_apart(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (11, None), (None, 11)], "a int, b int")
    sample, rest = split_exact(df, ["a", "b"], 0.5, 1)
    assert (sample.count(), rest.count()) == (2, 2)


def test_a_missing_value_never_wins_over_a_given_one(spark):
    df = spark.createDataFrame([(1, None), (1, "b"), (1, "a"), (2, None)], "k int, v string")
    assert rows(dedupe(df, ["k"])) == [(1, "a"), (2, None)]


def test_union_by_name_and_order(spark):
    a = spark.sql("select 1 x, 'b' y")
    b = spark.sql("select 'A' y, 2 x")
    assert rows(union_all([a, b], ordinal="source")) == [(1, "b", 0), (2, "A", 1)]
    merged = merge_sorted([a, b], ["y"], case_sensitive=False)
    assert [r["y"] for r in merged.collect()] == ["A", "b"]
    words = spark.createDataFrame([("b",), ("A",), ("a",), ("B",), (None,)], "w string")
    assert [r[0] for r in sorted_rows(words, ["w"]).collect()] == [None, "A", "B", "a", "b"]
    got = [r[0] for r in sorted_rows(words, ["w"], case_sensitive=False).collect()]
    assert got == [None, "A", "a", "B", "b"]
