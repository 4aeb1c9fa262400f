from datetime import date

import pytest
from frames import rows
from pyspark.sql import functions as F

from starload.functions import (
    duration_elapsed,
    duration_hours,
    iso_date,
    norm_str,
    parse_date,
    replace_text,
    seeded_hash,
    seeded_int,
    tidy_text,
)
from starload.functions.dates import _shape, parse_timestamp


def one(spark, value, make):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(make(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("  Miami-Dade ", "MIAMI-DADE"),
        ("\tLee", "\tLEE"),
        ("", ""),
        ("   ", ""),
        (None, None),
        ("unknown", "UNKNOWN"),
    ],
)
def test_norm_str_trims_spaces_only(spark, value, expected):
    assert one(spark, value, norm_str) == expected


def test_norm_str_with_more_characters(spark):
    assert one(spark, "\t Lee \n", lambda c: norm_str(c, chars=" \t\n")) == "LEE"


def test_tidy_text(spark):
    assert one(spark, " ab ", lambda c: tidy_text(c, trim="left")) == "AB "
    assert one(spark, " ab ", lambda c: tidy_text(c, trim="right", case="lower")) == " ab"
    assert one(spark, "7", lambda c: tidy_text(c, pad="left", pad_char="0", pad_length=3)) == "007"
    assert one(spark, "1234", lambda c: tidy_text(c, pad="left", pad_char="0", pad_length=3)) == "1234"
    assert one(spark, "new york", lambda c: tidy_text(c, case=None, initcap=True)) == "New York"
    assert one(spark, "a1b2", lambda c: tidy_text(c, digits="only")) == "12"
    assert one(spark, "a1b2", lambda c: tidy_text(c, digits="remove")) == "AB"


def test_replace_text(spark):
    assert one(spark, "a.b", lambda c: replace_text(c, "", "x")) == "a.b"
    assert one(spark, "a.b", lambda c: replace_text(c, ".", "$", regex=False)) == "a$b"
    assert one(spark, "a1b22", lambda c: replace_text(c, "[0-9]+", "#")) == "a#b#"
    assert one(spark, "Ab aB", lambda c: replace_text(c, "AB", "$1\\", regex=False, ignore_case=True)) == "$1\\ $1\\"
    assert one(spark, "cat category", lambda c: replace_text(c, "cat", "dog", whole_word=True)) == "dog category"
    assert one(spark, None, lambda c: replace_text(c, "a", "b")) is None


def test_parse_date_turns_bad_text_into_null(spark):
    day = date(2005, 8, 29)
    assert one(spark, "2005-08-29T00:00:00Z", parse_date) == day
    assert one(spark, "2005-08-29", parse_date) == day
    assert one(spark, "29.8.2005", parse_date) is None
    assert one(spark, "unknown", parse_date) is None
    assert one(spark, None, parse_date) is None
    assert one(spark, "2005-08-29T23:59:59Z", iso_date) == "2005-08-29"
    assert one(spark, "2005-08-29", iso_date) is None


SPANS = [
    # begin, end, calendar hours, elapsed hours
    ("2020-01-01 23:00:00", "2020-01-02 01:00:00", 24, 0),
    ("2020-01-02 01:00:00", "2020-01-01 23:00:00", -24, -24),
    ("2020-01-01 00:00:00", "2020-01-01 00:00:00", 0, 0),
    ("2020-01-01 00:00:00", "2020-01-03 00:00:00", 48, 48),
    ("2020-01-03 00:00:00", "2020-01-01 00:00:00", -48, -48),
    ("2020-01-01 00:00:00", "2020-01-02 23:59:59.999999", 24, 24),
    ("2020-01-01 00:00:00.000001", "2020-01-01 00:00:00", 0, -24),
]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_two_kinds_of_duration(spark, kind):
    df = spark.createDataFrame(SPANS, "b string, e string, hours int, elapsed int").select(
        F.col("b").cast(kind), F.col("e").cast(kind), "hours", "elapsed"
    )
    wrong = df.where(
        (duration_hours("b", "e") != F.col("hours"))
        | (duration_elapsed("b", "e") != F.col("elapsed"))
    )
    assert wrong.count() == 0


def test_duration_ignores_clock_changes_of_the_session(spark, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    df = spark.sql("select timestamp_ntz'2021-03-14 00:00:00' b, timestamp_ntz'2021-03-15 00:00:00' e")
    assert df.select(duration_elapsed("b", "e")).first()[0] == 24


@pytest.mark.parametrize(
    "format, shape",
    [
        ("yyyy-MM-dd'T'HH:mm:ss'Z'", "____-__-__T__:__:__Z"),
        ("yyyyMMdd", "________"),
        ("'mm'yyyy", "mm____"),
        ("d.M.yyyy", None),
        ("dd MMMM yyyy", None),
        ("yyyy[-MM]", None),
        ("yyyy''MM", None),
        ("yyyy_MM", None),
    ],
)
def test_shape_of_a_format(format, shape):
    assert _shape(format) == shape


def test_parse_with_any_format(spark):
    formats = ["d.M.yyyy", "dd MMMM yyyy", "yyyyMMdd"]
    for text in ("1.2.2020", "01 February 2020", "20200201"):
        assert one(spark, text, lambda c: parse_date(c, formats)) == date(2020, 2, 1)
    assert one(spark, "20201332", lambda c: parse_date(c, formats)) is None
    assert one(spark, "2020-02-0a", parse_date) is None


def test_parsed_timestamps_ignore_clock_changes_too(spark, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    df = spark.sql("select '2005-03-01T00:00:00Z' b, '2005-05-01T00:00:00Z' e")
    hours = duration_elapsed(parse_timestamp("b"), parse_timestamp("e"))
    assert df.select(hours, iso_date("b")).first() == (61 * 24, "2005-03-01")


def test_given_duration_wins(spark):
    df = spark.sql("select date'2020-01-01' b, date'2020-01-03' e, 7 g, cast(null as int) n")
    assert df.select(duration_hours("b", "e", "g"), duration_hours("b", "e", "n")).first() == (7, 48)
    assert df.select(duration_hours(F.lit(None).cast("date"), "e", "n")).first()[0] is None


def test_seeded_int_depends_on_seed_and_key_only(spark):
    df = spark.range(2000)
    first = rows(df.select("id", seeded_int(["id"], 24, 1, low=1).alias("h")))
    again = rows(df.repartition(7).select("id", seeded_int(["id"], 24, 1, low=1).alias("h")))
    other = rows(df.select("id", seeded_int(["id"], 24, 2, low=1).alias("h")))
    assert first == again != other
    assert {h for _, h in first} == set(range(1, 25))


def test_seeded_int_of_a_large_range(spark):
    got = spark.range(2000).select(seeded_int(["id"], 10**12, 1).alias("h")).agg({"h": "max"})
    assert 2**32 < got.first()[0] < 10**12
    for n in (0, 16**15 + 1):
        with pytest.raises(ValueError):
            seeded_int(["id"], n, 1)


def test_seeded_hash_tells_parts_apart(spark):
    df = spark.sql("select * from values (1, null), (null, 1), (null, null) t(a, b)")
    texts = spark.sql("select * from values ('a:b', 'c'), ('a', 'b:c') t(a, b)")
    for rows_ in (df, texts):
        hashes = [r[0] for r in rows_.select(seeded_hash(["a", "b"], 1)).collect()]
        assert len(set(hashes)) == len(hashes)


def test_seeded_hash_of_null(spark):
    df = spark.sql("select cast(null as string) k")
    assert len(df.select(seeded_hash(["k"], 1)).first()[0]) == 32
