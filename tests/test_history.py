"""Versions of members over several loads, and lookups at a date."""

import random
from datetime import datetime, timedelta

import pytest
from frames import rows
from pyspark.sql import functions as F

from starload.operators.dimensions import OPEN_END, Dimension
from starload.operators.history import (
    FIRST_START,
    build_history,
    resolve_key_at,
    update_history,
)

SPEC = Dimension(
    tk="tk",
    natural_key=["name", "area"],
    attributes=["colour", "size"],
    normalized=["name"],
    nullable_key=["area"],
    unknown={"name": "UNKNOWN", "area": 1},
)
DAY = datetime(2020, 1, 1)
START, END = (datetime.fromisoformat(t) for t in (FIRST_START, OPEN_END))


def frame(spark, lines):
    schema = "name string, area int, colour string, size int, at timestamp"
    return spark.createDataFrame(lines, schema).repartition(3)


def order(value):
    return [(v is not None, v) for v in value]


def brute(stored, lines):
    """Stored versions (key, at, attributes, tk) and changes: (key, version, from, to, attributes, tk)."""
    taken = {(k, at) for k, at, _, _ in stored}
    first = {}
    for name, area, colour, size, at in lines:
        if name is None or at is None or (name.strip(" ").upper(), area) == ("UNKNOWN", 1):
            continue
        key = (name.strip(" ").upper(), area)
        attributes = (colour, size)
        if (key, at) not in taken:
            # Nulls last.
            lowest = first.get((key, at))
            rank = [(v is None, v or 0 if not isinstance(v, str) else v) for v in attributes]
            if lowest is None or rank < lowest[0]:
                first[key, at] = (rank, attributes)
    events = stored + [(k, at, a, None) for (k, at), (_, a) in first.items()]
    events.sort(key=lambda e: (order(e[0]), e[1]))
    versions = []
    for key, at, attributes, tk in events:
        last = versions[-1] if versions and versions[-1][0] == key else None
        if tk is None and last and last[2] == attributes:
            continue
        versions.append((key, at, attributes, tk))
    top = max([v[3] for v in versions if v[3]] + [t for *_, t in stored], default=0)
    out = []
    for i, (key, at, attributes, tk) in enumerate(versions):
        nth = sum(v[0] == key for v in versions[: i + 1])
        if tk is None:
            top += 1
            tk = top
        goes_on = i + 1 < len(versions) and versions[i + 1][0] == key
        begin = min(at, START) if nth == 1 else at
        out.append((key, nth, begin, versions[i + 1][1] if goes_on else END, attributes, tk))
    return out


def taken(dim):
    return [
        ((r["name"], r["area"]), r["version"], r["date_from"], r["date_to"], (r["colour"], r["size"]), r["tk"])
        for r in dim.where("tk <> 0").collect()
    ]


def lines(seed, n, names="abcd"):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        hot = rng.random() < 0.4  # one member has much of it
        out.append(
            (
                " hot " if hot else rng.choice([*names, names[0].upper(), None, "Unknown"]),
                1 if hot else rng.choice([1, None]),
                rng.choice(["red", "blue", None]),
                rng.choice([1, None]),
                DAY + timedelta(days=rng.randint(0, 60)) if rng.random() < 0.95 else None,
            )
        )
    return out


def key_of(v):
    return (order(v[0]), v[1])


@pytest.mark.parametrize("seed", range(3))
def test_two_loads_against_brute_force(spark, seed):
    first, later = lines(seed, 150), lines(seed + 100, 120, "bcde")
    dim = build_history([frame(spark, first[:70]), frame(spark, first[70:])], SPEC, "at")
    assert dim.columns == SPEC.layout
    expected = brute([], first)
    assert sorted(taken(dim), key=key_of) == sorted(expected, key=key_of)
    unknown = dim.where("tk = 0").collect()
    assert len(unknown) == 1 and (unknown[0]["date_from"], unknown[0]["date_to"]) == (START, END)

    updated = update_history(dim, [frame(spark, later)], SPEC, "at")
    stored = [(key, begin, attributes, tk) for key, _, begin, _, attributes, tk in expected]
    after = brute(stored, later)
    assert sorted(taken(updated), key=key_of) == sorted(after, key=key_of)
    again = update_history(updated, [frame(spark, later)], SPEC, "at")
    assert rows(again.drop("version")) == rows(updated.drop("version"))
    assert updated.where("tk = 0").count() == 1
    # Versions of a member follow on one another without gap or overlap.
    for name in {v[0] for v in after}:
        mine = sorted((v for v in taken(updated) if v[0] == name), key=lambda v: v[1])
        assert [v[1] for v in mine] == list(range(1, len(mine) + 1))
        assert all(a[3] == b[2] for a, b in zip(mine, mine[1:])) and mine[-1][3] == END


@pytest.mark.parametrize("few_versions", [0, 1000])
def test_lookup_at_a_date(spark, few_versions):
    changes = lines(7, 200)
    dim = build_history([frame(spark, changes)], SPEC, "at")
    rng = random.Random(8)
    facts = []
    for i in range(400):
        name = "HOT" if i % 3 == 0 else rng.choice(["A", "B", "Z", None, "UNKNOWN"])
        day = DAY + timedelta(hours=rng.randint(-100, 24 * 70)) if rng.random() < 0.9 else None
        facts.append((i, name, 1 if i % 3 == 0 else rng.choice([1, None]), day))
    facts += facts[:20]
    df = spark.createDataFrame(facts, "id int, name string, area int, day timestamp").repartition(4)
    got = resolve_key_at(
        df, dim, ["name", "area"], "tk", "day", null_safe=["area"], default=-1,
        few_versions=few_versions,
    )
    assert got.columns == ["id", "name", "area", "day", "tk"]
    versions = brute([], changes) + [(("UNKNOWN", 1), 1, START, END, None, 0)]
    expected = []
    for i, name, area, day in facts:
        match = [
            v[5] for v in versions if day and v[0] == (name, area) and v[2] <= day < v[3]
        ]
        expected.append((i, match[0] if match else -1))
    assert rows(got, "id", "tk") == sorted(expected)


def test_nothing_to_look_up_and_no_changes(spark):
    empty = build_history([frame(spark, [])], SPEC, "at")
    assert rows(empty, "tk") == [(0,)]
    updated = update_history(empty, [frame(spark, lines(1, 20))], SPEC, "at")
    assert rows(update_history(updated, [frame(spark, [])], SPEC, "at")) == rows(updated)
    df = spark.createDataFrame([("A", DAY)], "name string, day timestamp")
    by_name = empty.drop("area")
    for few in (0, 10):
        got = resolve_key_at(df, by_name, ["name"], "tk", "day", few_versions=few)
        assert rows(got, "tk") == [(0,)]
        assert resolve_key_at(df.limit(0), by_name, ["name"], "tk", "day", few_versions=few).count() == 0


def test_a_hot_member_is_not_in_one_window(spark, settings):
    """A member with all changes: no sorted partition holds more than its share."""
    settings(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false")
    many = spark.range(20_000).select(
        F.lit("hot").alias("name"),
        F.lit(1).alias("area"),
        F.col("id").cast("string").alias("colour"),
        F.lit(1).alias("size"),
        (F.lit(DAY) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("at"),
    )
    dim = build_history([many], SPEC, "at").where("tk <> 0")
    assert dim.count() == 20_000 == dim.agg(F.max("version")).first()[0]
    follow = dim.where("date_to = timestamp '2200-01-01'").count()
    assert follow == 1
    from starload.operators.history import _placed

    placed = _placed(many.withColumn("_at", F.col("at")), ["name", "area", "_at"], "placed")
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 20_000 / 3
