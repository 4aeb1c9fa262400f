import pytest
from frames import rows

from starload.operators.normalize import denormalize, insert_if_absent, keyed_members
from starload.operators.quality import (
    constraint_violations,
    distinct_count,
    duplicate_groups,
    fk_orphans,
    pk_violations,
    require_rows,
    row_counts,
    rows_for_member,
    unknown_report,
)
from starload.plans import declarations as d

FLAT = [
    # key, state, county, type
    (1, "Texas", "Lee", "Flood"),
    (2, "Florida", "Lee", "Fire"),
    (3, "Texas", "Lee", "Fire"),
    (4, "Texas", None, "Fire"),
    (5, "Texas", "Clay", None),
    (6, None, "Lee", "Flood"),
]


@pytest.fixture
def flat(spark):
    return spark.createDataFrame(FLAT, "row int, state_name string, county_name string, incident_type string")


def test_normalize(flat):
    t = d.normalize(flat, ["row"])
    assert rows(t.state, "id", "state_name") == [(1, "Florida"), (2, "Texas")]
    assert rows(t.county, "id", "county_name", "state_fk") == [(1, "Lee", 1), (2, "Clay", 2), (3, "Lee", 2)]
    assert rows(t.disaster, "id", "incident_type") == [(1, "Fire"), (2, "Flood")]
    # A county is found by name alone: every Lee is the first Lee.
    assert rows(t.declaration, "id", "row", "county_fk", "disaster_fk") == [
        (1, 1, 1, 2),
        (2, 2, 1, 1),
        (3, 3, 1, 1),
        (4, 6, 1, 2),
    ]
    assert rows(t.rejects, "row") == [(4,), (5,)]


def test_normalize_keeps_a_county_per_row(flat):
    t = d.normalize(flat, ["row"], distinct_counties=False, county_ties=["row"])
    assert rows(t.county, "id", "county_name", "state_fk") == [
        (1, "Lee", 1),
        (2, "Clay", 2),
        (3, "Lee", 2),
        (4, "Lee", 2),
    ]
    assert t.declaration.count() == 4


def test_denormalize_undoes_normalize(spark, flat):
    whole = flat.where("county_name is not null and incident_type is not null and state_name = 'Texas'")
    t = d.normalize(whole, ["row"])
    back = d.denormalize_declarations(t.declaration, t.county, t.state, t.disaster)
    assert rows(back.select(*whole.columns)) == rows(whole)
    merged = d.denormalize_declarations(t.declaration, t.county, t.state, t.disaster, hint="merge")
    assert rows(merged.select(*whole.columns)) == rows(whole)


def test_denormalize_keeps_children_without_parent(spark):
    child = spark.createDataFrame([(1, 9), (2, None), (3, 1)], "c int, fk bigint")
    parent = spark.createDataFrame([(1, "p")], "id bigint, name string")
    assert rows(denormalize(child, [(parent, "fk", "id")]), "c", "name") == [(1, None), (2, None), (3, "p")]


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(3, "Lee", 1)], "id bigint, name string, state bigint")
    incoming = spark.createDataFrame(
        [("Lee", 1), ("Lee", 2), ("Clay", 1), ("Clay", 1), (None, 1)], "name string, state bigint"
    )
    once = insert_if_absent(existing, incoming, ["name", "state"])
    assert rows(once) == [(3, "Lee", 1), (4, "Clay", 1), (5, "Lee", 2)]
    assert rows(insert_if_absent(once, incoming, ["name", "state"])) == rows(once)


def test_insert_if_absent_takes_one_row_per_key(spark):
    existing = spark.createDataFrame([(1, "a", "x")], "id bigint, k string, v string")
    values = [("b", "p"), ("b", None), ("b", "q"), ("a", "y"), (None, "z")]
    incoming = spark.createDataFrame(values, "k string, v string")
    assert rows(insert_if_absent(existing, incoming, ["k"])) == [(1, "a", "x"), (2, "b", "p")]


def test_keyed_members_of_hot_value(spark):
    df = spark.createDataFrame([("a",)] * 20 + [("b",)], "n string")
    assert rows(keyed_members(df, ["n"])) == [(1, "a"), (2, "b")]
    bag = keyed_members(df, ["n"], distinct=False)
    assert rows(bag) == [*((i, "a") for i in range(1, 21)), (21, "b")]


def test_reports(spark):
    fact = spark.createDataFrame([(0, 1), (0, 0), (2, 1)], "a int, b int")
    assert unknown_report(fact, ["a", "b"]).first().asDict() == {"n_rows": 3, "unknown_a": 2, "unknown_b": 1}
    assert rows(row_counts({"f": fact, "g": fact.limit(0)})) == [("f", 3), ("g", 0)]
    assert rows(rows_for_member(fact, "a", 2)) == [(2, 1)]
    assert duplicate_groups(fact, ["a"]).first()["n_groups"] == 1
    assert duplicate_groups(fact, ["a", "b"]).first()["n_groups"] == 0
    assert distinct_count(fact, "a").first()["n_distinct"] == 2
    assert distinct_count(fact, "a", approximate=True).first()["n_distinct"] == 2
    with pytest.raises(RuntimeError, match="fact is empty"):
        require_rows(fact.limit(0), "fact")
    assert require_rows(fact) is fact


def test_unknown_report_is_one_scan(spark, plan, tmp_path):
    spark.sql("select 0 a, 1 b").write.parquet(str(tmp_path / "f"))
    report = unknown_report(spark.read.parquet(str(tmp_path / "f")), ["a", "b"])
    assert plan(report).split("== Physical Plan ==")[1].count("FileScan") == 1


def test_constraints(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, None), (None, "y")], "k int, v string")
    assert rows(pk_violations(df, ["k"])) == [(None, 1), (1, 2)]
    assert rows(pk_violations(df, ["k", "v"]), "n_rows") == [(1,), (1,), (1,)]
    assert rows(constraint_violations(df, not_null=["k", "v"], unique=["k", "v"])) == [
        ("k", "not_null", 1),
        ("k", "unique", 1),
        ("v", "not_null", 2),
        ("v", "unique", 0),
    ]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(fk_orphans(df, parent, "k", "id")) == [(2, 1)]
