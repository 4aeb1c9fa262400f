"""The whole way from a raw file to a loaded star, with the rows that go wrong."""

from dataclasses import replace
from datetime import date

import pytest
from frames import rows
from pyspark.sql import functions as F

from starload.operators.arrange import union_all
from starload.operators.dimensions import backfill_rows
from starload.operators.keys import max_key
from starload.operators.quality import fk_orphans, pk_violations, unknown_report
from starload.operators.split import split_exact
from starload.plans import declarations as d
from starload.plans import schemas
from starload.sources import append_table, overwrite_table, read_csv, write_csv

HEADER = (
    "fema_declaration_string,declaration_request_number,state,declaration_type,declaration_date,"
    "fy_declared,incident_type,declaration_title,ih_program_declared,ia_program_declared,"
    "pa_program_declared,hm_program_declared,incident_begin_date,incident_end_date,"
    "disaster_closeout_date,fips,place_code,last_ia_filing_date,hash,id,last_refresh"
)


def line(id, state="TX", kind="DR", begin="2005-08-29", end="2005-09-01", fips="01001", request=10, title="KATRINA", incident="Hurricane"):
    def stamp(day):
        return f"{day}T00:00:00Z" if day and day[0].isdigit() else day

    return (
        f"s,{request},{state},{kind},{stamp('2005-09-02')},2005,{incident},{title},0,1,1,0,"
        f"{stamp(begin)},{stamp(end)},,{fips},99,,h{id},{id},now"
    )


LINES = [
    line(1),
    line(2, state="GU", fips="66010", begin="2005-08-29", end="2005-08-29"),
    line(3, state="GM", kind="EM", begin="2005-09-03", end="2005-09-01"),
    line(4, end=""),
    line(5, state="ZZ", kind="QQ", fips="99999", title=""),
    line(6, begin="someday", request=11),
    line(7, request=12, title="B SIDE"),
    line(8, request=12, title="A SIDE", incident=""),
    *[line(i, request=20 + i % 3, fips="01003", incident="Flood") for i in range(9, 30)],
]

COUNTIES = [(1, "01001", "Old name"), (2, "01001", "Autauga County"), (3, "01003", "Baldwin County"), (4, "66010", "Guam")]


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    raw = read_csv(spark, str(path), schemas.RAW)
    counties = spark.createDataFrame(COUNTIES, "line int, code string, name string")
    # The id is dropped by cleaning, but decides the made-up numbers.
    return d.clean_declarations(raw, counties, row_key=["id"], order="line").cache()


def test_clean(cleaned):
    assert not set(schemas.RAW_UNUSED) & set(cleaned.columns)
    assert cleaned.count() == len(LINES) - 1
    odd = cleaned.where("declaration_type = 'QQ'").first()
    assert (odd["state_name"], odd["county_name"], odd["declaration_title"]) == ("ZZ", "99999", "unknown")
    assert rows(cleaned.where("state_name = 'Guam'"), "county_name") == [("Autauga County",), ("Guam",)]
    same_day = cleaned.where("county_name = 'Guam'").first()
    assert 1 <= same_day["incident_duration"] <= 24
    backwards = cleaned.where("incident_begin_date > incident_end_date").first()
    assert backwards["incident_duration"] == -48
    undated = cleaned.where("declaration_request_number = 11").first()
    assert undated["incident_begin_date"] is None and undated["incident_duration"] is None
    assert cleaned.where("deaths < 0 or deaths > 9999").count() == 0
    kinds = {r[0] for r in cleaned.select("declaration_type").distinct().collect()}
    assert kinds == {"Velika katastrofa", "Upravljanje hitnim situacijama", "QQ"}


@pytest.fixture(scope="module")
def halves(spark, cleaned, tmp_path_factory):
    folder = tmp_path_factory.mktemp("clean")
    numbered = cleaned.withColumn("row", F.monotonically_increasing_id()).cache()
    increment, historical = split_exact(numbered, ["row"], 0.2, 1)
    write_csv(historical.drop("row"), str(folder / "80"))
    write_csv(increment.drop("row"), str(folder / "20"))
    names = cleaned.columns
    kinds = {f.name: f.dataType.simpleString() for f in _clean_schema()}
    ddl = ", ".join(f"{n} {kinds[n]}" for n in names)
    return read_csv(spark, str(folder / "80"), ddl), read_csv(spark, str(folder / "20"), ddl)


def _clean_schema():
    from pyspark.sql.types import StructType

    # Flags are 0/1 in the file.
    return StructType.fromDDL(schemas.CLEAN.replace("boolean", "int")).fields


def test_halves_cover_the_clean_rows(cleaned, halves):
    historical, increment = halves
    assert increment.count() == round(0.2 * (len(LINES) - 1))
    both = historical.unionByName(increment)
    assert rows(both, "deaths", "declaration_title") == rows(cleaned, "deaths", "declaration_title")


ORDER = ["declaration_request_number", "deaths"]


@pytest.fixture(scope="module")
def star(halves):
    historical, increment = halves
    t = d.normalize(historical, ORDER)
    return d.build_star(t.state, t.county, t.disaster, t.declaration, increment, "2024-01-01")


def test_every_row_reaches_the_fact(halves, star):
    historical, increment = halves
    assert star.staging.count() == historical.count() + increment.count() == star.fact.count()
    assert rows(star.fact, "deaths") == rows(historical.unionByName(increment), "deaths")
    keys = [r[0] for r in star.fact.select("disaster_fact_tk").orderBy("disaster_fact_tk").collect()]
    assert keys == list(range(1, len(keys) + 1))


def test_every_key_is_in_its_dimension(star):
    dims = [star.state, star.county, star.disaster, star.declaration, star.dates]
    for dim, tk in zip(dims, d.FACT_KEYS):
        assert fk_orphans(star.fact, dim, tk, tk).count() == 0
        assert pk_violations(dim, [tk]).count() == 0
        assert dim.where(F.col(tk) == 0).count() == 1


def test_unknown_and_missing_go_to_member_0(star):
    # The missing incident type was filled as text, which is the unknown member.
    assert star.disaster.where("incident_type = 'UNKNOWN'").count() == 1
    report = {
        k: star.fact.where(F.col(k) == 0).count() for k in d.FACT_KEYS
    }
    assert report == {
        "state_tk": 0,
        "county_tk": 0,
        "disaster_tk": 1,
        "declaration_tk": 0,
        "incident_dates_tk": 1,
    }


def test_load_and_reload(spark, star, tmp_path):
    for _ in range(2):
        report = d.load_star(star, str(tmp_path / "dw")).first()
        assert report["n_rows"] == len(LINES) - 1 and report["unknown_incident_dates_tk"] == 1
    assert spark.read.parquet(str(tmp_path / "dw" / "disaster_fact")).count() == len(LINES) - 1


def test_a_load_that_fails_leaves_the_earlier_star(spark, star, tmp_path):
    folder = str(tmp_path / "dw")
    d.load_star(star, folder)
    broken = star.fact.withColumn("deaths", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        d.load_star(replace(star, state=star.state.limit(1), fact=broken), folder)
    assert spark.read.parquet(f"{folder}/state_dim").count() == star.state.count()
    assert spark.read.parquet(f"{folder}/disaster_fact").count() == star.fact.count()


def test_a_batch_that_broke_off_is_finished(spark, star, tmp_path, monkeypatch):
    from starload.sources import batches

    folder = str(tmp_path / "t")
    rows_ = spark.range(3)
    rows_.write.parquet(f"{folder}/a")
    rows_.write.parquet(f"{folder}/b")
    real, calls = batches._rename, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("stop")
        return real(*args)

    monkeypatch.setattr(batches, "_rename", failing)
    new = {"a": rows_.coalesce(1), "b": rows_.coalesce(1)}
    with pytest.raises(OSError):
        batches.append_batch(new, folder, "one")
    monkeypatch.setattr(batches, "_rename", real)
    for _ in range(2):
        assert batches.resume_batch(spark, folder, ["a", "b"], "one")
        assert [spark.read.parquet(f"{folder}/{n}").count() for n in "ab"] == [6, 6]
    assert not batches.resume_batch(spark, folder, ["a", "b"], "two")


@pytest.mark.parametrize("at", range(1, 6))
def test_a_load_that_broke_off_between_two_renames_is_finished(spark, tmp_path, monkeypatch, at):
    from starload.sources import batches

    folder = str(tmp_path / "t")
    for name in "ab":
        spark.range(3).write.parquet(f"{folder}/{name}")
    real, calls = batches._rename, []

    def failing(*args):
        calls.append(args)
        if len(calls) == at:
            raise OSError("stop")
        return real(*args)

    new = {name: spark.range(5) for name in "abc"}
    monkeypatch.setattr(batches, "_rename", failing)
    with pytest.raises(OSError):
        batches.switch_tables(new, folder)
    monkeypatch.setattr(batches, "_rename", real)
    assert batches.resume_switch(spark, folder, list(new))
    assert [spark.read.parquet(f"{folder}/{name}").count() for name in "abc"] == [5, 5, 5]
    assert not batches.resume_switch(spark, folder, list(new))


def test_a_load_with_an_empty_table_leaves_the_earlier_star(spark, star, tmp_path):
    folder = str(tmp_path / "dw")
    d.load_star(star, folder)
    with pytest.raises(RuntimeError, match="county_dim"):
        d.load_star(replace(star, county=star.county.limit(0)), folder)
    assert spark.read.parquet(f"{folder}/county_dim").count() == star.county.count()


def test_counts_of_a_load_equal_those_of_the_stored_tables(spark, star, tmp_path):
    folder = str(tmp_path / "dw")
    report = d.load_star(star, folder)
    stored = d.stored_star(spark, folder)
    assert rows(report) == rows(unknown_report(stored["disaster_fact"], d.FACT_KEYS))
    assert report.columns == unknown_report(stored["disaster_fact"], d.FACT_KEYS).columns
    read = {name: table.count() for name, table in stored.items()}
    counts = d.load_star_counts(star, folder)
    assert {name: c["n_rows"] for name, c in counts.items()} == read


def test_doubled_and_untidy_members_do_not_multiply_rows(star):
    untidy = star.state.withColumns(
        {"state_tk": F.col("state_tk") + 100, "state_name": F.lower("state_name")}
    )
    doubled = union_all([star.state, star.state, untidy])
    lookups = d.fact_lookups(
        doubled, star.county, star.disaster, star.declaration, star.dates, untidy=True
    )
    fact = d.disaster_fact(star.staging, lookups)
    assert rows(fact, *d.FACT_KEYS, "deaths") == rows(star.fact, *d.FACT_KEYS, "deaths")


def test_fact_as_bag_equals_fact_with_tie_break(star):
    lookups = d.fact_lookups(star.state, star.county, star.disaster, star.declaration, star.dates)
    tied = d.disaster_fact(star.staging, lookups, tie_break=ORDER)
    bag = d.disaster_fact(star.staging, lookups)
    assert rows(tied, *d.FACT_KEYS, "deaths") == rows(bag, *d.FACT_KEYS, "deaths")
    later = d.disaster_fact(star.staging, lookups, start=1001)
    assert later.agg(F.min("disaster_fact_tk")).first()[0] == 1001


def test_copies_of_a_row_are_all_kept(star):
    doubled = union_all([star.staging, star.staging])
    lookups = d.fact_lookups(star.state, star.county, star.disaster, star.declaration, star.dates)
    fact = d.disaster_fact(doubled, lookups)
    assert fact.count() == 2 * star.fact.count() == fact.agg(F.max("disaster_fact_tk")).first()[0]


def test_state_miss_may_drop_the_row(star):
    few = star.state.where("state_name <> 'GUAM'")
    lookups = d.fact_lookups(few, star.county, star.disaster, star.declaration, star.dates, state_on_miss="drop")
    guam = star.staging.where("state_name = 'GUAM'").count()
    assert guam > 0
    assert d.disaster_fact(star.staging, lookups).count() == star.fact.count() - guam


def test_declaration_identity(spark, star):
    one = star.declaration.where("declaration_request_number = 12")
    assert rows(one, "declaration_title", "declaration_date") == [("A SIDE", date(2005, 9, 2))]


def test_append_continues_keys(spark, star, tmp_path):
    dim_path, fact_path = str(tmp_path / "dim"), str(tmp_path / "fact")
    dates = overwrite_table(star.dates, dim_path)
    later = star.staging.withColumn("incident_duration", F.lit(1_000_000).cast("bigint"))
    added = backfill_rows(dates, later, d.DATES_DIM)
    # Appended to the very table it was compared with.
    dates = append_table(added, dim_path)
    assert pk_violations(dates, ["incident_dates_tk"]).count() == 0
    assert backfill_rows(dates, later, d.DATES_DIM).count() == 0

    fact = overwrite_table(star.fact, fact_path)
    lookups = d.fact_lookups(star.state, star.county, star.disaster, star.declaration, dates)
    more = d.disaster_fact(later, lookups, start=max_key(fact, d.FACT_TK) + 1)
    whole = append_table(more, fact_path)
    assert whole.count() == 2 * star.fact.count() == max_key(whole, d.FACT_TK)
    assert pk_violations(whole, [d.FACT_TK]).count() == 0


def test_database_types(star):
    assert d._column_types(star.declaration)["declaration_title"] == "TEXT"
    assert d._column_types(star.declaration, 1000)["declaration_title"] == "VARCHAR(1000)"
    for table in d.star_tables(star).values():
        assert set(d._column_types(table)) == set(table.columns)


def test_empty_table_is_not_loaded(star):
    empty = replace(star, fact=star.fact.limit(0))
    with pytest.raises(RuntimeError, match="disaster_fact"):
        d.star_tables(empty)


def test_without_files_in_between(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    raw = read_csv(spark, str(tmp_path / "raw.csv"), schemas.RAW).withColumnRenamed("id", "row")
    counties = spark.createDataFrame(COUNTIES, "line int, code string, name string")
    clean = d.clean_declarations(raw, counties, row_key=["row"], order="line")
    increment, historical = split_exact(clean, ["row"], 0.2, 1)
    t = d.normalize(historical, ["row"])
    star = d.build_star(
        t.state, t.county, t.disaster, t.declaration, increment, tie_break=["row"]
    )
    assert star.fact.count() == len(LINES) - 1
    assert rows(star.fact, "deaths") == rows(clean, "deaths")
