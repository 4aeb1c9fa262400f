import pytest
from frames import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.sources import (
    append_table,
    create_table,
    max_key_query,
    overwrite_table,
    read_csv,
    read_jdbc,
    read_jdbc_query,
    readback_count,
    split_rejects,
    write_csv,
    write_jdbc,
)
from starload.sources.jdbc import Partitioning
from starload.tables import materialize, run_folder, shared_folder, side_by_side


def test_csv_keeps_codes_quotes_and_nulls(spark, tmp_path):
    values = [("01001", 'a "quoted", name', 1), (" 7 ", None, None), ("x", "čšž", 3)]
    df = spark.createDataFrame(values, "fips string, name string, n int")
    write_csv(df, str(tmp_path / "c"))
    back = read_csv(spark, str(tmp_path / "c"), df.schema)
    assert back.schema == df.schema
    assert rows(back) == rows(df)
    trimmed = read_csv(spark, str(tmp_path / "c"), df.schema, trim=True)
    assert rows(trimmed, "fips")[1] == ("7",)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "in.csv").write_text("b,more,a\nb1,m,a1\n")
    df = read_csv(spark, str(tmp_path / "in.csv"), "a string, b string")
    assert df.columns == ["a", "b"] and rows(df) == [("a1", "b1")]
    with pytest.raises(ValueError, match="no column c"):
        read_csv(spark, str(tmp_path / "in.csv"), "a string, c string")


def test_csv_keeps_line_breaks_and_empty_text(spark, tmp_path):
    values = [(1, "x\ny"), (2, ""), (3, None), (4, 'a "b" \\'), (5, "a\r\nb\rc"), (6, "\n"), (7, " ")]
    df = spark.createDataFrame(values, "n int, t string")
    write_csv(df, str(tmp_path / "c"), whole_text=True)
    assert rows(read_csv(spark, str(tmp_path / "c"), "n int, t string", whole_text=True)) == values


def test_csv_values_that_do_not_fit(spark, tmp_path):
    (tmp_path / "in.csv").write_text("n,t\n1,a\nxx,b\n3,c\n")
    with pytest.raises(Exception, match="xx|FAILFAST|MALFORMED"):
        read_csv(spark, str(tmp_path / "in.csv"), "n int, t string").collect()
    good, rejects = split_rejects(
        read_csv(spark, str(tmp_path / "in.csv"), "n int, t string", on_bad="keep")
    )
    assert rows(good) == [(1, "a"), (3, "c")] and rows(rejects) == [("xx,b",)]


def test_intermediate_tables_lie_in_the_folder_of_the_run(spark):
    assert all(run_folder(spark) in f for f in materialize(spark.range(3)).inputFiles())


def test_csv_formats(spark, tmp_path):
    (tmp_path / "in.csv").write_text("d;n\n31.12.2020;'a;b'\n")
    df = read_csv(
        spark, str(tmp_path / "in.csv"), "d date, n string", delimiter=";", quote="'", date_format="dd.MM.yyyy"
    )
    assert rows(df.select(F.col("d").cast("string"), "n")) == [("2020-12-31", "a;b")]


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    assert create_table(spark, path, df.schema).count() == 0
    with pytest.raises(Exception, match="already exists"):
        create_table(spark, path, df.schema)
    assert rows(append_table(df, path)) == [(1, "a")]
    assert rows(append_table(df.withColumn("id", F.lit(2).cast("bigint")), path)) == [(1, "a"), (2, "a")]
    smaller = overwrite_table(spark.read.parquet(path).where("id = 2"), path, reads_target=True)
    assert rows(smaller) == [(2, "a")]
    assert create_table(spark, path, df.schema, overwrite=True).count() == 0


def test_readback_count(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    back = overwrite_table(df, str(tmp_path / "t"))
    assert readback_count(df, back).first() == (2, 2, True)
    assert readback_count(df, back.limit(1).withColumnRenamed("id", "k")).first() == (2, 1, False)


def test_materialize_writes_into_the_shared_folder(spark):
    df = materialize(spark.range(3), "three")
    assert all(shared_folder(spark) in f for f in df.inputFiles())
    assert rows(df) == [(0,), (1,), (2,)]


class FakeContext:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, master, conf):
        self.sparkContext = FakeContext(master)
        self.conf = conf


def test_the_cluster_names_the_shared_folder():
    named = FakeSession("spark://host:7077", {"spark.checkpoint.dir": "s3a://work/tmp/"})
    assert shared_folder(named) == "s3a://work/tmp"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("spark://host:7077", {}))


def test_side_by_side_keeps_order_and_raises(spark):
    a, b = side_by_side(spark, lambda: spark.range(1), lambda: spark.range(2))
    assert (a.count(), b.count()) == (1, 2)

    def fails():
        raise KeyError("x")

    with pytest.raises(KeyError):
        side_by_side(spark, lambda: spark.range(1), fails)


class Recorder:
    """Stands in for a reader or writer: collects options, touches no database."""

    def __init__(self):
        self.seen = {}

    read = write = property(lambda self: self)

    def format(self, name):
        self.seen["format"] = name
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **more):
        self.seen.update(more)
        return self

    def load(self):
        return self.seen

    def save(self):
        self.seen["saved"] = True


def test_jdbc_read_options():
    seen = read_jdbc(
        Recorder(), "jdbc:x", '"State"', {"user": "u"}, Partitioning("id", 1, 900, 9), fetchsize=500
    )
    assert seen == {
        "format": "jdbc",
        "user": "u",
        "url": "jdbc:x",
        "dbtable": '"State"',
        "fetchsize": 500,
        "partitionColumn": "id",
        "lowerBound": 1,
        "upperBound": 900,
        "numPartitions": 9,
    }
    query = read_jdbc_query(Recorder(), "jdbc:x", max_key_query("dim", "dim_tk"))
    assert query["dbtable"] == '(select coalesce(max("dim_tk"), 0) as "max_key" from dim) q'
    assert "numPartitions" not in query


def test_jdbc_write_options():
    to = Recorder()
    write_jdbc(to, "jdbc:x", "public.dim", {"user": "u"}, truncate=True, column_types={"tk": "INTEGER", "n": "VARCHAR(9)"}, partitions=4)
    assert to.seen == {
        "format": "jdbc",
        "mode": "overwrite",
        "user": "u",
        "url": "jdbc:x",
        "dbtable": "public.dim",
        "batchsize": 10_000,
        "truncate": True,
        "createTableColumnTypes": "tk INTEGER, n VARCHAR(9)",
        "numPartitions": 4,
        "saved": True,
    }
    to = Recorder()
    write_jdbc(to, "jdbc:x", "dim", mode="append")
    assert to.seen["mode"] == "append" and "createTableColumnTypes" not in to.seen


def test_declared_schemas_parse():
    from starload.plans import roles, schemas

    declared = [schemas.RAW, schemas.CLEAN, schemas.STATE, schemas.COUNTY, schemas.DISASTER, schemas.DECLARATION]
    for ddl in [*declared, *roles.SCHEMAS.values()]:
        assert StructType.fromDDL(ddl).fields


def test_tables_of_a_database(monkeypatch):
    from starload.plans import declarations as d

    read = []
    monkeypatch.setattr(d, "read_jdbc", lambda spark, url, table, *more: read.append((table, *more)))
    ranges, counties = Partitioning("id", 1, 9, 3), Partitioning("id", 1, 5, 2)
    d.read_tables_jdbc(None, "jdbc:x", {"user": "u"}, ranges, counties)
    assert [r[0] for r in read] == ['"State"', '"County"', '"Disaster"', '"Declaration"']
    assert read[3][2] is ranges and read[1][2] is counties
    with pytest.raises(ValueError, match="ranges"):
        d.read_tables_jdbc(None, "jdbc:x", {"user": "u"}, ranges)
    d.read_tables_jdbc(None, "jdbc:x", {"user": "u"}, single_task=True)
