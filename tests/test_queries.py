"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest
from check import TABLES, canonical

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from starload.plans.queries import QUERIES
from starload.plans.twins import TWINS

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)
    assert set(QUERIES) <= set(queries()) and set(TWINS) <= set(oracle_sql())


def test_entry(spark):
    fact = entry(spark)
    assert fact.columns[0] == "disaster_fact_tk" and not fact.isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = queries()[name](spark, SMOKE_DIR)
    cursor = con.execute(oracle_sql()[name])
    expected_types = {c[0]: str(c[1]) for c in cursor.description}
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema} == expected_types
    columns = [c[0] for c in cursor.description]
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(columns, cursor.fetchall())
