"""The given TPC-H-like tables in the roles of the declarations warehouse.

Orders play the declarations, customers the counties, nations the states and order priorities
the incident types; the end of an incident and its measure come from the line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.split import split_hash
from starload.plans.declarations import denormalize_declarations
from starload.sources import read_parquet
from starload.tables import materialize

SPLIT_SEED = 1
INCREMENT = 0.2


# Declared, so that reading a table starts no job of its own.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """
        c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string
    """,
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """
        p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double
    """,
    "orders": """
        o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string
    """,
    "lineitem": """
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz
    """,
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": """
        event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string
    """,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("state_name")
    )


def county(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("county_name"),
        F.col("c_nationkey").cast("bigint").alias("state_fk"),
    )


def _priority_id() -> F.Column:
    """The leading digit of an order priority."""
    return F.substring("o_orderpriority", 1, 1).cast("bigint")


def disaster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: joined as a table of known size, it needs no shuffle of the rows."""
    orders = table(spark, sf_dir, "orders")
    types = orders.select(
        _priority_id().alias("id"), F.col("o_orderpriority").alias("incident_type")
    )
    return materialize(types.distinct(), "disaster")


def declaration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four orders share a request number. Status F has no duration, O has the calendar one, P
    has another; orders without line items have no end."""
    orders = table(spark, sf_dir, "orders")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_shipdate").cast("date").alias("incident_end_date"),
            F.sum("l_quantity").cast("bigint").alias("deaths"),
            F.count(F.lit(1)).alias("_lines"),
        )
    )
    begin = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("id"),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("declaration_title"),
        F.when(status == "F", "DR").when(status == "O", "EM").otherwise("FM").alias(
            "declaration_type"
        ),
        begin.alias("declaration_date"),
        F.expr("o_orderkey div 4").alias("declaration_request_number"),
        begin.alias("incident_begin_date"),
        "incident_end_date",
        F.when(status == "O", F.datediff("incident_end_date", begin) * 24)
        .when(status == "P", F.col("_lines"))
        .cast("bigint")
        .alias("incident_duration"),
        (F.col("o_totalprice") >= 250000).alias("ih_program_declared"),
        (status != "F").alias("ia_program_declared"),
        (F.col("o_orderpriority") < "3").alias("pa_program_declared"),
        (F.col("o_totalprice") < 100000).alias("hm_program_declared"),
        "deaths",
        _priority_id().alias("disaster_fk"),
        F.col("o_custkey").alias("county_fk"),
    )


def halves(
    spark: SparkSession, sf_dir: str, written: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Declarations as (historical 80 %, increment 20 %).

    Each is a filter on the key, which Spark pushes below the join that makes declarations, together
    with the columns that are read. ``written`` has both read from one copy: for callers that read
    them whole and more than once.
    """
    rows = declaration(spark, sf_dir)
    if written:
        rows = materialize(rows, "declaration")
    increment, historical = split_hash(rows, ["id"], INCREMENT, SPLIT_SEED)
    return historical, increment


def flat(
    spark: SparkSession, sf_dir: str, rows: DataFrame, types: DataFrame | None = None
) -> DataFrame:
    """Declarations with names in place of foreign keys; ``declaration_id`` tells rows apart."""
    types = disaster(spark, sf_dir) if types is None else types
    return denormalize_declarations(rows, county(spark, sf_dir), state(spark, sf_dir), types)


def untidy(rows: DataFrame) -> DataFrame:
    """The same names in lower case with spaces around, as an unclean file would hold them."""
    return rows.withColumns(
        {
            c: F.concat(F.lit("  "), F.lower(c), F.lit(" "))
            for c in ("state_name", "county_name", "incident_type")
        }
    )


def increment_file(
    spark: SparkSession, sf_dir: str, types: DataFrame | None = None
) -> DataFrame:
    _, increment = halves(spark, sf_dir)
    return untidy(flat(spark, sf_dir, increment, types))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarations in the shape of the raw file: codes and ISO timestamps as text.

    Begin dates of type FM are free text and some titles are missing.
    """
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    rows = declaration(spark, sf_dir)
    places = county(spark, sf_dir).select(F.col("id").alias("_place"), "state_fk")
    joined = rows.join(places, F.col("county_fk") == F.col("_place"), "left")

    def stamp(c: str) -> F.Column:
        return F.date_format(F.col(c).cast("timestamp"), iso)

    begin = stamp("incident_begin_date")
    return joined.select(
        F.col("id").cast("string").alias("id"),
        F.md5(F.col("id").cast("string")).alias("hash"),
        "declaration_request_number",
        F.col("state_fk").cast("string").alias("state"),
        "declaration_type",
        stamp("declaration_date").alias("declaration_date"),
        F.nullif(F.col("declaration_title"), F.lit("5-LOW F")).alias("declaration_title"),
        F.when(F.col("declaration_type") == "FM", F.concat(F.lit("about "), begin))
        .otherwise(begin)
        .alias("incident_begin_date"),
        stamp("incident_end_date").alias("incident_end_date"),
        county_code(F.col("county_fk")).alias("fips"),
        F.expr("substring(declaration_title, 1, length(declaration_title) - 2)").alias(
            "incident_type"
        ),
        F.col("ih_program_declared").cast("int").alias("ih_program_declared"),
        F.col("ia_program_declared").cast("int").alias("ia_program_declared"),
        F.col("pa_program_declared").cast("int").alias("pa_program_declared"),
        F.col("hm_program_declared").cast("int").alias("hm_program_declared"),
    )


def county_code(c: F.Column) -> F.Column:
    """Key as text with a leading zero, which an integer column would lose."""
    return F.concat(F.lit("0"), c.cast("string"))


def county_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code list with every code twice: first its segment, then its name (which wins)."""
    customer = table(spark, sf_dir, "customer")
    code = county_code(F.col("c_custkey"))
    first, last = (
        customer.select(F.lit(line).alias("line"), code.alias("code"), F.col(name).alias("name"))
        for line, name in ((1, "c_mktsegment"), (2, "c_name"))
    )
    return first.unionByName(last)


def state_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region numbers as a code list: state codes beyond them stay unmapped."""
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("name")
    )
