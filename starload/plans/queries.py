"""The registered queries: each takes (spark, sf_dir) and reads the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import (
    duration_elapsed,
    duration_hours,
    iso_date,
    norm_str,
    parse_date,
    replace_text,
    seeded_int,
    tidy_text,
)
from starload.operators.arrange import merge_sorted, sorted_rows, union_all
from starload.operators.bitmaps import distinct_keys, fk_orphans_dense, pk_violations_dense
from starload.operators.cleanse import (
    drop_columns,
    drop_null_keys,
    fill_unknown,
    first_existing_column,
    rename_columns,
)
from starload.operators.dedupe import dedupe, duplicate_rejects
from starload.operators.dimensions import (
    Dimension,
    backfill_dimension,
    build_dimension,
    missing_members,
    upsert_dimension,
    without_unknown,
)
from starload.operators.fact import resolve_all
from starload.operators.history import build_history, resolve_key_at, update_history
from starload.operators.hot import resolve_hot_key
from starload.operators.keys import append_keys, dense_key, next_key, placed_key
from starload.operators.lookup import fk_first_match, resolve_key
from starload.operators.mapping import map_codes
from starload.operators.normalize import insert_if_absent, keyed_members
from starload.operators.quality import (
    constraint_violations,
    distinct_count,
    duplicate_groups,
    fk_orphans,
    pk_violations,
    row_counts,
    rows_for_member,
    unknown_report,
)
from starload.operators.sketches import distinct_estimates, distinct_sketches
from starload.operators.split import complement, split_exact, split_exact_bag, split_hash
from starload.plans import declarations as d
from starload.plans import roles
from starload.sources import (
    append_table,
    overwrite_table,
    read_csv,
    read_parquet,
    readback_content,
    readback_count,
    split_rejects,
    write_bucketed,
    write_csv,
)
from starload.streaming import feed_increments
from starload.tables import fresh_path, materialize, side_by_side

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# One load time for all, so that results can be compared.
LOAD_TS = "2024-01-01 00:00:00"


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def _dated(dim: DataFrame) -> DataFrame:
    return dim.withColumns({c: F.col(c).cast("date") for c in ("date_from", "date_to")})


def _historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.halves(spark, sf_dir)[0]


def _flat_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.flat(spark, sf_dir, roles.declaration(spark, sf_dir))


def _flat_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.flat(spark, sf_dir, _historical(spark, sf_dir))


def _staging(spark: SparkSession, sf_dir: str, ordinal: str | None = None) -> DataFrame:
    types = roles.disaster(spark, sf_dir)
    historical = roles.flat(spark, sf_dir, _historical(spark, sf_dir), types)
    increment = roles.increment_file(spark, sf_dir, types)
    return d.stage(historical, increment, ordinal, keep=["declaration_id"])


def _star(spark: SparkSession, sf_dir: str) -> d.Star:
    types, declaration = side_by_side(
        spark,
        lambda: roles.disaster(spark, sf_dir),
        lambda: materialize(roles.declaration(spark, sf_dir), "declaration"),
    )
    increment, historical = split_hash(declaration, ["id"], roles.INCREMENT, roles.SPLIT_SEED)
    increment_file = roles.untidy(roles.flat(spark, sf_dir, increment, types))
    return d.build_star(
        roles.state(spark, sf_dir),
        roles.county(spark, sf_dir),
        types,
        historical,
        increment_file,
        LOAD_TS,
        tie_break=["declaration_request_number", "declaration_id"],
    )


# ---- sources and sinks ---------------------------------------------------------------------


@query("src_csv_roundtrip")
def src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = roles.table(spark, sf_dir, "customer")
    path = fresh_path(spark, "csv")
    write_csv(customer, path)
    return read_csv(spark, path, customer.schema)


@query("src_csv_whole_text")
def src_csv_whole_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes, empty and null, read in another order of columns."""
    documents = roles.table(spark, sf_dir, "documents")
    tenth = F.col("doc_id") % 10
    text = F.when(tenth == 3, None).when(tenth == 4, "").otherwise(F.col("text"))
    documents = documents.withColumn("text", text)
    path = fresh_path(spark, "csv")
    write_csv(documents.select(*reversed(documents.columns)), path, whole_text=True)
    return read_csv(spark, path, documents.schema, whole_text=True)


@query("src_csv_rejects")
def src_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose customer is not a number, as they stand in the file."""
    wrong = F.concat(F.lit("x"), F.col("o_custkey").cast("string"))
    key = F.when(F.col("o_orderkey") % 7 == 0, wrong).otherwise(F.col("o_custkey").cast("string"))
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", key.alias("o_custkey"))
    path = fresh_path(spark, "csv")
    write_csv(orders, path)
    rows = read_csv(spark, path, "o_custkey bigint, o_orderkey bigint", on_bad="keep")
    good, rejects = split_rejects(rows)
    return rejects.unionByName(
        good.select(F.concat_ws(",", "o_orderkey", "o_custkey").alias("line"))
    )


@query("src_sql_projection")
def src_sql_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """
        select c_custkey as county_fk, c_name as county_name, c_nationkey as state_fk
        from {customer}
        """,
        customer=roles.table(spark, sf_dir, "customer"),
    )


@query("distinct_date_triples")
def distinct_date_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _staging(spark, sf_dir)
        .select("incident_begin_date", "incident_end_date", "incident_duration")
        .distinct()
    )


@query("sink_readback_count")
def sink_readback_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    county = roles.county(spark, sf_dir)
    written = overwrite_table(county, fresh_path(spark, "county"))
    return readback_count(county, written)


# ---- columns and rows ----------------------------------------------------------------------


@query("clean_base")
def clean_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders")
    kept = drop_columns(orders, ["o_totalprice", "o_orderstatus"])
    return rename_columns(kept, {"o_custkey": "county_fk", "o_orderpriority": "incident_type"})


@query("first_existing_column")
def first_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = roles.table(spark, sf_dir, "customer")
    name = first_existing_column(customer, ["county_name", "c_name", "c_mktsegment"])
    return customer.select("c_custkey", name.alias("county_name"))


@query("drop_null_keys")
def drop_null_keys_declaration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.declaration(spark, sf_dir)
    kept = drop_null_keys(rows, ["incident_begin_date", "incident_end_date", "incident_duration"])
    return kept.select("id", "incident_begin_date", "incident_end_date", "incident_duration")


@query("fill_unknown")
def fill_unknown_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.raw(spark, sf_dir).select("id", "declaration_title", "incident_end_date")
    return fill_unknown(rows)


@query("norm_names")
def norm_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = roles.table(spark, sf_dir, "customer")
    padded = F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))
    return customer.select(
        "c_custkey",
        norm_str(padded).alias("name_norm"),
        tidy_text(padded, trim="left", case=None, digits="only").alias("name_digits"),
    )


@query("replace_text")
def replace_text_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = roles.table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        replace_text("c_name", "cust[a-z]+#0*", "C-", ignore_case=True).alias("by_regex"),
        replace_text("c_name", "#", "$1", regex=False).alias("by_text"),
        replace_text("c_name", "", "x").alias("unchanged"),
    )


@query("map_codes")
def map_codes_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = roles.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("state")
    )
    return map_codes(customer, "state", roles.state_codes(spark, sf_dir))


@query("map_codes_last_wins")
def map_codes_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders").select(
        "o_orderkey", roles.county_code(F.col("o_custkey")).alias("fips")
    )
    codes = roles.county_codes(spark, sf_dir)
    return map_codes(orders, "fips", codes, order="line", out="county_name")


@query("parse_dates")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.raw(spark, sf_dir)
    return rows.select(
        "id",
        parse_date("incident_begin_date").alias("begin_date"),
        iso_date("incident_end_date").alias("end_text"),
    )


@query("resolve_duration")
def resolve_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.declaration(spark, sf_dir)
    hours = duration_hours("incident_begin_date", "incident_end_date", "incident_duration")
    return rows.select("id", hours.cast("bigint").alias("hours"))


@query("duration_hours")
def duration_hours_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.declaration(spark, sf_dir)
    hours = duration_hours("incident_begin_date", "incident_end_date").cast("bigint")
    kind = F.when(hours == 0, "same day").when(hours < 0, "backwards").otherwise("other")
    return rows.select("id", hours.alias("hours"), kind.alias("kind"))


@query("duration_elapsed")
def duration_elapsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = (
        roles.table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    )
    return spans.select(
        "user_id",
        "event_type",
        duration_elapsed("first_ts", "last_ts").cast("bigint").alias("hours"),
        duration_elapsed("last_ts", "first_ts").cast("bigint").alias("hours_back"),
    )


@query("seeded_measure")
def seeded_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        seeded_int(["o_orderkey"], 10_000, 1).alias("deaths"),
        seeded_int(["o_orderkey"], 24, 2, low=1).alias("hours"),
        seeded_int(["o_orderkey"], 10**12, 3).alias("large"),
    )


# ---- split ---------------------------------------------------------------------------------


def _labelled(sample: DataFrame, rest: DataFrame) -> DataFrame:
    return sample.select("o_orderkey", F.lit("sample").alias("half")).unionByName(
        rest.select("o_orderkey", F.lit("rest").alias("half"))
    )


@query("split_hash")
def split_hash_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(*split_hash(roles.table(spark, sf_dir, "orders"), ["o_orderkey"], 0.2, 1))


@query("split_exact")
def split_exact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(*split_exact(roles.table(spark, sf_dir, "orders"), ["o_orderkey"], 0.2, 1))


@query("split_hash_bounds")
def split_hash_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey")
    parts = [
        split_hash(orders, ["o_orderkey"], fraction, 1)[0].withColumn("fraction", F.lit(fraction))
        for fraction in (0.0, 0.2, 0.9999999999, 1.0)
    ]
    return union_all(parts)


@query("split_exact_pair")
def split_exact_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that only differ in which part of the key is null."""
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey")
    half = F.expr("o_orderkey div 2")
    even = F.col("o_orderkey") % 2 == 0
    orders = orders.withColumns({"a": F.when(even, half), "b": F.when(~even, half)})
    return _labelled(*split_exact(orders, ["a", "b"], 0.3, 1))


@query("split_complement")
def split_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders")
    sample, _ = split_exact(orders, ["o_orderkey"], 0.2, 1)
    return complement(orders, sample, ["o_orderkey"])


# ---- staging -------------------------------------------------------------------------------


@query("stage_typed")
def stage_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.type_staging(roles.untidy(_flat_all(spark, sf_dir)), keep=["declaration_id"])


@query("stage_union")
def stage_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staging(spark, sf_dir)


@query("stage_union_ordered")
def stage_union_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staging(spark, sf_dir, ordinal="part")


@query("merge_sorted")
def merge_sorted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = roles.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    suppliers = roles.table(spark, sf_dir, "supplier").select(F.lower("s_name").alias("name"))
    merged = merge_sorted([customers, suppliers], ["name"], case_sensitive=False)
    return placed_key(merged, "position")


@query("denormalize")
def denormalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_all(spark, sf_dir)


@query("denormalize_merge")
def denormalize_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.denormalize_declarations(
        roles.declaration(spark, sf_dir),
        roles.county(spark, sf_dir),
        roles.state(spark, sf_dir),
        roles.disaster(spark, sf_dir),
        hint="merge",
    )


# ---- keyed tables --------------------------------------------------------------------------


@query("normalize_state")
def normalize_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.normalize_state(_flat_all(spark, sf_dir))


@query("normalize_county")
def normalize_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _flat_all(spark, sf_dir).select("declaration_id", "state_name", "county_name")
    flat = materialize(names, "names")
    return d.normalize_county(flat, d.normalize_state(flat))


@query("normalize_county_bag")
def normalize_county_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _flat_all(spark, sf_dir).select("declaration_id", "state_name", "county_name")
    flat = materialize(names, "names")
    state = d.normalize_state(flat)
    return d.normalize_county(flat, state, distinct=False, ties=["declaration_id"])


@query("normalize_type")
def normalize_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.normalize_type(_flat_all(spark, sf_dir))


@query("normalize_declaration")
def normalize_declaration(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = materialize(_flat_all(spark, sf_dir), "flat")
    county = d.normalize_county(flat, d.normalize_state(flat))
    rows = d.normalize_declaration(flat, county, d.normalize_type(flat), ["declaration_id"])
    return rows.select(
        "id", "declaration_id", "declaration_request_number", "deaths", "county_fk", "disaster_fk"
    )


@query("fk_first_match")
def fk_first_match_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = roles.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return fk_first_match(part, part, ["p_name"], id="p_partkey", fk="first_part_fk")


@query("insert_if_absent")
def insert_if_absent_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    historical, increment = roles.halves(spark, sf_dir)
    key = ["state_name", "county_name"]
    types = roles.disaster(spark, sf_dir)
    existing = keyed_members(roles.flat(spark, sf_dir, historical, types), key)
    return insert_if_absent(existing, roles.flat(spark, sf_dir, increment, types), key)


@query("insert_if_absent_by_key")
def insert_if_absent_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several incoming rows per key, which differ in a column beside it."""
    customer = roles.table(spark, sf_dir, "customer").select(
        F.expr("c_custkey div 4").alias("area"), "c_custkey", F.col("c_name").alias("name")
    )
    old = customer.where("c_custkey % 12 = 0").select("area", "name")
    existing = dense_key(old, ["area"], "id")
    return insert_if_absent(existing, customer, ["area"])


@query("distinct_members")
def distinct_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()


@query("dedupe_by_key")
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(roles.table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"])


@query("duplicate_rejects")
def duplicate_rejects_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_rejects(roles.table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"])


@query("dense_key")
def dense_key_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate"
    )
    return dense_key(orders, ["o_orderpriority", "o_orderdate"], "order_tk", ties=["o_orderkey"])


@query("sequence_key")
def sequence_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dense_key(orders, ["o_custkey"], "order_seq", start=100, step=10, ties=["o_orderkey"])


@query("next_key")
def next_key_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_key(roles.table(spark, sf_dir, "orders"), "o_orderkey")


@query("append_keys")
def append_keys_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    added, existing = split_hash(orders, ["o_orderkey"], 0.2, 1)
    existing = existing.withColumnRenamed("o_orderkey", "order_tk")
    return append_keys(existing, added, ["o_orderdate"], "order_tk", ties=["o_orderkey"])


@query("sorted_rows")
def sorted_rows_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = roles.table(spark, sf_dir, "customer").select("c_mktsegment", "c_name")
    return placed_key(
        sorted_rows(customer, ["c_mktsegment", "c_name"], case_sensitive=False), "position"
    )


# ---- dimensions ----------------------------------------------------------------------------


@query("dim_state")
def dim_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [roles.state(spark, sf_dir), roles.increment_file(spark, sf_dir)]
    return _dated(build_dimension(sources, d.STATE_DIM, LOAD_TS))


@query("dim_county")
def dim_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [roles.county(spark, sf_dir), roles.increment_file(spark, sf_dir)]
    return _dated(build_dimension(sources, d.COUNTY_DIM, LOAD_TS))


@query("dim_type")
def dim_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = roles.disaster(spark, sf_dir)
    sources = [types, roles.increment_file(spark, sf_dir, types)]
    return _dated(build_dimension(sources, d.DISASTER_DIM, LOAD_TS))


def _declaration_dim(spark: SparkSession, sf_dir: str, spec: Dimension) -> DataFrame:
    sources = [d.typed_declarations(half) for half in roles.halves(spark, sf_dir)]
    return _dated(build_dimension(sources, spec, LOAD_TS))


@query("dim_declaration")
def dim_declaration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _declaration_dim(spark, sf_dir, d.DECLARATION_DIM)


@query("dim_declaration_full")
def dim_declaration_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _declaration_dim(spark, sf_dir, d.DECLARATION_FULL_DIM)


@query("dim_declaration_nulls")
def dim_declaration_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing title never stands for a request number that has one."""
    rows = roles.declaration(spark, sf_dir)
    title = F.when(F.col("id") % 3 > 0, F.col("declaration_title"))
    rows = d.typed_declarations(rows.withColumn("declaration_title", title))
    return _dated(build_dimension([rows], d.DECLARATION_DIM, LOAD_TS))


@query("dim_dates")
def dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [d.typed_dates(half) for half in roles.halves(spark, sf_dir)]
    return _dated(build_dimension(sources, d.DATES_DIM, LOAD_TS))


@query("dim_dates_pair")
def dim_dates_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [d.typed_dates(half) for half in roles.halves(spark, sf_dir)]
    return _dated(build_dimension(sources, d.DATES_PAIR_DIM, LOAD_TS))


@query("dim_with_unknown")
def dim_with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(build_dimension([roles.county(spark, sf_dir)], d.COUNTY_DIM, LOAD_TS))


@query("dim_without_unknown")
def dim_without_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = build_dimension([roles.county(spark, sf_dir)], d.COUNTY_DIM, LOAD_TS)
    return without_unknown(_dated(dim), "county_tk")


def _historical_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = d.typed_dates(_historical(spark, sf_dir))
    return build_dimension([dates], d.DATES_DIM, LOAD_TS)


@query("missing_members")
def missing_members_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, increment = roles.halves(spark, sf_dir)
    return missing_members(
        d.typed_dates(increment),
        _historical_dates(spark, sf_dir),
        d.DATES_DIM.natural_key,
        d.DATES_DIM.nullable_key,
    )


@query("backfill_dimension")
def backfill_dimension_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, increment = roles.halves(spark, sf_dir)
    dim = _historical_dates(spark, sf_dir)
    return _dated(backfill_dimension(dim, d.typed_dates(increment), d.DATES_DIM, LOAD_TS))


@query("upsert_dimension")
def upsert_dimension_declaration(spark: SparkSession, sf_dir: str) -> DataFrame:
    historical, increment = (d.typed_declarations(h) for h in roles.halves(spark, sf_dir))
    dim = build_dimension([historical], d.DECLARATION_DIM, LOAD_TS)
    return _dated(upsert_dimension(dim, [increment], d.DECLARATION_DIM, LOAD_TS))


# ---- lookups -------------------------------------------------------------------------------


@query("resolve_by_name")
def resolve_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _staging(spark, sf_dir, ordinal="part").select(
        "declaration_id", "part", "state_name", "county_name", "incident_type"
    )
    rows = materialize(names, "names")
    specs = [d.STATE_DIM, d.DISASTER_DIM, d.COUNTY_DIM]
    historical = rows.where("part = 0")
    dims = side_by_side(
        spark, *[partial(build_dimension, [historical], spec, LOAD_TS) for spec in specs]
    )
    for spec, dim in zip(specs, dims):
        rows = resolve_key(rows, dim, spec.natural_key, spec.tk)
    return rows.select("declaration_id", "state_tk", "county_tk", "disaster_tk")


@query("resolve_by_number")
def resolve_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    historical = d.typed_declarations(_historical(spark, sf_dir))
    dim = build_dimension([historical], d.DECLARATION_DIM, LOAD_TS)
    rows = roles.declaration(spark, sf_dir).select("id", "declaration_request_number")
    return resolve_key(rows, dim, d.DECLARATION_DIM.natural_key, "declaration_tk", unique=True)


@query("resolve_by_period")
def resolve_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Durations as given, so that null has to meet null.
    dim = build_dimension([_historical(spark, sf_dir)], d.DATES_DIM, LOAD_TS)
    rows = roles.declaration(spark, sf_dir).select("id", *d.DATES_DIM.natural_key)
    return resolve_key(
        rows, dim, d.DATES_DIM.natural_key, "incident_dates_tk", null_safe=["incident_duration"]
    ).select("id", "incident_dates_tk")


@query("resolve_or_drop")
def resolve_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _staging(spark, sf_dir).select("declaration_id", "county_name")
    dim = build_dimension([_flat_historical(spark, sf_dir)], d.COUNTY_DIM, LOAD_TS)
    return resolve_key(rows, dim, ["county_name"], "county_tk", on_miss="drop")


@query("resolve_untidy")
def resolve_untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with doubled and untidy names: every row keeps its one lowest key."""
    rows = roles.flat(spark, sf_dir, roles.declaration(spark, sf_dir))
    staging = d.type_staging(rows, keep=["declaration_id"])
    tidy = build_dimension([roles.county(spark, sf_dir)], d.COUNTY_DIM, LOAD_TS)
    untidy = tidy.withColumns(
        {
            "county_tk": F.col("county_tk") + 1_000_000,
            "county_name": F.concat(F.lit("  "), F.lower("county_name"), F.lit(" ")),
        }
    )
    dim = tidy.unionByName(untidy)
    lookup = d.Lookup(dim, "county_tk", ["county_name"], normalized=["county_name"])
    return resolve_all(staging, [lookup]).select("declaration_id", "county_tk")


@query("unknown_misses")
def unknown_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names given as unknown, and states and types the dimensions lack, go to member 0."""
    flat = _flat_all(spark, sf_dir)
    third = F.col("declaration_id") % 3
    state = F.when(third == 1, " unknown ").otherwise(F.col("state_name"))
    rows = materialize(
        d.type_staging(flat.withColumn("state_name", state), keep=["declaration_id"]), "rows"
    )
    known = rows.where("incident_type <> '5-LOW' and state_name not like '%A%'")
    for spec in (d.STATE_DIM, d.DISASTER_DIM):
        dim = build_dimension([known, rows.where("state_name = 'UNKNOWN'")], spec, LOAD_TS)
        dim = dim.where("incident_type <> '5-LOW'") if spec is d.DISASTER_DIM else dim
        rows = resolve_key(rows, dim, spec.natural_key, spec.tk)
    return unknown_report(rows, ["state_tk", "disaster_tk"])


# ---- fact ----------------------------------------------------------------------------------


@query("fact_for_state")
def fact_for_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _staging(spark, sf_dir)
    dim = build_dimension([roles.state(spark, sf_dir)], d.STATE_DIM, LOAD_TS)
    # Rows are summed per name first, so the lookup sees one row per state.
    sums = rows.groupBy("state_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("deaths").alias("deaths")
    )
    keyed = resolve_key(sums, dim, ["state_name"], "state_tk", unique=True)
    return keyed.groupBy("state_tk").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("deaths").alias("deaths")
    )


@query("fact_disaster")
def fact_disaster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).fact


@query("fact_disaster_bag")
def fact_disaster_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of dates and types only, where many rows are equal in every column."""
    rows = _staging(spark, sf_dir).select("incident_type", "deaths")
    dim = build_dimension([roles.disaster(spark, sf_dir)], d.DISASTER_DIM, LOAD_TS)
    lookups = [d.Lookup(dim, "disaster_tk", ["incident_type"])]
    return d.build_fact(rows, lookups, d.FACT_TK, ["disaster_tk"], d.MEASURES)


@query("fact_for_member")
def fact_for_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_for_member(_star(spark, sf_dir).fact, "state_tk", 1)


# ---- checks --------------------------------------------------------------------------------


@query("row_counts")
def row_counts_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return row_counts(
        {
            "state_dim": star.state,
            "county_dim": star.county,
            "disaster_dim": star.disaster,
            "declaration_dim": star.declaration,
            "incident_datesdim": star.dates,
            "disaster_fact": star.fact,
        }
    )


@query("distinct_count")
def distinct_count_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_count(roles.table(spark, sf_dir, "orders"), "o_orderdate")


@query("duplicate_groups")
def duplicate_groups_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(roles.declaration(spark, sf_dir), ["declaration_date"])


@query("unknown_report")
def unknown_report_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_report(_star(spark, sf_dir).fact, d.FACT_KEYS)


@query("pk_violations")
def pk_violations_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk_violations(roles.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("constraint_violations")
def constraint_violations_declaration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraint_violations(
        roles.declaration(spark, sf_dir),
        not_null=["id", "incident_end_date", "incident_duration"],
        unique=["id", "declaration_request_number"],
    )


@query("fk_orphans")
def fk_orphans_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose order is not in the historical half."""
    _, historical = split_hash(
        roles.table(spark, sf_dir, "orders"), ["o_orderkey"], roles.INCREMENT, roles.SPLIT_SEED
    )
    lineitem = roles.table(spark, sf_dir, "lineitem")
    return fk_orphans(lineitem, historical, "l_orderkey", "o_orderkey")


# ---- end to end ----------------------------------------------------------------------------


@query("clean_declarations")
def clean_declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.clean_declarations(
        roles.raw(spark, sf_dir),
        roles.county_codes(spark, sf_dir),
        row_key=["id"],
        states=roles.state_codes(spark, sf_dir),
        order="line",
    )


@query("clean_halves")
def clean_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = roles.raw(spark, sf_dir).withColumn("row", F.col("id"))
    increment, historical = d.clean_to_halves(
        raw,
        roles.county_codes(spark, sf_dir),
        ["row"],
        fresh_path(spark, "increment"),
        fresh_path(spark, "historical"),
        states=roles.state_codes(spark, sf_dir),
        order="line",
    )
    columns = ["row", "county_name", "state_name", "deaths"]
    return union_all(
        [
            increment.select(*columns, F.lit("increment").alias("half")),
            historical.select(*columns, F.lit("historical").alias("half")),
        ]
    )


def _loaded_star(
    spark: SparkSession, sf_dir: str
) -> tuple[str, int, DataFrame, list[str]]:
    """A stored star of the historical half and half of the increment: its folder, its number of
    fact rows, the other half of the increment, and what tells declarations apart."""
    types = roles.disaster(spark, sf_dir)
    historical, increment = roles.halves(spark, sf_dir, written=True)
    first, later = (
        roles.untidy(roles.flat(spark, sf_dir, increment.where(half), types))
        for half in ("id % 2 = 0", "id % 2 = 1")
    )
    ties = ["declaration_request_number", "declaration_id"]
    star = d.build_star(
        roles.state(spark, sf_dir),
        roles.county(spark, sf_dir),
        types,
        historical,
        first,
        LOAD_TS,
        tie_break=ties,
    )
    folder = fresh_path(spark, "star")
    report = d.load_star(star, folder)
    return folder, report.first()["n_rows"], later, ties


def _named_fact(spark: SparkSession, folder: str, loaded: int) -> DataFrame:
    """The stored fact with natural keys; rows after the first ``loaded`` ones are the later ones."""
    stored = d.stored_star(spark, folder)
    rows = stored["disaster_fact"].withColumn("is_later", F.col(d.FACT_TK) > loaded)
    for name, tk in zip(d.STAR_TABLES, d.FACT_KEYS):
        rows = rows.join(stored[name].drop("version", "date_from", "date_to"), tk)
    return rows.select(
        F.col(d.FACT_TK).between(1, stored["disaster_fact"].count()).alias("in_range"),
        "is_later",
        "state_name",
        "county_name",
        "incident_type",
        "declaration_request_number",
        "incident_begin_date",
        "incident_duration",
        "deaths",
    )


@query("apply_increment")
def apply_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact with its natural keys, half of the increment loaded with the star and half
    added later, twice (the second time changes nothing)."""
    folder, loaded, later, ties = _loaded_star(spark, sf_dir)
    for _ in range(2):
        d.apply_increment(spark, folder, later, "later", LOAD_TS, ties)
    return _named_fact(spark, folder, loaded)


@query("feed_increments")
def feed_increments_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, the later half arriving as files that a stream takes in: two runs with new files
    and one without."""
    folder, loaded, later, ties = _loaded_star(spark, sf_dir)
    source, checkpoint = fresh_path(spark, "arrived"), fresh_path(spark, "feed")
    for part in (1, 3, None):
        if part:
            append_table(later.where(F.col("declaration_id") % 4 == part), source)
        feed_increments(
            spark, source, later.schema, folder, checkpoint, LOAD_TS, ties, files_per_batch=4
        )
    return _named_fact(spark, folder, loaded)


@query("load_star_counts")
def load_star_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tasks counted that wrote the star."""
    counts = d.load_star_counts(_star(spark, sf_dir), fresh_path(spark, "star"))
    lines = [(name, metric, n) for name, found in counts.items() for metric, n in found.items()]
    return spark.createDataFrame(lines, "table_name string, metric string, n bigint")


# ---- versions ------------------------------------------------------------------------------


def _request_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the requests: the historical half, then the increment, which also brings changes
    that lie between those known."""
    historical, increment = (d.typed_declarations(h) for h in roles.halves(spark, sf_dir))
    first = materialize(build_history([historical], d.REQUEST_DIM, "declaration_date"), "first")
    for _ in range(2):  # the second time changes nothing
        updated = update_history(first, [increment], d.REQUEST_DIM, "declaration_date")
        first = materialize(updated, "updated")
    return first


@query("dim_versions")
def dim_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(_request_history(spark, sf_dir))


@query("resolve_at_date")
def resolve_at_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarations and the version of their request that was valid when the incident ended."""
    rows = roles.declaration(spark, sf_dir).select(
        "id", "declaration_request_number", "incident_end_date"
    )
    dim = _request_history(spark, sf_dir)
    key = d.REQUEST_DIM.natural_key
    return resolve_key_at(rows, dim, key, "declaration_tk", "incident_end_date")


@query("resolve_at_date_sorted")
def resolve_at_date_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the way for members with many versions."""
    rows = roles.declaration(spark, sf_dir).select(
        "id", "declaration_request_number", "incident_end_date"
    )
    dim = _request_history(spark, sf_dir)
    key = d.REQUEST_DIM.natural_key
    return resolve_key_at(
        rows, dim, key, "declaration_tk", "incident_end_date", few_versions=0
    )


# ---- hot keys, buckets, collations ---------------------------------------------------------


@query("resolve_hot")
def resolve_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of which a third have one part, others none or one the dimension lacks."""
    parts = roles.table(spark, sf_dir, "part").where("p_partkey % 5 <> 0").select("p_partkey")
    dim = dense_key(parts, ["p_partkey"], "part_tk")
    third = F.col("l_orderkey") % 3
    rows = roles.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(third == 0, 7)
        .when((third == 1) & (F.col("l_linenumber") % 2 == 0), F.lit(None))
        .otherwise(F.col("l_partkey") * 2)
        .cast("bigint")
        .alias("part"),
    )
    rows = materialize(rows, "rows")
    return resolve_hot_key(rows, dim, {"part": "p_partkey"}, "part_tk", unique=True)


@query("resolve_bucketed")
def resolve_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and counties written in buckets of the county, then looked up without an exchange."""
    county = roles.table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select("c_custkey")
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dim = dense_key(county, ["c_custkey"], "county_tk")
    label = uuid4().hex
    dim, rows = (
        write_bucketed(df, f"{name}_{label}", fresh_path(spark, name), [key], 8)
        for name, df, key in (("county", dim, "c_custkey"), ("orders", orders, "o_custkey"))
    )
    return resolve_key(rows, dim, {"o_custkey": "c_custkey"}, "county_tk", unique=True)


_COLLATION = "UNICODE_CI_AI"


def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three customers share a name, which each spells in another way."""
    third = F.col("c_custkey") % 3
    number = F.lpad(F.floor(F.col("c_custkey") / 3).cast("string"), 9, "0")
    name = F.concat(F.lit("Customer "), number)
    spelled = F.when(third == 0, F.upper(name)).when(third == 1, F.replace(name, F.lit("u"), F.lit("ú")))
    customer = roles.table(spark, sf_dir, "customer")
    return customer.select("c_custkey", spelled.otherwise(name).alias("county_name"))


@query("resolve_collated")
def resolve_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One member per name, whatever its case and accents, found under every spelling."""
    rows = materialize(_spelled(spark, sf_dir), "spelled")
    members = dedupe(rows, ["county_name"], ["c_custkey"], collation=_COLLATION)
    by_name = [F.collate("county_name", _COLLATION)]
    dim = dense_key(members.select("county_name"), by_name, "county_tk")
    return resolve_key(rows, dim, ["county_name"], "county_tk", collation=_COLLATION).select(
        "c_custkey", "county_tk"
    )


@query("sorted_collated")
def sorted_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sorted_rows(_spelled(spark, sf_dir), ["county_name"], collation=_COLLATION)
    return placed_key(rows, "position").select("c_custkey", "position")


# ---- checks by bitmaps, sketches and checksums ---------------------------------------------


@query("pk_violations_dense")
def pk_violations_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk_violations_dense(roles.table(spark, sf_dir, "orders"), "o_custkey")


@query("fk_orphans_dense")
def fk_orphans_dense_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, historical = split_hash(
        roles.table(spark, sf_dir, "orders"), ["o_orderkey"], roles.INCREMENT, roles.SPLIT_SEED
    )
    lineitem = roles.table(spark, sf_dir, "lineitem")
    return fk_orphans_dense(lineitem, historical, "l_orderkey", "o_orderkey")


@query("distinct_keys")
def distinct_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_keys(roles.table(spark, sf_dir, "lineitem"), "l_partkey")


@query("distinct_sketches")
def distinct_sketches_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of two loads, kept as a table; merged, they are within 3 % of the exact count."""
    orders, columns = roles.table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate", "o_orderkey"]
    loads = split_hash(orders, ["o_orderkey"], roles.INCREMENT, roles.SPLIT_SEED)
    path = fresh_path(spark, "sketches")
    for name, load in zip(("increment", "historical"), loads):
        append_table(distinct_sketches(load, columns, name), path)
    merged = distinct_estimates(read_parquet(spark, path))
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])
    both = merged.join(exact.select(F.inline(lines)), "column_name")
    near = F.abs(F.col("n_distinct") - F.col("n")) <= F.col("n") * 0.03
    return both.select("column_name", F.col("n").alias("n_exact"), near.alias("is_near"))


@query("sink_readback_content")
def sink_readback_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read back as it was written, and one in which two values changed places."""
    customer = roles.table(spark, sf_dir, "customer")
    stored = overwrite_table(customer, fresh_path(spark, "content"))
    swapped = F.when(F.col("c_custkey") == 1, 2).when(F.col("c_custkey") == 2, 1)
    other = stored.withColumn("c_custkey", swapped.otherwise(F.col("c_custkey")).cast("bigint"))
    return union_all([readback_content(customer, stored), readback_content(customer, other)])


@query("split_exact_bag")
def split_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of exact size of a table whose rows repeat."""
    rows = roles.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    sample, rest = split_exact_bag(rows, 0.3, roles.SPLIT_SEED)
    return sample.withColumn("half", F.lit("sample")).unionByName(
        rest.withColumn("half", F.lit("rest"))
    )
