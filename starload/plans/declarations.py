"""The declarations warehouse: raw file to cleaned halves to keyed tables to star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import (
    duration_elapsed,
    duration_hours,
    norm_str,
    seeded_int,
)
from starload.functions.dates import ISO_DATE, ISO_TIMESTAMP, parse_timestamp
from starload.operators.arrange import union_all
from starload.operators.cleanse import (
    cast_columns,
    drop_columns,
    drop_null_keys,
    fill_unknown,
    rename_columns,
    to_flag,
)
from starload.operators.dimensions import (
    UNKNOWN_KEY,
    Dimension,
    backfill_dimension,
    backfill_rows,
    build_dimension,
    new_members,
)
from starload.operators.fact import Lookup, build_fact
from starload.operators.keys import dense_key, max_key
from starload.operators.lookup import resolve_key
from starload.operators.mapping import map_codes, map_literal
from starload.operators.normalize import denormalize, keyed_members
from starload.operators.quality import require_rows, unknown_report
from starload.operators.split import split_exact
from starload.plans.schemas import (
    DECLARATION_TYPES,
    FLAGS,
    RAW_UNUSED,
    STAGING,
    STATE_NAMES,
)
from starload.sources import overwrite_table, read_jdbc, read_parquet, write_jdbc
from starload.sources.batches import (
    append_batch,
    resume_batch,
    resume_switch,
    switch_tables,
)
from starload.sources.jdbc import Partitioning
from starload.tables import materialize, side_by_side

STATE_DIM = Dimension(
    tk="state_tk",
    natural_key=["state_name"],
    normalized=["state_name"],
    unknown={"state_name": "UNKNOWN"},
)
COUNTY_DIM = Dimension(
    tk="county_tk",
    natural_key=["county_name"],
    normalized=["county_name"],
    unknown={"county_name": "UNKNOWN"},
)
DISASTER_DIM = Dimension(
    tk="disaster_tk",
    natural_key=["incident_type"],
    normalized=["incident_type"],
    unknown={"incident_type": "UNKNOWN"},
)
DECLARATION_DIM = Dimension(
    tk="declaration_tk",
    natural_key=["declaration_request_number"],
    attributes=["declaration_title", "declaration_type", "declaration_date", *FLAGS],
    unknown={flag: False for flag in FLAGS},
)
# Declaration identity by all of its attributes instead of the request number.
DECLARATION_FULL_DIM = Dimension(
    tk="declaration_tk",
    natural_key=[
        "declaration_request_number",
        "declaration_title",
        "declaration_type",
        "declaration_date",
        *FLAGS,
    ],
    nullable_key=["declaration_title", "declaration_type", "declaration_date", *FLAGS],
    unknown={flag: False for flag in FLAGS},
)
DATES_DIM = Dimension(
    tk="incident_dates_tk",
    natural_key=["incident_begin_date", "incident_end_date", "incident_duration"],
    nullable_key=["incident_duration"],
    unknown={"incident_duration": 0},
)
# A request's title and type change from declaration to declaration.
REQUEST_DIM = Dimension(
    tk="declaration_tk",
    natural_key=["declaration_request_number"],
    attributes=["declaration_title", "declaration_type"],
)
# One member per pair of dates, with the lowest duration as attribute.
DATES_PAIR_DIM = Dimension(
    tk="incident_dates_tk",
    natural_key=["incident_begin_date", "incident_end_date"],
    attributes=["incident_duration"],
    unknown={"incident_duration": 0},
)

#: The stored tables, dimensions first in the order of the fact's keys.
STAR_TABLES = [
    "state_dim",
    "county_dim",
    "disaster_dim",
    "declaration_dim",
    "incident_datesdim",
    "disaster_fact",
]
FACT_TK = "disaster_fact_tk"
FACT_KEYS = ["state_tk", "county_tk", "disaster_tk", "declaration_tk", "incident_dates_tk"]
MEASURES = ["deaths"]


# ---- cleaning ------------------------------------------------------------------------------


def clean_declarations(
    raw: DataFrame,
    counties: DataFrame,
    row_key: Sequence[str],
    states: DataFrame | Mapping[str, str] = STATE_NAMES,
    types: Mapping[str, str] = DECLARATION_TYPES,
    unused: Sequence[str] = RAW_UNUSED,
    seed: int = 1,
    order: str | None = None,
) -> DataFrame:
    """Clean raw declarations.

    Rows without an end date go, unused columns go, null text becomes ``unknown``, codes become
    names (``counties``: code, name and, to let the last of several win, ``order``), dates
    become ``yyyy-MM-dd`` text, the duration is the elapsed whole days in hours (1 to 24 hours
    within one day), and ``deaths`` is 0 to 9999. The made-up numbers depend on ``seed`` and
    ``row_key`` only.
    """
    rows = drop_null_keys(raw, ["incident_end_date"])
    dates = ["declaration_date", "incident_begin_date", "incident_end_date"]
    # Columns of their own, so that each date is parsed once per row.
    rows = rows.withColumns({c: parse_timestamp(c, [ISO_TIMESTAMP]) for c in dates})
    rows = rows.withColumn("_elapsed", duration_elapsed("incident_begin_date", "incident_end_date"))
    elapsed = F.col("_elapsed")
    same_day = seeded_int(row_key, 24, f"{seed}:hours", low=1).cast("bigint")
    rows = rows.withColumns(
        {
            "deaths": seeded_int(row_key, 10_000, f"{seed}:deaths").cast("bigint"),
            "incident_duration": F.when(elapsed == 0, same_day).otherwise(elapsed),
        }
    ).drop("_elapsed")
    rows = drop_columns(rows, [c for c in unused if c in rows.columns])
    rows = fill_unknown(rows)
    rows = rows.withColumns({c: F.date_format(c, ISO_DATE) for c in dates})
    rows = rows.withColumn("declaration_type", map_literal("declaration_type", types))
    if isinstance(states, DataFrame):
        rows = map_codes(rows, "state", states)
    else:
        rows = rows.withColumn("state", map_literal("state", states))
    rows = map_codes(rows, "fips", counties, order=order)
    return rename_columns(rows, {"fips": "county_name", "state": "state_name"})


def clean_to_halves(
    raw: DataFrame,
    counties: DataFrame,
    row_key: Sequence[str],
    increment_path: str,
    historical_path: str,
    fraction: float = 0.2,
    seed: int = 1,
    **cleaning: object,
) -> tuple[DataFrame, DataFrame]:
    """Clean, split exactly and write both parts as Parquet; (increment, historical) as stored.

    The cleaned rows are written once; the split reads the hash of their key and two filters.
    """
    cleaned = clean_declarations(raw, counties, row_key, seed=seed, **cleaning)
    cleaned = materialize(cleaned, "clean")
    increment, historical = split_exact(cleaned, row_key, fraction, seed)
    stored = side_by_side(
        raw.sparkSession,
        lambda: overwrite_table(increment, increment_path),
        lambda: overwrite_table(historical, historical_path),
    )
    return stored[0], stored[1]


# ---- keyed tables --------------------------------------------------------------------------


@dataclass(frozen=True)
class Tables:
    """Normalised tables; ``rejects`` are the flat rows whose county or type is not known."""

    state: DataFrame
    county: DataFrame
    disaster: DataFrame
    declaration: DataFrame
    rejects: DataFrame


def normalize_state(flat: DataFrame) -> DataFrame:
    return keyed_members(flat, ["state_name"])


def normalize_type(flat: DataFrame) -> DataFrame:
    return keyed_members(flat, ["incident_type"])


def normalize_county(
    flat: DataFrame, state: DataFrame, distinct: bool = True, ties: Sequence[str] = ()
) -> DataFrame:
    """Counties by state and name. ``distinct=False``: one row per input row."""
    rows = keyed_members(flat, ["state_name", "county_name"], distinct=distinct, ties=ties)
    # State ids are unique per name, so the county ids survive the lookup as they are.
    keyed = resolve_key(
        rows, state, ["state_name"], "id", on_miss="drop", unique=True, out="state_fk"
    )
    return keyed.select("id", "county_name", "state_fk")


def link_declarations(flat: DataFrame, county: DataFrame, disaster: DataFrame) -> DataFrame:
    """Flat rows with both foreign keys, null on a miss. A county is found by name alone, and
    the first one (lowest id) of that name counts."""
    rows = resolve_key(
        flat, disaster, ["incident_type"], "id", on_miss="null", unique=True, out="disaster_fk"
    )
    return resolve_key(rows, county, ["county_name"], "id", on_miss="null", out="county_fk")


def normalize_declaration(
    flat: DataFrame, county: DataFrame, disaster: DataFrame, order: Sequence[str]
) -> DataFrame:
    """Declarations with ids in the order of ``order`` (which tells rows apart)."""
    linked = materialize(link_declarations(flat, county, disaster), "linked")
    return _linked_declarations(linked, order)


def _linked_declarations(linked: DataFrame, order: Sequence[str]) -> DataFrame:
    rows = drop_null_keys(linked, ["disaster_fk", "county_fk"])
    return dense_key(rows.drop("state_name", "county_name", "incident_type"), list(order), "id")


def normalize(
    flat: DataFrame,
    order: Sequence[str],
    distinct_counties: bool = True,
    county_ties: Sequence[str] = (),
) -> Tables:
    """All keyed tables. The flat rows and the linked ones are read several times, so each is
    written once first."""
    flat = materialize(flat, "flat")
    state = normalize_state(flat)
    county = normalize_county(flat, state, distinct_counties, county_ties)
    disaster = normalize_type(flat)
    linked = materialize(link_declarations(flat, county, disaster), "linked")
    return Tables(
        state=state,
        county=county,
        disaster=disaster,
        declaration=_linked_declarations(linked, order),
        rejects=linked.where(F.col("disaster_fk").isNull() | F.col("county_fk").isNull()),
    )


# ---- staging -------------------------------------------------------------------------------


def type_staging(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Staging columns in their types, names normalised, missing durations filled in."""
    typed = cast_columns(
        rows,
        {
            "declaration_request_number": "bigint",
            "incident_begin_date": "date",
            "incident_end_date": "date",
            "incident_duration": "bigint",
            "deaths": "bigint",
        },
    )
    return typed.select(
        norm_str("state_name").alias("state_name"),
        norm_str("county_name").alias("county_name"),
        norm_str("incident_type").alias("incident_type"),
        "declaration_request_number",
        "incident_begin_date",
        "incident_end_date",
        duration_hours("incident_begin_date", "incident_end_date", F.col("incident_duration"))
        .cast("bigint")
        .alias("incident_duration"),
        "deaths",
        *keep,
    )


def denormalize_declarations(
    declaration: DataFrame,
    county: DataFrame,
    state: DataFrame,
    disaster: DataFrame,
    hint: str | None = None,
) -> DataFrame:
    """``hint`` is for the join with the counties, the only large parent."""
    parents = [
        (county, "county_fk", "id"),
        (state, "state_fk", "id"),
        (disaster, "disaster_fk", "id"),
    ]
    hints = {"county_fk": hint} if hint else None
    return denormalize(declaration.withColumnRenamed("id", "declaration_id"), parents, hints)


def stage(
    historical: DataFrame,
    increment: DataFrame,
    ordinal: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Historical rows and the increment as one typed staging table (``ordinal``: 0 and 1)."""
    return union_all(
        [type_staging(historical, keep), type_staging(increment, keep)], ordinal
    )


# ---- star schema ---------------------------------------------------------------------------


def typed_declarations(rows: DataFrame) -> DataFrame:
    """Declaration attributes in the types of the dimension."""
    return rows.withColumns(
        {
            "declaration_date": F.col("declaration_date").try_cast("date"),
            **{flag: to_flag(F.col(flag)) for flag in FLAGS},
        }
    )


def typed_dates(rows: DataFrame) -> DataFrame:
    """Begin, end and duration (hours, filled in where missing)."""
    typed = cast_columns(
        rows.select("incident_begin_date", "incident_end_date", "incident_duration"),
        {"incident_begin_date": "date", "incident_end_date": "date", "incident_duration": "bigint"},
    )
    hours = duration_hours(
        "incident_begin_date", "incident_end_date", F.col("incident_duration")
    )
    return typed.withColumn("incident_duration", hours.cast("bigint"))


def fact_lookups(
    state: DataFrame,
    county: DataFrame,
    disaster: DataFrame,
    declaration: DataFrame,
    dates: DataFrame,
    state_on_miss: str = "default",
    unique: bool = False,
    untidy: bool = False,
) -> list[Lookup]:
    """The five lookups, smallest dimension first.

    ``unique`` promises dimensions without doubled natural keys, as ``build_dimension`` makes
    them; otherwise each is reduced to its lowest key per natural key first. ``untidy``
    dimensions have their names normalised for the comparison.
    """

    def named(dim: DataFrame, tk: str, name: str, on_miss: str = "default") -> Lookup:
        tidied = [name] if untidy else []
        return Lookup(dim, tk, [name], on_miss=on_miss, unique=unique, normalized=tidied)

    return [
        named(state, "state_tk", "state_name", state_on_miss),
        named(disaster, "disaster_tk", "incident_type"),
        named(county, "county_tk", "county_name"),
        Lookup(
            dates,
            "incident_dates_tk",
            ["incident_begin_date", "incident_end_date", "incident_duration"],
            null_safe=["incident_duration"],
            unique=unique,
        ),
        Lookup(declaration, "declaration_tk", ["declaration_request_number"], unique=unique),
    ]


def disaster_fact(
    staging: DataFrame,
    lookups: Sequence[Lookup],
    tie_break: Sequence[str] | None = None,
    start: int = 1,
) -> DataFrame:
    return build_fact(staging, lookups, FACT_TK, FACT_KEYS, MEASURES, tie_break, start)


@dataclass(frozen=True)
class Star:
    staging: DataFrame
    state: DataFrame
    county: DataFrame
    disaster: DataFrame
    declaration: DataFrame
    dates: DataFrame
    fact: DataFrame


def build_star(
    state: DataFrame,
    county: DataFrame,
    disaster: DataFrame,
    declaration: DataFrame,
    increment: DataFrame,
    load_ts: datetime | str | None = None,
    tie_break: Sequence[str] | None = None,
) -> Star:
    """Dimensions and fact from the keyed tables and an increment of flat rows.

    Both parts of staging are written once and read by every later step; each reads only its
    columns. The increment's copy carries its declaration attributes too, so ``increment`` itself
    is read once. ``tie_break`` names columns of both inputs that tell declarations apart.
    """
    keep = [c for c in tie_break or () if c not in STAGING]
    more = [c for c in DECLARATION_DIM.attributes if c not in keep]
    flat = denormalize_declarations(declaration, county, state, disaster)
    spark = declaration.sparkSession
    historical, added = side_by_side(
        spark,
        lambda: materialize(type_staging(flat, keep), "historical"),
        lambda: materialize(type_staging(increment, [*keep, *more]), "increment"),
    )
    staging = union_all([historical, added.drop(*more)])

    def dates() -> DataFrame:
        known = build_dimension([historical], DATES_DIM, load_ts)
        return backfill_dimension(known, added, DATES_DIM, load_ts)

    declarations = [typed_declarations(declaration), typed_declarations(added)]
    dims = side_by_side(
        spark,
        lambda: build_dimension([state, added], STATE_DIM, load_ts),
        lambda: build_dimension([county, added], COUNTY_DIM, load_ts),
        lambda: build_dimension([disaster, added], DISASTER_DIM, load_ts),
        lambda: build_dimension(declarations, DECLARATION_DIM, load_ts),
        dates,
    )
    fact = disaster_fact(staging, fact_lookups(*dims, unique=True), tie_break)
    return Star(staging, *dims, fact)


def _named_tables(star: Star) -> dict[str, DataFrame]:
    tables = (star.state, star.county, star.disaster, star.declaration, star.dates, star.fact)
    return dict(zip(STAR_TABLES, tables))


def star_tables(star: Star) -> dict[str, DataFrame]:
    """Star tables by the name they are stored under; an empty one is an error."""
    return {name: require_rows(table, name) for name, table in _named_tables(star).items()}


def load_star(star: Star, folder: str) -> DataFrame:
    """Write the star schema under ``folder`` (overwriting) and return the unknown-key report.

    The tables are written beside those in use; only when all are there are they put in their
    place, so a load that fails leaves the earlier star whole. The report is counted by the tasks
    that write the fact; no table is read again.
    """
    found = load_star_counts(star, folder)["disaster_fact"]
    names = ["n_rows", *[f"unknown_{key}" for key in FACT_KEYS]]
    schema = ", ".join(f"{name} bigint" for name in names)
    return star.fact.sparkSession.createDataFrame([tuple(found[name] for name in names)], schema)


def load_star_counts(star: Star, folder: str) -> dict[str, dict[str, int]]:
    """Load like ``load_star``; per table its row count and how many rows have each key unknown.

    All counts are taken while the tables are written. An empty table is an error, found before
    anything is put in place.
    """
    spark = star.fact.sparkSession
    resume_switch(spark, folder, STAR_TABLES)
    rows = {"n_rows": F.count(F.lit(1))}
    metrics = {name: rows for name in STAR_TABLES}
    metrics["disaster_fact"] = rows | {
        f"unknown_{key}": F.count_if(F.col(key) == UNKNOWN_KEY) for key in FACT_KEYS
    }

    def check(found: dict[str, dict[str, int]]) -> None:
        for name, counts in found.items():
            if not counts["n_rows"]:
                raise RuntimeError(f"{name} is empty, nothing is put in place")

    return switch_tables(_named_tables(star), folder, metrics, check)


def stored_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the last load that was written whole."""
    resume_switch(spark, folder, STAR_TABLES)
    return {name: read_parquet(spark, f"{folder}/{name}") for name in STAR_TABLES}


def apply_increment(
    spark: SparkSession,
    folder: str,
    increment: DataFrame,
    batch: str,
    load_ts: datetime | str | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Add an increment of flat rows to the star stored under ``folder``; unknown-key report.

    New members get the next keys, fact rows go on from the highest key, and stored rows are not
    rewritten: the new files are written beside the tables and moved in at the end, the fact's
    last. ``batch`` names the increment; one that is in already changes nothing, and one that
    broke off while its files were moved is finished first.
    """
    if not resume_batch(spark, folder, STAR_TABLES, batch):
        dims = stored_star(spark, folder)
        keep = [c for c in tie_break or () if c not in STAGING]
        more = [c for c in DECLARATION_DIM.attributes if c not in keep]
        added = materialize(type_staging(increment, [*keep, *more]), "increment")
        steps = [
            lambda: new_members(dims["state_dim"], [added], STATE_DIM, load_ts),
            lambda: new_members(dims["county_dim"], [added], COUNTY_DIM, load_ts),
            lambda: new_members(dims["disaster_dim"], [added], DISASTER_DIM, load_ts),
            lambda: new_members(
                dims["declaration_dim"], [typed_declarations(added)], DECLARATION_DIM, load_ts
            ),
            lambda: backfill_rows(dims["incident_datesdim"], added, DATES_DIM, load_ts),
        ]
        new = dict(zip(STAR_TABLES, side_by_side(spark, *steps)))
        whole = [dims[name].unionByName(rows) for name, rows in new.items()]
        start = max_key(dims["disaster_fact"], FACT_TK) + 1
        lookups = fact_lookups(*whole, unique=True)
        new["disaster_fact"] = disaster_fact(added.drop(*more), lookups, tie_break, start)
        append_batch(new, folder, batch)
    fact = stored_star(spark, folder)["disaster_fact"]
    return unknown_report(fact, FACT_KEYS)


# ---- database ------------------------------------------------------------------------------


def read_tables_jdbc(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str] | None = None,
    declarations: Partitioning | None = None,
    counties: Partitioning | None = None,
    single_task: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """State, County, Disaster and Declaration tables of a database, counties and declarations in
    ranges. ``single_task`` says that one task may read a table whose ranges are not given."""
    if not single_task and (declarations is None or counties is None):
        raise ValueError("give ranges for declarations and counties, or say single_task")
    ranges = {"County": counties, "Declaration": declarations}
    state, county, disaster, declaration = (
        read_jdbc(spark, url, f'"{name}"', properties, ranges.get(name))
        for name in ("State", "County", "Disaster", "Declaration")
    )
    return state, county, disaster, declaration


def load_star_jdbc(
    star: Star,
    url: str,
    properties: Mapping[str, str] | None = None,
    schema: str = "public",
    mode: str = "overwrite",
    partitions: int | None = None,
    text_width: int | None = None,
) -> None:
    """Write the star schema to a database. Tables that exist are emptied, not dropped. Texts are
    unbounded unless ``text_width`` asks for a VARCHAR of that width."""
    for name, table in star_tables(star).items():
        write_jdbc(
            table,
            url,
            f"{schema}.{name}",
            properties,
            mode=mode,
            truncate=True,
            column_types=_column_types(table, text_width),
            partitions=partitions,
        )


def _column_types(table: DataFrame, text_width: int | None = None) -> dict[str, str]:
    """Database types."""
    names = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "timestamp": "TIMESTAMP",
        "date": "DATE",
        "boolean": "BOOLEAN",
        "string": f"VARCHAR({text_width})" if text_width else "TEXT",
    }
    return {f.name: names[f.dataType.simpleString()] for f in table.schema.fields}
