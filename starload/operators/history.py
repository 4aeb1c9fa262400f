"""Versions of a member over time, and the version that was valid at a date.

A version begins where a member's attributes differ from those before. Rows of all members are
sorted by member and time over all executors, written, and looked at in windows of one sorted
partition; what a window needs from its neighbours is one row per partition. A member with a third
of all changes is therefore spread like any other rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from starload.operators.cleanse import drop_null_keys
from starload.operators.dedupe import dedupe
from starload.operators.dimensions import (
    OPEN_END,
    UNKNOWN_KEY,
    Dimension,
    member_rows,
    unknown_member,
    without_unknown,
)
from starload.operators.keys import max_key
from starload.operators.lookup import matches, resolve_key
from starload.tables import materialize

#: From when on the first version of a member is valid.
FIRST_START = "1900-01-01 00:00:00"
#: Up to so many versions of a member are compared one by one with a row's date.
FEW_VERSIONS = 32

_PLACE, _PART = "_place", "_part"


def _here() -> WindowSpec:
    """Inside one sorted partition."""
    return Window.partitionBy(_PART).orderBy(_PLACE)


def _so_far() -> WindowSpec:
    return _here().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _parts() -> WindowSpec:
    """Over one row per sorted partition."""
    return Window.orderBy(_PART)


def _parts_before() -> WindowSpec:
    return _parts().rowsBetween(Window.unboundedPreceding, -1)


def _placed(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` sorted over all executors and written, with partition and place."""
    ordered = rows.orderBy(*order).withColumn(_PLACE, F.monotonically_increasing_id())
    return materialize(ordered, label).withColumn(_PART, F.shiftright(_PLACE, 33))


def _with_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Join the one row per partition that ``parts`` has."""
    parts = materialize(parts.withColumnRenamed(_PART, "_of"), "parts")
    return rows.join(parts, F.col(_PART) == F.col("_of"), "left").drop("_of")


def _with_previous(placed: DataFrame, row: Column, name: str) -> DataFrame:
    """Add ``row`` of the row before, across partitions."""
    lasts = placed.groupBy(_PART).agg(F.max_by(row, _PLACE).alias("_last"))
    before = lasts.select(_PART, F.lag("_last").over(_parts()).alias("_before"))
    joined = _with_parts(placed.withColumn(name, F.lag(row).over(_here())), before)
    return joined.withColumn(name, F.coalesce(name, "_before")).drop("_before")


def _versions(rows: DataFrame, spec: Dimension, start: int, first_start: str) -> DataFrame:
    """``rows`` (natural key, attributes, ``_at``, ``_tk``; one per member and time) as versions.

    Rows with a ``_tk`` are versions already and stay so; others only where they change something.
    """
    key = F.struct(*spec.natural_key)
    placed = _placed(rows, [*spec.natural_key, "_at"], "changes")
    seen = _with_previous(placed, F.struct(*spec.columns), "_previous")
    previous = F.struct(*[F.col(f"_previous.{c}").alias(c) for c in spec.natural_key])
    first = F.col("_previous").isNull() | ~previous.eqNullSafe(key)
    same = F.col("_previous").eqNullSafe(F.struct(*spec.columns))
    flagged = seen.withColumn("_first", first)
    changed = flagged.where(F.col("_first") | ~same | F.col("_tk").isNotNull()).drop("_previous")
    is_new = F.col("_tk").isNull().cast("long")
    numbered = materialize(
        changed.withColumns(
            {
                "_nth": F.row_number().over(_here()).cast("long"),
                "_nth_new": F.sum(is_new).over(_so_far()),
            }
        ),
        "versions",
    )
    parts = numbered.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(is_new).alias("_n_new"),
        F.max(F.when(F.col("_first"), F.col("_nth"))).alias("_last_first"),
        F.min_by(F.struct(*spec.natural_key, "_at"), "_nth").alias("_head"),
    )
    parts = parts.withColumns(
        {
            "_ahead": F.coalesce(F.sum("_n").over(_parts_before()), F.lit(0)),
            "_ahead_new": F.coalesce(F.sum("_n_new").over(_parts_before()), F.lit(0)),
            "_next_head": F.lead("_head").over(_parts()),
        }
    )
    begun = F.col("_ahead") + F.col("_last_first")
    parts = parts.select(
        _PART,
        "_ahead",
        "_ahead_new",
        "_next_head",
        F.last(begun, ignorenulls=True).over(_parts_before()).alias("_begun"),
    )
    joined = _with_parts(numbered, parts)
    nth = F.col("_ahead") + F.col("_nth")
    begin = F.coalesce(
        F.last(F.when(F.col("_first"), nth), ignorenulls=True).over(_so_far()), F.col("_begun")
    )
    following = F.coalesce(
        F.lead(F.struct(*spec.natural_key, "_at")).over(_here()), F.col("_next_head")
    )
    found = joined.withColumns({"version": (nth - begin + 1).cast("int"), "_following": following})
    next_key = F.struct(*[F.col(f"_following.{c}").alias(c) for c in spec.natural_key])
    goes_on = F.col("_following").isNotNull() & next_key.eqNullSafe(key)
    new_tk = F.col("_ahead_new") + F.col("_nth_new") + F.lit(start - 1)
    return found.withColumns(
        {
            spec.tk: F.coalesce("_tk", new_tk).cast("bigint"),
            "date_from": F.when(F.col("version") == 1, F.least("_at", _time(first_start)))
            .otherwise(F.col("_at")),
            "date_to": F.when(goes_on, F.col("_following._at")).otherwise(_time(OPEN_END)),
        }
    ).select(*spec.layout)


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _changes(sources: Sequence[DataFrame], spec: Dimension, at: str) -> DataFrame:
    """One row per member and time; of several at one time the lowest counts."""
    rows = member_rows(sources, spec, [at]).where(F.col(at).isNotNull())
    timed = rows.select(*spec.columns, F.col(at).cast("timestamp").alias("_at"))
    return dedupe(timed, [*spec.natural_key, "_at"])


def build_history(
    sources: Sequence[DataFrame],
    spec: Dimension,
    at: str,
    first_start: str = FIRST_START,
) -> DataFrame:
    """A dimension with one row per version of each member, and member 0.

    ``at`` says when a row's attributes began to hold; rows without it or without a key are left
    out. A version ends where the next one begins; the first holds from ``first_start`` and the
    last until the open end.
    """
    rows = _changes(sources, spec, at).withColumn("_tk", F.lit(None).cast("bigint"))
    versions = _versions(rows, spec, 1, first_start)
    return unknown_member(versions, spec, first_start).unionByName(versions)


def update_history(
    dim: DataFrame,
    sources: Sequence[DataFrame],
    spec: Dimension,
    at: str,
    first_start: str = FIRST_START,
) -> DataFrame:
    """``dim`` of ``build_history`` with the changes of a later load.

    A stored version keeps its key and its begin; it ends where a new version begins, also where
    that came late and lies between two stored ones (versions count again in order of time). A
    change at the very begin of a stored version is taken as in already, so a load done twice
    changes nothing. Members without changes are passed through.
    """
    changes = materialize(_changes(sources, spec, at), "incoming")
    names = {c: f"_touched_{c}" for c in spec.natural_key}
    touched = materialize(changes.select(*spec.natural_key).distinct().toDF(*names.values()), "keys")
    condition = matches(names, spec.nullable_key)
    known = without_unknown(dim, spec.tk)
    stored = known.join(touched, condition, "left_semi").select(
        *spec.columns, F.col("date_from").alias("_at"), F.col(spec.tk).alias("_tk")
    )
    both = stored.unionByName(changes.withColumn("_tk", F.lit(None).cast("bigint")))
    both = dedupe(both, [*spec.natural_key, "_at"], order=["_tk"])
    versions = _versions(both, spec, max_key(dim, spec.tk) + 1, first_start)
    others = known.join(touched, condition, "left_anti").select(*spec.layout)
    unknown = dim.where(F.col(spec.tk) == UNKNOWN_KEY).select(*spec.layout)
    return unknown.unionByName(others).unionByName(versions)


def resolve_key_at(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    tk: str,
    at: str,
    null_safe: Sequence[str] = (),
    default: int = 0,
    out: str | None = None,
    few_versions: int = FEW_VERSIONS,
) -> DataFrame:
    """Add the key of the version that was valid at ``at``; ``default`` where there is none.

    Where no member has more than ``few_versions`` versions, rows and versions are joined on the
    natural key with the range as a further condition. Beyond that, such a join would compare
    every row with every version of a hot member; then the distinct pairs of key and date are
    resolved by one common sort with the versions, and the rows look their pair up. Both give the
    same result. A row without a date has no version.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    out = out or tk
    most = dim.agg(F.max("version")).first()[0] or 0
    if most > few_versions:
        points = _resolved_points(df, dim, pairs, tk, at, null_safe)
        return resolve_key(
            df, points, [*pairs, at], "_tk", null_safe, default=default, unique=True, out=out
        )
    names = {left: f"_member_{i}" for i, left in enumerate(pairs)}
    members = dim.select(
        *[F.col(right).alias(names[left]) for left, right in pairs.items()],
        F.col("date_from").alias("_from"),
        F.col("date_to").alias("_to"),
        F.col(tk).alias("_tk"),
    )
    time = F.col(at).cast("timestamp")
    valid = (F.col("_from") <= time) & (time < F.col("_to"))
    joined = df.join(members, matches(names, null_safe) & valid, "left")
    found = F.coalesce("_tk", F.lit(default)).cast("bigint")
    return joined.withColumn(out, found).drop(*names.values(), "_from", "_to", "_tk")


def _resolved_points(
    df: DataFrame,
    dim: DataFrame,
    pairs: Mapping[str, str],
    tk: str,
    at: str,
    null_safe: Sequence[str],
) -> DataFrame:
    """The distinct pairs of key and date of ``df`` that have a version, with its ``_tk``.

    Sorted together with the versions, a pair belongs to the last version before it.
    """
    required = [c for c in pairs if c not in null_safe]
    points = drop_null_keys(df.select(*pairs, at), [*required, at]).distinct()
    nothing = F.lit(None).cast("bigint")
    rows = points.select(
        *pairs,
        F.col(at).cast("timestamp").alias("_time"),
        F.lit(1).alias("_kind"),
        nothing.alias("_tk"),
        F.lit(None).cast("timestamp").alias("_to"),
        F.col(at).alias("_at"),
    )
    versions = dim.select(
        *[F.col(right).alias(left) for left, right in pairs.items()],
        F.col("date_from").alias("_time"),
        F.lit(0).alias("_kind"),
        F.col(tk).cast("bigint").alias("_tk"),
        F.col("date_to").alias("_to"),
        F.lit(None).cast(points.schema[at].dataType).alias("_at"),
    )
    placed = _placed(versions.unionByName(rows), [*pairs, "_time", "_kind"], "points")
    version = F.when(F.col("_kind") == 0, F.struct(*pairs, "_tk", "_to"))
    place = F.when(F.col("_kind") == 0, F.col(_PLACE))
    lasts = placed.groupBy(_PART).agg(F.max_by(version, place).alias("_last"))
    carried = lasts.select(
        _PART, F.last("_last", ignorenulls=True).over(_parts_before()).alias("_before")
    )
    here = F.last(version, ignorenulls=True).over(_so_far())
    joined = _with_parts(placed.withColumn("_version", here), carried)
    joined = joined.withColumn("_version", F.coalesce("_version", "_before"))
    same = F.struct(*[F.col(f"_version.{c}").alias(c) for c in pairs]).eqNullSafe(F.struct(*pairs))
    valid = joined.where((F.col("_kind") == 1) & same & (F.col("_time") < F.col("_version._to")))
    found = valid.select(*pairs, F.col("_at").alias(at), F.col("_version._tk").alias("_tk"))
    return materialize(found, "resolved")
