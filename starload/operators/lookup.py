"""Natural key to surrogate key.

No join here carries a hint. The members joined against are read from files, so Spark knows their
size before it starts: it broadcasts those under ``spark.sql.autoBroadcastJoinThreshold`` and
leaves the rows where they are. Larger ones take a sort-merge join, and because a scan (not an
aggregate) feeds each side, adaptive execution can split the hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.text import norm_str
from starload.operators.dedupe import dedupe
from starload.tables import materialize


def resolve_key(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    tk: str,
    null_safe: Sequence[str] = (),
    on_miss: str = "default",
    default: int = 0,
    unique: bool = False,
    out: str | None = None,
    normalized: Sequence[str] = (),
    collation: str | None = None,
) -> DataFrame:
    """Add the key ``tk`` of the member of ``dim`` that matches.

    ``on``: shared names, or ``{column of df: column of dim}``. ``null_safe`` columns of ``df``
    match null with null. Several members with one natural key: the lowest ``tk`` wins
    (they are reduced and written once; ``unique=True`` promises that ``dim`` is a table without
    any and saves that). ``normalized`` columns of ``dim`` are brought to the form of ``norm_str``
    before they are compared; ``collation`` compares text columns by a collation of Spark ("UNICODE_CI"
    takes no notice of case, "UNICODE_CI_AI" of case and accents). ``on_miss``: "default" keeps the row with ``default``, "null" keeps it
    without a key, "drop" leaves it out.
    """
    if on_miss not in ("default", "null", "drop"):
        raise ValueError(f"on_miss: {on_miss}")
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    members, names = single_members(dim, pairs, tk, unique, normalized, collation)
    condition = matches(names, null_safe, collation)
    joined = df.join(members, condition, "inner" if on_miss == "drop" else "left")
    found = F.coalesce(F.col("_tk"), F.lit(default)) if on_miss == "default" else F.col("_tk")
    return joined.withColumn(out or tk, found.cast("bigint")).drop(*names.values(), "_tk")


def single_members(
    dim: DataFrame,
    pairs: Mapping[str, str],
    tk: str,
    unique: bool,
    normalized: Sequence[str],
    collation: str | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """The members with one ``_tk`` per natural key, and what the columns of ``pairs`` are called."""
    names = {left: f"_member_{i}" for i, left in enumerate(pairs)}
    members = dim.select(
        *[
            (norm_str(right) if right in normalized else F.col(right)).alias(names[left])
            for left, right in pairs.items()
        ],
        F.col(tk).alias("_tk"),
    )
    if collation:
        members = materialize(
            dedupe(members, list(names.values()), ["_tk"], collation=collation), "members"
        )
    elif not unique or normalized:
        members = materialize(
            members.groupBy(*names.values()).agg(F.min("_tk").alias("_tk")), "members"
        )
    return members, names


def matches(
    names: Mapping[str, str], null_safe: Sequence[str] = (), collation: str | None = None
) -> Column:
    """The join condition of these pairs of columns; null meets null in those of ``null_safe``."""

    def side(name: str) -> Column:
        return F.collate(F.col(name), collation) if collation else F.col(name)

    condition = F.lit(True)
    for left, right in names.items():
        if left in null_safe:
            condition &= side(left).eqNullSafe(side(right))
        else:
            condition &= side(left) == side(right)
    return condition


def fk_first_match(
    df: DataFrame,
    parent: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    id: str = "id",
    fk: str = "fk",
    on_miss: str = "null",
) -> DataFrame:
    """Foreign key of the first (lowest id) parent row that matches."""
    return resolve_key(df, parent, on, id, on_miss=on_miss, out=fk)
