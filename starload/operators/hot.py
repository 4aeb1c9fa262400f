"""Lookups where a few natural keys hold a large part of all rows.

The hot keys are found by a frequent-items sketch in one pass. Their rows stay where they are and
meet their few members by broadcast; the rows of all other keys are joined as usual, so no task of
that join has a hot key; rows without a key are not joined at all. What the sketch estimates only
decides which way a row takes, never what it finds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.lookup import matches, single_members

#: A key is hot from this share of all rows on.
HOT_SHARE = 0.01
#: Items the sketch keeps for each one that may be hot; its error is below a share of 1 / (100 x).
_SPARE = 40


def hot_hashes(df: DataFrame, columns: Sequence[str | Column], share: float) -> list[int]:
    """Hashes of the values of ``columns`` that hold at least about ``share`` of the rows.

    At most ``1 / share`` values can; nothing else reaches the driver.
    """
    if not 0.0001 <= share <= 1:
        raise ValueError(f"share: {share}, not in 0.0001 .. 1")
    most = ceil(1 / share)
    hashed = df.select(F.xxhash64(*columns).alias("_h"))
    found = hashed.agg(
        F.expr(f"approx_top_k(_h, {most}, {min(_SPARE * most, 1_000_000)})").alias("top"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    least = share * found["n"]
    return sorted(r["item"] for r in found["top"] or [] if r["count"] >= max(least, 2))


def resolve_hot_key(
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
    share: float = HOT_SHARE,
) -> DataFrame:
    """``resolve_key`` (same rows, same keys) for rows with hot keys.

    ``df`` is read once by the sketch and once by each branch, so write an input first that is
    costly to compute. At most ``1 / share`` members are broadcast. Both sides of a pair must be of
    one type that is not a floating-point one, because their hashes are compared.
    """
    if on_miss not in ("default", "null", "drop"):
        raise ValueError(f"on_miss: {on_miss}")
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    types, others = dict(df.dtypes), dict(dim.dtypes)
    for left, right in pairs.items():
        if types[left] != others[right] or types[left] in ("float", "double"):
            raise ValueError(f"{left} is {types[left]}, {right} is {others[right]}")
    members, names = single_members(dim, pairs, tk, unique, normalized)
    out = out or tk

    has_key = F.lit(True)
    for c in pairs:
        if c not in null_safe:
            has_key &= F.col(c).isNotNull()
    hot = hot_hashes(df.where(has_key), list(pairs), share)

    def is_hot(columns: Sequence[str]) -> Column:
        return F.xxhash64(*columns).isin(hot) if hot else F.lit(False)

    def found(rows: DataFrame, side: DataFrame) -> DataFrame:
        kind = "inner" if on_miss == "drop" else "left"
        return rows.join(side, matches(names, null_safe), kind).drop(*names.values())

    rest = members.where(~is_hot(list(names.values())))
    branches = [found(df.where(has_key & ~is_hot(list(pairs))), rest)]
    if hot:
        few = F.broadcast(members.where(is_hot(list(names.values()))))
        branches.append(found(df.where(has_key & is_hot(list(pairs))), few))
    if on_miss != "drop" and len(null_safe) < len(pairs):
        branches.append(df.where(~has_key).withColumn("_tk", F.lit(None).cast("bigint")))
    rows = branches[0]
    for branch in branches[1:]:
        rows = rows.unionByName(branch)
    value = F.coalesce(F.col("_tk"), F.lit(default)) if on_miss == "default" else F.col("_tk")
    return rows.withColumn(out, value.cast("bigint")).drop("_tk")
