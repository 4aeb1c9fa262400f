"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starload.operators.copies import CHUNK, expand_copies
from starload.tables import materialize

# monotonically_increasing_id() holds the partition number above bit 33 and the row's place
# in its partition below.
_PLACE_BITS = 33
_PLACE = "_place"


def dense_key(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str,
    start: int = 1,
    step: int = 1,
    ties: Sequence[str | Column] = (),
    maximum: int | None = None,
    label: str | None = None,
) -> DataFrame:
    """Number the rows ``start, start + step, ...`` in the order of ``order`` then ``ties``.

    One range-partitioned sort places every row; the placed rows are written once, the row
    count of each partition is read back, and the key is the partition's offset plus the place.
    The offsets (one number per partition) are a constant in the plan, so the result is a plain
    projection of a scan. ``order`` plus ``ties`` should tell rows apart: the range bounds are
    cut over all of them, which also splits a hot value of ``order``. Use ``dense_key_bag``
    where whole rows repeat. Above ``maximum`` it raises. The sort samples ``df`` before it reads
    it, so write an input first that is costly to compute.
    """
    return placed_key(df.orderBy(*order, *ties), name, start, step, maximum, label)


def placed_key(
    df: DataFrame,
    name: str,
    start: int = 1,
    step: int = 1,
    maximum: int | None = None,
    label: str | None = None,
) -> DataFrame:
    """Number the rows of ``df`` in the order they already have (that of a sorted output)."""
    placed = df.withColumn(_PLACE, F.monotonically_increasing_id())
    saved = materialize(placed, label or name)
    part = F.shiftright(_PLACE, _PLACE_BITS).cast("int")
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    sizes = saved.groupBy(part.alias("part")).count().collect()
    offsets, total = _offsets({r["part"]: r["count"] for r in sizes})
    _check_maximum(start + (total - 1) * step, maximum)
    key = F.lit(start).cast("bigint") + (F.get(offsets, part) + place) * F.lit(step)
    return saved.withColumn(name, key).drop(_PLACE)


def dense_key_bag(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    start: int = 1,
    chunk: int = CHUNK,
    maximum: int | None = None,
) -> DataFrame:
    """``dense_key`` for rows that may repeat in every column, however often.

    Equal rows are counted first (map-side), the distinct rows are placed, and each takes as
    many keys as it has copies. Copies are written out in chunks spread over the cluster.
    """
    columns = df.columns
    rest = [c for c in columns if c not in order]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    placed = counted.orderBy(*order, *rest).withColumn(_PLACE, F.monotonically_increasing_id())
    saved = materialize(placed, name)
    part = F.shiftright(_PLACE, _PLACE_BITS).cast("int")
    sizes = saved.groupBy(part.alias("part")).agg(F.sum("_copies").alias("rows")).collect()
    offsets, total = _offsets({r["part"]: r["rows"] for r in sizes})
    _check_maximum(start + total - 1, maximum)
    before = Window.partitionBy("_part").orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    first = F.get(offsets, F.col("_part")) + F.coalesce(F.sum("_copies").over(before), F.lit(0))
    numbered = saved.withColumn("_part", part).withColumn("_first", first + F.lit(start))
    copies = expand_copies(numbered, "_copies", "_copy", chunk)
    return copies.select(*columns, (F.col("_first") + F.col("_copy")).alias(name))


def _offsets(sizes: dict[int, int]) -> tuple[Column, int]:
    """Rows before each partition, as one array constant, and the total."""
    before, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        before.append(str(total))
        total += sizes.get(part, 0)
    return F.split(F.lit(",".join(before) or "0"), ",").cast("array<bigint>"), total


def _check_maximum(last: int, maximum: int | None) -> None:
    if maximum is not None and last > maximum:
        raise OverflowError(f"the last key would be {last}, above {maximum}")


def next_key(df: DataFrame, tk: str) -> DataFrame:
    """One row, ``max_key``: the highest key in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(tk), F.lit(0)).cast("bigint").alias("max_key"))


def max_key(df: DataFrame, tk: str) -> int:
    return next_key(df, tk).first()["max_key"]


def append_keys(
    existing: DataFrame,
    new_rows: DataFrame,
    order: Sequence[str | Column],
    tk: str,
    ties: Sequence[str | Column] = (),
) -> DataFrame:
    """Number ``new_rows`` on from the highest key of ``existing``; returns only the new rows."""
    return dense_key(new_rows, order, tk, start=max_key(existing, tk) + 1, ties=ties)
