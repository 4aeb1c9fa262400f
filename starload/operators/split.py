"""Seeded split of a table into a sample and the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.hashing import DIGITS, hash_number, seeded_hash
from starload.operators.copies import expand_copies
from starload.tables import materialize

#: Hex digits by which one histogram refines the cut: at most 65536 counts reach the driver.
_REFINE = 4


def split_hash(
    df: DataFrame, key: Sequence[str], fraction: float, seed: int | str
) -> tuple[DataFrame, DataFrame]:
    """(sample, rest) by a cut on the key's hash: no job, no shuffle, near ``fraction``."""
    _check(fraction)
    cut = round(fraction * 16**DIGITS)
    if cut == 16**DIGITS:
        return df, df.where(F.lit(False))
    number = hash_number(key, seed)
    return df.where(number < F.lit(cut)), df.where(number >= F.lit(cut))


def _check(fraction: float) -> None:
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction: {fraction}, not in 0 .. 1")


def split_exact(
    df: DataFrame, key: Sequence[str], fraction: float, seed: int | str
) -> tuple[DataFrame, DataFrame]:
    """(sample, rest) where the sample has exactly ``round(fraction * n)`` rows.

    The sample is the rows with the lowest hash of ``key``, which must tell rows apart. The hashes
    are written once; histograms of their prefixes (at most 65536 counts each) refine the cut
    until it falls between two counts. Both halves are plain filters of ``df``, so write an input
    that is costly to compute first (``clean_to_halves`` does).
    """
    _check(fraction)
    digest = seeded_hash(key, seed)
    hashes = materialize(df.select(digest.alias("h")), "hashes")
    prefix, need, total = "", None, None
    while True:
        length = len(prefix) + _REFINE
        if length > 32:
            raise ValueError(f"{list(key)} does not tell the rows apart")
        counts = (
            hashes.where(F.col("h").startswith(prefix))
            .groupBy(F.substring("h", 1, length).alias("p"))
            .count()
            .collect()
        )
        if need is None:
            total = sum(r["count"] for r in counts)
            need = round(fraction * total)
            if need == 0 or need == total:
                return df.where(F.lit(need > 0)), df.where(F.lit(need == 0))
        for row in sorted(counts, key=lambda r: r["p"]):
            prefix = row["p"]
            if need <= row["count"]:
                break
            need -= row["count"]
        if need == row["count"]:
            head = F.substring(digest, 1, length)
            return df.where(head <= prefix), df.where(head > prefix)


def split_exact_bag(
    df: DataFrame, fraction: float, seed: int | str
) -> tuple[DataFrame, DataFrame]:
    """``split_exact`` for rows that may repeat in every column, however often.

    Equal rows are counted first (map-side) and the counts are written; the cut runs through the
    hashes of the distinct rows, weighted by their copies, and divides the copies of the row it
    meets. Both halves write their copies in chunks over the cluster.
    """
    _check(fraction)
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    saved = materialize(counted.withColumn("_h", seeded_hash(columns, seed)), "counted")
    taken = _taken_copies(saved, fraction)
    if isinstance(taken, bool):
        return df.where(F.lit(taken)), df.where(F.lit(not taken))
    parts = saved.withColumn("_taken", taken).withColumn("_left", F.col("_copies") - F.col("_taken"))
    sample, rest = (expand_copies(parts, c, "_copy").select(*columns) for c in ("_taken", "_left"))
    return sample, rest


def _taken_copies(saved: DataFrame, fraction: float) -> Column | bool:
    """How many copies of a row are in the sample: all below the cut, none above it. Or whether all
    rows are, where all or none are."""
    all_copies, none = F.col("_copies"), F.lit(0).cast("bigint")
    prefix, need = "", None
    while True:
        length = len(prefix) + _REFINE
        if length > 32:
            raise ValueError("two different rows have one hash")
        groups = (
            saved.where(F.col("_h").startswith(prefix))
            .groupBy(F.substring("_h", 1, length).alias("p"))
            .agg(F.sum("_copies").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("_h").alias("h"))
            .collect()
        )
        if need is None:
            total = sum(g["n"] for g in groups)
            need = round(fraction * total)
            if need == 0 or need == total:
                return need > 0
        for group in sorted(groups, key=lambda g: g["p"]):
            prefix = group["p"]
            if need <= group["n"]:
                break
            need -= group["n"]
        if need == group["n"]:
            return F.when(F.substring("_h", 1, length) <= prefix, all_copies).otherwise(none)
        if group["rows"] == 1:
            cut = F.lit(group["h"])
            here = F.when(F.col("_h") == cut, F.lit(need).cast("bigint")).otherwise(none)
            return F.when(F.col("_h") < cut, all_copies).otherwise(here)


def complement(df: DataFrame, sample: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``sample``."""
    return df.join(sample.select(*key), list(key), "left_anti")
