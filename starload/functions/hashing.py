"""Pseudo-random values that depend only on a seed and the row's key.

A lost task recomputes the same values, which ``rand()`` does not promise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starload.functions.text import ColumnLike, as_column


#: Hex digits of a hash that fit a bigint without its sign.
DIGITS = 15


def seeded_hash(key: Sequence[ColumnLike], seed: int | str) -> Column:
    """32 hex digits, uniform over distinct keys.

    Of a key of several columns each part is marked as null or headed by its length, so that
    (1, null) and (null, 1), or parts with colons, stay apart.
    """
    parts = [as_column(c).cast("string") for c in key]
    if len(parts) > 1:
        parts = [
            F.coalesce(F.concat(F.length(p).cast("string"), F.lit("="), p), F.lit("null"))
            for p in parts
        ]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def hash_number(key: Sequence[ColumnLike], seed: int | str) -> Column:
    """Bigint in ``0 .. 16 ** DIGITS - 1``, uniform over distinct keys."""
    return F.conv(F.substring(seeded_hash(key, seed), 1, DIGITS), 16, 10).cast("bigint")


def seeded_int(key: Sequence[ColumnLike], n: int, seed: int | str, low: int = 0) -> Column:
    """Bigint in ``low .. low + n - 1``."""
    if not 0 < n <= 16**DIGITS:
        raise ValueError(f"n: {n}, not in 1 .. 16 ** {DIGITS}")
    return hash_number(key, seed) % F.lit(n).cast("bigint") + F.lit(low).cast("bigint")
