"""Dates and durations. Durations are whole hours everywhere."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starload.functions.text import ColumnLike, as_column

# The timestamp format of the raw declarations and the plain date format.
ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_DATE = "yyyy-MM-dd"


def parse_timestamp(c: ColumnLike, formats: Sequence[str] = (ISO_TIMESTAMP, ISO_DATE)) -> Column:
    """First format that fits; null where none does. Without a zone, so that the clock changes
    of the session's zone do not shorten or lengthen a day."""
    c = as_column(c)
    return F.coalesce(*[_try_format(c, f) for f in formats]).cast("timestamp_ntz")


# Pattern fields that stand for as many digits as they have letters.
_DIGITS = {"yyyy", "MM", "dd", "HH", "mm", "ss"}


def _try_format(c: Column, format: str) -> Column:
    """Parse, but only text of the right shape: a failed parse costs some twenty good ones."""
    parsed = F.try_to_timestamp(c, F.lit(format))
    shape = _shape(format)
    return parsed if shape is None else F.when(c.like(shape), parsed)


def _shape(format: str) -> str | None:
    """LIKE pattern of the text a format reads; None if its width is not fixed."""
    pieces = format.split("'")
    plain, quoted = pieces[::2], pieces[1::2]
    fields = [m[0] for piece in plain for m in re.finditer(r"([A-Za-z])\1*", piece)]
    if not set(fields) <= _DIGITS or "" in quoted or re.search(r"[%_\\\[\]]", format):
        return None
    pieces[::2] = [re.sub("[A-Za-z]", "_", piece) for piece in plain]
    return "".join(pieces)


def parse_date(c: ColumnLike, formats: Sequence[str] = (ISO_TIMESTAMP, ISO_DATE)) -> Column:
    return parse_timestamp(c, formats).cast("date")


def iso_date(c: ColumnLike, formats: Sequence[str] = (ISO_TIMESTAMP,)) -> Column:
    """Text to ``yyyy-MM-dd`` text; null where it is no date."""
    return F.date_format(parse_timestamp(c, formats), ISO_DATE)


def calendar_days(begin: ColumnLike, end: ColumnLike) -> Column:
    """Number of midnights between the two."""
    return F.datediff(as_column(end), as_column(begin))


def elapsed_days(begin: ColumnLike, end: ColumnLike) -> Column:
    """Number of whole 24 h periods between the two, rounded down."""
    span = as_column(end) - as_column(begin)
    seconds = span.cast("interval second").cast("decimal(20,6)")
    return F.floor(seconds / 86400).cast("bigint")


def duration_hours(begin: ColumnLike, end: ColumnLike, given: ColumnLike | None = None) -> Column:
    """``given`` if known, else the calendar days in hours."""
    computed = calendar_days(begin, end) * 24
    return computed if given is None else F.coalesce(as_column(given), computed)


def duration_elapsed(begin: ColumnLike, end: ColumnLike) -> Column:
    return elapsed_days(begin, end) * 24
