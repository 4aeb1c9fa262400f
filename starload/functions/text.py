"""Text normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_str(c: ColumnLike, chars: str | None = None) -> Column:
    """Trim and upper-case. Only spaces are trimmed unless ``chars`` names more."""
    c = as_column(c)
    return F.upper(F.trim(c) if chars is None else F.btrim(c, F.lit(chars)))


def tidy_text(
    c: ColumnLike,
    trim: str | None = "both",
    case: str | None = "upper",
    initcap: bool = False,
    pad: str | None = None,
    pad_char: str = " ",
    pad_length: int = 0,
    digits: str | None = None,
) -> Column:
    """String step with the usual switches.

    ``trim``: both, left, right. ``case``: upper, lower. ``pad``: left, right.
    ``digits``: only (keep digits), remove (drop digits).
    """
    c = as_column(c)
    if trim is not None:
        c = {"both": F.trim, "left": F.ltrim, "right": F.rtrim}[trim](c)
    if case is not None:
        c = {"upper": F.upper, "lower": F.lower}[case](c)
    if pad is not None:
        padded = {"left": F.lpad, "right": F.rpad}[pad](c, pad_length, pad_char)
        # lpad and rpad cut longer text, a padding step must not.
        c = F.when(F.length(c) < pad_length, padded).otherwise(c)
    if initcap:
        c = F.initcap(c)
    if digits is not None:
        c = F.regexp_replace(c, {"only": "[^0-9]", "remove": "[0-9]"}[digits], "")
    return c


def replace_text(
    c: ColumnLike,
    pattern: str,
    by: str,
    regex: bool = True,
    ignore_case: bool = False,
    whole_word: bool = False,
) -> Column:
    """Replace every match of ``pattern``; an empty pattern leaves the text alone."""
    c = as_column(c)
    if pattern == "":
        return c
    if not regex and not ignore_case and not whole_word:
        return F.replace(c, F.lit(pattern), F.lit(by))
    expression = pattern if regex else re.escape(pattern)
    if whole_word:
        expression = rf"\b(?:{expression})\b"
    if ignore_case:
        expression = f"(?i){expression}"
    if not regex:
        by = by.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(c, expression, by)
