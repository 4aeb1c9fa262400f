"""Column functions; all of them are compositions of Spark built-ins."""

from starload.functions.dates import duration_elapsed, duration_hours, iso_date, parse_date
from starload.functions.hashing import seeded_hash, seeded_int
from starload.functions.text import norm_str, replace_text, tidy_text

__all__ = [
    "duration_elapsed",
    "duration_hours",
    "iso_date",
    "norm_str",
    "parse_date",
    "replace_text",
    "seeded_hash",
    "seeded_int",
    "tidy_text",
]
