"""Small tables with the edge rows that every operator has to take."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark: SparkSession, texts, sources=None) -> DataFrame:
    """Documents 0, 1, ... with these texts; pairs give their own id."""
    rows = []
    for i, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (i, t)
        source = sources[len(rows)] if sources else "s"
        rows.append((i, t, "en", source, len(t) if t is not None else None))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(df: DataFrame) -> DataFrame:
    """Further columns named like those the operators make for themselves."""
    from pyspark.sql import functions as F

    names = "sha key fp id row size n kept piece start length _row _sha _rank root u v s bits block"
    names += " _language _train _toxic _gone _copy _p _place _number shard slot weight score rank"
    return df.select("*", *[F.lit("x").alias(n) for n in names.split()])


EDGES = [
    None,
    "",
    " \t\n",
    "a",
    "A",
    "word " * 30_000,
    "x" * 100_000,
    "naïve café \U0001f600 日本語のテキスト",
    "the same text twice over and over",
    "the same text twice over and over",
    (8, "the same text twice over and over"),
    (None, "a row without an id"),
    (None, None),
    "a\x00b c\x1cd \x85e",
]
