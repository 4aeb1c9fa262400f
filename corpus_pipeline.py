"""From raw documents to packed sequences; each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.exact_dedup import drop_exact_copies
from starload.llm.language import UNKNOWN, identify, train
from starload.llm.mixing import mix
from starload.llm.packing import pack
from starload.llm.simhash import keep_one_per_group
from starload.llm.text import documents, fold
from starload.tables import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language and those whose language is ambiguous."""
    model = train(docs.where(fold("doc_id", 4) != 2))
    into = "_language"
    while into in docs.columns:
        into = f"_{into}"
    found = identify(docs, model, into=into)
    clear = (F.col(f"{into}.lang_pred") != UNKNOWN) & ~F.col(f"{into}.ambiguous")
    return found.where(clear).drop(into)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Language classifiers, fingerprint groups and tokenizers cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
