"""Target-distribution importance resampling: draw the documents that look most like a target set.

An untrained ``tokenizers`` Split over the ASCII-lowered text gives words with their offsets.
Windows of 1 to ``ngrams`` consecutive offset pairs are the features; the CRC of a feature's words,
joined by one space, names its bucket. Each document's buckets are written once, in 16 bits each
where they fit. Three narrow steps follow: bucket histograms of the corpus and of the target
(summed in each task, so a task sends at most ``buckets`` counts), the gain of each bucket, and the
sum of gains per document. Gumbel noise from a hash of the id makes the highest scores a draw
without replacement in proportion to the documents' importance.

The highest scores are found by one range sort of ids and scores over all executors, which also
numbers them; texts do not move. What reaches the driver and goes back with the tasks is one number
per bucket, which is a parameter and does not grow with the data.

A text is split in segments of about ``SEGMENT`` characters, cut where no word is, because the
tokenizer keeps many bytes per character; windows go on across segments.

Defined cases: a null text has no words; an empty target gives every bucket the same smoothed
target count; documents without features weigh 0; a null id counts as the empty id in the hash and
is last among equal scores; repeated ids and rows get ranks of their own; an empty table gives an
empty result; other columns are not read by ``weights`` and all kept by ``draw``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from starload.llm.text import documents, whole_text
from starload.operators.keys import dense_key
from starload.tables import materialize

NGRAMS, BUCKETS = 1, 10_000
#: Documents of fewer words are not drawn; of the others, so many of 100 are.
MIN_WORDS, PERCENT = 20, 10
SEED = 2024
#: Characters that are in no word: those of ASCII other than lower-case letters and digits.
BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
SEGMENT = 1 << 16


def segments(text: str, limit: int = SEGMENT) -> Iterator[str]:
    """The text in pieces of about ``limit`` characters, cut beside a character of no word."""
    gap, low = re.compile(f"[{BETWEEN}]"), 0
    while len(text) - low > limit:
        cut = gap.search(text, low + limit)
        if cut is None:
            break
        yield text[low : cut.start()]
        low = cut.start()
    yield text[low:] if low else text


def feature_hasher(ngrams: int) -> Callable[[str], tuple[int, np.ndarray]]:
    """``hash(text) -> (words, CRCs of all runs of 1 to ngrams words)``."""
    from tokenizers import Regex, pre_tokenizers

    split = pre_tokenizers.Split(Regex(f"[{BETWEEN}]+"), behavior="removed").pre_tokenize_str

    def hashes(text: str) -> tuple[int, np.ndarray]:
        lowered = text.encode().lower().decode()  # of bytes, lower() changes A-Z only
        runs: list[list[int]] = [[] for _ in range(ngrams)]
        before: list[bytes] = []
        n = 0
        for segment in segments(lowered):
            words = [segment[low:high].encode() for _, (low, high) in split(segment)]
            n += len(words)
            runs[0] += map(crc32, words)
            if ngrams > 1:
                joined = before + words
                # A run that ends in this segment may begin in the ones before it.
                last = [crc32(word) for word in joined]
                for k in range(1, ngrams):
                    ends = joined[k:]
                    last = [crc32(b" " + word, crc) for crc, word in zip(last, ends)]
                    runs[k] += last[max(0, len(before) - k) :]
                before = joined[1 - ngrams :]
        return n, np.array([crc for run in runs for crc in run], "<u4")

    return hashes


def features(
    df: DataFrame, text_col: str, ngrams: int = NGRAMS, buckets: int = BUCKETS
) -> DataFrame:
    """The other columns of ``df`` and n_words, n_features, buckets (little-endian, packed)."""
    kept = [c for c in df.columns if c != text_col]
    own = ["n_words", "n_features", "buckets"]
    if set(own) & set(kept):
        raise ValueError(f"columns {own} are there already")
    schema = StructType(
        [df.schema[c] for c in kept]
        + [StructField(c, LongType()) for c in own[:2]]
        + [StructField(own[2], BinaryType())]
    )
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = feature_hasher(ngrams)
        for batch in batches:
            words, counts, packed = [], [], []
            for text in batch.column(len(kept)):
                n, found = hashes(text.as_py())
                words.append(n)
                counts.append(len(found))
                packed.append((found % buckets).astype(kind).tobytes())
            arrays = [pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *arrays], schema.names)

    rows = df.select(*kept, whole_text(text_col).alias("_text"))
    return rows.mapInArrow(run, schema)


def _kind(buckets: int) -> str:
    if not 0 < buckets <= 1 << 32:
        raise ValueError(f"buckets: {buckets}")
    return "<u2" if buckets <= 1 << 16 else "<u4"


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in the column ``buckets``; at most one row per bucket and task
    leaves a task."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "i8")
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_py(), kind), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    parts = found.select("buckets").mapInArrow(run, "bucket long, n long")
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, "i8")
    total[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target and corpus shares, rounded down."""
    buckets = len(corpus)
    s_all, t_all = int(corpus.sum()) + buckets, int(target.sum()) + buckets
    pairs = zip(corpus.tolist(), target.tolist())
    return np.array(
        [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], "i8"
    )


def _summed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(row, id, n_words, n_features, weight)."""
    kind = _kind(len(gain))
    names = ["row", "id", "n_words", "n_features"]
    schema = StructType([found.schema[c] for c in names] + [StructField("weight", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [
                int(gain[np.frombuffer(packed.as_py(), kind)].sum()) for packed in batch.column(4)
            ]
            arrays = [*batch.columns[:4], pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return found.select(*names, "buckets").mapInArrow(run, schema)


def _noise(doc_id: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the id's sha256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    share = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


def _ranked(
    rows: DataFrame, target: DataFrame, target_text: str, ngrams: int, buckets: int,
    min_words: int, percent: int, seed: int,
) -> DataFrame:
    """(row, id, n_features, weight, score, rank) of ``rows`` (row, id, text)."""
    if not 0 <= percent <= 100:
        raise ValueError(f"percent: {percent}, not in 0 .. 100")
    found = materialize(features(rows, "text", ngrams, buckets), "features")
    wanted = features(target.select(F.col(target_text).alias("text")), "text", ngrams, buckets)
    gain = gains(histogram(found, buckets), histogram(wanted, buckets))
    score = F.col("weight") + _noise("id", seed)
    scored = _summed(found, gain).withColumn("score", score)
    scored = materialize(scored.withColumn("open", F.col("n_words") >= min_words), "scored")
    drawn = scored.where("open").count() * percent // 100
    order = [F.desc("open"), F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    place = dense_key(scored, order, "place")
    return place.select(
        "row", "id", "n_features", "weight", "score",
        F.when(F.col("place") <= drawn, F.col("place")).alias("rank"),
    )


def weights(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of ``df``.

    ``rank`` counts the drawn documents from the highest score on and is null for the others:
    ``percent`` of 100 of the documents with at least ``min_words`` words, rounded down.
    """
    rows = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )
    found = _ranked(rows, target, target_text, ngrams, buckets, min_words, percent, seed)
    return found.drop("row").withColumnRenamed("id", id_col)


def draw(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """The drawn rows of ``df`` with all their columns. ``df`` is written once, with a number that
    tells its rows apart."""
    key = "_row"
    while key in df.columns:
        key = f"_{key}"
    saved = materialize(df.withColumn(key, F.monotonically_increasing_id()), "numbered")
    rows = saved.select(
        F.col(key).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    found = _ranked(rows, target, target_text, ngrams, buckets, min_words, percent, seed)
    chosen = materialize(found.where("rank is not null").select(F.col("row").alias(key)), "drawn")
    return saved.join(chosen, key, "left_semi").select(*df.columns)


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights(documents(spark, sf_dir), benchmark(spark, sf_dir))


QUERIES = {"op13_importance_resampling": op13_importance_resampling}
#: crc32 cannot be said in SQL; tested against a brute-force version.
TWINS: dict[str, str] = {}
