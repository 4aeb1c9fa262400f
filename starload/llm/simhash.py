"""SimHash near-dedup with the pigeonring filter.

A fingerprint is cut into ``d + 1`` segments in a ring, ``d`` being the most bits that may differ.
If two fingerprints differ in at most ``d`` bits, some segment starts a chain whose first
``l`` segments differ in at most ``floor(l * d / (d + 1))`` bits, for every ``l``: so the first is
equal, the first two differ in at most one bit, the first three in two, and so on. The first two
links of the chain are the join key (one side lists the second segment with each single bit
flipped); the longer chains are checked on the candidates, then the whole Hamming distance.

Only distinct fingerprints are joined. A key with more than ``HEAVY`` fingerprints (a dense group
of near copies) is cut into blocks; a task compares one block with another in memory and returns
at most one edge per fingerprint, which keeps the group connected without listing its pairs.

Defined cases: a null, empty or blank text has fingerprint zero and links like any other; equal
texts link at distance 0; a row without id takes part, and a group's id is its smallest non-null
id (null if it has none); rows that repeat are returned as often. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starload.llm.components import components
from starload.llm.text import documents, whole_text
from starload.tables import materialize

SHINGLE = 4
DISTANCE = 4
BITS = 64
HEAVY = 64
#: Fingerprints on either side of one in-memory comparison.
BLOCK = 1024


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hash64 = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist())
        hashes = np.array([hash64(joined[a:b], 42) for a, b in spans], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(starts))
    return int(bits.view(">i8")[0])


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(id, fp) for every row."""
    id_field = StructField(id_col, df.schema[id_col].dataType)
    out = StructType([id_field, StructField("fp", LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64())], names=[id_col, "fp"]
            )

    return df.select(id_col, whole_text(text_col).alias("text")).mapInArrow(hashed, out)


def _segments(distance: int) -> list[int]:
    count = distance + 1
    return [BITS * (i + 1) // count - BITS * i // count for i in range(count)]


def _rotated(fp: Column, by: int) -> Column:
    if by == 0:
        return fp
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def _signed(mask: int) -> int:
    mask &= (1 << BITS) - 1
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _keys(fp: Column, distance: int, flips: bool) -> list[Column]:
    """One key per start of a chain; with ``flips``, each with every single bit of the second
    segment flipped as well. The start is held above bit 56."""
    widths, offset, keys = _segments(distance), 0, []
    for start, width in enumerate(widths):
        second = widths[(start + 1) % len(widths)] if distance else 0
        used = min(width + second, 56)
        second = used - width
        base = F.shiftrightunsigned(_rotated(fp, offset), BITS - used).bitwiseOR(
            F.lit(start << 56)
        )
        keys.append(base)
        if flips:
            keys += [base.bitwiseXOR(F.lit(1 << bit)) for bit in range(second)]
        offset += width
    return keys


def _chains(differ: Column, key: Column, distance: int) -> Column:
    """The longer chains from the key's start stay within their budgets, and so does the whole."""
    widths, offset = _segments(distance), 0
    start = F.shiftrightunsigned(key, 56)
    ok = F.bit_count(differ) <= distance
    for first, width in enumerate(widths):
        within = F.lit(True)
        for length in range(3, distance + 1):
            span = sum(widths[(first + i) % len(widths)] for i in range(length))
            mask = ((1 << span) - 1) << (BITS - span)
            mask = (mask >> offset) | (mask << (BITS - offset))
            within &= F.bit_count(differ.bitwiseAND(F.lit(_signed(mask)))) <= length - 1
        ok &= (start != first) | within
        offset += width
    return ok


def _tied(block: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Edges that connect what links between the two sides of a block."""
    left = block.loc[block["side"] == 0, "fp"].drop_duplicates().to_numpy(np.int64)
    right = block.loc[block["side"] == 1, "fp"].drop_duplicates().to_numpy(np.int64)
    differ = left[:, None].view(np.uint64) ^ right[None, :].view(np.uint64)
    near = np.bitwise_count(differ) <= distance
    top = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        lower_a = np.minimum(a, np.where(near, b[None, :], top).min(1, initial=top))
        lower_b = np.minimum(b, np.where(near, lower_a[:, None], top).min(0, initial=top))
        if (lower_a == a).all() and (lower_b == b).all():
            break
        a, b = lower_a, lower_b
    edges = pd.DataFrame({"u": np.r_[left, right], "v": np.r_[a, b]})
    return edges[edges["u"] != edges["v"]].drop_duplicates()


def links(distinct: DataFrame, distance: int = DISTANCE, heavy: int = HEAVY) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints ``fp`` that connect all those within
    ``distance`` bits of each other. Light keys give every link, heavy ones a spanning set.

    Spark sizes what ``explode`` makes by the fingerprints before it, so it would broadcast all
    keys of a middling table; the join of the keys asks for a merge."""
    if distance == 0:
        return distinct.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    fp = F.col("fp")
    index = distinct.select(F.explode(F.array(*_keys(fp, distance, False))).alias("key"), "fp")
    probe = distinct.select(F.explode(F.array(*_keys(fp, distance, True))).alias("key"), "fp")
    dense = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy)
    dense = materialize(dense, "dense")
    a, b = F.col("a"), F.col("b")
    light = (
        index.join(dense, "key", "left_anti")
        .withColumnRenamed("fp", "a")
        .join(probe.withColumnRenamed("fp", "b").hint("merge"), "key")
        .where((a < b) & _chains(a.bitwiseXOR(b), F.col("key"), distance))
        .select(a.alias("u"), b.alias("v"))
    )
    light = materialize(light, "links")

    cut = materialize(probe.join(dense, "key"), "probes")
    sizes = materialize(
        cut.groupBy("key", "n").agg(F.count(F.lit(1)).alias("m")).select(
            "key",
            F.ceil(F.col("n") / BLOCK).cast("int").alias("n"),
            F.ceil(F.col("m") / BLOCK).cast("int").alias("m"),
        ),
        "sizes",
    )

    def sided(rows: DataFrame, side: int, own: str, other: str) -> DataFrame:
        at, each = (("i", "j"), ("j", "i"))[side]
        blocks = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return rows.select("key", "fp").join(sizes, "key").select(
            "key",
            "fp",
            F.lit(side).alias("side"),
            F.pmod(F.xxhash64("fp", F.lit(side)), F.col(own)).cast("int").alias(at),
            blocks.alias(each),
        )

    inside = index.join(dense.select("key"), "key", "left_semi")
    blocks = sided(inside, 0, "n", "m").unionByName(sided(cut, 1, "m", "n"))
    tied = blocks.groupBy("key", "i", "j").applyInPandas(
        lambda block: _tied(block, distance), "u long, v long"
    )
    return light.unionByName(tied)


def near_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row per row of ``df``: id, ``fp``, ``component_id`` (the group's smallest id)."""
    fps = materialize(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("low")), "nodes")
    roots = components(links(nodes.select("fp"), distance).select("u", "v"))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    placed = materialize(placed, "placed")
    lowest = materialize(placed.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = materialize(placed.join(lowest, "root").select("fp", "component_id"), "named")
    return fps.join(named, "fp").select(id_col, "fp", "component_id")


def keep_one_per_group(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """The rows of ``df`` that stay: of each group the document with the smallest id.

    The ids that go are few against the texts; the texts are not shuffled where Spark may
    broadcast them. Rows without id cannot lead a group or be named, and stay. Rows that share an
    id are one document: they stay if it leads one of its groups.
    """
    spread = near_groups(df, id_col, text_col, shingle, distance)
    ids = F.col(id_col)
    leads = F.max(ids == F.col("component_id")).alias("leads")
    gone = spread.where(ids.isNotNull()).groupBy(id_col).agg(leads).where("not leads")
    gone = materialize(gone.select(F.col(id_col).alias("_gone")), "gone")
    return df.join(gone, df[id_col] == gone["_gone"], "left_anti")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES = {"op4_simhash_near_dedup": op4_simhash_near_dedup}
TWINS: dict[str, str] = {}
