"""Sharding by longest-processing-time scheduling: groups that must stay together, sorted by size,
go to the least-loaded shard through a heap.

A group is all rows of one text; its size is the bytes of its rows. Groups of one size are
interchangeable, so the heap is fed with runs (size, how many) in falling order: a run's groups go
one by one to the least-loaded shard (of equal loads the lowest number), and a long run is
first dealt in whole levels, which gives each shard the same number of groups as one by one. The
loads equal those of scheduling every group singly. The groups are range-sorted by size over
all executors and numbered; a group's number within its run says which shard's share it is in.

What reaches the driver is one count per distinct group size, never a group. ``d`` distinct sizes
need at least ``d * (d + 1) / 2`` bytes of corpus, so ``d`` is below the root of twice the corpus
size: 245,000 at 30 GB, 14 million at 100 TB, at worst. The shares of the runs go back as a
written table. A group is never split, so one that outweighs an even share has a shard of its own
(that is the least possible maximum), and the rows of a hot group are spread over the tasks.

Defined cases: a null text counts as empty, and all empty texts are one group; a null id, repeated
ids and repeated rows are rows like any other, each with a slot of its own; an empty table gives
an empty result; with fewer groups than shards the last shards stay empty. Other columns of
the input are not read by ``assign``; ``with_shards`` keeps them all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.text import documents, whole_text
from starload.operators.keys import dense_key
from starload.tables import materialize

SHARDS = 24
#: Bytes of a row beside those of its text.
OVERHEAD = 8
#: The law that the sizes of the shards follow.
LAW = "bytes"

Run = tuple[int, int]
Share = tuple[int, list[int], list[int]]


def schedule(runs: Iterable[Run], shards: int = SHARDS) -> tuple[list[Share], list[int]]:
    """The shares of each run ``(size, count)`` and the load of each shard.

    A share ``(size, ends, owners)`` says that the run's groups up to ``ends[0]`` (exclusive,
    counted from 0) go to shard ``owners[0]``, the next ones up to ``ends[1]`` to ``owners[1]``, ...
    """
    heap = [(0, shard) for shard in range(shards)]
    shares = []
    for size, count in sorted(runs, reverse=True):
        taken: dict[int, int] = {}
        if size and count > 2 * shards:
            heap, taken = _levels(heap, size, count)
        for _ in range(count - sum(taken.values()) if size else 1):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            taken[shard] = taken.get(shard, 0) + 1
        if not size:  # weighs nothing: the least-loaded shard stays the least-loaded
            taken = {heap[0][1]: count}
        end, ends, owners = 0, [], []
        for shard in sorted(taken):
            end += taken[shard]
            ends.append(end)
            owners.append(shard)
        shares.append((size, ends, owners))
    return shares, [load for load, _ in sorted(heap, key=lambda entry: entry[1])]


def _levels(heap: list[Run], size: int, count: int) -> tuple[list[Run], dict[int, int]]:
    """Deal the groups that go to loads below the highest level that ``count`` of them reach.

    One by one, the groups go to loads in rising order, so all that go below a level come first.
    """
    low = heap[0][0]

    def below(levels: int) -> dict[int, int]:
        top = low + levels * size
        return {shard: -((load - top) // size) for load, shard in heap if load < top}

    enough, many = 0, count + 1
    while many - enough > 1:
        middle = (enough + many) // 2
        if sum(below(middle).values()) <= count:
            enough = middle
        else:
            many = middle
    taken = below(enough)
    dealt = [(load + size * taken.get(shard, 0), shard) for load, shard in heap]
    heapq.heapify(dealt)
    return dealt, taken


def _sha(text_col: str) -> Column:
    return F.unhex(F.sha2(whole_text(text_col), 256))


def _size(text_col: str, overhead: int) -> Column:
    return F.octet_length(whole_text(text_col)).cast("long") + F.lit(overhead)


def group_shards(rows: DataFrame, sha: str, size: str, shards: int = SHARDS) -> DataFrame:
    """(sha, shard) of every group of ``rows``, written."""
    spark = rows.sparkSession
    groups = materialize(rows.groupBy(sha).agg(F.sum(size).alias("_bytes")), "groups")
    counted = groups.groupBy("_bytes").agg(F.count(F.lit(1)).alias("n")).toArrow()
    shares, _ = schedule(zip(counted["_bytes"].to_pylist(), counted["n"].to_pylist()), shards)
    table = pa.table(
        {
            "_bytes": pa.array([s[0] for s in shares], pa.int64()),
            "_ends": pa.array([s[1] for s in shares], pa.list_(pa.int64())),
            "_owners": pa.array([s[2] for s in shares], pa.list_(pa.int32())),
        }
    )
    runs = materialize(spark.createDataFrame(table), "runs")
    # Numbered by rising size; the groups of a run then have consecutive numbers.
    numbered = dense_key(groups, ["_bytes", sha], "_number", start=0)
    firsts = materialize(numbered.groupBy("_bytes").agg(F.min("_number").alias("_first")), "firsts")
    runs = materialize(runs.join(firsts, "_bytes"), "shares")
    nth = F.col("_number") - F.col("_first")
    before = F.size(F.filter("_ends", lambda end: end <= nth))
    placed = numbered.join(runs, "_bytes").select(sha, F.get("_owners", before).alias("shard"))
    return materialize(placed, "placed")


def assign(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    overhead: int = OVERHEAD,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; ``slot`` counts a shard's rows from 0."""
    rows = materialize(
        df.select(
            F.col(id_col).alias("id"),
            _size(text_col, overhead).alias("size"),
            F.crc32(whole_text(text_col)).alias("crc"),
            _sha(text_col).alias("sha"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "rows",
    )
    placed = group_shards(rows, "sha", "size", shards)
    resolved = materialize(rows.join(placed, "sha").drop("sha"), "resolved")
    per_shard = dict(resolved.groupBy("shard").count().collect())
    before, total = [], 0
    for shard in range(shards):
        before.append(F.lit(total).cast("long"))
        total += per_shard.get(shard, 0)
    numbered = dense_key(resolved, ["shard", "row"], "place", start=0)
    return numbered.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("place") - F.get(F.array(*before), F.col("shard"))).alias("slot"),
    )


def with_shards(
    df: DataFrame,
    text_col: str = "text",
    shards: int = SHARDS,
    overhead: int = OVERHEAD,
    into: str = "shard",
) -> DataFrame:
    """All rows and columns of ``df`` and their shard in the column ``into``."""
    if into in df.columns:
        raise ValueError(f"there is a column {into} already")
    key = "_sha"
    while key in df.columns:
        key = f"_{key}"
    rows = df.withColumn(key, _sha(text_col))
    sizes = rows.select(key, _size(text_col, overhead).alias("size"))
    placed = group_shards(materialize(sizes.toDF("sha", "size"), "sizes"), "sha", "size", shards)
    return rows.join(placed.toDF(key, into), key).select(*df.columns, into)


def write_shards(
    df: DataFrame,
    folder: str,
    text_col: str = "text",
    shards: int = SHARDS,
    overhead: int = OVERHEAD,
    into: str = "shard",
) -> None:
    """Write ``df`` as one Parquet folder per shard (``shard=0`` ...).

    Several tasks write each shard, so that a shard is not limited to what one task can hold.
    """
    rows = with_shards(df, text_col, shards, overhead, into)
    tasks = int(df.sparkSession.sparkContext.defaultParallelism)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(max(1, tasks // shards)))
    dealt = rows.repartition(F.col(into), salt)
    dealt.write.partitionBy(into).parquet(folder)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assign(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op11_sharding": op11_sharding}
#: Neither a heap nor crc32 can be said in SQL; tested against single scheduling.
TWINS: dict[str, str] = {}
