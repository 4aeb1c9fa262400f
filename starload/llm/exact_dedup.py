"""Exact dedup: a two-pass Bloom filter finds possibly repeated hashes; only those rows shuffle.

Pass 1 hashes each row to two places in one block of a blocked Bloom filter and counts the places
(narrow, map-side combined). The filter keeps the places that were hit at least twice. Pass 2
probes every row: a row with a place hit only once has no equal and passes straight through; the
others shuffle by their full SHA-256, so false positives cost traffic but never a wrong result.

The filter has ``bits_per_row`` bits for each row, up to ``max_bits`` (16 MB by default), which
bounds what is broadcast. Beyond that bound more rows shuffle; the result stays the same.

Defined cases: a null text counts as empty, all empty and all-blank texts are equal; of equal rows
a null id loses to any id; rows that repeat with their id are one group of which one row stays.
Ids may be of any type that can be ordered. An empty table gives an empty result. Other columns of
the input are not touched or read.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.text import BLANKS, documents, whole_text
from starload.tables import materialize

#: Bits of one block: what bitmap_construct_agg packs into one value.
BLOCK = 1 << 15
BITS_PER_ROW = 16
MAX_BITS = 1 << 27


def squeezed(text: str | Column) -> Column:
    """The text without any blank."""
    return F.translate(whole_text(text), BLANKS, "")


def _block(sha: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(sha, F.lit(0)), F.lit(blocks))


def _places(sha: Column) -> list[Column]:
    """Two places in the row's block, counted from 1."""
    return [F.pmod(F.xxhash64(sha, F.lit(j)), F.lit(BLOCK)) + 1 for j in (1, 2)]


def repeated_filter(
    hashes: DataFrame, sha: str, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS
) -> tuple[DataFrame, int]:
    """(block, bits): the places hit at least twice, and the number of blocks."""
    rows = hashes.count()
    blocks = 1
    while blocks * BLOCK < min(rows * bits_per_row, max_bits):
        blocks *= 2
    block = _block(F.col(sha), blocks)
    spots = hashes.select(block.alias("block"), F.explode(F.array(*_places(F.col(sha)))).alias("p"))
    often = spots.groupBy("block", "p").count().where("count > 1")
    packed = often.groupBy("block").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    return materialize(packed, "bloom"), blocks


def maybe_repeated(rows: DataFrame, sha: str, bloom: DataFrame, blocks: int, name: str) -> DataFrame:
    """``rows`` with the flag ``name``: false means that no other row has this hash.

    ``bloom`` has at most ``max_bits / 8`` bytes, so it may be broadcast.
    """

    first, second = _places(F.col(sha))
    probe = rows.withColumn("_block", _block(F.col(sha), blocks))
    joined = probe.join(
        F.broadcast(bloom.toDF("_block", "_bits")), "_block", "left"
    )

    def is_set(place: Column) -> Column:
        at = place - 1
        byte = F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        return F.bit_get(value, (at % 8).cast("int")) == 1

    flag = F.coalesce(is_set(first) & is_set(second), F.lit(False))
    return joined.withColumn(name, flag).drop("_block", "_bits")


def exact_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = BITS_PER_ROW,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``df``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    The row with the most characters stays, then the one with the smallest id.
    """
    text = whole_text(text_col)
    hashes = materialize(
        df.select(
            F.col(id_col).alias("id"),
            F.sha2(squeezed(text), 256).alias("sha"),
            F.char_length(text).cast("long").alias("n"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "hashes",
    )
    bloom, blocks = repeated_filter(hashes, "sha", bits_per_row, max_bits)
    flagged = maybe_repeated(hashes, "sha", bloom, blocks, "maybe")
    order = F.struct(-F.col("n"), F.col("id").isNull(), "id", "row")
    groups = (
        flagged.where("maybe")
        .groupBy("sha")
        .agg(
            F.min_by(F.struct("id", "row"), order).alias("best"), F.count(F.lit(1)).alias("size")
        )
        .where("size > 1")
    )
    groups = groups.select("sha", "best.*", "size").toDF("sha", "b_id", "b_row", "size")
    groups = materialize(groups, "groups")
    same = flagged.where("maybe").join(groups, "sha", "left")
    alone = F.col("size").isNull()
    return same.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("b_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("b_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    ).unionByName(
        flagged.where("not maybe").select(
            F.col("id").alias(id_col),
            F.col("id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def drop_exact_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = BITS_PER_ROW,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows that stay, with all their columns; only possibly repeated rows shuffle.

    Of the repeated rows the narrow hashes choose first, so that texts which go are not moved.
    """
    text = whole_text(text_col)
    wide = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        F.sha2(squeezed(text), 256).alias("_sha"),
        F.char_length(text).alias("_n"),
        F.col(id_col).alias("_id"),
    )
    hashes = materialize(wide.select("_sha", "_n", "_id"), "hashes")
    bloom, blocks = repeated_filter(hashes, "_sha", bits_per_row, max_bits)
    order = F.struct(-F.col("_n"), F.col("_id").isNull(), "_id")
    winners = (
        maybe_repeated(hashes, "_sha", bloom, blocks, "_maybe")
        .where("_maybe")
        .groupBy("_sha")
        .agg(F.min_by(F.struct("_n", "_id"), order).alias("w"))
        .select("_sha", F.col("w._n").alias("w_n"), F.col("w._id").alias("w_id"))
    )
    winners = materialize(winners, "winners")
    flagged = maybe_repeated(wide, "_sha", bloom, blocks, "_maybe")
    chosen = (
        flagged.where("_maybe")
        .join(winners, "_sha")
        .where("_n = w_n and _id <=> w_id")
        .dropDuplicates(["_sha"])
    )
    return chosen.select("_row.*").unionByName(flagged.where("not _maybe").select("_row.*"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


#: All characters of ``[\x20\x09-\x0D]`` go, as in the operator.
SQUEEZED_SQL = (
    "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"
)
OP7_SQL = f"""
with hashed as (
    select doc_id, sha256({SQUEEZED_SQL}) as sha, length(coalesce(text, '')) as n,
           row_number() over () as r
    from documents
), ranked as (
    select *, count(*) over (partition by sha) as size,
           first_value(doc_id) over w as keep_id, first_value(r) over w as keep_r
    from hashed
    window w as (partition by sha order by n desc, doc_id asc nulls last, r)
)
select doc_id, keep_id, size as group_size, r = keep_r as kept, sha as text_sha256 from ranked
"""

QUERIES = {"op7_exact_dedup": op7_exact_dedup}
TWINS = {"op7_exact_dedup": OP7_SQL}
