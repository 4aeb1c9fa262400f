"""Best-fit packing of token sequences in bulk-synchronous steps.

Documents become pieces of at most ``capacity`` tokens; only longer ones are cut, and their first
piece takes the remainder, so that every other piece fills a sequence by itself. The pieces are
range-sorted by length over all executors and numbered. Pieces of one length, and open sequences
of one gap, are interchangeable, so the sorted lists are swept as runs (length or gap, how many):

* each step takes the longest unplaced run and finds its successor among the sorted gap runs, the
  smallest gap that holds it; gaps that are too small are never looked at again;
* conflicts are resolved by rank: the k-th piece of the run goes to the k-th place that the gap run
  offers; what is left over opens new sequences;
* the gaps are updated (runs of the smaller gap) and the next step begins.

A step places every piece of its length at once, so there are at most ``capacity`` steps whatever
the corpus, and the state on the driver is one count per length (at most ``capacity``) and the runs.
The rows then find their place by a distributed successor search over the runs' first ranks. That
equals best-fit decreasing over the single pieces.

Defined cases: a null text counts as empty and gives the end token alone; a null id, repeated ids
and repeated rows are packed like any row; an empty table gives an empty result; other columns of
the input are not read. Where a text contains the characters of a special token ("<|endoftext|>"),
they are that token's one id, as in the tokenizer file at its defaults, and part the text.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from starload.llm.text import documents, whole_text
from starload.operators.keys import dense_key
from starload.tables import materialize

CAPACITY = 1024
END = 2
#: The ranks of byte_bpe_50k.json: the same ids, of which a word not seen before costs a third.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The special tokens of that tokenizer file, which a file of ranks does not list.
SPECIAL = {"<|endoftext|>": 50256}
#: Words whose ids one task remembers.
KNOWN_WORDS = 200_000


def load_encoder(vocabulary: str):
    """``encode(text) -> ids`` for a file of ranks or a tokenizer file; a bare name is looked up
    among the public tokenizers of the machine that runs the task."""
    import os

    import public_tokenizers

    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    import base64

    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


#: A space with whitespace beside it, and a space with none.
_BESIDE, _BETWEEN = re.compile(r" \s|\s "), re.compile(r"(?<!\s) (?!\s)")


class WordIds(dict):
    """Ids of a space and a word, as little-endian 32-bit numbers, computed once per word.

    The vocabulary's pattern always begins a new token at a single space between two characters
    that are no whitespace of Unicode, so a text may be encoded word by word if it is only cut at
    such spaces. Merges do go across a space beside other whitespace (a no-break space).
    """

    def __init__(
        self, encode, limit: int = KNOWN_WORDS, special: Mapping[str, int] = SPECIAL
    ):
        super().__init__()
        self.encode, self.limit = encode, limit
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in special.items()}
        longest = sorted(special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if special else None

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(" " + word), "<u4").tobytes()
        if len(word) <= 40:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        if any(map(text.__contains__, self.special)):
            parts = self.marks.split(text)
            return b"".join(self.special.get(part) or self.plain(part) for part in parts if part)
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        """The ids of a text without special tokens."""
        if _BESIDE.search(text):
            first, *words = _BETWEEN.split(text)
        else:
            first, *words = text.split(" ")
        head = np.array(self.encode(first), "<u4").tobytes() if first else b""
        return head + b"".join(map(self.__getitem__, words))


def pieces(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    end: int = END,
    keep_ids: bool = False,
    special: Mapping[str, int] = SPECIAL,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document, the end token included."""
    fields = [
        StructField(id_col, df.schema[id_col].dataType),
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
    ]
    if keep_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds(load_encoder(vocabulary), special=special)
        stop = np.array([end], "<u4").tobytes()
        for batch in batches:
            owner, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = known.text(text.as_py()) + stop
                total, at, number = len(ids) // 4, 0, 0
                take = total % capacity or capacity
                while at < total:
                    part = ids[4 * at : 4 * (at + take)]
                    owner.append(row)
                    piece.append(number)
                    start.append(at)
                    length.append(take)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(np.frombuffer(part, "<i4"))
                    at, number, take = at + take, number + 1, capacity
            columns = [
                batch.column(0).take(pa.array(owner, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return df.select(id_col, whole_text(text_col).alias("text")).mapInArrow(
        cut, StructType(fields)
    )


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Place ``counts[length]`` pieces of each length; (runs, number of sequences).

    A run (length, first, n, sequence, width, offset) says: the pieces of ``length`` ranked
    ``first + i`` for i < n go to sequence ``sequence + i % width``, and start there at
    ``offset + i // width * length``.
    """
    gaps: list[int] = []
    free: dict[int, list[tuple[int, int]]] = {}
    runs: list[tuple] = []
    used = 0

    def release(gap: int, sequence: int, width: int) -> None:
        if gap and width:
            if gap not in free:
                bisect.insort(gaps, gap)
                free[gap] = []
            free[gap].append((sequence, width))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                sequence, width = free[gap].pop()
            else:
                gap, sequence, width = capacity, used, -(-left // (capacity // length))
            each = gap // length
            whole = min(width, left // each)
            if whole:
                taken = whole * each
                runs.append((length, rank, taken, sequence, whole, capacity - gap))
                release(gap - each * length, sequence, whole)
            else:
                whole, taken = 1, left
                for i in range(taken):
                    runs.append((length, rank + i, 1, sequence, 1, capacity - gap + i * length))
                release(gap - taken * length, sequence, 1)
            if gap == capacity and sequence == used:
                used += whole
            elif width > whole:
                free[gap].append((sequence + whole, width - whole))
            if gap in free and not free[gap]:
                del free[gap]
                gaps.remove(gap)
            rank, left = rank + taken, left - taken
    return runs, used


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    end: int = END,
    keep_ids: bool = False,
    special: Mapping[str, int] = SPECIAL,
) -> DataFrame:
    """The pieces of ``df`` with ``sequence_id`` and ``offset``."""
    spark = df.sparkSession
    cut = pieces(df, id_col, text_col, capacity, vocabulary, end, keep_ids, special)
    cut = materialize(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    placed = dense_key(cut, ["length"], "_rank", start=0, ties=["_row"], label="ranked")
    counts = {r["length"]: r["count"] for r in placed.groupBy("length").count().collect()}
    runs, _ = best_fit(counts, capacity)
    before, total = {}, 0
    for length in sorted(counts):
        before[length], total = total, total + counts[length]
    # Global ranks, so that one sorted list of first ranks serves all lengths.
    spots = sorted((before[r[0]] + r[1], *r[3:]) for r in runs)
    firsts, sequences, widths, offsets = (
        (list(column) for column in zip(*spots)) if spots else ([], [], [], [])
    )
    schema = StructType(
        [f for f in placed.schema.fields if not f.name.startswith("_")]
        + [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, sequence = np.array(firsts, np.int64), np.array(sequences, np.int64)
        width, offset = np.array(widths, np.int64), np.array(offsets, np.int64)
        for batch in batches:
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            run = np.searchsorted(first, rank, "right") - 1
            i = rank - first[run]
            columns = [batch.column(name) for name in schema.names[:-2]]
            columns.append(pa.array(sequence[run] + i % width[run]))
            columns.append(pa.array(offset[run] + i // width[run] * length))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    if not spots:
        return spark.createDataFrame([], schema)
    return placed.mapInArrow(settle, schema)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


QUERIES = {"op3_best_fit_packing": op3_best_fit_packing}
TWINS: dict[str, str] = {}
