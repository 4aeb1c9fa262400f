"""Language-model scores by a hidden Markov model over word classes.

Tokens are the words of the lower-cased text and one end. Every word has a class: the ``own``
most frequent words are classes of their own, the others share ``SHAPES`` classes by their last
three characters, the end is a class. A hidden Markov model with ``states`` states emits classes;
within a shared class a word has the probability of its exact training count, less a discount that
is kept for one unseen word per class. The probability of a text is the product of both, so it is a
proper distribution over texts with unseen words taken as one word per class.

Training is Baum-Welch over every training document: each task runs the scaled forward and backward
recursions on its documents and returns expected counts per class, Spark adds them up per class,
and only the model itself (classes times states) reaches the driver. Scoring runs the scaled
forward recursion, which is the exact likelihood.

Word counts are exact over all training documents and stay on the cluster. The ``KNOWN`` most
frequent words of at most ``KNOWN_BYTES`` bytes travel to the tasks with their counts (a bounded
dictionary); all other words are looked up by a join with the counts.

Defined cases: a null text counts as empty (the end alone); a null id is in fold 0; without training
documents every class is alike and every base term is 0; rows that repeat are scored alike; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from starload.llm.text import LOWER, UPPER, documents, fold, whole_text
from starload.tables import materialize

STATES = 8
ROUNDS = 4
OWN = 1 << 14
SHAPES = 1 << 12
KNOWN = 1 << 17
KNOWN_BYTES = 64
#: Weight of the unigram in the emissions of a state, in tokens.
PRIOR = 50.0
#: Tokens whose forward values are held at once.
TOKENS_AT_ONCE = 500_000


def token_words(text: str | Column) -> Column:
    """The words of the lower-cased text as an array."""
    low = F.translate(whole_text(text), UPPER, LOWER)
    return F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shape_of(word: str, own: int) -> int:
    return own + zlib.crc32(word[-3:].encode()) % SHAPES


def _shape_column(word: str) -> Column:
    return F.crc32(F.substring(word, -3, 3)) % SHAPES


@dataclass
class Vocabulary:
    """What the tasks know of the counts; bounded by ``KNOWN`` words and ``SHAPES`` classes."""

    tokens: int  # N
    distinct: int  # V
    ends: int
    words: list[str]  # most frequent first
    counts: np.ndarray
    own: int  # how many of them are classes of their own
    shape_tokens: np.ndarray
    shape_words: np.ndarray
    discount: float

    @property
    def classes(self) -> int:
        return self.own + SHAPES + 1

    @property
    def log_base(self) -> float:
        return math.log10(self.tokens + self.distinct + 1)

    def inner(self, count: np.ndarray, shape: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its class."""
        left = np.where(count > 0, count - self.discount, self.discount * self.shape_words[shape] + 1)
        return np.log10(left / (self.shape_tokens[shape] + 1))

    def class_share(self) -> np.ndarray:
        tokens = np.r_[self.counts[: self.own], self.shape_tokens, self.ends] + 0.5
        return tokens / tokens.sum()


def count_words(train: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, c) over all rows, written."""
    words = train.select(F.explode(token_words(text_col)).alias("word"))
    return materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("c")), "words")


def vocabulary(counts: DataFrame, ends: int, own: int = OWN, known: int = KNOWN) -> Vocabulary:
    total, distinct, once, twice = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)),
        F.count(F.lit(1)),
        F.sum((F.col("c") == 1).cast("long")),
        F.sum((F.col("c") == 2).cast("long")),
    ).first()
    short = counts.where(F.octet_length("word") <= KNOWN_BYTES)
    # The frequent words are those above a cut in counts; the cut is found from a few hundred bins.
    bin_of = F.floor(F.log2(F.col("c").cast("double")) * 16)
    bins = short.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c"))
    cut, inside = None, 0
    for r in bins.orderBy(F.desc("bin")).collect():
        inside += r["n"]
        if inside > known:
            break
        cut = r["c"]
    frequent = []
    if cut is not None:
        frequent = [(r["c"], r["word"]) for r in short.where(F.col("c") >= cut).collect()]
        frequent.sort(key=lambda x: (-x[0], x[1]))
    words = [w for _, w in frequent]
    own = min(own, len(words))
    per = counts.groupBy(_shape_column("word").alias("shape")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")
    )
    shape_tokens, shape_words = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in per.collect():
        shape_tokens[r["shape"]], shape_words[r["shape"]] = r["c"], r["v"]
    for (c, w) in frequent[:own]:
        shape = shape_of(w, 0)
        shape_tokens[shape] -= c
        shape_words[shape] -= 1
    discount = (once or 0) / ((once or 0) + 2 * (twice or 0)) if once else 0.5
    return Vocabulary(
        total + ends,
        distinct + (ends > 0),
        ends,
        words,
        np.array([c for c, _ in frequent], float),
        own,
        shape_tokens,
        shape_words,
        min(max(discount, 0.1), 0.95),
    )


def encoded(df: DataFrame, vocab: Vocabulary, id_col: str, held_out: Column) -> DataFrame:
    """One written row per document: the classes of its tokens, what the bounded dictionary says
    of its words, and the words that it does not hold."""
    schema = StructType(
        [
            StructField("id", df.schema[id_col].dataType),
            StructField("held_out", BooleanType()),
            StructField("n_tokens", LongType()),
            StructField("n_known", LongType()),
            StructField("base", DoubleType()),
            StructField("inner", DoubleType()),
            StructField("classes", ArrayType(IntegerType())),
            StructField("others", ArrayType(StringType())),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = len(vocab.words)
        places = {w.encode(): i for i, w in enumerate(vocab.words)}
        shape = np.array([shape_of(w, 0) for w in vocab.words], np.int64)
        own = np.arange(known) < vocab.own
        class_of = np.where(own, np.arange(known), vocab.own + shape).astype(np.int32)
        base = np.log10(vocab.counts + 1) - vocab.log_base
        inner = np.where(own, 0.0, vocab.inner(vocab.counts, shape) if known else 0.0)
        end = math.log10(vocab.ends + 1) - vocab.log_base
        find = places.get
        for batch in batches:
            rows = []
            for text in batch.column(2):
                words = text.as_py().encode().lower().split()
                at = np.array([find(w, -1) for w in words], np.int64)
                seen = at[at >= 0]
                kinds = np.empty(len(words) + 1, np.int32)
                kinds[:-1] = class_of[at] if known else 0
                missing = np.flatnonzero(at < 0).tolist()
                others = [words[i].decode() for i in missing]
                for i, word in zip(missing, others):
                    kinds[i] = shape_of(word, vocab.own)
                kinds[-1] = vocab.classes - 1
                rows.append(
                    (len(words) + 1, len(seen) + (vocab.ends > 0), end + base[seen].sum(),
                     inner[seen].sum(), kinds, others)
                )
            columns = list(zip(*rows)) or [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:2]]
            arrays += [pa.array(c, pa.float64()) for c in columns[2:4]]
            arrays += [pa.array(columns[4], pa.list_(pa.int32())), pa.array(columns[5], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], names=schema.names
            )

    rows = df.select(F.col(id_col), held_out.alias("held_out"), whole_text("text").alias("text"))
    rows = rows.mapInArrow(encode, schema).withColumn("row", F.monotonically_increasing_id())
    return materialize(rows, "encoded")


@dataclass
class Model:
    start: np.ndarray  # state
    move: np.ndarray  # state x state
    emit: np.ndarray  # class x state
    history: list[float] = field(default_factory=list)  # log10 likelihood before each round


def first_model(share: np.ndarray, states: int, seed: int = 11) -> Model:
    """States that stay as they are, with emissions a little apart."""
    rng = np.random.default_rng(seed)
    emit = share[:, None] * rng.uniform(0.5, 1.5, (len(share), states))
    move = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


class Recursion:
    """The recursions over many sequences at once, step by step; longest sequences first.

    Values are stored in the order of time, and at each time the sequences still running are the
    first ones, so there is no padding.
    """

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        flat = np.concatenate([sequences[i] for i in self.order])
        starts = np.cumsum(lengths) - lengths
        time = np.arange(len(flat)) - np.repeat(starts, lengths)
        self.seen = flat[np.argsort(time, kind="stable")]
        ended = np.bincount(lengths, minlength=lengths[0] + 1)
        self.running = (len(lengths) - np.cumsum(ended)[:-1]).tolist()
        self.offsets = (np.cumsum(self.running) - self.running).tolist()
        self.count = len(lengths)

    def forward(self, model: Model, keep: bool = False):
        """ln P of each sequence, in the given order; with ``keep`` also the scaled values."""
        log_p = np.zeros(self.count)
        kept = np.empty((len(self.seen), len(model.start))) if keep else None
        scales = np.empty(len(self.seen)) if keep else None
        now = None
        for n, at in zip(self.running, self.offsets):
            before = model.start[None, :] if now is None else now[:n] @ model.move
            now = before * model.emit[self.seen[at : at + n]]
            scale = now.sum(1)
            now /= scale[:, None]
            log_p[:n] += np.log(scale)
            if keep:
                kept[at : at + n], scales[at : at + n] = now, scale
        result = np.empty(self.count)
        result[self.order] = log_p
        return (result, kept, scales) if keep else result

    def expect(self, model: Model):
        """(ln P of all, expected starts, moves, and the posterior of every token)."""
        log_p, alpha, scales = self.forward(model, keep=True)
        moves = np.zeros_like(model.move)
        after = None
        for t in range(len(self.running) - 1, -1, -1):
            n, at = self.running[t], self.offsets[t]
            beta = np.ones((n, len(model.start)))
            if after is not None:
                m = len(after)
                moves += alpha[at : at + m].T @ after
                beta[:m] = after @ model.move.T
            seen = self.seen[at : at + n]
            after = model.emit[seen] * beta / scales[at : at + n, None]
            alpha[at : at + n] *= beta
        return log_p.sum(), alpha[: self.running[0]].sum(0), moves * model.move, alpha


def _groups(sequences: list[np.ndarray]) -> Iterator[list[int]]:
    """Sequences of like length together, at most about ``TOKENS_AT_ONCE`` tokens in each group."""
    group, size = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: -len(sequences[i])):
        if group and size + len(sequences[i]) > TOKENS_AT_ONCE:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(sequences[i])
    if group:
        yield group


def _sequences(column: pa.Array) -> list[np.ndarray]:
    flat = column.values.to_numpy()
    ends = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def baum_welch(rows: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Train on the ``classes`` of ``rows``."""
    share = vocab.class_share()
    model = first_model(share, states)
    sums = [f"k{k}" for k in range(states)]
    schema = "kind int, item int, " + ", ".join(f"{k} double" for k in sums)
    EMIT, MOVE, START, LIKELIHOOD = range(4)

    def expect_with(model: Model):
        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            emit = np.zeros((len(share), states))
            move, start, log_p = np.zeros((states, states)), np.zeros(states), 0.0
            for batch in batches:
                sequences = _sequences(batch.column(0))
                for group in _groups(sequences):
                    steps = Recursion([sequences[i] for i in group])
                    p, starts, moves, posterior = steps.expect(model)
                    log_p, start, move = log_p + p, start + starts, move + moves
                    for k in range(states):
                        emit[:, k] += np.bincount(steps.seen, posterior[:, k], len(share))
            used = np.flatnonzero(emit.any(1))
            kinds = np.r_[np.full(len(used), EMIT), np.full(states, MOVE), START, LIKELIHOOD]
            items = np.r_[used, np.arange(states), 0, 0]
            table = np.r_[emit[used], move, start[None], np.full((1, states), log_p)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds.astype(np.int32)), pa.array(items.astype(np.int32)),
                 *(pa.array(np.ascontiguousarray(table[:, k])) for k in range(states))],
                names=["kind", "item", *sums],
            )

        return expect

    for _ in range(rounds):
        counts = rows.select("classes").mapInArrow(expect_with(model), schema)
        added = counts.groupBy("kind", "item").agg(*[F.sum(k).alias(k) for k in sums]).toPandas()
        values = {kind: part for kind, part in added.groupby("kind")}
        if EMIT not in values:
            break
        emit = np.zeros((len(share), states))
        emit[values[EMIT]["item"]] = values[EMIT][sums].to_numpy()
        move = values[MOVE].sort_values("item")[sums].to_numpy() + 1e-2
        start = values[START][sums].to_numpy()[0] + 1e-2
        emit += PRIOR * share[:, None]
        log_p = float(values[LIKELIHOOD][sums[0]].iloc[0]) / math.log(10)
        model = Model(
            start / start.sum(),
            move / move.sum(1, keepdims=True),
            emit / emit.sum(0),
            [*model.history, log_p],
        )
    return model


def scores(
    df: DataFrame,
    trained_on: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
    own: int = OWN,
    known: int = KNOWN,
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``trained_on`` is true for the rows to learn from.
    """
    df = df.select(F.col(id_col), F.col(text_col).alias("text"), trained_on.alias("_train"))
    train = df.where("_train")
    counts = count_words(train)
    vocab = vocabulary(counts, train.count(), own, known)
    rows = encoded(df, vocab, id_col, ~F.col("_train"))
    model = baum_welch(rows.where("not held_out"), vocab, states, rounds)

    looked_up = rows.select("row", F.explode("others").alias("word")).join(counts, "word", "left")
    count = F.coalesce("c", F.lit(0)).cast("double")
    shape = _shape_column("word").cast("int")
    shapes = df.sparkSession.createDataFrame(
        [(i, float(vocab.shape_tokens[i]), float(vocab.shape_words[i])) for i in range(SHAPES)],
        "shape int, shape_tokens double, shape_words double",
    )
    left = F.when(F.col("count") > 0, F.col("count") - vocab.discount).otherwise(
        F.col("shape_words") * vocab.discount + 1
    )
    rest = (
        looked_up.select("row", count.alias("count"), shape.alias("shape"))
        .join(F.broadcast(shapes), "shape")
        .groupBy("row")
        .agg(
            F.sum(F.log10(F.col("count") + 1) - vocab.log_base).alias("more_base"),
            F.sum(F.log10(left / (F.col("shape_tokens") + 1))).alias("more_inner"),
            F.sum((F.col("count") > 0).cast("long")).alias("more_known"),
        )
    )
    plain = [f for f in rows.schema.fields if f.name not in ("classes", "others")]
    schema = StructType([*plain, StructField("ln_p", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences = _sequences(batch.column("classes"))
            ln_p = np.empty(len(sequences))
            for group in _groups(sequences):
                ln_p[group] = Recursion([sequences[i] for i in group]).forward(model)
            columns = [batch.column(f.name) for f in plain]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ln_p)], names=schema.names)

    scored = rows.drop("others").mapInArrow(score, schema)

    def more(name: str) -> Column:
        return F.coalesce(name, F.lit(0))

    return scored.join(rest, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + more("more_known")).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more("more_base")).alias("base_score"),
        (F.col("ln_p") / math.log(10) + F.col("inner") + more("more_inner")).alias("score"),
    )


def op10_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(documents(spark, sf_dir), fold("doc_id", 7) != 2)


QUERIES = {"op10_hmm_score": op10_hmm_score}
TWINS: dict[str, str] = {}
