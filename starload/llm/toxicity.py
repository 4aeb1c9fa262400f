"""Toxicity by a weighted finite-state pattern grammar.

Words become classes: insults and their stems are learned from labels, with a weight; threats,
targets (persons spoken to or of), negations and words of reported speech are short fixed lists. A
clause is a run of words up to a mark of punctuation or a line break. Four small weighted
transducers each read a clause and pass it on with some classes changed or weighted:

* ``reported`` marks what follows a word of reporting,
* ``negated`` marks the insult or threat that follows a negation in the next words,
* ``targeted`` strengthens one near a target,
* ``matched`` adds up what is left.

They are composed once into one machine (the reachable product of their states), which scores a
clause in one pass. A text's score is a logistic function of its strongest clause and of the sum of
its clauses, fitted on the same sample of labelled rows.

The lexicon is counted with Spark over about ``sample_rows`` labelled rows (chosen by a hash of the
id): in how many toxic and other texts each word and each word beginning of 4 to 6 letters occurs;
the ``max_terms`` surest terms reach the driver. Stems let unseen word forms match. Scoring covers
all rows and whole texts and reads nothing but the text.

Defined cases: a null or empty text has no clause and gets the score of a text without a match; a
null label is not learned, a null id is in fold 0 and never learned; without labels of both kinds
nothing is learned and every score is that of the fixed lists. Rows that repeat are scored alike; an
empty table gives an empty result; other columns are kept by ``scored``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.text import documents, fold, labels, whole_text

SAMPLE_ROWS = 20_000
MAX_TERMS = 4000
#: A term is learned if it occurs in this many toxic texts, this many standard deviations more
#: often than by chance, and if its log odds, less some standard errors, are above the floor.
MIN_TOXIC, DEVIATIONS, ERRORS, FLOOR = 4, 5.0, 2.0, 1.0
STEMS = (4, 5, 6)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Inner classes: an insult or threat seen as reported, as negated, or as aimed at someone.
SOFT, NEGATED, AIMED = 6, 7, 8
CLASSES = range(9)

THREATS = "kill hurt destroy smash beat burn töten umbringen schlagen tuer frapper matar golpear"
TARGETS = (
    "you your yours he she they them him her people everyone du dich dir ihr sie euch "
    "tu toi te vous ils elles tú ti usted ustedes ellos"
)
NEGATIONS = "not never no isn't aren't wasn't don't nicht kein keine nie pas jamais non ni nunca"
REPORTS = "said says called calls quoted wrote told sagte nannte schrieb dit appelé dijo llamó"

#: What is left of a weight when the insult is reported or negated, or aimed at a target.
REPORTED_SHARE, NEGATED_SHARE, AIMED_SHARE = 0.6, 0.4, 1.3
#: Words that a report, a negation or a target reaches.
REACH = 3

_MARKS = frozenset(".!?;:\n")


# A transducer: states 0..n-1, start 0; step(state, class) -> (state, class, factor).
Step = dict[tuple[int, int], tuple[int, int, float]]


def _reaching(opens: int, closes: tuple[int, ...], into: int, factor: float) -> Step:
    """After a word of class ``opens``, the next words of ``closes`` become ``into``."""
    step: Step = {}
    for state in range(REACH + 1):
        for c in CLASSES:
            if c == opens:
                step[state, c] = (REACH, c, 1.0)
            elif state and c in closes:
                step[state, c] = (state - 1, into, factor)
            else:
                step[state, c] = (max(0, state - 1), c, 1.0)
    return step


def compose(first: Step, second: Step) -> Step:
    """The machine that feeds the output of ``first`` to ``second``; reachable states only."""
    numbers, todo, step = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        pair = todo.pop()
        for c in CLASSES:
            a, middle, x = first[pair[0], c]
            b, out, y = second[pair[1], middle]
            if (a, b) not in numbers:
                numbers[a, b] = len(numbers)
                todo.append((a, b))
            step[numbers[pair], c] = (numbers[a, b], out, x * y)
    return step


def grammar() -> Step:
    harm = (INSULT, THREAT)
    reported = _reaching(REPORT, harm, SOFT, REPORTED_SHARE)
    negated = _reaching(NEGATION, (*harm, SOFT), NEGATED, NEGATED_SHARE)
    targeted = _reaching(TARGET, harm, AIMED, AIMED_SHARE)
    matched: Step = {
        (0, c): (0, c, 1.0 if c in (INSULT, THREAT, SOFT, NEGATED, AIMED) else 0.0) for c in CLASSES
    }
    machine = reported
    for following in (negated, targeted, matched):
        machine = compose(machine, following)
    return machine


def bare(word: str) -> str:
    """Lower case, without what surrounds the letters."""
    word = word.lower()
    if word.isalpha():
        return word
    start, end = 0, len(word)
    while start < end and not word[start].isalpha():
        start += 1
    while end > start and not word[end - 1].isalpha():
        end -= 1
    return word[start:end]


def stems(word: str) -> list[str]:
    return [f"{word[:n]}~" for n in STEMS if len(word) >= n]


class Lexicon(dict):
    """raw word -> (class, weight, ends the clause); remembers up to ``limit`` words."""

    def __init__(self, terms: dict[str, float], limit: int = 200_000):
        super().__init__()
        self.terms, self.limit = terms, limit
        self.fixed = {
            word: kind
            for kind, words in (
                (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS),
            )
            for word in words.split()
        }

    def __missing__(self, raw: str) -> tuple[int, float, bool]:
        word = bare(raw)
        weight = max((self.terms.get(t, 0.0) for t in (word, *stems(word))), default=0.0)
        kind = INSULT if weight > 0 else self.fixed.get(word, OTHER)
        found = (kind, weight if weight > 0 else 1.0, raw[-1:] in _MARKS)
        if len(raw) <= 40:
            if len(self) >= self.limit:
                self.clear()
            self[raw] = found
        return found


@dataclass
class Model:
    terms: dict[str, float]
    intercept: float = -3.0
    strongest: float = 1.0
    total: float = 0.5

    def prepare(self) -> tuple[Lexicon, Step]:
        return Lexicon(self.terms), grammar()

    def probability(self, strongest, total):
        z = self.intercept + self.strongest * strongest + self.total * np.log1p(total)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def clauses(text: str, lexicon: Lexicon, machine: Step) -> list[float]:
    """The weight of every clause that matches."""
    found = []
    for line in text.split("\n"):
        seen = list(map(lexicon.__getitem__, line.split()))
        if not any(kind in (INSULT, THREAT) for kind, _, _ in seen):
            continue
        state, weight = 0, 0.0
        for kind, own, ends in seen:
            state, _, factor = machine[state, kind]
            weight += own * factor
            if ends:
                if weight:
                    found.append(weight)
                state, weight = 0, 0.0
        if weight:
            found.append(weight)
    return found


def strength(text: str, lexicon: Lexicon, machine: Step) -> tuple[float, float]:
    """(strongest clause, sum of clauses)"""
    found = clauses(text, lexicon, machine)
    return (max(found), sum(found)) if found else (0.0, 0.0)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a ridge; a match never lowers a score, so a column whose weight would be
    below zero is left out and the rest is fitted again."""
    used = list(range(x.shape[1]))
    while True:
        part, w = x[:, used], np.zeros(len(used))
        ridge = np.diag([0.0, *[0.5] * (len(used) - 1)]) + 1e-6 * np.eye(len(used))
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            curve = (part * (p * (1 - p))[:, None]).T @ part + ridge
            step = np.linalg.solve(curve, part.T @ (p - y) + ridge @ w)
            w -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        lowest = 1 + int(np.argmin(w[1:])) if len(used) > 1 else 0
        if not lowest or w[lowest] >= 0:
            fitted = np.zeros(x.shape[1])
            fitted[used] = w
            return fitted
        del used[lowest]


def _without_short_copies(terms: dict[str, tuple[float, float]]) -> dict[str, float]:
    """The weights, without the shortest beginnings that stand for one word alone: those would
    match words of other languages."""
    top = {f"{w[: min(STEMS)]}~": 0.0 for w in terms}
    for word, (toxic, _) in terms.items():
        if not word.endswith("~"):
            stem = f"{word[: min(STEMS)]}~"
            top[stem] = max(top[stem], toxic)
    return {
        term: float(weight)
        for term, (toxic, weight) in terms.items()
        if len(term) != min(STEMS) + 1 or term not in top or top[term] < 0.6 * toxic
    }


def train(
    df: DataFrame,
    label: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    max_terms: int = MAX_TERMS,
) -> Model:
    """Learn from the rows of ``df`` that ``label`` (id, label) marks."""
    marks = label.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(
        F.max(F.col(label_col).cast("int")).alias("_toxic")
    )
    rows = marks.count()
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    chosen = marks.where(chance < min(1.0, sample_rows / max(rows, 1)))
    # About sample_rows ids of a few bytes each: bounded whatever the corpus.
    marked = df.select(F.col(id_col), whole_text(text_col).alias("_text")).join(
        F.broadcast(chosen), id_col
    )
    marked = marked.select(F.col("_text").alias("text"), F.col("_toxic").alias("toxic"))

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = {bare(w) for w in text.as_py().split()} - {""}
                terms = words | {s for w in words for s in stems(w)}
                if terms:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(terms), pa.array([toxic] * len(terms), pa.int32())],
                        names=["term", "toxic"],
                    )

    kinds = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    toxic, fine = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not fine:
        return Model({})
    counts = marked.mapInArrow(terms_of, "term string, toxic int").groupBy("term").agg(
        F.sum("toxic").cast("double").alias("t"), F.count(F.lit(1)).cast("double").alias("n")
    )
    yes, no = F.col("t") + 0.5, F.col("n") - F.col("t") + 0.5
    odds = F.log(yes / (toxic + 1 - yes + 0.5)) - F.log(no / (fine + 1 - no + 0.5))
    error = F.sqrt(1 / yes + 1 / no)
    chance = F.col("n") * toxic / (toxic + fine)
    often = (F.col("t") - chance) / F.sqrt(chance) >= DEVIATIONS
    sure = counts.where((F.col("t") >= MIN_TOXIC) & often).select(
        "term", "t", (odds - ERRORS * error).alias("sure")
    )
    best = sure.where(F.col("sure") > FLOOR).orderBy(F.desc("sure"), "term").limit(max_terms)
    model = Model(_without_short_copies({r["term"]: (r["t"], r["sure"]) for r in best.collect()}))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, machine = model.prepare()
        for batch in batches:
            found = [strength(t.as_py(), lexicon, machine) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found]), pa.array([f[1] for f in found]), batch.column(1)],
                names=["strongest", "total", "toxic"],
            )

    points = marked.mapInArrow(measured, "strongest double, total double, toxic int").toPandas()
    x = np.c_[np.ones(len(points)), points["strongest"], np.log1p(points["total"])]
    w = _logistic(x, points["toxic"].to_numpy(float))
    return Model(model.terms, *map(float, w))


def score(model: Model, text: Column) -> Column:
    """The probability that a text is toxic."""

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, machine = model.prepare()
        for batch in texts:
            found = np.array([strength(t, lexicon, machine) for t in batch]).reshape(-1, 2)
            yield pd.Series(model.probability(found[:, 0], found[:, 1]))

    return scores(whole_text(text))


def scored(df: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    return df.withColumn(into, score(model, F.col(text_col)))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learned = fold("doc_id", 5) != 0
    model = train(docs.where(learned), labels(spark, sf_dir).where(learned))
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return scored(docs.select("doc_id", held_out, "text"), model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


QUERIES = {"op6_toxicity": op6_toxicity}
TWINS: dict[str, str] = {}
