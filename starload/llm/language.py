"""Language identification with error-correcting output codes.

Every language has a codeword. One binary n-gram classifier per bit of the code predicts on which
side of that bit the text's language lies: its weight of an n-gram is the log odds of the n-gram
under the languages with the bit set against those without. Decoding compares the margins of all
bits with each codeword by logistic loss, weighted by how surely each bit separates the languages
it was trained on, and takes the nearest codeword. A text whose second codeword is about as near
as its first is flagged as ambiguous.

Texts are lower-cased; n-grams are of 1 to 3 bytes, non-letters count as blanks, and all of a text
is read, in slices. Counts of n-grams come from Spark: about ``rows_per_lang`` rows of each of the
``max_languages`` most frequent labels (chosen by a hash of the id) are counted over the cluster,
and at most ``FEATURES`` counts per language reach the driver. Everything else covers all rows.

Defined cases: a null text or one without any letter is ``und`` with score 0, and so is every text
if nothing was learned; null labels are not learned; a null id is in fold 0; with one language
every text with a letter is that language. An empty table gives an empty result. Other columns are
kept by ``identify`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.text import documents, fold

ROWS_PER_LANG = 3000
MAX_LANGUAGES = 1000
FEATURES = 1 << 15
#: Positions of a text that are looked up at once.
SLICE = 1 << 16
#: Margins are means of log odds per n-gram; this brings them to the scale of the logistic loss.
SCALE = 6.0
#: A best score under this is ambiguous.
AMBIGUOUS = 0.52
UNKNOWN = "und"
_BLANKED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of a text's n-grams, slice by slice; feature 0 is any blank n-gram."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace").translate(_BLANKED), np.uint8)
    for at in range(0, len(raw), SLICE):
        one = raw[at : at + SLICE + 2].astype(np.uint32)
        parts, blank, code = [], one == 32, np.zeros(len(one), np.uint32)
        silent = np.ones(len(one), bool)
        for n in (1, 2, 3):
            width = len(one) - n + 1
            if width <= 0:
                break
            code = code[:width] * np.uint32(257) + one[n - 1 :] + np.uint32(1)
            silent = silent[:width] & blank[n - 1 :]
            mixed = code * np.uint32(2654435761)
            mixed ^= mixed >> np.uint32(15)
            own = 1 + mixed % np.uint32(FEATURES - 1)
            own[silent] = 0
            parts.append(own[: max(0, min(SLICE, width))])
        yield np.concatenate(parts).astype(np.int32)


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """A matrix of +1 and -1, one row per language. All splits up to five languages; beyond that
    random distinct splits, three times the bits that would tell the languages apart."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= 5:
        rows = [(1, *rest) for rest in product((1, -1), repeat=languages - 1)]
        return np.array([r for r in rows if min(r) < 0]).T
    rng = np.random.default_rng(seed)
    bits = 15 + 3 * int(np.ceil(np.log2(languages)))
    best, widest = None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], (languages, bits))
        if (abs(code.sum(0)) == languages).any():
            continue
        apart = (code @ code.T)[~np.eye(languages, dtype=bool)].max()
        if best is None or (bits - apart) > widest:
            best, widest = code, bits - apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit
    weights: np.ndarray  # feature x bit
    trust: np.ndarray  # of each bit

    def score(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)"""
        if not text or not self.languages or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0, False
        total, n = np.zeros(self.weights.shape[1]), 0
        for features in ngrams(text):
            total += self.weights[features].sum(0, dtype=np.float64)
            n += np.count_nonzero(features)
        margin = SCALE * total / max(n, 1)
        loss = np.logaddexp(0, -self.code * margin) @ self.trust
        near = np.exp(loss.min() - loss)
        best = int(np.argmin(loss))
        share = float(near[best] / near.sum())
        return self.languages[best], share, share < AMBIGUOUS


def train(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    rows_per_lang: int = ROWS_PER_LANG,
    max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Fit the classifiers on a bounded sample of the labelled rows of ``df``."""
    known = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = known.groupBy(F.col(lang_col).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.orderBy(F.desc("rows"), "label").limit(max_languages).collect()
    languages = sorted(r["label"] for r in sizes)
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((FEATURES, 1), np.float32), np.ones(1))
    rates = {r["label"]: min(1.0, rows_per_lang / r["rows"]) for r in sizes}
    small = df.sparkSession.createDataFrame(
        [(name, rates[name], i) for i, name in enumerate(languages)],
        "label string, rate double, lang_no int",
    )
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    sample = (
        known.select(F.col(lang_col).alias("label"), F.col(text_col).alias("text"), chance.alias("p"))
        .join(F.broadcast(small), "label")
        .where("p < rate")
        .select("lang_no", "text")
    )
    count = len(languages)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {}
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = seen.setdefault(number, np.zeros(FEATURES, np.int64))
                for features in ngrams(text.as_py()):
                    own += np.bincount(features, minlength=FEATURES)
        for number, own in seen.items():
            where = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(where), number, np.int32)), pa.array(where.astype(np.int32)),
                 pa.array(own[where])],
                names=["lang_no", "feature", "n"],
            )

    counts = sample.mapInArrow(counted, "lang_no int, feature int, n long")
    table = counts.groupBy("lang_no", "feature").agg(F.sum("n").alias("n")).toPandas()
    per = np.zeros((count, FEATURES))
    per[table["lang_no"], table["feature"]] = table["n"]
    per[:, 0] = 0
    share = (per + 0.5) / (per.sum(1, keepdims=True) + 0.5 * FEATURES)
    code = codewords(count)
    if count == 1:
        return Model(languages, code, np.zeros((FEATURES, 1), np.float32), np.ones(1))
    weights = np.empty((FEATURES, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        up = code[:, bit] > 0
        weights[:, bit] = np.log(share[up].mean(0)) - np.log(share[~up].mean(0))
    weights[0] = 0
    reach = code * (share @ weights)
    trust = np.clip(reach.min(0), 0.05, None)
    return Model(languages, code, weights, trust / trust.mean())


def predicted(model: Model, text: Column) -> Column:
    """A struct column: lang_pred, score, ambiguous."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def decode(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame(
                [model.score(t) for t in batch], columns=["lang_pred", "score", "ambiguous"]
            )

    return decode(text)


def identify(df: DataFrame, model: Model, text_col: str = "text", into: str = "language") -> DataFrame:
    """``df`` with one more column, the struct of ``predicted``."""
    return df.withColumn(into, predicted(model, F.col(text_col)))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs.where(fold("doc_id", 4) != 2))
    held_out = (fold("doc_id", 4) == 2).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), model).select(
        "doc_id", "held_out", "language.lang_pred", "language.score", "language.ambiguous"
    )


QUERIES = {"op9_language_id": op9_language_id}
TWINS: dict[str, str] = {}
