import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import EDGES, SCHEMA, clashing, docs
from pyspark.sql import functions as F

from starload.llm.hmm import Model, Recursion, baum_welch, count_words, encoded, scores, vocabulary


def random_model(rng, states, classes):
    def rows(n, m):
        x = rng.random((n, m)) + 0.05
        return x / x.sum(1, keepdims=True)

    return Model(rows(1, states)[0], rows(states, states), rows(states, classes).T.copy())


def paths(model, seen):
    """Every path of states and its probability together with ``seen``."""
    k = len(model.start)
    for path in itertools.product(range(k), repeat=len(seen)):
        p = model.start[path[0]] * model.emit[seen[0], path[0]]
        for a, b, o in zip(path, path[1:], seen[1:]):
            p *= model.move[a, b] * model.emit[o, b]
        yield path, p


def test_forward_and_expectations_against_all_paths():
    rng = np.random.default_rng(1)
    model = random_model(rng, 3, 4)
    sequences = [rng.integers(0, 4, n).astype(np.int32) for n in (1, 5, 2, 5, 3, 1)]
    steps = Recursion(sequences)
    got = steps.forward(model)
    log_p, starts, moves, posterior = steps.expect(model)
    emit = np.zeros((4, 3))
    np.add.at(emit, steps.seen, posterior)
    want_starts, want_moves, want_emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for s, ln in zip(sequences, got):
        total = sum(p for _, p in paths(model, s))
        assert ln == pytest.approx(math.log(total))
        for path, p in paths(model, s):
            want_starts[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want_moves[a, b] += p / total
            for state, o in zip(path, s):
                want_emit[o, state] += p / total
    assert log_p == pytest.approx(got.sum())
    assert np.allclose(starts, want_starts)
    assert np.allclose(moves, want_moves)
    assert np.allclose(emit, want_emit)


def two_tongues(spark, n, seed=0):
    rng = random.Random(seed)
    a = [f"a{i}" for i in range(60)]
    b = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = [rng.choice(rng.choice([a, b]) if i % 10 == 0 else (a if i % 2 else b)) for _ in range(30)]
        words += [f"new{rng.randrange(10**6)}"] * (i % 3)
        rows.append((i, " ".join(words).upper() if i % 4 else " ".join(words), None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


def test_base_and_score(spark):
    df = two_tongues(spark, 300)
    train = [r for r in df.collect() if r["doc_id"] % 7 != 2]
    counts = Counter(w for r in train for w in r["text"].lower().split())
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    rows = scores(clashing(df), F.col("doc_id") % 7 != 2, own=40, known=80).collect()
    assert len(rows) == 300
    text = {r["doc_id"]: r["text"].lower() for r in df.collect()}
    better = 0
    for r in rows:
        own = [counts[w] for w in text[r["doc_id"]].split()] + [len(train)]
        assert r["n_tokens"] == len(own)
        assert r["n_known"] == sum(c > 0 for c in own)
        assert r["train_tokens"] == n
        assert r["base_score"] == pytest.approx(sum(math.log10((c + 1) / (n + v + 1)) for c in own))
        assert r["held_out"] == (r["doc_id"] % 7 == 2)
        better += r["score"] > r["base_score"]
    assert better > 290


def test_bounds_of_the_dictionary_do_not_change_the_base(spark):
    df = two_tongues(spark, 60)
    wide, narrow = (
        {r["doc_id"]: r for r in scores(df, F.lit(True), own=own, known=known, rounds=1).collect()}
        for own, known in ((16, 1000), (16, 20))
    )
    for i, r in wide.items():
        assert r["base_score"] == pytest.approx(narrow[i]["base_score"])
        assert r["n_known"] == narrow[i]["n_known"]


def test_words_of_a_class_and_one_unseen_word_add_up_to_one(spark):
    df = two_tongues(spark, 60)
    vocab = vocabulary(count_words(df), 60, own=10)
    for shape in np.flatnonzero(vocab.shape_words):
        counts = [
            r["c"]
            for r in count_words(df).collect()
            if r["word"] not in vocab.words[:10]
            and (__import__("zlib").crc32(r["word"][-3:].encode()) % 4096) == shape
        ]
        kinds = np.array([*counts, 0.0])
        assert sum(10 ** vocab.inner(kinds, np.full(len(kinds), shape))) == pytest.approx(1)
        break


def test_likelihood_rises(spark):
    df = two_tongues(spark, 200).select("doc_id", "text")
    vocab = vocabulary(count_words(df), 200)
    rows = encoded(df, vocab, "doc_id", F.lit(False))
    history = baum_welch(rows, vocab, states=3, rounds=5).history
    assert all(b > a for a, b in zip(history, history[1:]))


def test_edges(spark):
    df = docs(spark, EDGES)
    for train in (F.lit(True), F.lit(False), F.coalesce(F.col("doc_id") % 2 == 0, F.lit(True))):
        rows = scores(df, train, rounds=2).collect()
        assert len(rows) == len(EDGES)
        assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert {r["base_score"] for r in scores(df, F.lit(False), rounds=1).collect()} == {0.0}
    assert scores(df.limit(0), F.lit(True)).count() == 0
