import hashlib
import math
import random
import re
from zlib import crc32

import pytest
from helpers import EDGES, clashing, docs

from starload.llm.resampling import (
    draw,
    feature_hasher,
    op13_importance_resampling,
    segments,
    weights,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def runs(text, ngrams):
    words = WORD.findall(lowered(text))
    return words, [
        " ".join(words[i : i + k]) for k in range(1, ngrams + 1) for i in range(len(words) - k + 1)
    ]


def brute(rows, target, ngrams=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    def count(texts):
        found = [0] * buckets
        for text in texts:
            for f in runs(text, ngrams)[1]:
                found[crc32(f.encode()) % buckets] += 1
        return found

    s, t = count(text for _, text in rows), count(target)
    s_all, t_all = sum(s) + buckets, sum(t) + buckets
    gain = [math.floor(1000 * math.log((b + 1) * s_all / ((a + 1) * t_all))) for a, b in zip(s, t)]
    out, n_open = [], 0
    for i, text in rows:
        words, found = runs(text, ngrams)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        n_open += len(words) >= min_words
        out.append([i, len(found), weight, score, None, len(words) >= min_words])
    ranked = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(ranked[: percent * n_open // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def texts():
    rng = random.Random(9)
    names = [f"w{i}" for i in range(80)] + ["Über", "ÜBER", "naïve", "日本", "x_y", "a-b", "it's"]
    made = [" ".join(rng.choices(names, k=rng.randint(0, 60))) for _ in range(300)]
    long = [(None, " ".join(rng.choices(names, k=30))) for _ in range(5)]
    return EDGES + made + made[:40] + [(3, made[5]), (3, made[5])] + long


TARGET = ["w1 w2 w3 w1", None, "", "naïve Über w7 A-B"]


@pytest.mark.parametrize("ngrams, buckets", [(1, 10_000), (2, 70_000), (3, 64)])
def test_against_brute_force(spark, ngrams, buckets):
    df, target = docs(spark, texts()), docs(spark, TARGET)
    got = weights(clashing(df), target, ngrams=ngrams, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    expected = brute(rows, TARGET, ngrams, buckets)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert sum(r[4] is not None for r in expected) > 10


@pytest.mark.parametrize("ngrams", [1, 2, 4])
@pytest.mark.parametrize("limit", [1, 2, 5, 40])
def test_windows_go_on_across_segments(monkeypatch, ngrams, limit):
    monkeypatch.setattr("starload.llm.resampling.segments", lambda text: segments(text, limit))
    hashes = feature_hasher(ngrams)
    for text in texts():
        text = text[1] if isinstance(text, tuple) else text
        if text and len(text) < 2000:
            words, found = runs(text, ngrams)
            n, crcs = hashes(text)
            assert n == len(words)
            assert sorted(crcs.tolist()) == sorted(crc32(f.encode()) for f in found)


def test_segments_are_the_text():
    for text in ("", "a", "a b  c" * 9, "x" * 50, "x" * 50 + " y"):
        for limit in (1, 3, 100):
            assert "".join(segments(text, limit)) == text


def test_drawn_rows_keep_all_columns(spark):
    df, target = clashing(docs(spark, texts())), docs(spark, TARGET)
    got = draw(df, target, min_words=5, percent=30)
    assert got.columns == df.columns
    ranks = weights(df, target, min_words=5, percent=30).where("rank is not null")
    assert sorted(map(str, got.select("doc_id").collect())) == sorted(
        map(str, ranks.select("doc_id").collect())
    )


def test_no_target_and_no_rows(spark):
    df = docs(spark, texts())
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = weights(df, docs(spark, TARGET).limit(0))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, [])
    assert weights(df.limit(0), docs(spark, TARGET)).count() == 0
    assert draw(df.limit(0), docs(spark, TARGET)).count() == 0


def test_wrong_parameters(spark):
    df = docs(spark, ["a"])
    for wrong in ({"percent": 101}, {"buckets": 0}):
        with pytest.raises(ValueError):
            weights(df, df, **wrong)


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = op13_importance_resampling(spark, sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, target)
