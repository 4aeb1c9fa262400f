import hashlib
import random
import re

import xxhash
from helpers import EDGES, clashing, docs
from pyspark.sql import functions as F

from starload.llm.fingerprints import edited_fingerprints, likeness, signature

BLANK = "\x20\x09-\x0d"


def long_hash(values):
    """Spark's xxhash64 of longs: each hash is the seed of the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), seed)
    return seed


def brute(text, k=3, sketches=32, picks=2):
    tokens = re.findall(rf"[^{BLANK}]{{1,6}}", text)
    kmers = []
    for i in range(len(tokens)):
        seed = 42
        for t in tokens[max(0, i - k + 1) : i + 1]:
            seed = xxhash.xxh64_intdigest(t.encode(), seed)
        kmers.append(seed >> 28)
    seen, chosen = {}, {}
    for place, kmer in enumerate(kmers):
        number = seen[kmer] = seen.get(kmer, -1) + 1
        code = long_hash([kmer, number]) >> 28
        bucket = code >> (36 - (sketches.bit_length() - 1))
        chosen.setdefault(bucket, []).append((code, place))
    out = []
    for bucket in sorted(chosen):
        best = sorted(chosen[bucket])[:picks]
        codes = [code for code, _ in sorted(best, key=lambda b: b[1])]
        out.append(f"{bucket:02x}" + f"{long_hash(codes):016x}"[:8])
    return out


def test_signatures_against_their_definition(spark):
    rng = random.Random(1)
    texts = ["", " ", "a", "a b", "same line\n" * 50, "word " * 3000, "x" * 500]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(n)) for n in range(1, 400, 13)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", signature(F.col("text")).alias("s")).collect():
        assert r["s"] == brute(r["text"]), r["text"]


def test_order_and_edits_count(spark):
    rng = random.Random(2)
    lines = [" ".join(str(rng.randrange(10**6)) for _ in range(20)) for _ in range(30)]
    text = "\n".join(lines)
    moved = "\n".join(lines[15:] + lines[:15])
    shuffled = "\n".join(rng.sample(lines, 30))
    slight = text.replace(lines[3], "something else here")
    df = spark.createDataFrame([(text, slight, moved, shuffled, "none of it")], "a string, b string, c string, d string, e string")
    of = {c: signature(F.col(c), sketches=256) for c in "abcde"}
    near = df.select(*[likeness(of["a"], of[c]).alias(c) for c in "abcde"]).first()
    assert near["a"] == 1 > near["b"] > near["c"] > near["d"] > near["e"] == 0


def test_edited_texts(spark):
    rng = random.Random(3)
    texts = [" ".join(str(rng.randrange(900)) for _ in range(rng.randint(1, 200))) for _ in range(60)]
    texts += ["naïve 日本語 text " * 9, "\U0001f600" * 50, "", None, "ab", "abc", "abcd", "word " * 20_000]
    df = docs(spark, texts)
    rows = sorted(edited_fingerprints(clashing(df)).collect(), key=lambda r: r["doc_id"])
    assert len(rows) == len(texts)
    for i, r in enumerate(rows):
        text, after = texts[i] or "", texts[(i + 1) % len(texts)] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] != "" or not text.strip()
        assert (r["near_edited"] == 1) or edited != text
        if i < 59:
            assert r["fingerprint"] == "".join(brute(text))
            assert r["edited_fingerprint"] == "".join(brute(edited))
            assert r["near_next"] < 0.4
    assert sum(r["near_edited"] for r in rows[:59]) / 59 > 0.5


def test_edges(spark):
    df = docs(spark, EDGES)
    rows = edited_fingerprints(clashing(df)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in df.collect())
    assert edited_fingerprints(df.limit(0)).count() == 0
    only = edited_fingerprints(docs(spark, ["just one document"])).first()
    assert only["near_next"] == 1
