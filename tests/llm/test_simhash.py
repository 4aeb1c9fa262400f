import random
import re

import xxhash
from helpers import EDGES, clashing, docs

from starload.llm import simhash as module
from starload.llm.simhash import fingerprints, links, near_groups, simhash


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    spans = [words[i : i + 4] for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def unsigned(x):
    return x % 2**64


def test_fingerprint_against_definition(spark):
    texts = EDGES + ["one two three four five Six SEVEN eight nine ten", "a b", "a b c d"]
    for t in texts:
        t = t[1] if isinstance(t, tuple) else t
        assert unsigned(simhash(t or "")) == brute_fingerprint(t)
    df = clashing(docs(spark, texts))
    got = {r["doc_id"]: unsigned(r["fp"]) for r in fingerprints(df).collect() if r["doc_id"]}
    for r in df.collect():
        if r["doc_id"]:
            assert got[r["doc_id"]] == brute_fingerprint(r["text"])


def brute_groups(fps, distance):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (unsigned(a) ^ unsigned(b)).bit_count() <= distance:
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {frozenset(y for y in fps if find(y) == find(x)) for x in fps}


def linked(edges, fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        ra, rb = sorted((find(u), find(v)))
        root[rb] = ra
    return {frozenset(y for y in fps if find(y) == find(x)) for x in fps}


def near_fingerprints(seed, count, spread):
    rng = random.Random(seed)
    out = set()
    while len(out) < count:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 8])):
            near = centre
            for bit in rng.sample(range(64), rng.randint(0, spread)):
                near ^= 1 << bit
            out.add(near - 2**64 if near >> 63 else near)
    return sorted(out)


def test_links_lose_nothing(spark):
    for distance in (1, 3, 4, 7):
        fps = near_fingerprints(distance, 250, distance + 2)
        df = spark.createDataFrame([(f,) for f in fps], "fp long")
        edges = [tuple(r) for r in links(df, distance).collect()]
        assert linked(edges, fps) == brute_groups(fps, distance)


def test_heavy_keys_lose_nothing(spark):
    rng = random.Random(5)
    fps = set()
    while len(fps) < 300:
        near = 0
        for bit in rng.sample(range(64), rng.randint(0, 6)):
            near ^= 1 << bit
        fps.add(near - 2**64 if near >> 63 else near)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = [tuple(r) for r in links(df, 4, heavy=3).collect()]
    assert linked(edges, fps) == brute_groups(fps, 4)
    assert len(set(edges)) < 20_000


def test_exploded_keys_are_not_broadcast(spark, plan, monkeypatch):
    plans, write = {}, module.materialize

    def kept(df, label="table"):
        plans[label] = plan(df)
        return write(df, label)

    monkeypatch.setattr(module, "materialize", kept)
    fps = near_fingerprints(9, 100, 5)
    df = write(spark.createDataFrame([(f,) for f in fps], "fp long"))
    edges = [tuple(r) for r in links(df, 4).collect()]
    assert linked(edges, fps) == brute_groups(fps, 4)
    # Few fingerprints, so Spark would take each side for small; the keys without "dense" have no
    # size of their own.
    assert "SortMergeJoin" in plans["links"]
    assert not re.search(r"BroadcastHashJoin [^\n]*Inner", plans["links"])


def test_groups_of_documents(spark):
    rng = random.Random(1)
    base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(50)) for _ in range(400)]
    texts = list(EDGES)
    for i in range(60):
        words = list(base)
        for _ in range(i % 6):
            words[rng.randrange(400)] = "changed"
        texts.append(" ".join(words))
    df = docs(spark, texts)
    rows = near_groups(clashing(df)).collect()
    assert len(rows) == len(texts)
    fps = sorted({r["fp"] for r in rows})
    lowest = {}
    for group in brute_groups(fps, 4):
        ids = [r["doc_id"] for r in rows if r["fp"] in group and r["doc_id"] is not None]
        for f in group:
            lowest[f] = min(ids) if ids else None
    assert all(r["component_id"] == lowest[r["fp"]] for r in rows)


def test_empty_table(spark):
    assert near_groups(docs(spark, EDGES).limit(0)).count() == 0
