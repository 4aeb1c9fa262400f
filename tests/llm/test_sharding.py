import heapq
import random
import zlib
from collections import defaultdict

import pytest
from helpers import EDGES, clashing, docs
from pyspark.sql import functions as F

from starload.llm.sharding import assign, op11_sharding, schedule, with_shards, write_shards


def singly(sizes, shards):
    """Loads after scheduling every group by itself."""
    heap = [(0, shard) for shard in range(shards)]
    for size in sorted(sizes, reverse=True):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
    return [load for load, _ in sorted(heap, key=lambda entry: entry[1])]


@pytest.mark.parametrize("seed", range(60))
def test_runs_give_the_loads_of_single_groups(seed):
    rng = random.Random(seed)
    shards = rng.choice([1, 2, 3, 7, 24])
    top = rng.choice([2, 10, 500])
    runs = {rng.randint(1, top): rng.choice([1, 2, 5, 60, 400]) for _ in range(rng.randint(0, 30))}
    if seed % 3 == 0:
        runs[top * 1000] = 1  # outweighs all others
    shares, loads = schedule(runs.items(), shards)
    assert loads == singly([size for size, n in runs.items() for _ in range(n)], shards)
    again = [0] * shards
    for size, ends, owners in shares:
        assert ends == sorted(ends) and ends[-1] == runs[size] and len(set(owners)) == len(owners)
        for low, high, owner in zip([0, *ends], ends, owners):
            again[owner] += size * (high - low)
    assert again == loads


def test_groups_that_weigh_nothing():
    shares, loads = schedule([(0, 5), (4, 1)], 3)
    assert loads == [4, 0, 0]
    assert dict((size, ends) for size, ends, _ in shares) == {0: [5], 4: [1]}


def brute(rows, shards, overhead=8):
    groups = defaultdict(int)
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + overhead
    return singly(groups.values(), shards)


def check(rows, got, shards):
    loads, slots, homes = [0] * shards, defaultdict(list), defaultdict(set)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())))
    found = defaultdict(list)
    for r in got:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[r["size"], r["text_crc32"]].add(r["shard"])
        found[r["doc_id"]].append((r["size"], r["text_crc32"]))
    assert loads == brute(rows, shards)
    assert {i: sorted(v) for i, v in found.items()} == {i: sorted(v) for i, v in texts.items()}
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_against_single_scheduling(spark, shards):
    rng = random.Random(shards)
    texts = EDGES + ["hot" * 50] * 150 + [f"text {i % 120} " + "é" * rng.randint(0, 9) for i in range(300)]
    df = docs(spark, texts)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    check(rows, assign(clashing(df), shards=shards).collect(), shards)


def test_reruns_agree(spark):
    df = docs(spark, EDGES + [f"text {i % 40}" for i in range(100)])
    assert sorted(map(str, assign(df).collect())) == sorted(map(str, assign(df).collect()))


def test_a_hot_text_has_a_shard_of_its_own(spark):
    df = docs(spark, ["much " * 100] * 200 + [f"small {i}" for i in range(300)])
    got = assign(df, shards=4)
    hot = {r["shard"] for r in got.where("size > 100").collect()}
    assert len(hot) == 1
    assert got.where(F.col("shard") == hot.pop()).count() == 200


def test_files_hold_every_row_once(spark, tmp_path):
    df = clashing(docs(spark, EDGES + [f"text {i % 40}" for i in range(100)]))
    folder = f"{tmp_path}/shards"
    write_shards(df, folder, shards=5)
    back = spark.read.parquet(folder)
    assert back.columns == [*df.columns, "shard"]
    # The partition column is the last in the files.
    assert sorted(map(str, back.drop("shard").collect())) == sorted(map(str, df.collect()))
    per_text = back.groupBy(F.coalesce("text", F.lit(""))).agg(F.count_distinct("shard").alias("n"))
    assert per_text.where("n > 1").count() == 0


def test_a_column_of_the_name_is_an_error(spark):
    with pytest.raises(ValueError):
        with_shards(docs(spark, ["a"]).withColumn("shard", F.lit(1)))


def test_empty_table(spark):
    df = docs(spark, EDGES).limit(0)
    assert assign(df).count() == 0
    assert with_shards(df).count() == 0


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = op11_sharding(spark, sf_dir)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check([(r["doc_id"], r["text"]) for r in df.collect()], got.collect(), 24)
