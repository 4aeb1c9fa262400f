import random
from collections import defaultdict

import duckdb
import pytest
from helpers import EDGES, clashing, docs

from starload.llm.mixing import OP2_SQL, mix, mix_table, source_targets
from starload.tables import materialize


def shared(sizes, weights, total, most):
    """Targets by sharing the excess again until none is above its stop."""
    target, open_sources = {}, dict(weights)
    left = total * sum(sizes.values())
    while open_sources:
        each = left / sum(open_sources.values())
        over = [s for s, w in open_sources.items() if each * w > most * sizes[s]]
        if not over:
            return target | {s: each * w for s, w in open_sources.items()}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            del open_sources[s]
    return target


def some_docs(spark, seed, n=400, sources="abcdeé\U0001f600"):
    rng = random.Random(seed)
    texts = [" ".join(["w"] * rng.choice([0, 1, 5, 40, 300])) for _ in range(n)]
    names = [rng.choice(sources[:2] if rng.random() < 0.5 else sources) for _ in range(n)]
    names[0] = None
    return docs(spark, texts, names)


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken(spark, seed):
    df = some_docs(spark, seed)
    rows = mix_table(clashing(df)).collect()
    assert len(rows) == 400
    source = {r["doc_id"]: r["source"] for r in df.collect()}
    sizes, taken, target, longest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        longest[s] = max(longest[s], r["size"])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = shared(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(target[s] - taken[s]) <= longest[s] / 2 + 1
        assert abs(target[s] - taken[s]) < max(0.01 * target[s], 41)
        assert all(r["source_size"] == sizes[s] for r in rows if source[r["doc_id"]] == s)
    assert sorted(rows) == sorted(mix_table(df.repartition(7)).collect())


@pytest.mark.parametrize("seed", range(2))
def test_few_long_documents(spark, seed):
    """A source whose one long document outweighs what is lacking behind the others."""
    texts = [(seed, "w " * 30_000), *[(100 + 10 * seed + i, "w " * 900) for i in range(3)]]
    rows = mix_table(docs(spark, texts), weights=(1,), total=26_350 / 32_700).collect()
    assert rows[0]["target"] == pytest.approx(26_350)
    assert sum(r["taken"] for r in rows) in (30_000, 30_900, 31_800, 32_700)


@pytest.mark.parametrize("total, taken", [(1.5, 600), (1.3, 500), (0.2, 100)])
def test_equal_rows_are_drawn_singly(spark, total, taken):
    """Four equal rows of 100 words: as many as come nearest to the target."""
    df = docs(spark, [(7, "w " * 100)] * 4)
    rows = mix_table(df, weights=(1,), total=total).collect()
    assert len(rows) == 4 and sum(r["taken"] for r in rows) == taken
    assert mix(df, weights=(1,), total=total).count() == taken // 100
    more = df.unionByName(docs(spark, [(7, "v " * 100)] * 3 + ["u"] * 50))
    table = mix_table(more, weights=(1,), total=total).collect()
    assert mix(more, weights=(1,), total=total).count() == sum(r["copies"] for r in table)
    assert abs(sum(r["taken"] for r in table) - 750 * total) <= 51


def test_sql_twin(spark):
    alike = docs(spark, ["w w w"] * 120, [f"s{i % 20:02d}" for i in range(120)])
    equal = docs(spark, [(7, "w " * 100)] * 4)
    long = docs(spark, [(1, "w " * 30_000), *[(i, "w " * 900) for i in (2, 3, 4)]])
    for df in (some_docs(spark, 9, 200), alike, equal, long):
        con = duckdb.connect()
        con.register("documents", df.toPandas())
        got = sorted(tuple(r) for r in mix_table(df).collect())
        assert got == sorted(con.execute(OP2_SQL).fetchall())


def test_pareto_order_follows_the_weights(spark):
    from pyspark.sql import functions as F

    df = docs(spark, ["w " * 10] * 3000).withColumn("worth", F.col("doc_id") % 3 + 1)
    rows = mix_table(df, weight_col="worth", weights=(1,), total=0.5).collect()
    taken = [sum(r["copies"] for r in rows if r["doc_id"] % 3 == k) / 1000 for k in range(3)]
    assert sum(taken) == pytest.approx(1.5, abs=0.01)
    for k in range(3):
        assert taken[k] == pytest.approx(0.25 * (k + 1), abs=0.05)


def test_stopped_weights_are_shared_again(spark):
    from pyspark.sql import functions as F

    heavy = F.when(F.col("doc_id") < 100, 50).otherwise(1)
    df = docs(spark, ["w w"] * 1000).withColumn("worth", heavy)
    rows = mix_table(df, weight_col="worth", weights=(1,), total=1.0).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(2000, abs=2)
    assert all(r["copies"] == 2 for r in rows if r["doc_id"] < 100)


def test_edges_and_rows(spark):
    df = clashing(docs(spark, EDGES, ["a", None] * (len(EDGES) // 2)))
    table = mix_table(df)
    assert table.count() == len(EDGES)
    mixed = mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r["copies"] for r in table.collect())
    assert mix_table(df.limit(0)).count() == 0 == mix(df.limit(0)).count()


def test_sources_without_words(spark):
    df = docs(spark, ["", None, "a b"], ["x", "y", "z"])
    rows = materialize(mix_table(df), "t").collect()
    assert {r["doc_id"]: r["target"] for r in rows} == {0: 0.0, 1: 0.0, 2: 3.0}
    assert source_targets(df.limit(0).selectExpr("source", "n_chars size")).count() == 0
