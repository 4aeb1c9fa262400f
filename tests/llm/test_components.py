import random

from starload.llm.components import components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    return {(x, find(x)) for x in root}


def test_paths_stars_and_random_graphs(spark):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 501 + i) for i in range(60)]
    several = [(rng.randrange(1000, 1080), rng.randrange(1000, 1080)) for _ in range(50)]
    shuffled = [rng.sample(e, 2) for e in path + star]
    edges = [tuple(e) for e in shuffled] + [(-7, 7), (7, -7), (-7, 7)]
    edges += [(u, v) for u, v in several if u != v]
    df = spark.createDataFrame(edges, "u long, v long")
    assert {tuple(r) for r in components(df).collect()} == brute(edges)


def test_no_edges(spark):
    df = spark.createDataFrame([(3, 3)], "u long, v long")
    assert components(df).count() == 0
    assert components(df.limit(0)).count() == 0
