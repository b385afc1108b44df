import random

from threadlens.llm.components import components


def union_find(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def test_paths_stars_and_random_graphs(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find([(a, b) for a, b in edges if a != b])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
