import random

from finseries.llm.components import components


def test_random_graphs_against_union_find(spark):
    for seed in range(3):
        rng = random.Random(seed)
        n = 60
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
        links += [(500, x) for x in range(501, 560)] + [(None, 3), (7, None)]
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x
        for a, b in links:
            if a is not None and b is not None and a != b:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
        want = {x: min(y for y in parent if find(y) == find(x)) for x in parent}
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
