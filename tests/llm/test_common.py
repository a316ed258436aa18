import random

import pytest

from roadledger.llm.common import components


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components_name_the_smallest_node(spark, kind):
    rng = random.Random(3)
    edges = {"chain": [(k, k + 1) for k in range(40)], "star": [(99, k) for k in range(50, 98)], "none": [(5, 5)],
             "random": [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]}[kind]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}
