import random

import pytest

from conftest import rows
from tallyroute.llm.components import components


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted((x, root(x)) for x in parent)


def chain(n, seed):
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return list(zip(order, order[1:]))


CASES = {
    "chain": chain(300, 1),
    "star": [(500, k) for k in range(200)] + [(k, k) for k in range(600, 605)],
    "mixed": [(random.Random(k).randint(0, 150), random.Random(-k).randint(0, 150))
              for k in range(90)] * 2,
    "nulls": [(1, None), (None, 2), (3, 3), (5, 4)],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_components_match_union_find(spark, name):
    edges = CASES[name]
    df = spark.createDataFrame(edges, "a long, b long")
    assert rows(components(df)) == sorted(union_find(edges), key=lambda r: tuple(map(str, r)))


def test_text_nodes(spark):
    df = spark.createDataFrame([("b", "c"), ("c", "a")], "a string, b string")
    assert rows(components(df)) == [("a", "a"), ("b", "a"), ("c", "a")]
