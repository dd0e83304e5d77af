import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroute.llm import block_search

SCHEMA = "vec_id long, embedding array<float>, rank int, part string"


def brute(data, k=5):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in data
             if i is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in whole:
        if i % 50 == 0:
            asked[i] = min(v, asked.get(i, v))
    out = []
    for q, a in asked.items():
        scores = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in whole if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def run(spark, data, **options):
    df = spark.createDataFrame(
        [(i, v if v is None else [x if x is None else float(x) for x in v], 1, "x")
         for i, v in data], SCHEMA)
    return sorted(tuple(r) for r in block_search.top_k(df, F.col("vec_id") % 50 == 0,
                                                       **options).collect())


def test_random_clustered_and_tied_vectors(spark):
    rng = np.random.default_rng(1)
    data = [(int(i), rng.normal(0, 0.3, 6).round(2).tolist()) for i in range(700)]
    data += [(1000 + i, [0.5, 0.5, 0, 0, 0, 0]) for i in range(120)]
    data += [(2000 + i * 7, (rng.normal(0, 0.01, 6) + (i % 3)).tolist()) for i in range(300)]
    assert run(spark, data) == brute(data)


def test_rows_that_take_no_part(spark):
    data = [(0, [1.0, 2.0]), (50, [float("nan"), 1.0]), (1, [float("inf"), 1.0]), (2, None),
            (3, [None, 1.0]), (None, [9.0, 9.0]), (4, [1.0]), (5, []), (6, [1.0, 2.0, 3.0]),
            (7, [-1.0, -1.0]), (100, [1.0, 0.0]), (100, [0.0, 1.0]), (8, [1.0, 2.0]),
            (8, [1.0, 2.0])]
    assert run(spark, data) == brute(data)
    assert run(spark, data[:1]) == []
    assert run(spark, []) == []


def test_products_beyond_double_precision(spark):
    data = [(0, [3e8, 1.0, -3e8]), (1, [3e5, 2.0, 3e5]), (2, [3e5, 3.0, 3e5]),
            (3, [-3e5, 1.0, 2.0])]
    assert run(spark, data) == brute(data)
    large = run(spark, [(0, [1e20]), (1, [1e20]), (2, [-1e20])])
    assert [r[3] for r in large] == [2**63 - 1, -2**63]


@pytest.mark.parametrize("k", [1, 3])
def test_other_numbers_of_results(spark, k):
    data = [(i, [float(i % 7), 1.0]) for i in range(120)]
    assert run(spark, data, k=k) == brute(data, k)


def test_blocks_below_the_bound_are_not_scored():
    rng = np.random.default_rng(2)
    block = 8
    vectors = np.sort(rng.integers(-9, 9, 400)).astype(float)[:, None]
    docs = block_search.Packed.__new__(block_search.Packed)
    docs.ids, docs.width, docs.vectors = np.arange(400), 1, vectors
    cuts = np.arange(0, 400, block)
    docs.low, docs.high = np.minimum.reduceat(vectors, cuts), np.maximum.reduceat(vectors, cuts)
    asked = block_search.Packed.__new__(block_search.Packed)
    asked.ids, asked.width, asked.vectors = np.array([-1]), 1, np.array([[5.0]])
    asked.low = asked.high = asked.vectors
    found, scores, scored = block_search.best(asked, docs, 5, block)
    assert scored < 5
    want = sorted((-5 * v, i) for i, v in enumerate(vectors[:, 0].tolist()))[:5]
    assert [(-s, i) for i, s in zip(found[0].tolist(), scores[0].tolist())] == want
    floor = np.array([scores[0, 2]])
    floored, kept, fewer = block_search.best(asked, docs, 5, block, floor)
    assert fewer <= scored and (kept[0] >= floor[0]).sum() == (scores[0] >= floor[0]).sum()
    assert floored[0, :3].tolist() == found[0, :3].tolist()
    assert block_search.best(asked, docs, 5, block, np.array([1e9]))[2] == 0


def test_groups_meet_only_ranges_that_they_can_reach(spark, monkeypatch):
    """Vectors far apart by id: the ranges of one corner are out of reach of the others."""
    monkeypatch.setattr(block_search, "BLOCK", 4)
    monkeypatch.setattr(block_search, "RANGE", 4)
    monkeypatch.setattr(block_search, "GROUP", 3)
    seen = []
    real = block_search.meetings

    def watched(asked, ranges, k, slots):
        kept, floors = real(asked, ranges, k, slots)
        seen.append((kept.distinct().count(), kept.count(), asked.count() * ranges.count()))
        return kept, floors

    monkeypatch.setattr(block_search, "meetings", watched)
    rng = np.random.default_rng(3)
    data = []
    for i in range(800):
        vector = rng.uniform(0, 0.1, 4)
        vector[i // 200] += 1
        data.append((i, vector.tolist()))
    assert run(spark, data) == brute(data)
    distinct, kept, of_all = seen[0]
    assert distinct == kept < of_all / 2
