import math
from itertools import islice

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroute.llm import multi_index as M

SCHEMA = "vec_id long, embedding array<double>, id int, cell string, score double"


def brute(data, k=5):
    """Cosine of every query with every row, summed like the operator's."""
    kept = [(i, v) for i, v in data if i is not None and v is not None and any(v)
            and all(x is not None and math.isfinite(x) for x in v)]
    width = max([len(v) for _, v in kept], default=0)
    matrix = np.array([list(v) + [0.0] * (width - len(v)) for _, v in kept])
    ids = np.array([i for i, _ in kept])
    asked = {}
    for i, v in kept:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        others = matrix[ids != q]
        one = np.array([list(v) + [0.0] * (width - len(v))] * len(others)).reshape(-1, width)
        scores = M.cosines(one, others)
        top = sorted(zip((-scores).tolist(), ids[ids != q].tolist()))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(top)]
    return sorted(out)


def run(spark, data, parts=3, **options):
    df = spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in data], SCHEMA)
    return sorted(tuple(r) for r in M.search(
        df.repartition(parts), F.col("vec_id") % 50 == 0, **options).collect())


def floats(values):
    return [float(x) for x in values]


def recall(found, want):
    hits = {r[::2] for r in found} & {r[::2] for r in want}
    near = {(r[0], r[2]) for r in found} & {(r[0], r[2]) for r in want}
    return len(near) / len(want), hits


def test_recall_on_grouped_and_on_unstructured_vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (20, 16))
    grouped = [(int(i), floats(centres[i % 20] + rng.normal(0, 0.1, 16))) for i in range(3000)]
    loose = [(int(i), floats(rng.normal(0, 1, 16))) for i in range(3000)]
    for data in (grouped, loose):
        found, want = run(spark, data), brute(data)
        assert len(found) == len(want) and recall(found, want)[0] >= 0.9
        scores = {(q, i): s for q, _, i, s in brute(data, 3000)}
        assert all(scores[q, i] == s for q, _, i, s in found)  # the very same doubles
        assert [r[1] for r in found] == [r[1] for r in want]


def test_copies_share_a_score_and_go_by_id(spark):
    rng = np.random.default_rng(9)
    hot = floats(rng.normal(0, 1, 7))
    data = [(i, hot) for i in range(0, 3000, 3)]
    data += [(i, floats(rng.normal(0, 1, 7))) for i in range(1, 2000, 3)]
    assert recall(run(spark, data), brute(data))[0] >= 0.9
    everything = run(spark, data, recall=1.0)
    assert [r for r in everything if r[0] % 3 == 0] == [r for r in brute(data) if r[0] % 3 == 0]
    assert {r[3] for r in everything if r[0] % 3 == 0} == {everything[0][3]}


def test_rows_that_take_no_part_and_odd_lengths(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (50, [nan, 1.0]), (1, [inf, 1.0]), (2, None), (3, [None, 1.0]),
            (None, [9.0, 9.0]), (4, [1.0]), (5, []), (6, [1.0, 2.0, 3.0]), (7, [-1.0, -1.0]),
            (9, [0.0, 0.0]), (100, [1.0, 0.0]), (100, [0.0, 1.0]), (8, [1.0, 2.0]),
            (8, [1.0, 2.0]), (150, [1e300, 2e300]), (10, [1e-300, 2e-300])]
    assert run(spark, data, recall=1.0) == brute(data)
    assert len(run(spark, data)) == len(brute(data))
    assert run(spark, data[1:6]) == [] and run(spark, []) == []
    assert run(spark, data[:1]) == []


def test_many_rows_with_the_query_s_own_id(spark):
    data = [(0, [1.0, 0.01 * k]) for k in range(300)] + [(k, [-1.0, 0.1 * k]) for k in (1, 2, 3)]
    assert [r[2] for r in run(spark, data, k=3)] == [r[2] for r in brute(data, 3)]


def test_walk_gives_pairs_by_summed_distance():
    rng = np.random.default_rng(10)
    for rows, columns in ((1, 1), (1, 7), (9, 1), (13, 8), (30, 30)):
        one, two = rng.integers(0, 9, rows) / 4, rng.random(columns)
        found = list(M.walk(one, two))
        totals = (one[:, None] + two).reshape(-1)
        assert sorted(cell for _, cell in found) == list(range(rows * columns))
        assert [t for t, _ in found] == sorted(totals.tolist())
        assert all(totals[cell] == t for t, cell in found)
        assert list(islice(M.walk(one, two), 3)) == found[:3]


@pytest.mark.parametrize("enough", [0, 1, 40, 10**9])
def test_reach_holds_enough_rows_and_whole_distances(enough):
    rng = np.random.default_rng(11)
    one, two = rng.integers(0, 5, 12) / 2, rng.integers(0, 5, 9) / 2
    sizes = rng.integers(0, 4, 108)
    last, cells = M.reach(one, two, sizes.tolist(), enough)
    totals = (one[:, None] + two).reshape(-1)
    assert sorted(cells) == np.flatnonzero((totals <= last) & (sizes > 0)).tolist()
    assert sizes[cells].sum() >= min(enough, sizes.sum())


def test_query_against_all_rows(spark):
    import os

    from tallyroute.llm.queries import QUERIES

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    data = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    found = [tuple(r) for r in QUERIES["op11_multi_index"](spark, folder).collect()]
    want = brute(data)
    assert len(found) == len(want) and recall(found, want)[0] >= 0.9
    scores = {(q, i): s for q, _, i, s in brute(data, len(data))}
    assert all(scores[q, i] == s for q, _, i, s in found)
