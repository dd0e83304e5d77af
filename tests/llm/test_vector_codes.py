import hashlib
import math

import numpy as np
import pytest

from tallyroute.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label string, code string, error int, id int"
LIMIT = 2**63 - 1


def brute(data, entries=256, parts=4, rounds=4, scale=1024):
    """Plain Lloyd rounds in Python's whole numbers; the input's order does not matter."""
    kept = [(i, v, label) for i, v, label in data if v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    width = max([len(v) for _, v, _ in kept], default=0)
    width = -(-width // parts) * parts
    size = width // parts

    def whole(v):
        out = [math.floor(scale * x) for x in v] + [0] * (width - len(v))
        return [min(max(x, -2**63), LIMIT) for x in out]

    cut = [[whole(v)[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0], kept[k][1]))
    books = [[cut[k][p] for k in first[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            met = {}
            for c in cut:
                met.setdefault(nearest(c[p], book)[1], []).append(c[p])
            for n, held in met.items():
                book[n] = [sum(x) // len(held) for x in zip(*held)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{n:02x}" for _, n in f), min(e, LIMIT), min(by_label[label], LIMIT), sha)
         for (i, _, label), f, e in zip(kept, found, errors)), key=str)


def run(spark, data, parts=3, **options):
    df = spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in data], SCHEMA)
    return sorted((tuple(r) for r in V.digest(
        *V.compress(df.repartition(parts), **options)).collect()), key=str)


def floats(values):
    return [float(x) for x in values]


def test_random_and_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    data = [(int(i), floats(rng.normal(0, 0.2, 12)), str(i % 5)) for i in range(500)]
    data += [(1000 + i, floats(rng.normal(0, 0.004, 12) + i % 4), None) for i in range(400)]
    assert run(spark, data, entries=40) == brute(data, entries=40)


def test_copies_ties_and_repeated_ids(spark):
    data = [(i, [float(i % 3), 0.0, 1.0, 0.5], "a") for i in range(300)]
    data += [(7, [9.0, 1.0, 2.0, 3.0], "a"), (7, [9.0, 1.0, 2.0, 3.0], None)]
    data += [(None, [1.0, 1.0, 1.0, 1.0], "b"), (5, [0.5, 0.0, 0.0, 0.0], "b")]
    assert run(spark, data, entries=9) == brute(data, entries=9)


def test_rows_that_are_dropped_and_odd_lengths(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, None, "a"), (2, [nan, 1.0], "a"), (3, [inf, 1.0], "a"), (4, [None, 1.0], "a"),
            (5, [], "a"), (6, [1.0], None), (7, [1.0, 2.0, 3.0, 4.0, 5.0], None),
            (8, [0.1] * 5, "c"), (9, [-0.0001] * 4, "c")]
    assert run(spark, data) == brute(data)
    assert run(spark, data[:4]) == []
    assert run(spark, []) == []
    assert run(spark, [(1, [], "a"), (2, [], None)]) == brute([(1, [], "a"), (2, [], None)])


def test_numbers_beyond_doubles(spark):
    data = [(i, [3e9 * i, -2e9, 1e300, 0.5 * i], "a") for i in range(12)]
    data += [(50 + i, [1e7 + i, 1e7 - i, -1e300, 7.25], "b") for i in range(80)]
    assert run(spark, data, entries=5) == brute(data, entries=5)


@pytest.mark.parametrize("spread", [0.0, 0.01, 1.0])
def test_trees_assign_like_a_plain_search(spread):
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (6, 5)).astype(float)
    points = centres[rng.integers(0, 6, 700)] + np.floor(rng.normal(0, 40 * spread, (700, 5)))
    book = V.Book(np.concatenate([centres, centres[:2], np.floor(rng.normal(0, 300, (25, 5)))]))
    tree = V.Tree(points, V.LEAF)
    labels, whole, single = V.assign(tree, book, book.order)
    distances = ((tree.points[:, None] - book.by_number) ** 2).sum(axis=2)
    assert labels.tolist() == distances.argmin(axis=1).tolist()
    settled = sum(int(tree.sizes(d)[nodes].sum()) for d, nodes, _ in whole)
    assert settled + single.sum() == len(points)
    assert spread or settled > 0  # copies and tight groups go as whole nodes
    for depth, nodes, numbers in whole:
        cuts = tree.cuts(depth)
        for node, number in zip(nodes, numbers):
            span = slice(cuts[node], cuts[node + 1])
            assert (labels[span] == number).all()
            assert (tree.levels[depth][2][node] == tree.points[span].sum(axis=0)).all()
