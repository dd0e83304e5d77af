import random

import pytest

from conftest import rows
from tallyroute.llm import line_dedup as L

ODD = [(1, "a b c d e f g\nx y z"), (2, "a b c d e f h\nx y z\n\n"), (3, "a b c d e f\nq a b c d e f g"),
       (4, None), (5, ""), (6, "x y w"), (None, "a b c d e f g"), (None, None),
       (7, "a b c d e f g h i j\na b X d e f g"), (7, "a b c d e f g h i j\na b X d e f g"),
       (8, "k a b c d e f g h i j"), (9, "b c d e f g"), (10, "c a b d e f g"),
       (11, "\n  \n\nx  y\n" + "w " * 4000), (12, "w " * 4001), (13, "v " + "w " * 3999)]


def run(spark, data):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in data],
                               "doc_id long, text string, line int, lines_gone int, version int")
    return rows(L.digest(L.dedup_lines(df)))


def test_odd_rows(spark):
    assert run(spark, ODD) == sorted(L.brute_force(ODD), key=lambda r: tuple(map(str, r)))
    assert run(spark, []) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_lines_match_brute_force(spark, seed):
    """Few words and many near lines, so that halves, variants and roles meet in every way."""
    rng = random.Random(seed)
    data = []
    for doc_id in rng.sample(range(500), 40):
        lines = []
        for _ in range(rng.randint(0, 6)):
            base = ["a"] * rng.randint(3, 9) if rng.random() < 0.5 else list("abcdefgh")
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(base))
                change = rng.choice(["put", "cut", "swap"])
                if change == "put":
                    base.insert(at, rng.choice("abx"))
                elif change == "cut" and len(base) > 1:
                    del base[at]
                else:
                    base[at] = rng.choice("abxy")
            lines.append(" ".join(base))
        data.append((doc_id, "\n".join(lines)))
    assert run(spark, data) == sorted(L.brute_force(data), key=lambda r: tuple(map(str, r)))


def test_columns_stay(spark):
    df = spark.createDataFrame([(1, "a\na", "en", 3)], "doc_id long, text string, lang string, n_chars long")
    out = L.dedup_lines(df, added=("before", "gone"))
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "before", "gone"]
    assert rows(out) == [(1, "a", "en", 3, 2, 1)]


def test_many_lines_in_one_text(spark):
    """The time of a text follows its lines, not their square."""
    import time

    def text(n, start):
        return "\n".join(f"line {k % (n // 2)} of a text {start + k % 7}" for k in range(n))

    took = []
    for n in (2_000, 100_000):
        df = spark.createDataFrame([(1, text(n, 0)), (2, text(n // 10, 3))], "doc_id long, text string")
        started = time.time()
        found = {r["doc_id"]: (r["lines_read"], r["lines_gone"]) for r in L.dedup_lines(df).collect()}
        took.append(time.time() - started)
        assert found[1][0] == n and found[1][1] > n // 3
    assert took[1] < 60


def test_marks_of_many_lines(spark):
    lines = [f"w{k} x y z v{k}" for k in range(70_000)]
    lines[40_000], lines[69_999], lines[33_000] = lines[3], lines[5], ""
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, None)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in L.dedup_lines(df).collect()}
    kept = [x for k, x in enumerate(lines) if k not in (40_000, 69_999)]
    assert out[1]["text"] == "\n".join(kept) and out[1]["lines_gone"] == 2
    assert out[2]["text"] is None and out[2]["lines_gone"] == 0
