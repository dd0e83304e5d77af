import random

import pytest

from conftest import rows
from tallyroute.llm import substring_dedup as S


def run(spark, data, window):
    df = spark.createDataFrame([(*r, 1, "m") for r in data],
                               "doc_id long, text string, anchor int, marks string")
    return rows(S.digest(S.remove_repeated(df, window=window)).drop("removed"))


def want(data, window):
    return sorted(S.brute_force(data, window), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("window,letters", [(3, "ab"), (6, "abc"), (20, "ab"), (50, "a")])
def test_random_texts_match_brute_force(spark, window, letters):
    rng = random.Random(window)
    data = [(k * 2, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 3 * window))))
            for k in rng.sample(range(200), 25)]
    passage = " ".join(rng.choice("xyz") for _ in range(window + 5))
    data += [(500 + k, f"p{k} {passage} q{k}\n{passage}") for k in range(15)]
    data += [(2, None), (4, ""), (6, data[0][1]), (6, data[0][1]), (6, data[1][1]),
             (None, data[0][1]), (None, None), (900, "z " * 20_000), (901, "z\t" * 19_000)]
    assert run(spark, data, window) == want(data, window)


def test_copies_lose_all_and_the_first_nothing(spark):
    text = " ".join(f"w{k}" for k in range(120))
    found = {r[0]: r[2] for r in run(spark, [(9, text), (3, text), (5, text + " more")], 50)}
    assert found == {3: 0, 5: 120, 9: 120}


def test_intervals_are_maximal(spark):
    text = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(1, text), (2, f"a b {text} c")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in S.remove_repeated(df, window=10).collect()}
    assert out[2]["removed"] == [2, 32] and out[2]["kept"] == "a b c" and out[1]["removed"] == []


def test_empty_table(spark):
    assert S.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_words_that_mirror_each_other_are_different_words(spark):
    from llm.test_words import twins

    common = " ".join(f"w{k}" for k in range(49))
    data = [(k, f"{word} {common}") for k, word in enumerate(twins(512))]
    assert [r[2] for r in run(spark, data, 50)] == [0, 0]


def test_texts_of_one_id_with_equal_short_hashes(spark):
    from pyspark.sql import functions as F

    words = F.expr("transform(sequence(1, 50), k -> concat(id, 'x', k))")
    texts = spark.range(400_000).select(F.array_join(words, " ").alias("text"))
    same = texts.groupBy(F.hash("text")).agg(F.min("text").alias("a"), F.max("text").alias("b"))
    a, b = same.where("a != b").select("a", "b").first()
    data = [(1, a), (5, a), (5, b)]
    assert run(spark, data, 50) == want(data, 50)
