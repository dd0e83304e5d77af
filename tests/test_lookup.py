"""Left joins to a side with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.operators import lookup


def brute(left, right):
    out = []
    for key, who in left:
        met = [v for k, v in right if k is not None and k == key]
        out += [(key, who, v) for v in met] or [(key, who, None)]
    return sorted(out, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_keys_lonely_rows_and_nulls(spark, seed):
    rng = random.Random(seed)
    left = [(rng.choice([None, 0, 1, 2, 3, 50]), n) for n in range(60)]
    right = [(0 if n % 3 else rng.randrange(40), n % 5) for n in range(900)]  # equal rows too
    right += [(None, 7)] * 300 + [(1, None)] * 200
    a = spark.createDataFrame(left, "k INT, who INT")
    b = spark.createDataFrame(right, "k INT, v INT")
    hot = {r["k"]: r["__pieces"] for r in lookup.hot_keys(b, ["k"]).collect()}
    assert hot[0] > hot.get(1, 1) >= 1 and None not in hot and len(hot) < 6
    assert rows(lookup.many_left_join(a, b, ["k"])) == brute(left, right)


def test_pieces_follow_the_share_of_a_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.col("id").cast("string")).alias("k"), "id")
    found = lookup.hot_keys(df, ["k"]).collect()
    wanted = lookup.SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [(r["k"], r["__pieces"]) for r in found] == [("hot", -(-wanted // 3))]


def test_a_hot_key_of_equal_rows_is_spread_and_several_columns_join(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (1, None)], "a INT, b STRING")
    right = spark.range(4000).select(
        F.lit(1).alias("a"), F.lit("x").alias("b"), F.lit(5).alias("v"))
    joined = lookup.many_left_join(left, right, ["a", "b"])
    assert joined.columns == ["a", "b", "v"]
    assert rows(joined.groupBy("a", "b").agg(F.count("v"), F.count(F.lit(1)))) == sorted(
        [(1, "x", 4000, 4000), (1, None, 0, 1), (2, "y", 0, 1)], key=lambda r: tuple(map(str, r)))


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    none = spark.createDataFrame([], "a INT, v INT")
    assert rows(lookup.many_left_join(left, none, ["a"])) == [(1, "x", None)]
    assert lookup.many_left_join(left.limit(0), none, ["a"]).count() == 0
