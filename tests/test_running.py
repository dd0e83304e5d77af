"""Chunked running columns must equal a plain loop, whatever the size of a key."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.operators import running
from tallyroute.operators.running import dense_index, running_by


def brute(data, with_sum=True):
    groups = {}
    for key, day, ident, value in data:
        groups.setdefault(key, []).append((day is None, day or 0, ident, value, day))
    out = []
    for key, members in groups.items():
        total, last = 0, None
        for n, (_, _, ident, value, day) in enumerate(sorted(members, key=lambda m: m[:3]), 1):
            out.append((key, day, ident, value, n, last, total))
            total, last = total + value, value
    return sorted(out, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("sample,heavy,pieces", [
    (1 << 16, 16, 1024), (1 << 16, 2, 5), (150, 3, 40), (1 << 16, 10**6, 8)])
def test_running_matches_loop(spark, monkeypatch, sample, heavy, pieces):
    monkeypatch.setattr(running, "SAMPLE", sample)
    monkeypatch.setattr(running, "HEAVY", heavy)
    monkeypatch.setattr(running, "PIECES", pieces)
    rng = random.Random(7)
    # one key holds a third of all rows, one group has a NULL key, some days are NULL
    data = [(1 if n % 3 == 0 else rng.choice([None, 2, 3, 4, 5]),
             rng.choice([None, *range(20)]), n, rng.randrange(9)) for n in range(300)]
    df = spark.createDataFrame(data, "k BIGINT, day INT, id BIGINT, v BIGINT")
    found = running_by(df, ["k"], ["day", "id"], number="n",
                       previous={"last": "v"}, sums={"before": "v"})
    assert rows(found) == brute(data)


def test_a_key_on_one_day_is_cut(spark):
    """All rows share the key and the first order column; only the id tells them apart."""
    df = spark.range(0, 40_000, 1, 4).select(
        F.lit(1).alias("k"), F.lit(None).cast("date").alias("day"),
        (F.xxhash64("id") * 0 + F.col("id") * F.col("id")).alias("id"), (F.col("id") % 7).alias("v"))
    found = running_by(df, ["k"], ["day", "id"], number="n", sums={"before": "v"})
    total = found.agg(F.max("n"), F.max("before"), F.countDistinct("n")).first()
    assert total[0] == total[2] == 40_000 and total[1] == sum(i % 7 for i in range(39_999))
    wrong = found.where("id != (n - 1) * (n - 1)")
    assert wrong.count() == 0


def test_no_job_runs_while_the_plan_is_built(spark):
    df = spark.range(100).withColumn("bad", F.raise_error(F.lit("ran")).cast("int"))
    running_by(df, ["bad"], ["id"], number="n")


@pytest.mark.parametrize("n", [0, 1, 8, 5000])
def test_dense_index_of_sparse_ids(spark, n):
    rng = random.Random(n)
    ids = sorted({rng.randrange(-2**62, 2**62) for _ in range(n)})
    df = spark.createDataFrame([(i,) for i in rng.sample(ids, n)], "id BIGINT")
    assert sorted(tuple(r) for r in dense_index(df, "id", "n").select("n", "id").collect()) == list(
        enumerate(ids))


@pytest.mark.parametrize("heavy,pieces,slots", [(2, 5, 1 << 14), (3, 40, 60), (1, 300, 1 << 14)])
def test_cut_keys_match_loop(spark, monkeypatch, heavy, pieces, slots):
    """Every row may be a bound, so that keys are cut into many pieces."""
    monkeypatch.setattr(running, "RATE", 1)
    monkeypatch.setattr(running, "SLOTS", 1)
    monkeypatch.setattr(running, "SAMPLE", slots)
    monkeypatch.setattr(running, "HEAVY", heavy)
    monkeypatch.setattr(running, "PIECES", pieces)
    rng = random.Random(heavy)
    data = [(1 if n % 3 == 0 else rng.choice([None, 2, 3]), rng.choice([None, *range(20)]), n,
             rng.randrange(9)) for n in range(400)]
    df = spark.createDataFrame(data, "k BIGINT, day INT, id BIGINT, v BIGINT")
    held = running._heavy_keys(df, ["k"], ["day", "id"]).select(F.size("__bounds")).collect()
    assert max(r[0] for r in held) >= 5
    found = running_by(df, ["k"], ["day", "id"], number="n",
                       previous={"last": "v"}, sums={"before": "v"})
    assert rows(found) == brute(data)


def test_more_partitions_allow_more_pieces(spark, monkeypatch):
    monkeypatch.setattr(running, "RATE", 1)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    df = spark.range(120_000).select(F.lit(1).alias("k"), "id")
    try:
        spark.conf.set(name, "3000")
        plan = running._heavy_keys(df, ["k"], ["id"])
    finally:
        spark.conf.set(name, before)
    assert 1500 < plan.select(F.size("__bounds")).first()[0] <= 3000
