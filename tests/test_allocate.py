"""Round robin, balanced groups, quotas and the manager climb against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.operators import allocate, running


def test_round_robin(spark):
    df = spark.createDataFrame([(i,) for i in (30, 10, 20, 50, 40)], "id BIGINT")
    found = allocate.round_robin(df, "id", [7, 8])
    assert rows(found) == [(10, 7), (20, 8), (30, 7), (40, 8), (50, 7)]
    assert rows(allocate.round_robin(df, "id", [7, 8], limit=2)) == [(10, 7), (20, 8)]


def quota_loop(requests, pool):
    left = {}
    for owner, item in sorted(pool, key=lambda p: p[1]):
        left.setdefault(owner, []).append(item)
    out = []
    for row, owner, quota in sorted(requests):
        stock = left.get(owner, [])
        out += [(row, owner, item) for item in stock[:quota]]
        left[owner] = stock[quota:]
    return sorted(out, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("heavy", [10_000, 5])
def test_quota_against_loop(spark, heavy, monkeypatch):
    monkeypatch.setattr(running, "HEAVY", heavy)
    monkeypatch.setattr(allocate, "SLOT_BLOCK", 3)
    rng = random.Random(3)
    pool = [(1 if n % 3 == 0 else rng.randrange(6), n) for n in range(240)]
    requests = [(r, 1 if r % 3 == 0 else rng.randrange(7), rng.choice([1, 2, 5, 9, 400]))
                for r in range(60)]
    taken, ranges = allocate.quota_allocate(
        spark.createDataFrame(requests, "row BIGINT, owner BIGINT, quota BIGINT"),
        spark.createDataFrame(pool, "owner BIGINT, item BIGINT"),
        "owner", "quota", "row", "item")
    assert rows(taken.select("row", "owner", "item")) == quota_loop(requests, pool)
    assert ranges.count() == len(requests)


@pytest.mark.parametrize("heavy", [10_000, 4])
def test_balanced_against_loop(spark, heavy, monkeypatch):
    monkeypatch.setattr(running, "HEAVY", heavy)
    rng = random.Random(5)
    data = [("hot" if n % 3 == 0 else rng.choice("ab"), rng.randrange(30), n,
             rng.choice([1, 2, 3, None])) for n in range(150)]
    owners = [1, 2, 9]
    expected = []
    for group in {d[0] for d in data}:
        members = sorted(d for d in data if d[0] == group)
        held = [d for d in members if d[3] in owners]
        keep = max(held, key=lambda d: (d[1], d[2])) if held else None
        turn = 0
        for member in sorted(members, key=lambda d: (d[1], d[2])):
            if member is keep:
                expected.append((member[2], member[3], True))
            else:
                expected.append((member[2], owners[turn % 3], False))
                turn += 1
    df = spark.createDataFrame(data, "g STRING, day INT, id BIGINT, holder INT")
    found = allocate.balanced_reassign(
        df, ["g"], "holder", owners, "day", "id")
    assert rows(found.select("id", "new_owner", "kept")) == sorted(
        expected, key=lambda r: tuple(map(str, r)))


def test_climb(spark):
    # 1 -> 2 -> 3(ok); 4 <-> 5 cycle; 6 -> missing; 7 ok itself; 8 -> 1
    data = [(1, 2, False), (2, 3, False), (3, None, True), (4, 5, False), (5, 4, False),
            (6, 99, None), (7, 3, True), (8, 1, False), (9, 9, False)]
    df = spark.createDataFrame(data, "user BIGINT, boss BIGINT, ok BOOLEAN")
    found = allocate.climb_hierarchy(df, "user", "boss", F.col("ok"), -1)
    assert rows(found) == sorted([(1, 3), (2, 3), (3, 3), (4, -1), (5, -1), (6, -1), (7, 7),
                                  (8, 3), (9, -1)], key=lambda r: tuple(map(str, r)))


def test_long_chain_with_cycle_and_gap(spark):
    """A chain of 5,000 people, a cycle of 300, and a chain whose top is missing."""
    chain = [(n, n - 1 if n else None) for n in range(5000)]
    cycle = [(10_000 + n, 10_000 + (n + 1) % 300) for n in range(300)]
    gap = [(20_000 + n, 20_000 + n - 1) for n in range(1, 50)]
    df = spark.createDataFrame(chain + cycle + gap, "id BIGINT, boss BIGINT")
    found = allocate.climb_hierarchy(df, "id", "boss", F.col("id") == 0, -1)
    assert found.where("id < 10000 AND responsible <> 0").count() == 0
    assert found.where("id >= 10000 AND responsible <> -1").count() == 0
    assert found.count() == len(chain + cycle + gap)
