import random

import numpy as np
import pytest

from conftest import rows
from tallyroute.llm import simhash_dedup as S


def data(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["É", "Abc"]
    out = []
    for k in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 30, 300]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append((len(out) * 3 + 7, rng.choice([" ", "\n ", "\t"]).join(copy)))
    return out + [(1000, None), (5, "  "), (16, out[3][1]), (16, out[3][1]), (None, out[0][1]),
                  (900, "w1 " * 5000), (901, "W1 " * 5000)]


@pytest.mark.parametrize("distance,blocks", [(4, 7), (0, 2), (10, 12)])
def test_groups_match_brute_force(spark, distance, blocks):
    known = data(distance)
    df = spark.createDataFrame([(*r, 1, 2) for r in known],
                               "doc_id long, text string, fingerprint int, component_id int")
    found = S.digest(S.near_duplicates(df, distance=distance, blocks=blocks))
    if distance:
        assert rows(found) == sorted(S.brute_force(known, distance=distance),
                                     key=lambda r: tuple(map(str, r)))
    else:
        assert found.count() == len(known)


def test_empty_table_and_too_few_blocks(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0
    with pytest.raises(ValueError):
        S.near_duplicates(df, blocks=4)


def test_a_large_group_gives_a_forest_only():
    rng = np.random.default_rng(1)
    members = np.unique(np.array([1 << int(a) | 1 << int(b) for a, b in
                                  rng.integers(0, 64, (3000, 2))], dtype=np.uint64))
    links = S._forest(members, 4)
    assert len(links) == len(members) - 1
    assert all((a ^ b).bit_count() <= 4 for a, b in links)


def everything(numbers, differing):
    return np.ones(len(numbers), bool)


def test_links_survive_any_cut_into_batches():
    import pyarrow as pa

    keys = np.array([1, 1, 1, 2, 3, 3, 4, 4, 4, 4])
    values = np.array([0, 1, 2**40 - 1, 5, 6, 7, 8, 9, 10, 11], np.int64)
    whole = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)],
                                       names=["key", "fingerprint"])

    def linked(batches, most=float("inf")):
        out, handed = [], []
        for b in S._links(4, everything, most)(iter(batches)):
            for one, other, key in zip(*(b[n].to_pylist() for n in ("a", "b", "key"))):
                (out if key is None else handed).append((one, other) if key is None else (key, one))
        return {x for p in out for x in p}, len(out), sorted(handed)

    for cut in range(11):
        for later in range(cut, 11):
            batches = [whole[:cut], whole[cut:later], whole[later:]]
            assert linked(batches) == linked([whole])
            assert linked(batches, 2) == linked([whole], 2)
    assert linked([whole], 2)[2] == [(1, 0), (1, 1), (1, 2**40 - 1), (4, 8), (4, 9), (4, 10), (4, 11)]


@pytest.mark.parametrize("most", [2, 50, 10**6])
def test_large_meetings_are_dealt_out_again(spark, most):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 3, dtype=np.uint64)
    prints = set()
    for k in range(1500):  # three groups of near copies, and prints of their own
        flips = sum(1 << int(b) for b in set(rng.integers(0, 64, int(rng.integers(0, 6))).tolist()))
        prints.add(int(centre[k % 3]) ^ flips)
    prints |= {int(x) for x in rng.integers(0, 2**63, 300, dtype=np.uint64)}
    values = sorted(p - (p >> 63 << 64) for p in prints)
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    links = [tuple(r) for r in S.near_links(df, most=most).collect()]
    assert len(links) == len({frozenset(p) for p in links})
    group = {v: v for v in values}

    def root(v):
        while group[v] != v:
            group[v] = group[group[v]]
            v = group[v]
        return v

    for a, b in links:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
        group[max(root(a), root(b))] = min(root(a), root(b))
    found = [root(v) for v in values]
    array = np.array(values).view(np.uint64)
    for k, v in enumerate(values):
        near = np.flatnonzero(np.bitwise_count(array ^ array[k]) <= 4)
        assert {found[n] for n in near} == {found[k]}
