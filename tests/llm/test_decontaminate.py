import hashlib
import random

import pytest

from conftest import rows
from tallyroute.llm import decontaminate as D

SCHEMA = "doc_id long, text string, item_id int, terms string"


def texts(rng, n, longest, words=("a", "B", "c1", "é", "dd")):
    return ["".join(rng.choice(words) + rng.choice([" ", ", ", "\n"])
                    for _ in range(rng.randint(0, longest))) for _ in range(n)]


def data(seed):
    rng = random.Random(seed)
    docs = [(k, t) for k, t in enumerate(texts(rng, 40, 60))]
    docs += [(50, None), (51, ""), (52, "..."), (1, docs[2][1]), (3, docs[3][1]),
             (None, docs[4][1]), (53, "a b " * 3000)]
    items = [(k, t) for k, t in enumerate(texts(rng, 25, 9))]
    items += [(100, None), (101, ""), (None, docs[5][1]), (7, "a b"), (7, "dd dd"),
              (102, "a B " * 12), (103, docs[6][1])]
    return docs, items


@pytest.mark.parametrize("window,part", [(10, 1 << 20), (4, 60), (1, 1 << 20)])
def test_hits_match_brute_force(spark, window, part):
    docs, items = data(window)
    df = spark.createDataFrame([(*r, 1, "t") for r in docs], SCHEMA)
    tests = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, doc_id int")
    path = D.scratch_path(spark, "test-postings")
    found = D.search(D.build_index(df, path), tests, window=window, part_bytes=part)
    got = D.digest(found.withColumn("n_hit", D.hit_words()))
    want = D.brute_force(docs, items, window)
    assert rows(got) == sorted(want, key=lambda r: tuple(map(str, r)))


def test_empty_tables(spark):
    docs, items = data(1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert D.contamination(df.limit(0), tests).count() == 0
    clean = D.contamination(df, tests.limit(0))
    assert clean.where("n_hit > 0 OR size(items) > 0").count() == 0
    assert clean.count() == len(docs)


def test_proximity_matches(spark):
    docs = [(1, "one two three four five"), (2, "one two x three four five"),
            (3, "one two x y z three four five"), (4, "two one three five four"),
            (5, "one two three four six"), (6, "x x one two three five four")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(9, "ONE two three four five")], "item_id long, text string")
    found = {r["doc_id"]: (r["items"], r["near"])
             for r in D.contamination(df, tests, window=5, slack=1).collect()}
    assert found == {1: (["9"], []), 2: ([], ["9"]), 3: ([], []), 4: ([], ["9"]), 5: ([], []),
                     6: ([], ["9"])}


def test_digest_names_proximity_matches_beside_exact_ones(spark):
    docs = [(1, "one two three four five"), (2, "one two x three four five"), (3, "six")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(9, "one two three four five")], "item_id long, text string")
    found = D.contamination(df, tests, window=5, slack=1)
    got = {r["doc_id"]: (r["n_items"], r["contaminated"], r["n_near"], r["near_sha256"])
           for r in D.digest(found, near=True).collect()}
    none, nine = (hashlib.sha256(s).hexdigest() for s in (b"", b"9"))
    assert got == {1: (1, True, 0, none), 2: (0, False, 1, nine), 3: (0, False, 0, none)}


@pytest.mark.parametrize("slack", [1, 2])
def test_proximity_matches_brute_force_in_any_cut(spark, monkeypatch, slack):
    rng = random.Random(slack)
    words = ("a", "b", "c", "d", "e", "f")
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 14)))) for k in range(60)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for k in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(rng.choice([1, 3]))
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"]: set(r["items"]) | set(r["near"])
             for r in D.contamination(df, tests, window=4, slack=slack).collect()}
    for doc_id, text in docs:
        assert found[doc_id] == {str(i) for i, item in items
                                 if D.brute_force_near(text, item, 4, slack)}, text


def test_words_that_mirror_each_other_are_different_words(spark):
    from llm.test_words import twins

    docs = [(k, f"a b c {word} d e f g h i") for k, word in enumerate(twins(1024))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(9, docs[0][1])], "item_id long, text string")
    got = rows(D.digest(D.contamination(df, tests)))
    assert [(r[0], r[2]) for r in got] == [(0, 10), (1, 0)]
