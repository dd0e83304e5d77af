import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyroute.llm import spelling as S

SCHEMA = "doc_id long, text string, word string, n int, form double, key string"


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows, letters=6, occurrences=5, one_in=199, factor=5):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    words = {w: n for w, n in seen.items() if len(w) >= letters and n >= occurrences}
    linked = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if near(a, b):
            linked[a].append(b)
            linked[b].append(a)
    forms = {}
    for w, others in linked.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= factor * words[w]:
                forms[w] = best

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return sorted((w, forms.get(w), root(w), n, len(linked[w]), words.get(forms.get(w)))
                  for w, n in words.items())


def run(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(i, t, "x", 1, 2.0, "y") for i, t in rows], SCHEMA)
    return sorted(tuple(r) for r in S.variants(df.repartition(parts), **options).collect())


def edited(rng, word):
    letters = list("abcdeinorstéü×")
    k = int(rng.integers(0, len(word)))
    new = letters[int(rng.integers(0, len(letters)))]
    return [word[:k] + word[k + 1:], word[:k] + new + word[k:], word[:k] + new + word[k + 1:]][
        int(rng.integers(0, 3))]


def corpus(rng, stems, documents):
    words = list(stems)
    for word in stems:
        one = edited(rng, word)
        words += [one, edited(rng, one), edited(rng, word)]
    weights = rng.pareto(0.7, len(words)) + 0.05
    weights /= weights.sum()
    return [(int(i), " ".join(str(w).title() if rng.random() < 0.1 else str(w)
                              for w in rng.choice(words, 400, p=weights)) + ".")
            for i in range(documents)]


def test_words_with_variants(spark):
    rng = np.random.default_rng(5)
    stems = ["correction", "collection", "connection", "überlegung", "naïvetés",
             "banana", "bananas", "aaaaaaaa", "aaaaaaa", "abababab", "internet", "interned"]
    rows = corpus(rng, stems, 40)
    assert run(spark, rows, one_in=7) == brute(rows, one_in=7)
    assert any(r[2] != r[1] and r[1] for r in run(spark, rows, one_in=7))  # chains of forms


def test_short_alphabets_where_all_bigrams_are_common(spark):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("ab"), int(rng.integers(6, 10)))) for _ in range(1500)]
    rows = [(i, " ".join(words[i::10])) for i in range(10)]
    assert run(spark, rows, occurrences=2, factor=2) == brute(rows, occurrences=2, factor=2)


def test_odd_rows(spark):
    rows = [(None, "spelling " * 6), (1, None), (2, ""), (2, "speling " * 5), (2, "spelling\n"),
            (3, "x" * 3_000_000 + " spelling" + "中" * 900_000 + "speling SPELING"),
            (4, "1spelling2spelling-Spelling_Éspelling")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[1:3]) == [] and run(spark, []) == []


def test_a_form_with_very_many_words(spark):
    middle = "intermediate"
    others = sorted({middle[:k] + c + middle[k + 1:] for k in range(len(middle))
                     for c in "abcdefghijklmnopqrstuvwxyz"} - {middle})
    rows = [(k, f"{w} " * 5) for k, w in enumerate(others)] + [(-1, f"{middle} " * 40)]
    found = run(spark, rows, one_in=10**12)
    assert found == brute(rows, one_in=10**12)
    assert {r[2] for r in found} == {middle}


LETTERS = st.text("abcé", min_size=6, max_size=9)


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS, min_size=2, max_size=14, unique=True), st.data())
def test_near_words_always_meet(words, data):
    for word in list(words):
        k = data.draw(st.integers(0, len(word) - 1))
        words += [word[:k] + word[k + 1:], word[:k] + "b" + word[k:], word[:k] + "c" + word[k + 1:]]
    words = sorted({w for w in words if len(w) >= 6})
    grams = Counter(g for w in words for g in map("".join, zip(w, w[1:])))
    ordered = sorted(grams.items(), key=lambda x: (x[1], x[0]))
    ranks = {g: (k, n) for k, (g, n) in enumerate(ordered)}
    signed = {w: S.signature(w, ranks) for w in words}
    for a, b in combinations(words, 2):
        if near(a, b):
            first, second = sorted((a, b), key=lambda w: signed[w][0])
            assert set(signed[first][1]) & set(signed[second][2])


def test_pivots_share_no_letter_and_weigh_least():
    rng = np.random.default_rng(7)
    for _ in range(300):
        size = int(rng.integers(3, 9))
        places = sorted(rng.choice(12, size, replace=False).tolist())
        weights = rng.integers(1, 9, size).tolist()
        chosen = S.pivots_of(places, weights)
        weight = dict(zip(places, weights))
        want = min(weight[a] + weight[b] for a, b in combinations(places, 2) if b - a > 1)
        assert chosen[1] - chosen[0] > 1 and sum(weight[p] for p in chosen) == want


def test_plan_joins_by_equality(spark):
    words = spark.createDataFrame([("spelling", 9), ("speling", 7)], "word string, n long")
    plan = S.near_pairs(words)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert S.near_pairs(words).select(F.col("a")).first()[0] == "speling"
