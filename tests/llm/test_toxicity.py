import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyroute.llm import toxicity as X
from tallyroute.llm import words as W
from tallyroute.llm.queries import fold

MEAN = {"en": ["vile", "scummy"], "fr": ["bête", "crasseux"]}


def corpus(n, seed=1):
    rng = random.Random(seed)
    rest = [f"{a}{b}" for a in ("the", "lo", "ma", "ri", "que", "sten") for b in ("na", "ti", "rou", "mel")]
    docs, labels = [], []
    for k in range(n):
        lang = rng.choice(["en", "fr"])
        toxic = int(rng.random() < 0.25)
        words = [rng.choice(rest) for _ in range(rng.randint(5, 60))]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(MEAN[lang]) + rng.choice(["", "r", "sten"]))
        docs.append((k, " ".join(words), lang))
        labels.append((k, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus(1500)
    df = spark.createDataFrame([(*d, 0, 1) for d in docs],
                               "doc_id long, text string, lang string, toxic int, draw int")
    marks = spark.createDataFrame([(*m, "x") for m in labels] + [(1, None, "x"), (None, 1, "x"),
                                                                 (2, 7, "x"), (99999, 1, "x")],
                                  "doc_id long, toxic int, text string")
    return df, dict(labels), X.learn(df, marks, fold() != 1)


def test_held_out_rows_are_told_apart(spark, trained):
    df, labels, net = trained
    found = X.score(df, net).withColumn("held", fold() == 1).where("held").collect()
    right = [(r["score"] >= 0.7) == (labels[r["doc_id"]] == 1) for r in found]
    assert len(found) > 300 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    assert set(net.thresholds) == {"", "en", "fr"}


def test_scores_depend_on_the_text_alone(spark, trained):
    _, _, net = trained
    odd = [(1, None, "en"), (2, "", None), (3, " .. ", "xx"), (None, "vile vile", None),
           (4, "vile vile", "fr"), (4, "vile vile", "en"), (5, "thena " * 50_000 + "scummy vile", "en")]
    df = spark.createDataFrame([(*r, "s") for r in odd], "doc_id long, text string, lang string, other string")
    found = X.score(df, net, "__s").select("text", "lang", "__s",
                                           X.threshold(net, F.col("lang")).alias("t")).collect()
    by_text = {}
    for r in found:
        by_text.setdefault(r["text"] if r["text"] and r["text"].strip(" .") else "", set()).add(r["__s"])
        assert 0.5 <= r["t"] <= 0.9
    assert all(len(v) == 1 for v in by_text.values())
    assert min(by_text["vile vile"]) > 0.7 > max(by_text[""])
    assert X.score(df.limit(0), net).count() == 0


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert X.learn(docs, labels) is None
    assert X.learn(docs, labels.limit(0)) is None
    assert X.score(docs, None).first()["score"] == 0.0


def test_pooling_over_pieces_is_pooling_over_texts():
    """A text's filters never see the words of its neighbour."""
    rng = np.random.default_rng(2)
    net = X._start([np.zeros((1, 5), np.int32)], np.array([1]), 3)
    net.embed[:] = rng.normal(0, 1, net.embed.shape)
    texts = ["a b c", "", "d", "e f", "g h i j", ""]

    def pooled(column):
        return np.concatenate([net.pooled(*X.features(p)) for p in W.pieces(pa.array(column))])

    together = pooled(texts)
    for k, text in enumerate(texts):
        assert np.allclose(together[k], pooled([text])[0], atol=1e-5)
        buckets, counts = X.features(next(W.pieces(pa.array([text]))))
        if counts[0]:
            for n, span in enumerate(X.SPANS):
                best = net.responses(net.vectors(buckets), span).max(axis=0) + net.bias[span]
                assert np.allclose(np.maximum(best, 0),
                                   together[k, n * X.FILTERS:(n + 1) * X.FILTERS], atol=1e-5)


def test_a_repeated_id_gives_one_text(spark):
    docs = spark.createDataFrame([(1, f"text {k}", "en") for k in range(50)] + [(2, "b", None)],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    table, totals = X.sample(docs, labels)
    got = sorted(zip(*(table[name].to_pylist() for name in ("doc_id", "text", "lang", "label"))))
    assert got == [(1, "text 0", "en", 1), (2, "b", None, 0)] and totals == {0: 1, 1: 1}


def plain_score(net, text):
    """The network's score by loops over words, filters and steps."""
    piece = next(W.pieces(pa.array([text or ""])))
    buckets, _ = X.features(piece)
    vectors = [sum(net.embed[b].astype(float) for b in row) for row in buckets.tolist()]
    logit, place = net.base, 0
    for span in X.SPANS:
        for f in range(X.FILTERS):
            values = [sum(float(vectors[p + s] @ net.filters[span][s][:, f])
                          for s in range(span) if p + s < len(vectors))
                      for p in range(len(vectors))]
            best = max(max(values) + float(net.bias[span][f]), 0.0) if values else 0.0
            logit += best * float(net.out[place])
            place += 1
    return 1 / (1 + np.exp(-np.clip(logit * net.scale + net.shift, -30, 30)))


def test_query_matches_plain_scores(spark):
    import os

    from tallyroute.llm.queries import QUERIES, table

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    docs = table(spark, folder, "documents")
    net = X.learn(docs, table(spark, folder, "labels"), fold() != 1)
    found = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, folder).collect()}
    short = [r for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 2500]
    assert len(found) == docs.count() and len(short) > 50
    for r in short:
        score = plain_score(net, r["text"])
        assert found[r["doc_id"]]["score"] == pytest.approx(score, abs=1e-4)
        assert found[r["doc_id"]]["predicted"] == int(found[r["doc_id"]]["score"] >= 0.7)


@pytest.mark.parametrize("size", [1, 7, 40, 1000])
def test_a_long_text_part_by_part_gives_the_same_values(trained, monkeypatch, size):
    net = trained[2]
    odd = ["vile", "a b", "thena " * 30 + "scummy vile", "x" * 200 + " vile scummy lona", " . ", "vile " * 50]
    whole = [net.pooled(*X.features(next(W.pieces(pa.array([t]))))) for t in odd]
    monkeypatch.setattr(W, "PIECE", size)
    for text, want in zip(odd, whole):
        found = net.pooled_long(next(W.pieces(pa.array([text]), 1 << 20)))
        assert np.allclose(found, want, atol=1e-5)
        assert np.allclose(net.piece_scores(next(W.pieces(pa.array([text]), 1 << 20))),
                           X._logistic((want @ net.out + net.base) * net.scale + net.shift), atol=1e-5)


LONG = """
import resource, sys
import numpy as np, pyarrow as pa
from tallyroute.llm import toxicity as X, words as W
net = X._start([np.zeros((1, 5), np.int32)], np.array([1]), 1)
column = pa.array(["vile lona quesna " * (int(sys.argv[1]) // 17)])
held = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for piece in W.pieces(column):
    net.piece_scores(piece)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - held) >> 10)
"""


def test_memory_does_not_follow_a_long_text():
    root = str(Path(X.__file__).resolve().parents[2])
    grown = int(subprocess.run([sys.executable, "-c", LONG, str(32 << 20)], cwd=root, check=True,
                               capture_output=True, text=True).stdout)
    assert grown < 200  # MB; the text alone has 32


def test_all_labelled_rows_are_learnt_from(spark, monkeypatch):
    """Words of a few rows count, in a text of any length and whatever the number of tasks."""
    docs, labels = corpus(6000, seed=5)
    late = [(k, "thena " * (20_000 if k < 10_003 else 5) + "zuzzel", "en") for k in range(10_000, 10_012)]
    docs = spark.createDataFrame(docs + late, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels + [(k, 1) for k, _, _ in late], "doc_id long, toxic int")
    monkeypatch.setattr(X, "ROWS", 2000)
    net = X.learn(docs, marks)
    asked = spark.createDataFrame([(1, "thena zuzzel"), (2, "thena")], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in X.score(asked, net).collect()}
    assert found[1] > 0.5 > found[2]
    table, totals = X.sample(docs, marks)
    assert sum(totals.values()) == len(table) == 6012


def test_a_score_does_not_depend_on_the_place_of_its_text():
    rng = np.random.default_rng(3)
    net = X._start([np.zeros((1, 5), np.int32)], np.array([1]), 3)
    net.embed[:] = rng.normal(0, 1, net.embed.shape)
    net.out[:] = rng.normal(0, 1, net.out.shape)
    texts = [f"w{k} vile lona w{k % 7}" for k in range(200)]
    alone = [float(net.piece_logits(next(W.pieces(pa.array([t]))))[0]) for t in texts]
    for first in (0, 1, 2, 3, 5):
        together = net.piece_logits(next(W.pieces(pa.array(["x y z"] * first + texts))))
        assert together[first:].tolist() == alone
