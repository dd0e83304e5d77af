import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as P
from tallyroute.llm import bpe, decontaminate, line_dedup, simhash_dedup
from tallyroute.llm.store import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, version int"
TEST = "the quick brown fox jumps over the lazy dog while nobody is watching"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("so", "ne", "ta", "ri") for b in ("lo", "mi", "ker", "pan", "du")]
    docs, labels = [], []
    for k in range(400):
        said = [rng.choice(words) for _ in range(rng.randint(1, 80))]
        toxic = int(k % 4 == 0)
        if toxic:
            said[rng.randrange(len(said))] = "vilest"
        docs.append([k, " ".join(said), rng.choice(["en", "fr", None]), "s"])
        labels.append((k, toxic))
    for k in range(401, 440, 2):
        docs.append([k, docs[k - 401][1], "en", None])
    docs += [[500, "so lo\n" + TEST + "\nmi", "en", "s"], [501, None, "en", "s"], [502, "", "en", "s"],
             [None, "no id at all", "en", "s"], [503, "ta ri ne so pan\n" * 30, "en", "s"],
             [1, docs[1][1], docs[1][2], "s"]]
    at = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(*d, len(d[1] or ""), 1) for d in docs], SCHEMA).write.parquet(
        f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, TEST)], "item_id long, text string").write.parquet(
        f"{at}/benchmark.parquet")
    return str(at)


def test_stages_do_what_they_say(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES:
        before = [tuple(r)[:2] for r in docs.select("doc_id", "text").collect()]
        out = stored(stage(spark, docs, folder), name)
        if name != "byte_bpe":
            assert out.columns == docs.columns
        kept[name] = (before, [tuple(r)[:2] for r in out.select(*out.columns[:2]).collect()], out)
        docs = out

    before, after, _ = kept["toxicity"]
    gone = {i for i, _ in before} - {i for i, _ in after}
    toxic = {i for i, text in before if text and "vilest" in text}
    assert len(toxic - gone) <= 2 and not gone - toxic

    before, after, out = kept["line_dedup"]
    want = sorted((i, h) for i, _, _, h in line_dedup.brute_force(before) if i is not None)
    assert sorted((i, hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t in after if i is not None) == want
    assert out.where("n_chars <> length(text)").count() == 0

    before, after, _ = kept["simhash_dedup"]
    stay = {i for i, _, c in simhash_dedup.brute_force(before) if i == c}
    assert sorted(map(str, (i for i, _ in after))) == sorted(map(str, stay | {None}))

    before, after, _ = kept["decontaminate"]
    hit = {r[0] for r in decontaminate.brute_force(before, [(1, TEST)]) if r[5]}
    assert {i for i, _ in before} - {i for i, _ in after} == hit and 500 in hit

    before, after, out = kept["byte_bpe"]
    coder = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = {i: hashlib.sha256(np.array(coder.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest()
            for i, t in before}
    assert {r["doc_id"]: r["ids_sha256"] for r in out.collect()} == want
    assert P.run(spark, folder).count() == len(before)


def test_empty_corpus(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, folder), f"empty-{name}")
        assert docs.count() == 0
