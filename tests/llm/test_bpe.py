import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from conftest import rows
from tallyroute.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coder():
    return bpe.encoding(RANKS, PATTERN)


def test_cuts_do_not_change_the_ids(coder):
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(" \t\n　\x85'ab1é!s") for _ in range(rng.randint(0, 40)))
        size = rng.randint(1, 6)
        parts = list(bpe.parts(text, size))
        assert "".join(parts) == text
        ids = [i for part in parts for i in coder.encode_ordinary(part)]
        assert ids == coder.encode_ordinary(text), text


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 1_500_000 + "end", "word and " * 30_000,
                                  "\n" * 100_000])
def test_very_long_texts_come_back(coder, text):
    ids = bpe.encode_text(coder, text)
    assert coder.decode_bytes(ids.tolist()) == text.encode()


def test_deep_white_space_goes_by_single_matches(coder):
    text = "a  \n\n  b " + " " * 2000 + "c é1"
    by_match = [i for m in bpe.regex.finditer(PATTERN, text)
                for i in coder._encode_single_piece(m.group())]
    assert by_match == coder.encode_ordinary(text)


def test_round_trip_of_odd_rows(spark, coder):
    texts = [(1, "Héllo <|endoftext|> 😀 wörld"), (2, None), (3, ""), (3, "twice"), (3, "twice"),
             (None, "no id"), (4, "  \n ")]
    df = spark.createDataFrame(
        [(*r, "x", 9) for r in texts], "doc_id long, text string, ids string, n_tokens int")
    want = []
    for doc_id, text in texts:
        ids = coder.encode_ordinary(text or "")
        raw = (text or "").encode()
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(raw).hexdigest()))
    assert rows(bpe.round_trip(df, RANKS, PATTERN)) == sorted(
        want, key=lambda r: tuple(map(str, r)))
    assert bpe.round_trip(df.limit(0), RANKS, PATTERN).count() == 0


def test_ids_that_end_inside_a_character_decode_to_raw_bytes(spark, coder):
    half = coder.encode_ordinary("😀")[:1]
    df = spark.createDataFrame([(1, 1, bytearray(np.array(half, "<u4").tobytes())),
                                (2, 0, None)], "doc_id long, n_tokens long, ids binary")
    found = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(df, RANKS, PATTERN).collect()}
    assert found == {1: coder.decode_bytes(half), 2: b""}
