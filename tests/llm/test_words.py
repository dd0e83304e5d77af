import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyroute.llm import words as W


def texts(seed, n=60, alphabet="ab é\t\nZ9.　"):
    rng = random.Random(seed)
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return ["", *out, None, "", " ", "last"]


@pytest.mark.parametrize("limit", [1, 20, 1 << 20])
def test_spans_are_the_words_of_each_text(limit):
    rows = texts(1)
    for table, pattern in ((W.NOT_SPACE, "[^\\x20\\x09-\\x0D]+"),
                           (W.ALNUM, "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")):
        found = [[] for _ in rows]
        for piece in W.pieces(pa.array(rows), limit):
            raw = piece.data.tobytes()
            for start, end, text in zip(*W.spans(piece, table)):
                found[piece.first + text].append(raw[start:end].decode())
        assert found == [re.findall(pattern, t or "") for t in rows]


def test_pieces_respect_slices_and_cover_all_rows():
    column = pa.array(texts(2))[5:40]
    covered = [k for piece in W.pieces(column, 25) for k in range(piece.first, piece.last)]
    assert covered == list(range(len(column)))


def test_equal_words_hash_alike_and_others_do_not():
    piece = next(W.pieces(pa.array(["aa bb aa", "bb a a aaa " + "a" * 40])))
    starts, ends, _ = W.spans(piece, W.NOT_SPACE)
    raw = piece.data.tobytes()
    by_word = {}
    for s, e, h in zip(starts, ends, W.word_hashes(piece.data, starts, ends).tolist()):
        by_word.setdefault(raw[s:e], set()).add(h)
    assert all(len(v) == 1 for v in by_word.values())
    assert len(set.union(*by_word.values())) == len(by_word)


@pytest.mark.parametrize("which", [0, 1])
def test_rolling_hash_depends_on_the_window_alone(which):
    rng = np.random.default_rng(3)
    values = W.mix(rng.integers(0, 3, 400).astype(np.uint64))
    seen = {}
    for k, h in enumerate(W.rolling(values, 5, which).tolist()):
        seen.setdefault(tuple(values[k:k + 5].tolist()), set()).add(h)
    assert all(len(v) == 1 for v in seen.values())
    assert len(set.union(*seen.values())) == len(seen)
    assert len(W.rolling(values[:4], 5, which)) == 0


@pytest.mark.parametrize("width", [1, 2, 3, 7, 8, 35])
def test_sliding_min(width):
    values = np.random.default_rng(4).integers(0, 99, 60)
    assert W.sliding_min(values, width).tolist() == [
        values[k:k + width].min() for k in range(len(values) - width + 1)]


def twins(size):
    """Two words that no sum of byte values times powers of an odd base tells apart."""
    one = "".join("ab"[k.bit_count() % 2] for k in range(size))
    return one, one.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [512, 1024, 2048])
def test_words_that_mirror_each_other_hash_differently(size):
    piece = next(W.pieces(pa.array([" ".join(twins(size))]), 1 << 20))
    starts, ends, _ = W.spans(piece, W.NOT_SPACE)
    for which in (0, 1):
        one, other = W.word_hashes(piece.data, starts, ends, which)
        assert one != other


def test_hashes_do_not_depend_on_slices(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 90))) for _ in range(200)]
    piece = next(W.pieces(pa.array([" ".join(words), "x" * 700]), 1 << 20))
    starts, ends, _ = W.spans(piece, W.NOT_SPACE)
    whole = [W.word_hashes(piece.data, starts, ends, k) for k in (0, 1)]
    assert not set(whole[0].tolist()) & set(whole[1].tolist())
    for size in (1, 7, 100):
        monkeypatch.setattr(W, "SLICE", size)
        assert all((W.word_hashes(piece.data, starts, ends, k) == whole[k]).all() for k in (0, 1))


def test_span_hashes_are_sums_of_powers_whatever_the_slices(monkeypatch):
    rng = random.Random(6)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 40))) for _ in range(60)]
    piece = next(W.pieces(pa.array([" ".join(words), "x" * 300, "ab ab"]), 1 << 20))
    starts, ends, _ = W.spans(piece, W.NOT_SPACE)
    raw = piece.data.tobytes()

    def plain(low, high):
        total = sum((b + 1) * pow(W.BYTE_BASE, k, 1 << 64) for k, b in enumerate(raw[low:high]))
        return W.mix(np.array([(total + high - low) % (1 << 64)], np.uint64))[0]

    want = [[plain(s, min(e, s + size)) for s, e in zip(starts.tolist(), ends.tolist())]
            for size in (1000, 4, 7)]
    for size in (1, 5, 64, 1 << 18):
        monkeypatch.setattr(W, "SLICE", size)
        assert (W.span_hashes(piece.data, starts, ends, (4, 7)) == np.array(want, np.uint64)).all()


@pytest.mark.parametrize("limit", [1, 3, 10, 1000])
def test_parts_cut_between_words(limit):
    text = " ab  cde\tf " + "g" * 30 + " hi"
    piece = next(W.pieces(pa.array([text]), 1 << 20))
    found = list(W.parts(piece, W.NOT_SPACE, limit))
    assert b"".join(p.data.tobytes() for p in found).decode() == text
    assert [w for p in found for w in p.data.tobytes().decode().split()] == text.split()
    assert all(len(p.data) <= max(limit, 32) for p in found)
    assert not list(W.parts(next(W.pieces(pa.array([""]))), W.NOT_SPACE, limit))


@pytest.mark.parametrize("which", [0, 1])
def test_rolling_hashes_do_not_depend_on_slices(monkeypatch, which):
    values = W.mix(np.arange(300, dtype=np.uint64))
    for length in (1, 5, 50, 300):
        whole = W.rolling(values, length, which)
        for size in (1, 7, 100, 251):
            monkeypatch.setattr(W, "SLICE", size)
            assert (W.rolling(values, length, which) == whole).all()
        monkeypatch.undo()
