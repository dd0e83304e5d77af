"""Spelling variants of a corpus' words, found by pivotal grams.

Words are the runs of Latin letters of whole texts.  Two words are *near* if they differ by exactly
one inserted, deleted or replaced code point.  A word's *form* is its near word with the most
occurrences, if that has enough more of them; its *root* is where the forms end.

*Pivotal grams.*  The bigrams of all words are ordered by the number of words' places they stand
at, rarest first.  A word's *prefix* holds its three rarest bigrams (and all that are as rare as the
third).  Among these, dynamic programming chooses two that share no letter and are rarest together,
the *pivots*.  One edit touches at most one of two such bigrams, so the other still stands in the
near word; and as it is no more common than the end of its word's prefix, it stands in the prefix of
the near word, if that prefix ends at least as late in the order.  Hence a near pair always meets
where the pivots of the word whose prefix ends first are looked up among the prefixes of the others.

*Position limits.*  The one edit lies before or behind the pivot that is left.  In the first case
the letters behind it are the same, in the second those before it; its place differs by one at most.
Of the side with the edit, the letters at its beginning or those at its end are the same too, for
as many as fit in twice.  So a pivot is looked up under its bigram, the side and the end that are the
same, their letters, and one of the three lengths the other word can have: a join by equality, in
which words meet that are near or almost.  What meets is verified by its edit distance.

Defined results: NULL texts hold no words, a NULL id counts as empty text in the checksum.  Rows that
share an id are rows of their own.  Texts are read in segments cut behind other characters, so
memory follows the longest run of letters, not the longest text.  A word without near words has
none, no form, and itself as root.  Ties go to the smallest word in code-point order.  Empty
tables give no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm import words as W
from tallyroute.llm.store import map_arrow, stored

#: letters of a word in UTF-8: A-Z, a-z, and the code points C0 to FF
LETTER = rb"(?:[A-Za-z]|\xC3[\x80-\xBF])"
#: an ASCII character that is no letter; a segment of a long text may end behind it
BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
SEGMENT = 1 << 20
#: distinct words a task counts before it hands them on
HELD = 1 << 16
LOWER = bytes(W.LOWER)
#: modulus and base of the hashes of letters, odd multipliers that join hashes to keys
PRIME, BASE = (1 << 61) - 1, 0x5851F42D4C957F2D
MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xBF58476D1CE4E5B9)
#: bigrams in a prefix: two for the edit and one more; bigrams chosen among them
PREFIX, PIVOTS = 3, 2


def segments(data: memoryview) -> Iterator[memoryview]:
    start = 0
    while start < len(data):
        stop = start + SEGMENT
        if stop < len(data):
            found = BREAK.search(data, stop)
            stop = found.end() if found else len(data)
        yield data[start:stop]
        start = stop


def word_of(run: bytes, check: int, one_in: int) -> bytes:
    """The lower-cased ``run``, without one code point if its checksum says so."""
    if check % one_in:
        return run
    letters = run.decode()
    gone = check % len(letters)
    return (letters[:gone] + letters[gone + 1:]).encode()


def _occurrences(least: int, one_in: int):
    runs = re.compile(LETTER + b"{%d,}" % least)

    def counted(totals: Counter) -> pa.RecordBatch:
        words = [w.decode() for w in totals]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(list(totals.values()), pa.int64())],
            names=["word", "n"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            ids = batch["id"].to_pylist()
            for piece in W.pieces(batch["text"]):
                data = memoryview(piece.data)
                for k in range(len(piece)):
                    text = data[piece.offsets[k]:piece.offsets[k + 1]]
                    start = zlib.crc32(f"{ids[piece.first + k] or ''}:".encode())
                    for segment in segments(text):
                        for run, n in Counter(runs.findall(segment)).items():
                            run = run.translate(LOWER)
                            word = word_of(run, zlib.crc32(run, start), one_in)
                            totals[word] += n
                        if len(totals) >= HELD:
                            yield counted(totals)
                            totals = Counter()
        yield counted(totals)
    return rows


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text: str = "text", letters: int = 6,
               occurrences: int = 5, one_in: int = 199) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough."""
    named = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    counted = map_arrow(named, _occurrences(letters, one_in), "word string, n long")
    return (
        counted.where(F.length("word") >= letters).groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= occurrences))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: Counter = Counter()
    for batch in batches:
        for word in batch["word"].to_pylist():
            totals.update(map("".join, zip(word, word[1:])))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())],
        names=["gram", "n"])


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Occurrences of every bigram, rarest first: at most 90 * 90, as there are 90 letters."""
    counts = map_arrow(words.select("word"), _grams, "gram string, n long")
    ordered = counts.groupBy("gram").agg(F.sum("n").alias("n")).orderBy("n", "gram")
    return {row["gram"]: row["n"] for row in ordered.collect()}


def prefix_of(ranks: list[int]) -> list[int]:
    """Places of the rarest bigrams, in order of place."""
    last = sorted(ranks)[min(PREFIX, len(ranks)) - 1]
    return [place for place, rank in enumerate(ranks) if rank <= last]


def pivots_of(places: list[int], weights: list[int]) -> list[int]:
    """Of the bigrams at ``places``, the ``PIVOTS`` that share no letter and weigh least together.

    ``best[c]`` is the lightest choice of ``c`` bigrams that all end before the place at hand;
    choices that end at the place before it have to wait for one more step.
    """
    none = (float("inf"), ())
    best = [(0, ()), *[none] * PIVOTS]
    waiting: list[tuple[int, list]] = []
    for place, weight in zip(places, weights):
        while waiting and waiting[0][0] + 1 < place:
            best = [min(a, b) for a, b in zip(best, waiting.pop(0)[1])]
        with_it = [none] + [
            (best[c][0] + weight, best[c][1] + (place,)) if best[c] is not none else none
            for c in range(PIVOTS)]
        waiting.append((place, with_it))
    for _, choice in waiting:
        best = [min(a, b) for a, b in zip(best, choice)]
    return list(best[PIVOTS][1])


class Letters:
    """Hashes of any letters of a word that stand in a row."""

    def __init__(self, word: str) -> None:
        self.sums, self.powers = [0], [1]
        for letter in word:
            self.sums.append((self.sums[-1] * BASE + ord(letter)) % PRIME)
            self.powers.append(self.powers[-1] * BASE % PRIME)

    def hash(self, start: int, stop: int) -> int:
        return (self.sums[stop] - self.sums[start] * self.powers[stop - start]) % PRIME


def keys_of(letters: Letters, n: int, place: int, rank: int, length: int) -> list[int]:
    """Keys of the bigram at ``place`` in a word of ``n`` letters for a near word of ``length``.

    One side of the bigram has to be the same; of the other side, which has ``m`` letters in the
    near word, the first ``(m - 1) // 2`` or as many last ones, since one edit spares one of them.
    """
    found = []
    for side, same, other in ((0, (0, place), (place + 2, n)), (1, (place + 2, n), (0, place))):
        m = other[1] - other[0] + length - n
        if m < 0:
            continue
        half = max(0, m - 1) // 2
        kept = letters.hash(*same)
        for end, at in ((0, other[0]), (1, other[1] - half)):
            kind = ((rank * 2 + side) * 2 + end) * MIX[0] + length * MIX[1]
            key = (kind + kept * MIX[2] + letters.hash(at, at + half) * MIX[3]) & W.MASK
            found.append(key - (1 << 64) if key >> 63 else key)
    return found


def signature(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[int, list[int], list[int]]:
    """End of the prefix, keys its pivots are looked up by, and keys its prefix is found by."""
    known = [ranks[gram] for gram in map("".join, zip(word, word[1:]))]
    places = prefix_of([rank for rank, _ in known])
    chosen = pivots_of(places, [known[p][1] for p in places])
    letters, n = Letters(word), len(word)
    asked = [key for p in chosen for length in (n - 1, n, n + 1)
             for key in keys_of(letters, n, p, known[p][0], length)]
    found = [key for p in places for key in keys_of(letters, n, p, known[p][0], n)]
    return max(known[p][0] for p in places), asked, found


def _signatures(counts: dict[str, int]):
    ranks = {gram: (rank, n) for rank, (gram, n) in enumerate(counts.items())}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signature(word, ranks) for word in batch["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["word"].cast(pa.string()), batch["n"],
                 pa.array([f[0] for f in found], pa.int32()),
                 *(pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in (1, 2))],
                names=["word", "n", "last", "asked", "found"])
    return rows


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``a_n``, ``b`` and ``b_n`` of every two near words, once each, ``a`` before ``b``."""
    signed = stored(map_arrow(
        words.select("word", "n"), _signatures(gram_counts(words)),
        "word string, n long, last int, asked array<long>, found array<long>"), "word-keys")
    pivots = signed.select(F.explode("asked").alias("key"), "last", "word", "n")
    prefixes = signed.select(F.explode("found").alias("key"), F.col("last").alias("other_last"),
                             F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = pivots.join(prefixes, "key").where(
        (F.col("last") <= F.col("other_last")) & (F.col("word") != F.col("other"))
        & (F.levenshtein("word", "other", 1) == 1))
    swap = F.col("word") > F.col("other")
    return met.select(
        *[F.when(swap, second).otherwise(F.col(first)).alias(name) for name, first, second in (
            ("a", "word", F.col("other")), ("a_n", "n", F.col("other_n")),
            ("b", "other", F.col("word")), ("b_n", "other_n", F.col("n")))]).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its forms, for every word that has a ``form``.

    A form has several times its word's occurrences, so forms end after a logarithm of the largest
    count; each round doubles the steps taken."""
    state = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(state.join(onward, "root", "left").select("word", "root", "next"), "roots")
        if step.where("next IS NOT NULL").isEmpty():
            return state
        state = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", letters: int = 6,
             occurrences: int = 5, one_in: int = 199, factor: int = 5) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word."""
    if letters < PREFIX + 1:
        raise ValueError("words need as many bigrams as a prefix holds")
    words = stored(vocabulary(docs, id_column, text, letters, occurrences, one_in), "vocabulary")
    pairs = stored(near_pairs(words), "near-words")
    both = pairs.select("a", "a_n", "b", "b_n").union(pairs.select("b", "b_n", "a", "a_n"))
    best = both.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("a_n").alias("own"),
        F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("top"))
    taken = -F.col("top.less") >= factor * F.col("own")
    near = stored(best.select(
        F.col("a").alias("word"), "n_near", F.when(taken, F.col("top.form")).alias("form"),
        F.when(taken, -F.col("top.less")).alias("form_n")), "forms")
    ends = roots(near.where("form IS NOT NULL"))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
