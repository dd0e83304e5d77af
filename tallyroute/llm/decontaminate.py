"""Find test passages in training texts through a positional inverted index.

*Index.*  Each task cuts its texts into blocks of about 256 KB and stores one row per block:
the sorted hashes of its terms and, per term, the positions where it stands.  The table lies in
the shared folder and serves any number of test sets.  Blocks hold whole texts, so no text, term
or copy group is ever gathered from elsewhere: building and searching need no shuffle and have no
hot key.

*Search.*  The test set is a stated query set.  Its different rows are cut into parts of about
``PART_BYTES``; each part is sent to all tasks and run against every block.  Parts follow one another:
the matches of one are stored and its broadcast is given up before the next is sent, so neither the
driver nor a task ever holds more than one.  A window of consecutive words starts from the postings of
its rarest term in the block; these places, shifted by the term's offset, are intersected with
the postings of the other terms, rarer ones first.  What is left are exact phrases.  With
``slack``, a window also matches in proximity: there is a place from which on every term stands
at most that many words off its own place, in any order.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower
case; they are compared by a 64-bit hash.  Defined results: a NULL or empty text has no words and
no hits; an item of fewer words than a window is one window, an item of none never occurs; items
without an id take no part; an id given twice names all its texts; rows may repeat.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm import words as W
from tallyroute.llm.store import importable, map_arrow, stored
from tallyroute.session import scratch_path

#: bytes of test texts sent to all tasks at a time
PART_BYTES = 16 << 20
WINDOW = 10

BLOCK = ("block string, doc_ids array<long>, versions array<long>, sizes array<int>, "
         "terms binary, gaps binary")
FOUND = ("block string, row int, doc_id long, version long, n_words long, hits array<int>, "
         "items array<string>, near array<string>")


def _terms(piece: W.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a piece, and the number of words of each text."""
    data = W.LOWER[piece.data]
    starts, ends, texts = W.spans(W.Piece(piece.first, piece.last, data, piece.offsets), W.ALNUM)
    return W.word_hashes(data, starts, ends), np.bincount(texts, minlength=len(piece))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in W.pieces(batch["text"]):
            hashes, sizes = _terms(piece)
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            fresh = np.ones(len(ranked), bool)
            fresh[1:] = ranked[1:] != ranked[:-1]
            keys = (np.cumsum(fresh) - 1) * len(hashes) + order
            gaps = np.diff(keys, prepend=0).astype("<u4")
            own = slice(piece.first, piece.last)
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]),
                 pa.array([batch["doc_id"][own].to_pylist()], pa.list_(pa.int64())),
                 pa.array([batch["version"][own].to_pylist()], pa.list_(pa.int64())),
                 pa.array([sizes.tolist()], pa.list_(pa.int32())),
                 pa.array([ranked[fresh].astype("<u8").tobytes()], pa.binary()),
                 pa.array([gaps.tobytes()], pa.binary())],
                names=["block", "doc_ids", "versions", "sizes", "terms", "gaps"])


def build_index(docs: DataFrame, path: str, id_column: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Write the index of all texts to ``path``; returns the stored table."""
    named = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                        F.xxhash64(F.col(f"`{text}`")).alias("version"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    index = map_arrow(named, _blocks, BLOCK)
    index.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(BLOCK).parquet(path)


@dataclass
class TestSet:
    """Windows of one part of the test items."""

    items: list[str]
    terms: np.ndarray  # distinct word hashes, sorted
    words: np.ndarray  # all words of all items, as places in ``terms``
    starts: np.ndarray  # first word of each window
    sizes: np.ndarray  # its number of words
    owner: np.ndarray  # its item


def test_set(rows: list[tuple[str, str]], window: int = WINDOW) -> TestSet:
    texts = pa.array([text or "" for _, text in rows], pa.string())
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for piece in W.pieces(texts):
        found, sizes = _terms(piece)
        hashes.append(found)
        counts.append(sizes)
    terms, words = np.unique(np.concatenate(hashes), return_inverse=True)
    count = np.concatenate(counts)
    base = np.cumsum(count) - count
    numbers = np.where(count > 0, np.maximum(count - window + 1, 1), 0)
    owner = np.repeat(np.arange(len(rows)), numbers)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
    return TestSet([str(i) for i, _ in rows], terms, words, base[owner] + within,
                   np.minimum(count, window)[owner], owner)


def _ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - firsts, sizes)


class Postings:
    """Postings of one block: ``keys`` holds rank of the term times ``n`` plus position."""

    def __init__(self, terms: bytes, gaps: bytes, sizes: np.ndarray) -> None:
        self.terms = np.frombuffer(terms, "<u8")
        self.keys = np.cumsum(np.frombuffer(gaps, "<u4"), dtype=np.int64)
        self.n = len(self.keys)
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.base = np.concatenate([[0], np.cumsum(sizes)])

    def matches(self, asked: TestSet, slack: int) -> tuple[np.ndarray, ...]:
        """Window, first word, text and whether the match is exact, of all matches in the block."""
        empty = np.zeros(0, np.int64)
        none = empty, empty, empty, np.zeros(0, bool)
        if not self.n or not len(asked.starts):
            return none
        rank = np.searchsorted(self.terms, asked.terms)
        known = self.terms[np.minimum(rank, len(self.terms) - 1)] == asked.terms
        low = np.searchsorted(self.keys, rank * self.n)
        count = np.where(known, np.searchsorted(self.keys, (rank + 1) * self.n) - low, 0)
        out = [none]
        for size in np.unique(asked.sizes).tolist():
            windows = np.flatnonzero(asked.sizes == size)
            words = asked.words[asked.starts[windows][:, None] + np.arange(size)]
            whole = count[words].min(axis=1) > 0
            windows, words = windows[whole], words[whole]
            rarer = np.argsort(count[words], axis=1, kind="stable")
            seed = np.take_along_axis(words, rarer[:, :1], 1)[:, 0]
            row = np.repeat(np.arange(len(windows)), count[seed])
            place = self.keys[_ranges(low[seed], count[seed])] - rank[seed[row]] * self.n
            text = self.text[place]
            first = place - rarer[row, 0]
            exact = (first >= self.base[text]) & (first + size <= self.base[text + 1])
            if slack:  # the rarest term itself may be off by so many words
                off = np.arange(-slack, slack + 1)
                exact = ((off == 0) & exact[:, None]).ravel()
                first = (first[:, None] + off).ravel()
                row, text = np.repeat(row, len(off)), np.repeat(text, len(off))
            else:
                row, first, text, exact = row[exact], first[exact], text[exact], exact[exact]
            for k in range(1, size):
                offset = rarer[row, k]
                goal = rank[words[row, offset]] * self.n
                at = first + offset
                exact &= self._holds(goal + at, goal + at)
                keep = exact
                if slack:
                    lowest = np.maximum(at - slack, self.base[text])
                    highest = np.minimum(at + slack, self.base[text + 1] - 1)
                    keep = exact | self._holds(goal + lowest, goal + highest)
                row, first, text, exact = row[keep], first[keep], text[keep], exact[keep]
            out.append((windows[row], first, text, exact))
        return tuple(np.concatenate([part[k] for part in out]) for k in range(4))

    def _holds(self, lowest: np.ndarray, highest: np.ndarray) -> np.ndarray:
        """Whether some key lies between the bounds (never where they are the wrong way round)."""
        at = np.searchsorted(self.keys, lowest)
        return (at < self.n) & (self.keys[np.minimum(at, self.n - 1)] <= highest)


def _found(asked, slack: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: TestSet = asked.value
        for batch in batches:
            for block in batch.to_pylist():
                sizes = np.array(block["sizes"], np.int64)
                postings = Postings(block["terms"], block["gaps"], sizes)
                window, first, texts, exact = postings.matches(tests, slack)
                cover = np.zeros(postings.n + 1, np.int64)
                np.add.at(cover, first[exact], 1)
                np.add.at(cover, first[exact] + tests.sizes[window[exact]], -1)
                hit = np.cumsum(cover) > 0
                named: dict[int, tuple[set, set]] = {}
                for text, item, whole in zip(
                        texts.tolist(), tests.owner[window].tolist(), exact.tolist()):
                    own = named.setdefault(text, (set(), set()))
                    own[0 if whole else 1].add(tests.items[item])
                count = len(sizes)
                hits, items, near = [[]] * count, [[]] * count, [[]] * count
                for text, (phrases, close) in named.items():
                    inside = hit[postings.base[text]:postings.base[text + 1]]
                    edges = np.diff(np.concatenate([[0], inside, [0]]).astype(np.int8))
                    hits[text] = np.flatnonzero(edges).tolist()
                    items[text], near[text] = sorted(phrases), sorted(close - phrases)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block["block"]] * count),
                     pa.array(np.arange(count, dtype=np.int32)),
                     pa.array(block["doc_ids"], pa.int64()),
                     pa.array(block["versions"], pa.int64()),
                     pa.array(sizes), pa.array(hits, pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string())),
                     pa.array(near, pa.list_(pa.string()))],
                    names=["block", "row", "doc_id", "version", "n_words", "hits", "items",
                           "near"])
    return rows


def search(index: DataFrame, tests: DataFrame, item: str = "item_id", text: str = "text",
           window: int = WINDOW, slack: int = 0, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per indexed text: ``doc_id``, ``version`` (hash of the text), ``n_words``, ``hits`` (start
    and end of the matched word ranges of each part of the test set, end exclusive), ``items``
    (ids with an exact phrase) and ``near`` (ids with a proximity match only)."""
    spark = importable(index.sparkSession)
    asked = tests.select(F.col(f"`{item}`").cast("string").alias("item"),
                         F.col(f"`{text}`").cast("string").alias("text")).where(
                             "item IS NOT NULL").distinct()
    total = asked.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    parts = total // part_bytes + 1
    found = None
    for part in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).collect()
        prepared = spark.sparkContext.broadcast(
            test_set([(row["item"], row["text"]) for row in rows], window))
        one = map_arrow(index, _found(prepared, slack), FOUND)
        if parts > 1:
            one = stored(one, "matches")
            prepared.destroy()
        found = one if found is None else found.union(one)
    return (
        found.groupBy("block", "row")
        .agg(F.first("doc_id").alias("doc_id"), F.first("version").alias("version"),
             F.first("n_words").alias("n_words"),
             F.flatten(F.collect_list("hits")).alias("hits"),
             F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
             F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        .withColumn("near", F.array_sort(F.array_except("near", "items")))
        .drop("block", "row"))


def hit_words(hits: str = "hits"):
    """Number of words covered by ranges given as start, end, start, end, ..."""
    places = F.expr(f"""flatten(transform(
        filter(sequence(0, size({hits}) - 1), k -> size({hits}) > 0 AND k % 2 = 0),
        k -> sequence({hits}[k], {hits}[k + 1] - 1)))""")
    return F.size(F.array_distinct(places)).cast("long")


def contamination(docs: DataFrame, tests: DataFrame, id_column: str = "doc_id",
                  text: str = "text", item: str = "item_id", window: int = WINDOW,
                  slack: int = 0) -> DataFrame:
    """Index all texts in the shared folder and search the test set in them."""
    index = build_index(docs, scratch_path(docs.sparkSession, "postings"), id_column, text)
    found = search(index, tests, item, text, window, slack)
    return found.withColumn("n_hit", hit_words())


def digest(found: DataFrame, near: bool = False) -> DataFrame:
    """Counts and hashes of the exact matches; with ``near`` also those of the items that match in
    proximity only (``n_near``, ``near_sha256``), which do not make a text contaminated."""
    more = [F.size("near").cast("long").alias("n_near"),
            F.sha2(F.array_join("near", ","), 256).alias("near_sha256")]
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), *(more if near else []))


def brute_force_near(doc: str, item: str, window: int, slack: int) -> bool:
    """Whether some window of an item has a proximity match in a text; for tests."""
    d, w = doc.split(), item.split()
    size = min(window, len(w))
    return any(
        all(any(d[p] == w[a + j] for p in range(max(0, s + j - slack),
                                                min(len(d), s + j + slack + 1)))
            for j in range(size))
        for a in range(len(w) - size + 1) for s in range(-size - slack, len(d) + slack))


def brute_force(docs, tests, window: int = WINDOW):
    """The same by a dictionary of all windows; for tests."""
    import hashlib
    import re

    def words(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)

    known: dict[tuple, set] = {}
    for item, text in tests:
        w = words(text)
        for k in range(max(len(w) - window + 1, 1 if w else 0)):
            if item is not None:
                known.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    lengths = {len(k) for k in known}
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, items = [False] * len(w), set()
        for size in lengths:
            for k in range(len(w) - size + 1):
                found = known.get(tuple(w[k:k + size]))
                if found:
                    items |= found
                    hit[k:k + size] = [True] * size
        joined = ",".join(sorted(items, key=str.encode))
        out.append((doc_id, len(w), sum(hit), len(items),
                    hashlib.sha256(joined.encode()).hexdigest(), any(hit)))
    return out
