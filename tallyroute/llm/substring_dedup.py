"""Remove passages of at least ``window`` words that an earlier document holds as well.

Every window of ``window`` consecutive words gets a Rabin-Karp hash, rolled over the hashes of
its words, and Spark counts the windows across documents.  Two steps keep the counting narrow:

* Equal windows have equal *anchors*: the smallest hash of ``GRAM`` consecutive words inside the
  window.  Neighbouring windows mostly share theirs, so windows travel as *runs* (anchor, first
  window, number of windows, hash of the run), about one run per 18 windows.  Windows whose
  anchor occurs in one document only are unique without being looked at one by one.
* Equal runs are settled as a whole by their hash: the smallest document id keeps them.  Only the
  windows of different runs with a common anchor are counted one by one.

A window is identified by its anchor and its own hash, which come from two independent hashes of
its words.  Removed windows merge
into maximal intervals per document.  All groupings are sums or minima that combine map-side, so
a passage found in a third of all documents costs each task one row.

Defined results: a NULL text has no words.  Rows without an id take no part and keep their words.
Rows that share an id are never compared with one another, and each keeps its own words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm import words as W
from tallyroute.llm.store import map_arrow, stored

#: words in the smallest unit that anchors a window; shorter ones anchor more by chance
GRAM = 16

RUNS = "doc_id long, version long, anchor long, content long, first int, windows int"
MARKS = "array<struct<first:int,windows:int,whole:boolean>>"


def _named(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Id, text, and a hash that tells rows with one id but different texts apart."""
    return df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                     F.xxhash64(F.col(f"`{text}`")).alias("version"), F.col(f"`{text}`").alias("text"))


class _Windows:
    """Anchors and hashes of all windows of the texts of one piece."""

    def __init__(self, piece: W.Piece, window: int, gram: int) -> None:
        starts, ends, self.word_text = W.spans(piece, W.NOT_SPACE)
        words, others = (W.word_hashes(piece.data, starts, ends, which) for which in (0, 1))
        self.counts = np.bincount(self.word_text, minlength=len(piece))
        self.base = np.concatenate([[0], np.cumsum(self.counts)])
        self.window = window
        if len(words) < window:
            self.at = np.zeros(0, np.int64)
            self.anchor = self.hash = np.zeros(0, np.uint64)
            return
        inside = self.word_text[:len(words) - window + 1] == self.word_text[window - 1:]
        self.at = np.flatnonzero(inside)
        self.anchor = W.sliding_min(W.rolling(others, gram, 1), window - gram + 1)[self.at]
        self.hash = W.rolling(words, window)[self.at]

    def runs(self) -> tuple[np.ndarray, ...]:
        """Text, anchor, content hash, first window and number of windows of every run."""
        text = self.word_text[self.at]
        opens = np.ones(len(self.at), bool)
        opens[1:] = (self.anchor[1:] != self.anchor[:-1]) | (text[1:] != text[:-1])
        heads = np.flatnonzero(opens)
        sizes = np.diff(np.append(heads, len(self.at)))
        tails = self.hash[heads + sizes - 1] if len(heads) else self.hash
        middle = np.add.reduceat(W.mix(self.hash), heads) if len(heads) else self.hash
        content = W.mix(self.hash[heads] + W.mix(tails) + W.mix(middle + sizes.astype(np.uint64)))
        return (text[heads], self.anchor[heads], content,
                self.at[heads] - self.base[text[heads]], sizes)


def _run_rows(window: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch["text"]):
                text, anchor, content, first, sizes = _Windows(piece, window, gram).runs()
                at = pa.array(piece.first + text)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(at), batch["version"].take(at),
                     pa.array(W.signed(anchor)), pa.array(W.signed(content)),
                     pa.array(first.astype(np.int32)), pa.array(sizes.astype(np.int32))],
                    names=["doc_id", "version", "anchor", "content", "first", "windows"])
    return rows


def _flat_marks(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first window, number of windows and whole-run flag of all marks of a batch."""
    flat = column.flatten()
    rows = np.asarray(pa.compute.list_parent_indices(column))
    parts = [flat.field(name).to_numpy(zero_copy_only=False)
             for name in ("first", "windows", "whole")]
    return rows, *parts


def _ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges that start at ``firsts``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - firsts, sizes)


def _window_rows(window: int, gram: int):
    """Windows of the marked runs that are not settled as a whole."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark_row, mark_first, mark_size, whole = _flat_marks(batch["marks"])
            for piece in W.pieces(batch["text"]):
                here = ((mark_row >= piece.first) & (mark_row < piece.last)
                        & ~whole.astype(bool))
                if not here.any():
                    continue
                found = _Windows(piece, window, gram)
                text = (mark_row[here] - piece.first).astype(np.int64)
                word = _ranges(found.base[text] + mark_first[here], mark_size[here])
                place = np.searchsorted(found.at, word)
                texts = found.word_text[word]
                at = pa.array(piece.first + texts)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(at), batch["version"].take(at),
                     pa.array(W.signed(found.anchor[place])),
                     pa.array(W.signed(found.hash[place])),
                     pa.array((word - found.base[texts]).astype(np.int32))],
                    names=["doc_id", "version", "anchor", "hash", "first"])
    return rows


def repeated_windows(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                     window: int = 50, gram: int = GRAM) -> DataFrame:
    """Per row (``doc_id``, ``version``) the ``marks``: first window and number of windows that
    also start in a document with a smaller id.  Rows without such windows are absent."""
    if window < gram:
        gram = window
    named = _named(docs, id_column, text).where(F.col("doc_id").isNotNull())
    runs = stored(map_arrow(named, _run_rows(window, gram), RUNS), "runs")
    # sums are stored before they are joined: both sides then come from exchanges, and Spark can
    # split a hot key
    anchors = stored(
        runs.groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
             F.min("content").alias("one"), F.max("content").alias("other"))
        .where("low < high")
        .select("anchor", (F.col("one") != F.col("other")).alias("mixed")), "shared-anchors")
    shared = stored(runs.join(anchors, "anchor"), "shared-runs")
    holders = stored(
        shared.groupBy("anchor", "content").agg(F.min("doc_id").alias("holder")), "run-holders")
    marked = (
        shared.join(holders, ["anchor", "content"])
        .withColumn("whole", F.col("holder") < F.col("doc_id"))
        .where("whole OR mixed")
        .groupBy("doc_id", "version")
        .agg(F.collect_list(F.struct("first", "windows", "whole")).alias("marks")))
    marked = stored(marked.select("doc_id", "version", F.col("marks").cast(MARKS)), "marks")
    windows = map_arrow(
        named.join(marked, ["doc_id", "version"]), _window_rows(window, gram),
        "doc_id long, version long, anchor long, hash long, first int")
    holders = stored(
        windows.groupBy("anchor", "hash")
        .agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last"))
        .where("holder < last").drop("last"), "window-holders")
    single = (
        windows.join(holders, ["anchor", "hash"]).where("holder < doc_id")
        .groupBy("doc_id", "version").agg(F.collect_list("first").alias("singles")))
    return (
        marked.join(single, ["doc_id", "version"], "left")
        .select("doc_id", "version", F.concat(
            F.expr("filter(marks, m -> m.whole)"),
            F.expr("transform(coalesce(singles, array()), "
                   "s -> named_struct('first', s, 'windows', 1, 'whole', true))"))
            .alias("marks"))
        .where(F.size("marks") > 0))


def _kept(window: int):
    """Words kept of each text, in one pass over the marks."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch["marks"].fill_null([])
            mark_row, mark_first, mark_size, _ = _flat_marks(marks)
            order = np.argsort(mark_row, kind="stable")
            mark_row, mark_first, mark_size = (
                x[order] for x in (mark_row, mark_first, mark_size))
            out_count, out_removed, out_text, out_spans = [], [], [], []
            for piece in W.pieces(batch["text"]):
                starts, ends, texts = W.spans(piece, W.NOT_SPACE)
                counts = np.bincount(texts, minlength=len(piece))
                base = np.concatenate([[0], np.cumsum(counts)])
                low, high = np.searchsorted(mark_row, [piece.first, piece.last])
                row = (mark_row[low:high] - piece.first).astype(np.int64)
                first = base[row] + mark_first[low:high]
                cover = np.zeros(len(starts) + 1, np.int64)
                np.add.at(cover, first, 1)
                np.add.at(cover, first + mark_size[low:high] + window - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                raw = piece.data.tobytes()
                for k in range(len(piece)):
                    s, e = base[k], base[k + 1]
                    dead = gone[s:e]
                    kept = np.flatnonzero(~dead) + s
                    out_text.append(b" ".join(
                        [raw[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist())]))
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], dead, [False]])
                                                  .astype(np.int8)))
                    out_spans.append(edge.tolist())
                    out_count.append(int(e - s))
                    out_removed.append(int(dead.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(out_count, pa.int64()),
                 pa.array(out_removed, pa.int64()),
                 pa.array(out_text, pa.binary()).cast(pa.string()),
                 pa.array(out_spans, pa.list_(pa.int32()))],
                names=["doc_id", "n_words", "n_removed", "kept", "removed"])
    return rows


def remove_repeated(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    window: int = 50) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed``, the ``kept`` words joined by
    one space, and ``removed``: start and end (exclusive) of each maximal removed interval."""
    marks = repeated_windows(docs, id_column, text, window)
    joined = _named(docs, id_column, text).join(marks, ["doc_id", "version"], "left")
    return map_arrow(
        joined.select("doc_id", "text", "marks"), _kept(window),
        "doc_id long, n_words long, n_removed long, kept string, removed array<int>")


def digest(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"),
                     F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


def brute_force(rows, window: int = 50):
    """The same by a dictionary of all windows; for tests."""
    import re

    words = [(i, re.findall("[^\\x20\\x09-\\x0D]+", t or "")) for i, t in rows]
    first: dict[tuple, int] = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
