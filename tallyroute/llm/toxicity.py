"""Toxicity scores by a small convolutional network over hashed words, written in numpy.

A word is the sum of hashed embeddings of itself and of its beginnings of a few lengths, so that
inflected and compound forms share what is learnt.  Filters of several widths run over the words;
each filter keeps its largest value over the whole text; a logistic layer turns these into a
score.  Every labelled row takes part, whatever the length of its text: four fifths train, the rest
calibrate.  In each of ``ROUNDS`` rounds the rows are dealt to tasks, about ``ROWS`` to each; every
task goes on from the same network through its rows, and what the tasks change is averaged, for a
bucket over the tasks that met it.  The driver and each task hold the network, ``BUCKETS`` times
``WIDTH`` numbers and a few filters with their steps, whatever the input.

Scores depend on the text alone.  They are calibrated to probabilities on the rows that took
no part in training, by counts of logits rounded to 1 / ``GRID``.  There, thresholds are set per language, for decisions only: the
lowest score from which on ``PRECISION`` of the rows are toxic.  A language with fewer than
``ENOUGH`` toxic rows there takes the threshold of all languages together.

A long text is scored part by part, with the same largest values as in one.

Defined results: a NULL, empty or wordless text gets the score of no evidence.  Labels other than
0 and 1 and labels without a document are not learnt from.  Without any usable label of both
kinds every score is 0.  A NULL or unknown language takes the common threshold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.llm import words as W
from tallyroute.llm.store import importable, map_arrow, stored

#: rows that a task trains on in a round, one row in so many that calibrates, and steps of a logit
ROWS, HELD, GRID = 4000, 5, 1024
#: words of the rows whose order is drawn anew in each round
SHUFFLED = 1 << 20
BUCKETS, WIDTH = 1 << 17, 12
#: words a filter spans, and filters of each span
SPANS, FILTERS = (1, 2, 3), 8
#: bytes of the beginnings of a word that are hashed besides the word itself
HEADS = (4, 5, 6, 7)
ROUNDS, BATCH, RATE, RARE = 6, 32, 0.1, 4
PRECISION, ENOUGH = 0.97, 20


def features(piece: W.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word (words x kinds), and the number of words per text."""
    data = W.LOWER[piece.data]
    starts, ends, texts = W.spans(W.Piece(piece.first, piece.last, data, piece.offsets), W.ALNUM)
    kinds = W.span_hashes(data, starts, ends, HEADS)
    for k in range(len(HEADS)):
        kinds[k + 1] = W.mix(kinds[k + 1] + np.uint64(k + 1))
    buckets = kinds.T % np.uint64(BUCKETS)
    return buckets.astype(np.int32), np.bincount(texts, minlength=len(piece))


def _windows(text: np.ndarray | W.Piece) -> Iterator[tuple[np.ndarray, int]]:
    """Buckets of the words of a text and how many of them begin a window: at once, or part by part
    for a piece of one text.  The last words of a part wait for the words after them, so memory does
    not follow the number of words."""
    if isinstance(text, np.ndarray):
        if len(text):
            yield text, len(text)
        return
    wait = max(SPANS) - 1
    held = np.zeros((0, 1 + len(HEADS)), np.int32)
    for part in chain(W.parts(text, W.ALNUM, W.PIECE), [None]):
        if part is not None:
            held = np.concatenate([held, features(part)[0]])
        ready = len(held) if part is None else max(0, len(held) - wait)
        if ready:
            yield held, ready
        held = held[ready:]


@dataclass
class Network:
    """Embeddings, filters (span -> span x width x filters), and the logistic layer."""

    embed: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    base: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def vectors(self, buckets: np.ndarray) -> np.ndarray:
        found = self.embed[buckets[:, 0]]
        for k in range(1, buckets.shape[1]):
            found += self.embed[buckets[:, k]]
        return found

    def responses(self, vectors: np.ndarray, span: int) -> np.ndarray:
        """Filter values at each word; words beyond the end count as zero."""
        weights = self.filters[span]
        found = vectors @ weights[0]
        for step in range(1, min(span, len(vectors))):
            found[:-step] += vectors[step:] @ weights[step]
        return found

    def pooled(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Largest value of every filter in every text; zero where a text has no words."""
        out = np.zeros((len(counts), FILTERS * len(SPANS)), np.float32)
        full = np.flatnonzero(counts)
        if not len(full):
            return out
        heads = (np.cumsum(counts) - counts)[full]
        vectors = self.vectors(buckets).astype(np.float64)
        for k, span in enumerate(SPANS):
            weights = self.filters[span]
            found = vectors @ weights[0]
            for step in range(1, span):
                moved = vectors[step:] @ weights[step]
                # the last words of a text have no words after them
                for back in range(1, step + 1):
                    ends = heads + counts[full] - back
                    ends = ends[(ends >= heads) & (ends < len(moved))]
                    moved[ends] = 0
                found[:len(moved)] += moved
            best = np.maximum.reduceat(found, heads, axis=0) + self.bias[span]
            out[full, k * FILTERS:(k + 1) * FILTERS] = np.maximum(best, 0)
        return out

    def pooled_long(self, piece: W.Piece) -> np.ndarray:
        """As ``pooled`` for a piece of one text, part by part."""
        best = np.full((len(SPANS), FILTERS), -np.inf, np.float32)
        for held, ready in _windows(piece):
            vectors = self.vectors(held).astype(np.float64)
            for k, span in enumerate(SPANS):
                found = self.responses(vectors, span)[:ready]
                best[k] = np.maximum(best[k], found.max(axis=0))
        biased = best + np.stack([self.bias[span] for span in SPANS])
        return np.maximum(biased, 0).reshape(1, -1)

    def peaks(self, text: np.ndarray | W.Piece) -> tuple[np.ndarray, list, list]:
        """Largest value of every filter without its bias, and the buckets of the words it spans
        there, with a mark for those that are words of the text."""
        best = np.full((len(SPANS), FILTERS), -np.inf, np.float32)
        words = [np.zeros((FILTERS, span, 1 + len(HEADS)), np.int32) for span in SPANS]
        live = [np.zeros((FILTERS, span), bool) for span in SPANS]
        for held, ready in _windows(text):
            vectors = self.vectors(held)
            for k, span in enumerate(SPANS):
                found = self.responses(vectors, span)[:ready]
                at = found.argmax(axis=0)
                top = found[at, np.arange(FILTERS)]
                new = np.flatnonzero(top > best[k])
                place = at[new, None] + np.arange(span)
                best[k, new] = top[new]
                words[k][new] = held[np.minimum(place, len(held) - 1)]
                live[k][new] = place < len(held)
        return best, words, live

    def piece_logits(self, piece: W.Piece) -> np.ndarray:
        """Logits of the texts of a piece; one that is longer than a piece holds one text."""
        pooled = (self.pooled_long(piece) if len(piece.data) > W.PIECE
                  else self.pooled(*features(piece)))
        return self._logits(pooled)

    def piece_scores(self, piece: W.Piece) -> np.ndarray:
        return self._probabilities(self.piece_logits(piece))

    def _logits(self, pooled: np.ndarray) -> np.ndarray:
        """Sums in double precision, rounded, so that a text's place among others does not show."""
        found = pooled.astype(np.float64) @ self.out.astype(np.float64) + self.base
        return np.rint(found * FINER) / FINER

    def _probabilities(self, logits: np.ndarray) -> np.ndarray:
        return _logistic(logits * self.scale + self.shift)

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self._logits(self.pooled(buckets, counts))

    def scores(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self._probabilities(self.logits(buckets, counts))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Steps:
    """Adaptive steps: each number moves by its gradient over the root of its past squares."""

    def __init__(self, values: np.ndarray, rate: float) -> None:
        self.values, self.rate = values, rate
        self.past = np.full(values.shape, 1e-3, np.float32)

    def move(self, gradient: np.ndarray, rows=slice(None)) -> None:
        self.past[rows] += gradient ** 2
        self.values[rows] -= self.rate * gradient / np.sqrt(self.past[rows])


def _start(texts: list[np.ndarray], labels: np.ndarray, seed: int) -> Network:
    """Small random weights; the first number of an embedding begins as the bucket's evidence,
    less of it the fewer texts have the bucket.  Buckets of fewer than ``RARE`` texts stay zero:
    they would only learn single texts by heart."""
    seen = np.zeros((2, BUCKETS), np.float64)
    for buckets, label in zip(texts, labels):
        seen[label, np.unique(buckets)] += 1
    return _started(seen, np.bincount(labels, minlength=2), seed)


def _started(seen: np.ndarray, texts: np.ndarray, seed: int) -> Network:
    """As ``_start`` from the number of ``texts`` of either label and of those with each bucket."""
    random = np.random.default_rng(seed)
    rate = (seen + 0.5) / (texts[:, None] + 1)
    embed = random.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    texts_with = seen.sum(axis=0)
    embed[:, 0] = np.clip(np.log(rate[1] / rate[0]), -2, 4) / 4 * texts_with / (texts_with + 5)
    embed[texts_with < RARE] = 0
    filters = {s: random.normal(0, 0.1, (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS}
    for weights in filters.values():
        weights[:, 0, :] += 0.5
    bias = {s: np.full(FILTERS, -0.2, np.float32) for s in SPANS}
    out = np.full(FILTERS * len(SPANS), 0.2, np.float32)
    return Network(embed, filters, bias, out, base=-2.0)


#: rows that all numbers but the embeddings take in the table of a training
REST = -(-sum(s * WIDTH * FILTERS + 2 * FILTERS for s in SPANS) // WIDTH) + 1
#: what a task changes is sent and summed in whole numbers, so that no order matters
FINE, FINER = 2.0 ** 20, 2.0 ** 30
CHANGED = "place INT, rows BIGINT, " + ", ".join(
    [f"m{k} BIGINT" for k in range(WIDTH)] + [f"p{k} BIGINT" for k in range(WIDTH)])


class Training:
    """A network with its steps.  All its numbers lie in ``table``, the embeddings first, and their
    past squares in ``past``; ``weight`` is that of a row of either label."""

    def __init__(self, net: Network, weight: np.ndarray) -> None:
        self.weight = weight
        rest = np.zeros(REST * WIDTH, np.float32)
        parts = [*(net.filters[s] for s in SPANS), *(net.bias[s] for s in SPANS), net.out,
                 np.array([net.base])]
        flat = np.concatenate([part.ravel() for part in parts])
        rest[:len(flat)] = flat
        self.table = np.concatenate([net.embed, rest.reshape(REST, WIDTH)]).astype(np.float32)
        self.past = np.full(self.table.shape, 1e-3, np.float32)
        self.open()

    def open(self) -> None:
        """Name the parts of the table; all are views of it."""
        steps = {}
        at = 0
        rest, past = self.table[BUCKETS:].reshape(-1), self.past[BUCKETS:].reshape(-1)

        def part(shape: tuple[int, ...], rate: float) -> _Steps:
            nonlocal at
            size = int(np.prod(shape))
            held = _Steps(rest[at:at + size].reshape(shape), rate)
            held.past = past[at:at + size].reshape(shape)
            at += size
            return held

        steps |= {("w", s): part((s, WIDTH, FILTERS), RATE / 4) for s in SPANS}
        steps |= {("b", s): part((FILTERS,), RATE / 4) for s in SPANS}
        steps["out"] = part((FILTERS * len(SPANS),), RATE / 2)
        steps["base"] = part((1,), RATE)
        steps["embed"] = _Steps(self.table[:BUCKETS], RATE / 2)
        steps["embed"].past = self.past[:BUCKETS]
        self.steps = steps
        self.net = Network(
            steps["embed"].values, {s: steps["w", s].values for s in SPANS},
            {s: steps["b", s].values for s in SPANS}, steps["out"].values)

    def copy(self) -> Training:
        other = object.__new__(Training)
        other.weight, other.table, other.past = self.weight, self.table.copy(), self.past.copy()
        other.open()
        return other

    def __getstate__(self) -> tuple:
        return self.weight, self.table, self.past

    def __setstate__(self, state: tuple) -> None:
        self.weight, self.table, self.past = state
        self.open()

    def network(self) -> Network:
        net = self.copy().net
        net.base = float(self.steps["base"].values[0])
        return net

    def step(self, texts: list[np.ndarray | W.Piece], labels: np.ndarray) -> None:
        """One step for a batch; gradients pass the maxima only, so it touches a few words per
        text."""
        net, steps = self.net, self.steps
        found = [net.peaks(text) for text in texts]
        biased = np.stack([best for best, _, _ in found]) + np.stack([net.bias[s] for s in SPANS])
        pooled = np.maximum(biased, 0).reshape(len(texts), -1)
        guess = _logistic(pooled @ net.out + steps["base"].values[0])
        error = ((guess - labels) * self.weight[labels] / len(texts)).astype(np.float32)
        back = error[:, None] * net.out * (pooled > 0)
        moved, slopes = [], []
        for k, s in enumerate(SPANS):
            own = back[:, k * FILTERS:(k + 1) * FILTERS]
            words = np.stack([held[k] for _, held, _ in found])
            live = np.stack([held[k] for _, _, held in found]) & (own != 0)[:, :, None]
            vectors = net.vectors(words.reshape(-1, words.shape[-1])).reshape(*live.shape, WIDTH)
            gradient = np.einsum("nf,nfsw->swf", own, vectors * live[..., None])
            moved.append(words[live])
            slopes.append((own[:, :, None, None] * net.filters[s].transpose(2, 0, 1))[live])
            steps["w", s].move(gradient)
            steps["b", s].move(own.sum(axis=0))
        steps["out"].move(pooled.T @ error)
        steps["base"].move(np.array([error.sum()], np.float32))
        buckets, slope = np.concatenate(moved), np.concatenate(slopes)
        touched, inverse = np.unique(buckets, return_inverse=True)
        total = np.zeros((len(touched), WIDTH), np.float32)
        known = net.embed[touched].any(axis=1)
        np.add.at(total, inverse.reshape(buckets.shape),
                  np.repeat(slope[:, None], buckets.shape[1], 1))
        steps["embed"].move(total[known], touched[known])

    def run(self, batches: Iterable[pa.RecordBatch], random: np.random.Generator) -> int:
        """Step through all rows, ``BATCH`` at a time, and return their number.  The order is drawn
        anew among rows of about ``SHUFFLED`` words."""
        rows, held, size = 0, [], 0

        def steps() -> None:
            order = random.permutation(len(held))
            for low in range(0, len(order), BATCH):
                texts, labels = zip(*(held[k] for k in order[low:low + BATCH]))
                self.step(list(texts), np.array(labels))

        for text, label in _texts(batches):
            held.append((text, label))
            rows += 1
            size += len(text) if isinstance(text, np.ndarray) else len(text.data)
            if size >= SHUFFLED:
                steps()
                held, size = [], 0
        steps()
        return rows

    def round(self, rows: DataFrame, seed: list[int]) -> Training:
        """The training after all tasks have gone through their ``rows`` once."""
        sent = importable(rows.sparkSession).sparkContext.broadcast(self)

        def changes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = sent.value.copy()
            count = own.run(batches, np.random.default_rng(seed))
            place = np.flatnonzero((own.past != sent.value.past).any(axis=1))
            moved = np.rint((own.table - sent.value.table)[place] * FINE).astype(np.int64) * count
            past = np.rint((own.past - sent.value.past)[place] * FINER).astype(np.int64) * count
            names = [part.split()[0] for part in CHANGED.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place.astype(np.int32)), pa.array(np.full(len(place), count, np.int64)),
                 *map(pa.array, moved.T), *map(pa.array, past.T)], names)

        summed = map_arrow(rows, changes, CHANGED).groupBy("place").agg(
            *[F.sum(name).alias(name) for name in
              ("rows", *[f"m{k}" for k in range(WIDTH)], *[f"p{k}" for k in range(WIDTH)])])
        found = summed.toArrow()
        sent.unpersist()
        after = self.copy()
        place, count = (np.asarray(found[name]) for name in ("place", "rows"))
        for k in range(WIDTH):
            after.table[place, k] += np.asarray(found[f"m{k}"]) / count / FINE
            after.past[place, k] += np.asarray(found[f"p{k}"]) / count / FINER
        return after


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray | W.Piece, int]]:
    """Buckets of each text and its label; a text longer than a piece comes as its piece."""
    for batch in batches:
        labels = batch["label"].to_pylist()
        for piece in W.pieces(batch["text"]):
            if len(piece.data) > W.PIECE:
                yield piece, labels[piece.first]
                continue
            buckets, counts = features(piece)
            yield from zip(np.split(buckets, np.cumsum(counts)[:-1]),
                           labels[piece.first:piece.last])


def _seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of either label have each bucket."""
    seen = np.zeros((2, BUCKETS), np.int64)
    for text, label in _texts(batches):
        there = np.zeros(BUCKETS, bool)
        for held, ready in _windows(text):
            there[held[:ready]] = True
        seen[label] += there
    label, bucket = np.nonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label.astype(np.int32)), pa.array(bucket.astype(np.int32)),
         pa.array(seen[label, bucket])], ["label", "bucket", "texts"])


def train(rows: DataFrame, counts: np.ndarray, seed: int = 11, rounds: int = ROUNDS) -> Network:
    """Fit a network to the ``text`` and ``label`` of all rows, of which there are ``counts``."""
    tasks = rows.select("label", "text").coalesce(max(1, -(-int(counts.sum()) // ROWS)))
    found = map_arrow(tasks, _seen, "label INT, bucket INT, texts BIGINT").groupBy(
        "label", "bucket").agg(F.sum("texts").alias("texts")).toArrow()
    seen = np.zeros((2, BUCKETS), np.float64)
    seen[np.asarray(found["label"]), np.asarray(found["bucket"])] = np.asarray(found["texts"])
    training = Training(_started(seen, counts, seed), 0.5 * counts.sum() / np.maximum(counts, 1e-9))
    for number in range(rounds):
        training = training.round(tasks, [seed, number])
    return training.network()


def calibrate(net: Network, logits: np.ndarray, labels: np.ndarray, weights: np.ndarray,
              languages: list) -> None:
    """Scale logits to probabilities by logistic regression, then set the thresholds; ``weights``
    says how many rows have a logit, label and language."""
    scale, shift = 1.0, 0.0
    for _ in range(200):
        guess = _logistic(logits * scale + shift)
        error = weights * (guess - labels)
        curve = weights * guess * (1 - guess) + 1e-9
        steps = np.array([[np.sum(curve * logits ** 2) + 0.1, np.sum(curve * logits)],
                          [np.sum(curve * logits), np.sum(curve) + 0.1]])
        slope = np.array([np.sum(error * logits) + 0.1 * (scale - 1), np.sum(error)])
        move = np.linalg.solve(steps, slope)
        scale, shift = max(scale - move[0], 0.05), shift - move[1]
        if np.abs(move).max() < 1e-6:
            break
    net.scale, net.shift = float(scale), float(shift)
    scores = _logistic(logits * scale + shift)
    net.thresholds = {"": _threshold(scores, labels, weights)}
    for name in {x for x in languages if x}:
        own = np.array([x == name for x in languages])
        if (labels * weights)[own].sum() >= ENOUGH:
            net.thresholds[name] = _threshold(scores[own], labels[own], weights[own])


def _threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Middle of the gap above which the wanted share of rows is toxic; 0.5 at the least."""
    ordered, inverse = np.unique(-scores, return_inverse=True)
    toxic = np.cumsum(np.bincount(inverse, labels * weights))
    good = np.flatnonzero(toxic >= PRECISION * np.cumsum(np.bincount(inverse, weights)))
    if not len(good):
        return 0.9
    last = good[-1]
    below = -ordered[last + 1] if last + 1 < len(ordered) else 0.0
    return float(np.clip((below - ordered[last]) / 2, 0.5, 0.9))


#: Spark drops texts without a label by a Bloom filter of 4 MB before it moves them to their labels;
#: beyond 4,000,000 labels more of them are moved
_BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
FILTER = {
    f"{_BLOOM}.enabled": "true", f"{_BLOOM}.applicationSideScanSizeThreshold": "0",
    f"{_BLOOM}.creationSideThreshold": "64g", f"{_BLOOM}.expectedNumItems": "4000000",
    f"{_BLOOM}.numBits": str(1 << 25),
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for what is run inside."""
    held = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)


def learnable(docs: DataFrame, labels: DataFrame, allowed: Column | None = None) -> DataFrame:
    """``doc_id``, ``text``, ``lang`` and ``label`` of every row to learn from, and its ``draw``, a
    hash of the id; ``allowed`` may exclude rows by ``doc_id``.  An id gives one text."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("toxic").cast("int").alias("label"))
    usable = usable.where("doc_id IS NOT NULL AND label IN (0, 1)")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
    texts = texts.where("doc_id IS NOT NULL AND text IS NOT NULL")
    if allowed is not None:
        usable, texts = usable.where(allowed), texts.where(allowed)
    texts = (
        texts.join(usable.select("doc_id"), "doc_id", "left_semi")
        .groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("one"))
        .select("doc_id", "one.text", "one.lang"))
    return texts.join(usable, "doc_id").withColumn(
        "draw", F.xxhash64("doc_id", F.lit("toxicity")))


def sample(docs: DataFrame, labels: DataFrame,
           allowed: Column | None = None) -> tuple[pa.Table, dict[int, int]]:
    """All rows to learn from and how many there are of either label, for tables that are small."""
    table = learnable(docs, labels, allowed).toArrow()
    totals = {k: table["label"].to_pylist().count(k) for k in (0, 1)}
    return table.sort_by([("draw", "ascending"), ("text", "ascending")]), totals


def learn(docs: DataFrame, labels: DataFrame, allowed: Column | None = None) -> Network | None:
    """Train on four fifths of the labelled rows and calibrate on the rest."""
    with _settings(docs.sparkSession, FILTER):
        rows = stored(
            learnable(docs, labels, allowed).select(
                "label", "lang", "text", "draw", (F.pmod("draw", F.lit(HELD)) == 0).alias("held"))
            .sortWithinPartitions("draw", "label", "text"), "labelled")
    counts = np.zeros((2, 2), np.int64)  # held, label
    for row in rows.groupBy("held", "label").count().collect():
        counts[int(row["held"]), row["label"]] = row["count"]
    if not counts.sum(axis=0).all():
        return None
    fit, check = rows.where("NOT held"), rows.where("held")
    if not counts.all():
        fit = check = rows
        counts[:] = counts.sum(axis=0)
    net = train(fit, counts[0])
    cells = logit_cells(check, net).toArrow()
    label, cell, texts = (np.asarray(cells[name]) for name in ("label", "cell", "texts"))
    calibrate(net, cell / GRID, label, texts.astype(np.float64), cells["lang"].to_pylist())
    return net


def logit_cells(rows: DataFrame, net: Network) -> DataFrame:
    """How many rows of a ``label`` and language have a logit of ``cell`` / ``GRID``.  A language
    that sets no threshold is NULL."""
    sent = importable(rows.sparkSession).sparkContext.broadcast(net)

    @F.arrow_udf("bigint")
    def celled(column: pa.Array) -> pa.Array:
        found = [np.rint(sent.value.piece_logits(piece) * GRID) for piece in W.pieces(column)]
        return pa.array(np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64))

    often = rows.where("label = 1 AND lang != ''").groupBy("lang").agg(
        F.count(F.lit(1)).alias("toxic")).where(F.col("toxic") >= ENOUGH)
    names = [row["lang"] for row in often.collect()]
    lang = F.when(F.col("lang").isin(names), F.col("lang")) if names else F.lit(None).cast("string")
    return rows.select("label", lang.alias("lang"), celled("text").alias("cell")).groupBy(
        "label", "lang", "cell").agg(F.count(F.lit(1)).alias("texts")).orderBy(
            F.col("cell").desc(), "label", "lang")


def score(docs: DataFrame, net: Network | None, name: str = "score",
          text: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: the score of the whole text."""
    if net is None:
        return docs.withColumn(name, F.lit(0.0))
    sent = importable(docs.sparkSession).sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        found = [sent.value.piece_scores(piece) for piece in W.pieces(column)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return docs.withColumn(name, scored(F.col(f"`{text}`").cast("string")))


def threshold(net: Network | None, lang: Column) -> Column:
    """Threshold of the row's language."""
    picked = F.lit(net.thresholds[""] if net else 2.0)
    for name, value in sorted((net.thresholds if net else {}).items()):
        if name:
            picked = F.when(lang == name, value).otherwise(picked)
    return picked
