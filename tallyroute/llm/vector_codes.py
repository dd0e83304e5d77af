"""Vector codes by Lloyd rounds over two trees.

Vectors become whole numbers, ``floor(scale * x)``, and are cut into equal consecutive parts.  Each
part position has a codebook of some entries.  A round assigns every part to its nearest entry and
moves each entry to the floor of the mean of its parts.

*Trees.*  Vectors are stored once, in rows of up to ``CHUNK`` of them; a row holds, for each part
position, the tree over its parts: the order in which the parts of every node lie end to end.  A
task that reads a row takes the smallest and largest component and the sum of every leaf in one
pass and those of the nodes above from them.  The entries of a codebook stand in a tree of their
own down to single entries.  A round descends both trees together.  Of a pair of nodes the smallest and largest distance between their
boxes are known; a pair goes when its smallest distance is above the least largest distance of its
parts' node.  Against single entries it also goes when another entry is nearer at that corner of
the box which favours it most.  A node left with one entry is assigned whole, by its cached sum.
Leaves with several entries left are settled part by part with whole numbers.

No row is moved between machines: a task reads stored rows and hands on one sum per entry and
position, so that a round ends in ``entries * width`` numbers, which make the next codebook.

Whole numbers are held in doubles while every distance is below 2**53 and as Python's whole numbers
beyond, so nothing is ever rounded.

Defined results: vectors that are NULL or hold NULL or non-finite components are dropped.  Shorter
vectors are filled with zeros up to the longest one, and all up to a multiple of the parts; empty
vectors have distance 0.  Components beyond 64 bits are cut to the nearest 64-bit number, and so
are errors.  Rows that share an id are rows of their own; the codebooks start with rows in order of
id and vector, rows without an id last, and have fewer entries if there are fewer rows.  Equal
distances go to the lower entry, unused entries stay.  Labels are compared as text, NULLs together.
An empty table gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.store import map_arrow, stored

#: vectors in a stored row, parts in a leaf
CHUNK, LEAF = 2048, 64
EXACT = 1 << 53
LIMIT = np.iinfo(np.int64)


class Tree:
    """Points in the order of a balanced tree.

    Node ``j`` of depth ``d`` covers the points from ``n * j >> d`` to ``n * (j + 1) >> d``; a node
    is halved along its widest component.
    """

    def __init__(self, points: np.ndarray, leaf: int, order: np.ndarray | None = None) -> None:
        self.n = len(points)
        self.depth = max(0, -(-self.n // leaf) - 1).bit_length()
        self.order = self._built(points) if order is None else order
        self.points = points[self.order]
        levels = [self._leaves()]
        for _ in range(self.depth):
            low, high, total = levels[-1]
            levels.append((np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2]),
                           total[::2] + total[1::2]))
        self.levels = levels[::-1]

    def cuts(self, depth: int) -> np.ndarray:
        return self.n * np.arange((1 << depth) + 1) >> depth

    def _built(self, points: np.ndarray) -> np.ndarray:
        order = np.arange(self.n)
        for depth in range(self.depth):
            cuts = self.cuts(depth)
            for j in range(1 << depth):
                part = order[cuts[j]:cuts[j + 1]]
                if len(part) < 2 or not points.shape[1]:
                    continue
                held = points[part]
                widest = int(np.argmax(held.max(axis=0) - held.min(axis=0)))
                part[:] = part[np.argsort(held[:, widest], kind="stable")]
        return order

    def _leaves(self):
        """Box and sum of each leaf; a leaf without points has an empty box."""
        cuts = self.cuts(self.depth)
        full = cuts[1:] > cuts[:-1]
        shape = (len(full), self.points.shape[1])
        kind = self.points.dtype
        low, high, total = (np.full(shape, fill, kind) for fill in (np.inf, -np.inf, 0))
        starts = cuts[:-1][full]
        if len(starts) and shape[1]:
            low[full] = np.minimum.reduceat(self.points, starts)
            high[full] = np.maximum.reduceat(self.points, starts)
            total[full] = np.add.reduceat(self.points, starts)
        return low, high, total

    def sizes(self, depth: int) -> np.ndarray:
        return np.diff(self.cuts(depth))


def _fresh(keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _ordered(*keys: np.ndarray) -> np.ndarray:
    """Rows sorted by the last key, then the one before it, and so on."""
    order = np.arange(len(keys[0]))
    for key in keys:
        order = order[np.argsort(key[order], kind="stable")]
    return order


def _squares(values: np.ndarray) -> np.ndarray:
    return (values * values).sum(axis=1)


def _nearer_corner(low, high, entry, best):
    """Distances of ``entry`` and ``best`` from the corner of the box that favours ``entry``."""
    corner = np.where(entry > best, high, low)
    return _squares(corner - entry), _squares(corner - best)


def assign(parts: Tree, book: Tree, numbers: np.ndarray):
    """Nearest entry of every point of ``parts``, in the tree's order, and the nodes settled whole
    as ``(depth, node, entry)`` arrays, followed by the points that were settled one by one."""
    labels = np.zeros(parts.n, np.int64)
    whole: list[tuple[int, np.ndarray, np.ndarray]] = []
    single = np.zeros(parts.n, bool)
    q, r, dq, dr = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while parts.n and len(q):
        (q_low, q_high, _), (r_low, r_high, _) = parts.levels[dq], book.levels[dr]
        here = (book.sizes(dr)[r] > 0) & (parts.sizes(dq)[q] > 0)
        q, r = q[here], r[here]
        if not len(q):
            break
        gap = np.maximum(np.maximum(r_low[r] - q_high[q], q_low[q] - r_high[r]), 0)
        reach = np.maximum(q_high[q] - r_low[r], r_high[r] - q_low[q])
        near, far = _squares(gap), _squares(reach)
        heads = _fresh(q)
        runs = np.diff(np.append(heads, len(q)))
        keep = near <= np.repeat(np.minimum.reduceat(far, heads), runs)
        q, r, far = q[keep], r[keep], far[keep]
        if dr == book.depth:
            heads = _fresh(q)
            runs = np.diff(np.append(heads, len(q)))
            entry = numbers[book.cuts(dr)[r]]
            first = _ordered(entry, far, q)[heads]
            best = np.repeat(r[first], runs)
            own, other = _nearer_corner(q_low[q], q_high[q], r_low[r], r_low[best])
            keep = (r == best) | (own < other) | (
                (own == other) & (entry < np.repeat(entry[first], runs)))
            q, r, entry = q[keep], r[keep], entry[keep]
            heads = _fresh(q)
            runs = np.diff(np.append(heads, len(q)))
            cuts = parts.cuts(dq)
            alone = heads[runs == 1]
            whole.append((dq, q[alone], entry[alone]))
            for node, number in zip(q[alone].tolist(), entry[alone].tolist()):
                labels[cuts[node]:cuts[node + 1]] = number
            if dq == parts.depth:
                for start, size in zip(heads[runs > 1].tolist(), runs[runs > 1].tolist()):
                    span = slice(cuts[q[start]], cuts[q[start] + 1])
                    left = np.sort(entry[start:start + size])
                    labels[span] = left[_nearest(parts.points[span], book.by_number[left])]
                    single[span] = True
                break
            more = np.repeat(runs > 1, runs)
            q, r = q[more], r[more]
        down_q, down_r = dq < parts.depth, dr < book.depth
        halves_q = np.stack([2 * q, 2 * q + 1], 1) if down_q else q[:, None]
        halves_r = np.stack([2 * r, 2 * r + 1], 1) if down_r else r[:, None]
        shape = (len(q), halves_q.shape[1], halves_r.shape[1])
        q = np.broadcast_to(halves_q[:, :, None], shape).reshape(-1)
        r = np.broadcast_to(halves_r[:, None, :], shape).reshape(-1)
        sort = np.argsort(q, kind="stable")
        q, r, dq, dr = q[sort], r[sort], dq + down_q, dr + down_r
    return labels, whole, single


def _nearest(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    distances = (-2 * points) @ entries.T + _squares(entries)
    return np.argmin(distances, axis=1)


class Book(Tree):
    """The codebook of a part position: entries by number, and the tree over them."""

    def __init__(self, entries: np.ndarray) -> None:
        super().__init__(entries, 1)
        self.by_number = entries


def _kind(*arrays: np.ndarray) -> type:
    """``float`` if every squared distance is a whole number that doubles hold, else ``object``."""
    most = max([max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0)))) for a in arrays])
    width = max(a.shape[-1] for a in arrays)
    return float if 4 * width * most * most < EXACT else object


class Books:
    """The codebooks of all part positions; their trees are built once in a task."""

    def __init__(self, codebook: np.ndarray) -> None:
        self.codebook = codebook
        self.built: dict[tuple[int, type], Book] = {}

    def trees(self, row: dict) -> Iterator[tuple[Tree, Book]]:
        """Per part position: the tree over a stored row's parts, and the book."""
        parts, _, size = self.codebook.shape
        count = len(row["ids"])
        matrix = np.frombuffer(row["vectors"], "<i8").reshape(count, parts * size)
        orders = np.frombuffer(row["orders"], "<u2").reshape(parts, count)
        for position, entries in enumerate(self.codebook):
            part = matrix[:, position * size:(position + 1) * size]
            kind = _kind(part, entries)
            if (position, kind) not in self.built:
                self.built[position, kind] = Book(entries.astype(kind))
            yield (Tree(part.astype(kind), LEAF, orders[position].astype(np.int64)),
                   self.built[position, kind])


def whole_numbers(vectors: list, width: int, scale: int) -> np.ndarray:
    """One row of ``floor(scale * x)`` per vector, filled with zeros to ``width``."""
    matrix = np.zeros((len(vectors), width))
    for row, vector in zip(matrix, vectors):
        row[:len(vector)] = vector
    with np.errstate(over="ignore"):
        matrix = np.floor(matrix * scale)
    top = matrix >= 2.0**63
    matrix = np.where(top, 0, np.maximum(matrix, -2.0**63)).astype(np.int64)
    return np.where(top, LIMIT.max, matrix)


def _chunks(width: int, parts: int, scale: int):
    """Rows into stored rows with the trees' orders."""
    def packed(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        matrix = whole_numbers(vectors, width, scale)
        orders = [Tree(part.astype(_kind(part)), LEAF).order
                  for part in np.split(matrix, parts, axis=1)]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())),
             pa.array([matrix.astype("<i8").tobytes()], pa.binary()),
             pa.array([np.array(orders).astype("<u2").tobytes()], pa.binary())],
            names=["ids", "labels", "vectors", "orders"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for batch in batches:
            values = batch["vector"].flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch["vector"].value_lengths().to_numpy(zero_copy_only=False))
            for one, label, vector in zip(batch["id"].to_pylist(), batch["label"].to_pylist(),
                                          np.split(values, ends[:-1])):
                ids.append(one)
                labels.append(label)
                vectors.append(vector)
                if len(ids) == CHUNK:
                    yield packed(ids, labels, vectors)
                    ids, labels, vectors = [], [], []
        if ids:
            yield packed(ids, labels, vectors)
    return rows


def _sums(codebook: np.ndarray):
    """One row per part position, entry and component: the sum and the number of its parts."""
    parts, entries, size = codebook.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, size), object)
        counts = np.zeros((parts, entries), np.int64)
        books = Books(codebook)
        for batch in batches:
            for row in batch.to_pylist():
                for position, (tree, book) in enumerate(books.trees(row)):
                    labels, whole, single = assign(tree, book, book.order)
                    counts[position] += np.bincount(labels, minlength=entries)
                    into = np.zeros((entries, size), tree.points.dtype)
                    for depth, nodes, numbers in whole:
                        np.add.at(into, numbers, tree.levels[depth][2][nodes])
                    np.add.at(into, labels[single], tree.points[single])
                    totals[position] += _whole(into)
        used = np.argwhere(counts)
        if not len(used) or not size:
            return
        place = np.repeat(used, size, axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place[:, 0], pa.int32()), pa.array(place[:, 1], pa.int32()),
             pa.array(np.tile(np.arange(size), len(used)), pa.int32()),
             pa.array([str(x) for p, e in used.tolist() for x in totals[p, e]]),
             pa.array(counts[place[:, 0], place[:, 1]])],
            names=["part", "entry", "place", "total", "n"])
    return rows


def _whole(values: np.ndarray) -> np.ndarray:
    """Whole numbers held in doubles as Python's whole numbers."""
    return values if values.dtype == object else values.astype(np.int64).astype(object)


def _codes(codebook: np.ndarray):
    parts, entries, _ = codebook.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = Books(codebook)
        for batch in batches:
            for row in batch.to_pylist():
                count = len(row["ids"])
                codes, errors = np.zeros((count, parts), np.int64), np.zeros(count, object)
                for position, (tree, book) in enumerate(books.trees(row)):
                    labels, _, _ = assign(tree, book, book.order)
                    codes[tree.order, position] = labels
                    off = tree.points - book.by_number[labels]
                    errors[tree.order] += _whole(_squares(off))
                digits = "%0" + str(max(2, len(f"{entries - 1:x}"))) + "x"
                text = ["".join([digits % x for x in code]) for code in codes.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()),
                     pa.array(text), pa.array([min(int(e), LIMIT.max) for e in errors], pa.int64())],
                    names=["id", "label", "code", "error"])
    return rows


def first_entries(kept: DataFrame, entries: int, width: int, parts: int,
                  scale: int) -> np.ndarray:
    """Codebooks of the rows with the smallest ids, by part position, entry and component."""
    first = kept.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(entries)
    whole = whole_numbers([row["vector"] for row in first.collect()], width, scale)
    return whole.reshape(len(whole), parts, width // parts).transpose(1, 0, 2)


def moved(codebook: np.ndarray, chunks: DataFrame) -> np.ndarray:
    """The codebook after one round; ``entries * width`` sums come back at most."""
    sums = map_arrow(chunks.select("ids", "vectors", "orders"), _sums(codebook),
                     "part int, entry int, place int, total string, n long")
    found = sums.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    after = codebook.copy()
    for row in found.toArrow().to_pylist():
        after[row["part"], row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return after


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
             label: str = "label", scale: int = 1024, parts: int = 4, entries: int = 256,
             rounds: int = 4) -> tuple[DataFrame, np.ndarray]:
    """``id``, ``label``, ``code`` and ``error`` of every kept row, as a stored table, and the final
    codebooks by part position, entry and component."""
    values = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(values.isNotNull() & finite).select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"), values.alias("vector"))
    width = kept.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        empty = kept.sparkSession.createDataFrame(
            [], "id long, label string, code string, error long")
        return empty, np.zeros((parts, 0, 0), np.int64)
    width = -(-width // parts) * parts
    chunks = stored(map_arrow(
        kept, _chunks(width, parts, scale),
        "ids array<long>, labels array<string>, vectors binary, orders binary"), "vector-trees")
    codebook = first_entries(kept, entries, width, parts, scale)
    for _ in range(rounds):
        codebook = moved(codebook, chunks)
    codes = map_arrow(chunks, _codes(codebook), "id long, label string, code string, error long")
    return stored(codes, "vector-codes"), codebook


def codebook_text(codebook: np.ndarray) -> str:
    """All components by part position, entry and place, joined by commas."""
    return ",".join(map(str, codebook.reshape(-1).tolist()))


def digest(codes: DataFrame, codebook: np.ndarray) -> DataFrame:
    """The rows with the error of their label and the hash of the codebooks.

    Errors are summed before they meet the rows, so a label with very many rows is one row of the
    smaller side."""
    totals = stored(codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)"))
                                               .alias("total")), "label-errors")
    named = totals.select(F.col("label").alias("of"), "total")
    most = F.lit(int(LIMIT.max)).cast("decimal(38,0)")
    return codes.join(named, codes["label"].eqNullSafe(named["of"])).select(
        F.col("id").alias("vec_id"), "code", "error",
        F.least("total", most).cast("long").alias("label_error"),
        F.lit(hashlib.sha256(codebook_text(codebook).encode()).hexdigest())
        .alias("codebooks_sha256"))
