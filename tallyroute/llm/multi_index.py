"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length one and cut into two halves, and each half is quantised by a codebook of
its own.  A pair of centroids is a *cell*; every row is filed in the cell of its halves' nearest
centroids.  A query goes through the cells in order of the summed squared distance of its halves
from the two centroids.  A heap holds the next pairs, so that no more of them are looked at than are
taken.  It stops when the cells taken hold enough rows, and the rows in them are ranked again by the
cosine of the original vectors, in double precision.

*How many rows are enough* is measured and not guessed: for a bounded sample of queries all rows are
compared, and each true neighbour tells how many rows the cells up to its own hold.  The depth that
takes ``recall`` of these neighbours serves all queries, so recall holds whatever the data look like.

*How it runs.*  The codebooks are fitted on a bounded sample (``SAMPLE`` rows).  Every row is
indexed; rows lie in stored pieces of up to ``PIECE`` rows in the order of the cells, so a cell with
very many rows is several pieces.  Queries are packed into groups of ``GROUP`` in the order of their
own cells, so that a group's queries go through much the same cells.  A group meets the pieces that
hold a cell taken by one of its queries, by joins on the cell; in a meeting a query is compared with
the rows of its cells only, which its last summed distance tells.  Each meeting hands on ``k`` rows
per query at most.

Bounds: the number of centroids of a half is ``2 * N ** (1/4)``, at most ``CENTROIDS``; the sizes of
the cells and the codebooks go to the driver and to the tasks, ``CENTROIDS ** 2`` numbers at most.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components, and rows
without an id, take no part.  Vectors of different lengths: missing components are 0.  A query never
meets rows with its own id.  Rows with equal ids are candidates of their own; of several queries
with one id the smallest vector asks.  Ties go to the smaller id.  A query gets ``k`` rows whenever
there are as many.  Empty tables give no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroute.llm.store import map_arrow, stored

#: rows the codebooks are fitted on, queries the depth is measured on
SAMPLE, ASKED = 16384, 256
#: most centroids of a half, and rounds of their fit
CENTROIDS, ROUNDS = 1024, 12
#: rows in a stored piece, queries in a group
PIECE, GROUP = 1024, 256
NONE = np.iinfo(np.int64).max


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a power of two is taken out first, so nothing overflows."""
    most = np.abs(matrix).max(axis=1, initial=0, keepdims=True)
    scaled = np.ldexp(matrix, -np.frexp(most)[1])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``one`` with the same row of ``others``, summed in one fixed order, so
    that equal vectors score alike wherever they are stored."""
    pair = [np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, initial=0, keepdims=True))[1])
            for m in (one, others)]
    a, b = map(np.ascontiguousarray, pair)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, filled with zeros to ``width``."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    matrix = np.zeros((len(sizes), width))
    matrix[np.arange(width) < sizes[:, None]] = values
    return matrix


def distances(halves: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every row from every centroid."""
    return np.maximum((halves * halves).sum(axis=1)[:, None] - 2 * halves @ centroids.T
                      + (centroids * centroids).sum(axis=1), 0)


def fit(halves: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Centroids of a half by Lloyd's rounds over the sample; empty ones stay where they were."""
    known = np.unique(halves, axis=0)
    chosen = np.random.default_rng(seed).permutation(len(known))[:count]
    centroids = known[np.sort(chosen)]
    for _ in range(ROUNDS):
        near = distances(halves, centroids).argmin(axis=1)
        sizes = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, halves)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


class Codebooks:
    """The centroids of both halves."""

    def __init__(self, first: np.ndarray, second: np.ndarray) -> None:
        self.first, self.second = first, second

    def spread(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of the halves of every vector, scaled to length one, from the centroids."""
        scaled, cut = unit(matrix), self.first.shape[1]
        return distances(scaled[:, :cut], self.first), distances(scaled[:, cut:], self.second)

    def cells(self, matrix: np.ndarray) -> np.ndarray:
        one, two = self.spread(matrix)
        return one.argmin(axis=1) * len(self.second) + two.argmin(axis=1)


def walk(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int]]:
    """Summed distance and number of the cells, nearest first, by a heap of the next pairs.

    Pair ``(i, j)`` of the two sorted lists is pushed when both ``(i - 1, j)`` and ``(i, j - 1)``
    have been taken."""
    order_one, order_two = one.argsort(kind="stable"), two.argsort(kind="stable")
    a, b = one[order_one].tolist(), two[order_two].tolist()
    order_one, order_two = order_one.tolist(), order_two.tolist()
    taken = [0] * len(a)  # how many of a row's pairs are taken
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield total, order_one[i] * len(b) + order_two[j]
        taken[i] = j + 1
        if i + 1 < len(a) and taken[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))


def reach(one: np.ndarray, two: np.ndarray, sizes: list[int], enough: int) -> tuple[float, list[int]]:
    """Summed distance of the last cell a query takes, and the cells taken that hold rows."""
    held, cells, last = 0, [], -1.0
    for total, cell in walk(one, two):
        if held >= enough and total > last:
            break
        last = total
        if sizes[cell]:
            held += sizes[cell]
            cells.append(cell)
    return last, cells


PACKED = "ids binary, vectors binary, cells binary, bounds binary"


def _record(ids, matrix, cells, bounds) -> dict:
    return {"ids": np.asarray(ids, "<i8").tobytes(), "vectors": matrix.astype("<f8").tobytes(),
            "cells": np.asarray(cells, "<i4").tobytes(),
            "bounds": np.asarray(bounds, "<f8").tobytes()}


def _part(number: int) -> str:
    from pyspark import TaskContext

    return f"{TaskContext.get().partitionId()}-{number}"


def _filed(books: Codebooks, width: int):
    """Rows with the number of their cell."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = books.cells(matrix_of(batch["vector"], width))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(cells, pa.int32()), batch["vector"]],
                names=["id", "cell", "vector"])
    return rows


def _slices(batches: Iterator[pa.RecordBatch], size: int, width: int, columns: tuple[str, ...]):
    """Up to ``size`` consecutive rows at a time, as arrays."""
    waiting = []
    held = 0
    for batch in batches:
        start = 0
        while start < len(batch):
            step = min(size - held, len(batch) - start)
            waiting.append(batch.slice(start, step))
            held, start = held + step, start + step
            if held == size:
                yield _joined(waiting, width, columns)
                waiting, held = [], 0
    if held:
        yield _joined(waiting, width, columns)


def _joined(batches: list[pa.RecordBatch], width: int, columns: tuple[str, ...]):
    return (np.concatenate([matrix_of(b["vector"], width) for b in batches]),
            *(np.concatenate([b[name].to_numpy() for b in batches]) for name in columns))


def _pieces(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (matrix, ids, cells) in enumerate(_slices(batches, PIECE, width, ("id", "cell"))):
            record = {"piece": _part(number), "held": np.unique(cells).tolist(),
                      **_record(ids, matrix, cells, [])}
            yield pa.RecordBatch.from_pylist([record], pa.schema([
                ("piece", pa.string()), ("held", pa.list_(pa.int32())),
                *((name, pa.binary()) for name in ("ids", "vectors", "cells", "bounds"))]))
    return rows


def _groups(books: Codebooks, width: int, sizes: np.ndarray, enough: int):
    """Queries packed into groups, each with the cells its queries take."""
    sizes = sizes.tolist()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = _slices(batches, GROUP, width, ("id", "cell", "own"))
        for number, (matrix, ids, cells, own) in enumerate(slices):
            one, two = books.spread(matrix)
            bounds, taken = [], set()
            for k in range(len(ids)):
                last, cells_taken = reach(one[k], two[k], sizes, enough + int(own[k]))
                bounds.append(last)
                taken.update(cells_taken)
            record = {"part": _part(number), "taken": sorted(taken),
                      **_record(ids, matrix, cells, bounds)}
            yield pa.RecordBatch.from_pylist([record], pa.schema([
                ("part", pa.string()), ("taken", pa.list_(pa.int32())),
                *((name, pa.binary()) for name in ("ids", "vectors", "cells", "bounds"))]))
    return rows


class Packed:
    """A stored piece or group with its arrays."""

    def __init__(self, row: dict, side: str, width: int) -> None:
        self.ids = np.frombuffer(row[f"{side}ids"], "<i8")
        self.matrix = np.frombuffer(row[f"{side}vectors"], "<f8").reshape(len(self.ids), width)
        self.cells = np.frombuffer(row[f"{side}cells"], "<i4")
        self.bounds = np.frombuffer(row[f"{side}bounds"], "<f8")


#: scores this near the k-th are computed once more in the fixed order
CLOSE = 1e-9


def best(ids: np.ndarray, asked: np.ndarray, rows: Packed, allowed: np.ndarray, k: int):
    """Query number, row number and cosine of each query's best rows among those ``allowed``."""
    allowed = allowed & (rows.ids != ids[:, None])
    scores = np.where(allowed, unit(asked) @ unit(rows.matrix).T, -np.inf)
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k][:, None]
    else:
        least = np.full((len(scores), 1), -np.inf)
    who, what = np.nonzero(allowed & (scores >= least - CLOSE))
    exact = np.empty(len(who))
    for start in range(0, len(who), 1 << 14):
        span = slice(start, start + (1 << 14))
        exact[span] = cosines(asked[who[span]], rows.matrix[what[span]])
    order = np.lexsort((rows.ids[what], -exact, who))
    who, what, exact = who[order], what[order], exact[order]
    heads = np.searchsorted(who, who)
    top = np.arange(len(who)) - heads < k
    return who[top], what[top], exact[top]


def _meet(books: Codebooks, width: int, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                asked, held = Packed(row, "q_", width), Packed(row, "", width)
                one, two = books.spread(asked.matrix)
                first, second = np.divmod(held.cells, len(books.second))
                # a little further, so that no machine's rounding leaves out a cell that was taken
                allowed = one[:, first] + two[:, second] <= asked.bounds[:, None] + CLOSE
                who, what, scores = best(asked.ids, asked.matrix, held, allowed, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked.ids[who]), pa.array(held.ids[what]), pa.array(scores)],
                    names=["query_id", "vec_id", "score"])
    return rows


def _compared(ids: np.ndarray, asked: np.ndarray, width: int, k: int):
    """The best rows of a stored piece for the sample of queries, with their cells."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                held = Packed(batch.slice(at, 1).to_pylist()[0], "", width)
                everything = np.ones((len(ids), len(held.ids)), bool)
                who, what, scores = best(ids, asked, held, everything, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[who]), pa.array(held.ids[what]), pa.array(scores),
                     pa.array(held.cells[what])], names=["query_id", "vec_id", "score", "cell"])
    return rows


def ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def taking_part(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` in doubles of the rows that take part."""
    values = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(f"`{key}`").isNotNull() & values.isNotNull() & finite
                         & F.exists(values, lambda x: x != 0)).select(
        F.col(f"`{key}`").cast("long").alias("id"), values.alias("vector"))


def _sampled(rows: DataFrame, count: int, most: int) -> DataFrame:
    """About ``most`` different rows chosen by hash, and never more."""
    mark = F.xxhash64("id", "vector")
    share = min(1.0, 1.25 * most / max(count, 1))
    below = rows.where(F.pmod(mark, F.lit(1 << 30)) < int(share * (1 << 30)))
    return below.distinct().orderBy(F.xxhash64("vector", "id"), "id").limit(most)


def _matrix(rows: list, width: int) -> np.ndarray:
    matrix = np.zeros((len(rows), width))
    for held, row in zip(matrix, rows):
        held[:len(row["vector"])] = row["vector"]
    return matrix


class Index:
    """A stored multi-index: its pieces, codebooks and the sizes of its cells."""

    def __init__(self, rows: DataFrame) -> None:
        count, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
        self.count, self.width = count, width or 0
        if not count:
            return
        centroids = min(CENTROIDS, max(1, round(2 * count ** 0.25)))
        sample = unit(_matrix(_sampled(rows, count, SAMPLE).collect(), self.width))
        cut = (self.width + 1) // 2
        self.books = Codebooks(fit(sample[:, :cut], centroids, 1), fit(sample[:, cut:], centroids, 2))
        filed = stored(map_arrow(rows, _filed(self.books, self.width),
                                 "id long, cell int, vector array<double>"), "filed")
        self.sizes = np.zeros(len(self.books.first) * len(self.books.second), np.int64)
        for row in filed.groupBy("cell").count().collect():
            self.sizes[row["cell"]] = row["count"]
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # the id is part of the range's key, so that a cell with very many rows is cut
        spread = filed.repartitionByRange(parts, "cell", F.xxhash64("id", "vector"))
        self.pieces = stored(map_arrow(
            spread.sortWithinPartitions("cell"), _pieces(self.width),
            f"piece string, held array<int>, {PACKED}"), "pieces")

    def depth(self, asking: DataFrame, k: int, recall: float) -> int:
        """Rows the cells of a query must hold, so that ``recall`` of the true neighbours of the
        sampled queries are among them."""
        rows = _sampled(asking.select("id", "vector"), asking.count(), ASKED).collect()
        if not rows:
            return k
        ids, asked = np.array([r["id"] for r in rows]), _matrix(rows, self.width)
        found = map_arrow(self.pieces, _compared(ids, asked, self.width, k),
                          "query_id long, vec_id long, score double, cell int")
        cells: dict[int, list[int]] = {}
        for row in ranked(found, k).select("query_id", "cell").collect():
            cells.setdefault(row["query_id"], []).append(row["cell"])
        one, two = self.books.spread(asked)
        needed = []
        for k_th, query in enumerate(ids.tolist()):
            totals = (one[k_th][:, None] + two[k_th]).reshape(-1)
            order = totals.argsort(kind="stable")
            held = np.cumsum(self.sizes[order])
            # cells as far away as the neighbour's own may be taken before it
            last = np.searchsorted(totals[order], totals[cells.get(query, [])], "right") - 1
            needed += held[last].tolist()
        needed.sort()
        return max(k, needed[min(len(needed) - 1, int(recall * len(needed)))] if needed else k)


def search(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id",
           vector: str = "embedding", recall: float = 0.95) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` for every row that ``is_query``
    selects, against all rows."""
    index = Index(taking_part(vectors, key, vector))
    spark = vectors.sparkSession
    if not index.count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asking = taking_part(vectors.where(is_query), key, vector)
    asking = asking.groupBy("id").agg(F.min("vector").alias("vector"), F.count(F.lit(1)).alias("own"))
    asking = stored(asking, "asking")
    enough = index.depth(asking, k, recall)
    books, width = index.books, index.width
    filed = map_arrow(asking.select("id", "vector"), _filed(books, width),
                      "id long, cell int, vector array<double>").join(
                          asking.select("id", "own"), "id")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = stored(map_arrow(
        filed.repartitionByRange(parts, "cell", "id").sortWithinPartitions("cell", "id"),
        _groups(books, width, index.sizes, enough), f"part string, taken array<int>, {PACKED}"),
        "groups")
    names = PACKED.replace(" binary", "").split(", ")
    wanted = groups.select("part", F.explode("taken").alias("cell"))
    directory = index.pieces.select("piece", F.explode("held").alias("cell"))
    meetings = stored(wanted.join(directory, "cell").select("part", "piece").distinct(), "meetings")
    met = (
        meetings.join(groups.select("part", *[F.col(n).alias(f"q_{n}") for n in names]), "part")
        .join(index.pieces.select("piece", *names), "piece").drop("part", "piece"))
    found = map_arrow(met, _meet(books, width, k), "query_id long, vec_id long, score double")
    return ranked(found, k).select("query_id", "rank", "vec_id", "score")
