"""Exact top-k by inner product, block by block with score bounds.

Vectors are made whole numbers, ``floor(scale * x)``.  They are dealt into ranges of ids, and
each range into *blocks*; a stored row holds the forward index of a range: ids, components, and
per block the smallest and largest component of every term.  The stated queries are packed into
groups.

1. The extremes of every range travel to the groups; a query's *reach* in a range is the largest
   score a block of it can give, the sum over the query's terms of the largest product.
2. Every group meets the one range of the largest reach, which gives each query a k-th score: its
   *floor*, from which it starts in all other ranges.
3. A group meets a range only if the reach of one of its queries there is not below the query's
   floor.  Groups travel, a range is read and moved once however many groups it meets.  There, a
   query orders the blocks by bound, scores them from the best on, and stops when the bound falls
   below its k-th score or its floor.

Blocks are skipped only when no vector in them can enter, so the result is exact.  Each meeting
hands on at most k rows per query, none below its floor; the last step ranks these.

Products are summed in double precision, exact below 2**53; beyond that bound the sums are made
with Python's whole numbers, and scores outside 64 bits are cut to the nearest 64-bit number.

Defined results: vectors that are NULL or hold NULL or non-finite components, and rows without an
id, take no part.  Vectors of different lengths: missing components are 0.  A query never meets
rows with its own id.  Rows with equal ids are candidates of their own; of several queries with
one id the smallest vector asks.  Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroute.llm.store import map_arrow, stored

#: vectors in a block, blocks in a stored range, queries in a group
BLOCK, RANGE, GROUP = 128, 32, 512
EXACT = float(1 << 53)

PACKED = "part string, ids binary, width int, vectors binary, low binary, high binary"


def _packed(ids: list, vectors: list, number: int, block: int) -> pa.RecordBatch:
    width = max(map(len, vectors))
    matrix = np.zeros((len(vectors), width))
    for row, vector in zip(matrix, vectors):
        row[:len(vector)] = vector
    cuts = np.arange(0, len(matrix), block)
    low, high = (f.reduceat(matrix, cuts, axis=0) if width else matrix[cuts]
                 for f in (np.minimum, np.maximum))
    from pyspark import TaskContext

    part = f"{TaskContext.get().partitionId()}-{number}"
    return pa.RecordBatch.from_arrays(
        [pa.array([part]), pa.array([np.array(ids, "<i8").tobytes()]),
         pa.array([width], pa.int32()),
         *(pa.array([x.astype("<f8").tobytes()], pa.binary()) for x in (matrix, low, high))],
        names=["part", "ids", "width", "vectors", "low", "high"])


def _pack(size: int, block: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, number = [], [], 0
        for batch in batches:
            values = batch["vector"].flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch["vector"].value_lengths().to_numpy(zero_copy_only=False))
            for one, vector in zip(batch["id"].to_pylist(), np.split(values, ends[:-1])):
                ids.append(one)
                vectors.append(vector)
                if len(ids) == size:
                    yield _packed(ids, vectors, number, block)
                    ids, vectors, number = [], [], number + 1
        if ids:
            yield _packed(ids, vectors, number, block)
    return rows


class Packed:
    """A stored range or group with its arrays."""

    def __init__(self, row: dict, side: str) -> None:
        width = row[f"{side}width"]
        self.ids = np.frombuffer(row[f"{side}ids"], "<i8")
        self.width = width
        self.vectors, self.low, self.high = (
            np.frombuffer(row[f"{side}{name}"], "<f8").reshape(-1, width) if width
            else np.zeros((len(self.ids) if name == "vectors" else 1, 0))
            for name in ("vectors", "low", "high"))

    def widen(self, width: int) -> None:
        extra = width - self.width
        if extra:
            self.vectors, self.low, self.high = (
                np.pad(x, ((0, 0), (0, extra))) for x in (self.vectors, self.low, self.high))


def _whole(values: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


def _level(asked: Packed, docs: Packed) -> bool:
    """Bring both sides to one width; whether their products are exact in double precision."""
    width = max(asked.width, docs.width)
    asked.widen(width)
    docs.widen(width)
    largest = max([np.abs(x).max(initial=0) for x in (asked.vectors, docs.low, docs.high)])
    return width * largest * largest < EXACT


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def best(asked: Packed, docs: Packed, k: int, block: int,
         floors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores (largest id and minus infinity where missing) of each query's best vectors
    that are not below its floor, and the number of blocks scored."""
    exact = _level(asked, docs)
    queries, vectors, low, high = asked.vectors, docs.vectors, docs.low, docs.high
    if not exact:
        queries, vectors, low, high = map(_whole, (queries, vectors, low, high))
    none = -np.inf
    floors = np.full(len(queries), none) if floors is None else floors
    bounds = _bounds(queries, low, high)
    scored = 0
    order = np.argsort(-bounds, axis=1, kind="stable")
    scores = np.full((len(queries), k), none, object if not exact else float)
    found = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)
    waiting = np.arange(len(queries))
    for turn in range(bounds.shape[1]):
        turns = order[waiting, turn]
        alive = ((bounds[waiting, turns] >= scores[waiting, -1])
                 & (bounds[waiting, turns] >= floors[waiting])).astype(bool)
        waiting, turns = waiting[alive], turns[alive]
        if not len(waiting):
            break
        scored += len(waiting)
        for which in np.unique(turns):
            rows = waiting[turns == which]
            span = slice(which * block, (which + 1) * block)
            new = queries[rows] @ vectors[span].T
            ids = np.broadcast_to(docs.ids[span], new.shape)
            new = np.where(ids == asked.ids[rows][:, None], none, new)
            all_scores = np.concatenate([scores[rows], new], axis=1)
            all_ids = np.concatenate([found[rows], ids], axis=1)
            all_ids = np.where(all_scores == none, np.iinfo(np.int64).max, all_ids)
            top = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            scores[rows] = np.take_along_axis(all_scores, top, 1)
            found[rows] = np.take_along_axis(all_ids, top, 1)
    below = scores < floors[:, None]
    return (np.where(below, np.iinfo(np.int64).max, found), np.where(below, none, scores), scored)


def reach(asked: Packed, extremes: Packed) -> np.ndarray:
    """Per query the largest bound of a block; infinite where doubles may be wrong."""
    if not _level(asked, extremes):
        return np.full(len(asked.vectors), np.inf)
    return _bounds(asked.vectors, extremes.low, extremes.high).max(axis=1)


def _names(row: dict, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"q_part": row["q_part"], "part": row["part"], **values}])


def _reaches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            far = reach(Packed(row, "q_"), Packed({"ids": b"", "vectors": b"", **row}, ""))
            yield _names(row, total=float(far.sum()), reach=far.astype("<f8").tobytes())


def _floors(k: int, block: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked, docs = Packed(row, "q_"), Packed(row, "")
                scores = best(asked, docs, k, block)[1][:, -1]
                if not _level(asked, docs):  # sums beyond doubles are no floors
                    scores = np.full(len(scores), -np.inf)
                yield pa.RecordBatch.from_pylist([{
                    "q_part": row["q_part"], "floors": scores.astype("<f8").tobytes()}])
    return rows


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            if (np.frombuffer(row["reach"]) >= np.frombuffer(row["floors"])).any():
                yield _names(row)


def _meet(k: int, block: int):
    limit = np.iinfo(np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked, docs = Packed(row, "q_"), Packed(row, "")
                found, scores, _ = best(asked, docs, k, block, np.frombuffer(row["floors"]))
                real = scores != -np.inf
                who = np.broadcast_to(asked.ids[:, None], found.shape)[real]
                values = [min(max(int(s), limit.min), limit.max) for s in scores[real].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who), pa.array(found[real]), pa.array(values, pa.int64())],
                    names=["query_id", "vec_id", "score"])
    return rows


def whole_vectors(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``id`` and ``vector`` as whole numbers (held as doubles) of the rows that take part."""
    values = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(f"`{key}`").isNotNull() & values.isNotNull() & finite).select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.transform(values, lambda x: F.rint(x * scale) - F.when(
            F.rint(x * scale) > x * scale, 1.0).otherwise(0.0)).alias("vector"))


def meetings(asked: DataFrame, ranges: DataFrame, k: int,
             slots: int) -> tuple[DataFrame, DataFrame]:
    """The names of groups and ranges that have to meet, and the floors of every group."""
    slot = F.pmod(F.xxhash64("part"), F.lit(slots))
    every = F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))
    pairs = asked.select("q_part", F.explode(every).alias("slot")).join(
        ranges.select("part", slot.alias("slot")), "slot")
    extremes = ranges.select("part", "width", "low", "high")
    reached = stored(map_arrow(
        pairs.select("q_part", "part").join(extremes, "part").join(asked, "q_part"),
        _reaches, "q_part string, part string, total double, reach binary"), "reach")
    first = reached.groupBy("q_part").agg(
        F.max_by("part", F.struct("total", "part")).alias("part"))
    floors = stored(map_arrow(
        first.join(asked, "q_part").join(ranges, "part"),
        _floors(k, BLOCK), "q_part string, floors binary"), "floors")
    kept = map_arrow(reached.join(floors, "q_part"), _kept, "q_part string, part string")
    return stored(kept, "meetings"), floors


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id",
          vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` for every row that ``is_query``
    selects, against all rows."""
    whole = whole_vectors(vectors, key, vector, scale)
    asking = whole_vectors(vectors.where(is_query), key, vector, scale)
    asking = asking.groupBy("id").agg(F.min("vector").alias("vector"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stored(map_arrow(
        whole.repartitionByRange(parts, "id").sortWithinPartitions("id"),
        _pack(BLOCK * RANGE, BLOCK), PACKED), "forward-index")
    groups = stored(map_arrow(
        asking.repartitionByRange(max(1, parts // 8), "id"), _pack(GROUP, GROUP), PACKED), "asked")
    asked = groups.select(*[F.col(name).alias(f"q_{name}") for name in groups.columns])
    kept, floors = meetings(asked, ranges, k, parts)
    # groups come to ranges; either join has one row per key on its right side
    met = kept.join(asked.join(floors, "q_part"), "q_part").join(ranges, "part")
    near = map_arrow(met, _meet(k, BLOCK), "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
