"""Hand out work: round robin, balanced groups, quotas, and the climb to a responsible manager."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.operators.running import dense_index, running_by
from tallyroute.session import cut_lineage

#: slots unfolded from one array while expanding quotas
SLOT_BLOCK = 100_000


def turn(owners: Sequence[int], position: Column) -> Column:
    """Owner whose turn it is at a 0-based position."""
    seats = F.array(*[F.lit(owner).cast("bigint") for owner in owners])
    return F.element_at(seats, (position % len(owners) + 1).cast("int"))


def first_n(df: DataFrame, unique_id: str, n: int) -> DataFrame:
    """First ``n`` rows along a unique id, for a batch too large for a driver-side top-k."""
    return dense_index(df, unique_id, "__idx").where(F.col("__idx") < n).drop("__idx")


def round_robin(
    df: DataFrame,
    unique_id: str,
    owners: Sequence[int],
    name: str = "new_owner",
    limit: int | None = None,
) -> DataFrame:
    """Deal rows in id order to the owners in turn; ``limit`` keeps the first rows only."""
    indexed = dense_index(df, unique_id, "__idx")
    if limit is not None:
        indexed = indexed.where(F.col("__idx") < limit)
    return indexed.withColumn(name, turn(owners, F.col("__idx"))).drop("__idx")


def balanced_reassign(
    df: DataFrame,
    groups: Sequence[str],
    holder: str,
    owners: Sequence[int],
    created: str,
    surrogate: str,
    name: str = "new_owner",
) -> DataFrame:
    """Per group the newest row held by a listed owner stays; the others are dealt in turn.

    ``kept`` tells the two kinds apart.  ``surrogate`` is unique within a group and group
    columns are not NULL.  All rows are numbered along (created, surrogate) in one pass; the rows
    behind the one that stays move up by one turn.
    """
    def rank() -> Column:
        return F.struct(F.col(created).isNull().alias("n"), F.col(created).alias("c"),
                        F.col(surrogate).alias("s"))

    held = F.coalesce(F.col(holder).isin(list(owners)), F.lit(False))
    stays = df.where(held).groupBy(*groups).agg(F.max(rank()).alias("__stays"))
    numbered = running_by(df, groups, [created, surrogate], number="__turn")
    dealt = numbered.join(stays, list(groups), "left").withColumns({
        "kept": F.coalesce(F.col("__stays") == rank(), F.lit(False)),
        "__behind": F.coalesce(rank() > F.col("__stays"), F.lit(False)).cast("int")})
    return dealt.select(
        *df.columns,
        F.when(F.col("kept"), F.col(holder).cast("bigint"))
        .otherwise(turn(owners, F.col("__turn") - F.col("__behind") - 1)).alias(name),
        "kept",
    )


def quota_ranges(
    requests: DataFrame,
    pool: DataFrame,
    owner: str,
    quota: str,
    row_id: str,
) -> DataFrame:
    """Per request the slice ``[lo, hi)`` of its owner's pool, in row order.

    A request takes at most what is left, possibly nothing.
    """
    stock = pool.groupBy(owner).agg(F.count(F.lit(1)).alias("__stock"))
    ranged = running_by(requests, [owner], [row_id], sums={"__asked_before": quota})
    left = F.coalesce(F.col("__stock"), F.lit(0)).cast("bigint")
    lo = F.least(F.col("__asked_before").cast("bigint"), left)
    hi = F.least(F.col("__asked_before").cast("bigint") + F.col(quota), left)
    return (
        ranged.join(stock, owner, "left")
        .withColumns({"lo": lo, "hi": hi})
        .drop("__stock", "__asked_before")
    )


def quota_allocate(
    requests: DataFrame,
    pool: DataFrame,
    owner: str,
    quota: str,
    row_id: str,
    pool_id: str,
) -> tuple[DataFrame, DataFrame]:
    """Give each request the next ``quota`` rows of its owner's pool, in request order.

    Returns (allocations: row id, owner, pool id, slot; requests with their slice).  A slice
    is unfolded to single slots in two bounded steps, and slots meet pool rows by an equality
    join on (owner, slot): one partner each, whatever the size of the owner.
    """
    wanted = pool.join(requests.select(owner).distinct(), owner, "left_semi")
    ranges = quota_ranges(requests, wanted, owner, quota, row_id)
    taken = ranges.where(F.col("hi") > F.col("lo")).select(row_id, owner, "lo", "hi")
    blocks = taken.withColumn(
        "__from", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(SLOT_BLOCK).cast("bigint")))
    )
    slots = blocks.select(
        row_id,
        owner,
        F.explode(
            F.sequence("__from", F.least(F.col("__from") + SLOT_BLOCK, F.col("hi")) - 1)
        ).alias("slot"),
    )
    ranked = running_by(wanted, [owner], [pool_id], number="__rank").select(
        "*", (F.col("__rank") - 1).alias("slot")).drop("__rank")
    return ranked.join(slots, [owner, "slot"]), ranges


def climb_hierarchy(
    users: DataFrame, user: str, manager: str, qualifies: Column, fallback: int
) -> DataFrame:
    """For every user the first qualifying person on the way up, the user included.

    Each round doubles the distance looked ahead and is checkpointed to keep the plan flat.  A
    chain is at most as long as there are users, so ``log2(users) + 1`` rounds reach every top;
    who is still on the way then goes round in a cycle.  Cycles and missing managers end at
    ``fallback``.
    """
    state = cut_lineage(users.select(
        F.col(user).alias("node"),
        F.when(qualifies, F.col(user)).alias("found"),
        F.when(~F.coalesce(qualifies, F.lit(False)), F.col(manager)).alias("up"),
    ))
    for _ in range(math.ceil(math.log2(max(2, state.count()))) + 1):
        if state.where(F.col("found").isNull() & F.col("up").isNotNull()).isEmpty():
            break
        ahead = state.select(
            F.col("node").alias("up"), F.col("found").alias("__f"), F.col("up").alias("__u")
        )
        state = cut_lineage(state.join(ahead, "up", "left").select(
            "node",
            F.coalesce("found", "__f").alias("found"),
            F.when(F.col("found").isNull() & F.col("__f").isNull(), F.col("__u")).alias("up"),
        ))
    return state.select(
        F.col("node").alias(user),
        F.coalesce(F.col("found"), F.lit(fallback)).alias("responsible"),
    )
