"""One row per key.

A filter on ``row_number`` lets Spark drop the losers of every key inside each map task
(WindowGroupLimit, partial) before the exchange, so a key that owns a third of the table sends
only one row per task.  Every order ends in a surrogate id, which makes the pick repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def newest(*columns: str) -> list[Column]:
    """Descending with NULLs first, the order the reports were written for."""
    return [F.col(name).desc_nulls_first() for name in columns]


def oldest(*columns: str) -> list[Column]:
    """Ascending with NULLs last."""
    return [F.col(name).asc_nulls_last() for name in columns]


def nth_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The ``n``-th row of each key; keys with fewer rows are absent."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == n).drop(_RANK)


def latest_by(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return nth_by(df, keys, newest(*order))


def earliest_by(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return nth_by(df, keys, oldest(*order))


def any_by(df: DataFrame, keys: Sequence[str], surrogate: str) -> DataFrame:
    """Where any row would do, take the one with the smallest id."""
    return nth_by(df, keys, oldest(surrogate))


def preferred_by(
    df: DataFrame, keys: Sequence[str], preferred: Column, *order: str
) -> DataFrame:
    """Latest row among those that satisfy ``preferred``, else the latest row at all."""
    return nth_by(df, keys, [F.coalesce(preferred, F.lit(False)).desc(), *newest(*order)])


def as_of_by(
    df: DataFrame, keys: Sequence[str], moment: str, cutoff, *tie: str
) -> DataFrame:
    """Last row strictly before the cutoff."""
    return latest_by(df.where(F.col(moment) < F.lit(cutoff)), keys, moment, *tie)


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: str,
    carry: Sequence[str],
    default: str,
) -> DataFrame:
    """Latest row per key plus its last non-null ``value``, in one aggregate pass.

    Both picks are ``max_by`` aggregates, so they are combined map-side.
    """
    latest = F.max_by(F.struct(*[F.col(name) for name in carry]), F.col(order))
    known = F.max_by(
        F.col(value), F.when(F.col(value).isNotNull(), F.col(order))
    )
    return (
        df.groupBy(*keys)
        .agg(latest.alias("__latest"), known.alias("__known"))
        .select(
            *keys,
            "__latest.*",
            F.coalesce(F.col("__known"), F.lit(default)).alias(value),
        )
    )


def repeated(df: DataFrame, keys: Sequence[str], count: str = "rows") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)
