"""Append-only import that skips keys already present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.operators.pick import nth_by


def import_counts(
    incoming: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bad: Column | None = None,
) -> DataFrame:
    """How many rows an import inserts, skips and fails.

    The first row of a key wins inside the file, repeats and known keys are skipped; a row
    without its key, or with ``bad``, fails and stops no other row.
    """
    faulty = F.lit(False) if bad is None else F.coalesce(bad, F.lit(False))
    for key in keys:
        faulty = faulty | F.col(key).isNull()
    marked = incoming.withColumn("__bad", faulty)
    good = marked.where(~F.col("__bad"))
    first = nth_by(good, keys, list(order)).join(
        target.select(*keys).distinct(), list(keys), "left_anti"
    )
    fresh = first.withColumn("outcome", F.lit("inserted"))
    known = (
        good.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        .join(fresh.select(*keys, F.lit(1).alias("__one")), list(keys), "left")
        .select((F.col("__n") - F.coalesce("__one", F.lit(0))).alias("rows"))
    )
    return (
        fresh.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))
        .unionByName(known.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
                     .select(F.lit("skipped").alias("outcome"), "rows"))
        .unionByName(marked.where("__bad").agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit("failed").alias("outcome"), "rows"))
    )


def new_rows(
    incoming: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Rows to append: one per new key."""
    present = incoming
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    return nth_by(present, keys, list(order)).join(
        target.select(*keys).distinct(), list(keys), "left_anti"
    )
