"""Stack report branches and aligned sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """All rows; a column missing in a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged(branches: Mapping[str, DataFrame], tag: str = "flag") -> DataFrame:
    """Report branches under one another, each marked by its name."""
    return stack(*[df.withColumn(tag, F.lit(name)) for name, df in branches.items()])


def distinct_stack(*frames: DataFrame) -> DataFrame:
    return stack(*frames).distinct()


def column_differences(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Columns only one side has."""
    left, right = set(a.columns), set(b.columns)
    return {"missing": sorted(left - right), "extra": sorted(right - left)}
