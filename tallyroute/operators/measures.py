"""Wide conditional aggregates from a specification: one hash aggregate, whatever the width."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def counts_where(conditions: Mapping[str, str]) -> list[Column]:
    """How many rows satisfy each condition."""
    return [F.count_if(F.expr(text)).alias(name) for name, text in conditions.items()]


def sums_where(specs: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Sum of an expression over the rows that satisfy a condition, 0 if none does."""
    return [
        F.sum(F.expr(f"CASE WHEN {condition} THEN {value} ELSE 0 END")).alias(name)
        for name, (condition, value) in specs.items()
    ]


def flags_where(conditions: Mapping[str, str], suffix: str = "") -> list[Column]:
    """0/1 columns; an unknown condition gives 0."""
    return [
        F.expr(f"CASE WHEN {text} THEN 1 ELSE 0 END").alias(name + suffix)
        for name, text in conditions.items()
    ]


def any_positive(df: DataFrame, names: Iterable[str]) -> DataFrame:
    condition = F.lit(False)
    for name in names:
        condition = condition | (F.col(name) > 0)
    return df.where(condition)


def money(column: str | Column) -> Column:
    """Exact sum of a money column, given back as a double."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast(MONEY)).cast("double")


def ever(condition: str) -> Column:
    """1 if any row of the group satisfies the condition, else 0."""
    return F.max(F.expr(f"CASE WHEN {condition} THEN 1 ELSE 0 END"))


def first_along(value: str, order: Sequence[str]) -> Column:
    return F.min_by(F.col(value), _rank(order))


def last_along(value: str, order: Sequence[str]) -> Column:
    return F.max_by(F.col(value), _rank(order))


def _rank(order: Sequence[str]) -> Column:
    """NULLs compare last, so ascending order equals the order of the file."""
    parts = []
    for name in order:
        parts += [F.col(name).isNull().alias(f"{name}_n"), F.col(name)]
    return F.struct(*parts)


def distinct_list(
    df: DataFrame, keys: Sequence[str], value: str, name: str, separator: str = ","
) -> DataFrame:
    """Sorted list of distinct values per key as text.

    Duplicates go before anything is collected, so a hot key holds its distinct values only.
    """
    return (
        df.select(*keys, value)
        .distinct()
        .groupBy(*keys)
        .agg(F.array_join(F.sort_array(F.collect_set(value)), separator).alias(name))
    )


def ordered_text(value: Column, order: Column, separator: str = ",") -> Column:
    """All non-null values of a group in a stated order, repeats included.

    The text itself holds every value, so its size is that of the result.
    """
    pairs = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
    return F.nullif(
        F.array_join(F.transform(F.sort_array(pairs), lambda pair: pair["v"]), separator),
        F.lit(""),
    )


def pivot_counts(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str]
) -> DataFrame:
    """Counts per value as columns; the value list is given, so no extra pass finds it."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)
