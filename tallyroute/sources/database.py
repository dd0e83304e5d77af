"""Options for a partitioned database read; credentials and driver come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str,
    *,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """JDBC options; with a numeric key column the read is split into ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if column is None:
        return options
    if lower is None or upper is None or upper <= lower:
        raise ValueError("a partition column needs lower < upper")
    return options | {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(max(1, min(partitions, upper - lower))),
    }


def read_database(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
