"""Schema facts as rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.functions.cleaning import snake_header


def describe(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table, column, position and type; filter with ``like`` as on a catalogue."""
    rows = [
        (table, field.name, position, field.dataType.simpleString())
        for table, df in tables.items()
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(
        rows, "table_name STRING, column_name STRING, ordinal INT, data_type STRING"
    )


def contract(df: DataFrame, required: Iterable[str], rule=snake_header) -> DataFrame:
    """One row per column, present or required: normalised name, state, filled and total rows.

    All counts come from one aggregate over the table.
    """
    wanted, present = set(required), {rule(name): name for name in df.columns}
    facts = []
    for name in sorted(wanted | set(present)):
        state = "missing" if name not in present else "required" if name in wanted else "extra"
        filled = F.count(F.col(f"`{present[name]}`")) if name in present else F.lit(0)
        facts.append(
            F.struct(
                F.lit(name).alias("column_name"), F.lit(state).alias("state"),
                filled.cast("bigint").alias("filled"), F.count(F.lit(1)).alias("total"),
            )
        )
    return df.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))
