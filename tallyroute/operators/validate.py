"""Row checks: each row keeps its place and gets a status and a reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PENDING, FAILED, SUCCESS = "PENDING", "FAILED", "SUCCESS"
CLEAN = "OK"


@dataclass(frozen=True)
class Check:
    """``bad`` is true for a faulty row; NULL counts as not faulty."""

    message: str | Column
    bad: Column

    def text(self) -> Column:
        return self.message if isinstance(self.message, Column) else F.lit(self.message)


def _chain(checks: Sequence[Check], remark: str, status: str, df: DataFrame) -> DataFrame:
    reason = None
    for check in checks:
        reason = (reason if reason is not None else F).when(check.bad, check.text())
    return df.withColumn(remark, reason if reason is not None else F.lit(None).cast("string")) \
        .withColumn(
            status, F.when(F.col(remark).isNull(), F.lit(PENDING)).otherwise(F.lit(FAILED))
        )


def first_failure(
    df: DataFrame, checks: Sequence[Check], status: str = "process_status",
    remark: str = "remarks",
) -> DataFrame:
    """The earliest failing check names the reason."""
    return _chain(checks, remark, status, df)


def last_failure(
    df: DataFrame, checks: Sequence[Check], status: str = "process_status",
    remark: str = "remarks",
) -> DataFrame:
    """The latest failing check names the reason, as repeated overwriting does."""
    return _chain(list(reversed(checks)), remark, status, df)


def all_failures(df: DataFrame, checks: Sequence[Check], errors: str = "errors") -> DataFrame:
    """Every failing check, in order, as an array; an empty array means a valid row."""
    found = F.array(*[F.when(check.bad, check.text()) for check in checks])
    return df.withColumn(errors, F.array_compact(found))


def remark_text(errors: str = "errors", separator: str = " | ") -> Column:
    return F.when(F.size(errors) == 0, F.lit(CLEAN)).otherwise(F.array_join(errors, separator))


def stage(df: DataFrame, steps: Sequence[tuple[Column, str]], default: str, name: str = "stage"):
    """Label of the furthest step reached; list the furthest step first."""
    label = None
    for reached, text in steps:
        label = (label if label is not None else F).when(reached, F.lit(text))
    return df.withColumn(name, label.otherwise(F.lit(default)))
