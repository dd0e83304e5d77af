"""Audit frames, run summaries and their sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyroute.operators.changes import EXECUTE, Run
from tallyroute.operators.validate import remark_text

#: audit columns of a quota transfer run.  Fixed values.
TRANSFER_AUDIT = (
    "full_name", "transfer_to_email", "lead_id", "contact_id", "old_rm_id", "new_rm_id",
    "status_id", "substatus_id", "new_mapping_id", "session_id", "remarks", "transfer_status",
)


def audit_frame(df: DataFrame, columns: Sequence[str], errors: str | None = None) -> DataFrame:
    """Fixed column list; a column the rows lack is NULL; errors become the remarks text."""
    if errors is not None:
        df = df.withColumn("remarks", remark_text(errors))
    return df.select(
        *[F.col(name) if name in df.columns else F.lit(None).alias(name) for name in columns]
    )


def status_counts(audit: DataFrame, status: str = "process_status") -> DataFrame:
    return audit.groupBy(status).agg(F.count(F.lit(1)).alias("rows"))


def run_summary(audit: DataFrame, run_id: str, status: str = "transfer_status") -> DataFrame:
    """One row per run: total, succeeded, failed."""
    return audit.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.lower(status) == "success").alias("succeeded"),
        F.count_if(F.lower(status) == "failed").alias("failed"),
    ).select(F.lit(run_id).alias("run_id"), "total", "succeeded", "failed")


def settle(audit: DataFrame, run: Run, status: str = "process_status",
           remark: str = "remarks", done: str = "TRANSFERRED") -> DataFrame:
    """Final status of validated rows: what was pending succeeded; a dry run says so instead."""
    pending = F.col(status) == "PENDING"
    good = done if run.mode == EXECUTE else f"{done} (DRY RUN)"
    return audit.withColumns(
        {status: F.when(pending, "SUCCESS").otherwise(F.col(status)),
         remark: F.when(pending, good).otherwise(F.col(remark))}
    )


def write_audit(audit: DataFrame, folder: str, run_id: str, fmt: str = "csv") -> str:
    """Write one folder per run; a retried run replaces its own folder only."""
    path = f"{folder.rstrip('/')}/run_id={run_id}"
    arrays = [f.name for f in audit.schema.fields if f.dataType.typeName() == "array"]
    if fmt == "csv":
        audit = reduce(
            lambda df, name: df.withColumn(
                name, F.array_join(F.col(name).cast("array<string>"), " | ")),
            arrays, audit,
        )
    audit.write.mode("overwrite").option("header", True).format(fmt).save(path)
    return path


def write_with_summary(
    audit: DataFrame, folder: str, run_id: str, status: str = "transfer_status", fmt: str = "csv",
) -> tuple[str, DataFrame]:
    """Write an audit and return its folder and its :func:`run_summary`, counted by the pass that
    writes.  The counts belong to the tasks of the last stage, each of which counts once however
    often it is tried."""
    seen = Observation()
    counted = audit.observe(
        seen, F.count(F.lit(1)).alias("total"),
        F.count_if(F.lower(status) == "success").alias("succeeded"),
        F.count_if(F.lower(status) == "failed").alias("failed"))
    path = write_audit(counted, folder, run_id, fmt)
    found = seen.get
    return path, audit.sparkSession.createDataFrame(
        [(run_id, found["total"], found["succeeded"], found["failed"])],
        "run_id STRING, total BIGINT, succeeded BIGINT, failed BIGINT")
