"""Tables written to the shared folder between steps, and Arrow functions sent to executors."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyroute.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back.

    Cuts the lineage, so that a lost executor costs its own tasks only, and lets several later
    steps read rows that were computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: bytes of a batch between Spark and a Python worker; both sides hold a few of them
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver did, and keep
    the batches sent to them small.

    On a cluster the package is installed on the executors; there the extra path is harmless.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    held = spark.conf.get(_BATCH_SETTING).removesuffix("b")
    if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:  # a smaller setting stays
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return spark


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package importable in the workers, in batches of bounded size."""
    importable(df.sparkSession)
    return df.mapInArrow(function, schema)
