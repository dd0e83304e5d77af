"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings every plan in this package relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot foreign key is split even when that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: shuffled bytes up to which Spark merges partitions into one task; sorted, they take 20 to 25 times
#: as much memory in stages that join many histories, several sorts being held at once
PARTITION_BYTES = 16 << 20
_PARTITION_SETTING = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_UNITS = {"": 1, "b": 1, **{unit + end: 1 << 10 * power
                           for power, unit in enumerate("kmgtp", 1) for end in ("", "b")}}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF`, keep merged partitions small and return the session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    held = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get(_PARTITION_SETTING).strip().lower())
    if not held or int(held[1]) * _UNITS[held[2]] > PARTITION_BYTES:  # a smaller setting stays
        spark.conf.set(_PARTITION_SETTING, str(PARTITION_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    A path without its file system lies in the cluster's default one; it is taken as Spark has
    completed it, which is where checkpoints go too.  Only a local master may fall back to a
    temporary folder; a cluster without the setting is an error, because a machine-local folder
    would be lost with its executor, and so is a path that nobody has completed.
    """
    context = spark.sparkContext
    known = [folder for folder in (spark.conf.get("spark.checkpoint.dir", None),
                                   context.getCheckpointDir()) if folder]
    local = context.master.startswith("local") and not context.master.startswith("local-cluster")
    for folder in known:
        if local or re.match(r"[A-Za-z][\w+.-]*:/", folder):
            return folder
    if known:
        raise RuntimeError(f"spark.checkpoint.dir ({known[0]}) must name its file system, as in"
                           " hdfs://…, so that no executor takes it for a folder of its own")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyroute-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never reused between runs.

    All paths of an application lie in one folder named after it, so that its owner can remove them
    together once the results are read.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/{application}/{label}-{uuid.uuid4().hex}"


_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files as they end, not when the driver next collects
    its garbage."""
    held = spark.conf.get(_CLEANUP_SETTING, None)
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(_CLEANUP_SETTING)
        else:
            spark.conf.set(_CLEANUP_SETTING, held)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: computed once, read by several.

    Only the rows stay on disk; what was shuffled for them is removed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later plans read the stored rows, and a lost executor is harmless."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
