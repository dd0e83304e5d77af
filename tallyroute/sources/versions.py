"""Tables whose runs write touched buckets only and become visible together.

A table is laid out in buckets by its key, as folders that Spark prunes.  A run brings new and
changed rows per table (see ``Run(delta=True)``).  For each table only the buckets these rows fall
into are read, joined with them and written, to a folder of the run.  When all tables are
written, one file, the run's entry, names the buckets of all of them.  It appears in one step, so a
reader sees every table before the run or every table after it, and a run that stops before it
leaves the old state.  A run id that has an entry is recognised, and its repetition changes nothing.

One run publishes at a time; a second one that started from the same state is refused.  This is no
transaction of a database: rows are not locked, and folders of stopped runs stay until removed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroute.session import stored

ENTRY = ("run_id STRING, place BIGINT, table_name STRING, key STRING, buckets INT,"
         " written ARRAY<INT>, columns STRING")
BUCKET = "__bucket"


def bucket_of(df: DataFrame, key: str, buckets: int) -> Column:
    """Bucket of a row; surrogate ids are dealt by their remainder, other keys by a hash."""
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    number = F.coalesce(F.col(key), F.lit(0)) if whole else F.xxhash64(key)
    return F.pmod(number, F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Prepared:
    """What a run has written and would publish."""

    run_id: str
    place: int
    entry: list[tuple]


class VersionedTables:
    """Tables below ``root``, a folder all executors reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        # a folder of entries is there from the beginning; one with entries stays as it is
        spark.createDataFrame([], ENTRY).write.mode("ignore").json(f"{self.root}/entries")

    def entries(self) -> DataFrame:
        """One row per run and table, as published."""
        return self.spark.read.schema(ENTRY).json(f"{self.root}/entries")

    def _state(self) -> tuple[int, set[str], dict[str, dict]]:
        """Last place, known runs, and per table its key, layout and the run of every bucket.

        A row per run and table comes to the driver, and a number per bucket."""
        place, runs, tables = 0, set(), {}
        for row in sorted(self.entries().collect(), key=lambda r: r["place"]):
            place = max(place, row["place"])
            runs.add(row["run_id"])
            held = tables.setdefault(row["table_name"], {
                "key": row["key"], "buckets": row["buckets"], "columns": row["columns"], "runs": {}})
            held["runs"].update(dict.fromkeys(row["written"], row["run_id"]))
        return place, runs, tables

    def _folder(self, table: str, run_id: str) -> str:
        return f"{self.root}/{table}/run={run_id}"

    def _read(self, table: str, held: dict, buckets: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(held["columns"]))
        paths = [f"{self._folder(table, run)}/{BUCKET}={b}" for b, run in sorted(held["runs"].items())
                 if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _write(self, df: DataFrame, table: str, run_id: str, key: str, buckets: int) -> list[int]:
        """Write a run's rows of a table; returns the buckets that have some."""
        folder = self._folder(table, run_id)
        schema = T.StructType([*df.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        df.withColumn(BUCKET, bucket_of(df, key, buckets)).repartition(BUCKET).write.mode(
            "overwrite").partitionBy(BUCKET).parquet(folder)
        found = self.spark.read.schema(schema).parquet(folder).select(BUCKET).distinct().collect()
        return sorted(row[BUCKET] for row in found)

    def create(self, run_id: str, tables: Mapping[str, tuple[DataFrame, str]],
               buckets: int = 64) -> bool:
        """Lay out new tables, given with their keys."""
        place, runs, known = self._state()
        if run_id in runs:
            return False
        if set(tables) & set(known):
            raise ValueError("these tables are there already")
        entry = [(run_id, place + 1, name, key, buckets,
                  self._write(df, name, run_id, key, buckets), df.schema.json())
                 for name, (df, key) in tables.items()]
        return self.publish(Prepared(run_id, place, entry))

    def table(self, name: str) -> DataFrame:
        """A table as of the last published run."""
        return self._read(name, self._state()[2][name])

    def prepare(self, run_id: str, deltas: Mapping[str, DataFrame]) -> Prepared | None:
        """Write the touched buckets of every table; None for a run that is published already."""
        place, runs, known = self._state()
        if run_id in runs:
            return None
        entry = []
        for name, delta in deltas.items():
            held, delta = known[name], stored(delta, "delta")
            key, buckets = held["key"], held["buckets"]
            touched = {row[0] for row in delta.select(
                bucket_of(delta, key, buckets)).distinct().collect()}
            old = self._read(name, held, touched)
            rows = old.join(delta.select(key), key, "left_anti").select(*old.columns).unionByName(
                delta.select(*[F.col(f.name).cast(f.dataType) for f in old.schema.fields]))
            entry.append((run_id, place + 1, name, key, buckets,
                          self._write(rows, name, run_id, key, buckets), held["columns"]))
        return Prepared(run_id, place, entry)

    def publish(self, prepared: Prepared | None) -> bool:
        """Make all tables of a run visible by one file; False if there is nothing to do."""
        if prepared is None:
            return False
        place, runs, _ = self._state()
        if prepared.run_id in runs:
            return False
        if place != prepared.place:
            raise ValueError("another run was published meanwhile; prepare this one again")
        self.spark.createDataFrame(prepared.entry, ENTRY).coalesce(1).write.mode("append").json(
            f"{self.root}/entries")
        return True

    def apply(self, run_id: str, deltas: Mapping[str, DataFrame]) -> bool:
        return self.publish(self.prepare(run_id, deltas))

    def written(self, run_id: str) -> DataFrame:
        """``table_name``, ``bucket`` and ``buckets`` of what a published run has rewritten."""
        return self.entries().where(F.col("run_id") == run_id).select(
            "table_name", F.explode("written").alias("bucket"), "buckets")
