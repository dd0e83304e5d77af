"""File sources read as text, with a file-order row id, and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroute.functions.cleaning import one_line_header
from tallyroute.sources.records import csv_records

LATIN, UTF8 = "ISO-8859-1", "UTF-8"


def read_csv_text(
    spark: SparkSession, path: str, encoding: str = UTF8, multi_line: bool = False
) -> DataFrame:
    """Every field as STRING, headers on one line and free of a byte-order mark.

    ``multi_line`` reads fields with line breaks in one split per file; :func:`read_csv_records`
    reads them from as many splits as there are.
    """
    df = (
        spark.read.option("header", True).option("inferSchema", False)
        .option("encoding", encoding).option("mode", "PERMISSIVE").option("escape", '"')
        .option("multiLine", multi_line).csv(path)
    )
    return df.toDF(*[one_line_header(name) for name in df.columns])


def read_csv_records(spark: SparkSession, path: str, encoding: str = UTF8) -> DataFrame:
    """As :func:`read_csv_text` for files whose quoted fields hold line breaks, without keeping a
    file in one split.  Every file begins with the header."""
    names = spark.read.option("header", True).option("encoding", encoding).option(
        "escape", '"').option("multiLine", True).csv(path).columns
    text = F.regexp_replace("text", "\\r$", "")
    rows = csv_records(spark, path, encoding).where("record > 1").select(text.alias("text"))
    schema = ", ".join(f"c{k} STRING" for k in range(len(names)))
    fields = F.from_csv("text", schema, {"mode": "PERMISSIVE", "escape": '"'})
    return rows.where("text != ''").select(fields.alias("row")).select("row.*").toDF(
        *[one_line_header(name) for name in names])


#: column that :func:`read_csv_checked` adds
UNREAD = "unread_line"


def read_csv_checked(spark: SparkSession, path: str, encoding: str = UTF8) -> DataFrame:
    """As :func:`read_csv_text`, plus ``unread_line``: the text of a line that has more or fewer
    fields than the header, else NULL.  Such a line keeps the fields it has."""
    names = spark.read.option("header", True).option("encoding", encoding).option(
        "escape", '"').csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in (*names, UNREAD)]
    df = (
        spark.read.schema(T.StructType(fields)).option("header", True)
        .option("encoding", encoding).option("mode", "PERMISSIVE").option("escape", '"')
        .option("enforceSchema", False).option("columnNameOfCorruptRecord", UNREAD).csv(path)
    )
    return df.toDF(*[one_line_header(name) for name in names], UNREAD)


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, encoding: str = UTF8
) -> DataFrame:
    """Read by extension or by a stated format; an unknown one is an error."""
    kind = (fmt or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    if kind == "csv":
        return read_csv_text(spark, path, encoding)
    if kind == "json":
        return spark.read.option("primitivesAsString", True).option("multiLine", False).json(path)
    if kind == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported file format: {kind}")


def with_file_row_id(df: DataFrame, name: str = "row_id", first: int = 0) -> DataFrame:
    """Dense row number in file order for a frame read straight from files.

    A split is named by its file and start offset, and ``monotonically_increasing_id`` grows
    inside a split, so each split is numbered alone and shifted by the rows of the splits
    before it.  Only one count per split meets in a single task.
    """
    placed = df.select(
        *df.columns,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__at"),
    )
    split = ["__file", "__start"]
    counts = placed.groupBy(*split).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *split, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy(*split).orderBy("__at")
    return (
        placed.withColumn("__place", F.row_number().over(inside))
        .join(offsets, split)
        .withColumn(name, (F.col("__before") + F.col("__place") + (first - 1)).cast("bigint"))
        .select(*df.columns, name)
    )


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Make a report readable by name in SQL, in this session; see :func:`publish_version`."""
    df.createOrReplaceTempView(name)
    return df


VERSION = "version"


def published_version(spark: SparkSession, name: str) -> str | None:
    """Version a published name stands for; None if nothing is published under it."""
    if not spark.catalog.tableExists(name):
        return None
    held = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return held.get(VERSION)


def publish_version(df: DataFrame, name: str, version: str, folder: str) -> bool:
    """Publish a report in the catalog, for every session that shares it, under a plain name.

    The rows are written to a folder of their version first; then the name is pointed to it in one
    step, so readers see the old report or the new one.  A version that is published already is left
    alone (False).  Columns may be added; a report that lacks a column of the one before, or has it
    with another type, is refused.
    """
    spark = df.sparkSession
    if published_version(spark, name) == version:
        return False
    if spark.catalog.tableExists(name):
        kinds = dict(df.dtypes)
        lost = [c for c, kind in spark.table(name).dtypes if kinds.get(c) != kind]
        if lost:
            raise ValueError(f"{name} would lose or change columns: {', '.join(lost)}")
    path = f"{folder.rstrip('/')}/{name}/version={version}"
    df.write.mode("overwrite").parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}') AS"
              f" SELECT * FROM parquet.`{path}`")
    return True


def write_run(df: DataFrame, folder: str, run_id: str, fmt: str = "parquet") -> str:
    path = f"{folder.rstrip('/')}/run_id={run_id}"
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)
    return path
