"""Bloom filters and key extremes per file of a table, to read only files that may hold a key.

The index is a parquet table beside the data: per file its rows, smallest and largest key, and the
bits of a Bloom filter in pieces of 32,768 (``bitmap_construct_agg``).  Every key sets ``HASHES`` bits
of its file, which has ``bits`` bits per row.  Keys asked for meet the pieces by equality: a file is
read if for one key within its extremes all bits are set.  What is read is compared exactly, so a
filter that is wrong costs a file and never a row.  NULL keys are in no filter and match nothing.

Build the index again for files that were added (``build_index`` of a folder), and keep one per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bits a key sets, bits per row, and bits in a piece (that of Spark's bitmap functions)
HASHES, BITS, PIECE = 5, 16, 32768


def _hashes(key: Column) -> Column:
    """The hashes a key's bits follow from."""
    return F.array(*[F.xxhash64(F.lit(k), key) for k in range(HASHES)])


def _bit(hashed: Column, pieces: Column) -> tuple[Column, Column]:
    """Piece and bit in the piece of a hash, for a file with so many pieces."""
    place = F.pmod(hashed, pieces.cast("bigint") * PIECE)
    return (F.floor(place / PIECE)).cast("int"), place % PIECE


def build_index(spark: SparkSession, folder: str, key: str, path: str, bits: int = BITS) -> DataFrame:
    """Write the index of the files in ``folder`` to ``path``; one pass over the key column for the
    sizes and one for the bits."""
    rows = spark.read.parquet(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"))
    sizes = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"),
        F.count("key").alias("keys"))
    # powers of two: few sizes of filters, so that few bits are worked out for a key asked for
    doubled = F.ceil(F.log2(F.greatest(F.col("keys") * bits / F.lit(PIECE), F.lit(1.0))))
    sizes = sizes.withColumn("pieces", F.when(F.col("keys") > 0, F.pow(F.lit(2.0), doubled))
                             .cast("int")).drop("keys")
    held = rows.where(F.col("key").isNotNull()).join(sizes.select("file", "pieces"), "file")
    set_bits = held.select("file", "pieces", F.explode(_hashes(F.col("key"))).alias("hashed"))
    piece, bit = _bit(F.col("hashed"), F.col("pieces"))
    filters = set_bits.select("file", piece.alias("piece"), bit.alias("bit")).groupBy(
        "file", "piece").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    sizes.join(filters, "file", "left").write.parquet(path)
    return spark.read.parquet(path)


#: whether the bit ``bit`` of ``bitmap`` is set
IS_SET = ("shiftright(CAST(conv(hex(substring(bitmap, CAST(bit div 8 AS INT) + 1, 1)), 16, 10) AS INT),"
          " CAST(bit % 8 AS INT)) & 1 = 1")


def possible_files(index: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """``file`` of every file that may hold one of the ``asked`` keys."""
    keys = asked.select(F.col(key).alias("key")).where("key IS NOT NULL").distinct()
    shapes = index.select("pieces").distinct().where("pieces IS NOT NULL")
    # a row per key, size of filter and bit: files of one size share their rows
    wanted = keys.withColumn("shapes", shapes.agg(F.collect_set("pieces")).scalar()).select(
        "key", F.explode("shapes").alias("pieces")).select(
            "key", "pieces", F.explode(_hashes(F.col("key"))).alias("hashed"))
    piece, bit = _bit(F.col("hashed"), F.col("pieces"))
    met = wanted.select("key", "pieces", piece.alias("piece"), bit.alias("bit")).join(
        index, ["pieces", "piece"]).where("key BETWEEN low AND high")
    return met.where(IS_SET).groupBy("file", "key").agg(
        F.count(F.lit(1)).alias("set")).where(F.col("set") == HASHES).select("file").distinct()


def read_possible(spark: SparkSession, folder: str, index: DataFrame, asked: DataFrame,
                  key: str) -> DataFrame:
    """The table's rows from those files only; their names come to the driver, as all files' names do
    when a folder is read."""
    files = [row["file"] for row in possible_files(index, asked, key).collect()]
    whole = spark.read.parquet(folder)
    if not files:
        return whole.limit(0)
    return spark.read.schema(whole.schema).option("basePath", folder).parquet(*files)


def keys_known(spark: SparkSession, folder: str, index: DataFrame, asked: DataFrame,
               keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``asked`` that the table holds; the first of ``keys`` is the indexed one."""
    there = read_possible(spark, folder, index, asked, keys[0])
    return there.select(*keys).join(asked.select(*keys), list(keys), "left_semi").distinct()
