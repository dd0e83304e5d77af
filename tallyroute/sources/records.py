"""Records of text files whose quoted values may hold the record separator, read in splits.

A file is read in *fragments*, the pieces between two separators, from as many splits as Spark makes
of it.  Whether a fragment begins inside a quoted value is not known where it is read.  But each
fragment has one end state if it begins outside and one if it begins inside, and such pairs of
states combine: a fragment either settles the state, flips it or keeps it.  So every split counts
its records for both states it may begin in and ends in one state for each; the splits of a file are
put in order, which gives every split its true first state; and of the two numberings one is right.
A record is the fragments from one that begins outside up to the next such one.

Only fragments of records that hold a separator are gathered, by record.  A record of more than
``longest`` bytes (a quote that is never closed) is not gathered but comes out in fragments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroute.session import stored

#: bytes of the longest record that is put together
LONGEST = 64 << 20

SQL_STRING = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
SQL_COMMENT = r"--[^\n]*+|/\*(?:[^*]|\*(?!/))*+\*/"


def sql_open(text: Column) -> Column:
    """Whether SQL text that begins outside ends inside a quoted value."""
    left = F.regexp_replace(text, f"(?s){SQL_STRING}|{SQL_COMMENT}", "")
    return F.contains(left, F.lit("'"))


def csv_open(text: Column) -> Column:
    """Whether a CSV line that begins outside ends inside a quoted field; a quote opens a field only
    at its beginning."""
    quoted = '"[^"]*+(?:""[^"]*+)*+'
    return text.rlike(rf'\A(?:{quoted}"[^,]*+,|[^",][^,]*+,|,)*+{quoted}\z')


def _odd(count: Column) -> Column:
    return count % 2 == 1


def _states(df: DataFrame, outside: str, inside: str, keys: list[str], order: str) -> DataFrame:
    """Adds ``__flips`` and ``__kept``: how often the state has flipped up to and with this row, and
    the state that it would have from the last settled one on without the flips before it."""
    sofar = Window.partitionBy(*keys).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    flips = F.sum((F.col(outside) & ~F.col(inside)).cast("long")).over(sofar)
    settled = F.when(F.col(outside) == F.col(inside), F.col(outside) != _odd(F.col("__flips")))
    return (
        df.withColumn("__flips", flips)
        .withColumn("__kept", F.last(settled, ignorenulls=True).over(sofar)))


def _after(first: bool) -> Column:
    return F.coalesce("__kept", F.lit(first)) != _odd(F.col("__flips"))


def _before(first: bool, place: Window) -> Column:
    return F.coalesce(F.lag(_after(first)).over(place), F.lit(first))


def fragments(spark: SparkSession, path: str, separator: str, opens: Callable[[Column], Column],
              quote: str, encoding: str = "UTF-8") -> DataFrame:
    """Every fragment with, for both states its split may begin in (``0`` outside, ``1`` inside),
    the states it begins and ends in and the number of its record in the split."""
    raw = F.col("value").cast("binary")
    read = spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"),
        (F.octet_length(raw) + len(separator)).cast("long").alias("bytes"),
        (F.col("value") if encoding.upper() == "UTF-8" else F.decode(raw, encoding)).alias("text"))
    text = F.col("text")
    place = Window.partitionBy("file", "split").orderBy("at")
    sofar = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = _states(
        read.withColumns({"__out": opens(text), "__in": opens(F.concat(F.lit(quote), text))}),
        "__out", "__in", ["file", "split"], "at")
    for first in (0, 1):
        marked = marked.withColumns({
            f"inside{first}": _before(bool(first), place), f"open{first}": _after(bool(first))})
    for first in (0, 1):
        marked = marked.withColumn(
            f"record{first}", F.sum((~F.col(f"inside{first}")).cast("long")).over(sofar))
    return marked.drop("__out", "__in", "__flips", "__kept")


def _splits(marked: DataFrame) -> DataFrame:
    """Per split: the state it begins in, the records before it, and its last fragment, if the file
    ends there without a separator."""
    ends = marked.groupBy("file", "split").agg(
        F.max_by("open0", "at").alias("open0"), F.max_by("open1", "at").alias("open1"),
        F.max("record0").alias("record0"), F.max("record1").alias("record1"),
        F.max("at").alias("last"), F.sum("bytes").alias("bytes"), F.max("size").alias("size"))
    place = Window.partitionBy("file").orderBy("split")
    earlier = place.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    ordered = _states(ends, "open0", "open1", ["file"], "split").withColumn(
        "begins", _before(False, place))
    own = F.when(F.col("begins"), F.col("record1")).otherwise(F.col("record0"))
    unended = (F.sum("bytes").over(whole) == F.col("size") + 1) & (
        F.max("split").over(whole) == F.col("split"))
    return ordered.select(
        "file", "split", "begins", F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias("records"),
        F.when(unended, F.col("last")).alias("unended"))


def records(spark: SparkSession, path: str, separator: str, opens: Callable[[Column], Column],
            quote: str, encoding: str = "UTF-8", longest: int = LONGEST) -> DataFrame:
    """``file``, ``record`` (from 1 in file order), its ``text`` without the separator at its end,
    whether it is ``whole`` (else a fragment of a record that is too long), and whether a separator
    ``ended`` it."""
    marked = stored(fragments(spark, path, separator, opens, quote, encoding), "fragments")
    begun = F.col("begins")
    placed = marked.join(_splits(marked), ["file", "split"]).select(
        "file", "at", "text", "bytes",
        F.when(begun, F.col("inside1")).otherwise(F.col("inside0")).alias("inside"),
        F.when(begun, F.col("open1")).otherwise(F.col("open0")).alias("open"),
        (F.col("records") + F.when(begun, F.col("record1")).otherwise(F.col("record0")))
        .alias("record"),
        (~F.col("at").eqNullSafe(F.col("unended"))).alias("ended"))
    alone = placed.where("NOT inside AND NOT open").select(
        "file", "record", "text", F.lit(True).alias("whole"), "ended")
    parts = placed.where("inside OR open")
    sizes = parts.groupBy("file", "record").agg(F.sum("bytes").alias("held"))
    sized = parts.join(sizes, ["file", "record"])
    held = F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"])
    joined = sized.where(F.col("held") <= longest).groupBy("file", "record").agg(
        F.array_join(held, separator).alias("text"), F.lit(True).alias("whole"),
        F.bool_and("ended").alias("ended"))
    cut = sized.where(F.col("held") > longest).select(
        "file", "record", "text", F.lit(False).alias("whole"), "ended")
    return alone.unionByName(joined).unionByName(cut)


def sql_records(spark: SparkSession, path: str, encoding: str = "UTF-8",
                longest: int = LONGEST) -> DataFrame:
    """SQL text up to each closing bracket that is not quoted, over any number of lines."""
    return records(spark, path, ")", sql_open, "'", encoding, longest)


def csv_records(spark: SparkSession, path: str, encoding: str = "UTF-8",
                longest: int = LONGEST) -> DataFrame:
    """CSV records, over any number of lines."""
    return records(spark, path, "\n", csv_open, '"', encoding, longest)
