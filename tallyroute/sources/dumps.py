"""Rows of ``INSERT INTO … VALUES (…),(…)`` dump text as a Spark text job.

Quotes, brackets and commas inside quoted values are part of the value.  What cannot be read is kept
apart with its text, so nothing is lost unseen.

Files are read by :func:`read_dump` in records that end at a closing bracket outside of quotes, so
tuples may run over lines and a dump may have no line ends at all.  A comment may hold quotes as long
as no closing bracket stands before them in it.  The functions for ``lines`` take rows of text in
which a line holds any number of whole tuples, with or without the INSERT header in front; there a
line that cannot be read spoils no other.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.sources.records import SQL_COMMENT, sql_records

_HEAD = r"(?is)^\s*INSERT\s+INTO\s+.*?\((.*?)\)\s*VALUES\s*"
_QUOTED = r"'(?:[^'\\]|\\.|'')*+'"
_TUPLE = rf"\((?:[^'()]|{_QUOTED})*+\)"
_LINE = rf"(?s)^\s*,?\s*{_TUPLE}(?:\s*,\s*{_TUPLE})*+\s*[,;]?\s*$"
#: a value with the comma or bracket in front of it
_VALUE = rf"(?<=[(,])\s*+(?:{_QUOTED}|[^,'()]*+)(?=\s*[,)])"
#: lines that belong to a dump without holding rows: blank, comments, other statements, separators
_OTHER = r"(?is)^\s*([;,]?\s*|(--|#|/\*).*|(LOCK|UNLOCK|SET|USE|DROP|CREATE|ALTER|COMMIT|BEGIN)\b.*)$"


def dump_columns(header: str) -> list[str]:
    """Column names of the INSERT header."""
    match = re.search(_HEAD, header)
    if not match:
        raise ValueError("no INSERT INTO … (columns) VALUES header")
    return [name.strip().strip("`'\"") for name in match.group(1).split(",")]


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"\A\s+|\s+\z", "")


def _unquoted(raw: Column) -> Column:
    """Text of a value; a quoted one loses its quotes, its doubled quotes and its escapes.  White
    space at its ends does not count, in or out of quotes."""
    text = _stripped(raw)
    inner = F.regexp_replace(F.regexp_replace(text, r"(?s)\A'|'\z", ""), "''", "'")
    plain = _stripped(F.regexp_replace(inner, r"(?s)\\(.)", "$1"))
    return F.when((plain != "") & (F.upper(plain) != "NULL"), plain)


def parsed_lines(lines: DataFrame, columns: list[str], line: str = "value") -> DataFrame:
    """One row per tuple or unreadable line: its ``text``, the list of ``values``, and whether it
    was ``read``, that is, has a value for every column."""
    body = F.regexp_replace(F.col(line), _HEAD, "")
    held = lines.select(F.col(line).alias("text"), body.alias("body")).where(
        ~F.col("body").rlike(_OTHER))
    found = F.when(F.col("body").rlike(_LINE), F.regexp_extract_all("body", F.lit(_TUPLE), F.lit(0)))
    tuples = held.select("text", F.explode_outer(found).alias("tuple"))
    return _valued(tuples, columns)


def _valued(tuples: DataFrame, columns: list[str]) -> DataFrame:
    """``text``, ``values`` and ``read`` of rows with a ``tuple``, or only a ``text`` without one."""
    values = F.regexp_extract_all("tuple", F.lit(_VALUE), F.lit(0))
    return tuples.select(
        F.coalesce("tuple", "text").alias("text"), F.transform(values, _unquoted).alias("values"),
    ).withColumn("read", F.coalesce(F.size("values") == len(columns), F.lit(False)))


def _columns(parsed: DataFrame, columns: list[str]) -> DataFrame:
    return parsed.where("read").select(
        *[F.col("values")[k].alias(name) for k, name in enumerate(columns)])


def parse_dump(lines: DataFrame, columns: list[str], line: str = "value") -> DataFrame:
    """Text columns of every readable tuple; empty text and NULL in any case count as missing."""
    return _columns(parsed_lines(lines, columns, line), columns)


def failed_lines(lines: DataFrame, columns: list[str], line: str = "value") -> DataFrame:
    """``text`` of the lines and tuples that could not be read."""
    return parsed_lines(lines, columns, line).where("NOT read").select("text")


#: what may stand before a tuple of rows, before a list of columns, and in other statements
_LEAD = r"(?is)\A(?:[\s,;]*|.*\bVALUES\s*)\z"
_NAMES = r"(?is)\bINSERT\s+(?:IGNORE\s+)?INTO\s+[^\s(]+\s*\z"
_STATEMENT = r"(?is)\A[\s;]*(?:LOCK|UNLOCK|SET|USE|DROP|CREATE|ALTER|COMMIT|BEGIN)\b"


def parsed_records(found: DataFrame, columns: list[str]) -> DataFrame:
    """As :func:`parsed_lines` for the records of a file."""
    text = F.when(F.col("ended"), F.concat("text", F.lit(")"))).otherwise(F.col("text"))
    record = found.withColumn("text", text)
    rows = record.select("text", F.when(
        F.col("whole"), F.regexp_extract("text", rf"(?s)\A.*?({_TUPLE})\z", 1)).alias("tuple"))
    lead = F.substring("text", F.lit(1), F.length("text") - F.length("tuple"))
    plain = rows.withColumn("lead", F.regexp_replace(
        F.when(F.coalesce("tuple", F.lit("")) == "", F.col("text")).otherwise(lead),
        f"(?s){SQL_COMMENT}", ""))
    is_row = (F.col("tuple") != "") & F.col("lead").rlike(_LEAD)
    skipped = F.col("lead").rlike(_STATEMENT) | F.when(
        F.col("tuple") != "", F.col("lead").rlike(_NAMES)).otherwise(F.col("lead").rlike(r"\A[\s,;]*\z"))
    kept = plain.where(~F.coalesce(skipped, F.lit(False))).select(
        F.trim("text").alias("text"), F.when(is_row, F.col("tuple")).alias("tuple"))
    return _valued(kept, columns)


def read_dump(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Text columns of every readable tuple of the files at ``path``."""
    return _columns(parsed_records(sql_records(spark, path), columns), columns)


def read_dump_checked(spark: SparkSession, path: str,
                      columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Readable tuples, and the ``text`` of what could not be read."""
    parsed = parsed_records(sql_records(spark, path), columns)
    return _columns(parsed, columns), parsed.where("NOT read").select("text")
