"""Prepare the ``documents`` of a corpus for training, in stages.

Each stage takes what the one before kept, written as Parquet and read again, and decides on all of
it.  All stages but the last return the columns of ``documents``.

1. ``toxicity``: documents whose score reaches the threshold of their language go.
2. ``line_dedup``: lines that equal or nearly equal an earlier line go; documents stay, ``n_chars``
   follows the text.
3. ``simhash_dedup``: of each group of near duplicates the document with the smallest id stays, one
   row of it.  Rows without an id stay.  Rows that share an id stay or go together.
4. ``decontaminate``: documents that hold a window of words of a benchmark item go.
5. ``byte_bpe``: what is left is encoded; the ids and what they decode to are returned as digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroute.llm import bpe, decontaminate, line_dedup, simhash_dedup, toxicity
from tallyroute.llm.queries import fold, table
from tallyroute.llm.store import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold() != 1)
    scored = toxicity.score(docs, net, "__toxicity")
    rejected = F.col("__toxicity") >= toxicity.threshold(net, F.col("lang"))
    return scored.where(~rejected).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs, added=("__read", "__gone")).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.near_duplicates(docs)
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    one = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
    kept = (
        docs.join(stay, "doc_id", "left_semi").withColumn("__row", F.row_number().over(one))
        .where("__row = 1").select(*docs.columns))
    return kept.union(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = stored(found.where("n_hit > 0").select(F.col("version").alias("__version")).distinct(),
                 "contaminated")
    return docs.join(hit, F.xxhash64("text") == F.col("__version"), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated), ("byte_bpe", tokens),
]

#: a trained network decides in the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; returns the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
