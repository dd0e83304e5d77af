"""Files are skipped by key without losing a row."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.sources import file_index


@pytest.fixture
def table(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(20_000).select(
        (F.col("id") * 7).alias("id"), F.concat(F.lit("k"), F.col("id")).alias("name"),
        (F.col("id") % 8).alias("slice")).repartition(1).write.partitionBy("slice").parquet(folder)
    return folder


@pytest.mark.parametrize("key", ["id", "name"])
def test_possible_files_hold_every_match(spark, tmp_path, table, key):
    index = file_index.build_index(spark, table, key, str(tmp_path / "i"))
    assert index.select("file").distinct().count() == 8
    assert index.select("file", "rows").distinct().agg(F.sum("rows")).first()[0] == 20_000
    rng = random.Random(1)
    chosen = [rng.randrange(20_000) for _ in range(5)]
    values = [n * 7 if key == "id" else f"k{n}" for n in chosen] + [-5 if key == "id" else "zz", None]
    asked = spark.createDataFrame([(v,) for v in values], f"{key} {'BIGINT' if key == 'id' else 'STRING'}")
    known = file_index.keys_known(spark, table, index, asked, [key])
    assert rows(known) == sorted({(v,) for v in values[:5]}, key=lambda r: str(r[0]))
    files = file_index.possible_files(index, asked, key).count()
    assert len({n % 8 for n in chosen}) <= files < 8


def test_keys_outside_and_empty_requests_read_nothing(spark, tmp_path, table):
    index = file_index.build_index(spark, table, "id", str(tmp_path / "i"))
    for values in ([], [(None,)], [(-1,), (10**9,)]):
        asked = spark.createDataFrame(values, "id BIGINT")
        assert file_index.possible_files(index, asked, "id").count() == 0
        assert file_index.keys_known(spark, table, index, asked, ["id"]).count() == 0


def test_false_files_are_few_and_counted(spark, tmp_path, table):
    index = file_index.build_index(spark, table, "id", str(tmp_path / "i"))
    absent = spark.range(1000).select((F.col("id") * 7 + 3).alias("id"))
    per_key = index.select("file").distinct().count() * 1000
    pieces = index.where("low IS NOT NULL").count()
    assert pieces >= 8
    hit = 0
    for part in range(4):
        one = absent.where(F.pmod("id", F.lit(4)) == part)
        hit += file_index.possible_files(index, one.limit(50), "id").count()
    assert hit <= 16 and per_key == 8000


def test_files_without_keys(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.createDataFrame([(None, 1), (None, 2)], "id BIGINT, v INT").coalesce(1).write.parquet(folder)
    index = file_index.build_index(spark, folder, "id", str(tmp_path / "i"))
    asked = spark.createDataFrame([(1,)], "id BIGINT")
    assert file_index.keys_known(spark, folder, index, asked, ["id"]).count() == 0
