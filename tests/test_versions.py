"""Versioned tables: touched buckets, one entry per run, repeated and stopped runs."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.operators import changes
from tallyroute.sources.versions import VersionedTables


@pytest.fixture
def tables(spark, tmp_path):
    held = VersionedTables(spark, str(tmp_path / "v"))
    a = spark.range(100).select("id", (F.col("id") * 2).alias("v"), F.lit("x").alias("who"))
    b = spark.createDataFrame([("k", 1), ("l", None), (None, 3)], "name STRING, n INT")
    assert held.create("r0", {"a": (a, "id"), "b": (b, "name")}, buckets=8)
    return held


def test_a_run_writes_touched_buckets_only(spark, tables):
    delta = spark.createDataFrame([(3, -1, None), (11, -2, "y"), (200, 0, "new")],
                                  "id BIGINT, v BIGINT, who STRING")
    before = tables.table("a")
    want = rows(changes.merged(before, delta, "id"))
    assert tables.apply("r1", {"a": delta})
    assert rows(tables.table("a")) == want and tables.table("a").count() == 101
    assert rows(tables.written("r1")) == [("a", 0, 8), ("a", 3, 8)]
    assert before.count() == 100  # a reader of the old state keeps it
    read = set(tables.table("a").inputFiles())
    assert all(("run=r1" in f) == ("bucket=3" in f or "bucket=0" in f) for f in read)


def test_tables_change_together_or_not_at_all(spark, tables):
    a = spark.createDataFrame([(5, 0, "z")], "id BIGINT, v BIGINT, who STRING")
    b = spark.createDataFrame([("k", 9), ("m", 4)], "name STRING, n INT")
    old = rows(tables.table("a")), rows(tables.table("b"))
    prepared = tables.prepare("r1", {"a": a, "b": b})
    assert (rows(tables.table("a")), rows(tables.table("b"))) == old
    assert tables.publish(prepared)
    assert tables.table("a").where("who = 'z'").count() == 1
    assert rows(tables.table("b")) == rows(spark.createDataFrame(
        [("k", 9), ("l", None), (None, 3), ("m", 4)], "name STRING, n INT"))


def test_a_repeated_run_changes_nothing(spark, tables):
    one = spark.createDataFrame([(5, 0, "z")], "id BIGINT, v BIGINT, who STRING")
    assert tables.apply("r1", {"a": one})
    files = sorted(tables.table("a").inputFiles())
    assert not tables.apply("r1", {"a": one.withColumn("who", F.lit("other"))})
    assert not tables.create("r0", {"c": (one, "id")})
    assert sorted(tables.table("a").inputFiles()) == files
    assert tables.entries().count() == 3


def test_a_stopped_run_can_be_prepared_again(spark, tables):
    wrong = spark.createDataFrame([(5, 0, "wrong")], "id BIGINT, v BIGINT, who STRING")
    tables.prepare("r1", {"a": wrong})
    assert tables.apply("r1", {"a": wrong.withColumn("who", F.lit("right"))})
    assert tables.table("a").where("who = 'wrong'").isEmpty()
    assert tables.table("a").where("who = 'right'").count() == 1


def test_two_runs_from_one_state(spark, tables):
    one = spark.createDataFrame([(5, 0, "z")], "id BIGINT, v BIGINT, who STRING")
    first, second = tables.prepare("r1", {"a": one}), tables.prepare("r2", {"a": one})
    assert tables.publish(first)
    with pytest.raises(ValueError, match="another run"):
        tables.publish(second)


def test_empty_tables_and_empty_runs(spark, tables):
    empty = spark.createDataFrame([], "id INT, v STRING")
    assert tables.create("r1", {"c": (empty, "id")}) and tables.table("c").count() == 0
    assert tables.apply("r2", {"c": empty}) and tables.table("c").columns == ["id", "v"]
    assert tables.apply("r3", {"c": spark.createDataFrame([(1, "q")], "id INT, v STRING")})
    assert rows(tables.table("c")) == [(1, "q")]
    with pytest.raises(ValueError, match="already"):
        tables.create("r4", {"a": (empty, "id")})


def test_a_second_reader_leaves_the_entries(spark, tables):
    again = VersionedTables(spark, tables.root)
    assert again.entries().count() == 2 and again.table("a").count() == 100
