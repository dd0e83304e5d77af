"""Order of NULLs, ties and the map-side limit of per-key picks."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from tallyroute.operators import measures, pick

DATA = [("a", 1, 10), ("a", None, 11), ("a", 3, 12), ("b", 2, 20), ("b", 2, 21), ("c", None, 30)]


def frame(spark):
    return spark.createDataFrame(DATA, "k STRING, t INT, id INT")


def test_latest_puts_null_first_and_breaks_ties(spark):
    assert rows(pick.latest_by(frame(spark), ["k"], "t", "id")) == [
        ("a", None, 11), ("b", 2, 21), ("c", None, 30)]


def test_earliest_puts_null_last(spark):
    assert rows(pick.earliest_by(frame(spark), ["k"], "t", "id")) == [
        ("a", 1, 10), ("b", 2, 20), ("c", None, 30)]


def test_nth_row_and_short_groups(spark):
    assert rows(pick.nth_by(frame(spark), ["k"], pick.oldest("id"), 3)) == [("a", 3, 12)]


def test_preferred_then_latest(spark):
    picked = pick.preferred_by(frame(spark), ["k"], F.col("t").eqNullSafe(1), "id")
    assert rows(picked) == [("a", 1, 10), ("b", 2, 21), ("c", None, 30)]


def test_as_of_is_strictly_before(spark):
    data = [(1, datetime(2024, 1, 1), 1), (1, datetime(2024, 1, 2), 2)]
    df = spark.createDataFrame(data, "k INT, t TIMESTAMP_NTZ, id INT")
    assert rows(pick.as_of_by(df, ["k"], "t", datetime(2024, 1, 2), "id"))[0][2] == 1


def test_last_known_value_beside_latest_row(spark):
    data = [(1, 1, "RED", "x"), (1, 2, None, "y"), (2, 5, None, "z")]
    df = spark.createDataFrame(data, "k INT, id INT, color STRING, who STRING")
    found = pick.last_known(df, ["k"], "color", "id", ["id", "who"], "ORANGE")
    assert rows(found) == [(1, 2, "y", "RED"), (2, 5, "z", "ORANGE")]


def test_losers_are_dropped_before_the_exchange(spark):
    plan = pick.latest_by(frame(spark), ["k"], "t", "id")._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_ordered_text_and_first_last(spark):
    found = frame(spark).groupBy("k").agg(
        measures.ordered_text(F.col("t").cast("string"), F.col("id")).alias("text"),
        measures.first_along("id", ["t", "id"]).alias("first"),
        measures.last_along("id", ["t", "id"]).alias("last"))
    assert rows(found) == [("a", "1,3", 10, 11), ("b", "2,2", 20, 21), ("c", None, 30, 30)]
