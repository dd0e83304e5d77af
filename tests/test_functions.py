"""Dirty values, durations, dates and payloads."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyroute.functions import cleaning, dates, durations, idlists, payload


def one(spark, column, value, kind="STRING"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


@pytest.mark.parametrize("raw,value", [
    ("1,234.50", 1234.5), (" 7 ", 7.0), ("abc", None), ("", None), (None, None),
    ("nan", None), ("NaN", None), ("inf", None), ("-Infinity", None), ("12d", None), ("1e400", None),
    ("0x1p3", None), ("-.5", -0.5), ("3.", 3.0), ("+2e3", 2000.0), (".", None), ("1 2", None)])
def test_number(spark, raw, value):
    assert one(spark, cleaning.number("x"), raw) == value


@pytest.mark.parametrize("raw,value", [
    ("31/12/2025", date(2025, 12, 31)), ("1/2/2025", date(2025, 2, 1)),
    ("05-06-2024", date(2024, 6, 5)), ("2024-02-29", date(2024, 2, 29)), ("30/02/2024", None),
    ("29/02/2023", None), ("12/13/2024", None), ("00/01/2024", None), ("nan", None),
    ("", None), (None, None), (" 3/4/2021 ", date(2021, 4, 3)),
    ("2024-03-05 00:00:00", date(2024, 3, 5)), ("05/03/2024 14:30", date(2024, 3, 5)),
    ("2024-03-05T01:02:03.5Z", date(2024, 3, 5)), ("5/3/2024 1:02:03 PM", date(2024, 3, 5)),
    ("05.03.2024", date(2024, 3, 5)), ("05/03/24", date(2024, 3, 5)), ("5-3-69", date(1969, 3, 5)),
    ("5 Mar 2024", date(2024, 3, 5)), ("05-MAR-24", date(2024, 3, 5)), ("5th March, 2024", date(2024, 3, 5)),
    ("March 5, 2024", date(2024, 3, 5)), ("Sept 5 2024", date(2024, 9, 5)), ("5 Mrz 2024", None),
    ("05/03-2024", None), ("5 ma 2024", None), ("31 Feb 2024", None), ("inf", None)])
def test_day_first_date(spark, raw, value):
    assert one(spark, cleaning.day_first_date("x"), raw) == value


@pytest.mark.parametrize("raw,value", [
    ("12", 12), (" 5 ", 5), ("0", None), ("-1", None), ("abc", None), ("1.5", None), ("", None),
    ("99999999999", None)])
def test_positive_int(spark, raw, value):
    assert one(spark, cleaning.positive_int("x"), raw) == value


def test_tokens_flags_and_maps(spark):
    assert one(spark, cleaning.null_if_token("x"), " NaN ") is None
    assert one(spark, cleaning.null_if_token("x"), " A@B ") == "a@b"
    assert one(spark, cleaning.yes_no("x"), " YES") is True
    assert one(spark, cleaning.yes_no("x"), "perhaps") is None
    assert one(spark, cleaning.digits("x"), "12a") is None
    assert one(spark, cleaning.mapped("x", {"NEFT": 111}), "cash") is None
    assert one(spark, cleaning.percent(F.lit(5.0), F.col("x")), 0.0, "DOUBLE") is None
    assert one(spark, cleaning.half_even_int("x"), 2.5, "DOUBLE") == 2


def test_headers():
    assert cleaning.squeeze_header("﻿ Lead  Number ") == "lead number"
    assert cleaning.snake_header("ï»¿Refund Date(Finance)") == "refund_date_finance"
    assert cleaning.one_line_header("A\nB") == "A B"


def test_required_columns(spark):
    with pytest.raises(ValueError, match="b, c"):
        cleaning.require_columns(spark.range(1).toDF("a"), ["a", "b", "c"])


@pytest.mark.parametrize("seconds,text,wrapped", [
    (0, "00:00:00", "00:00:00"), (3661, "01:01:01", "01:01:01"),
    (90061, "25:01:01", "01:01:01"), (360000 + 59, "100:00:59", "04:00:59")])
def test_clock_text(spark, seconds, text, wrapped):
    assert one(spark, durations.clock_text("x"), seconds, "BIGINT") == text
    assert one(spark, durations.clock_text("x", wrap=True), seconds, "BIGINT") == wrapped


@pytest.mark.parametrize("text,strict,loose", [
    ("01:00:05", 3605, 3605), ("90", 0, 90), ("1:00:05", 0, 0), ("", 0, 0), (None, 0, 0),
    ("n/a", 0, 0)])
def test_clock_seconds(spark, text, strict, loose):
    assert one(spark, durations.clock_seconds("x"), text) == strict
    assert one(spark, durations.clock_seconds("x", plain_numbers=True), text) == loose


@pytest.mark.parametrize("born,at,years", [
    (date(1996, 2, 29), date(2026, 2, 28), 29), (date(1996, 2, 29), date(2026, 3, 1), 30),
    (date(2000, 5, 5), date(2024, 5, 5), 24)])
def test_completed_years(spark, born, at, years):
    assert one(spark, dates.completed_years("x", F.lit(at)), born, "DATE") == years


def test_relative_windows_are_half_open(spark):
    now = datetime(2024, 3, 10, 8, 0)
    df = spark.createDataFrame(
        [(datetime(2024, 3, 9),), (datetime(2024, 3, 9, 23, 59, 59),), (datetime(2024, 3, 10),)],
        "t TIMESTAMP_NTZ")
    assert df.where(dates.yesterday("t", now)).count() == 2
    assert df.where(dates.since_days("t", now, 1)).count() == 3
    assert df.where(dates.older_than_days("t", now, 1)).count() == 1
    assert df.where(dates.month_to_date("t", now)).count() == 3


def test_relative_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(datetime(2024, 3, 9), 1)], "t TIMESTAMP_NTZ, v INT") \
        .write.parquet(path)
    df = spark.read.parquet(path).where(dates.yesterday("t", datetime(2024, 3, 10))).select("t")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan and "v:int" not in plan


def test_local_time(spark):
    at = one(spark, dates.local_time("x").cast("string"), datetime(2024, 1, 1, 20), "TIMESTAMP_NTZ")
    assert at == "2024-01-02 01:30:00"


ENCODED = json.dumps({"actions": json.dumps(
    [{}, {"details": json.dumps({"pan": json.dumps({"occupation": "Baker"})})}])})


@pytest.mark.parametrize("text,value", [
    ('{"occupation": "A"}', "A"),
    ('{"signing_parties": [{"pki_signature_details": {"occupation": "B"}}]}', "B"),
    (ENCODED, "Baker"), ("<x><occupation>C</occupation><occupation>D</occupation></x>", "C"),
    (json.dumps(json.dumps({"pan_details": {"occupation": "E"}})), "E"),
    ('{"occupation": ', None), ("", None), (None, None), ('{"other": 1}', None)])
def test_occupation_shapes(spark, text, value):
    assert one(spark, payload.occupation("x"), text) == value


def test_any_item(spark):
    check = payload.any_item("x", "$.msgs", "category", "Outgoing")
    assert one(spark, check, '{"msgs": [{"category": "In"}, {"category": "Outgoing"}]}') is True
    assert one(spark, check, '{"msgs": []}') is False
    assert one(spark, check, "broken") is None


def test_id_lists(spark):
    assert one(spark, idlists.clean_ids("x"), "10, 9,x,10 ,2") == "2, 9, 10"
    df = spark.createDataFrame([([1, 23],), ([1],), (None,)], "a ARRAY<INT>")
    assert df.where(idlists.lacks("a", 23)).count() == 1
