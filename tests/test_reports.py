"""Reports read every fact table once."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.functions import catalog
from tallyroute.plans import payments, productivity
from tallyroute.plans.shared import Need, ReadOnce

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def crm(spark, tmp_path_factory):
    """Every CRM table as a folder of its own."""
    from entry_queries.bridge import CrmTables

    source, root = CrmTables(spark, FOLDER), tmp_path_factory.mktemp("crm")

    class Written(dict):
        def __missing__(self, name):
            path = str(root / f"table_{name}")
            source[name].write.parquet(path)
            self[name] = spark.read.parquet(path)
            return self[name]

    return Written()


def scans(df) -> list[str]:
    text = df._jdf.queryExecution().optimizedPlan().toString()
    files = df._jdf.queryExecution().sparkPlan().toString()
    return re.findall(r"table_(\w+)", files) if "table_" in files else re.findall(r"table_(\w+)", text)


@needs_data
def test_fact_tables_are_read_once(spark, crm):
    from datetime import datetime

    as_of = datetime(2024, 2, 5, 12, 0, 0)
    report = payments.payments_report(crm, as_of, "2023-01-01", excluded_owner=7)
    left = set(scans(report))
    assert not left & set(payments.payment_facts()) and "mst_user" in left
    for february in (False, True):
        report = productivity.productivity_report(
            crm, as_of, payments.owner_directory(crm, as_of), february=february)
        left = set(scans(report))
        assert not left & set(productivity.productivity_facts(february)) and "mst_user" in left


@needs_data
def test_outcomes_of_both_branches_come_from_one_pass(spark, crm):
    from datetime import datetime

    as_of = datetime(2024, 1, 25, 12, 0, 0)
    calls, recent = payments.both_outcomes(crm, as_of, 10)
    assert rows(calls.select(*sorted(calls.columns))) == rows(
        payments.call_outcomes(crm).select(*sorted(calls.columns)))
    assert rows(recent.select(*sorted(recent.columns))) == rows(
        payments.recent_outcomes(crm, as_of, 10).select(*sorted(recent.columns)))
    assert calls.count() and recent.count()


def test_only_asked_columns_and_rows_are_stored(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS v", "'x' AS wide")
    once = ReadOnce({"a": df, "b": df}, {"a": Need(("id", "v"), F.col("id") > 6)})
    assert once["a"].columns == ["id", "v"] and once["a"].count() == 3
    assert once["b"].count() == 10


def _dealt_spine(df):
    """Keys by which the left side of the joins of a report is dealt, from its end to its source."""
    node, keys = df._jdf.queryExecution().sparkPlan(), []
    while True:
        if "Join" in node.nodeName():
            keys.append(tuple(node.leftKeys().apply(i).name() for i in range(node.leftKeys().size())))
        below = node.children()
        if below.size() == 0:
            return keys
        node = below.apply(0)


@needs_data
def test_the_rows_of_the_payment_detail_are_dealt_once_per_key(spark, crm):
    from datetime import datetime

    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = _dealt_spine(payments.payments_detail(crm, datetime(2024, 2, 5, 12, 0, 0)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    turns = [key for i, key in enumerate(keys) if i == 0 or keys[i - 1] != key]
    # demography and plans are joined to contracts and amounts, and the widest side comes last
    assert turns == [("onboarding_id",), ("lead_id",), ("contact_id",),
                     ("payment_id", "sub_product_id"), ("payment_id",)]


def test_histories_of_booked_leads_are_found_without_sorting_them(spark):
    links = "utm_medium STRING, utm_source STRING, utm_campaign STRING, utm_content STRING, page_url STRING"
    stamp = "TIMESTAMP_NTZ"

    def table(values, schema):
        return spark.sql(f"SELECT * FROM VALUES {values}").toDF(
            *[c.split()[0] for c in schema.split(", ")]).selectExpr(
                *[f"CAST({name} AS {kind}) AS {name}"
                  for name, kind in (c.split() for c in schema.split(", "))])

    crm = {
        # the latest bookings of contacts 1 and 2 share a lead, that of contact 3 has none
        "follow_up": table(
            "(1, 1, 9, '2024-01-01'), (2, 1, 7, '2024-01-02'), (3, 2, 7, '2024-01-03'),"
            " (4, 3, NULL, '2024-01-04')",
            f"follow_up_id BIGINT, contact_id BIGINT, lead_id BIGINT, created_at {stamp}").selectExpr(
                "*", "'whatsapp' AS source", "'{\"utm_source\": \"s\"}' AS source_info",
                "false AS is_completed", "created_at AS follow_up", "created_at AS updated_at",
                f"CAST(NULL AS {stamp}) AS completed_on"),
        "lead": table("(1, 7, 1), (2, 7, 1)", "contact_id BIGINT, lead_id BIGINT, substatus_id INT"),
        "lead_log": table(
            f"(7, 2, {catalog.REPEAT_SUBSTATUS}, 'late'), (7, 1, 1, 'early'), (9, 3, 1, 'other'),"
            f" (NULL, 4, {catalog.REPEAT_SUBSTATUS}, 'none')",
            "lead_id BIGINT, log_id BIGINT, substatus_id INT, utm_source STRING").selectExpr(
                "*", *[f"'x' AS {c.split()[0]}" for c in links.split(", ") if "utm_source" not in c],
                "TIMESTAMP_NTZ '2024-01-01' AS created_at", "TIMESTAMP_NTZ '2024-01-02' AS updated_at"),
        "sales_flat_data": table("(7, '2024-02-02'), (7, '2024-02-01')",
                                 f"lead_id BIGINT, payment_date {stamp}"),
        "status_log": table(f"(7, {catalog.ACTIVE_SUBSCRIPTION}, '2024-01-01', 1, 5)",
                            f"lead_id BIGINT, substatus_id INT, created_at {stamp},"
                            " status_log_id BIGINT, rm_id BIGINT"),
        "contact": table("(1, 'a'), (2, 'b'), (3, 'c')", "contact_id BIGINT, full_name STRING"),
        "mst_user": table("(5, 'u', 'e')", "user_id BIGINT, full_name STRING, email_address STRING"),
    }
    found = productivity.appointments(crm, "2024-03-01")
    shown = found.select("appointment_lead_name", "initial_utm_source", "repeat_utm_source",
                         "payment_date_ab", "converted_by_name")
    assert [(*told, day is not None, by) for *told, day, by in rows(shown)] == [
        ("a", "early", "late", True, "u"), ("b", "early", "late", True, "u"),
        ("c", None, None, False, None)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    hashed = re.findall(r"ShuffledHashJoin \[lead_id#\w+\], \[lead_id#\w+\], LeftSemi", plan)
    assert len(hashed) == 4
    assert not re.search(r"SortMergeJoin \[lead_id#\w+\], \[lead_id#\w+\], LeftSemi", plan)
