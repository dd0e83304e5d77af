"""The stacked reports keep little on disk at once, and show the rows that their branches give one by one."""

import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.operators import lookup, unions
from tallyroute.plans import payments, productivity
from tallyroute.plans.shared import Codes, Need, ReadOnce
from tallyroute.session import stored

AS_OF = datetime(2024, 2, 5, 12, 0, 0)


@pytest.fixture(scope="module")
def crm(spark, tmp_path_factory):
    """CRM tables over a few rows of base tables; some orders, owners and contacts come twice, some
    orders have no customer."""
    from entry_queries.bridge import CrmTables

    root = tmp_path_factory.mktemp("base")
    day = "TIMESTAMP_NTZ '2001-06-01' + make_dt_interval(CAST({} AS INT))".format
    tables = {
        "region": (2, "CAST(id AS INT) AS r_regionkey, 'R' || id AS r_name"),
        "nation": (25, "CAST(id AS INT) AS n_nationkey, 'N' || id AS n_name, 0 AS n_regionkey"),
        "customer": (60, "id AS c_custkey, 'C' || id AS c_name, 1 AS c_nationkey,"
                         " 1.5D AS c_acctbal, 'M' || id % 3 AS c_mktsegment"),
        "supplier": (5, "id AS s_suppkey, 'S' || id AS s_name, CAST(id AS INT) AS s_nationkey,"
                        " 0.5D + id AS s_acctbal"),
        "part": (200, "id AS p_partkey, 'P' || id AS p_name, 'B' AS p_brand, 'T' AS p_type,"
                      " 1 AS p_size, 1D AS p_retailprice"),
        "orders": (400, "id AS o_orderkey, IF(id % 43 = 7, NULL, id * 7 % 60) AS o_custkey,"
                        " 'O' AS o_orderstatus, 10.5D + id AS o_totalprice,"
                        f" {day('id % 300')} AS o_orderdate, '1' AS o_orderpriority"),
        "lineitem": (1500, "id * 11 % 400 AS l_orderkey, id * 3 % 150 AS l_partkey,"
                           " id * 5 % 6 AS l_suppkey, CAST(1 + id % 7 AS INT) AS l_linenumber,"
                           " 1D AS l_quantity, 2.5D + id AS l_extendedprice, 0D AS l_discount,"
                           " 0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus,"
                           f" {day('id % 310')} AS l_shipdate"),
        "events": (1200, "id AS event_id, TIMESTAMP_NTZ '2023-11-01' + make_dt_interval("
                         "CAST(id % 90 AS INT)) AS ts, id % 60 AS user_id, element_at(array("
                         "'click', 'view', 'signup', 'purchase', 'error'), CAST(id * 3 % 5 + 1 AS"
                         " INT)) AS event_type, 3.5D * (id % 70) AS value, '{}' AS props"),
    }
    for name, (size, text) in tables.items():
        twice = spark.range(size).where(
            "id % 31 = 3" if name in ("orders", "customer", "supplier") else "false")
        spark.range(size).union(twice).selectExpr(*re.split(r", (?=[^()]*(?:\([^()]*(?:\([^()]*\)[^()]*)*\)[^()]*)*$)", text)
                                                  ).write.parquet(f"{root}/{name}.parquet")
    return CrmTables(spark, str(root))


def labels(df) -> set[str]:
    """What the files were stored as that a frame still reads."""
    return {found[1] for path in df.inputFiles()
            if (found := re.search(r"/([\w-]+)-[0-9a-f]{32}/", path))}


def told(df) -> list[tuple]:
    return rows(df.select(*sorted(df.columns)))


def one_by_one(crm, directory, february):
    branches = {
        "Sales Calling": productivity.sales_calling(crm, one_feedback_per_lead=february),
        "Funnel Management": productivity.funnel_snapshot(crm, AS_OF, other_channels=february),
        "Login Log": productivity.login_log(crm, phone_users_only=february),
        "Target": productivity.targets(crm),
        "LQR": productivity.lead_quality(crm, taken_with_owner_only=not february),
        "Reasons": productivity.loss_reasons(crm),
    }
    return unions.tagged({name: productivity.enrich(crm, df, directory)
                          for name, df in branches.items()})


@pytest.mark.parametrize("february", [False, True])
def test_the_productivity_report_keeps_only_its_longest_branch_to_the_end(spark, crm, february):
    # a list of owners that is not the users' table: an unknown one, one without captain, one missing
    directory = payments.owner_directory(crm, AS_OF).where("rm_id <> 2").union(
        payments.owner_directory(crm, AS_OF).where("rm_id = 1").withColumn("rm_id", F.lit(77)))
    report = productivity.productivity_report(crm, AS_OF, directory, february=february)
    left = labels(report)
    assert {"calling", "funnel", "reasons"} <= left
    assert not left & {"once-follow_up", "once-contact_mapping", "once-activity", "many-side"}
    # rows of the long branch meet owners and contacts before they are many and wide
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = report.where("flag = 'LQR'")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)
    met = next(i for i, keys in enumerate(joins) if "__salt" in keys)
    assert {re.sub(r"#\w+", "", keys) for keys in joins[:met]} <= {
        "status_id", "substatus_id", "product_id", "sub_product_id"}
    expected = one_by_one(crm, directory, february)
    assert report.columns == expected.columns
    assert told(report) == told(expected)
    assert {flag for flag, in report.select("flag").distinct().collect()} == {
        "Sales Calling", "Funnel Management", "Login Log", "Target", "LQR", "Reasons"}


def test_the_payments_report_keeps_only_its_longest_branch_to_the_end(crm):
    report = payments.payments_report(crm, AS_OF, "2023-01-01", excluded_owner=1)
    left = labels(report)
    assert {"detail", "taken", "calls", "leads"} <= left
    assert not left & {"once-instalment", "once-onboarding", "once-lead_log"}
    expected = unions.tagged({
        "Payment": payments.payments_detail(crm, AS_OF, excluded_owner=1),
        "Payment (none)": payments.owners_without_payment(crm, AS_OF),
        "Counsellor Details": payments.owner_directory(crm, AS_OF),
        "Lead Taken": payments.lead_pickups(crm, "2023-01-01"),
        "Activity": payments.call_activity(crm),
        "Combine": payments.lead_activity_payment(crm, AS_OF),
        "Lead Details": payments.lead_details(crm),
    }).withColumn("flag", F.regexp_replace("flag", r" \(none\)$", ""))
    assert report.columns == expected.columns
    assert told(report) == told(expected)


def shuffled(spark) -> set[str]:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {name for i in range(files.size())
            if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_what_was_shuffled_for_stored_rows_is_removed(spark):
    before = shuffled(spark)
    held = stored(spark.range(999).groupBy((F.col("id") % 7).alias("k")).count(), "sevenths")
    deadline = time.time() + 20
    while shuffled(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled(spark) - before
    assert held.count() == 7 and held.agg(F.sum("count")).first()[0] == 999
    # the setting lasts as long as the write
    lazy = spark.range(99).groupBy((F.col("id") % 3).alias("k")).count()
    assert lazy.count() == 3 and lazy.count() == 3
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_masters_keep_the_rows_that_facts_refer_to(spark):
    facts = spark.sql("SELECT * FROM VALUES (1, 7, array(1, 2)), (2, NULL, NULL), (3, 9, array(4))"
                      " AS t(id, code, plans)")
    codes = spark.sql("SELECT * FROM VALUES (7, 'a'), (7, 'b'), (8, 'c'), (9, 'd'), (NULL, 'e')"
                      " AS t(code, name)")
    plans = spark.sql("SELECT * FROM VALUES (1, 8), (2, 2), (3, 3) AS t(plan, code)")
    crm = {"facts": facts, "codes": codes, "plans": plans, "free": codes}
    once = ReadOnce(crm, {"facts": Need(("id", "code", "plans"))}, {
        "plans": Codes("plan", (("facts", F.explode("plans")),)),
        "codes": Codes("code", (("facts", "code"), ("plans", "code")))})
    assert rows(once["plans"]) == [(1, 8), (2, 2)]
    assert rows(once["codes"]) == [(7, "a"), (7, "b"), (8, "c"), (9, "d")]
    assert once["free"].count() == 5


def test_columns_joined_to_dealt_rows(spark):
    left = spark.sql("SELECT * FROM VALUES (1, 'x'), (1, 'y'), (2, 'z'), (NULL, 'n') AS t(k, l)")
    right = spark.range(400).selectExpr("IF(id < 380, 1, IF(id < 390, 3, NULL)) AS k", "id AS r")
    names = spark.sql("SELECT * FROM VALUES (5L, 'five'), (5L, 'fünf') AS t(r, name)")
    expected = left.join(right.join(names, "r", "left"), "k", "left").select("k", "l", "r", "name")
    for store in (True, False):
        found = lookup.many_left_join(left, right, ["k"], store=store,
                                      widen=lambda df: df.join(names, "r", "left"))
        assert rows(found.select("k", "l", "r", "name")) == rows(expected)
