"""A cross-section of registered queries against their SQL oracles at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = (
    "scenario_counts", "payment_scenarios", "payments_detail", "funnel_snapshot", "sales_calling",
    "engagement_report", "lead_quality", "loss_reasons", "service_plan", "transfer_apply",
    "transfer_by_quota", "transfer_by_list", "cs_transfer_copy", "restore_from_log",
    "refund_audit", "winback_batch", "payment_batch", "file_round_trip", "values_dump_ingest",
    "array_membership_left_join", "quota_allocation", "balanced_reassign",
)

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


def test_every_query_has_an_oracle():
    from entry_queries.registry import QUERIES

    own = {name for name, plan in QUERIES.items() if plan.__module__.startswith("entry_queries")}
    assert own and own <= set(entry.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    verdict, _, _ = compare(spark, con, FOLDER, name, entry.queries()[name],
                            entry.oracle_sql()[name])
    assert verdict == "ok"


@needs_data
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
