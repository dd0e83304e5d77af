"""Scenario rules: one hand-labelled payment per rule, and the two orders side by side."""

import pytest
from pyspark.sql import functions as F

from tallyroute.functions import catalog
from tallyroute.functions.rules import case_text, classify
from tallyroute.plans.payments import scenario_facts

PAID = "2024-06-01"
BEFORE, AFTER = "2024-05-31", "2024-06-01"

# plan, rank, instalment, plan before, instalment before, expiry before, status before,
# coarse, fine
CASES = [
    (1, 1, 0, None, None, None, None, "New Retail", "New Retail"),
    (1, 2, 0, 23, 0, BEFORE, 6, "New Retail", "Existing upgrade to Retail"),
    (1, 2, 0, 23, 0, AFTER, 6, "New Retail", "Existing upgrade to Retail"),
    (2, 2, 0, 2, 0, AFTER, 6, "Retail Renewal", "Before Expiry"),
    (2, 2, 0, 2, 0, AFTER, 35, "Retail Renewal", "Before Expiry"),
    (2, 2, 0, 2, 0, BEFORE, 6, "New Retail", "Expired to customer"),
    (2, 2, 1, 2, 0, AFTER, 6, "Partpayment", "Retail Renewal Tranche 2"),
    (3, 5, 4, 1, 0, AFTER, 6, "Partpayment", "Retail Renewal Tranche 2"),
    (3, 2, 0, 1, 0, AFTER, 6, "New Retail", "Deactivated to customer"),
    (3, 2, 0, 1, 0, AFTER, 35, "New Retail", "Refund to customer"),
    (3, 2, 0, 1, 1, AFTER, 6, "Unknown Status", "Unknown Scenario"),
    (1, 2, 0, 4, 0, None, 35, "New Retail", "Refund to customer"),
    (1, 2, 0, 4, None, None, 35, "Unknown Status", "Unknown Scenario"),
    (23, 1, 0, None, None, None, None, "New Bundle", "New Bundle"),
    (24, 2, 0, 23, 0, AFTER, 6, "New Bundle", "New Bundle"),
    (24, 2, 3, 24, 0, AFTER, 6, "Renewal Bundle", "Before Expiry"),
    (24, 2, 0, 24, 0, BEFORE, 6, "New Bundle", "Expired to customer"),
    (24, 2, 1, 23, 0, AFTER, 6, "Unknown Status", "Unknown Scenario"),
    (4, 1, 0, None, None, None, None, "New Retail Plus", "New Retail Plus"),
    (4, 2, 0, 8, 0, AFTER, 6, "New Retail Plus", "New Retail Plus"),
    (4, 2, 1, 4, 0, AFTER, 6, "Partpayment", "Retail Plus Partpayment"),
    (4, 2, 2, 1, 0, AFTER, 6, "Partpayment", "Retail Plus Partpayment"),
    (4, 2, 0, 1, 0, BEFORE, 6, "New Retail Plus", "Expired to customer"),
    (4, 2, None, 1, 0, BEFORE, 6, "New Retail Plus", "Expired to customer"),
    (4, 2, 0, 1, 0, AFTER, 35, "New Retail Plus", "Refund to customer"),
    (4, 2, 0, 1, 0, AFTER, 6, "Existing Upgrade", "Existing Upgrade To Retail Plus"),
    (4, 2, 0, 11, 0, AFTER, 6, "Unknown Status", "Unknown Scenario"),
    (5, 1, 0, None, None, None, None, "New Advisory", "New Advisory"),
    (8, 2, 0, 4, 0, AFTER, 6, "New Advisory", "New Advisory"),
    (8, 2, 0, 8, 0, AFTER, 6, "Renewal Advisory", "Before Expiry"),
    (8, 2, 1, 8, 0, AFTER, 6, "Partpayment", "Advisory Renewal Tranche 2"),
    (8, 2, 0, 8, 0, BEFORE, 6, "New Advisory", "Expired to customer"),
    (8, 2, 0, 5, 0, AFTER, 35, "New Advisory", "Refund to customer"),
    (8, 2, 0, 5, 0, AFTER, 6, "New Advisory", "Deactivated to customer"),
    (11, 1, 0, None, None, None, None, "New Advisory Plus", "New Advisory Plus"),
    (11, 2, 0, 1, 0, AFTER, 6, "New Advisory Plus", "New Advisory Plus (Existing Upgrade)"),
    (11, 2, 0, 1, 0, BEFORE, 6, "Unknown Status", "Unknown Scenario"),
    (11, 2, 0, 5, 0, BEFORE, 6, "New Advisory Plus", "Expired to customer"),
    (11, 2, 0, 5, 0, AFTER, 35, "New Advisory Plus", "Refund to customer"),
    (11, 2, 0, 5, 0, AFTER, 6, "Existing Upgrade", "Existing Upgrade To Advisory Plus"),
    # a later instalment after another family: the two lists disagree by design
    (11, 2, 1, 5, 0, AFTER, 6, "Partpayment", "Existing Upgrade To Advisory Plus"),
    (11, 2, 1, 5, 0, BEFORE, 6, "Partpayment", "Expired to customer"),
    (11, 2, 1, 11, 0, AFTER, 6, "Partpayment", "Advisory Plus Partpayment"),
    (99, 1, 0, None, None, None, None, "Unknown Status", "Unknown Scenario"),
]


def test_every_scenario_rule(spark):
    schema = ("sub_product_id INT, installment_rank INT, instalment_number INT,"
              " previous_sub_product_id INT, previous_instalment_number INT, expiry STRING,"
              " previous_status_id INT, coarse STRING, fine STRING")
    df = spark.createDataFrame(CASES, schema).withColumns({
        "previous_expiry_date": F.to_date("expiry"), "payment_date": F.to_timestamp(F.lit(PAID))})
    labelled = df.withColumns(scenario_facts()).select(
        "*", F.expr(catalog.payment_status_text()).alias("s"),
        F.expr(catalog.scenario_text()).alias("c"))
    wrong = [r.asDict() for r in labelled.collect() if (r.s, r.c) != (r.coarse, r.fine)]
    assert not wrong


def test_site_names_go_into_labels(spark):
    names = {**catalog.FAMILY_NAMES, "bundle": "Starter"}
    assert "'New Starter'" in catalog.payment_status_text(names)
    assert "Bundle" not in catalog.scenario_text(names)


@pytest.mark.parametrize("method,provider,kind,mode", [
    (110, 305, "Online", "Cheque"), (110, 166, "Offline", "Old-Razorpay"),
    (115, 166, "Online", "New-Razorpay"), (109, 167, "Offline", "Instamojo"),
    (114, 304, "Online", "Other"), (117, 231, "Online", "Razorpay-Emandate"),
    (117, 231, "Offline", "Unknown"), (113, 169, "Online", "INTERNET BANKING"),
    (111, 170, "Offline", "NEFT"), (112, 169, "Online", "Unknown"), (112, 168, "Online", "RTGS"),
    (109, 300, "Online", "UPI"), (None, 300, "Online", "Unknown")])
def test_payment_modes(spark, method, provider, kind, mode):
    df = spark.createDataFrame([(method, provider, kind)], "m INT, p INT, t STRING")
    assert df.select(F.expr(catalog.payment_mode_text("m", "p", "t"))).first()[0] == mode


def test_mandate_label_has_no_second_name():
    assert sum(117 in methods for _, methods, _, _ in catalog.PAYMENT_MODES) == 1


def test_first_rule_wins_and_null_never_holds(spark):
    rules = [("x > 1", "big"), ("x > 0", "some")]
    df = spark.createDataFrame([(2,), (1,), (None,)], "x INT")
    assert [r[0] for r in df.select(classify(rules, "none")).collect()] == ["big", "some", "none"]
    assert case_text(rules, None).endswith("ELSE NULL END")


def test_bucket_of_unknown_substatus_is_zero(spark):
    df = spark.createDataFrame([(None,), (6,), (1,)], "s INT")
    touched = F.expr(f"CASE WHEN {catalog.bucket_conditions('s')['touched']} THEN 1 ELSE 0 END")
    assert [r[0] for r in df.select(touched).collect()] == [0, 1, 0]


def test_funnel_has_all_measures():
    assert len(catalog.funnel_conditions("a", "b", "c", "d", "e")) == 69
