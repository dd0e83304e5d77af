"""Refund batch: request rows to one refund per contact and a complete audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import cleaning, payload
from tallyroute.operators import lookup, measures
from tallyroute.operators.changes import EXECUTE, Run, with_new_ids, write_back
from tallyroute.operators.pick import any_by, latest_by
from tallyroute.operators.validate import PENDING, Check, last_failure
from tallyroute.plans.payments import Crm
from tallyroute.session import cut_lineage

#: file header after snake-casing -> column.  Fixed values.
HEADERS = {
    "counselor_counsellor_rm": "counselor",
    "client_name": "client_name",
    "client_email_id": "client_email",
    "client_phone_number": "client_phone",
    "lead_contact_id": "contact_id",
    "onboarding_date": "onboarding_date",
    "refund_request_date_from_client": "refund_request_date",
    "detail_concern": "detail_concern",
    "ops_status": "ops_status",
    "refund_category": "refund_category",
    "refund_sub_category": "refund_sub_category",
    "reason": "reason",
    "reason_sub_category": "reason_sub_category",
    "amount": "amount",
    "gst_amount": "gst_amount",
    "refund_amount": "refund_amount",
    "bank_proof": "bank_proof",
    "deactivation_yes_no": "deactivation_flag",
    "refunded_product": "refunded_product",
    "date_of_request_raised_to_finance_ops": "finance_request_date",
    "ops_remarks": "ops_remarks",
    "refund_date_finance": "refund_date",
    "utr_finance": "utr",
    "amount_paid": "amount_paid",
    "finance_remarks": "finance_remarks",
    "ec_status_refunded": "ec_status",
    "dashboard_deactivation_dated": "dashboard_deactivation_date",
    "deactivation_email_to_client": "deactivation_email_date",
}
TEXT = ("counselor", "client_name", "ops_status", "refund_category", "refund_sub_category",
        "reason", "reason_sub_category", "finance_remarks")
MONEY = ("amount", "gst_amount", "refund_amount", "amount_paid")
DATES = ("onboarding_date", "refund_request_date", "finance_request_date", "refund_date",
         "dashboard_deactivation_date", "deactivation_email_date", "ec_status")
REFUND_TYPE = 257


@dataclass(frozen=True)
class RefundBatch:
    refunds: DataFrame
    audit: DataFrame


def clean_requests(rows: DataFrame) -> DataFrame:
    """File rows (all text, ``row_id`` added at ingest) to typed columns."""
    named = cleaning.normalise_headers(rows, cleaning.snake_header)
    named = cleaning.rename(cleaning.require_columns(named, HEADERS), HEADERS)
    typed: dict[str, Column] = {name: F.trim(name) for name in TEXT}
    typed |= {name: cleaning.number(name) for name in MONEY}
    typed |= {name: cleaning.day_first_date(name) for name in DATES}
    typed |= {
        "client_email": cleaning.canonical("client_email"),
        "contact_id": cleaning.digits("contact_id"),
        "deactivation_flag": cleaning.yes_no("deactivation_flag"),
    }
    return named.withColumns(typed)


def active_contracts(crm: Crm, requests: DataFrame) -> DataFrame:
    """Latest active contract of each contact that the requests name."""
    active = crm["onboarding"].where(F.col("substatus_id") == 29).select(
        "contact_id", "onboarding_id", "created_at")
    return latest_by(
        lookup.keyed_fetch(active, requests, "contact_id"),
        ["contact_id"], "created_at", "onboarding_id",
    ).select("contact_id", "onboarding_id")


def contract_payments(crm: Crm, contracts: DataFrame) -> DataFrame:
    """Per given contract: payment ids, and the last known value of each payment attribute."""

    def last_known(name: str) -> Column:
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.col("payment_id")))

    attributes = ("lead_id", "payment_provider", "external_customer_id", "sub_product_id")
    paid = lookup.keyed_fetch(crm["payment"], contracts, "onboarding_id")
    return paid.groupBy("onboarding_id").agg(
        F.sort_array(F.collect_set("payment_id")).alias("payment_ids"),
        F.max("payment_id").alias("payment_id"),
        *[last_known(name).alias(name) for name in attributes],
    )


def resolve(crm: Crm, requests: DataFrame) -> DataFrame:
    """Add contract, reason and status; a missing payment outranks a missing reason."""
    reasons = any_by(
        crm["mst_reason"].select(cleaning.code("code").alias("reason_sub_category_clean"),
                                 "reason_id"),
        ["reason_sub_category_clean"], "reason_id",
    )
    contracts = active_contracts(crm, requests)
    paid = lookup.keyed_fetch(
        crm["payment"].select("onboarding_id"), contracts, "onboarding_id"
    ).distinct().withColumn("has_payment", F.lit(True))
    rows = (
        requests.withColumn("reason_sub_category_clean",
                            cleaning.code(cleaning.filled("reason_sub_category")))
        .join(reasons, "reason_sub_category_clean", "left")
        .join(contracts, "contact_id", "left")
        .join(paid, "onboarding_id", "left")
    )
    return last_failure(
        rows,
        [Check("REASON NOT FOUND", F.col("reason_id").isNull()),
         Check("VALID PAYMENT NOT FOUND", F.col("has_payment").isNull())],
    ).drop("has_payment")


def per_contact(rows: DataFrame) -> DataFrame:
    """One row per contact: sums, values along the refund date, distinct concerns in order."""
    order = ["refund_date", "row_id"]

    def last_known(name: str) -> Column:
        rank = F.struct(F.col("refund_date").isNull().alias("n"), "refund_date", "row_id")
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), rank))

    known_first = F.struct(F.col("refund_date").isNull().alias("n"), "refund_date", "row_id")
    sums = rows.groupBy("contact_id").agg(
        *[measures.money(name).alias(name) for name in MONEY],
        *[last_known(name).alias(name)
          for name in ("onboarding_id", "utr", "refund_date", "bank_proof")],
        measures.first_along("reason_id", order).alias("reason_id"),
    )
    concerns = (
        rows.where(F.col("detail_concern").isNotNull())
        .groupBy("contact_id", F.trim("detail_concern").alias("text"))
        .agg(F.min(known_first).alias("at"))
        .groupBy("contact_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"))
        .select("contact_id",
                F.array_join(F.col("parts.text"), ", ").alias("detail_concern"))
    )
    return sums.join(concerns, "contact_id", "left")


def refund_batch(
    crm: Crm, requests: DataFrame, run: Run, per_row: bool = False
) -> RefundBatch:
    """``requests``: output of :func:`clean_requests`.  Every request row appears in the audit.

    The judged rows are stored once; sums, concerns, refunds and audit all read them.  With
    ``per_row`` every valid row is a refund of its own, numbered in file order, instead of one
    refund per contact.
    """
    rows = cut_lineage(resolve(crm, requests))
    valid = rows.where(F.col("process_status") == PENDING)
    key = "row_id" if per_row else "contact_id"
    grouped = (valid if per_row else per_contact(valid)).join(
        contract_payments(crm, valid), "onboarding_id")

    kind = F.lit(REFUND_TYPE)
    numbered = with_new_ids(grouped, crm["refund"], "refund_id", key)
    refunds = numbered.select(
        "refund_id", "payment_id", "onboarding_id", "contact_id", "external_customer_id",
        "lead_id", "sub_product_id", kind.alias("type"),
        cleaning.whole("amount_paid").alias("received_amount"), cleaning.whole("amount").alias("amount"),
        cleaning.whole("gst_amount").alias("gst_amount"), cleaning.whole("refund_amount").alias("refund_amount"),
        F.col("detail_concern").alias("comment"),
        F.col("payment_provider").alias("payment_provider_id"),
        kind.alias("payment_method_id"), F.col("utr").alias("payment_utr_number"),
        "refund_date", cleaning.whole("amount_paid").alias("net_amount"), F.lit("Pending").alias("status"),
        run.now.alias("approved_rejected_at"), F.lit(run.actor).alias("approved_rejected_by"),
        run.now.alias("processed_at"), F.lit(run.actor).alias("processed_by"),
        F.lit(run.company).alias("company_id"),
        *[column.alias(name) for name, column in run.stamps().items()],
        F.lit(False).alias("send_refunded_email"), F.col("reason_id").alias("refund_reason_id"),
        cleaning.whole("refund_amount").alias("claim_amount"),
        F.col("payment_ids").alias("temp_payment_ids"),
        payload.object_of(status=F.lit("Process By Tech Team")).alias("tech_response"),
        *([F.col("row_id")] if per_row else []),
    )
    if run.mode != EXECUTE:
        unpaid = rows.withColumn("refund_id", F.lit(None).cast("bigint"))
        return RefundBatch(refunds.limit(0), unpaid)
    results = refunds.select(
        key, F.lit("SUCCESS").alias("process_status"), F.lit("").alias("remarks"),
        "refund_id",
    )
    failed = rows.where(F.col("process_status") != PENDING).withColumn(
        "refund_id", F.lit(None).cast("bigint"))
    done = write_back(
        valid, results, key,
        ["process_status", "remarks", "refund_id"],
    )
    return RefundBatch(refunds, done.unionByName(failed))
