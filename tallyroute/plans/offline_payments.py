"""Offline payments from files: single due dates, wide tranche files, and the open extract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import catalog, cleaning, payload
from tallyroute.operators import lookup
from tallyroute.operators.changes import Run, with_new_ids
from tallyroute.operators.pick import nth_by, oldest
from tallyroute.operators.validate import PENDING, Check, last_failure, stage
from tallyroute.plans.payments import Crm
from tallyroute.session import cut_lineage

#: snake-cased headers of the two file forms.  Fixed values.
COMMON_HEADERS = (
    "sales_table_date", "client_name", "email_id", "team_head", "sales_rep", "location",
    "pmt_type", "lead_no", "payment_reference", "price", "tds", "discount", "gift_shares",
    "net_price", "product", "status", "mode",
)
SINGLE_HEADERS = (*COMMON_HEADERS, "user_code", "due_date")
TRANCHE_DATES = ("tranche_due_date", *[f"tranche_due_date_{n}" for n in range(1, 5)])
WIDE_HEADERS = (
    *COMMON_HEADERS, "tranche_no", *[f"tranche_no_{n}" for n in range(1, 5)], *TRANCHE_DATES,
)
SINGLE_PLAN = 4


@dataclass(frozen=True)
class PaymentBatch:
    payments: DataFrame
    audit: DataFrame


def clean_file(
    rows: DataFrame, required: Sequence[str], date_columns: Sequence[str]
) -> DataFrame:
    """Snake-case headers, check them, coerce; ``row_id`` was added at ingest."""
    df = cleaning.require_columns(
        cleaning.normalise_headers(rows, cleaning.snake_header), required)
    typed: dict[str, Column] = {
        "email_id": cleaning.canonical("email_id"), "lead_no": cleaning.number("lead_no"),
        "product": cleaning.canonical("product"), "mode": F.trim("mode"),
        **{name: cleaning.number(name) for name in ("price", "discount", "net_price")},
        **{name: cleaning.day_first_date(name)
           for name in ("sales_table_date", *date_columns)},
    }
    return df.withColumns(typed).withColumns(
        {
            "discount_percentage": cleaning.percent("discount", "price"),
            "sub_product_id": cleaning.mapped("product", catalog.PLAN_BY_NAME),
            "payment_method": cleaning.mapped("mode", catalog.METHOD_BY_MODE),
        }
    )


def contacts_by_email(crm: Crm, requests: DataFrame) -> DataFrame:
    """Smallest contact per canonical e-mail that the requests name."""
    known = crm["contact"].select(
        cleaning.canonical("email_address").alias("email_id"), "contact_id")
    return (
        lookup.keyed_fetch(known, requests, "email_id")
        .groupBy("email_id").agg(F.min("contact_id").alias("contact_id"))
    )


def plan_leads(crm: Crm, exact: bool) -> DataFrame:
    """Active leads of the single plan: subscribed (``exact``) or at that stage and beyond."""
    state = F.col("status_id") >= 6
    if exact:
        state = (F.col("status_id") == 6) & (
            F.col("substatus_id") == catalog.ACTIVE_SUBSCRIPTION)
    return crm["lead"].where(
        (F.col("product_id") == 1) & F.array_contains("sub_product_ids", SINGLE_PLAN)
        & F.col("is_active") & state
    ).select("lead_id", "contact_id")


def due_instalments(crm: Crm, unpaid_only: bool) -> DataFrame:
    rows = crm["instalment"]
    if unpaid_only:
        rows = rows.where((F.col("balance_amount") > 0) & F.col("payment_id").isNull())
    return rows.select("lead_id", F.to_date("payable_on").alias("due_date"), "instalment_id",
                       "onboarding_id", "external_customer_id")


def _payment_rows(
    rows: DataFrame, crm: Crm, run: Run, approved_by: str, along: str, tie: Sequence[str] = ()
) -> DataFrame:
    def whole(name: str) -> Column:
        return F.col(name).try_cast("bigint")

    numbered = with_new_ids(rows, crm["offline_payment"], "offline_payment_id", along, tie)
    note = payload.object_of(
        source=F.lit("Bulk Upload"), approved_by=F.lit(approved_by),
        uploaded_via=F.lit("tech team"))
    return numbered.select(
        along, "offline_payment_id", "onboarding_id", "contact_id", "external_customer_id",
        "lead_id", whole("price").alias("amount"), "sub_product_id", "payment_method",
        F.col("payment_reference").alias("payment_utr_number"),
        F.col("sales_table_date").alias("payment_date"), whole("net_price").alias("net_amount"),
        F.lit("Pending").alias("status"), F.lit(run.company).alias("company_id"),
        *[column.alias(name) for name, column in run.stamps().items()],
        F.col("instalment_ids").alias("instalment_id"), note.alias("meta_info"),
        whole("discount").alias("discount_amount"),
        whole("discount_percentage").alias("discount_percentage"),
    )


def offline_payment_batch(
    crm: Crm, requests: DataFrame, run: Run, approved_by: str = "operations"
) -> PaymentBatch:
    """One payment per valid row; the latest failing check names the reason.

    ``requests``: :func:`clean_file` of the single form.  A row matches the instalment of its
    own lead and due date; the earliest instalment wins.
    """
    rows = (
        requests.join(contacts_by_email(crm, requests), "email_id", "left")
        .join(plan_leads(crm, exact=False), "contact_id", "left")
        .join(due_instalments(crm, unpaid_only=True), ["lead_id", "due_date"], "left")
    )
    picked = nth_by(rows, ["row_id"], oldest("instalment_id", "lead_id"))
    audit = cut_lineage(last_failure(
        picked,
        [Check("PAYMENT MODE NOT MAPPED", F.col("payment_method").isNull()),
         Check("CONTACT NOT FOUND", F.col("contact_id").isNull()),
         Check("VALID PMP LEAD NOT FOUND", F.col("lead_id").isNull()),
         Check("INSTALLMENT NOT FOUND FOR DUE DATE", F.col("instalment_id").isNull())],
    ))
    valid = audit.where(F.col("process_status") == PENDING).withColumns(
        {"instalment_ids": F.array("instalment_id"), "sub_product_id": F.lit(SINGLE_PLAN)})
    return PaymentBatch(_payment_rows(valid, crm, run, approved_by, "row_id"), audit)


def tranche_matches(crm: Crm, requests: DataFrame) -> DataFrame:
    """Request rows against instalments on any of their due dates: one row per match."""
    resolved = (
        requests.join(contacts_by_email(crm, requests), "email_id", "left")
        .join(plan_leads(crm, exact=True), "contact_id", "left")
    )
    keep = [name for name in resolved.columns if name not in TRANCHE_DATES]
    return lookup.unpivot_join(
        resolved, keep, list(TRANCHE_DATES), due_instalments(crm, unpaid_only=False),
        {"lead_id": "lead_id", "due_date": "due_date"}, "left",
    )


def winback_batch(
    crm: Crm, requests: DataFrame, run: Run, approved_by: str = "operations"
) -> PaymentBatch:
    """Wide tranche file to one payment per (lead, sales date) with all its instalments.

    ``requests``: :func:`clean_file` of the wide form.  The payment takes its values from the
    first match, earlier due-date columns first, then file order.  The audit has one row per
    request with the stage it reached.
    """
    matches = cut_lineage(tranche_matches(crm, requests))
    place = {name: n for n, name in enumerate(TRANCHE_DATES)}
    found = matches.where(F.col("instalment_id").isNotNull()).withColumn(
        "place", cleaning.mapped("due_column", place))
    pair = ["lead_id", "sales_table_date"]
    ids = found.groupBy(*pair).agg(
        F.sort_array(F.collect_set("instalment_id")).alias("instalment_ids"))
    first = nth_by(found, pair, oldest("place", "row_id", "instalment_id"))
    # NULL sales dates form a pair of their own, so the match is null-safe on the date
    same = (F.col("a.lead_id") == F.col("b.lead_id")) & F.col("a.sales_table_date").eqNullSafe(
        F.col("b.sales_table_date"))
    paid = first.alias("a").join(ids.alias("b"), same).select("a.*", "b.instalment_ids")
    valid = paid.where(F.col("sub_product_id").isNotNull())
    payments = _payment_rows(valid, crm, run, approved_by, "row_id", ["lead_id"])
    reached = matches.groupBy("row_id").agg(
        F.max("contact_id").alias("contact_id"), F.max("lead_id").alias("lead_id"),
        F.min("instalment_id").alias("instalment_id"),
        F.count("instalment_id").alias("matches"))
    audit = stage(
        reached,
        [(F.col("instalment_id").isNotNull(), "Instalment Found"),
         (F.col("lead_id").isNotNull(), "Lead Found"),
         (F.col("contact_id").isNotNull(), "Contact Found")],
        "No Match",
    )
    return PaymentBatch(payments, audit)


def unprocessed_extract(crm: Crm, requests: DataFrame) -> DataFrame:
    """Rows with a numeric user code whose lead has an instalment on the due date."""
    return (
        requests.withColumn("user_code", cleaning.digits("user_code"))
        .where(F.col("user_code").isNotNull())
        .join(contacts_by_email(crm, requests), "email_id")
        .join(plan_leads(crm, exact=True), "contact_id")
        .join(due_instalments(crm, unpaid_only=False), ["lead_id", "due_date"])
        .withColumn("offline_payment_id", F.lit(None).cast("bigint"))
    )
