"""Reassignment of collection cases from a typed-in file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import cleaning
from tallyroute.operators import lookup
from tallyroute.operators.changes import Run, reassign_collections
from tallyroute.plans.payments import Crm
from tallyroute.plans.service import active_owner

#: squeezed header -> column, the usual misspelling included.  Fixed values.
HEADERS = {
    "cutomer_email": "customer_email", "instalment id": "instalment_id", "rm email": "rm_email",
}
REQUIRED = ("customer_email", "instalment_id", "rm_email", "counsellor")


def collection_requests(
    crm: Crm, rows: DataFrame, *, plan: int = 4, substatus: int = 29, status: int = 6
) -> DataFrame:
    """File rows (all text) to distinct (``lead_id``, ``old_rm_id``, ``new_rm_id``).

    The old owner is found by e-mail, the new one by name, the contact by e-mail, and the lead
    through the contact's active contract of the plan.  Rows with an instalment id that is no whole
    number, or with one of the four unknown, give nothing.
    """
    named = cleaning.rename(cleaning.normalise_headers(rows), HEADERS)
    text = {name: cleaning.canonical(name) for name in ("customer_email", "rm_email", "counsellor")}
    asked = cleaning.require_columns(named, REQUIRED).withColumns(
        {"instalment_id": cleaning.digits("instalment_id"), **text}
    ).where(F.col("instalment_id").isNotNull())
    contacts = lookup.keyed_fetch(
        lookup.canonical_key(crm["contact"], "email_address", "customer_email")
        .select("customer_email", "contact_id"), asked, "customer_email")
    contracts = crm["onboarding"].where(
        (F.col("status_id") >= status) & (F.col("substatus_id") == substatus)
        & (F.col("sub_product_id") == plan)).select("contact_id", "lead_id")
    return (
        asked.join(active_owner(crm, "rm_email", "email_address", "old_rm_id"), "rm_email")
        .join(active_owner(crm, "counsellor", "full_name", "new_rm_id"), "counsellor")
        .join(contacts, "customer_email")
        .join(lookup.keyed_fetch(contracts, contacts, "contact_id"), "contact_id")
        .select("lead_id", "old_rm_id", "new_rm_id").where("lead_id IS NOT NULL").distinct()
    )


def reassign_from_file(crm: Crm, rows: DataFrame, run: Run):
    """File rows straight to the new follow-ups and cases and their audit."""
    return reassign_collections(
        crm["follow_up"], crm["payment_collection"], collection_requests(crm, rows), run)
