"""Expired customers without a running subscription, and their match to a supplied list."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import catalog, cleaning, dates
from tallyroute.operators import lookup
from tallyroute.operators.pick import latest_by
from tallyroute.plans.payments import Crm, named


def expired_customers(
    crm: Crm,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    product_id: int | None = None,
) -> DataFrame:
    """Latest lead of every contact with an expired and no active lead.

    ``start`` and ``end`` are inclusive days of the expired lead's creation.
    """
    lead = crm["lead"]
    last = None if end is None else dates.midnight(end) + timedelta(days=1)
    first = None if start is None else dates.midnight(start)
    expired = lead.where(
        F.col("substatus_id").isin(list(catalog.EXPIRED_SUBSTATUS))
        & dates.in_range("created_at", first, last)
    ).select("contact_id").distinct()
    active = lead.where(F.col("substatus_id") == catalog.ACTIVE_SUBSCRIPTION)
    lapsed = lookup.without(expired, active, ["contact_id"])
    newest = latest_by(
        lead.join(lapsed, "contact_id", "left_semi").select(
            "lead_id", "contact_id", F.col("created_at").alias("lead_created_at"), "status_id",
            "substatus_id", "product_id", "sub_product_ids", "rm_id"),
        ["contact_id"], "lead_created_at", "lead_id",
    )
    if product_id is not None:
        newest = newest.where(F.col("product_id") == product_id)
    with_plan = lookup.array_member_left_join(
        newest, "lead_id", "sub_product_ids",
        named(crm["mst_subproduct"], "sub_product_id", "sub_product_id", sub_product="name"),
        "sub_product_id")
    owners = lookup.star(
        named(crm["mst_user"], "user_id", "rm_id", counsellor_name="full_name",
              location_id="location_id"),
        (named(crm["mst_location"], "location_id", "location_id", counsellor_location="name"),
         "location_id"),
    ).drop("location_id")
    contracts = crm["onboarding"].select("lead_id", "onboarding_id")
    rows = lookup.star(
        with_plan.join(
            crm["contact"].select("contact_id", "full_name", "mobile_number", "email_address",
                                  F.to_date("created_at").alias("contact_created_date")),
            "contact_id"),
        (contracts, "lead_id"),
        (named(crm["mst_status"], "status_id", "status_id", status="name"), "status_id"),
        (named(crm["mst_substatus"], "substatus_id", "substatus_id", substatus="name"),
         "substatus_id"),
        (named(crm["mst_product"], "product_id", "product_id", product="name"), "product_id"),
        (owners, "rm_id"),
    )
    return rows.select(
        F.col("full_name").alias("lead_name"), F.col("mobile_number").alias("lead_contact"),
        F.col("email_address").alias("lead_email"), "contact_id", "lead_id", "onboarding_id",
        dates.day_text("lead_created_at").alias("lead_created_date"), "contact_created_date",
        "status", "substatus", "product", "sub_product", "counsellor_name",
        "counsellor_location",
    )


def match_list(supplied: DataFrame, expired: DataFrame, email: str) -> DataFrame:
    """Supplied rows with the expired customer of the same e-mail, or NULLs."""
    ours = expired.withColumn(
        "__email", cleaning.null_if_token("lead_email")).where(F.col("__email").isNotNull())
    return supplied.withColumn("__email", cleaning.null_if_token(email)).join(
        ours, "__email", "left").drop("__email")
