"""Customer service: request validation, re-assignment plan, and lead creation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import catalog, cleaning, dates
from tallyroute.operators import allocate, lookup
from tallyroute.operators.pick import last_known
from tallyroute.operators.running import dense_index
from tallyroute.operators.validate import PENDING, Check, first_failure, last_failure
from tallyroute.plans.payments import Crm, named
from tallyroute.session import cut_lineage

#: headers of the lead creation file after squeezing.  Fixed values.
CREATION_HEADERS = (
    "lead number", "emailasperleadsquared", "product", "client name", "contact no.", "cust id",
    "subscription date", "original expiry date", "final expiry date", "account status",
    "allocated to",
)


def plans_by_name(crm: Crm) -> DataFrame:
    """Active plan per canonical name; the last row of a repeated name counts."""
    active = crm["mst_subproduct"].where("is_active").select(
        cleaning.canonical("name").alias("plan_name"), "product_id", "sub_product_id")
    return lookup.last_entry(
        active.withColumn("__order", F.col("sub_product_id")), "plan_name", "__order",
        ["product_id", "sub_product_id"])


def active_owner(crm: Crm, key: str, source: str, found: str) -> DataFrame:
    """Active user per canonical name or e-mail; the last of several namesakes counts."""
    return crm["mst_user"].where("is_active").groupBy(
        cleaning.canonical(source).alias(key)).agg(F.max("user_id").alias(found))


def contact_by_email(crm: Crm, requests: DataFrame, key: str) -> DataFrame:
    """Smallest contact per canonical e-mail that the requests name."""
    known = crm["contact"].select(cleaning.canonical("email_address").alias(key), "contact_id")
    return lookup.keyed_fetch(known, requests, key).groupBy(key).agg(
        F.min("contact_id").alias("contact_id"))


def service_requests(crm: Crm, requests: DataFrame) -> DataFrame:
    """Check a service transfer file; the first failing check names the reason.

    ``requests``: ``row_id``, ``new_rm``, ``old_rm``, ``email``, ``product`` as text.
    """
    rows = requests.withColumns(
        {name: cleaning.canonical(name) for name in ("new_rm", "old_rm", "email", "product")})
    subscribed = crm["lead"].where(
        (F.col("status_id") == 6) & (F.col("substatus_id") == catalog.ACTIVE_SUBSCRIPTION)
    ).groupBy("contact_id").agg(F.max("lead_id").alias("lead_id"))
    rows = lookup.star(
        rows,
        (plans_by_name(crm).withColumnRenamed("plan_name", "product"), "product"),
        (active_owner(crm, "new_rm", "full_name", "new_rm_id"), "new_rm"),
        (active_owner(crm, "old_rm", "full_name", "old_rm_id"), "old_rm"),
        (contact_by_email(crm, rows, "email"), "email"),
        (subscribed, "contact_id"),
    )
    return first_failure(
        rows,
        [Check("PRODUCT NOT FOUND", F.col("product_id").isNull()),
         Check("NEW RM NOT FOUND", F.col("new_rm_id").isNull()),
         Check("CONTACT NOT FOUND", F.col("contact_id").isNull()),
         Check("QUALIFIED LEAD NOT FOUND", F.col("lead_id").isNull())],
    )


def creation_requests(
    crm: Crm, requests: DataFrame, owners: Sequence[int] | None = None
) -> DataFrame:
    """Check a lead creation file; the last failing check names the reason.

    Without an owner list the file's own allocation e-mail decides; with one, valid rows are
    dealt to the owners in turn.  ``requests`` has squeezed headers and ``row_id``.
    """
    rows = cleaning.require_columns(requests, CREATION_HEADERS).select(
        "row_id", cleaning.digits("`lead number`").alias("lead_number"),
        cleaning.canonical("emailasperleadsquared").alias("email"),
        cleaning.canonical("product").alias("plan_name"),
        cleaning.canonical("`allocated to`").alias("owner_email"),
    ).where(F.col("lead_number").isNotNull())
    rows = lookup.star(rows, (plans_by_name(crm), "plan_name"),
                       (contact_by_email(crm, rows, "email"), "email"))
    checks = [Check("PRODUCT NOT FOUND", F.col("product_id").isNull()),
              Check("EMAIL NOT FOUND", F.col("contact_id").isNull())]
    if owners is None:
        rows = rows.join(active_owner(crm, "owner_email", "email_address", "rm_id"),
                         "owner_email", "left")
        return last_failure(rows, [*checks, Check("RM NOT FOUND", F.col("rm_id").isNull())])
    judged = last_failure(rows, checks)
    valid = judged.where(F.col("process_status") == PENDING)
    dealt = dense_index(valid, "row_id", "__turn").withColumn(
        "rm_id", allocate.turn(owners, F.col("__turn"))).drop("__turn")
    return dealt.unionByName(
        judged.where(F.col("process_status") != PENDING), allowMissingColumns=True)


def service_plan(
    crm: Crm,
    start,
    end,
    owners: Sequence[int],
    *,
    plans: Sequence[int] = (1, 2, 3),
    substatus: Sequence[int] = (29, 31),
) -> DataFrame:
    """Balanced new service owner for running subscriptions, per start month and colour.

    The month is a key, not a loop.  ``start`` (inclusive) and ``end`` (exclusive) bound the
    subscription start.
    """
    running = crm["lead"].where(
        F.col("substatus_id").isin(list(substatus)) & (F.col("product_id") == 1)
    ).select("lead_id")
    base = (
        crm["onboarding"].where(
            dates.in_range("subscription_start_date", dates.midnight(start),
                           dates.midnight(end))
            & F.col("sub_product_id").isin(list(plans)))
        .select("lead_id", F.trunc(F.to_date("subscription_start_date"), "MM").alias("month"))
        .join(running, "lead_id", "left_semi").distinct()
    )
    feedback = last_known(
        crm["feedback_response"].join(base.select("lead_id").distinct(), "lead_id", "left_semi"),
        ["lead_id"], "color", "feedback_response_id",
        ["feedback_response_id", "onboarding_id", "contact_id", "assigned_to", "created_at"],
        catalog.SERVICE_COLOUR_DEFAULT,
    )
    contract = crm["onboarding"].select(
        "onboarding_id", "sub_product_id", F.col("subscription_start_date"),
        F.col("created_at").alias("onboarded_at"))
    rows = base.join(feedback, "lead_id").join(contract, "onboarding_id").join(
        named(crm["mst_subproduct"], "sub_product_id", "sub_product_id", sub_product="name"),
        "sub_product_id")
    assigned = allocate.balanced_reassign(
        cut_lineage(rows), ["month", "color"], "assigned_to", owners, "created_at",
        "feedback_response_id", "new_assigned_to")
    users = crm["mst_user"]
    return lookup.star(
        assigned,
        (named(crm["contact"], "contact_id", "contact_id", customer_name="full_name",
               customer_email="email_address", customer_mobile="mobile_number"), "contact_id"),
        (named(users, "user_id", "assigned_to", previous_assignee="full_name"), "assigned_to"),
        (named(users, "user_id", "new_assigned_to", new_assignee="full_name"),
         "new_assigned_to"),
    ).select(
        "month", "lead_id", "color", "customer_name", "customer_email", "customer_mobile",
        "onboarding_id", "contact_id", "assigned_to", "previous_assignee", "sub_product",
        "subscription_start_date", "onboarded_at", "new_assigned_to", "new_assignee", "kept",
    )
