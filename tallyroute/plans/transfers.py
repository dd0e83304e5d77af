"""Transfer batches: by list, by quota, by hierarchy, and by allocation table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import catalog, cleaning
from tallyroute.operators import allocate, lookup
from tallyroute.operators.audit import TRANSFER_AUDIT, audit_frame
from tallyroute.operators.changes import (
    EXECUTE, Run, Transfer, last_request, transfer_leads, transferable,
)
from tallyroute.operators.pick import latest_by, nth_by
from tallyroute.operators.validate import Check, all_failures
from tallyroute.plans.payments import Crm
from tallyroute.session import cut_lineage

SYSTEM_USERS = (1,)


@dataclass(frozen=True)
class TransferBatch:
    """``transfer`` is None in a dry run; ``audit`` names every request row or lead."""

    audit: DataFrame
    transfer: Transfer | None


def _decided(rows: DataFrame, run: Run) -> DataFrame:
    """Store the decision once before several tables change by it; a dry run stays lazy."""
    return cut_lineage(rows) if run.mode == EXECUTE else rows


def _apply(crm: Crm, moves: DataFrame, run: Run, **options) -> Transfer | None:
    if run.mode != EXECUTE:
        return None
    return transfer_leads(
        crm["lead"], crm["contact_mapping"], crm["contact_transfer_backup"], moves, run,
        **options)


def users_by(crm: Crm, key: Column, name: str, found: str, nth: int = 1,
             active_only: bool = True) -> DataFrame:
    """User id per key; among namesakes the ``nth`` smallest id."""
    users = crm["mst_user"].where("is_active") if active_only else crm["mst_user"]
    keyed = users.select(key.alias(name), F.col("user_id").alias(found)).where(
        F.col(name).isNotNull())
    return nth_by(keyed, [name], [F.col(found).asc()], nth)


def ids_by_name(dim: DataFrame, key: str, name: str) -> DataFrame:
    """Smallest id per lower-cased name of a master table."""
    return dim.groupBy(F.lower(F.trim("name")).alias(name)).agg(F.min(key).alias(key))


# --- by list ------------------------------------------------------------------------------


def resolve_list(crm: Crm, requests: DataFrame, run: Run, location: int | None = None):
    """Resolve contact, owners, status and substatus of a list file and collect every error.

    The lead is looked up only for rows without any other error.
    """
    text = {
        "email": F.trim(cleaning.filled("email_address")),
        "mobile": F.trim(cleaning.filled("mobile_number")),
        "old_name": F.trim(cleaning.filled("current_counselor")),
        "new_name": F.trim(cleaning.filled("move_to_owner")),
        "status_name": cleaning.canonical(cleaning.filled("status")),
        "substatus_name": cleaning.canonical(cleaning.filled("substatus")),
    }
    rows = lookup.fallback_lookup(
        requests.withColumns(text), crm["contact"], "contact_id",
        {"email": "email_address"}, {"mobile": "mobile_number"})
    full_name = F.col("full_name")
    rows = lookup.star(
        rows,
        (users_by(crm, full_name, "old_name", "old_rm_id"), "old_name"),
        (users_by(crm, full_name, "new_name", "new_rm_id"), "new_name"),
        (ids_by_name(crm["mst_status"], "status_id", "status_name"), "status_name"),
        (ids_by_name(crm["mst_substatus"], "substatus_id", "substatus_name"), "substatus_name"),
    )
    checked = all_failures(
        rows,
        [Check("contact_not_found", F.col("contact_id").isNull()),
         Check("old_rm_not_found", F.col("old_rm_id").isNull()),
         Check("new_rm_not_found", F.col("new_rm_id").isNull()),
         Check("status_not_found", F.col("status_id").isNull()),
         Check("substatus_not_found", F.col("substatus_id").isNull())],
    )
    pool = transferable(crm["lead"], run, below_status=6)
    if location is not None:
        at = crm["mst_user"].where(F.col("location_id") == location)
        pool = pool.join(at.select(F.col("user_id").alias("rm_id")), "rm_id", "left_semi")
    asked = lookup.keyed_fetch(pool.select("contact_id", "lead_id"), checked, "contact_id")
    newest = latest_by(asked, ["contact_id"], "lead_id")
    with_lead = checked.join(newest, "contact_id", "left")
    clean = F.size("errors") == 0
    missing = F.when(clean & F.col("lead_id").isNull(), F.array(F.lit("lead_not_found")))
    return with_lead.withColumns(
        {
            "errors": F.coalesce(missing, F.col("errors")),
            "lead_id": F.when(clean, F.col("lead_id")),
        }
    )


def transfer_by_list(
    crm: Crm, requests: DataFrame, run: Run, location: int | None = None
) -> TransferBatch:
    """Each valid row moves its contact's newest transferable lead to the named owner.

    If a file moves one lead twice, its last row counts and earlier rows say so.
    """
    rows = _decided(resolve_list(crm, requests, run, location), run)
    good = rows.where(F.size("errors") == 0)
    final = last_request(good, ["lead_id"], "row_id")
    kept = final.select("row_id", F.lit(True).alias("__kept"))
    moves = final.select("lead_id", "new_rm_id")
    transfer = _apply(crm, moves, run, follow_up=crm["follow_up"])
    marked = rows.join(kept, "row_id", "left").withColumn(
        "errors",
        F.when((F.size("errors") == 0) & F.col("__kept").isNull(),
               F.array(F.lit("superseded by a later row"))).otherwise(F.col("errors")),
    )
    return TransferBatch(_list_audit(marked, transfer), transfer)


def _list_audit(rows: DataFrame, transfer: Transfer | None) -> DataFrame:
    if transfer is not None:
        done = transfer.audit.select("lead_id", "new_mapping_id", "session_id")
        rows = rows.join(done, "lead_id", "left")
    good = F.size("errors") == 0
    outcome = "success" if transfer is not None else "validated"
    status = F.when(good, outcome).otherwise("failed")
    columns = ["row_id", "contact_name", "email_address", "mobile_number", "current_counselor",
               "status", "substatus", "move_to_owner", "contact_id", "lead_id", "old_rm_id",
               "new_rm_id", "status_id", "substatus_id", "new_mapping_id", "session_id",
               "remarks", "transfer_status"]
    return audit_frame(rows.withColumn("transfer_status", status), columns, "errors")


# --- by quota -----------------------------------------------------------------------------


def resolve_quota(crm: Crm, requests: DataFrame, nth: int = 1) -> DataFrame:
    """Old owner by name, new owner by e-mail, positive quota; every error is kept."""
    rows = requests.withColumns(
        {
            "owner_name": cleaning.canonical(cleaning.filled("full_name")),
            "owner_email": F.trim(cleaning.filled("transfer_to_email")),
            "quota": cleaning.positive_int("lead_count").cast("bigint"),
        }
    )
    rows = lookup.star(
        rows,
        (users_by(crm, cleaning.canonical("full_name"), "owner_name", "old_rm_id", nth,
                  active_only=False), "owner_name"),
        (users_by(crm, F.col("email_address"), "owner_email", "new_rm_id",
                  active_only=False), "owner_email"),
    )

    def quoted(label: str, column: str) -> Column:
        return F.concat(F.lit(f"{label}: '"), F.trim(cleaning.filled(column)), F.lit("'"))

    return all_failures(
        rows,
        [Check(quoted("old_rm_not_found", "full_name"), F.col("old_rm_id").isNull()),
         Check(quoted("new_rm_not_found_by_email", "transfer_to_email"),
               F.col("new_rm_id").isNull()),
         Check(quoted("invalid_lead_count", "lead_count"), F.col("quota").isNull())],
    )


def transfer_by_quota(
    crm: Crm,
    requests: DataFrame,
    run: Run,
    *,
    nth: int = 1,
) -> TransferBatch:
    """Each valid row takes the next leads of its old owner, in file order.

    The audit has one line per moved lead and one per row that moved none.
    """
    rows = _decided(resolve_quota(crm, requests, nth), run)
    valid = rows.where(F.size("errors") == 0)
    pool = transferable(crm["lead"], run, below_status=5, stale_days=None, products=(1, 2)).select(
        F.col("rm_id").alias("old_rm_id"), "lead_id", "contact_id", "status_id", "substatus_id")
    taken, ranges = allocate.quota_allocate(
        valid, pool, "old_rm_id", "quota", "row_id", "lead_id")
    names = rows.select("row_id", "full_name", "transfer_to_email", "new_rm_id")
    moved = _decided(taken.join(names, "row_id"), run)
    transfer = _apply(crm, moved.select("lead_id", "new_rm_id"), run, match="contact_id",
                      reuse_open=True)
    outcome = "success" if transfer is not None else "validated"
    lines = moved.withColumns({"transfer_status": F.lit(outcome), "remarks": F.lit("OK")})
    if transfer is not None:
        lines = lines.join(
            transfer.audit.select("lead_id", "new_mapping_id", "session_id"), "lead_id", "left")
    nothing = ranges.where(F.col("hi") <= F.col("lo")).withColumn(
        "errors",
        F.array(F.concat(F.lit("no_active_leads_found_or_exhausted for rm_id="),
                         F.col("old_rm_id").cast("string"))),
    )
    failed = rows.where(F.size("errors") > 0).unionByName(
        nothing.select(*rows.columns)).withColumn("transfer_status", F.lit("failed"))
    columns = ["row_id", *TRANSFER_AUDIT]
    audit = audit_frame(lines, columns).unionByName(audit_frame(failed, columns, "errors"))
    return TransferBatch(audit, transfer)


# --- by hierarchy -------------------------------------------------------------------------


def responsible_managers(crm: Crm, fallback: int) -> DataFrame:
    """First active sales person on the way up from every user."""
    users = crm["mst_user"].join(
        crm["mst_department"].select("department_id", "group_name"), "department_id", "left")
    sells = (
        F.col("is_active") & F.col("group_name").ilike("%sales%")
        & ~F.col("user_id").isin(list(SYSTEM_USERS))
    )
    return allocate.climb_hierarchy(users, "user_id", "reporting_manager_id", sells, fallback)


def transfer_by_hierarchy(
    crm: Crm, lead_ids: DataFrame, run: Run, centre_head: int
) -> TransferBatch:
    """Leads whose owner does not sell move up to the first manager who does."""
    managers = responsible_managers(crm, centre_head)
    leads = lookup.within(crm["lead"], lead_ids, ["lead_id"]).select("lead_id", "rm_id")
    judged = leads.join(
        managers.select(F.col("user_id").alias("rm_id"), "responsible"), "rm_id", "left"
    ).select(
        "lead_id", F.col("rm_id").alias("old_rm_id"),
        F.coalesce("responsible", F.lit(centre_head)).alias("new_rm_id"),
        (F.col("responsible") == F.col("rm_id")).alias("__stays"),
    )
    judged = _decided(judged, run)
    stays = F.coalesce("__stays", F.lit(False))
    moves = judged.where(~stays).select("lead_id", "new_rm_id")
    transfer = _apply(crm, moves, run, follow_up=crm["follow_up"], touch_lead=True)
    outcome = "success" if transfer is not None else "validated"
    audit = judged.select(
        "lead_id", "old_rm_id", "new_rm_id",
        F.when(stays, "valid owner, skipped").otherwise("OK").alias("remarks"),
        F.when(stays, "skipped").otherwise(outcome).alias("transfer_status"),
    )
    return TransferBatch(audit, transfer)


# --- by allocation table ------------------------------------------------------------------


def allocation_moves(crm: Crm, allocation: DataFrame) -> DataFrame:
    """Latest open lead of the allocation source per named customer, with the named owner.

    ``allocation``: ``customer_email``, ``counsellor_email``; keys are compared in canonical form.
    """
    asked = allocation.select(
        cleaning.canonical("customer_email").alias("email"), "customer_email",
        cleaning.canonical("counsellor_email").alias("owner_email"))
    contacts = crm["contact"].select(
        cleaning.canonical("email_address").alias("email"), "contact_id")
    owners = crm["mst_user"].select(
        cleaning.canonical("email_address").alias("owner_email"),
        F.col("user_id").alias("new_rm_id"))
    leads = crm["lead"].where(
        F.col("is_active") & (F.col("lead_source_id") == catalog.PULLBACK_SOURCE)
    ).select("lead_id", "contact_id", "created_at")
    rows = asked.join(contacts, "email").join(owners, "owner_email").join(leads, "contact_id")
    return nth_by(
        rows, ["contact_id"],
        [F.col("created_at").desc_nulls_first(), F.col("lead_id").desc(),
         F.col("new_rm_id").asc()],
    ).select("lead_id", "new_rm_id", "customer_email")


def transfer_by_round_robin(
    crm: Crm, run: Run, old_owners: list[int] | None, new_owners: list[int], limit: int | None,
) -> TransferBatch:
    """The first transferable leads, in id order, are dealt to the new owners in turn."""
    pool = transferable(
        crm["lead"], run, owners=old_owners, substatus=catalog.TRANSFERABLE,
    ).select("lead_id", F.col("rm_id").alias("old_rm_id"))
    moves = _decided(
        allocate.round_robin(pool, "lead_id", new_owners, "new_rm_id", limit), run)
    transfer = _apply(crm, moves.select("lead_id", "new_rm_id"), run,
                      follow_up=crm["follow_up"])
    outcome = "success" if transfer is not None else "validated"
    return TransferBatch(moves.withColumn("transfer_status", F.lit(outcome)), transfer)
