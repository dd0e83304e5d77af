"""Changes as table-to-table transforms: (current tables, requests, run) -> (new tables, audit).

Nothing is updated in place.  Each function returns the complete new version of every table it
touches, and the caller writes all of them to a new folder before publishing the run.  With
``Run(delta=True)`` it returns only the rows that are new or changed instead; :func:`merged` makes the
new version from them, or the caller's table format does.  New ids
are ``max(id) + 1 + position`` along a unique request id.  Requests are unique per target; use
:func:`last_request` first where a file may repeat one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.operators.pick import latest_by, nth_by, preferred_by
from tallyroute.operators.running import dense_index, running_by
from tallyroute.operators.unions import stack
from tallyroute.session import cut_lineage

SALES, SERVICE = "Sales", "Customer Service"
EXECUTE, DRY_RUN = "EXECUTE", "DRY_RUN"


@dataclass(frozen=True)
class Run:
    """Who changes what and when; ``mode`` DRY_RUN validates and audits only, ``delta`` returns
    new and changed rows instead of whole tables."""

    as_of: datetime
    actor: int = 1
    company: int = 1
    mode: str = EXECUTE
    delta: bool = False

    @property
    def now(self) -> Column:
        return F.lit(self.as_of).cast("timestamp_ntz")

    def stamps(self) -> dict[str, Column]:
        who = F.lit(self.actor).cast("bigint")
        return {"created_at": self.now, "created_by": who,
                "updated_at": self.now, "updated_by": who}


# --- generic steps ------------------------------------------------------------------------


def next_number(table: DataFrame, column: str) -> Column:
    """``max + 1`` as a scalar subquery; 1 for an empty table."""
    return F.coalesce(table.agg(F.max(column).cast("bigint")).scalar(), F.lit(0)) + 1


def with_new_ids(rows: DataFrame, table: DataFrame, id_column: str, along: str,
                 tie: Sequence[str] = ()) -> DataFrame:
    """Number new rows above the ids in use, in the order of a unique request id."""
    return (
        dense_index(rows, along, "__idx", tie)
        .withColumn(id_column, next_number(table, id_column) + F.col("__idx"))
        .drop("__idx")
    )


def update_rows(
    table: DataFrame,
    key: str | Sequence[str],
    updates: DataFrame,
    values: Mapping[str, Column],
    changed_only: bool = False,
) -> DataFrame:
    """Set columns on rows whose key occurs in ``updates`` (unique there).

    ``values`` may refer to columns of ``updates``; rows that do not match stay as they are, or are
    left out with ``changed_only``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    joined = table.join(updates.withColumn("__hit", F.lit(True)), keys,
                        "inner" if changed_only else "left")
    return joined.select(
        *[
            F.when(F.col("__hit"), values[name].cast(table.schema[name].dataType))
            .otherwise(F.col(name)).alias(name)
            if name in values
            else F.col(name)
            for name in table.columns
        ]
    )


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows, keeping the column list and types of the table; absent columns are NULL."""
    return table.unionByName(
        rows.select(
            *[
                (F.col(name) if name in rows.columns else F.lit(None))
                .cast(table.schema[name].dataType).alias(name)
                for name in table.columns
            ]
        )
    )


def kept_rows(table: DataFrame, run: Run) -> DataFrame:
    """The rows a table keeps in the result of a run: all, or none in a delta."""
    return table.limit(0) if run.delta else table


def merged(table: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """New version of a table from the new and changed rows of a run; see ``sources/versions.py`` for
    one that reads and writes the touched part of a table only."""
    return append_rows(table.join(delta.select(key), key, "left_anti"), delta)


def last_request(requests: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """When a file names a target twice, its last row counts."""
    return nth_by(requests, keys, [F.col(row_id).desc()])


def matched_update(
    table: DataFrame, requests: DataFrame, keys: Sequence[str], values: Sequence[str],
    delta: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Keyed update on the full key; returns the new table, or its changed rows with ``delta``, and
    each request with ``matched``."""
    renamed = requests.select(*keys, *[F.col(name).alias(f"__new_{name}") for name in values])
    new_table = update_rows(
        table, keys, renamed, {name: F.col(f"__new_{name}") for name in values},
        changed_only=delta,
    )
    present = table.select(*keys).join(renamed.select(*keys), list(keys), "left_semi").distinct().withColumn("matched", F.lit(True))
    audit = requests.join(present, list(keys), "left").withColumn(
        "matched", F.coalesce("matched", F.lit(False))
    )
    return new_table, audit


# --- ownership transfer -------------------------------------------------------------------


@dataclass(frozen=True)
class Transfer:
    lead: DataFrame
    contact_mapping: DataFrame
    follow_up: DataFrame | None
    backup: DataFrame
    audit: DataFrame


def closing_mappings(
    mapping: DataFrame,
    moves: DataFrame,
    kind: str,
    match: str,
) -> DataFrame:
    """Open mapping each move closes: (``move_id``, ``mapping_id``).

    A move by lead closes the latest open mapping of (lead, old owner).  Moves by contact may
    share a (contact, old owner): the k-th of them closes the k-th latest open mapping, as one
    move after the other would.
    """
    is_open = F.col("end_date").isNull() & (F.col("type") == kind)
    open_rows = mapping.where(is_open).select(match, F.col("rm_id").alias("old_rm_id"), "mapping_id")
    if match == "lead_id":
        return latest_by(
            open_rows.join(moves.select("move_id", match, "old_rm_id"), [match, "old_rm_id"]),
            ["move_id"], "mapping_id",
        ).select("move_id", "mapping_id")
    wanted = open_rows.join(
        moves.select(match, "old_rm_id").distinct(), [match, "old_rm_id"], "left_semi"
    ).withColumn("__down", -F.col("mapping_id"))
    ranked = running_by(
        wanted, [match, "old_rm_id"], ["__down"], number="k"
    ).select(match, "old_rm_id", "k", "mapping_id")
    turns = running_by(
        moves.select("move_id", match, "old_rm_id"), [match, "old_rm_id"], ["move_id"], number="k"
    )
    return turns.join(ranked, [match, "old_rm_id", "k"]).select("move_id", "mapping_id")


def _mapping_rows(moves: DataFrame, run: Run, kind: str) -> DataFrame:
    return moves.select(
        "move_id", "contact_id", "lead_id", F.col("new_rm_id").alias("rm_id"),
        F.lit(kind).alias("type"), F.lit(False).alias("is_transferred"),
        F.to_date(run.now).alias("from_date"), F.lit(run.company).alias("company_id"),
        *[column.alias(name) for name, column in run.stamps().items()],
    )


def _closed(mapping: DataFrame, closing: DataFrame, run: Run) -> DataFrame:
    return update_rows(
        mapping, "mapping_id", closing.select("mapping_id"),
        {"end_date": run.now, "is_transferred": F.lit(True), "updated_at": run.now,
         "updated_by": F.lit(run.actor)},
        changed_only=run.delta,
    )


def transfer_leads(
    lead: DataFrame,
    contact_mapping: DataFrame,
    backup: DataFrame,
    moves: DataFrame,
    run: Run,
    *,
    follow_up: DataFrame | None = None,
    match: str = "lead_id",
    reuse_open: bool = False,
    touch_lead: bool = False,
) -> Transfer:
    """Sales ownership transfer of whole leads.

    ``moves`` has one row (``lead_id``, ``new_rm_id``) per lead.  Closes the old open mapping,
    opens one for the new owner (or reuses one with ``reuse_open``), sets the lead's owner,
    completes the latest open follow-up and adds a new one if ``follow_up`` is given, and
    writes a backup row under the next session number.
    """
    # every table changes by these few rows: they are found once
    base = cut_lineage(lead.join(moves.select("lead_id", "new_rm_id"), "lead_id").select(
        F.col("lead_id").alias("move_id"), "lead_id", "contact_id",
        F.col("rm_id").alias("old_rm_id"), "new_rm_id", "status_id", "substatus_id",
    ))
    closing = closing_mappings(contact_mapping, base, SALES, match)
    closed = _closed(contact_mapping, closing, run)

    needed = base
    if reuse_open:
        still_open = contact_mapping.where(
            F.col("end_date").isNull() & (F.col("type") == SALES)
        ).join(closing.select("mapping_id"), "mapping_id", "left_anti")
        present = still_open.groupBy("contact_id", F.col("rm_id").alias("new_rm_id")).agg(
            F.max("mapping_id").alias("present_id")
        )
        base = base.join(present, ["contact_id", "new_rm_id"], "left")
        base = cut_lineage(base)
        needed = nth_by(
            base.where(F.col("present_id").isNull()), ["contact_id", "new_rm_id"],
            [F.col("lead_id").asc()],
        )
    opened = with_new_ids(
        _mapping_rows(needed, run, SALES), contact_mapping, "mapping_id", "move_id"
    )
    if reuse_open:
        fresh = opened.select(
            "contact_id", F.col("rm_id").alias("new_rm_id"), F.col("mapping_id").alias("fresh_id")
        )
        done = base.join(fresh, ["contact_id", "new_rm_id"], "left").withColumn(
            "new_mapping_id", F.coalesce("present_id", "fresh_id")
        )
    else:
        done = base.join(
            opened.select("move_id", F.col("mapping_id").alias("new_mapping_id")), "move_id"
        )

    owner = {"rm_id": F.col("new_rm_id")}
    if touch_lead:
        owner["updated_at"] = run.now
    new_lead = update_rows(
        lead, "lead_id", moves.select("lead_id", "new_rm_id"), owner, changed_only=run.delta)
    audit = done.withColumn("session_id", next_number(backup, "session_id")).select(
        "lead_id", "contact_id", "old_rm_id", "new_rm_id", "status_id", "substatus_id",
        "new_mapping_id", "session_id",
    )
    new_backup = append_rows(
        kept_rows(backup, run),
        audit.withColumnsRenamed({"new_rm_id": "rm_id", "new_mapping_id": "mapping_id"})
        .withColumn("created_at", run.now),
    )
    new_follow_up = None
    if follow_up is not None:
        new_follow_up = hand_over_follow_up(follow_up, base, run)
    return Transfer(new_lead, append_rows(closed, opened), new_follow_up, new_backup, audit)


def hand_over_follow_up(follow_up: DataFrame, moves: DataFrame, run: Run) -> DataFrame:
    """Complete the old owner's latest open follow-up and add an open one for the new owner."""
    open_rows = follow_up.where(~F.col("is_completed")).select(
        "lead_id", F.col("rm_id").alias("old_rm_id"), "follow_up_id"
    )
    latest = latest_by(
        open_rows.join(moves.select("lead_id", "old_rm_id"), ["lead_id", "old_rm_id"]),
        ["lead_id"], "follow_up_id",
    )
    finished = update_rows(
        follow_up, "follow_up_id", latest.select("follow_up_id"),
        {"is_completed": F.lit(True), "completed_on": run.now, "updated_at": run.now},
        changed_only=run.delta,
    )
    added = with_new_ids(
        moves.select(
            "move_id", "lead_id", "contact_id", F.col("new_rm_id").alias("rm_id"), "status_id",
            "substatus_id", F.lit(1).alias("activity_type_id"), run.now.alias("follow_up"),
            F.lit(False).alias("is_completed"), F.lit(run.company).alias("company_id"),
            *[column.alias(name) for name, column in run.stamps().items()],
        ),
        follow_up, "follow_up_id", "move_id",
    )
    return append_rows(finished, added)


def transferable(
    lead: DataFrame,
    run: Run,
    *,
    owners: Sequence[int] | None = None,
    substatus: Sequence[int] | None = None,
    excluded_plan: int = 23,
    below_status: int = 5,
    stale_substatus: Sequence[int] = (10, 11),
    stale_days: int | None = 61,
    products: Sequence[int] | None = None,
) -> DataFrame:
    """Leads that may change hands; a stale unreachable lead stays where it is."""
    kept = lead.where(
        F.col("is_active")
        & ~F.array_contains("sub_product_ids", excluded_plan)
        & (F.col("status_id") < below_status)
    )
    if owners is not None:
        kept = kept.where(F.col("rm_id").isin(list(owners)))
    if products is not None:
        kept = kept.where(F.col("product_id").isin(list(products)))
    if substatus is not None:
        kept = kept.where(F.col("substatus_id").isin(list(substatus)))
    if stale_days is not None:
        edge = run.now - F.make_dt_interval(F.lit(stale_days))
        kept = kept.where(
            ~(
                F.col("substatus_id").isin(list(stale_substatus))
                & (F.coalesce("updated_at", "created_at") <= edge)
            )
        )
    return kept


# --- customer service ---------------------------------------------------------------------


@dataclass(frozen=True)
class ServiceTransfer:
    contact_mapping: DataFrame
    feedback: DataFrame
    follow_up: DataFrame


def transfer_service(
    contact_mapping: DataFrame,
    feedback: DataFrame,
    follow_up: DataFrame,
    moves: DataFrame,
    run: Run,
    *,
    prefer_old_owner: bool = False,
    activity_type: int = 6,
) -> ServiceTransfer:
    """Hand a customer over to a new service owner.

    ``moves``: unique (``contact_id``, ``lead_id``) with ``old_rm_id`` (may be NULL) and
    ``new_rm_id``.  Mappings change per row; the latest feedback and the latest follow-up
    change once per contact, the follow-up being completed and copied to an open one.
    """
    moves = cut_lineage(moves.withColumn("move_id", F.col("lead_id")))
    closing = closing_mappings(contact_mapping, moves, SERVICE, "contact_id")
    opened = with_new_ids(
        _mapping_rows(moves, run, SERVICE), contact_mapping, "mapping_id", "move_id"
    )
    mapping = append_rows(_closed(contact_mapping, closing, run), opened)

    per_contact = latest_by(moves, ["contact_id"], "move_id").select(
        "contact_id", "old_rm_id", "new_rm_id"
    )
    candidates = feedback.join(per_contact, "contact_id")
    if prefer_old_owner:
        picked = preferred_by(
            candidates, ["contact_id"], F.col("assigned_to").eqNullSafe(F.col("old_rm_id")),
            "feedback_response_id",
        )
    else:
        picked = latest_by(candidates, ["contact_id"], "feedback_response_id")
    new_feedback = update_rows(
        feedback, "feedback_response_id", picked.select("feedback_response_id", "new_rm_id"),
        {"assigned_to": F.col("new_rm_id"), "updated_at": run.now},
        changed_only=run.delta,
    )
    return ServiceTransfer(
        mapping, new_feedback,
        copy_latest_follow_up(follow_up, per_contact, run, activity_type, prefer_old_owner),
    )


def copy_latest_follow_up(
    follow_up: DataFrame, per_contact: DataFrame, run: Run, activity_type: int = 6,
    of_old_owner: bool = False,
) -> DataFrame:
    """Complete the latest follow-up per contact and reopen a copy of the latest one.

    With ``of_old_owner`` only a follow-up of the old owner is completed; the copy is taken
    from the contact's latest row in either case.
    """
    candidates = follow_up.join(per_contact, "contact_id")
    latest = latest_by(candidates, ["contact_id"], "follow_up_id")
    done = latest
    if of_old_owner:
        done = latest_by(
            candidates.where(F.col("rm_id") == F.col("old_rm_id")), ["contact_id"],
            "follow_up_id",
        )
    finished = update_rows(
        follow_up, "follow_up_id", done.select("follow_up_id"),
        {"is_completed": F.lit(True), "completed_on": run.now, "updated_at": run.now},
        changed_only=run.delta,
    )
    copies = latest.withColumns(
        {
            "rm_id": F.col("new_rm_id"),
            "activity_type_id": F.lit(activity_type),
            "follow_up": run.now,
            "is_completed": F.lit(False),
            "completed_on": F.lit(None),
            **run.stamps(),
        }
    ).drop("follow_up_id", "old_rm_id", "new_rm_id")
    return append_rows(
        finished, with_new_ids(copies, follow_up, "follow_up_id", "contact_id")
    )


def reassign_by_copy(
    contact_mapping: DataFrame,
    feedback: DataFrame,
    follow_up: DataFrame,
    moves: DataFrame,
    run: Run,
    substatus: int = 29,
) -> ServiceTransfer:
    """Per lead (``lead_id``, ``new_rm_id``): copy whole rows and reopen the copies.

    Latest unfinished feedback gets the new owner; the latest open follow-up of the given
    substatus is completed and its copy reopened, a lead without one gets a new follow-up; the
    open service mapping is closed and the newest closed one is copied and reopened.
    """
    newest_feedback = latest_by(
        feedback.join(moves, "lead_id"), ["lead_id"], "feedback_response_id"
    )
    handled = newest_feedback.select("lead_id", "contact_id", "new_rm_id")
    new_feedback = update_rows(
        feedback, "feedback_response_id",
        newest_feedback.where(F.col("completed_on").isNull())
        .select("feedback_response_id", "new_rm_id"),
        {"assigned_to": F.col("new_rm_id"), "updated_at": run.now,
         "updated_by": F.lit(run.actor)},
        changed_only=run.delta,
    )

    owners = handled.select("lead_id", "new_rm_id")
    latest = latest_by(
        follow_up.where(~F.col("is_completed") & (F.col("substatus_id") == substatus))
        .join(owners, "lead_id"),
        ["lead_id"], "follow_up_id",
    )
    finished = update_rows(
        follow_up, "follow_up_id", latest.select("follow_up_id"),
        {"is_completed": F.lit(True), "completed_on": run.now, "updated_at": run.now,
         "updated_by": F.lit(run.actor)},
        changed_only=run.delta,
    )
    copies = latest.withColumns(
        {"rm_id": F.col("new_rm_id"), "is_completed": F.lit(False), "completed_on": F.lit(None)}
    ).drop("follow_up_id", "new_rm_id")
    created = handled.join(latest.select("lead_id"), "lead_id", "left_anti").select(
        "lead_id", "contact_id", F.col("new_rm_id").alias("rm_id"),
        F.lit(6).alias("activity_type_id"), F.lit(6).alias("status_id"),
        F.lit(substatus).alias("substatus_id"), run.now.alias("follow_up"),
        F.lit(False).alias("is_completed"), F.lit(run.company).alias("company_id"),
        *[column.alias(name) for name, column in run.stamps().items()],
    )
    new_follow_up = append_rows(
        finished, with_new_ids(stack(copies, created), follow_up, "follow_up_id", "lead_id")
    )

    service = contact_mapping.where(F.col("type") == SERVICE).join(owners, "lead_id")
    closing = latest_by(service.where(F.col("end_date").isNull()), ["lead_id"], "mapping_id")
    closed = _closed(contact_mapping, closing, run)
    source = latest_by(
        stack(service.where(F.col("end_date").isNotNull()), closing), ["lead_id"], "mapping_id"
    )
    reopened = source.withColumns(
        {"rm_id": F.col("new_rm_id"), "end_date": F.lit(None), "is_transferred": F.lit(False)}
    ).drop("mapping_id", "new_rm_id")
    return ServiceTransfer(
        append_rows(closed, with_new_ids(reopened, contact_mapping, "mapping_id", "lead_id")),
        new_feedback, new_follow_up,
    )


def upsert_feedback(
    feedback: DataFrame, requests: DataFrame, run: Run
) -> tuple[DataFrame, DataFrame]:
    """Reassign the latest feedback per contact, or create one; returns (table, ids per contact).

    ``requests``: unique ``contact_id`` with ``lead_id`` and ``rm_id``.
    """
    wanted = requests.select("contact_id", "lead_id", F.col("rm_id").alias("new_rm_id"))
    latest = latest_by(
        feedback.select("contact_id", "feedback_response_id")
        .join(wanted.drop("lead_id"), "contact_id"),
        ["contact_id"], "feedback_response_id",
    )
    updated = update_rows(
        feedback, "feedback_response_id", latest.drop("contact_id"),
        {"assigned_to": F.col("new_rm_id"), "updated_at": run.now,
         "updated_by": F.lit(run.actor)},
        changed_only=run.delta,
    )
    created = with_new_ids(
        wanted.join(latest, "contact_id", "left_anti").select(
            "contact_id", "lead_id", F.col("new_rm_id").alias("assigned_to"),
            F.lit(run.company).alias("company_id"), run.now.alias("feedback_for_date"),
            *[column.alias(name) for name, column in run.stamps().items()],
        ),
        feedback, "feedback_response_id", "contact_id",
    )
    ids = stack(
        latest.select("contact_id", "feedback_response_id", F.lit("updated").alias("action")),
        created.select("contact_id", "feedback_response_id", F.lit("inserted").alias("action")),
    )
    return append_rows(updated, created), ids


# --- creation, restore, reassignment ------------------------------------------------------


@dataclass(frozen=True)
class Created:
    lead: DataFrame
    follow_up: DataFrame
    contact_mapping: DataFrame
    ids: DataFrame


def create_leads(
    lead: DataFrame,
    follow_up: DataFrame,
    contact_mapping: DataFrame,
    requests: DataFrame,
    run: Run,
    *,
    source: int = 57,
    status: int = 1,
    substatus: int = 2,
) -> Created:
    """One lead, follow-up and sales mapping per valid request row.

    An active lead of the same contact that still waits in the same source and status is
    deactivated, also when an earlier row of the same file created it.

    ``requests``: unique ``row_id`` with ``contact_id``, ``rm_id``,
    ``lead_number``, ``product_id``, ``sub_product_id``.  ``ids`` gives the new ids per row.
    """
    stamps = [column.alias(name) for name, column in run.stamps().items()]
    contacts = requests.select("contact_id").distinct().withColumn("__again", F.lit(True))
    waiting = (
        (F.col("lead_source_id") == source) & (F.col("status_id") == status)
        & (F.col("substatus_id") == substatus)
    )
    known = lead.join(contacts, "contact_id", "left")
    if run.delta:
        known = known.where(F.col("__again") & waiting & F.col("is_active"))
    retired = known.select(
        *[
            F.when(F.col("__again") & waiting, F.lit(False)).otherwise(F.col(name)).alias(name)
            if name == "is_active" else F.col(name)
            for name in lead.columns
        ]
    )
    last = latest_by(requests.select("contact_id", "row_id"), ["contact_id"], "row_id")
    marked = requests.join(
        last.select("row_id", F.lit(True).alias("__last")), "row_id", "left"
    ).withColumn("__last", F.coalesce("__last", F.lit(False)))
    leads = with_new_ids(marked, lead, "lead_id", "row_id")
    state = [F.lit(status).alias("status_id"), F.lit(substatus).alias("substatus_id")]
    company = F.lit(run.company).alias("company_id")
    new_lead = leads.select(
        "lead_id", "lead_number", "contact_id", "rm_id", "product_id",
        F.lit(source).alias("lead_source_id"), F.array("sub_product_id").alias("sub_product_ids"),
        F.col("__last").alias("is_active"), company, *state, *stamps,
    )
    tasks = with_new_ids(
        leads.select("row_id", "lead_id", "contact_id", "rm_id", company, *state,
                     run.now.alias("follow_up"), F.lit(False).alias("is_completed"), *stamps),
        follow_up, "follow_up_id", "row_id",
    )
    owners = with_new_ids(
        leads.select("row_id", "contact_id", "lead_id", "rm_id", F.lit(SALES).alias("type"),
                     F.lit(False).alias("is_transferred"),
                     F.to_date(run.now).alias("from_date"), company, *stamps),
        contact_mapping, "mapping_id", "row_id",
    )
    ids = (
        leads.select("row_id", "lead_id", "rm_id")
        .join(tasks.select("row_id", "follow_up_id"), "row_id")
        .join(owners.select("row_id", "mapping_id"), "row_id")
    )
    return Created(
        append_rows(retired, new_lead), append_rows(kept_rows(follow_up, run), tasks),
        append_rows(kept_rows(contact_mapping, run), owners), ids,
    )


def corrupted_mappings(
    contact_mapping: DataFrame, backup: DataFrame, start: datetime, end: datetime
) -> DataFrame:
    """Mappings closed in a time span although no transfer closed them.

    Only leads with more than one mapping closed in the span count.
    """
    in_span = F.col("updated_at").between(
        F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    )
    touched = contact_mapping.where(in_span)
    closed = touched.where(F.col("end_date").isNotNull())
    several = closed.groupBy("lead_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    legitimate = backup.select("lead_id", F.col("old_rm_id").alias("rm_id")).distinct()
    return (
        closed.join(several, "lead_id", "left_semi")
        .join(legitimate, ["lead_id", "rm_id"], "left_anti")
        .select("mapping_id", "lead_id")
    )


def restore_mappings(
    contact_mapping: DataFrame,
    mapping_log: DataFrame,
    lead: DataFrame,
    broken: DataFrame,
    cutoff: datetime,
    delta: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bring broken mappings back to their last log entry before ``cutoff``.

    The lead then follows its open mapping; where none is open, the restored mapping with the
    highest id is reopened and gives the owner.  Returns (mapping, lead, audit); with ``delta`` only
    the changed rows of the two tables.
    """
    columns = ["rm_id", "end_date", "is_transferred", "updated_at", "updated_by"]
    edge = F.lit(cutoff).cast("timestamp_ntz")
    entry = latest_by(
        mapping_log.join(broken.select("mapping_id"), "mapping_id", "left_semi")
        .where(F.col("log_timestamp") < edge),
        ["mapping_id"], "log_timestamp", "log_id",
    ).select("mapping_id", *[F.col(name).alias(f"__old_{name}") for name in columns])
    before = {name: F.col(f"__old_{name}") for name in columns}
    restored = update_rows(contact_mapping, "mapping_id", entry, before, changed_only=delta)
    leads = broken.join(entry, "mapping_id").select("lead_id", "mapping_id")
    of_leads = contact_mapping.join(leads.select("lead_id").distinct(), "lead_id", "left_semi")
    state = update_rows(of_leads, "mapping_id", entry, before)
    open_now = latest_by(
        state.where(F.col("end_date").isNull()), ["lead_id"], "mapping_id"
    ).select("lead_id", F.col("rm_id").alias("__open_rm"))
    reopen = (
        latest_by(leads, ["lead_id"], "mapping_id")
        .join(open_now, "lead_id", "left_anti")
        .join(entry.select("mapping_id", F.col("__old_rm_id").alias("__open_rm")), "mapping_id")
    )
    mapping = update_rows(
        restored, "mapping_id", reopen.select("mapping_id"), {"end_date": F.lit(None)}
    )
    new_lead = update_rows(
        lead, "lead_id", stack(open_now, reopen.select("lead_id", "__open_rm")),
        {"rm_id": F.col("__open_rm")}, changed_only=delta,
    )
    audit = broken.join(entry.select("mapping_id", "__old_rm_id"), "mapping_id", "left").join(
        reopen.select("mapping_id", F.lit(True).alias("__reopened")), "mapping_id", "left"
    ).select(
        "mapping_id", "lead_id", F.col("__old_rm_id").alias("restored_rm_id"),
        F.when(F.col("__old_rm_id").isNull(), "skipped")
        .when(F.col("__reopened"), "reopened").otherwise("restored").alias("outcome"),
    )
    return mapping, new_lead, audit


def reassign_collections(
    follow_up: DataFrame,
    collection: DataFrame,
    requests: DataFrame,
    run: Run,
    *,
    status: int = 7,
    substatus: int = 43,
    department: int = 20,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Move a collection case when both its follow-up and its collection row exist.

    ``requests``: unique (``lead_id``, ``old_rm_id``, ``new_rm_id``).  Returns (follow_up,
    collection, audit); the audit gives the reason of every request left alone.
    """
    pair = ["lead_id", "old_rm_id"]
    keys = requests.select(*pair).distinct()
    task = latest_by(
        follow_up.select("lead_id", F.col("rm_id").alias("old_rm_id"), "follow_up_id")
        .join(keys, pair, "left_semi"),
        pair, "follow_up_id",
    )
    case = latest_by(
        collection.where((F.col("status_id") == status) & (F.col("substatus_id") == substatus))
        .select("lead_id", F.col("assigned_to").alias("old_rm_id"), "payment_collection_id")
        .join(keys, pair, "left_semi"),
        pair, "payment_collection_id",
    )
    done = "updated successfully" if run.mode == EXECUTE else "ready (dry run)"
    audit = (
        requests.join(task, pair, "left").join(case, pair, "left")
        .withColumn(
            "status",
            F.when(F.col("follow_up_id").isNull(), "follow_up not available")
            .when(F.col("payment_collection_id").isNull(),
                  "payment_collection not available OR rm mismatch")
            .otherwise(done),
        )
    )
    if run.mode != EXECUTE:
        return follow_up, collection, audit
    ready = audit.where(F.col("status") == done)
    new_follow_up = update_rows(
        follow_up, "follow_up_id", ready.select("follow_up_id", "new_rm_id"),
        {"rm_id": F.col("new_rm_id"), "is_completed": F.lit(False),
         "completed_on": F.lit(None)},
        changed_only=run.delta,
    )
    new_collection = update_rows(
        collection, "payment_collection_id", ready.select("payment_collection_id", "new_rm_id"),
        {"assigned_to": F.col("new_rm_id"), "department_id": F.lit(department)},
        changed_only=run.delta,
    )
    return new_follow_up, new_collection, audit


def mark_processed(requests: DataFrame, done: DataFrame, key: str, mark: str = "record_insert"):
    """Set the mark on request rows whose key was processed."""
    hits = done.select(key).distinct().withColumn("__done", F.lit(True))
    kept = F.col(mark) if mark in requests.columns else F.lit(None).cast("int")
    return requests.join(hits, key, "left").select(
        *[name for name in requests.columns if name != mark],
        F.when(F.col("__done"), F.lit(1)).otherwise(kept).alias(mark),
    )


def write_back(
    rows: DataFrame, results: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Bring grouped results back to every input row; rows without a result keep their values."""
    renamed = results.select(
        key, F.lit(True).alias("__hit"), *[F.col(name).alias(f"__r_{name}") for name in columns]
    )
    joined = rows.join(renamed, key, "left")
    out = [F.col(name) for name in rows.columns if name not in columns]
    for name in columns:
        old = F.col(name) if name in rows.columns else F.lit(None)
        out.append(F.when(F.col("__hit"), F.col(f"__r_{name}")).otherwise(old).alias(name))
    return joined.select(*out)
