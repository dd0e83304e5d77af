"""Productivity report: calls, funnel, logins, targets, lead quality, loss reasons."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import catalog, cleaning, dates, durations, idlists, payload
from tallyroute.operators import lookup, measures, unions
from tallyroute.operators.pick import any_by, earliest_by, latest_by
from tallyroute.plans.payments import Crm, managers, named, people
from tallyroute.plans.shared import Codes, Need, ReadOnce
from tallyroute.session import stored

# --- what every branch shows of owner and lead ----------------------------------------------


def known_owners(directory: DataFrame) -> DataFrame:
    return directory.select(
        F.col("rm_id").alias("counsellor_id"), F.col("rm_name").alias("known_counsellor"),
        F.col("rm_center").alias("known_location"), F.col("owner_product").alias("user_product"),
        F.col("manager_name").alias("known_captain"))


def lead_contacts(crm: Crm) -> DataFrame:
    return crm["lead"].select("lead_id", F.col("contact_id").alias("lead_contact_id")).join(
        named(crm["contact"], "contact_id", "lead_contact_id", contact_name="full_name"),
        "lead_contact_id", "left")


@dataclass(frozen=True)
class More:
    """Columns of owners and of leads that a branch joins while its rows are narrow and lie by
    that key anyway; :func:`filled` uses them."""

    owners: DataFrame | None = None
    contacts: DataFrame | None = None

    @property
    def columns(self) -> list[str]:
        return [name for df, key in ((self.owners, "counsellor_id"), (self.contacts, "lead_id"))
                if df is not None for name in df.columns if name != key]

    def of_owner(self, rows: DataFrame, key: str = "counsellor_id") -> DataFrame:
        if self.owners is None:
            return rows
        return rows.join(self.owners.withColumnRenamed("counsellor_id", key), key, "left")

    def of_people(self, users: DataFrame, prefix: str) -> DataFrame:
        """Owners of :func:`people`; what they name themselves is not held a second time."""
        if self.owners is None:
            return users
        both = self.of_owner(users, f"{prefix}_user")
        return both.withColumns({
            known: F.when(F.col(f"{prefix}_{own}").isNull(), F.col(known))
            for known, own in (("known_counsellor", "name"), ("known_location", "center"))})

    def of_lead(self, rows: DataFrame) -> DataFrame:
        return rows if self.contacts is None else rows.join(self.contacts, "lead_id", "left")


def filled(rows: DataFrame) -> DataFrame:
    """Owner, centre, contact and name, where the branch has none, from the columns of
    :class:`More`."""
    spare = {"captain_counsellor": "known_captain", "counsellor": "known_counsellor",
             "location": "known_location"}
    if "lead_contact_id" in rows.columns:
        spare |= {"contact_id": "lead_contact_id", "lead_name": "contact_name"}
    own = set(rows.columns)
    values = {
        name: F.coalesce(*([F.col(name)] if name in own else []), F.col(other))
        for name, other in spare.items()
    }
    values |= {name: dates.parse_stamp(name) for name in ("login_time", "logout_time")
               if name in own}
    keys = [name for name in ("lead_id", "counsellor_id") if name in own]
    return rows.select(*keys, *[name for name in rows.columns if name not in keys]).withColumns(
        values).drop(*spare.values())


# --- calls --------------------------------------------------------------------------------


def call_rows(crm: Crm) -> DataFrame:
    """Dialler calls and noted activities of active users, one row per call or comment."""
    users = lookup.star(
        crm["mst_user"].where("is_active").select(
            F.col("user_id").alias("counsellor_id"), F.col("full_name").alias("counsellor"),
            "location_id", "department_id")
        .join(crm["mst_department"].select("department_id", "group_name", "short_name"),
              "department_id"),
        (named(crm["mst_location"], "location_id", "location_id", location="name"),
         "location_id"),
    ).drop("location_id", "department_id")
    calls = crm["call_log"].where(F.col("lead_id").isNotNull()).select(
        F.col("created_by").alias("counsellor_id"), "lead_id", "created_at",
        F.lit(None).cast("double").alias("call_duration"), F.lit(0).alias("activity_type"),
        F.lit(None).cast("string").alias("note"),
        F.coalesce(cleaning.half_even_int("call_duration"), F.lit(0)).cast("bigint")
        .alias("seconds"),
        F.expr(catalog.unanswered_call_text("call_duration", "status_details", "call_status"))
        .alias("activity_count_flag"),
    )
    comments = named(crm["mst_comment"], "comment_id", "comment_id", note="name").where(
        F.col("comment_id").isin(list(catalog.NOTE_COMMENTS))
    )
    wanted = F.array(*[F.lit(c) for c in catalog.NOTE_COMMENTS])
    members = F.array_intersect(F.col("comment_ids").cast("array<int>"), wanted)
    notes = (
        crm["activity"].where(F.col("lead_id").isNotNull())
        .withColumn("comment_id", F.explode(members))
        .join(comments, "comment_id")
        .select(
            F.col("created_by").alias("counsellor_id"), "lead_id", "created_at", "call_duration",
            F.col("activity_type_id").cast("int").alias("activity_type"), "note",
            F.coalesce(cleaning.half_even_int("call_duration"), F.lit(0)).cast("bigint")
            .alias("seconds"),
            F.lit(1).alias("activity_count_flag"),
        )
    )
    return unions.stack(calls, notes).join(users, "counsellor_id")


def call_conditions() -> dict[str, str]:
    long_call = catalog.LONG_CALL_SECONDS
    found = {
        "called": "activity_type = 0 AND seconds = 0",
        "phone_conversation": f"activity_type = 0 AND seconds > 0 AND seconds < {long_call}",
        "detailed_conversation": f"activity_type = 0 AND seconds >= {long_call}",
    }
    for prefix, kind in (("notes", catalog.NOTE_ACTIVITY), ("call", catalog.CALL_ACTIVITY)):
        for name, text in catalog.NOTE_KINDS.items():
            found[f"{prefix}_{name}"] = f"activity_type = {kind} AND note = '{text}'"
    return found


def sales_calling(
    crm: Crm, one_feedback_per_lead: bool = False, more: More = More()
) -> DataFrame:
    """Twelve call measures per (owner, lead, moment), with the feedback completion time."""
    measured = call_conditions()
    grain = ["counsellor", "counsellor_id", "location", "lead_id", "call_duration",
             "created_at", "group_name", "short_name", "activity_count_flag"]
    counted = call_rows(crm).groupBy(*grain).agg(
        *measures.counts_where(measured),
        F.sum(F.when(F.col("activity_type") == 0, F.col("seconds")).otherwise(0))
        .alias("talk_seconds"),
    )
    feedback = crm["feedback_response"].where(
        (F.col("type") == "FEEDBACK") & F.col("assigned_to").isNotNull()
    )
    if one_feedback_per_lead:
        feedback = any_by(feedback, ["lead_id"], "feedback_response_id")
    total: Column = F.lit(0).cast("bigint")
    for name in measured:
        total = total + F.col(name)
    # the groups lie by owner
    return more.of_lead(more.of_owner(counted).join(
        feedback.select(F.col("assigned_to").alias("counsellor_id"), "lead_id", "completed_on"),
        ["counsellor_id", "lead_id"], "left",
    )).select(
        "lead_id", F.col("created_at").alias("report_date"),
        F.col("created_at").alias("refresh_date"), "counsellor", "counsellor_id", "location",
        "call_duration", *measured, durations.clock_text("talk_seconds").alias("talktime"),
        "group_name", "short_name",
        F.when(F.col("call_duration") >= catalog.LONG_CALL_SECONDS, 1).otherwise(0)
        .alias("detailed_conversation_flag"),
        total.alias("total_calls"), "activity_count_flag", "completed_on", *more.columns,
    )


# --- funnel parts -------------------------------------------------------------------------


def follow_up_states(crm: Crm, as_of) -> DataFrame:
    """State of each lead's latest follow-up."""
    latest = latest_by(
        crm["follow_up"].select("lead_id", "follow_up", "follow_up_id", "is_completed"),
        ["lead_id"], "follow_up", "follow_up_id",
    )
    overdue = ~F.col("is_completed") & dates.in_range("follow_up", end=dates.as_datetime(as_of))
    return latest.select(
        "lead_id", F.lit(1).alias("follow_ups"),
        F.when(F.col("is_completed"), "completed").when(overdue, "overdue")
        .alias("follow_up_status"),
    )


def contact_attempts(other_channels: bool = False) -> Column:
    """What counts as touching a lead; ``other_channels`` adds messages and mails."""
    kind = F.col("activity_type_id")
    outbound = (
        (kind == 1) & (F.lower("origin") == "outbound") & (F.col("call_duration") > 0)
    )
    if not other_channels:
        return outbound | (kind == 7)
    sent = payload.field("meta_info", "$.status").isin("Pending", "Sent")
    outgoing = payload.any_item("meta_info", "$.msgs", "category", "Outgoing")
    return outbound | (kind == 4) | ((kind == 2) & outgoing) | ((kind == 3) & sent)


def untouched_leads(crm: Crm, as_of, days: int = 30, other_channels: bool = False) -> DataFrame:
    """Active leads of active contacts whose last contact attempt lies ``days`` back."""
    last = (
        crm["activity"].where(contact_attempts(other_channels))
        .groupBy("lead_id").agg(F.max("created_at").alias("last_attempt"))
        .where(dates.older_than_days("last_attempt", as_of, days))
    )
    owned = open_sales_mappings(crm).select("contact_id", "rm_id")
    return (
        crm["lead"].where("is_active").select("lead_id", "contact_id", "rm_id")
        .join(last, "lead_id")
        .join(crm["contact"].where("is_active").select("contact_id"), "contact_id", "left_semi")
        .join(owned, ["contact_id", "rm_id"], "left_semi")
        .select("lead_id", F.col("contact_id").alias("untouched_contact_id"),
                F.lit(1).alias("untouched_flag"))
    )


def open_sales_mappings(crm: Crm) -> DataFrame:
    """(contact, owner) pairs with their number of open sales mappings."""
    return (
        crm["contact_mapping"]
        .where(F.col("end_date").isNull() & (F.col("type") == "Sales"))
        .groupBy("contact_id", "rm_id").agg(F.count(F.lit(1)).alias("mappings"))
    )


def repeat_dates(crm: Crm) -> DataFrame:
    repeats = crm["status_log"].where(F.col("substatus_id") == catalog.REPEAT_SUBSTATUS)
    return latest_by(repeats.select("lead_id", "created_at", "status_log_id"), ["lead_id"],
                     "status_log_id").select("lead_id", F.col("created_at")
                                             .alias("repeat_lead_date"))


def converted_leads(crm: Crm) -> DataFrame:
    """Earliest payment per lead among online and pending offline payments."""
    columns = ["payment_id", "offline_payment_id", "sub_product_id", "lead_id", "payment_type",
               "payment_date"]
    online = crm["payment"].select(
        "*", F.lit(0).cast("bigint").alias("offline_payment_id"),
        F.lit("online").alias("payment_type")).select(*columns)
    pending = crm["offline_payment"].where(F.col("status") == "Pending").drop("payment_id").select(
        "*", F.lit(0).cast("bigint").alias("payment_id"),
        F.lit("offline-pending").alias("payment_type")).select(*columns)
    first = earliest_by(
        unions.distinct_stack(online, pending), ["lead_id"], "payment_date", "payment_id",
        "offline_payment_id",
    )
    return first.join(
        named(crm["mst_subproduct"], "sub_product_id", "sub_product_id", product_name="name"),
        "sub_product_id", "left",
    ).select("lead_id", "payment_date", "product_name")


APPOINTMENT_LINKS = ("utm_medium", "utm_source", "utm_campaign", "utm_content", "page_url")


def appointments(crm: Crm, as_of) -> DataFrame:
    """Latest appointment booked over chat per contact, with the story of its lead.

    The booking is picked first, so every history below is reduced to the leads in question
    before its own per-lead pick.
    """
    booked = crm["follow_up"].where(
        (F.col("source") == "whatsapp") & (F.col("source_info") != "{}")
    )
    latest = latest_by(booked, ["contact_id"], "created_at", "follow_up_id")
    last_lead = latest_by(
        crm["lead"].join(latest.select("contact_id"), "contact_id", "left_semi")
        .select("contact_id", F.col("lead_id").alias("shown_lead_id"),
                F.col("substatus_id").alias("lead_substatus_id")),
        ["contact_id"], "shown_lead_id",
    )
    # few and narrow: looked up in a hash table, so that a task need not hold two sorts per history
    keys = latest.select("lead_id").where(F.col("lead_id").isNotNull()).hint("shuffle_hash")

    def of_interest(table: str) -> DataFrame:
        return crm[table].join(keys, "lead_id", "left_semi")

    first_log = earliest_by(of_interest("lead_log"), ["lead_id"], "log_id").select(
        "lead_id", F.col("created_at").alias("lead_created_date"),
        *[F.col(c).alias(f"initial_{c}") for c in APPOINTMENT_LINKS])
    repeat_log = latest_by(
        of_interest("lead_log").where(F.col("substatus_id") == catalog.REPEAT_SUBSTATUS),
        ["lead_id"], "log_id",
    ).select("lead_id", F.col("updated_at").alias("repeat_lead_created_date"),
             *[F.col(c).alias(f"repeat_{c}") for c in APPOINTMENT_LINKS])
    paid = of_interest("sales_flat_data").groupBy("lead_id").agg(
        F.min("payment_date").alias("paid_on"))
    subscribed = earliest_by(
        of_interest("status_log").where(
            F.col("substatus_id") == catalog.ACTIVE_SUBSCRIPTION),
        ["lead_id"], "created_at", "status_log_id",
    ).select("lead_id", F.col("rm_id").alias("converter_id"),
             F.col("created_at").alias("subscribed_on"))
    now = F.lit(dates.as_datetime(as_of)).cast("timestamp_ntz")
    answered = F.coalesce("completed_on", "updated_at")
    done = F.col("is_completed")
    links = payload.fields("source_info", list(APPOINTMENT_LINKS))
    rows = lookup.star(
        latest.withColumn("links", links),
        (last_lead, "contact_id"),
        (named(crm["contact"], "contact_id", "contact_id", appointment_lead_name="full_name"),
         "contact_id"),
        (first_log, "lead_id"), (repeat_log, "lead_id"), (paid, "lead_id"),
        (subscribed, "lead_id"),
        (named(crm["mst_user"], "user_id", "converter_id",
               converted_by_name="full_name", converted_by_email="email_address"),
         "converter_id"),
    )
    return rows.select(
        F.col("shown_lead_id").alias("lead_id"), "appointment_lead_name",
        F.col("created_at").alias("appointment_created_date"),
        F.col("follow_up").alias("appointment_booked_date"),
        *[F.col(f"links.{c}").alias(f"appointment_{c}") for c in APPOINTMENT_LINKS],
        F.when(done, 1).otherwise(0).alias("is_appointment_completed"),
        F.col("completed_on").alias("appointment_completed_date"), "lead_created_date",
        *[f"initial_{c}" for c in APPOINTMENT_LINKS], "repeat_lead_created_date",
        *[f"repeat_{c}" for c in APPOINTMENT_LINKS],
        dates.short_day_text("paid_on").alias("payment_date_ab"),
        dates.short_day_text("subscribed_on").alias("subscription_start_date_ab"),
        "converted_by_name", "converted_by_email",
        F.when(done & (F.col("follow_up") >= answered), 1).otherwise(0)
        .alias("completed_ontime"),
        F.when(~done & (F.col("follow_up") < F.coalesce(answered, now)), 1).otherwise(0)
        .alias("overdue_appointment"),
        F.when(~done, 1).otherwise(0).alias("active_appointment"),
        F.lit(1).alias("appointment_booking_flag"),
        F.when(F.col("lead_substatus_id").isin(list(catalog.WORKABLE_FOLLOW_UP)), 1).otherwise(0)
        .alias("workable_sl"),
        F.when(F.col("lead_substatus_id").isin(list(catalog.NON_WORKABLE)), 1).otherwise(0)
        .alias("non_workable_sl"),
    )


def funnel_measure_conditions(as_of) -> dict[str, str]:
    """The 69 funnel measures over ``lead`` columns."""
    edge = dates.midnight(as_of) - timedelta(days=catalog.RECENT_DAYS)
    changed = "coalesce(updated_at, created_at)"
    return catalog.funnel_conditions(
        "status_id", "substatus_id", "is_active",
        f"{changed} >= TIMESTAMP_NTZ '{edge}'",
        f"{changed} >= TIMESTAMP_NTZ '{edge + timedelta(days=1)}'",
    )


def funnel_snapshot(
    crm: Crm, as_of, untouched_days: int = 30, other_channels: bool = False, more: More = More()
) -> DataFrame:
    """Active leads with an open sales mapping: 69 measures and the story of each lead.

    Everything shown depends on the lead alone, so the measures need no grouping: each is the
    number of open mappings where its condition holds.
    """
    conditions = funnel_measure_conditions(as_of)
    lead = crm["lead"].where("is_active").select(
        "lead_id", "contact_id", "rm_id", "status_id", "substatus_id", "is_active", "created_at",
        "updated_at")
    owner = more.of_people(lookup.star(
        people(crm, "rm_id", "counsellor", manager_id="reporting_manager_id"),
        (managers(crm), "manager_id")), "counsellor")
    rows = lookup.star(
        # owners first: later the rows are wide, and stay where they lie by lead
        more.of_lead(lead.join(open_sales_mappings(crm), ["contact_id", "rm_id"])
                     .join(owner, "rm_id", "left")),
        (follow_up_states(crm, as_of), "lead_id"),
        (repeat_dates(crm), "lead_id"),
        (converted_leads(crm), "lead_id"),
        (untouched_leads(crm, as_of, untouched_days, other_channels), "lead_id"),
        (appointments(crm, as_of), "lead_id"),
        (named(crm["mst_status"], "status_id", "status_id", lead_status="name"), "status_id"),
        (named(crm["mst_substatus"], "substatus_id", "substatus_id", lead_substatus="name"),
         "substatus_id"),
    )
    booking = [c for c in rows.columns if c.startswith(("appointment_", "initial_", "repeat_"))]
    booking += ["is_appointment_completed", "lead_created_date", "payment_date_ab",
                "subscription_start_date_ab", "converted_by_name", "converted_by_email",
                "completed_ontime", "overdue_appointment", "active_appointment", "workable_sl",
                "non_workable_sl"]
    return rows.select(
        "lead_id", F.col("created_at").alias("report_date"),
        F.col("created_at").alias("refresh_date"), F.col("updated_at").alias("new_lead_count_date"),
        F.col("manager_name").alias("captain_counsellor"),
        F.col("counsellor_name").alias("counsellor"),
        F.col("counsellor_user").alias("counsellor_id"),
        F.col("counsellor_center").alias("location"), "lead_status", "lead_substatus",
        *[F.expr(f"CASE WHEN {text} THEN mappings ELSE 0L END").alias(name)
          for name, text in conditions.items()],
        "follow_up_status", "follow_ups", "payment_date", "product_name",
        F.col("untouched_contact_id").alias("contact_id"), "untouched_flag",
        F.when(F.col("substatus_id").isin(list(catalog.WORKABLE_UNTOUCHED)), 1).otherwise(0)
        .alias("workable_untouched"),
        F.when(F.col("substatus_id").isin(list(catalog.NON_WORKABLE_UNTOUCHED)), 1).otherwise(0)
        .alias("non_workable_untouched"),
        *booking, *more.columns,
    )


# --- logins, targets, quality, reasons ----------------------------------------------------


def login_log(crm: Crm, phone_users_only: bool = False) -> DataFrame:
    """First and last login per user and local day."""
    users = crm["mst_user"]
    if phone_users_only:
        users = users.where(F.col("sip_number").isNotNull())
    local = crm["user_login_log"].select(
        "user_id", dates.local_time("log_time").alias("local_time"))
    spans = local.groupBy("user_id", F.to_date("local_time").alias("login_date")).agg(
        F.min("local_time").alias("first_seen"), F.max("local_time").alias("last_seen"))
    owners = lookup.star(
        users.select("user_id", F.col("full_name").alias("counsellor"), "location_id"),
        (named(crm["mst_location"], "location_id", "location_id", location="name"),
         "location_id"),
    ).drop("location_id")
    return spans.join(owners, "user_id").select(
        F.col("login_date").cast("timestamp_ntz").alias("report_date"),
        F.col("login_date").cast("timestamp_ntz").alias("refresh_date"), "counsellor",
        F.col("user_id").alias("counsellor_id"), "location",
        dates.stamp_text("first_seen").alias("login_time"),
        dates.stamp_text("last_seen").alias("logout_time"),
    )


TARGET_COLUMNS = ("conversion_count", "arpa_amount", "arft_amount", "emandate_count",
                  "cash_flow_amount", "cash_flow_count")


def targets(crm: Crm) -> DataFrame:
    return crm["target_management"].select(
        F.col("start_date").alias("report_date"), F.col("created_at").alias("refresh_date"),
        F.col("rm_id").alias("counsellor_id"), *TARGET_COLUMNS)


def lead_quality(
    crm: Crm, taken_with_owner_only: bool = True, more: More = More()
) -> DataFrame:
    """Every lead with its fresh status entries against every log row of the lead.

    From stored tables, whose masters hold few codes, log rows travel with their codes and are
    named last; else masters are sorted and merged, which is cheaper before the leads are met.
    """
    held = isinstance(crm, ReadOnce)
    fresh = crm["status_log"].where(F.col("substatus_id").isin(list(catalog.UNTOUCHED))).select(
        "lead_id", F.col("created_at").alias("lead_created_date"),
        F.col("status_id").alias("status_id_sl"), F.col("substatus_id").alias("substatus_id_sl"),
        F.col("updated_at").alias("new_lead_count_date"))
    new_leads = crm["lead"].select(
        "lead_id", "contact_id", "utm_source", "utm_medium", "utm_campaign", "utm_content",
        F.col("page_url").alias("utm_url")).join(fresh, "lead_id", "left")
    pool = crm["pool_contact_mapping"]
    if taken_with_owner_only:
        pool = pool.where(F.col("rm_id").isNotNull())
    taken = lookup.star(
        earliest_by(pool.select("lead_id", "rm_id", "location_id", "pool_mapping_id"),
                    ["lead_id"], "pool_mapping_id"),
        (named(crm["mst_user"], "user_id", "rm_id", initially_taken_by="full_name"), "rm_id"),
        (named(crm["mst_location"], "location_id", "location_id",
               initially_taken_by_location="name"), "location_id"),
    ).select("lead_id", "initially_taken_by", "initially_taken_by_location")
    log = crm["lead_log"].select(
        "lead_id", "log_id", F.col("rm_id").alias("owner_id"), "status_id", "substatus_id",
        "product_id", idlists.last_item("sub_product_ids").alias("sub_product_id"),
        F.col("log_timestamp").alias("created_at_sl"))
    owner = more.of_people(people(crm, "owner_id", "counsellor"), "counsellor")

    def labelled(df: DataFrame) -> DataFrame:
        return lookup.star(
            df,
            (named(crm["mst_subproduct"], "sub_product_id", "sub_product_id", sub_product="code"),
             "sub_product_id"),
            (named(crm["mst_product"], "product_id", "product_id", product="code"), "product_id"),
            (named(crm["mst_status"], "status_id", "status_id", lead_status="name"), "status_id"),
            (named(crm["mst_substatus"], "substatus_id", "substatus_id", lead_substatus="name"),
             "substatus_id"),
        )

    rows = lookup.star(
        more.of_lead(lookup.star(new_leads, (taken, "lead_id"))),
        (named(crm["contact"], "contact_id", "contact_id", lead_name="full_name",
               lead_mobile="mobile_number", lead_email="email_address"), "contact_id"),
    ).drop("contact_id")
    if more.contacts is not None:  # a name is held once
        rows = rows.withColumn(
            "contact_name", F.when(F.col("lead_name").isNull(), F.col("contact_name")))
    rows = stored(rows, "lead-rows") if held else rows
    met = lookup.many_left_join(
        rows, log, ["lead_id"], store=not held,
        widen=lambda dealt: (dealt if held else labelled(dealt)).join(owner, "owner_id", "left"))
    return (labelled(met) if held else met).select(
        "lead_id", F.col("lead_created_date").alias("report_date"),
        F.col("lead_created_date").alias("refresh_date"), "new_lead_count_date",
        F.col("counsellor_name").alias("counsellor"),
        F.col("counsellor_user").alias("counsellor_id"),
        F.coalesce("counsellor_center", "initially_taken_by_location").alias("location"),
        "lead_status", "lead_substatus", "lead_name", "lead_mobile", "lead_email", "product",
        "sub_product", "utm_medium", "utm_source", "utm_campaign", "utm_content", "utm_url",
        "initially_taken_by", "initially_taken_by_location", "status_id_sl", "substatus_id_sl",
        "created_at_sl", "log_id",
        *measures.flags_where(catalog.bucket_conditions("substatus_id")),
        *measures.flags_where(catalog.bucket_conditions("substatus_id_sl"), "_sl"),
        *more.columns,
    )


def loss_reasons(crm: Crm, more: More = More()) -> DataFrame:
    """Losing status changes with the comments the owner noted on the same day."""
    losing = F.col("substatus_id").isin(list(catalog.LOSS_SUBSTATUS))
    changes = crm["status_log"].where(losing).select(
        "status_log_id", "lead_id", "rm_id", "status_id", "substatus_id", "created_at",
        "updated_at")
    notes = crm["activity"].where(
        losing & (F.col("created_by") != 1)
        & F.col("activity_type_id").isin(catalog.CALL_ACTIVITY, catalog.NOTE_ACTIVITY)
    ).select("activity_id", "lead_id", F.col("created_by").alias("rm_id"), "status_id",
             "substatus_id", F.col("created_at").alias("noted_at"), "comment_ids",
             "additional_comments")
    paired = lookup.same_day_join(
        changes, notes, ["lead_id", "rm_id", "status_id", "substatus_id"], "created_at",
        "noted_at", store=not isinstance(crm, ReadOnce))
    commented = lookup.array_member_left_join(
        paired, ["status_log_id", "activity_id"], "comment_ids",
        named(crm["mst_comment"], "comment_id", "comment_id", comment="name"), "comment_id")
    owner = more.of_people(people(crm, "rm_id", "counsellor"), "counsellor")
    return more.of_lead(commented.join(owner, "rm_id", "left")).select(
        "lead_id", F.col("created_at").alias("report_date"),
        F.col("created_at").alias("refresh_date"),
        F.col("updated_at").alias("new_lead_count_date"),
        F.col("counsellor_name").alias("counsellor"),
        F.col("counsellor_user").alias("counsellor_id"),
        F.col("counsellor_center").alias("location"), "comment", "additional_comments",
        *more.columns,
    )


# --- the whole report ---------------------------------------------------------------------


def enrich(crm: Crm, rows: DataFrame, directory: DataFrame) -> DataFrame:
    """Fill owner, centre, contact and name of one branch from the directory and the leads."""
    more = More(known_owners(directory), lead_contacts(crm))
    rows = more.of_owner(rows)
    return filled(more.of_lead(rows) if "lead_id" in rows.columns else rows)


def productivity_facts(other_channels: bool) -> dict[str, Need]:
    """What the branches read of each fact table that more than one of them needs."""
    links = tuple(APPOINTMENT_LINKS)
    channels = ("origin", "meta_info") if other_channels else ("origin",)
    noted = F.size(F.array_intersect(F.col("comment_ids").cast("array<int>"), F.array(
        *[F.lit(c) for c in catalog.NOTE_COMMENTS]))) > 0
    losing = F.col("substatus_id").isin(list(catalog.LOSS_SUBSTATUS))
    return {
        "lead": Need(("lead_id", "contact_id", "rm_id", "status_id", "substatus_id", "is_active",
                      "created_at", "updated_at", "utm_source", "utm_medium", "utm_campaign",
                      "utm_content", "page_url")),
        "contact": Need(("contact_id", "full_name", "mobile_number", "email_address",
                         "is_active")),
        "activity": Need(
            ("activity_id", "lead_id", "rm_id", "created_by", "activity_type_id", "call_duration",
             "comment_ids", "additional_comments", "created_at", "status_id", "substatus_id",
             *channels),
            noted | losing | contact_attempts(other_channels)),
        "status_log": Need(("status_log_id", "lead_id", "rm_id", "status_id", "substatus_id",
                            "created_at", "updated_at")),
        "lead_log": Need(("log_id", "lead_id", "rm_id", "status_id", "substatus_id", "product_id",
                          "sub_product_ids", "log_timestamp", "created_at", "updated_at", *links)),
        "follow_up": Need(("follow_up_id", "lead_id", "contact_id", "follow_up", "is_completed",
                           "completed_on", "created_at", "updated_at", "source", "source_info")),
        "contact_mapping": Need(("contact_id", "rm_id", "type", "end_date"),
                                F.col("end_date").isNull() & (F.col("type") == "Sales")),
    }


def productivity_masters() -> dict[str, Codes]:
    """Where the branches look up each master table."""
    def by(code: str) -> Codes:
        return Codes(code, (("lead", code), ("lead_log", code)))

    return {
        "mst_status": by("status_id"),
        "mst_substatus": by("substatus_id"),
        "mst_product": Codes("product_id", (("lead_log", "product_id"),)),
        "mst_subproduct": Codes("sub_product_id", (
            ("lead_log", idlists.last_item("sub_product_ids")), ("payment", "sub_product_id"),
            ("offline_payment", "sub_product_id"))),
        "mst_comment": Codes("comment_id", (("activity", F.explode("comment_ids")),)),
    }


def productivity_report(
    crm: Crm,
    as_of,
    directory: DataFrame,
    *,
    february: bool = False,
) -> DataFrame:
    """Six branches, marked in ``flag``, enriched from the owner directory.

    ``february`` selects the variant: other channels count as touching a lead, one feedback per
    lead, logins of phone users only, and the first pool entry whoever took it.  Every fact table that
    several branches need is read once.  Branches are enriched while they are narrow, and all but the
    longest are stored as they are computed, so that what one shuffles is gone before the next begins.
    """
    crm = ReadOnce(crm, productivity_facts(february), productivity_masters())
    more = More(known_owners(directory), lead_contacts(crm))
    branches: Mapping[str, DataFrame] = {
        "Sales Calling": stored(
            filled(sales_calling(crm, one_feedback_per_lead=february, more=more)), "calling"),
        "Funnel Management": stored(
            filled(funnel_snapshot(crm, as_of, other_channels=february, more=more)), "funnel"),
        "Login Log": enrich(crm, login_log(crm, phone_users_only=february), directory),
        "Target": enrich(crm, targets(crm), directory),
        "LQR": filled(lead_quality(crm, taken_with_owner_only=not february, more=more)),
        "Reasons": stored(filled(loss_reasons(crm, more=more)), "reasons"),
    }
    return unions.tagged(branches)
