"""Engagement report: what each contact watched and did yesterday."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import catalog, dates, durations, payload
from tallyroute.operators import lookup, measures
from tallyroute.operators.pick import latest_by
from tallyroute.plans.payments import Crm, named


def watch_seconds(group: str, condition: str, stem: str) -> Column:
    """Seconds of one content group: watched time if abandoned, full length if completed.

    Reads the second columns made once per event by :func:`parsed_events`.
    """
    kind = "any" if group in catalog.PLAIN_SECONDS_GROUPS else "clock"
    scope = F.expr(condition)
    return (
        F.when(scope & (F.col("Event_Name") == f"{stem} Abandoned"), F.col(f"watched_{kind}"))
        .when(scope & (F.col("Event_Name") == f"{stem} Completed"), F.col(f"length_{kind}"))
        .otherwise(F.lit(0).cast("bigint"))
    )


def parsed_events(activity: DataFrame) -> DataFrame:
    """Payload members as columns, each duration turned into seconds once."""
    parsed = activity.select(
        "contact_id", "activity_id",
        payload.fields("meta_info", catalog.PAYLOAD_FIELDS, "$.payload").alias("p"),
    ).select("contact_id", "activity_id", "p.*")
    return parsed.withColumns({
        f"{name}_{kind}": durations.clock_seconds(column, plain_numbers=kind == "any")
        for name, column in (("watched", "User_Watched_Time"),
                             ("length", "Actual_Content_Video_Length"))
        for kind in ("clock", "any")
    })


def event_conditions() -> dict[str, str]:
    event, course = "trim(Event_Name)", "trim(Course_Name)"
    found = {"logins": "Event_Name = 'Login'"}
    for state in ("Started", "Completed"):
        for name, title in catalog.QUIZ_COURSES.items():
            found[f"quiz_{state.lower()}_{name}"] = (
                f"{event} = 'Quiz {state}' AND {course} = '{title}'"
            )
    found["courses_purchased"] = f"{event} = 'Course Purchased'"
    found["workshops_purchased"] = f"{event} = 'Workshop Purchased'"
    return found


def contact_engagement(crm: Crm, as_of) -> DataFrame:
    """One row per contact active yesterday: seconds per content group, counts, purchases.

    The payload is parsed once per event; all measures come from one aggregate.
    """
    parsed = parsed_events(crm["activity"].where(dates.yesterday("created_at", as_of)))
    seconds = [F.sum(watch_seconds(*group)).alias(group[0]) for group in catalog.WATCH_GROUPS]

    def bought(kind: str, column: str) -> Column:
        name = F.when(F.trim("Event_Name") == f"{kind} Purchased", F.trim(column))
        return measures.ordered_text(name, F.col("activity_id"))

    return parsed.groupBy("contact_id").agg(
        *seconds, *measures.counts_where(event_conditions()),
        bought("Course", "Course_Name").alias("course_names"),
        bought("Workshop", "Workshop_Name").alias("workshop_names"),
    )


def user_points(crm: Crm, contacts: DataFrame) -> DataFrame:
    """Latest stated points per contact, over the whole history of the given contacts."""
    points = payload.field("meta_info", "$.payload.User_Points")
    stated = (
        crm["activity"].select("contact_id", "activity_id", points.alias("user_points"))
        .where(F.col("user_points").isNotNull() & (F.col("user_points") != ""))
        .join(contacts.select("contact_id"), "contact_id", "left_semi")
    )
    return latest_by(stated, ["contact_id"], "activity_id").select("contact_id", "user_points")


def engagement_report(crm: Crm, as_of, wrap_at_midnight: bool = False) -> DataFrame:
    """Per lead of a contact active yesterday: dimensions, durations as text, counts, total.

    Activity is aggregated per contact before leads and plans multiply the rows; leads that
    show the same values are listed once.
    """
    engaged = contact_engagement(crm, as_of)
    pulled = latest_by(
        crm["pool_contact_mapping"].where("is_taken AND NOT is_mapped AND is_active")
        .select("lead_id", "rm_id", "pool_mapping_id"),
        ["lead_id"], "pool_mapping_id",
    ).select("lead_id", F.col("rm_id").alias("puller_id"))
    lead = crm["lead"].select(
        "lead_id", "contact_id", "created_at", "product_id", "sub_product_ids", "status_id",
        "substatus_id", "rm_id").join(engaged.select("contact_id"), "contact_id", "left_semi")
    lead = lookup.array_member_left_join(
        lead, "lead_id", "sub_product_ids",
        named(crm["mst_subproduct"], "sub_product_id", "sub_product_id", sub_product="name"),
        "sub_product_id")
    leads = lookup.star(
        lead,
        (pulled, "lead_id"),
        (named(crm["mst_status"], "status_id", "status_id", lead_status="name"), "status_id"),
        (named(crm["mst_substatus"], "substatus_id", "substatus_id", lead_substatus="name"),
         "substatus_id"),
        (named(crm["mst_product"], "product_id", "product_id", product="name"), "product_id"),
        (named(crm["mst_user"], "user_id", "rm_id", counsellor_name="full_name",
               counsellor_email="email_address"), "rm_id"),
        (named(crm["mst_user"], "user_id", "puller_id", pulled_by="full_name"), "puller_id"),
    ).select(
        F.coalesce(dates.day_text("created_at"), F.lit("N/A")).alias("lead_created_date"),
        "contact_id", "product", "sub_product", "lead_status", "lead_substatus",
        "counsellor_name", "counsellor_email", "pulled_by",
    ).distinct()
    contacts = named(crm["contact"], "contact_id", "contact_id", lead_name="full_name",
                     lead_number="mobile_number", lead_email="email_address")
    rows = lookup.star(
        leads.join(engaged, "contact_id"), (contacts, "contact_id"),
        (user_points(crm, engaged), "contact_id"))
    groups = [group[0] for group in catalog.WATCH_GROUPS]
    total = F.lit(0).cast("bigint")
    for name in groups:
        part = F.pmod(F.col(name), F.lit(86400)) if wrap_at_midnight else F.col(name)
        total = total + part
    return rows.withColumn("total_time_spent", durations.clock_text(total)).withColumns(
        {name: durations.clock_text(name, wrap_at_midnight) for name in groups})
