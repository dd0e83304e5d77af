"""Runs that rewrite touched buckets of versioned tables and publish all tables at once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entry_queries import change_queries as base
from entry_queries.registry import ORACLES, Source, query
from tallyroute.operators import changes, unions
from tallyroute.plans import transfers
from tallyroute.session import scratch_path
from tallyroute.sources.versions import VersionedTables

KEYS = {"lead": "lead_id", "contact_mapping": "mapping_id", "follow_up": "follow_up_id",
        "feedback_response": "feedback_response_id", "status_log": "status_log_id"}


def versioned(t: Source, *names: str) -> VersionedTables:
    """The named tables as a first run lays them out."""
    tables = VersionedTables(t.spark, scratch_path(t.spark, "versions"))
    tables.create("first", {name: (t.crm[name], KEYS[name]) for name in names})
    return tables


def _service(t: Source, done: changes.ServiceTransfer) -> DataFrame:
    tables = versioned(t, "contact_mapping", "feedback_response", "follow_up")
    tables.apply("second", {"contact_mapping": done.contact_mapping,
                            "feedback_response": done.feedback, "follow_up": done.follow_up})
    return base._service_view(changes.ServiceTransfer(
        tables.table("contact_mapping"), tables.table("feedback_response"),
        tables.table("follow_up")))


@query("service_versions", ORACLES["cs_transfer_copy"])
def service_versions(t: Source) -> DataFrame:
    return _service(t, changes.transfer_service(
        t.crm["contact_mapping"], t.crm["feedback_response"], t.crm["follow_up"],
        base.service_moves(t), base.DELTA))


@query("service_preferred_versions", ORACLES["cs_transfer_preferred"])
def service_preferred_versions(t: Source) -> DataFrame:
    return _service(t, changes.transfer_service(
        t.crm["contact_mapping"], t.crm["feedback_response"], t.crm["follow_up"],
        base.service_moves(t), base.DELTA, prefer_old_owner=True, activity_type=1))


@query("reassign_versions", ORACLES["cs_reassign_by_copy"])
def reassign_versions(t: Source) -> DataFrame:
    moves = t.crm["feedback_response"].select("lead_id").distinct().withColumn(
        "new_rm_id", F.col("lead_id") % 16)
    return _service(t, changes.reassign_by_copy(
        t.crm["contact_mapping"], t.crm["feedback_response"], t.crm["follow_up"], moves,
        base.DELTA))


@query("upsert_versions", ORACLES["upsert_latest"])
def upsert_versions(t: Source) -> DataFrame:
    asked = t.customer.select(
        (F.col("c_custkey") * 2).alias("contact_id"), F.col("c_custkey").alias("lead_id"),
        (F.col("c_custkey") % 11).alias("rm_id"))
    delta, ids = changes.upsert_feedback(t.crm["feedback_response"], asked, base.DELTA)
    tables = versioned(t, "feedback_response")
    tables.apply("second", {"feedback_response": delta})
    actions = ids.select(F.col("action").alias("flag"), F.col("feedback_response_id").alias("id"),
                         "contact_id")
    return unions.stack(unions.tagged(
        {"feedback": base.feedback_view(tables.table("feedback_response"))}), actions)


@query("keyed_update_versions", ORACLES["keyed_update"])
def keyed_update_versions(t: Source) -> DataFrame:
    asked = t.events.select(
        F.col("event_id").alias("status_log_id"), F.expr("event_id div 4").alias("lead_id"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 1 SECOND ELSE ts END")
        .alias("created_at"),
        F.lit(9).alias("status_id"), (F.col("event_id") % 50).cast("int").alias("substatus_id"))
    delta, audit = changes.matched_update(
        t.crm["status_log"], asked, ["status_log_id", "created_at", "lead_id"],
        ["status_id", "substatus_id"], delta=True)
    tables = versioned(t, "status_log")
    tables.apply("second", {"status_log": delta})
    return tables.table("status_log").select(
        F.col("status_log_id").alias("id"), "status_id", "substatus_id").join(
            audit.select(F.col("status_log_id").alias("id"), "matched"), "id")


@query("restore_versions", ORACLES["restore_from_log"])
def restore_versions(t: Source) -> DataFrame:
    broken = changes.corrupted_mappings(
        t.crm["contact_mapping"], t.crm["contact_transfer_backup"], *base.SPAN)
    mapping, lead, audit = changes.restore_mappings(
        t.crm["contact_mapping"], t.crm["contact_mapping_log"], t.crm["lead"], broken,
        datetime(2022, 1, 1), delta=True)
    tables = versioned(t, "contact_mapping", "lead")
    tables.apply("second", {"contact_mapping": mapping, "lead": lead})
    return unions.tagged({
        "mapping": base.mapping_view(tables.table("contact_mapping")).select(
            "id", "lead_id", "rm_id", "is_open"),
        "lead": base.lead_view(tables.table("lead")).select("id", "lead_id", "rm_id", "is_open"),
        "audit": audit.select(F.col("mapping_id").alias("id"), "lead_id",
                              F.col("restored_rm_id").alias("rm_id"), "outcome")})


ONE_MOVE_SQL = base.ROUND_ROBIN_SQL.replace(
    f"FROM crm_lead WHERE {base.TRANSFERABLE})",
    f"FROM crm_lead WHERE {base.TRANSFERABLE} ORDER BY lead_id LIMIT 1)")


@query("touched_buckets", f"""
WITH {ONE_MOVE_SQL},
changed AS (SELECT 'lead' AS table_name, lead_id AS id FROM moves
  UNION ALL SELECT 'contact_mapping', mapping_id FROM closing
  UNION ALL SELECT 'contact_mapping', mapping_id FROM new_mapping WHERE mapping_id > (SELECT max(mapping_id) FROM crm_contact_mapping)
  UNION ALL SELECT 'follow_up', follow_up_id FROM finishing
  UNION ALL SELECT 'follow_up', follow_up_id FROM new_follow WHERE follow_up_id > (SELECT max(follow_up_id) FROM crm_follow_up))
SELECT DISTINCT table_name, (id % 64)::INT AS bucket, 64 AS buckets FROM changed WHERE id IS NOT NULL""",
       base.TRANSFER_TABLES)
def touched_buckets(t: Source) -> DataFrame:
    """What a run that moves one lead rewrites of each table."""
    done = transfers.transfer_by_round_robin(t.crm, base.DELTA, None, [3, 7, 9], 1).transfer
    tables = versioned(t, "lead", "contact_mapping", "follow_up")
    tables.apply("one lead", {"lead": done.lead, "contact_mapping": done.contact_mapping,
                              "follow_up": done.follow_up})
    return tables.written("one lead")


def _owners(tables: VersionedTables, stage: str) -> DataFrame:
    return unions.tagged({
        "mapping": base.mapping_view(tables.table("contact_mapping")),
        "lead": base.lead_view(tables.table("lead"))}).withColumn("stage", F.lit(stage))


def _stage_sql(stage: str, mapping: str, lead: str) -> str:
    new = lead == "new_lead"
    return f"""SELECT *, '{stage}' AS stage FROM (
  {base.view_sql('mapping', mapping, *base.MAPPING_VIEW)}
  UNION ALL {base.view_sql('lead', lead, 'lead_id', 'rm_id', 'status_id', 'is_active',
                           f'coalesce(updated_at = {base.NOW}, FALSE)' if new else 'FALSE')})"""


@query("stopped_and_repeated_run", f"""
WITH {base.ROUND_ROBIN_SQL}
{_stage_sql('stopped', 'crm_contact_mapping', 'crm_lead')}
UNION ALL {_stage_sql('published', 'new_mapping', 'new_lead')}
UNION ALL {_stage_sql('repeated', 'new_mapping', 'new_lead')}""", base.TRANSFER_TABLES)
def stopped_and_repeated_run(t: Source) -> DataFrame:
    """A run that stops before it publishes leaves both tables as they were; one that is published
    changes both; and published under the same id again it changes nothing."""
    done = base._round_robin(t, base.DELTA).transfer
    delta = {"lead": done.lead, "contact_mapping": done.contact_mapping}
    tables = versioned(t, "lead", "contact_mapping")
    tables.prepare("transfer", delta)
    stopped = _owners(tables, "stopped")
    tables.apply("transfer", delta)
    published = _owners(tables, "published")
    tables.apply("transfer", delta)
    return stopped.unionByName(published).unionByName(_owners(tables, "repeated"))
