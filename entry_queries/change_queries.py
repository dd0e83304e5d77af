"""Table-to-table changes, file batches, ingestion."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entry_queries.registry import ORACLES, Source, day, query, ts
from tallyroute.functions import cleaning
from tallyroute.operators import audit, changes, measures, unions
from tallyroute.operators.changes import Run
from tallyroute.plans import collections, offline_payments, refunds, service, transfers
from tallyroute.session import cut_lineage, scratch_path
from tallyroute.sources import dumps, file_index, files, ingest, schema

AS_OF = datetime(2024, 2, 5, 12, 0, 0)
RUN, DELTA = Run(AS_OF), Run(AS_OF, delta=True)
NOW = "TIMESTAMP '2024-02-05 12:00:00'"
STAMP = "'2024-02-05 12:00:00'"


def stamped(column: str) -> F.Column:
    return (F.col(column) == RUN.now).alias("stamped")


def mapping_view(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("mapping_id").alias("id"), "lead_id", "contact_id", "rm_id",
        F.col("type").alias("kind"), F.col("end_date").isNull().alias("is_open"),
        stamped("updated_at"))


def follow_up_view(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("follow_up_id").alias("id"), "lead_id", "contact_id", "rm_id",
        F.col("activity_type_id").cast("string").alias("kind"),
        (~F.col("is_completed")).alias("is_open"), stamped("updated_at"))


def feedback_view(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("feedback_response_id").alias("id"), "lead_id", "contact_id",
        F.col("assigned_to").alias("rm_id"), F.col("color").alias("kind"),
        F.col("completed_on").isNull().alias("is_open"), stamped("updated_at"))


def lead_view(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("lead_id").alias("id"), "lead_id", "contact_id", "rm_id",
        F.col("status_id").cast("string").alias("kind"), F.col("is_active").alias("is_open"),
        F.coalesce(F.col("updated_at") == RUN.now, F.lit(False)).alias("stamped"))


def view_sql(flag: str, table: str, key: str, owner: str, kind: str, is_open: str,
             stamped_at: str = f"updated_at = {NOW}") -> str:
    return (f"SELECT '{flag}' AS flag, {key} AS id, lead_id, contact_id, {owner} AS rm_id,"
            f" CAST({kind} AS VARCHAR) AS kind, {is_open} AS is_open, {stamped_at} AS stamped"
            f" FROM {table}")


MAPPING_VIEW = ("mapping_id", "rm_id", "type", "end_date IS NULL")
FOLLOW_VIEW = ("follow_up_id", "rm_id", "activity_type_id", "NOT is_completed")
FEEDBACK_VIEW = ("feedback_response_id", "assigned_to", "color", "completed_on IS NULL")

# --- sales transfer -----------------------------------------------------------------------

TRANSFERABLE = """is_active AND NOT list_contains(sub_product_ids, 23) AND status_id < 5
  AND (substatus_id BETWEEN 1 AND 3 OR substatus_id BETWEEN 5 AND 7 OR substatus_id BETWEEN 9 AND 11
    OR substatus_id BETWEEN 13 AND 28 OR substatus_id BETWEEN 54 AND 62 OR substatus_id IN (64, 65))
  AND NOT (substatus_id IN (10, 11) AND coalesce(updated_at, created_at) <= TIMESTAMP '2023-12-06 12:00:00')"""

ROUND_ROBIN_SQL = f"""
moves AS (SELECT lead_id, contact_id, rm_id AS old_rm, status_id, substatus_id,
    list_extract([3, 7, 9], CAST((row_number() OVER (ORDER BY lead_id) - 1) % 3 + 1 AS INT))::BIGINT AS new_rm,
    row_number() OVER (ORDER BY lead_id) AS pos
  FROM crm_lead WHERE {TRANSFERABLE}),
closing AS (SELECT max(mapping_id) AS mapping_id FROM crm_contact_mapping m JOIN moves v ON v.lead_id = m.lead_id
  AND v.old_rm = m.rm_id WHERE end_date IS NULL AND type = 'Sales' GROUP BY v.lead_id),
new_mapping AS (SELECT mapping_id, contact_id, lead_id, rm_id, type,
    CASE WHEN mapping_id IN (SELECT mapping_id FROM closing) THEN {NOW} ELSE end_date END AS end_date,
    CASE WHEN mapping_id IN (SELECT mapping_id FROM closing) THEN {NOW} ELSE updated_at END AS updated_at
  FROM crm_contact_mapping
  UNION ALL SELECT (SELECT max(mapping_id) FROM crm_contact_mapping) + pos, contact_id, lead_id, new_rm, 'Sales', NULL, {NOW} FROM moves),
finishing AS (SELECT max(follow_up_id) AS follow_up_id FROM crm_follow_up f JOIN moves v ON v.lead_id = f.lead_id
  AND v.old_rm = f.rm_id WHERE NOT is_completed GROUP BY v.lead_id),
new_follow AS (SELECT follow_up_id, lead_id, contact_id, rm_id, activity_type_id,
    is_completed OR follow_up_id IN (SELECT follow_up_id FROM finishing) AS is_completed,
    CASE WHEN follow_up_id IN (SELECT follow_up_id FROM finishing) THEN {NOW} ELSE updated_at END AS updated_at
  FROM crm_follow_up
  UNION ALL SELECT (SELECT max(follow_up_id) FROM crm_follow_up) + pos, lead_id, contact_id, new_rm, 1, FALSE, {NOW} FROM moves),
new_lead AS (SELECT l.lead_id, l.contact_id, coalesce(new_rm, l.rm_id) AS rm_id, l.status_id, l.is_active, l.updated_at
  FROM crm_lead l LEFT JOIN moves v ON v.lead_id = l.lead_id)"""
TRANSFER_TABLES = ("lead", "contact_mapping", "follow_up", "contact_transfer_backup")


def _round_robin(t: Source, run: Run = RUN) -> transfers.TransferBatch:
    return transfers.transfer_by_round_robin(t.crm, run, None, [3, 7, 9], None)


@query("transfer_apply", f"""
WITH {ROUND_ROBIN_SQL}
{view_sql('mapping', 'new_mapping', *MAPPING_VIEW)}
UNION ALL {view_sql('follow_up', 'new_follow', *FOLLOW_VIEW)}
UNION ALL {view_sql('lead', 'new_lead', 'lead_id', 'rm_id', 'status_id', 'is_active',
                    f'coalesce(updated_at = {NOW}, FALSE)')}""", TRANSFER_TABLES)
def transfer_apply(t: Source) -> DataFrame:
    done = _round_robin(t).transfer
    return unions.tagged({
        "mapping": mapping_view(done.contact_mapping), "follow_up": follow_up_view(done.follow_up),
        "lead": lead_view(done.lead)})


@query("transfer_delta", f"""
WITH {ROUND_ROBIN_SQL}
SELECT * FROM ({view_sql('mapping', 'new_mapping', *MAPPING_VIEW)}
  UNION ALL {view_sql('follow_up', 'new_follow', *FOLLOW_VIEW)}) WHERE stamped
UNION ALL {view_sql('lead', 'new_lead', 'lead_id', 'rm_id', 'status_id', 'is_active',
                    f'coalesce(updated_at = {NOW}, FALSE)')} WHERE lead_id IN (SELECT lead_id FROM moves)""",
       TRANSFER_TABLES)
def transfer_delta(t: Source) -> DataFrame:
    """Only the rows that a transfer adds or changes."""
    done = _round_robin(t, DELTA).transfer
    return unions.tagged({
        "mapping": mapping_view(done.contact_mapping), "follow_up": follow_up_view(done.follow_up),
        "lead": lead_view(done.lead)})


@query("transfer_merged", ORACLES["transfer_apply"])
def transfer_merged(t: Source) -> DataFrame:
    """New and changed rows merged into the tables are the new tables."""
    done = _round_robin(t, DELTA).transfer
    return unions.tagged({
        "mapping": mapping_view(changes.merged(
            t.crm["contact_mapping"], done.contact_mapping, "mapping_id")),
        "follow_up": follow_up_view(changes.merged(
            t.crm["follow_up"], done.follow_up, "follow_up_id")),
        "lead": lead_view(changes.merged(t.crm["lead"], done.lead, "lead_id"))})


@query("transfer_backup", f"""
WITH {ROUND_ROBIN_SQL}
SELECT lead_id, new_rm AS rm_id, old_rm AS old_rm_id, status_id, substatus_id,
  (SELECT max(mapping_id) FROM crm_contact_mapping) + pos AS mapping_id, {STAMP} AS created_at,
  (SELECT max(session_id) + 1 FROM crm_contact_transfer_backup) AS session_id FROM moves
UNION ALL SELECT lead_id, rm_id, old_rm_id, status_id, substatus_id, mapping_id, {ts('created_at')}, session_id
FROM crm_contact_transfer_backup""", TRANSFER_TABLES)
def transfer_backup(t: Source) -> DataFrame:
    return _round_robin(t).transfer.backup


@query("transfer_twice", f"""
WITH old_owner AS (SELECT DISTINCT rm_id FROM crm_lead WHERE rm_id >= 4),
pool AS (SELECT lead_id FROM crm_lead WHERE rm_id IN (SELECT rm_id FROM old_owner) AND {TRANSFERABLE})
SELECT 1 AS run, count(*)::BIGINT AS moved FROM pool
UNION ALL SELECT 2, 0""", ("lead",))
def transfer_twice(t: Source) -> DataFrame:
    """Owners 0-3 take every transferable lead of the others; a second run finds none."""
    receivers = [0, 1, 2, 3]

    def one_run(crm) -> transfers.TransferBatch:
        pool = changes.transferable(
            crm["lead"].where(~F.col("rm_id").isin(receivers)), RUN,
            substatus=transfers.catalog.TRANSFERABLE)
        moves = transfers.allocate.round_robin(
            pool.select("lead_id"), "lead_id", receivers, "new_rm_id")
        done = changes.transfer_leads(
            crm["lead"], crm["contact_mapping"], crm["contact_transfer_backup"], moves, RUN)
        return transfers.TransferBatch(moves, done)

    first = one_run(t.crm)
    after = {"lead": cut_lineage(first.transfer.lead),
             "contact_mapping": first.transfer.contact_mapping,
             "contact_transfer_backup": first.transfer.backup}
    second = one_run(after)
    counts = [batch.audit.agg(F.count(F.lit(1)).alias("moved")).select(
        F.lit(n).alias("run"), "moved") for n, batch in ((1, first), (2, second))]
    return unions.stack(*counts)


# --- by quota, by list, by hierarchy --------------------------------------------------------

QUOTA_SQL = """
requests AS (SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 13 = 0 THEN 'Nobody' ELSE
    ' OWNER ' || (s_suppkey // 4) || ' ' END AS full_name,
    CASE WHEN s_suppkey % 11 = 0 THEN 'x@example.org' ELSE 'owner' || ((s_suppkey * 7) % 10) || '@example.org' END AS email,
    CASE WHEN s_suppkey % 9 = 0 THEN 'abc' WHEN s_suppkey % 9 = 1 THEN '0' WHEN s_suppkey % 9 = 2 THEN '-1'
         ELSE CAST(5 + s_suppkey % 30 AS VARCHAR) END AS quota FROM supplier),
owners AS (SELECT lower(full_name) AS name, min(user_id) AS old_rm FROM crm_mst_user GROUP BY 1),
resolved AS (SELECT r.*, old_rm, u.user_id AS new_rm,
    CASE WHEN TRY_CAST(quota AS INT) > 0 THEN CAST(quota AS INT) END AS q
  FROM requests r LEFT JOIN owners ON name = lower(trim(r.full_name)) LEFT JOIN crm_mst_user u ON u.email_address = r.email),
judged AS (SELECT *, concat_ws(' | ', CASE WHEN old_rm IS NULL THEN 'old_rm_not_found: ''' || trim(full_name) || '''' END,
    CASE WHEN new_rm IS NULL THEN 'new_rm_not_found_by_email: ''' || email || '''' END,
    CASE WHEN q IS NULL THEN 'invalid_lead_count: ''' || quota || '''' END) AS errors FROM resolved),
asked AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY old_rm ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo
  FROM judged WHERE errors = ''),
pool AS (SELECT rm_id, lead_id, contact_id, status_id, substatus_id, row_number() OVER (PARTITION BY rm_id ORDER BY lead_id) - 1 AS slot
  FROM crm_lead WHERE is_active AND product_id IN (1, 2) AND NOT list_contains(sub_product_ids, 23) AND status_id < 5),
taken AS (SELECT a.row_id, a.full_name, a.email, p.lead_id, p.contact_id, a.old_rm, a.new_rm, p.status_id, p.substatus_id
  FROM asked a JOIN pool p ON p.rm_id = a.old_rm AND slot >= lo AND slot < lo + q),
lines AS (SELECT row_id, full_name, email, lead_id, contact_id, old_rm, new_rm, status_id, substatus_id, 'OK' AS remarks, TRUE AS good FROM taken
  UNION ALL SELECT row_id, full_name, email, NULL, NULL, old_rm, new_rm, NULL, NULL, errors, FALSE FROM judged WHERE errors <> ''
  UNION ALL SELECT row_id, full_name, email, NULL, NULL, old_rm, new_rm, NULL, NULL,
    'no_active_leads_found_or_exhausted for rm_id=' || old_rm, FALSE FROM asked
  WHERE row_id NOT IN (SELECT row_id FROM taken))"""


def quota_requests(t: Source) -> DataFrame:
    key = F.col("s_suppkey")
    return t.supplier.select(
        key.alias("row_id"),
        F.when(key % 13 == 0, "Nobody").otherwise(
            F.concat(F.lit(" OWNER "), F.expr("CAST(s_suppkey div 4 AS STRING)"), F.lit(" ")))
        .alias("full_name"),
        F.when(key % 11 == 0, "x@example.org").otherwise(F.concat(
            F.lit("owner"), ((key * 7) % 10).cast("string"), F.lit("@example.org")))
        .alias("transfer_to_email"),
        F.when(key % 9 == 0, "abc").when(key % 9 == 1, "0").when(key % 9 == 2, "-1")
        .otherwise((5 + key % 30).cast("string")).alias("lead_count"))


QUOTA_TABLES = ("mst_user", "lead", "contact_mapping", "contact_transfer_backup")


@query("transfer_by_quota", f"""
WITH {QUOTA_SQL},
moves AS (SELECT t.*, row_number() OVER (PARTITION BY contact_id, old_rm ORDER BY lead_id) AS k FROM taken t),
open_rows AS (SELECT contact_id, rm_id, mapping_id, row_number() OVER (PARTITION BY contact_id, rm_id ORDER BY mapping_id DESC) AS k
  FROM crm_contact_mapping WHERE end_date IS NULL AND type = 'Sales'),
closing AS (SELECT mapping_id FROM moves m JOIN open_rows o ON o.contact_id = m.contact_id AND o.rm_id = m.old_rm AND o.k = m.k),
present AS (SELECT contact_id, rm_id, max(mapping_id) AS id FROM crm_contact_mapping m
  WHERE end_date IS NULL AND type = 'Sales' AND mapping_id NOT IN (SELECT mapping_id FROM closing) GROUP BY 1, 2),
fresh AS (SELECT contact_id, new_rm, min(lead_id) AS lead_id FROM moves m
  WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.contact_id = m.contact_id AND p.rm_id = m.new_rm) GROUP BY 1, 2),
fresh_ids AS (SELECT *, (SELECT max(mapping_id) FROM crm_contact_mapping) + row_number() OVER (ORDER BY lead_id) AS id FROM fresh)
SELECT l.row_id, l.full_name, l.email AS transfer_to_email, l.lead_id, l.contact_id, l.old_rm AS old_rm_id, l.new_rm AS new_rm_id,
  l.status_id, l.substatus_id, coalesce(p.id, f.id)::BIGINT AS new_mapping_id,
  CASE WHEN good THEN (SELECT max(session_id) + 1 FROM crm_contact_transfer_backup) END AS session_id, l.remarks,
  CASE WHEN good THEN 'success' ELSE 'failed' END AS transfer_status
FROM lines l LEFT JOIN present p ON good AND p.contact_id = l.contact_id AND p.rm_id = l.new_rm
LEFT JOIN fresh_ids f ON good AND f.contact_id = l.contact_id AND f.new_rm = l.new_rm""", QUOTA_TABLES)
def transfer_by_quota(t: Source) -> DataFrame:
    return transfers.transfer_by_quota(t.crm, quota_requests(t), RUN).audit


@query("transfer_by_quota_dry", f"""
WITH {QUOTA_SQL}
SELECT row_id, full_name, email AS transfer_to_email, lead_id, contact_id, old_rm AS old_rm_id, new_rm AS new_rm_id,
  status_id, substatus_id, remarks, CASE WHEN good THEN 'validated' ELSE 'failed' END AS transfer_status FROM lines""",
       ("mst_user", "lead"))
def transfer_by_quota_dry(t: Source) -> DataFrame:
    """The same validation and audit without any change."""
    dry = Run(AS_OF, mode=changes.DRY_RUN)
    return transfers.transfer_by_quota(t.crm, quota_requests(t), dry).audit.drop(
        "new_mapping_id", "session_id")


LIST_SQL = """
requests AS (SELECT c_custkey AS row_id, 'Person ' || c_custkey AS contact_name,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'user' || c_custkey || '@example.org' END AS email,
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE ' 9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS mobile,
    CASE WHEN c_custkey % 17 = 0 THEN 'Nobody' ELSE 'Owner ' || (c_custkey % 5) END AS old_name,
    CASE WHEN c_custkey % 19 = 0 THEN '' ELSE ' Owner ' || (c_custkey % 4) END AS new_name,
    CASE WHEN c_custkey % 23 = 0 THEN 'none' ELSE 'STATUS ' || (1 + c_custkey % 8) END AS status_name,
    'substatus ' || (1 + c_custkey % 80) AS substatus_name FROM customer),
owners AS (SELECT full_name, min(user_id) AS user_id FROM crm_mst_user WHERE is_active GROUP BY 1),
resolved AS (SELECT r.*, coalesce((SELECT min(contact_id) FROM crm_contact c WHERE c.email_address = r.email AND r.email <> ''),
    (SELECT min(contact_id) FROM crm_contact c WHERE c.mobile_number = trim(r.mobile))) AS contact_id,
    o.user_id AS old_rm, n.user_id AS new_rm, st.status_id, ss.substatus_id
  FROM requests r LEFT JOIN owners o ON o.full_name = trim(old_name) LEFT JOIN owners n ON n.full_name = trim(new_name)
  LEFT JOIN crm_mst_status st ON lower(st.name) = lower(status_name)
  LEFT JOIN crm_mst_substatus ss ON lower(ss.name) = lower(substatus_name)),
judged AS (SELECT *, concat_ws(' | ', CASE WHEN contact_id IS NULL THEN 'contact_not_found' END,
    CASE WHEN old_rm IS NULL THEN 'old_rm_not_found' END, CASE WHEN new_rm IS NULL THEN 'new_rm_not_found' END,
    CASE WHEN status_id IS NULL THEN 'status_not_found' END, CASE WHEN substatus_id IS NULL THEN 'substatus_not_found' END) AS errors
  FROM resolved),
newest AS (SELECT contact_id, max(lead_id) AS lead_id FROM crm_lead WHERE is_active AND NOT list_contains(sub_product_ids, 23)
  AND status_id < 6 AND NOT (substatus_id IN (10, 11) AND coalesce(updated_at, created_at) <= TIMESTAMP '2023-12-06 12:00:00')
  GROUP BY contact_id),
final AS (SELECT j.*, CASE WHEN errors = '' THEN w.lead_id END AS lead_id,
    CASE WHEN errors = '' AND w.lead_id IS NULL THEN 'lead_not_found' ELSE errors END AS all_errors
  FROM judged j LEFT JOIN newest w ON w.contact_id = j.contact_id),
pos AS (SELECT lead_id, row_number() OVER (ORDER BY lead_id) AS n FROM final WHERE all_errors = '')"""


def list_requests(t: Source) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")

    def numbered(label: str, number: F.Column) -> F.Column:
        return F.concat(F.lit(label), number.cast("string"))

    return t.customer.select(
        key.alias("row_id"), numbered("Person ", key).alias("contact_name"),
        F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("user"), text, F.lit("@example.org")))
        .alias("email_address"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.lit(" 9"), F.lpad(text, 9, "0")))
        .alias("mobile_number"),
        F.when(key % 17 == 0, "Nobody").otherwise(numbered("Owner ", key % 5))
        .alias("current_counselor"),
        numbered("STATUS ", 1 + key % 8).alias("status"),
        numbered("substatus ", 1 + key % 80).alias("substatus"),
        F.when(key % 19 == 0, "").otherwise(numbered(" Owner ", key % 4)).alias("move_to_owner"),
    ).withColumn("status", F.when(F.col("row_id") % 23 == 0, "none").otherwise(F.col("status")))


@query("transfer_by_list", f"""
WITH {LIST_SQL}
SELECT row_id, contact_name, email AS email_address, mobile AS mobile_number, old_name AS current_counselor,
  status_name AS status, substatus_name AS substatus, new_name AS move_to_owner, contact_id, f.lead_id, old_rm AS old_rm_id,
  new_rm AS new_rm_id, status_id, substatus_id,
  CASE WHEN all_errors = '' THEN (SELECT max(mapping_id) FROM crm_contact_mapping) + n END AS new_mapping_id,
  CASE WHEN all_errors = '' THEN (SELECT max(session_id) + 1 FROM crm_contact_transfer_backup) END AS session_id,
  CASE WHEN all_errors = '' THEN 'OK' ELSE all_errors END AS remarks,
  CASE WHEN all_errors = '' THEN 'success' ELSE 'failed' END AS transfer_status
FROM final f LEFT JOIN pos ON pos.lead_id = f.lead_id""",
       ("contact", "mst_user", "mst_status", "mst_substatus", *TRANSFER_TABLES))
def transfer_by_list(t: Source) -> DataFrame:
    return transfers.transfer_by_list(t.crm, list_requests(t), RUN).audit


@query("transfer_by_hierarchy", """
WITH RECURSIVE sells AS (SELECT user_id FROM crm_mst_user u JOIN crm_mst_department d ON d.department_id = u.department_id
  WHERE u.is_active AND d.group_name ILIKE '%sales%' AND user_id <> 1),
up AS (SELECT user_id AS root, user_id AS node, 0 AS depth FROM crm_mst_user
  UNION ALL SELECT root, u.reporting_manager_id, depth + 1 FROM up JOIN crm_mst_user u ON u.user_id = node
  WHERE u.reporting_manager_id IS NOT NULL),
hit AS (SELECT root, node FROM up WHERE node IN (SELECT user_id FROM sells)
  QUALIFY row_number() OVER (PARTITION BY root ORDER BY depth) = 1)
SELECT l.lead_id, l.rm_id AS old_rm_id, coalesce(node, 77)::BIGINT AS new_rm_id,
  CASE WHEN node = l.rm_id THEN 'valid owner, skipped' ELSE 'OK' END AS remarks,
  CASE WHEN node = l.rm_id THEN 'skipped' ELSE 'success' END AS transfer_status
FROM crm_lead l LEFT JOIN hit ON root = l.rm_id""", ("mst_user", "mst_department", "lead"))
def transfer_by_hierarchy(t: Source) -> DataFrame:
    leads = t.crm["lead"].select("lead_id")
    return transfers.transfer_by_hierarchy(t.crm, leads, RUN, 77).audit


ALLOCATION_SQL = """
alloc AS (SELECT '  USER' || c_custkey || '@example.ORG' AS customer_email,
  CASE WHEN c_custkey % 6 = 0 THEN 'gone@example.org' ELSE 'Owner' || (c_custkey % 10) || '@example.org ' END AS counsellor_email,
  0 AS record_insert FROM customer),
moves AS (SELECT c.contact_id, l.lead_id, u.user_id AS new_rm, a.customer_email FROM alloc a
  JOIN crm_contact c ON lower(trim(c.email_address)) = lower(trim(a.customer_email))
  JOIN crm_mst_user u ON lower(trim(u.email_address)) = lower(trim(a.counsellor_email))
  JOIN crm_lead l ON l.contact_id = c.contact_id WHERE l.is_active AND l.lead_source_id = 57
  QUALIFY row_number() OVER (PARTITION BY c.contact_id ORDER BY l.created_at DESC, l.lead_id DESC) = 1)"""


@query("allocation_marked", f"""
WITH {ALLOCATION_SQL}
SELECT a.customer_email, a.counsellor_email, CASE WHEN m.customer_email IS NOT NULL THEN 1 ELSE a.record_insert END AS record_insert
FROM alloc a LEFT JOIN moves m ON m.customer_email = a.customer_email""", ("contact", "mst_user", "lead"))
def allocation_marked(t: Source) -> DataFrame:
    key = F.col("c_custkey")
    alloc = t.customer.select(
        F.concat(F.lit("  USER"), key.cast("string"), F.lit("@example.ORG")).alias("customer_email"),
        F.when(key % 6 == 0, "gone@example.org").otherwise(F.concat(
            F.lit("Owner"), (key % 10).cast("string"), F.lit("@example.org ")))
        .alias("counsellor_email"), F.lit(0).alias("record_insert"))
    moves = transfers.allocation_moves(t.crm, alloc)
    return changes.mark_processed(alloc, moves, "customer_email")


# --- customer service ---------------------------------------------------------------------

SERVICE_MOVES = """
moves AS (SELECT contact_id, max(lead_id) AS lead_id, arg_max(rm_id, lead_id) AS old_rm, max(lead_id) % 7 AS new_rm
  FROM crm_lead WHERE status_id = 6 AND substatus_id = 29 GROUP BY contact_id),
pos AS (SELECT *, row_number() OVER (ORDER BY lead_id) AS n, row_number() OVER (ORDER BY contact_id) AS cn FROM moves)"""


def service_moves(t: Source) -> DataFrame:
    subscribed = t.crm["lead"].where("status_id = 6 AND substatus_id = 29")
    return subscribed.groupBy("contact_id").agg(
        F.max("lead_id").alias("lead_id"), F.max_by("rm_id", "lead_id").alias("old_rm_id"),
        (F.max("lead_id") % 7).alias("new_rm_id"))


def _service_sql(prefer: bool) -> str:
    order = "(assigned_to IS NOT DISTINCT FROM old_rm) DESC, " if prefer else ""
    mine = "AND f.rm_id = p.old_rm" if prefer else ""
    kind = 1 if prefer else 6
    return f"""
WITH {SERVICE_MOVES},
closing AS (SELECT max(mapping_id) AS id FROM crm_contact_mapping m JOIN pos p ON p.contact_id = m.contact_id AND p.old_rm = m.rm_id
  WHERE end_date IS NULL AND type = 'Customer Service' GROUP BY p.contact_id),
new_mapping AS (SELECT mapping_id, contact_id, lead_id, rm_id, type,
    CASE WHEN mapping_id IN (SELECT id FROM closing) THEN {NOW} ELSE end_date END AS end_date,
    CASE WHEN mapping_id IN (SELECT id FROM closing) THEN {NOW} ELSE updated_at END AS updated_at FROM crm_contact_mapping
  UNION ALL SELECT (SELECT max(mapping_id) FROM crm_contact_mapping) + n, contact_id, lead_id, new_rm, 'Customer Service', NULL, {NOW} FROM pos),
fb AS (SELECT DISTINCT ON (p.contact_id) feedback_response_id AS id, new_rm FROM crm_feedback_response r JOIN pos p ON p.contact_id = r.contact_id
  ORDER BY p.contact_id, {order}feedback_response_id DESC),
new_feedback AS (SELECT feedback_response_id, lead_id, contact_id, coalesce(new_rm, assigned_to) AS assigned_to, color, completed_on,
    CASE WHEN fb.id IS NOT NULL THEN {NOW} ELSE updated_at END AS updated_at
  FROM crm_feedback_response LEFT JOIN fb ON fb.id = feedback_response_id),
done AS (SELECT max(follow_up_id) AS id FROM crm_follow_up f JOIN pos p ON p.contact_id = f.contact_id {mine} GROUP BY p.contact_id),
latest AS (SELECT p.cn, p.new_rm, f.contact_id, max(follow_up_id) AS id, arg_max(f.lead_id, follow_up_id) AS lead_id
  FROM crm_follow_up f JOIN pos p ON p.contact_id = f.contact_id GROUP BY 1, 2, 3),
new_follow AS (SELECT follow_up_id, lead_id, contact_id, rm_id, activity_type_id,
    is_completed OR follow_up_id IN (SELECT id FROM done) AS is_completed,
    CASE WHEN follow_up_id IN (SELECT id FROM done) THEN {NOW} ELSE updated_at END AS updated_at FROM crm_follow_up
  UNION ALL SELECT (SELECT max(follow_up_id) FROM crm_follow_up) + row_number() OVER (ORDER BY cn), lead_id, contact_id, new_rm, {kind}, FALSE, {NOW} FROM latest)
{view_sql('mapping', 'new_mapping', *MAPPING_VIEW)}
UNION ALL {view_sql('feedback', 'new_feedback', *FEEDBACK_VIEW)}
UNION ALL {view_sql('follow_up', 'new_follow', *FOLLOW_VIEW)}"""


SERVICE_TABLES = ("lead", "contact_mapping", "feedback_response", "follow_up")


def _service_view(done: changes.ServiceTransfer) -> DataFrame:
    return unions.tagged({
        "mapping": mapping_view(done.contact_mapping), "feedback": feedback_view(done.feedback),
        "follow_up": follow_up_view(done.follow_up)})


def _service(t: Source, **options) -> DataFrame:
    return _service_view(changes.transfer_service(
        t.crm["contact_mapping"], t.crm["feedback_response"], t.crm["follow_up"],
        service_moves(t), RUN, **options))


@query("cs_transfer_copy", _service_sql(False), SERVICE_TABLES)
def cs_transfer_copy(t: Source) -> DataFrame:
    return _service(t)


@query("cs_transfer_preferred", _service_sql(True), SERVICE_TABLES)
def cs_transfer_preferred(t: Source) -> DataFrame:
    return _service(t, prefer_old_owner=True, activity_type=1)


@query("cs_reassign_by_copy", f"""
WITH moves AS (SELECT DISTINCT lead_id, (lead_id % 16)::BIGINT AS new_rm FROM crm_feedback_response),
latest AS (SELECT m.lead_id, new_rm, max(feedback_response_id) AS id, arg_max(contact_id, feedback_response_id) AS contact_id
  FROM crm_feedback_response r JOIN moves m ON m.lead_id = r.lead_id GROUP BY 1, 2),
new_feedback AS (SELECT r.feedback_response_id, r.lead_id, r.contact_id,
    CASE WHEN l.id IS NOT NULL AND completed_on IS NULL THEN new_rm ELSE assigned_to END AS assigned_to, color, completed_on,
    CASE WHEN l.id IS NOT NULL AND completed_on IS NULL THEN {NOW} ELSE updated_at END AS updated_at
  FROM crm_feedback_response r LEFT JOIN latest l ON l.id = r.feedback_response_id),
open_fu AS (SELECT f.lead_id, max(follow_up_id) AS id FROM crm_follow_up f JOIN latest l ON l.lead_id = f.lead_id
  WHERE NOT is_completed AND substatus_id = 29 GROUP BY f.lead_id),
added AS (SELECT l.lead_id, coalesce(f.contact_id, l.contact_id) AS contact_id, new_rm,
    CASE WHEN f.follow_up_id IS NULL THEN 6 ELSE f.activity_type_id END AS kind,
    CASE WHEN f.follow_up_id IS NULL THEN {NOW} ELSE f.updated_at END AS updated_at
  FROM latest l LEFT JOIN open_fu o ON o.lead_id = l.lead_id LEFT JOIN crm_follow_up f ON f.follow_up_id = o.id),
new_follow AS (SELECT follow_up_id, lead_id, contact_id, rm_id, activity_type_id,
    is_completed OR follow_up_id IN (SELECT id FROM open_fu) AS is_completed,
    CASE WHEN follow_up_id IN (SELECT id FROM open_fu) THEN {NOW} ELSE updated_at END AS updated_at FROM crm_follow_up
  UNION ALL SELECT (SELECT max(follow_up_id) FROM crm_follow_up) + row_number() OVER (ORDER BY lead_id), lead_id, contact_id, new_rm, kind, FALSE, updated_at FROM added),
svc AS (SELECT m.*, l.new_rm FROM crm_contact_mapping m JOIN latest l ON l.lead_id = m.lead_id WHERE type = 'Customer Service'),
closing AS (SELECT max(mapping_id) AS id FROM svc WHERE end_date IS NULL GROUP BY lead_id),
src AS (SELECT DISTINCT ON (lead_id) * FROM svc WHERE end_date IS NOT NULL OR mapping_id IN (SELECT id FROM closing) ORDER BY lead_id, mapping_id DESC),
new_mapping AS (SELECT mapping_id, contact_id, lead_id, rm_id, type,
    CASE WHEN mapping_id IN (SELECT id FROM closing) THEN {NOW} ELSE end_date END AS end_date,
    CASE WHEN mapping_id IN (SELECT id FROM closing) THEN {NOW} ELSE updated_at END AS updated_at FROM crm_contact_mapping
  UNION ALL SELECT (SELECT max(mapping_id) FROM crm_contact_mapping) + row_number() OVER (ORDER BY lead_id), contact_id, lead_id, new_rm, type, NULL, updated_at FROM src)
{view_sql('mapping', 'new_mapping', *MAPPING_VIEW)}
UNION ALL {view_sql('feedback', 'new_feedback', *FEEDBACK_VIEW)}
UNION ALL {view_sql('follow_up', 'new_follow', *FOLLOW_VIEW)}""",
       ("contact_mapping", "feedback_response", "follow_up"))
def cs_reassign_by_copy(t: Source) -> DataFrame:
    moves = t.crm["feedback_response"].select("lead_id").distinct().withColumn(
        "new_rm_id", F.col("lead_id") % 16)
    return _service_view(changes.reassign_by_copy(
        t.crm["contact_mapping"], t.crm["feedback_response"], t.crm["follow_up"], moves, RUN))


@query("service_requests", """
WITH asked AS (SELECT c_custkey AS row_id, CASE WHEN c_custkey % 12 = 0 THEN 'no plan' ELSE ' PLAN ' || (1 + c_custkey % 30) END AS product,
    CASE WHEN c_custkey % 14 = 0 THEN 'nobody' ELSE 'owner ' || (c_custkey % 5) END AS new_rm,
    'Owner ' || (c_custkey % 3) AS old_rm,
    CASE WHEN c_custkey % 15 = 0 THEN 'nan' ELSE 'USER' || c_custkey || '@example.org ' END AS email FROM customer),
owners AS (SELECT lower(trim(full_name)) AS name, max(user_id) AS id FROM crm_mst_user WHERE is_active GROUP BY 1),
rows AS (SELECT a.row_id, lower(trim(a.product)) AS product, sp.product_id, sp.sub_product_id, n.id AS new_rm_id, o.id AS old_rm_id,
    (SELECT min(contact_id) FROM crm_contact c WHERE lower(trim(c.email_address)) = lower(trim(a.email))) AS contact_id
  FROM asked a LEFT JOIN crm_mst_subproduct sp ON sp.is_active AND lower(trim(sp.name)) = lower(trim(a.product))
  LEFT JOIN owners n ON n.name = lower(trim(a.new_rm)) LEFT JOIN owners o ON o.name = lower(trim(a.old_rm))),
full_rows AS (SELECT r.*, (SELECT max(lead_id) FROM crm_lead l WHERE l.contact_id = r.contact_id AND status_id = 6 AND substatus_id = 29) AS lead_id FROM rows r)
SELECT row_id, product, product_id, sub_product_id, new_rm_id, old_rm_id, contact_id, lead_id,
  CASE WHEN product_id IS NULL THEN 'PRODUCT NOT FOUND' WHEN new_rm_id IS NULL THEN 'NEW RM NOT FOUND'
       WHEN contact_id IS NULL THEN 'CONTACT NOT FOUND' WHEN lead_id IS NULL THEN 'QUALIFIED LEAD NOT FOUND' END AS remarks,
  CASE WHEN remarks IS NULL THEN 'PENDING' ELSE 'FAILED' END AS process_status FROM full_rows""",
       ("mst_user", "mst_subproduct", "contact", "lead"))
def service_requests(t: Source) -> DataFrame:
    key = F.col("c_custkey")

    def text(label: str, number: F.Column, tail: str = "") -> F.Column:
        return F.concat(F.lit(label), number.cast("string"), F.lit(tail))

    asked = t.customer.select(
        key.alias("row_id"),
        F.when(key % 12 == 0, "no plan").otherwise(text(" PLAN ", 1 + key % 30)).alias("product"),
        F.when(key % 14 == 0, "nobody").otherwise(text("owner ", key % 5)).alias("new_rm"),
        text("Owner ", key % 3).alias("old_rm"),
        F.when(key % 15 == 0, "nan").otherwise(text("USER", key, "@example.org ")).alias("email"))
    return service.service_requests(t.crm, asked).drop("new_rm", "old_rm", "email")


@query("upsert_latest", f"""
WITH asked AS (SELECT c_custkey * 2 AS contact_id, c_custkey AS lead_id, (c_custkey % 11)::BIGINT AS rm FROM customer),
latest AS (SELECT a.contact_id, rm, max(feedback_response_id) AS id FROM asked a JOIN crm_feedback_response r ON r.contact_id = a.contact_id GROUP BY 1, 2),
fresh AS (SELECT a.*, row_number() OVER (ORDER BY a.contact_id) AS n FROM asked a WHERE contact_id NOT IN (SELECT contact_id FROM latest)),
new_feedback AS (SELECT r.feedback_response_id, r.lead_id, r.contact_id, coalesce(l.rm, r.assigned_to) AS assigned_to, color, completed_on,
    CASE WHEN l.id IS NOT NULL THEN {NOW} ELSE updated_at END AS updated_at
  FROM crm_feedback_response r LEFT JOIN latest l ON l.id = r.feedback_response_id
  UNION ALL SELECT (SELECT max(feedback_response_id) FROM crm_feedback_response) + n, lead_id, contact_id, rm, NULL, NULL, {NOW} FROM fresh)
{view_sql('feedback', 'new_feedback', *FEEDBACK_VIEW)}
UNION ALL SELECT 'updated', id, NULL, contact_id, NULL, NULL, NULL, NULL FROM latest
UNION ALL SELECT 'inserted', (SELECT max(feedback_response_id) FROM crm_feedback_response) + n, NULL, contact_id, NULL, NULL, NULL, NULL FROM fresh""",
       ("feedback_response",))
def upsert_latest(t: Source) -> DataFrame:
    asked = t.customer.select(
        (F.col("c_custkey") * 2).alias("contact_id"), F.col("c_custkey").alias("lead_id"),
        (F.col("c_custkey") % 11).alias("rm_id"))
    table, ids = changes.upsert_feedback(t.crm["feedback_response"], asked, RUN)
    actions = ids.select(F.col("action").alias("flag"), F.col("feedback_response_id").alias("id"),
                         "contact_id")
    return unions.stack(unions.tagged({"feedback": feedback_view(table)}), actions)


@query("keyed_update", """
WITH asked AS (SELECT event_id AS status_log_id, event_id // 4 AS lead_id,
    CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 1 SECOND ELSE ts END AS created_at, 9 AS status_id, (event_id % 50)::INT AS substatus_id FROM events),
hit AS (SELECT a.* FROM asked a JOIN crm_status_log s ON s.status_log_id = a.status_log_id AND s.created_at = a.created_at AND s.lead_id = a.lead_id)
SELECT s.status_log_id AS id, coalesce(h.status_id, s.status_id) AS status_id, coalesce(h.substatus_id, s.substatus_id) AS substatus_id,
  h.status_log_id IS NOT NULL AS matched FROM crm_status_log s LEFT JOIN hit h ON h.status_log_id = s.status_log_id""", ("status_log",))
def keyed_update(t: Source) -> DataFrame:
    asked = t.events.select(
        F.col("event_id").alias("status_log_id"), F.expr("event_id div 4").alias("lead_id"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 1 SECOND ELSE ts END")
        .alias("created_at"),
        F.lit(9).alias("status_id"), (F.col("event_id") % 50).cast("int").alias("substatus_id"))
    table, audit = changes.matched_update(
        t.crm["status_log"], asked, ["status_log_id", "created_at", "lead_id"],
        ["status_id", "substatus_id"])
    return table.select(F.col("status_log_id").alias("id"), "status_id", "substatus_id").join(
        audit.select(F.col("status_log_id").alias("id"), "matched"), "id")


@query("create_leads", f"""
WITH asked AS (SELECT c_custkey AS row_id, c_custkey // 2 AS contact_id, c_custkey % 10 AS rm FROM customer),
retired AS (SELECT lead_id, contact_id, rm_id, status_id, is_active AND NOT (lead_source_id = 57 AND status_id = 1 AND substatus_id = 2
    AND contact_id IN (SELECT contact_id FROM asked)) AS is_active, coalesce(updated_at = {NOW}, FALSE) AS stamped FROM crm_lead)
SELECT 'lead' AS flag, lead_id AS id, lead_id, contact_id, rm_id, CAST(status_id AS VARCHAR) AS kind, is_active AS is_open, stamped FROM retired
UNION ALL SELECT 'lead', (SELECT max(lead_id) FROM crm_lead) + row_number() OVER (ORDER BY row_id), (SELECT max(lead_id) FROM crm_lead) + row_number() OVER (ORDER BY row_id),
  contact_id, rm, '1', row_id = max(row_id) OVER (PARTITION BY contact_id), TRUE FROM asked
UNION ALL SELECT 'follow_up', (SELECT max(follow_up_id) FROM crm_follow_up) + row_number() OVER (ORDER BY row_id),
  (SELECT max(lead_id) FROM crm_lead) + row_number() OVER (ORDER BY row_id), contact_id, rm, NULL, TRUE, TRUE FROM asked
UNION ALL SELECT 'mapping', (SELECT max(mapping_id) FROM crm_contact_mapping) + row_number() OVER (ORDER BY row_id),
  (SELECT max(lead_id) FROM crm_lead) + row_number() OVER (ORDER BY row_id), contact_id, rm, 'Sales', TRUE, TRUE FROM asked
UNION ALL {view_sql('follow_up', 'crm_follow_up', 'follow_up_id', 'rm_id', 'activity_type_id', 'NOT is_completed')}
UNION ALL {view_sql('mapping', 'crm_contact_mapping', 'mapping_id', 'rm_id', 'type', 'end_date IS NULL')}""",
       ("lead", "follow_up", "contact_mapping"))
def create_leads(t: Source) -> DataFrame:
    asked = t.customer.select(
        F.col("c_custkey").alias("row_id"), F.expr("c_custkey div 2").alias("contact_id"),
        (F.col("c_custkey") % 10).alias("rm_id"), F.col("c_custkey").alias("lead_number"),
        F.lit(1).alias("product_id"), F.lit(4).alias("sub_product_id"))
    done = changes.create_leads(
        t.crm["lead"], t.crm["follow_up"], t.crm["contact_mapping"], asked, RUN)
    return unions.tagged({"lead": lead_view(done.lead),
                          "follow_up": follow_up_view(done.follow_up),
                          "mapping": mapping_view(done.contact_mapping)})


@query("creation_requests", """
WITH asked AS (SELECT c_custkey AS row_id, c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE 'plan ' || (1 + c_custkey % 30) END AS plan_name,
    'owner' || (c_custkey % 12) || '@example.org' AS owner_email FROM customer WHERE c_custkey % 8 <> 0),
rows AS (SELECT a.row_id, c_custkey AS lead_number, sp.product_id, sp.sub_product_id, c.contact_id, u.user_id AS rm_id
  FROM asked a LEFT JOIN crm_mst_subproduct sp ON sp.is_active AND lower(sp.name) = plan_name
  LEFT JOIN crm_contact c ON lower(trim(c.email_address)) = 'user' || c_custkey || '@example.org'
  LEFT JOIN crm_mst_user u ON u.is_active AND u.email_address = owner_email)
SELECT *, CASE WHEN rm_id IS NULL THEN 'RM NOT FOUND' WHEN contact_id IS NULL THEN 'EMAIL NOT FOUND' WHEN product_id IS NULL THEN 'PRODUCT NOT FOUND' END AS remarks,
  CASE WHEN remarks IS NULL THEN 'PENDING' ELSE 'FAILED' END AS process_status FROM rows""", ("mst_subproduct", "contact", "mst_user"))
def creation_requests(t: Source) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")
    asked = t.customer.select(
        key.alias("row_id"),
        F.when(key % 8 == 0, F.concat(F.lit("L"), text)).otherwise(F.concat(F.lit(" "), text))
        .alias("lead number"),
        F.concat(F.lit(" User"), text, F.lit("@Example.org")).alias("emailasperleadsquared"),
        F.when(key % 13 == 0, "Unknown").otherwise(
            F.concat(F.lit("PLAN "), (1 + key % 30).cast("string"))).alias("product"),
        F.concat(F.lit("Owner"), (key % 12).cast("string"), F.lit("@example.org "))
        .alias("allocated to"),
        *[F.lit("").alias(name) for name in service.CREATION_HEADERS if name not in (
            "lead number", "emailasperleadsquared", "product", "allocated to")])
    return service.creation_requests(t.crm, asked).drop("email", "plan_name", "owner_email")


# --- restore, collections -----------------------------------------------------------------

SPAN = (datetime(2018, 1, 1), datetime(2023, 1, 1))
BROKEN_SQL = """
closed AS (SELECT * FROM crm_contact_mapping WHERE updated_at BETWEEN TIMESTAMP '2018-01-01' AND TIMESTAMP '2023-01-01' AND end_date IS NOT NULL),
broken AS (SELECT mapping_id, lead_id FROM closed c WHERE lead_id IN (SELECT lead_id FROM closed GROUP BY lead_id HAVING count(*) > 1)
  AND NOT EXISTS (SELECT 1 FROM crm_contact_transfer_backup b WHERE b.lead_id = c.lead_id AND b.old_rm_id = c.rm_id))"""


@query("corrupted_mappings", f"WITH {BROKEN_SQL} SELECT * FROM broken",
       ("contact_mapping", "contact_transfer_backup"))
def corrupted_mappings(t: Source) -> DataFrame:
    return changes.corrupted_mappings(
        t.crm["contact_mapping"], t.crm["contact_transfer_backup"], *SPAN)


@query("restore_from_log", f"""
WITH {BROKEN_SQL},
entry AS (SELECT DISTINCT ON (mapping_id) mapping_id, rm_id, end_date, updated_at FROM crm_contact_mapping_log
  WHERE mapping_id IN (SELECT mapping_id FROM broken) AND log_timestamp < TIMESTAMP '2022-01-01'
  ORDER BY mapping_id, log_timestamp DESC, log_id DESC),
restored AS (SELECT m.mapping_id, m.lead_id, m.contact_id, m.type, CASE WHEN e.mapping_id IS NOT NULL THEN e.rm_id ELSE m.rm_id END AS rm_id,
    CASE WHEN e.mapping_id IS NOT NULL THEN e.end_date ELSE m.end_date END AS end_date FROM crm_contact_mapping m LEFT JOIN entry e ON e.mapping_id = m.mapping_id),
touched AS (SELECT b.lead_id, max(b.mapping_id) AS mapping_id FROM broken b JOIN entry USING (mapping_id) GROUP BY b.lead_id),
open_now AS (SELECT lead_id, arg_max(rm_id, mapping_id) AS rm FROM restored WHERE end_date IS NULL AND lead_id IN (SELECT lead_id FROM touched) GROUP BY lead_id),
reopen AS (SELECT t.lead_id, t.mapping_id, e.rm_id AS rm FROM touched t JOIN entry e USING (mapping_id) WHERE t.lead_id NOT IN (SELECT lead_id FROM open_now)),
owner AS (SELECT lead_id, rm FROM open_now UNION ALL SELECT lead_id, rm FROM reopen)
SELECT 'mapping' AS flag, mapping_id AS id, lead_id, rm_id, end_date IS NULL OR mapping_id IN (SELECT mapping_id FROM reopen) AS is_open, NULL AS outcome FROM restored
UNION ALL SELECT 'lead', l.lead_id, l.lead_id, coalesce(o.rm, l.rm_id), l.is_active, NULL FROM crm_lead l LEFT JOIN owner o ON o.lead_id = l.lead_id
UNION ALL SELECT 'audit', b.mapping_id, b.lead_id, e.rm_id, NULL, CASE WHEN e.mapping_id IS NULL THEN 'skipped'
  WHEN b.mapping_id IN (SELECT mapping_id FROM reopen) THEN 'reopened' ELSE 'restored' END FROM broken b LEFT JOIN entry e ON e.mapping_id = b.mapping_id""",
       ("contact_mapping", "contact_transfer_backup", "contact_mapping_log", "lead"))
def restore_from_log(t: Source) -> DataFrame:
    broken = changes.corrupted_mappings(
        t.crm["contact_mapping"], t.crm["contact_transfer_backup"], *SPAN)
    mapping, lead, audit = changes.restore_mappings(
        t.crm["contact_mapping"], t.crm["contact_mapping_log"], t.crm["lead"], broken,
        datetime(2022, 1, 1))
    return unions.tagged({
        "mapping": mapping_view(mapping).select("id", "lead_id", "rm_id", "is_open"),
        "lead": lead_view(lead).select("id", "lead_id", "rm_id", "is_open"),
        "audit": audit.select(F.col("mapping_id").alias("id"), "lead_id",
                              F.col("restored_rm_id").alias("rm_id"), "outcome")})


@query("reassign_with_reason", """
WITH asked AS (SELECT lead_id, CASE WHEN lead_id % 5 = 0 THEN 1 ELSE lead_id // 150 END AS old_rm, lead_id % 9 AS new_rm FROM crm_lead),
rows AS (SELECT a.*, (SELECT max(follow_up_id) FROM crm_follow_up f WHERE f.lead_id = a.lead_id AND f.rm_id = a.old_rm) AS fid,
  (SELECT max(payment_collection_id) FROM crm_payment_collection c WHERE c.lead_id = a.lead_id AND c.assigned_to = a.old_rm
    AND status_id = 7 AND substatus_id = 43) AS cid FROM asked a)
SELECT 'audit' AS flag, lead_id, old_rm AS old_rm_id, new_rm AS new_rm_id, fid AS follow_up_id, cid AS payment_collection_id,
  CASE WHEN fid IS NULL THEN 'follow_up not available' WHEN cid IS NULL THEN 'payment_collection not available OR rm mismatch'
  ELSE 'updated successfully' END AS status FROM rows
UNION ALL SELECT 'follow_up', f.lead_id, NULL, CASE WHEN r.fid IS NOT NULL THEN new_rm ELSE f.rm_id END, f.follow_up_id, NULL,
  CASE WHEN r.fid IS NOT NULL THEN 'open' WHEN is_completed THEN 'done' ELSE 'open' END
  FROM crm_follow_up f LEFT JOIN rows r ON r.fid = f.follow_up_id AND r.cid IS NOT NULL
UNION ALL SELECT 'collection', c.lead_id, NULL, CASE WHEN r.cid IS NOT NULL THEN new_rm ELSE c.assigned_to END, NULL, c.payment_collection_id,
  CAST(CASE WHEN r.cid IS NOT NULL THEN 20 ELSE department_id END AS VARCHAR)
  FROM crm_payment_collection c LEFT JOIN rows r ON r.cid = c.payment_collection_id AND r.fid IS NOT NULL""",
       ("lead", "follow_up", "payment_collection"))
def reassign_with_reason(t: Source) -> DataFrame:
    asked = t.crm["lead"].select(
        "lead_id", F.expr("CASE WHEN lead_id % 5 = 0 THEN 1L ELSE lead_id div 150 END")
        .alias("old_rm_id"), (F.col("lead_id") % 9).alias("new_rm_id"))
    follow_up, collection, audit = changes.reassign_collections(
        t.crm["follow_up"], t.crm["payment_collection"], asked, RUN)
    return unions.tagged({
        "audit": audit,
        "follow_up": follow_up.select(
            "lead_id", F.col("rm_id").alias("new_rm_id"), "follow_up_id",
            F.when(F.col("is_completed"), "done").otherwise("open").alias("status")),
        "collection": collection.select(
            "lead_id", F.col("assigned_to").alias("new_rm_id"), "payment_collection_id",
            F.col("department_id").cast("string").alias("status"))})


# --- refunds and offline payments -----------------------------------------------------------

REFUND_ASKED = """
asked AS (SELECT lead_id AS row_id, contact_id, CASE WHEN lead_id % 9 = 0 THEN NULL ELSE (1000 + lead_id % 700)::DOUBLE + 0.75 END AS amount,
    (lead_id % 90)::DOUBLE + 0.25 AS gst, (lead_id % 500)::DOUBLE + 0.5 AS refund_amount, (lead_id % 400)::DOUBLE + 0.5 AS amount_paid,
    CASE WHEN lead_id % 7 = 0 THEN NULL ELSE DATE '2023-01-01' + CAST(lead_id % 300 AS INT) END AS refund_date,
    CASE WHEN lead_id % 4 = 0 THEN NULL ELSE 'concern ' || (lead_id % 3) END AS concern,
    CASE WHEN lead_id % 6 = 0 THEN NULL ELSE 'utr' || lead_id END AS utr, 'proof' || (lead_id % 5) AS proof,
    CASE WHEN lead_id % 10 = 0 THEN 'NO SUCH REASON' ELSE 'REASON ' || (lead_id % 12) END AS reason FROM crm_lead)"""
REFUND_SQL = f"""
{REFUND_ASKED},
reasons AS (SELECT upper(trim(code)) AS code, min(reason_id) AS reason_id FROM crm_mst_reason GROUP BY 1),
contract AS (SELECT contact_id, arg_max(onboarding_id, (created_at, onboarding_id)) AS onboarding_id FROM crm_onboarding
  WHERE substatus_id = 29 GROUP BY contact_id),
pays AS (SELECT onboarding_id, string_agg(CAST(payment_id AS VARCHAR), ',' ORDER BY payment_id) AS ids, max(payment_id) AS payment_id,
    arg_max(lead_id, payment_id) AS lead_id, arg_max(payment_provider, payment_id) AS provider,
    arg_max(external_customer_id, payment_id) AS customer, arg_max(sub_product_id, payment_id) AS plan FROM crm_payment GROUP BY onboarding_id),
rows AS (SELECT a.*, r.reason_id, c.onboarding_id, CASE WHEN p.onboarding_id IS NULL THEN 'VALID PAYMENT NOT FOUND'
    WHEN r.reason_id IS NULL THEN 'REASON NOT FOUND' END AS failure
  FROM asked a LEFT JOIN reasons r ON r.code = a.reason LEFT JOIN contract c ON c.contact_id = a.contact_id
  LEFT JOIN pays p ON p.onboarding_id = c.onboarding_id),
ordered AS (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY refund_date NULLS LAST, row_id) AS n FROM rows WHERE failure IS NULL),
concerns AS (SELECT contact_id, string_agg(concern, ', ' ORDER BY n) AS comment FROM (SELECT contact_id, concern, min(n) AS n FROM ordered
  WHERE concern IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
grouped AS (SELECT contact_id, sum(amount) AS amount, sum(gst) AS gst, sum(refund_amount) AS refund_amount, sum(amount_paid) AS paid,
    arg_max(onboarding_id, n) AS onboarding_id, arg_max(utr, n) FILTER (WHERE utr IS NOT NULL) AS utr,
    max(refund_date) AS refund_date, arg_min(reason_id, n) AS reason_id FROM ordered GROUP BY contact_id),
refunds AS (SELECT (SELECT max(refund_id) FROM crm_refund) + row_number() OVER (ORDER BY g.contact_id) AS refund_id, g.*, p.* EXCLUDE (onboarding_id), comment
  FROM grouped g JOIN pays p ON p.onboarding_id = g.onboarding_id LEFT JOIN concerns c ON c.contact_id = g.contact_id)"""


def refund_requests(t: Source) -> DataFrame:
    """Request file rows as text, with the headers people type."""
    key = F.col("lead_id")

    def num(offset: int, modulus: int, tail: str) -> F.Column:
        return F.concat((offset + key % modulus).cast("string"), F.lit(tail))

    reason = F.when(key % 10 == 0, "no such reason").otherwise(
        F.concat(F.lit(" reason "), (key % 12).cast("string"), F.lit(" ")))
    due = F.date_add(F.to_date(F.lit("2023-01-01")), (key % 300).cast("int"))
    given = {
        "Lead / Contact ID": F.concat(F.lit(" "), F.col("contact_id").cast("string")),
        "Amount": F.when(key % 9 == 0, F.element_at(F.array(*map(F.lit, (
            "pending", "nan", "-inf", "12d", "1e400"))), (key % 5 + 1).cast("int"))).otherwise(
            F.concat(F.lit("1,"), F.lpad((key % 700).cast("string"), 3, "0"), F.lit(".75"))),
        "GST Amount": num(0, 90, ".25"), "Refund Amount": num(0, 500, ".5"),
        "Amount paid": num(0, 400, ".5"),
        "Refund Date(Finance)": F.when(key % 7 == 0, "soon")
        .when(key % 7 == 1, F.date_format(due, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 7 == 2, F.date_format(due, "dd.MM.yy"))
        .when(key % 7 == 3, F.date_format(due, "d MMMM yyyy"))
        .when(key % 7 == 4, F.date_format(due, "MMM d, yyyy"))
        .otherwise(F.date_format(due, "dd/MM/yyyy")),
        "Detail  Concern": F.when(key % 4 > 0, F.concat(F.lit(" concern "),
                                                       (key % 3).cast("string"))),
        "UTR (Finance)": F.when(key % 6 > 0, F.concat(F.lit("utr"), key.cast("string"))),
        "Bank proof": F.concat(F.lit("proof"), (key % 5).cast("string")),
        "Reason Sub\nCategory": reason,
    }
    blank = ("Counselor Counsellor/RM", "Client Name", "Client Email ID", "Client Phone Number",
             "Onboarding Date", "Refund Request Date from Client", "Ops Status",
             "Refund Category", "Refund Sub Category", "Reason", "Deactivation Yes/No",
             "Refunded Product", "Date of Request Raised to Finance (Ops)", "Ops Remarks",
             "Finance Remarks", "EC Status (Refunded)", "Dashboard Deactivation Dated",
             "Deactivation Email to Client")
    rows = t.crm["lead"].select(
        key.alias("row_id"), *[column.alias(name) for name, column in given.items()],
        *[F.lit("").alias(name) for name in blank])
    return refunds.clean_requests(rows)


REFUND_TABLES = ("lead", "mst_reason", "onboarding", "payment", "refund")


@query("refund_batch", f"""
WITH {REFUND_SQL}
SELECT refund_id, payment_id, onboarding_id, contact_id, customer AS external_customer_id, lead_id, plan AS sub_product_id,
  257 AS type, coalesce(trunc(paid), 0)::BIGINT AS received_amount, coalesce(trunc(amount), 0)::BIGINT AS amount,
  coalesce(trunc(gst), 0)::BIGINT AS gst_amount, coalesce(trunc(refund_amount), 0)::BIGINT AS refund_amount, comment,
  provider AS payment_provider_id, utr AS payment_utr_number, {day('refund_date')} AS refund_date, reason_id AS refund_reason_id,
  coalesce(trunc(refund_amount), 0)::BIGINT AS claim_amount, ids AS temp_payment_ids, '{{"status":"Process By Tech Team"}}' AS tech_response
FROM refunds""", REFUND_TABLES)
def refund_batch(t: Source) -> DataFrame:
    made = refunds.refund_batch(t.crm, refund_requests(t), RUN).refunds
    return made.select(
        "refund_id", "payment_id", "onboarding_id", "contact_id", "external_customer_id",
        "lead_id", "sub_product_id", "type", "received_amount", "amount", "gst_amount",
        "refund_amount", "comment", "payment_provider_id", "payment_utr_number", "refund_date",
        "refund_reason_id", "claim_amount", "temp_payment_ids", "tech_response")


@query("refund_audit", f"""
WITH {REFUND_SQL}
SELECT r.row_id, r.contact_id, r.onboarding_id, r.reason_id, r.amount,
  CASE WHEN failure IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS process_status, coalesce(failure, '') AS remarks, f.refund_id
FROM rows r LEFT JOIN refunds f ON f.contact_id = r.contact_id AND r.failure IS NULL""", REFUND_TABLES)
def refund_audit(t: Source) -> DataFrame:
    audit = refunds.refund_batch(t.crm, refund_requests(t), RUN).audit
    return audit.select("row_id", "contact_id", "onboarding_id", "reason_id", "amount",
                        "process_status", "remarks", "refund_id")


PAYMENT_ASKED = """
dues AS (SELECT lead_id, min(payable_on)::DATE AS due, min(payable_on) FILTER (WHERE instalment_number = 1)::DATE AS d1,
  min(payable_on) FILTER (WHERE instalment_number = 2)::DATE AS d2 FROM crm_instalment GROUP BY lead_id),
asked AS (SELECT l.lead_id AS row_id, CASE WHEN l.lead_id % 31 = 0 THEN 'nobody@example.org' ELSE lower(trim(c.email_address)) END AS email,
    CASE WHEN l.lead_id % 5 = 0 THEN due + 1 ELSE due END AS due, d1, d2, CASE l.lead_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 111 ELSE 166 END AS method,
    CASE WHEN l.lead_id % 17 > 0 THEN (1000 + l.lead_id % 900)::DOUBLE END AS price, (l.lead_id % 100)::DOUBLE AS discount, (900 + l.lead_id % 900)::DOUBLE + 0.5 AS net,
    DATE '2024-01-01' + CAST(l.lead_id % 20 AS INT) AS sold, 'ref' || l.lead_id AS ref
  FROM crm_lead l JOIN dues ON dues.lead_id = l.lead_id JOIN crm_contact c ON c.contact_id = l.contact_id),
emails AS (SELECT lower(trim(email_address)) AS email, min(contact_id) AS contact_id FROM crm_contact GROUP BY 1)"""


def payment_file(t: Source) -> DataFrame:
    """One typed-in row per lead with instalments: e-mail, price, due dates, mode."""
    number = F.col("instalment_number")
    dues = t.crm["instalment"].groupBy("lead_id").agg(
        F.min("payable_on").alias("due"),
        *[F.min(F.when(number == n, F.col("payable_on"))).alias(f"d{n}") for n in (1, 2)])
    rows = t.crm["lead"].select("lead_id", "contact_id").join(dues, "lead_id").join(
        t.crm["contact"].select("contact_id", "email_address"), "contact_id")
    key = F.col("lead_id")
    sold = F.date_add(F.to_date(F.lit("2024-01-01")), (key % 20).cast("int"))
    mode = F.when(key % 8 == 0, "Cash").when(key % 8 == 1, " NEFT").when(
        key % 8 == 2, "Razorpay-New").otherwise("Razorpay ")
    return rows.select(
        key.alias("row_id"), key.alias("lead_id"),
        F.date_format(sold, "dd/MM/yyyy").alias("Sales Table Date"),
        F.when(key % 31 == 0, "nobody@example.org").otherwise(
            F.concat(F.lit(" "), F.upper("email_address"))).alias("Email ID"),
        F.when(key % 17 == 0, F.when(key % 2 == 0, "nan").otherwise("inf")).otherwise(
            F.concat(F.lit("1,"), F.lpad((key % 900).cast("string"), 3, "0"))).alias("Price"),
        (key % 100).cast("string").alias("Discount"),
        F.concat((900 + key % 900).cast("string"), F.lit(".5")).alias("Net Price"),
        F.lit("PMP ").alias("Product"), mode.alias("Mode"),
        F.concat(F.lit("ref"), key.cast("string")).alias("Payment Reference"),
        F.date_format(F.date_add("due", F.when(key % 5 == 0, 1).otherwise(0)), "dd-MM-yyyy")
        .alias("due"),
        *[F.date_format(f"d{n}", "dd/MM/yyyy").alias(f"d{n}") for n in (1, 2)],
        *[F.lit("").alias(name) for name in (
            "Client Name", "Team Head", "Sales Rep.", "Location", "Pmt Type", "Lead No.", "TDS",
            "Gift Shares", "Status")])


def single_requests(t: Source) -> DataFrame:
    rows = payment_file(t).drop("d1", "d2").withColumnRenamed("due", "Due Date").withColumn(
        "User Code", F.when(F.col("row_id") % 6 == 0, "x").otherwise(
            F.col("row_id").cast("string"))).drop("lead_id")
    return offline_payments.clean_file(rows, offline_payments.SINGLE_HEADERS, ["due_date"])


@query("payment_batch", f"""
WITH {PAYMENT_ASKED},
plan_leads AS (SELECT lead_id, contact_id FROM crm_lead WHERE product_id = 1 AND list_contains(sub_product_ids, 4) AND is_active AND status_id >= 6),
matched AS (SELECT a.*, e.contact_id, p.lead_id, i.instalment_id, i.onboarding_id, i.external_customer_id FROM asked a
  LEFT JOIN emails e ON e.email = a.email LEFT JOIN plan_leads p ON p.contact_id = e.contact_id
  LEFT JOIN crm_instalment i ON i.lead_id = p.lead_id AND CAST(i.payable_on AS DATE) = a.due AND i.balance_amount > 0 AND i.payment_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY i.instalment_id NULLS LAST, p.lead_id NULLS LAST) = 1),
judged AS (SELECT *, CASE WHEN instalment_id IS NULL THEN CASE WHEN lead_id IS NULL OR instalment_id IS NULL THEN 'INSTALLMENT NOT FOUND FOR DUE DATE' END
  WHEN method IS NULL THEN 'PAYMENT MODE NOT MAPPED' END AS failure FROM matched)
SELECT row_id, contact_id, lead_id, instalment_id, CASE WHEN failure IS NULL THEN 'PENDING' ELSE 'FAILED' END AS process_status, failure AS remarks,
  CASE WHEN failure IS NULL THEN (SELECT max(offline_payment_id) FROM crm_offline_payment) + row_number() OVER (PARTITION BY failure IS NULL ORDER BY row_id) END AS offline_payment_id,
  CASE WHEN failure IS NULL THEN price::BIGINT END AS amount, CASE WHEN failure IS NULL THEN trunc(net)::BIGINT END AS net_amount,
  CASE WHEN failure IS NULL THEN trunc(discount / price * 100)::BIGINT END AS discount_percentage,
  CASE WHEN failure IS NULL THEN {day('sold')} END AS payment_date FROM judged""",
       ("lead", "contact", "instalment", "offline_payment"))
def payment_batch(t: Source) -> DataFrame:
    done = offline_payments.offline_payment_batch(t.crm, single_requests(t), RUN)
    made = done.payments.select("row_id", "offline_payment_id", "amount", "net_amount",
                                "discount_percentage", "payment_date")
    return done.audit.select("row_id", "contact_id", "lead_id", "instalment_id", "process_status",
                             "remarks").join(made, "row_id", "left")


def wide_requests(t: Source) -> DataFrame:
    rows = payment_file(t)
    dates_in = {"Tranche Due Date": "due", "Tranche Due Date_1": "d1", "Tranche Due Date_2": "d2"}
    blank = ["Tranche Due Date_3", "Tranche Due Date_4", "Tranche no",
             *[f"Tranche no_{n}" for n in range(1, 5)]]
    wide = rows.withColumnsRenamed({old: new for new, old in dates_in.items()}).withColumns(
        {name: F.lit("") for name in blank}).drop("lead_id")
    return offline_payments.clean_file(
        wide, offline_payments.WIDE_HEADERS, offline_payments.TRANCHE_DATES)


WINBACK_SQL = f"""
{PAYMENT_ASKED},
plan_leads AS (SELECT lead_id, contact_id FROM crm_lead WHERE product_id = 1 AND list_contains(sub_product_ids, 4) AND is_active
  AND status_id = 6 AND substatus_id = 29),
resolved AS (SELECT a.*, e.contact_id, p.lead_id FROM asked a LEFT JOIN emails e ON e.email = a.email LEFT JOIN plan_leads p ON p.contact_id = e.contact_id),
long AS (SELECT *, 0 AS place, due AS day FROM resolved UNION ALL SELECT *, 1, d1 FROM resolved UNION ALL SELECT *, 2, d2 FROM resolved),
found AS (SELECT l.*, i.instalment_id, i.onboarding_id, i.external_customer_id FROM long l JOIN crm_instalment i ON i.lead_id = l.lead_id AND CAST(i.payable_on AS DATE) = l.day)"""


@query("winback_batch", f"""
WITH {WINBACK_SQL},
ids AS (SELECT lead_id, sold, array_to_string(list_sort(list(DISTINCT instalment_id)), ',') AS ids FROM found GROUP BY 1, 2),
first AS (SELECT DISTINCT ON (lead_id, sold) * FROM found ORDER BY lead_id, sold, place, row_id, instalment_id)
SELECT (SELECT max(offline_payment_id) FROM crm_offline_payment) + row_number() OVER (ORDER BY row_id, f.lead_id) AS offline_payment_id,
  onboarding_id, contact_id, external_customer_id, f.lead_id, price::BIGINT AS amount, 4 AS sub_product_id, method AS payment_method,
  ref AS payment_utr_number, {day('f.sold')} AS payment_date, trunc(net)::BIGINT AS net_amount, 'Pending' AS status, ids AS instalment_id,
  '{{"source":"Bulk Upload","approved_by":"operations","uploaded_via":"tech team"}}' AS meta_info,
  discount::BIGINT AS discount_amount, trunc(discount / price * 100)::BIGINT AS discount_percentage
FROM first f JOIN ids ON ids.lead_id = f.lead_id AND ids.sold = f.sold""", ("lead", "contact", "instalment", "offline_payment"))
def winback_batch(t: Source) -> DataFrame:
    made = offline_payments.winback_batch(t.crm, wide_requests(t), RUN).payments
    return made.select(
        "offline_payment_id", "onboarding_id", "contact_id", "external_customer_id", "lead_id",
        "amount", "sub_product_id", "payment_method", "payment_utr_number", "payment_date",
        "net_amount", "status", "instalment_id", "meta_info", "discount_amount",
        "discount_percentage")


@query("winback_audit", f"""
WITH {WINBACK_SQL}
SELECT r.row_id, max(r.contact_id) AS contact_id, max(r.lead_id) AS lead_id, min(f.first_id) AS instalment_id,
  coalesce(sum(f.n), 0)::BIGINT AS matches, CASE WHEN min(f.first_id) IS NOT NULL THEN 'Instalment Found' WHEN max(r.lead_id) IS NOT NULL THEN 'Lead Found'
  WHEN max(r.contact_id) IS NOT NULL THEN 'Contact Found' ELSE 'No Match' END AS stage
FROM resolved r LEFT JOIN (SELECT row_id, lead_id, min(instalment_id) AS first_id, count(*) AS n FROM found GROUP BY 1, 2) f
  ON f.row_id = r.row_id AND f.lead_id = r.lead_id GROUP BY r.row_id""", ("lead", "contact", "instalment"))
def winback_audit(t: Source) -> DataFrame:
    return offline_payments.winback_batch(t.crm, wide_requests(t), RUN).audit


@query("unprocessed_extract", f"""
WITH {PAYMENT_ASKED},
plan_leads AS (SELECT lead_id, contact_id FROM crm_lead WHERE product_id = 1 AND list_contains(sub_product_ids, 4) AND is_active
  AND status_id = 6 AND substatus_id = 29)
SELECT a.row_id, a.row_id AS user_code, e.contact_id, p.lead_id, i.instalment_id, i.onboarding_id, {day('a.due')} AS due_date,
  NULL::BIGINT AS offline_payment_id
FROM asked a JOIN emails e ON e.email = a.email JOIN plan_leads p ON p.contact_id = e.contact_id
JOIN crm_instalment i ON i.lead_id = p.lead_id AND CAST(i.payable_on AS DATE) = a.due WHERE a.row_id % 6 <> 0""",
       ("lead", "contact", "instalment"))
def unprocessed_extract(t: Source) -> DataFrame:
    return offline_payments.unprocessed_extract(t.crm, single_requests(t)).select(
        "row_id", "user_code", "contact_id", "lead_id", "instalment_id", "onboarding_id",
        "due_date", "offline_payment_id")


# --- ingestion ----------------------------------------------------------------------------


@query("append_skip_duplicates", """
WITH incoming AS (SELECT l_partkey, l_quantity FROM lineitem),
good AS (SELECT l_partkey FROM incoming WHERE l_quantity >= 3),
fresh AS (SELECT DISTINCT l_partkey FROM good WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25))
SELECT 'inserted' AS outcome, count(*)::BIGINT AS rows FROM fresh
UNION ALL SELECT 'skipped', (SELECT count(*) FROM good) - (SELECT count(*) FROM fresh)
UNION ALL SELECT 'failed', count(*) FROM incoming WHERE l_quantity < 3""")
def append_skip_duplicates(t: Source) -> DataFrame:
    incoming = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_orderkey",
                                 "l_linenumber", "l_quantity")
    return ingest.import_counts(
        incoming, t.part.where("p_size > 25"), ["p_partkey"],
        [F.col("l_orderkey").asc(), F.col("l_linenumber").asc()], F.col("l_quantity") < 3)


@query("appended_rows", """
SELECT l_partkey AS p_partkey, min(l_orderkey) AS l_orderkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY l_partkey""")
def appended_rows(t: Source) -> DataFrame:
    incoming = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_orderkey")
    return ingest.new_rows(incoming, t.part.where("p_size > 25"), ["p_partkey"],
                           [F.col("l_orderkey").asc()])


@query("indexed_import", """
SELECT s_suppkey * 5 AS o_orderkey, CASE WHEN s_suppkey * 5 IN (SELECT o_orderkey FROM orders) THEN 'skipped' ELSE 'inserted' END AS outcome,
  (SELECT count(DISTINCT o_orderkey // 5000) FROM orders)::BIGINT AS files,
  (SELECT count(DISTINCT o_orderkey // 5000) FROM orders) > (SELECT count(DISTINCT o_orderkey // 5000) FROM orders
    WHERE o_orderkey IN (SELECT s_suppkey * 5 FROM supplier)) AS spared FROM supplier""")
def indexed_import(t: Source) -> DataFrame:
    """Few keys against a table of many files: the files that cannot hold one of them are not read."""
    folder, index_path = scratch_path(t.spark, "orders"), scratch_path(t.spark, "orders-index")
    t.orders.select("o_orderkey", F.expr("o_orderkey div 5000").alias("slice")).repartition(
        "slice").write.partitionBy("slice").parquet(folder)
    index = file_index.build_index(t.spark, folder, "o_orderkey", index_path)
    asked = t.supplier.select((F.col("s_suppkey") * 5).alias("o_orderkey"))
    known = file_index.keys_known(t.spark, folder, index, asked, ["o_orderkey"])
    files = index.agg(F.countDistinct("file")).scalar()
    read = file_index.possible_files(index, asked, "o_orderkey").agg(F.count(F.lit(1))).scalar()
    return asked.join(known.withColumn("known", F.lit(True)), "o_orderkey", "left").select(
        "o_orderkey", F.when(F.col("known"), "skipped").otherwise("inserted").alias("outcome"),
        files.alias("files"), (read < files).alias("spared"))


DUMP_COLUMNS = ["id", "full_name", "note", "balance"]


@query("values_dump_ingest", """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'O''Neil, "' || c_name AS full_name,
  CASE WHEN c_custkey % 3 > 0 THEN 'a (b), c; ''' || c_mktsegment || '),(' END AS note,
  CAST(floor(c_acctbal)::BIGINT AS VARCHAR) AS balance, NULL AS failed FROM customer WHERE c_custkey % 50 <> 7
UNION ALL SELECT NULL, NULL, NULL, NULL, '(' || c_custkey || ', ''open, 1)' FROM customer WHERE c_custkey % 50 = 7""")
def values_dump_ingest(t: Source) -> DataFrame:
    """Write the customers as an INSERT dump below the shared folder, one to five tuples on a line,
    and read it back; a line that cannot be read comes out as it is."""
    key = F.col("c_custkey")
    note = F.when(key % 3 > 0, F.concat(
        F.lit("'a (b), c; ''"), F.col("c_mktsegment"), F.lit("),('"))).otherwise("NULL")
    good = F.concat(
        F.lit("("), key.cast("string"), F.lit(", 'O\\'Neil, \""), F.col("c_name"), F.lit("', "),
        note, F.lit(","), F.floor("c_acctbal").cast("string"), F.lit(")"))
    bad = F.concat(F.lit("("), key.cast("string"), F.lit(", 'open, 1)"))
    rows = t.customer.select(
        F.when(key % 50 == 7, -key).otherwise(F.floor(key / 5)).alias("line"), key.alias("at"),
        F.when(key % 50 == 7, bad).otherwise(good).alias("tuple"))
    tuples = F.array_sort(F.collect_list(F.struct("at", "tuple")))["tuple"]
    head = F.when(F.col("line") % 2 == 0, "INSERT INTO c (id, full_name, note, balance) VALUES ")
    lines = rows.groupBy("line").agg(F.array_join(tuples, ", ").alias("text")).select(F.concat(
        head.otherwise(""), "text", F.when(F.col("line") < 0, "").otherwise(";")).alias("value"))
    path = scratch_path(t.spark, "dump")
    lines.write.text(path)
    stored = t.spark.read.text(path)
    failed = F.regexp_replace("text", "^INSERT.*VALUES ", "").alias("failed")
    return dumps.parse_dump(stored, DUMP_COLUMNS).unionByName(
        dumps.failed_lines(stored, DUMP_COLUMNS).select(failed), allowMissingColumns=True)


@query("dump_over_lines", """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'O''Neil, "' || c_name AS full_name,
  CASE WHEN c_custkey % 3 > 0 THEN 'a (b), c;' || chr(10) || '(''' || c_mktsegment || '),' || chr(10) || '-- (' END AS note,
  CAST(floor(c_acctbal)::BIGINT AS VARCHAR) AS balance, NULL AS failed FROM customer WHERE c_custkey % 50 <> 7
UNION ALL SELECT NULL, NULL, NULL, NULL, '(' || c_custkey || ', ''one' || chr(10) || 'two'')' FROM customer WHERE c_custkey % 50 = 7""")
def dump_over_lines(t: Source) -> DataFrame:
    """A dump whose tuples run over several lines in one half of its files and which has no line
    ends between tuples in the other half, read from as many splits as there are."""
    key = F.col("c_custkey")
    note = F.when(key % 3 > 0, F.concat(
        F.lit("'a (b), c;\n(\\'"), F.col("c_mktsegment"), F.lit("),\n-- ('"))).otherwise("NULL")
    good = F.concat(
        F.lit("("), key.cast("string"), F.lit(",\n  'O''Neil, \""), F.col("c_name"), F.lit("',\n  "),
        note, F.lit(",\n"), F.floor("c_acctbal").cast("string"), F.lit("\n)"))
    bad = F.concat(F.lit("("), key.cast("string"), F.lit(", 'one\ntwo')"))
    head = F.when(key % 20 == 0, "; INSERT INTO c (id, full_name, note, balance) VALUES ")
    rows = t.customer.select(key, F.concat(
        head.otherwise(""), F.when(key % 50 == 7, bad).otherwise(good)).alias("value"))
    folder = scratch_path(t.spark, "dump")
    for half, separator in ((0, ","), (1, ",\n")):
        rows.where(F.floor(key / 100) % 2 == half).select("value").write.option(
            "lineSep", separator).text(f"{folder}/half={half}")
    good_rows, failed = dumps.read_dump_checked(t.spark, f"{folder}/*", DUMP_COLUMNS)
    plain = F.regexp_replace("text", r"^[\s,;]*(?:INSERT.*?VALUES )?", "").alias("failed")
    return good_rows.unionByName(failed.select(plain), allowMissingColumns=True)


@query("csv_over_lines", """
SELECT o_orderkey AS row_key, 'one' || chr(10) || '"two", ' || o_custkey || CASE WHEN o_orderkey % 4 = 0 THEN chr(10) || chr(10) || ',Zoë' ELSE '' END AS remark,
  CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS priority, 1::BIGINT AS copies FROM orders""")
def csv_over_lines(t: Source) -> DataFrame:
    """Quoted fields with line breaks through CSV files that Spark reads in splits."""
    path = scratch_path(t.spark, "lines")
    key = F.col("o_orderkey")
    t.orders.select(
        key.alias("Row\nKey"),
        F.concat(F.lit('one\n"two", '), F.col("o_custkey").cast("string"),
                 F.when(key % 4 == 0, "\n\n,Zoë").otherwise("")).alias("Remark"),
        F.when(key % 5 > 0, F.col("o_orderpriority")).alias("Priority")).write.option(
            "header", True).option("escape", '"').csv(path)
    read = cleaning.normalise_headers(files.read_csv_records(t.spark, path), cleaning.snake_header)
    return read.groupBy(F.col("row_key").cast("bigint").alias("row_key"), "remark", "priority").agg(
        F.count(F.lit(1)).alias("copies"))


@query("file_round_trip", """
WITH clean AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 1 THEN 'user' || o_custkey || '@x.org' END AS email,
  CASE WHEN o_orderkey % 8 > 0 THEN floor(o_totalprice) + 0.5 END AS amount,
  CASE WHEN o_orderkey % 6 > 0 THEN strftime(make_date(2001, CAST(1 + o_orderkey % 12 AS INT), CAST(1 + o_orderkey % 28 AS INT)), '%Y-%m-%d') END AS due FROM orders)
SELECT *, 1::BIGINT AS copies FROM clean""")
def file_round_trip(t: Source) -> DataFrame:
    """Dirty rows out as Latin-1 CSV, back as text with a dense file-order id, then coerced."""
    from entry_queries.value_queries import dirty_rows

    folder = scratch_path(t.spark, "csv")
    path = f"{folder}/run_id=1"
    dirty_rows(t).select("o_orderkey", "email", "amount", "due").write.option(
        "header", True).option("encoding", files.LATIN).option("escape", '"').csv(path)
    raw = files.read_csv_text(t.spark, path, files.LATIN)
    numbered = files.with_file_row_id(raw)
    once = numbered.groupBy("row_id").agg(F.count(F.lit(1)).alias("copies"))
    return numbered.join(once, "row_id").select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        cleaning.null_if_token("email").alias("email"), cleaning.number("amount").alias("amount"),
        cleaning.day_first_date("due").alias("due"), "copies")


@query("utf8_csv", """
SELECT c_custkey AS row_key, 'Zoë ' || c_name AS who, CAST(c_acctbal AS VARCHAR) AS balance, 1::BIGINT AS copies FROM customer""")
def utf8_csv(t: Source) -> DataFrame:
    """Names beyond ASCII through a UTF-8 file with a byte-order mark and an untidy header."""
    path = scratch_path(t.spark, "utf8")
    t.customer.select(
        F.col("c_custkey").alias("﻿Row  Key"), F.concat(F.lit("Zoë "), "c_name").alias("Who"),
        F.col("c_acctbal").alias("Balance")).write.option("header", True).csv(path)
    read = cleaning.normalise_headers(files.read_csv_text(t.spark, path), cleaning.snake_header)
    numbered = files.with_file_row_id(read)
    once = numbered.groupBy("row_id").agg(F.count(F.lit(1)).alias("copies"))
    return numbered.join(once, "row_id").select(
        F.col("row_key").cast("bigint").alias("row_key"), "who", "balance", "copies")


@query("format_dispatch", """
SELECT fmt, p_partkey, p_name, CAST(p_size AS VARCHAR) AS size FROM part, (VALUES ('csv'), ('json'), ('parquet')) f(fmt)""")
def format_dispatch(t: Source) -> DataFrame:
    """The same rows through each readable format, chosen by extension or by name."""
    rows = t.part.select("p_partkey", "p_name", F.col("p_size").cast("string").alias("size"))
    out = {}
    for fmt in ("csv", "json", "parquet"):
        path = f"{scratch_path(t.spark, 'format')}.{fmt}"
        rows.write.option("header", True).format(fmt).save(path)
        read = files.read_table(t.spark, path, fmt if fmt == "json" else None)
        out[fmt] = read.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "size")
    return unions.tagged(out, "fmt")


@query("audit_sink", """
SELECT run, CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey || ' | ' || (s_suppkey + 1) ELSE CAST(s_suppkey AS VARCHAR) END AS leads
FROM supplier, (VALUES ('a'), ('b')) r(run) WHERE run = 'a' OR s_suppkey % 2 = 0""")
def audit_sink(t: Source) -> DataFrame:
    """Audit rows with lists go to one folder per run; a repeated run replaces its own folder only."""
    key = F.col("s_suppkey")
    ids = F.when(key % 3 == 0, F.array(key, key + 1)).otherwise(F.array(key))
    rows = t.supplier.select(key.alias("id"), ids.alias("leads"))
    folder = scratch_path(t.spark, "audit")
    audit.write_audit(rows.where(key < 3), folder, "a")
    audit.write_audit(rows, folder, "a")
    files.write_run(rows.where(key % 2 == 0).withColumn("leads", F.array_join(
        F.col("leads").cast("array<string>"), " | ")), folder, "b", "csv")
    read = t.spark.read.option("header", True).csv(folder)
    return read.select(F.col("run_id").alias("run"), "id", "leads")


@query("published_report", """
SELECT n_name, count(*)::BIGINT AS customers, sum(CAST(c_acctbal AS DECIMAL(18,2)))::DOUBLE AS balance, 'v2' AS version
FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def published_report(t: Source) -> DataFrame:
    """A report published under a name, replaced by its next version, and read by another session."""
    name, folder = f"report_{uuid.uuid4().hex}", scratch_path(t.spark, "published")
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    first = rows.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))
    second = rows.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), measures.money("c_acctbal").alias("balance"))
    files.publish_version(first, name, "v1", folder)
    files.publish_version(second, name, "v2", folder)
    files.publish_version(first, name, "v2", folder)  # known already
    other = t.spark.newSession()
    version = files.published_version(other, name)
    return t.spark.table(name).withColumn("version", F.lit(version))


@query("schema_facts", """
SELECT 'nation' AS table_name, name AS column_name, ordinal, kind AS data_type, (SELECT count(*) FROM nation) AS total,
  (SELECT count(*) FROM region) AS regions
FROM (VALUES ('n_nationkey', 1, 'int'), ('n_name', 2, 'string'), ('n_regionkey', 3, 'int')) f(name, ordinal, kind)""")
def schema_facts(t: Source) -> DataFrame:
    """Columns of a table with position and type, next to the rows counted in the tables."""
    columns = schema.describe(t.spark, {"nation": t.nation, "region": t.region}).where(
        F.col("table_name").like("nat%"))
    return columns.withColumns({
        "total": t.nation.agg(F.count(F.lit(1))).scalar(),
        "regions": t.region.agg(F.count(F.lit(1))).scalar()})


@query("collection_requests", """
WITH asked AS (SELECT c_custkey AS row_id, CASE WHEN c_custkey % 11 = 0 THEN 'x' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS instalment,
    lower(trim(email_address)) AS email, 'owner' || (c_custkey % 12) || '@example.org' AS rm_email, 'owner ' || (c_custkey % 9) AS counsellor
  FROM customer JOIN crm_contact ON contact_id = c_custkey),
old_rm AS (SELECT lower(trim(email_address)) AS rm_email, max(user_id) AS old_rm_id FROM crm_mst_user WHERE is_active GROUP BY 1),
new_rm AS (SELECT lower(trim(full_name)) AS counsellor, max(user_id) AS new_rm_id FROM crm_mst_user WHERE is_active GROUP BY 1),
people AS (SELECT lower(trim(email_address)) AS email, contact_id FROM crm_contact),
contracts AS (SELECT contact_id, lead_id FROM crm_onboarding WHERE status_id >= 6 AND substatus_id = 29 AND sub_product_id = 4)
SELECT DISTINCT lead_id, old_rm_id, new_rm_id FROM asked JOIN old_rm USING (rm_email) JOIN new_rm USING (counsellor)
JOIN people USING (email) JOIN contracts USING (contact_id) WHERE regexp_full_match(instalment, '[0-9]+')""",
       ("contact", "mst_user", "onboarding"))
def collection_requests(t: Source) -> DataFrame:
    """A typed-in reassignment file to (lead, old owner, new owner)."""
    key = F.col("c_custkey")
    rows = t.customer.join(t.crm["contact"], key == F.col("contact_id")).select(
        F.when(key % 11 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise(
            F.concat(key.cast("string"), F.lit(" "))).alias(" Instalment  ID"),
        F.concat(F.lit(" "), F.upper("email_address")).alias("Cutomer_Email"),
        F.concat(F.lit("Owner"), (key % 12).cast("string"), F.lit("@Example.org ")).alias("RM Email"),
        F.concat(F.lit(" owner "), (key % 9).cast("string")).alias("Counsellor"))
    return collections.collection_requests(t.crm, rows)


@query("refund_rows", f"""
WITH {REFUND_SQL},
good AS (SELECT * FROM rows WHERE failure IS NULL)
SELECT (SELECT max(refund_id) FROM crm_refund) + row_number() OVER (ORDER BY g.row_id) AS refund_id, g.row_id, p.payment_id, g.onboarding_id,
  g.contact_id, p.customer AS external_customer_id, p.lead_id, p.plan AS sub_product_id, coalesce(trunc(g.amount_paid), 0)::BIGINT AS received_amount,
  coalesce(trunc(g.amount), 0)::BIGINT AS amount, coalesce(trunc(g.refund_amount), 0)::BIGINT AS refund_amount, ' ' || concern AS comment,
  utr AS payment_utr_number, {day('refund_date')} AS refund_date, reason_id AS refund_reason_id, ids AS temp_payment_ids
FROM good g JOIN pays p ON p.onboarding_id = g.onboarding_id""", REFUND_TABLES)
def refund_rows(t: Source) -> DataFrame:
    """The form without grouping: one refund per valid request row."""
    made = refunds.refund_batch(t.crm, refund_requests(t), RUN, per_row=True).refunds
    return made.select(
        "refund_id", "row_id", "payment_id", "onboarding_id", "contact_id", "external_customer_id",
        "lead_id", "sub_product_id", "received_amount", "amount", "refund_amount", "comment",
        "payment_utr_number", "refund_date", "refund_reason_id", "temp_payment_ids")
