"""Invariants of the change transforms on small hand-made tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.operators import audit, changes
from tallyroute.operators.changes import DRY_RUN, Run

NOW = datetime(2024, 2, 5, 12)
OLD = datetime(2024, 1, 1)
RUN = Run(NOW)
LEAD = ("lead_id BIGINT, lead_number BIGINT, contact_id BIGINT, rm_id BIGINT, product_id INT,"
        " sub_product_ids ARRAY<INT>, lead_source_id INT, status_id INT, substatus_id INT,"
        " is_active BOOLEAN, company_id INT, created_at TIMESTAMP_NTZ, created_by BIGINT,"
        " updated_at TIMESTAMP_NTZ, updated_by BIGINT")
MAPPING = ("mapping_id BIGINT, contact_id BIGINT, lead_id BIGINT, rm_id BIGINT, type STRING,"
           " is_transferred BOOLEAN, from_date DATE, end_date TIMESTAMP_NTZ, company_id INT,"
           " created_at TIMESTAMP_NTZ, created_by BIGINT, updated_at TIMESTAMP_NTZ,"
           " updated_by BIGINT")
BACKUP = ("lead_id BIGINT, rm_id BIGINT, old_rm_id BIGINT, status_id INT, substatus_id INT,"
          " mapping_id BIGINT, created_at TIMESTAMP_NTZ, session_id BIGINT")


def leads(spark, *specs):
    return spark.createDataFrame(
        [(i, 100 + i, c, rm, 1, [4], 1, 2, 5, True, 1, OLD, 1, OLD, 1) for i, c, rm in specs], LEAD)


def mappings(spark, *specs, kind="Sales"):
    return spark.createDataFrame(
        [(m, c, lead, rm, kind, False, date(2024, 1, 1), None if is_open else OLD, 1, OLD, 1, OLD, 1)
         for m, c, lead, rm, is_open in specs], MAPPING)


def moves(spark, *pairs):
    return spark.createDataFrame(list(pairs), "lead_id BIGINT, new_rm_id BIGINT")


def backup(spark):
    return spark.createDataFrame([], BACKUP)


def test_transfer_closes_latest_and_opens_one(spark):
    lead = leads(spark, (1, 10, 5), (2, 11, 5))
    mapping = mappings(spark, (1, 10, 1, 5, True), (2, 10, 1, 5, True), (3, 11, 2, 6, True))
    done = changes.transfer_leads(lead, mapping, backup(spark), moves(spark, (1, 9), (2, 9)), RUN)
    state = {r.mapping_id: r for r in done.contact_mapping.collect()}
    assert state[2].end_date == NOW and state[2].is_transferred
    assert state[1].end_date is None and state[3].end_date is None  # older one, other owner
    assert (state[4].lead_id, state[4].rm_id, state[4].end_date) == (1, 9, None)
    assert (state[5].lead_id, state[5].rm_id) == (2, 9)
    assert {r.rm_id for r in done.lead.collect()} == {9}
    assert rows(done.backup.select("lead_id", "old_rm_id", "mapping_id", "session_id")) == [
        (1, 5, 4, 1), (2, 5, 5, 1)]


def test_moves_by_contact_close_one_mapping_each(spark):
    lead = leads(spark, (1, 10, 5), (2, 10, 5))
    mapping = mappings(spark, (1, 10, 1, 5, True), (2, 10, 2, 5, True), (3, 10, 2, 5, True))
    done = changes.transfer_leads(lead, mapping, backup(spark), moves(spark, (1, 9), (2, 9)), RUN,
                                  match="contact_id", reuse_open=True)
    closed = {r.mapping_id for r in done.contact_mapping.where("end_date IS NOT NULL").collect()}
    assert closed == {2, 3}
    opened = done.contact_mapping.where("rm_id = 9").collect()
    assert len(opened) == 1  # the second lead reuses the mapping the first one opened
    assert {r.new_mapping_id for r in done.audit.collect()} == {opened[0].mapping_id}


def test_existing_open_mapping_is_reused(spark):
    lead = leads(spark, (1, 10, 5))
    mapping = mappings(spark, (1, 10, 1, 5, True), (2, 10, 7, 9, True))
    done = changes.transfer_leads(lead, mapping, backup(spark), moves(spark, (1, 9)), RUN,
                                  match="contact_id", reuse_open=True)
    assert done.contact_mapping.count() == 2
    assert done.audit.first().new_mapping_id == 2


def test_second_run_moves_nothing(spark):
    lead = leads(spark, (1, 10, 5), (2, 11, 5), (3, 12, 6))
    mapping = mappings(spark, (1, 10, 1, 5, True))

    def run(lead, mapping, log):
        pool = changes.transferable(lead, RUN, owners=[5]).select("lead_id")
        chosen = pool.withColumn("new_rm_id", F.lit(9).cast("bigint"))
        return chosen.count(), changes.transfer_leads(lead, mapping, log, chosen, RUN)

    moved, first = run(lead, mapping, backup(spark))
    again, second = run(first.lead, first.contact_mapping, first.backup)
    assert (moved, again) == (2, 0)
    assert second.contact_mapping.count() == first.contact_mapping.count()


def test_stale_leads_stay(spark):
    fresh = leads(spark, (1, 10, 5)).withColumn("substatus_id", F.lit(10))
    old = leads(spark, (2, 11, 5)).withColumns(
        {"substatus_id": F.lit(11), "updated_at": F.lit(datetime(2023, 12, 6, 12)).cast("timestamp_ntz")})
    excluded = leads(spark, (3, 12, 5)).withColumn("sub_product_ids", F.array(F.lit(23)))
    unknown = leads(spark, (4, 13, 5)).withColumn(
        "sub_product_ids", F.lit(None).cast("array<int>"))
    pool = fresh.unionByName(old).unionByName(excluded).unionByName(unknown)
    assert rows(changes.transferable(pool, RUN).select("lead_id")) == [(1,)]


def test_next_number_of_empty_table(spark):
    assert spark.range(1).select(changes.next_number(backup(spark), "session_id")).first()[0] == 1


def test_matched_update_needs_the_whole_key(spark):
    table = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "id INT, lead INT, v INT")
    asked = spark.createDataFrame([(1, 1, 5), (2, 9, 6)], "id INT, lead INT, v INT")
    new, log = changes.matched_update(table, asked, ["id", "lead"], ["v"])
    assert rows(new) == [(1, 1, 5), (2, 1, 0)]
    assert rows(log.select("id", "matched")) == [(1, True), (2, False)]


def test_last_request_of_a_file_counts(spark):
    asked = spark.createDataFrame([(1, 7, "a"), (2, 7, "b"), (3, 8, "c")],
                                  "row_id INT, lead_id INT, who STRING")
    assert rows(changes.last_request(asked, ["lead_id"], "row_id")) == [(2, 7, "b"), (3, 8, "c")]


def test_repeated_contact_keeps_one_waiting_lead(spark):
    empty_follow = spark.createDataFrame([], (
        "follow_up_id BIGINT, lead_id BIGINT, contact_id BIGINT, rm_id BIGINT, status_id INT,"
        " substatus_id INT, follow_up TIMESTAMP_NTZ, is_completed BOOLEAN"))
    waiting = leads(spark, (1, 10, 5)).withColumns(
        {"lead_source_id": F.lit(57), "status_id": F.lit(1), "substatus_id": F.lit(2)})
    asked = spark.createDataFrame([(0, 10, 9, 1, 1, 4), (1, 10, 9, 2, 1, 4), (2, 11, 9, 3, 1, 4)], (
        "row_id BIGINT, contact_id BIGINT, rm_id BIGINT, lead_number BIGINT, product_id INT,"
        " sub_product_id INT"))
    made = changes.create_leads(waiting, empty_follow, mappings(spark), asked, RUN)
    assert rows(made.lead.select("lead_id", "contact_id", "is_active")) == [
        (1, 10, False), (2, 10, False), (3, 10, True), (4, 11, True)]
    assert rows(made.ids.select("row_id", "lead_id", "follow_up_id", "mapping_id")) == [
        (0, 2, 1, 1), (1, 3, 2, 2), (2, 4, 3, 3)]


def test_dry_run_changes_nothing_and_says_so(spark):
    task = spark.createDataFrame([(1, 5, 7, True, None)], (
        "lead_id BIGINT, rm_id BIGINT, follow_up_id BIGINT, is_completed BOOLEAN,"
        " completed_on TIMESTAMP_NTZ"))
    case = spark.createDataFrame([(1, 5, 3, 7, 43, 18)], (
        "lead_id BIGINT, assigned_to BIGINT, payment_collection_id BIGINT, status_id INT,"
        " substatus_id INT, department_id INT"))
    asked = spark.createDataFrame([(1, 5, 9), (2, 5, 9)],
                                  "lead_id BIGINT, old_rm_id BIGINT, new_rm_id BIGINT")
    t, c, log = changes.reassign_collections(task, case, asked, Run(NOW, mode=DRY_RUN))
    assert rows(t) == rows(task) and rows(c) == rows(case)
    assert {r.lead_id: r.status for r in log.collect()} == {
        1: "ready (dry run)", 2: "follow_up not available"}
    t, c, log = changes.reassign_collections(task, case, asked, RUN)
    assert (t.first().rm_id, t.first().is_completed, c.first().assigned_to,
            c.first().department_id) == (9, False, 9, 20)


def test_write_back_and_settle(spark):
    base = spark.createDataFrame([(1, "PENDING", None), (2, "FAILED", "X")],
                                 "id INT, process_status STRING, remarks STRING")
    assert rows(audit.settle(base, RUN).select("id", "process_status", "remarks")) == [
        (1, "SUCCESS", "TRANSFERRED"), (2, "FAILED", "X")]
    assert audit.settle(base, Run(NOW, mode=DRY_RUN)).first().remarks == "TRANSFERRED (DRY RUN)"
    result = spark.createDataFrame([(1, "SUCCESS", 77)], "id INT, process_status STRING, new_id INT")
    assert rows(changes.write_back(base, result, "id", ["process_status", "new_id"])) == [
        (1, None, "SUCCESS", 77), (2, "X", "FAILED", None)]


@pytest.mark.parametrize("open_other", [True, False])
def test_restore_follows_open_mapping_or_reopens(spark, open_other):
    mapping = mappings(spark, (1, 10, 1, 5, False), (2, 10, 1, 6, open_other))
    lead = leads(spark, (1, 10, 99))
    log = spark.createDataFrame([(1, 1, 4, OLD, True, OLD, 1, datetime(2023, 1, 1)),
                                 (2, 1, 8, OLD, True, OLD, 1, datetime(2024, 1, 20))], (
        "log_id BIGINT, mapping_id BIGINT, rm_id BIGINT, end_date TIMESTAMP_NTZ,"
        " is_transferred BOOLEAN, updated_at TIMESTAMP_NTZ, updated_by BIGINT,"
        " log_timestamp TIMESTAMP_NTZ"))
    broken = spark.createDataFrame([(1, 1)], "mapping_id BIGINT, lead_id BIGINT")
    new, owners, report = changes.restore_mappings(mapping, log, lead, broken, datetime(2024, 1, 10))
    state = {r.mapping_id: r for r in new.collect()}
    assert state[1].rm_id == 4  # the entry before the cutoff, not the later one
    assert (state[1].end_date is None) is not open_other
    assert owners.first().rm_id == (6 if open_other else 4)
    assert report.first().outcome == ("restored" if open_other else "reopened")


def test_a_delta_holds_the_new_and_changed_rows_only(spark):
    """Merged into the tables it gives what a whole run gives."""
    lead = spark.createDataFrame(
        [(i, 100 + i, 1 + i % 2, 1, 2) for i in range(6)],
        "lead_id BIGINT, contact_id BIGINT, rm_id BIGINT, status_id INT, substatus_id INT")
    moves = spark.createDataFrame([(1, 9), (4, 8)], "lead_id BIGINT, new_rm_id BIGINT")
    updated = changes.update_rows(lead, "lead_id", moves, {"rm_id": F.col("new_rm_id")})
    delta = changes.update_rows(
        lead, "lead_id", moves, {"rm_id": F.col("new_rm_id")}, changed_only=True)
    assert delta.count() == 2 and delta.columns == lead.columns
    assert rows(changes.merged(lead, delta, "lead_id")) == rows(updated)
    run = changes.Run(datetime(2024, 1, 1), delta=True)
    assert changes.kept_rows(lead, run).count() == 0
