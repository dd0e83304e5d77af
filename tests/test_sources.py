"""Files, dumps, ingestion, schema facts and audit sinks."""

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, rows
from tallyroute.operators import audit, lookup, unions
from tallyroute.operators.validate import Check, all_failures, first_failure, last_failure
from tallyroute.session import cut_lineage, shared_dir
from tallyroute.sources import database, dumps, files, ingest, schema


def test_latin_csv_keeps_text_and_order(spark, tmp_path):
    text = "﻿Lead  Number,Name\n 007 ,René\nnan,\"a, \"\"b\"\"\"\n".encode("utf-8")
    path = tmp_path / "in.csv"
    path.write_bytes(text.replace("é".encode(), b"\xe9"))
    df = files.read_table(spark, str(path), encoding=files.LATIN)
    assert df.columns == ["Lead Number", "Name"]
    assert rows(files.with_file_row_id(df, first=2).select("row_id", "Lead Number", "Name")) == [
        (2, " 007 ", "René"), (3, "nan", 'a, "b"')]


def test_row_id_is_dense_over_many_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(100, numPartitions=5).write.option("header", True).csv(path)
    df = files.with_file_row_id(files.read_csv_text(spark, path))
    assert [r[0] for r in rows(df.select(F.col("row_id")))] == sorted(range(100), key=str)


def test_lines_with_other_field_counts_are_kept_in_sight(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id, Full Name\n1,a\n2,b,c\n3\n4,"d,e"\n')
    df = files.read_csv_checked(spark, str(path))
    assert df.columns == ["id", "Full Name", files.UNREAD]
    assert rows(df) == [("1", "a", None), ("2", "b", "2,b,c"), ("3", None, "3"), ("4", "d,e", None)]


def test_unknown_format_raises(spark):
    with pytest.raises(ValueError, match="xlsx"):
        files.read_table(spark, "/tmp/a.xlsx")


def test_dump_text(spark, tmp_path):
    head = "INSERT INTO t (id, `name`, note) VALUES"
    path = tmp_path / "d.sql"
    path.write_text(head + "\n(1, 'O\\'Neil, x', NULL),\n(2, '', 'a (b), c;'),\n(3,'null','z');\n")
    columns = dumps.dump_columns(head)
    assert columns == ["id", "name", "note"]
    assert rows(dumps.read_dump(spark, str(path), columns)) == [
        ("1", "O'Neil, x", None), ("2", None, "a (b), c;"), ("3", None, "z")]


def test_dump_with_many_tuples_on_a_line(spark):
    lines = [
        "INSERT INTO t (a, b) VALUES (1,'x'),(2,'y'),(3,'z');", "(5,'q'),(6,'r');", ",(7, NULL)",
        "  (8, 'it''s'), (9, 'c\\\\d\\'e') , (10, '(,)''),(')", "-- note", "", "UNLOCK TABLES;",
        "(11, 'open),(12,'x')", "(13)", "(14, 1, 2),(15, 3)", "garbage (1,2)", "(16,'a' 'b')",
        "(17,)", "('" + "y" * 20_000 + "', 18)"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert rows(dumps.parse_dump(df, ["a", "b"])) == sorted([
        ("1", "x"), ("2", "y"), ("3", "z"), ("5", "q"), ("6", "r"), ("7", None), ("8", "it's"),
        ("9", "c\\d'e"), ("10", "(,)'),("), ("15", "3"), ("17", None), ("y" * 20_000, "18")],
        key=lambda r: tuple(map(str, r)))
    assert sorted(r[0] for r in dumps.failed_lines(df, ["a", "b"]).collect()) == sorted([
        "(11, 'open),(12,'x')", "(13)", "(14, 1, 2)", "garbage (1,2)", "(16,'a' 'b')"])


def test_import_counts(spark):
    incoming = spark.createDataFrame([(1, 0), (1, 1), (2, 2), (None, 3), (5, 4), (7, 5)],
                                     "k INT, n INT")
    target = spark.createDataFrame([(2,)], "k INT")
    counts = ingest.import_counts(incoming, target, ["k"], [F.col("n").asc()], F.col("k") == 7)
    assert dict(rows(counts)) == {"inserted": 2, "skipped": 2, "failed": 2}
    assert rows(ingest.new_rows(incoming, target, ["k"], [F.col("n").asc()])) == [
        (1, 0), (5, 4), (7, 5)]


def test_database_options():
    options = database.read_options("jdbc:x", "t", column="id", lower=0, upper=10, partitions=64)
    assert options["numPartitions"] == "10" and options["partitionColumn"] == "id"
    assert "partitionColumn" not in database.read_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        database.read_options("jdbc:x", "t", column="id", lower=5, upper=5)


def test_schema_facts(spark):
    df = spark.createDataFrame([(1, "a")], "id INT, amount_paid STRING")
    facts = schema.describe(spark, {"t": df})
    assert rows(facts.where(F.col("column_name").like("%amount%"))) == [
        ("t", "amount_paid", 2, "string")]
    assert rows(schema.contract(df, ["id", "gone"])) == [
        ("amount_paid", "extra", 1, 1), ("gone", "missing", 0, 1), ("id", "required", 1, 1)]


def test_status_policies(spark):
    df = spark.createDataFrame([(None, None), (1, None), (None, 1), (1, 1)], "a INT, b INT")
    checks = [Check("A", F.col("a").isNull()), Check("B", F.col("b").isNull())]

    def remarks(result):
        return [r.remarks for r in result.orderBy("a", "b").collect()]

    assert remarks(first_failure(df, checks)) == ["A", "A", "B", None]
    assert remarks(last_failure(df, checks)) == ["B", "A", "B", None]
    assert rows(all_failures(df, checks).select(F.size("errors"))) == [(0,), (1,), (1,), (2,)]


def test_audit_sink_replaces_only_its_run(spark, tmp_path):
    df = spark.createDataFrame([(1, ["x", "y"])], "id INT, ids ARRAY<STRING>")
    for _ in range(2):
        path = audit.write_audit(df, str(tmp_path), "r1")
    audit.write_audit(df, str(tmp_path), "r2")
    assert rows(spark.read.option("header", True).csv(path)) == [("1", "x | y")]
    assert spark.read.option("header", True).csv(str(tmp_path)).count() == 2


def test_left_array_join_keeps_unmatched_once(spark):
    fact = spark.createDataFrame([(1, [1, 1, 9]), (2, [8, 9]), (3, None), (4, [1, 2])],
                                 "id INT, ids ARRAY<INT>")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "d INT, name STRING")
    found = lookup.array_member_left_join(fact, "id", "ids", dim, "d").select("id", "d", "name")
    assert rows(found) == [(1, 1, "a"), (2, None, None), (3, None, None), (4, 1, "a"), (4, 2, "b")]


def test_many_left_join_keeps_lonely_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k INT, who STRING")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 12), (None, 13)], "k INT, v INT")
    assert rows(lookup.many_left_join(left, right, ["k"])) == [
        (1, "a", 10), (1, "a", 11), (2, "b", None), (None, "c", None)]


def test_anti_join_survives_a_null_key(spark):
    left = spark.createDataFrame([(1,), (2,)], "k INT")
    right = spark.createDataFrame([(1,), (None,)], "k INT")
    assert rows(lookup.without(left, right, ["k"])) == [(2,)]


def test_column_differences(spark):
    a, b = spark.range(1).toDF("x"), spark.range(1).toDF("y")
    assert unions.column_differences(a, b) == {"missing": ["x"], "extra": ["y"]}


def test_lineage_is_cut_in_the_shared_folder(spark):
    assert shared_dir(spark)
    plan = cut_lineage(spark.range(5))._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan


def test_summary_comes_from_the_pass_that_writes(spark, tmp_path):
    df = spark.range(10).select("id", F.when(F.col("id") % 3 == 0, "SUCCESS").otherwise(
        "failed").alias("transfer_status"), F.array("id").alias("ids"))
    path, summary = audit.write_with_summary(df, str(tmp_path), "r1")
    assert rows(summary) == [("r1", 10, 4, 6)]
    assert rows(audit.run_summary(df, "r1")) == rows(summary)
    assert spark.read.option("header", True).csv(path).count() == 10
    assert rows(audit.write_with_summary(df.limit(0), str(tmp_path), "r2")[1]) == [("r2", 0, 0, 0)]


def test_published_versions(spark, tmp_path):
    name = "report_of_tests"
    first = spark.createDataFrame([(1, "a")], "id INT, who STRING")
    try:
        assert files.published_version(spark, name) is None
        assert files.publish_version(first, name, "v1", str(tmp_path))
        assert not files.publish_version(first.limit(0), name, "v1", str(tmp_path))
        other = spark.newSession()
        assert rows(other.table(name)) == [(1, "a")]
        assert files.publish_version(first.withColumn("n", F.lit(2)), name, "v2", str(tmp_path))
        assert rows(other.table(name)) == [(1, "a", 2)]
        assert files.published_version(other, name) == "v2"
        for worse in (first, first.withColumn("n", F.lit("2"))):
            with pytest.raises(ValueError, match="n"):
                files.publish_version(worse, name, "v3", str(tmp_path))
        assert files.published_version(spark, name) == "v2"
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}")


def test_a_cluster_names_the_file_system_of_its_shared_folder():
    from types import SimpleNamespace

    def session(master, conf, held=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: held)
        return SimpleNamespace(
            sparkContext=context, conf=SimpleNamespace(get=lambda name, default: conf))

    for folder in ("hdfs://nn/x", "file:/shared/x", "s3a://b/x"):
        assert shared_dir(session("yarn", folder)) == folder
        assert shared_dir(session("yarn", None, folder)) == folder
    assert shared_dir(session("local[2]", "/tmp/x")) == "/tmp/x"
    for master, conf in (("yarn", "/tmp/x"), ("local-cluster[2,1,512]", "x"), ("yarn", None)):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master, conf))


def test_a_path_without_file_system_is_taken_as_spark_completed_it():
    from types import SimpleNamespace

    held = "file:/shared/0b1c"
    context = SimpleNamespace(master="local-cluster[3,4,1024]", getCheckpointDir=lambda: held)
    for conf in ("/shared", "shared", None):
        session = SimpleNamespace(
            sparkContext=context, conf=SimpleNamespace(get=lambda name, default, conf=conf: conf))
        assert shared_dir(session) == held


def test_scratch_folders_of_a_cluster_lie_below_the_completed_path():
    from types import SimpleNamespace

    from tallyroute.session import scratch_path

    context = SimpleNamespace(master="local-cluster[3,4,1024]", applicationId="app-1",
                              getCheckpointDir=lambda: "file:/shared/0b1c")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(
        get=lambda name, default: "/shared"))
    first, second = scratch_path(session, "audit"), scratch_path(session, "audit")
    assert first != second
    assert all(path.startswith("file:/shared/0b1c/app-1/audit-") for path in (first, second))


def test_merged_partitions_stay_small(spark):
    from tallyroute import prepare
    from tallyroute.session import PARTITION_BYTES

    session, name = spark.newSession(), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for held in ("64MB", "67108864b", "1g", str(PARTITION_BYTES + 1)):
        session.conf.set(name, held)
        assert prepare(session).conf.get(name) == str(PARTITION_BYTES)
    for held in ("8m", "4096kb", "1048576b", str(PARTITION_BYTES)):
        session.conf.set(name, held)
        assert prepare(session).conf.get(name) == held


def test_a_cluster_with_a_plain_path_stores_and_reads(tmp_path):
    import subprocess
    import sys

    code = f"""
from pyspark.sql import SparkSession
from tallyroute.session import stored
spark = SparkSession.builder.config(map={{
    "spark.master": "local-cluster[1,1,1024]", "spark.executor.memory": "512m", "spark.ui.enabled": "false",
    "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": {str(tmp_path / 'shared')!r}}}).getOrCreate()
df = stored(spark.range(10), "ten")
print("read", df.count(), df.inputFiles()[0])
spark.stop()
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                         timeout=120)
    assert "read 10 file:" in run.stdout and str(tmp_path / "shared") in run.stdout, run.stderr


def test_queries_that_store_rows_run_on_a_cluster_with_a_plain_path(tmp_path):
    import subprocess
    import sys

    import duckdb

    tables = {
        "part": "SELECT i AS p_partkey, 'part ' || i AS p_name, CAST(i % 50 AS INT) AS p_size",
        "orders": "SELECT i AS o_orderkey, i % 7 AS o_custkey, '1-URGENT' AS o_orderpriority",
        "nation": "SELECT CAST(i AS INT) AS n_nationkey, 'nation ' || i AS n_name",
        "customer": "SELECT i AS c_custkey, CAST(i % 5 AS INT) AS c_nationkey, i / 4 AS c_acctbal",
        "events": "SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_minutes(i) AS ts,"
                  " i % 9 AS user_id, 'view' AS event_type, i / 2 AS value, '{}' AS props"}
    names = ("format_dispatch", "csv_over_lines", "published_report", "keyed_update_versions")
    for table, sql in tables.items():
        duckdb.execute(f"COPY ({sql} FROM range(60) r(i)) TO '{tmp_path / table}.parquet'")
    code = f"""
import sys
sys.path.insert(0, "tests")
import duckdb
from pyspark.sql import SparkSession
import __spark_entry__ as entry
from compare import compare
spark = SparkSession.builder.config(map={{
    "spark.master": "local-cluster[1,2,1024]", "spark.executor.memory": "768m", "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "2", "spark.driver.host": "127.0.0.1",
    "spark.sql.warehouse.dir": {str(tmp_path / 'warehouse')!r},
    "spark.checkpoint.dir": {str(tmp_path / 'shared')!r}}}).getOrCreate()
con = duckdb.connect()
for table in {list(tables)!r}:
    con.execute(f"CREATE VIEW {{table}} AS SELECT * FROM '{tmp_path}/{{table}}.parquet'")
for name in {names!r}:
    verdict, _, n = compare(spark, con, {str(tmp_path)!r}, name, entry.queries()[name], entry.oracle_sql()[name])
    print("found", name, n > 0, verdict)
spark.stop()
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                         timeout=240)
    found = [line for line in run.stdout.splitlines() if line.startswith("found ")]
    assert found == [f"found {name} True ok" for name in names], run.stdout + run.stderr
