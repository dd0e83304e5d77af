"""Run every registered query on Spark and its oracle on DuckDB and compare the values.

``python tests/compare.py [folder] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("tallyroute")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


#: nodes no registered plan should contain, but for the corpus operators (``op``, ``pipeline``)
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
            "MapInPandas", "FlatMapGroupsInPandas", "PythonRDD")


def plan_flags(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [node for node in UNWANTED if node in text]


def compare(spark, con, folder: str, name: str, plan, sql: str | None) -> tuple[str, float, int]:
    started = time.time()
    df = plan(spark, folder)
    rows = [tuple(row) for row in df.collect()]
    took = time.time() - started
    flags = [] if name.startswith(("op", "pipeline")) else plan_flags(df)
    if flags:
        return f"PLAN {flags}", took, len(rows)
    if sql is None:
        return "rows only", took, len(rows)
    result = con.execute(sql)
    names = [item[0] for item in result.description]
    kinds = {item[0]: str(item[1]) for item in result.description}
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(set(names) ^ set(df.columns))}", took, len(rows)
    wrong = [(c, k, kinds[c]) for c, k in df.dtypes if KINDS.get(k) != kinds[c]]
    expected = bag(names, result.fetchall())
    found = bag(df.columns, rows)
    if expected != found:
        more, less = found - expected, expected - found
        sample = f"\n   only spark  {list(more)[:2]}\n   only oracle {list(less)[:2]}"
        return (f"VALUES {sum(more.values())}/{sum(less.values())} of {len(rows)}"
                f"/{sum(expected.values())}{sample}", took, len(rows))
    return (f"TYPES {wrong}" if wrong else "ok"), took, len(rows)


def main() -> int:
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = session(), oracle(folder)
    sql, bad = entry.oracle_sql(), 0
    for name, plan in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            verdict, took, n = compare(spark, con, folder, name, plan, sql.get(name))
        except Exception as error:  # one bad query must not hide the others
            verdict, took, n = f"ERROR {str(error)[:900]}", 0.0, 0
        bad += verdict not in ("ok", "rows only")
        print(f"{name:32s} {n:8d} rows {took:6.2f}s  {verdict}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
