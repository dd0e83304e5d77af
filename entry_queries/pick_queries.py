"""Per-key picks, sequences, allocation, sort and top-k."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entry_queries import expected
from entry_queries.registry import Source, day, query, ts
from tallyroute.functions import rules
from tallyroute.operators import allocate, measures, pick
from tallyroute.operators.running import running_by

SIZE_CLASS = "CASE WHEN p_size <= 15 THEN 'S' WHEN p_size <= 35 THEN 'M' ELSE 'L' END"

STEP_RULES = [
    ("seq = 1", "First"),
    ("l_returnflag = 'R' AND prev_flag = 'R'", "Repeat return"),
    ("size_class = prev_class AND l_returnflag = prev_flag", "Same again"),
    ("size_class <> prev_class AND prev_class = 'S'", "Step up"),
    ("size_class = 'S' AND prev_class <> 'S'", "Step down"),
    ("gap_days > 90", "Comeback"),
    ("l_returnflag = 'A'", "Accepted"),
    ("l_returnflag <> prev_flag", "Changed"),
]
#: the same facts in another order give another label
DETAIL_RULES = [STEP_RULES[i] for i in (5, 0, 7, 3, 4, 2, 6)]

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

STEP_SQL = f"""
steps AS (
  SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate,
         {SIZE_CLASS} AS size_class,
         row_number() OVER w AS seq, lag({SIZE_CLASS}) OVER w AS prev_class,
         lag(l_returnflag) OVER w AS prev_flag,
         date_diff('day', lag(l_shipdate) OVER w, l_shipdate) AS gap_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WINDOW w AS (PARTITION BY o_custkey
               ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey))
"""


def line_steps(t: Source) -> DataFrame:
    """Lines of each customer in order, with the facts of the line before."""
    lines = t.lineitem.select(*LINE_ORDER, "l_returnflag").join(
        t.orders.select("o_custkey", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    sized = t.part.select(F.col("p_partkey").alias("l_partkey"),
                          F.expr(SIZE_CLASS).alias("size_class"))
    steps = running_by(
        lines.join(sized, "l_partkey"), ["o_custkey"], LINE_ORDER,
        number="seq",
        previous={"prev_class": "size_class", "prev_flag": "l_returnflag",
                  "prev_ship": "l_shipdate"},
        sample_of=lines,
    )
    return steps.withColumn("gap_days", F.date_diff(F.to_date("l_shipdate"),
                                                    F.to_date("prev_ship")))


@query("scenario_counts", f"""
WITH {STEP_SQL}
SELECT {expected.first_of(STEP_RULES, 'Other')} AS label, count(*)::BIGINT AS n_lines,
       count(DISTINCT o_custkey)::BIGINT AS n_customers, max(seq)::BIGINT AS longest
FROM steps GROUP BY 1""")
def scenario_counts(t: Source) -> DataFrame:
    labelled = line_steps(t).select(
        "o_custkey", "seq", rules.classify(STEP_RULES, "Other").alias("label"))
    # one row per (label, customer) first, so the distinct count needs no second wide shuffle
    per_customer = labelled.groupBy("label", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("seq").alias("seq"))
    return per_customer.groupBy("label").agg(
        F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_customers"),
        F.max("seq").alias("longest"))


@query("scenario_detail", f"""
WITH {STEP_SQL}
SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, seq::BIGINT AS seq,
       {expected.first_of(DETAIL_RULES, 'Unknown')} AS label
FROM steps JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'""")
def scenario_detail(t: Source) -> DataFrame:
    segment = t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"))
    return line_steps(t).join(segment, "o_custkey", "left_semi").select(
        "o_custkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "seq",
        rules.classify(DETAIL_RULES, "Unknown").alias("label"))


@query("lead_type_flags", """
SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::INT AS is_repeat,
       max(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)::INT AS is_new,
       bool_or(o_orderpriority = '1-URGENT') AS ever_urgent,
       CASE WHEN bool_or(o_orderstatus = 'F') THEN 'repeat_lead'
            WHEN bool_or(o_orderstatus = 'O') THEN 'New_lead' ELSE 'NA' END AS lead_type
FROM orders GROUP BY o_custkey""")
def lead_type_flags(t: Source) -> DataFrame:
    flags = t.orders.groupBy("o_custkey").agg(
        measures.ever("o_orderstatus = 'F'").alias("is_repeat"),
        measures.ever("o_orderstatus = 'O'").alias("is_new"),
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("ever_urgent"))
    kind = rules.classify([("is_repeat = 1", "repeat_lead"), ("is_new = 1", "New_lead")], "NA")
    return flags.withColumn("lead_type", kind)


@query("latest_order_per_customer", f"""
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, {ts('o_orderdate')} AS o_orderdate
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1""")
def latest_order_per_customer(t: Source) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice",
                           "o_orderdate")
    return pick.latest_by(rows, ["o_custkey"], "o_orderdate", "o_orderkey")


@query("earliest_line_per_order", f"""
SELECT DISTINCT ON (l_orderkey) l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {ts('l_shipdate')} AS l_shipdate
FROM lineitem ORDER BY l_orderkey, lineitem.l_shipdate, l_linenumber, l_partkey, l_suppkey""")
def earliest_line_per_order(t: Source) -> DataFrame:
    rows = t.lineitem.select(*LINE_ORDER)
    return pick.earliest_by(rows, ["l_orderkey"], "l_shipdate", "l_linenumber", "l_partkey",
                            "l_suppkey")


@query("latest_event_multi_key", f"""
SELECT user_id, event_type, event_id, value, {ts('ts')} AS ts
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY events.ts DESC NULLS FIRST, event_id DESC) = 1""")
def latest_event_multi_key(t: Source) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    return pick.latest_by(rows, ["user_id", "event_type"], "ts", "event_id")


@query("arbitrary_pick_defined", """
SELECT p_brand, p_type, min(p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name
FROM part GROUP BY p_brand, p_type""")
def arbitrary_pick_defined(t: Source) -> DataFrame:
    rows = t.part.select("p_brand", "p_type", "p_partkey", "p_name")
    return pick.any_by(rows, ["p_brand", "p_type"], "p_partkey")


@query("preferred_pick", """
SELECT o_custkey, o_orderkey, o_orderstatus
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY (nullif(o_orderstatus, 'P') IS NOT DISTINCT FROM 'O') DESC, o_orderkey DESC) = 1""")
def preferred_pick(t: Source) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return pick.preferred_by(rows, ["o_custkey"], status.eqNullSafe("O"), "o_orderkey")


@query("nth_order_per_customer", f"""
SELECT o_custkey, o_orderkey, {ts('o_orderdate')} AS o_orderdate
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY orders.o_orderdate NULLS LAST, o_orderkey) = 3""")
def nth_order_per_customer(t: Source) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return pick.nth_by(rows, ["o_custkey"], pick.oldest("o_orderdate", "o_orderkey"), 3)


@query("asof_last_before_cutoff", f"""
SELECT user_id, event_id, event_type, value, {ts('ts')} AS ts
FROM events WHERE events.ts < TIMESTAMP '2024-01-15 00:00:00'
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY events.ts DESC, event_id DESC) = 1""")
def asof_last_before_cutoff(t: Source) -> DataFrame:
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return pick.as_of_by(rows, ["user_id"], "ts", datetime(2024, 1, 15), "event_id")


@query("last_non_null", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice,
       coalesce(arg_max(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus <> 'P'),
                'ORANGE') AS color
FROM orders GROUP BY o_custkey""")
def last_non_null(t: Source) -> DataFrame:
    rows = t.orders.withColumn("color", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return pick.last_known(rows, ["o_custkey"], "color", "o_orderkey",
                           ["o_orderkey", "o_totalprice"], "ORANGE")


@query("dup_detector", """
SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dup_detector(t: Source) -> DataFrame:
    return pick.repeated(t.lineitem, ["l_orderkey", "l_linenumber"], "n")


@query("round_robin_assign", """
SELECT o_orderkey, o_custkey,
       list_extract([11, 22, 33], CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 3 + 1 AS INT))
         ::BIGINT AS new_owner
FROM orders""")
def round_robin_assign(t: Source) -> DataFrame:
    return allocate.round_robin(
        t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", [11, 22, 33])


BALANCE_OWNERS = list(range(0, 320, 20))


@query("balanced_reassign", f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate,
                  date_trunc('month', o_orderdate)::DATE AS month FROM orders),
keep AS (SELECT o_orderkey FROM o WHERE o_custkey IN ({', '.join(map(str, BALANCE_OWNERS))})
         QUALIFY row_number() OVER (PARTITION BY month, o_orderpriority
           ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
rest AS (SELECT *, row_number() OVER (PARTITION BY month, o_orderpriority
           ORDER BY o_orderdate, o_orderkey) - 1 AS turn
         FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM keep))
SELECT o_orderkey, o_orderpriority, {day('month')} AS month, o_custkey AS new_owner, TRUE AS kept
FROM o WHERE o_orderkey IN (SELECT o_orderkey FROM keep)
UNION ALL
SELECT o_orderkey, o_orderpriority, {day('month')}, (turn % 16 * 20)::BIGINT, FALSE FROM rest""")
def balanced_reassign(t: Source) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate",
                           F.trunc(F.to_date("o_orderdate"), "MM").alias("month"))
    dealt = allocate.balanced_reassign(
        rows, ["month", "o_orderpriority"], "o_custkey", BALANCE_OWNERS, "o_orderdate",
        "o_orderkey")
    return dealt.select("o_orderkey", "o_orderpriority", "month", "new_owner", "kept")


QUOTA_SQL = """
req AS (SELECT c_custkey AS row_id, c_custkey // 3 AS owner, (1 + c_custkey % 5)::BIGINT AS quota
        FROM customer),
asked AS (SELECT *, coalesce(sum(quota) OVER (PARTITION BY owner ORDER BY row_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo FROM req),
pool AS (SELECT o_custkey AS owner, o_orderkey,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS slot
         FROM orders)
"""


def quota_frames(t: Source) -> tuple[DataFrame, DataFrame]:
    requests = t.customer.select(
        F.col("c_custkey").alias("row_id"), F.expr("c_custkey div 3").alias("owner"),
        (1 + F.col("c_custkey") % 5).cast("bigint").alias("quota"))
    return requests, t.orders.select(F.col("o_custkey").alias("owner"), "o_orderkey")


@query("quota_allocation", f"""
WITH {QUOTA_SQL}
SELECT row_id, pool.owner, o_orderkey, slot::BIGINT AS slot
FROM asked JOIN pool ON pool.owner = asked.owner AND slot >= lo AND slot < lo + quota""")
def quota_allocation(t: Source) -> DataFrame:
    requests, pool = quota_frames(t)
    taken, _ = allocate.quota_allocate(requests, pool, "owner", "quota", "row_id", "o_orderkey")
    return taken.select("row_id", "owner", "o_orderkey", "slot")


@query("quota_slices", f"""
WITH {QUOTA_SQL}, stock AS (SELECT owner, count(*) AS n FROM pool GROUP BY owner)
SELECT row_id, asked.owner, quota, least(lo, coalesce(n, 0))::BIGINT AS lo,
       least(lo + quota, coalesce(n, 0))::BIGINT AS hi
FROM asked LEFT JOIN stock ON stock.owner = asked.owner""")
def quota_slices(t: Source) -> DataFrame:
    requests, pool = quota_frames(t)
    return allocate.quota_ranges(requests, pool, "owner", "quota", "row_id")


@query("hierarchy_climb", """
WITH RECURSIVE up AS (
  SELECT s_suppkey AS root, s_suppkey AS node, 0 AS depth FROM supplier
  UNION ALL
  SELECT root, node // 3, depth + 1 FROM up WHERE node > 0),
hit AS (SELECT root, node, depth FROM up JOIN supplier ON s_suppkey = node
        WHERE s_acctbal > 6000
        QUALIFY row_number() OVER (PARTITION BY root ORDER BY depth) = 1)
SELECT s_suppkey, coalesce(node, -1)::BIGINT AS responsible
FROM supplier LEFT JOIN hit ON root = s_suppkey""")
def hierarchy_climb(t: Source) -> DataFrame:
    users = t.supplier.select(
        "s_suppkey", "s_acctbal",
        F.expr("CASE WHEN s_suppkey > 0 THEN s_suppkey div 3 END").alias("manager"))
    return allocate.climb_hierarchy(
        users, "s_suppkey", "manager", F.col("s_acctbal") > 6000, -1)


@query("topn_orders", f"""
SELECT o_orderkey, o_totalprice, {ts('o_orderdate')} AS o_orderdate FROM orders
ORDER BY orders.o_orderdate DESC NULLS FIRST, o_totalprice, o_orderkey LIMIT 100""")
def topn_orders(t: Source) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderdate").orderBy(
        F.col("o_orderdate").desc_nulls_first(), "o_totalprice", "o_orderkey").limit(100)


@query("batch_slice", """
SELECT o_orderkey, o_custkey FROM orders
QUALIFY row_number() OVER (ORDER BY o_orderkey) <= (SELECT count(*) // 4 FROM orders)""")
def batch_slice(t: Source) -> DataFrame:
    """A batch limit that grows with the table, taken without a single-task sort."""
    quarter = t.orders.agg(F.floor(F.count(F.lit(1)) / 4)).scalar()
    return allocate.first_n(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", quarter)


HOT_KEY = "CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_suppkey END"
#: the hot key's lines are all on one day or on none
HOT_DAY = ("CASE WHEN l_orderkey % 6 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN TIMESTAMP '1995-01-01'"
           " ELSE l_shipdate END")


@query("hot_key_steps", f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {HOT_KEY} AS holder, {HOT_DAY} AS day FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, holder, row_number() OVER w AS seq, lag(l_partkey) OVER w AS prev_part,
  coalesce(sum(l_linenumber) OVER (PARTITION BY holder ORDER BY day NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
FROM l WINDOW w AS (PARTITION BY holder ORDER BY day NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey)""")
def hot_key_steps(t: Source) -> DataFrame:
    """Numbers, previous values and sums per key, one key holding a third of all lines, on one day
    or without a day."""
    kind = t.lineitem.schema["l_shipdate"].dataType
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.expr(HOT_KEY).alias("holder"),
        F.expr(HOT_DAY).cast(kind).alias("day"))
    order = ["day", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    steps = running_by(lines, ["holder"], order, number="seq", previous={"prev_part": "l_partkey"},
                       sums={"before": "l_linenumber"})
    return steps.drop("day").withColumn("before", F.col("before").cast("bigint"))
