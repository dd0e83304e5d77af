"""Joins, set operations and array membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entry_queries.registry import Source, query, ts
from tallyroute.functions import cleaning
from tallyroute.operators import lookup, pick, unions
from tallyroute.operators.validate import stage

PART_ARRAYS = """arrays AS (SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS parts
  FROM lineitem GROUP BY l_orderkey)"""


def part_arrays(t: Source) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set("l_partkey")).alias("parts"))


@query("star_left_join", """
SELECT r_name, n_name, c_mktsegment, count(*)::BIGINT AS n_orders,
       sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY r_name, n_name, c_mktsegment""")
def star_left_join(t: Source) -> DataFrame:
    # totals per customer first: the dimensions then meet one row per customer
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"))
    rows = lookup.star(
        totals,
        (t.customer.select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey")),
         "c_custkey"),
        (t.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey")),
         "n_nationkey"),
        (t.region.select("r_regionkey", "r_name"), "r_regionkey"))
    return rows.groupBy("r_name", "n_name", "c_mktsegment").agg(
        F.sum("n").alias("n_orders"), F.sum("s").cast("double").alias("total"))


@query("manager_self_join", """
SELECT s.s_suppkey, s.s_name, m.s_name AS manager_name, n_name
FROM supplier s LEFT JOIN supplier m ON m.s_suppkey = CASE WHEN s.s_suppkey > 0
  THEN s.s_suppkey // 3 END JOIN nation ON n_nationkey = s.s_nationkey""")
def manager_self_join(t: Source) -> DataFrame:
    users = t.supplier.withColumn(
        "manager", F.expr("CASE WHEN s_suppkey > 0 THEN s_suppkey div 3 END"))
    bosses = t.supplier.select(F.col("s_suppkey").alias("manager"),
                               F.col("s_name").alias("manager_name"))
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return users.join(bosses, "manager", "left").join(nations, "s_nationkey").select(
        "s_suppkey", "s_name", "manager_name", "n_name")


@query("right_join_latest", """
WITH latest AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
  QUALIFY row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1)
SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM latest RIGHT JOIN customer ON c_custkey = o_custkey""")
def right_join_latest(t: Source) -> DataFrame:
    rows = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate")
    latest = pick.latest_by(rows, ["c_custkey"], "o_orderdate", "o_orderkey")
    return latest.join(t.customer.select("c_custkey", "c_name"), "c_custkey", "right").select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("array_membership_join", f"""
WITH {PART_ARRAYS}
SELECT l_orderkey, p_type, count(*)::BIGINT AS n_parts
FROM arrays JOIN part ON list_contains(parts, p_partkey) GROUP BY l_orderkey, p_type""")
def array_membership_join(t: Source) -> DataFrame:
    return lookup.array_member_join(
        part_arrays(t), "parts", t.part.select("p_partkey", "p_type"), "p_partkey"
    ).groupBy("l_orderkey", "p_type").agg(F.count(F.lit(1)).alias("n_parts"))


@query("array_membership_left_join", f"""
WITH {PART_ARRAYS}, big AS (SELECT p_partkey, p_name FROM part WHERE p_size > 45),
hits AS (SELECT l_orderkey, p_partkey, p_name FROM (
  SELECT l_orderkey, unnest(parts) AS p_partkey FROM arrays) JOIN big USING (p_partkey))
SELECT arrays.l_orderkey, p_partkey, p_name
FROM arrays LEFT JOIN hits ON hits.l_orderkey = arrays.l_orderkey""")
def array_membership_left_join(t: Source) -> DataFrame:
    big = t.part.where("p_size > 45").select("p_partkey", "p_name")
    return lookup.array_member_left_join(
        part_arrays(t), "l_orderkey", "parts", big, "p_partkey"
    ).select("l_orderkey", "p_partkey", "p_name")


@query("last_element_join", f"""
WITH {PART_ARRAYS}
SELECT l_orderkey, parts[-1] AS p_partkey, p_name, p_size
FROM arrays LEFT JOIN part ON p_partkey = parts[-1]""")
def last_element_join(t: Source) -> DataFrame:
    return lookup.last_member_join(
        part_arrays(t), "parts", t.part.select("p_partkey", "p_name", "p_size"), "p_partkey"
    ).select("l_orderkey", "p_partkey", "p_name", "p_size")


@query("lateral_unnest", """
WITH arrays AS (SELECT l_orderkey, CASE WHEN count(DISTINCT l_partkey) > 2
  THEN list(DISTINCT l_partkey) END AS parts FROM lineitem GROUP BY l_orderkey)
SELECT member AS l_partkey, count(*)::BIGINT AS n_orders
FROM (SELECT unnest(parts) AS member FROM arrays) GROUP BY member""")
def lateral_unnest(t: Source) -> DataFrame:
    arrays = part_arrays(t).withColumn("parts", F.when(F.size("parts") > 2, F.col("parts")))
    return lookup.member_rows(arrays, "parts", "l_partkey").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_orders"))


@query("composite_key_join", f"""
WITH asked AS (SELECT DISTINCT o_orderkey, o_orderdate + to_days(CAST(o_orderkey % 60 AS INT))
  AS due FROM orders)
SELECT o_orderkey, {ts('due')} AS due, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM asked JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate = due""")
def composite_key_join(t: Source) -> DataFrame:
    asked = t.orders.select(
        "o_orderkey",
        F.expr("o_orderdate + make_dt_interval(CAST(o_orderkey % 60 AS INT))").alias("due"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("due"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return asked.join(lines, ["o_orderkey", "due"])


@query("semi_in", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
                    AND o_orderpriority = '1-URGENT')""")
def semi_in(t: Source) -> DataFrame:
    wanted = t.orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey"))
    return lookup.within(t.customer.select("c_custkey", "c_name"), wanted, ["c_custkey"])


@query("anti_not_exists", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def anti_not_exists(t: Source) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey"))
    return lookup.without(t.customer.select("c_custkey", "c_name"), urgent, ["c_custkey"])


@query("anti_left_null", """
SELECT p_partkey, p_name FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem
  WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 40) l
  ON l_partkey = p_partkey WHERE l_partkey IS NULL""")
def anti_left_null(t: Source) -> DataFrame:
    returned = t.lineitem.where(
        "l_returnflag = 'R' AND l_shipdate >= TIMESTAMP_NTZ '1998-01-01' AND l_quantity > 40"
    ).select(F.col("l_partkey").alias("p_partkey"))
    return lookup.without(t.part.select("p_partkey", "p_name"), returned, ["p_partkey"])


@query("anti_two_keys", """
SELECT l_orderkey, l_suppkey, count(*)::BIGINT AS n FROM lineitem a
WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey
  AND b.l_suppkey = a.l_suppkey AND b.l_returnflag = 'N') GROUP BY l_orderkey, l_suppkey""")
def anti_two_keys(t: Source) -> DataFrame:
    keys = ["l_orderkey", "l_suppkey"]
    accepted = t.lineitem.where("l_returnflag = 'N'")
    return lookup.without(t.lineitem.select(*keys), accepted, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"))


@query("same_day_reason_join", """
SELECT a.event_id AS error_id, b.event_id AS view_id, a.user_id
FROM (SELECT * FROM events WHERE event_type = 'error') a
LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b
  ON a.user_id = b.user_id AND b.ts >= date_trunc('day', a.ts)
  AND b.ts < date_trunc('day', a.ts) + INTERVAL 1 DAY""")
def same_day_reason_join(t: Source) -> DataFrame:
    errors = t.events.where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), "user_id", "ts")
    views = t.events.where("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("seen"))
    return lookup.same_day_join(errors, views, ["user_id"], "ts", "seen").select(
        "error_id", "view_id", "user_id")


@query("canonical_key_join", """
SELECT a.c_custkey AS asked_key, b.c_custkey AS found_key, b.c_name
FROM (SELECT c_custkey, '  ' || upper(c_name) || ' ' AS typed FROM customer) a
JOIN customer b ON lower(trim(a.typed)) = lower(trim(b.c_name))""")
def canonical_key_join(t: Source) -> DataFrame:
    typed = t.customer.select(
        F.col("c_custkey").alias("asked_key"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("typed"))
    known = t.customer.select(F.col("c_custkey").alias("found_key"), "c_name")
    return lookup.canonical_key(typed, "typed", "name_key").join(
        lookup.canonical_key(known, "c_name", "name_key"), "name_key"
    ).select("asked_key", "found_key", "c_name")


@query("unpivot_then_join", """
WITH wide AS (SELECT o_orderkey, o_orderdate::DATE AS d0, (o_orderdate + INTERVAL 30 DAY)::DATE AS d1,
  (o_orderdate + INTERVAL 60 DAY)::DATE AS d2 FROM orders),
long AS (UNPIVOT wide ON d0, d1, d2 INTO NAME due_column VALUE due_date),
due AS (SELECT l_orderkey, l_shipdate::DATE AS due_date, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT due_column, CASE WHEN n > 1 THEN 'Several' WHEN n = 1 THEN 'One' ELSE 'No Match' END AS stage,
       count(*)::BIGINT AS n_rows, coalesce(sum(n), 0)::BIGINT AS n_lines
FROM long LEFT JOIN due ON l_orderkey = o_orderkey AND due.due_date = long.due_date GROUP BY 1, 2""")
def unpivot_then_join(t: Source) -> DataFrame:
    wide = t.orders.select(
        "o_orderkey", *[F.date_add(F.to_date("o_orderdate"), 30 * n).alias(f"d{n}")
                        for n in range(3)])
    due = t.lineitem.groupBy("l_orderkey", F.to_date("l_shipdate").alias("due_date")).agg(
        F.count(F.lit(1)).alias("n"))
    matched = lookup.unpivot_join(
        wide, ["o_orderkey"], ["d0", "d1", "d2"], due,
        {"o_orderkey": "l_orderkey", "due_date": "due_date"}, "left")
    staged = stage(matched, [(F.col("n") > 1, "Several"), (F.col("n") == 1, "One")], "No Match")
    return staged.groupBy("due_column", "stage").agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))


@query("fallback_lookup", """
WITH asked AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
       WHEN o_orderkey % 3 = 1 THEN '' END AS name,
  CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_custkey AS VARCHAR) END AS code FROM orders)
SELECT o_orderkey, coalesce(a.c_custkey, b.c_custkey) AS c_custkey
FROM asked LEFT JOIN customer a ON a.c_name = name AND name <> ''
LEFT JOIN customer b ON CAST(b.c_custkey AS VARCHAR) = code""")
def fallback_lookup(t: Source) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    asked = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Customer#"), F.lpad(key, 9, "0")))
        .when(F.col("o_orderkey") % 3 == 1, "").alias("name"),
        F.when(F.col("o_orderkey") % 4 > 0, key).alias("code"))
    people = t.customer.select("c_custkey", "c_name",
                               F.col("c_custkey").cast("string").alias("c_code"))
    return lookup.fallback_lookup(
        asked, people, "c_custkey", {"name": "c_name"}, {"code": "c_code"}
    ).select("o_orderkey", "c_custkey")


@query("keyed_fetch", """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')""")
def keyed_fetch(t: Source) -> DataFrame:
    requests = t.events.where("event_type = 'purchase'").select(
        F.col("user_id").alias("c_custkey"))
    return lookup.keyed_fetch(
        t.customer.select("c_custkey", "c_name", "c_acctbal"), requests, "c_custkey")


@query("master_dictionary", """
WITH last_named AS (SELECT lower(trim(p_name)) AS name_key, arg_max(p_brand, p_partkey) AS brand,
  max(p_partkey) AS part_id FROM part GROUP BY 1)
SELECT l_linenumber, brand, count(*)::BIGINT AS n, max(part_id) AS top_part
FROM lineitem JOIN part ON p_partkey = l_partkey
LEFT JOIN last_named ON name_key = lower(trim(p_name)) GROUP BY 1, 2""")
def master_dictionary(t: Source) -> DataFrame:
    names = t.part.select("p_partkey", cleaning.canonical("p_name").alias("name_key"))
    master = t.part.select(cleaning.canonical("p_name").alias("name_key"), "p_partkey",
                           F.col("p_brand").alias("brand"), F.col("p_partkey").alias("part_id"))
    lines = t.lineitem.select("l_linenumber", F.col("l_partkey").alias("p_partkey"))
    rows = lookup.dictionary_join(
        lines.join(names, "p_partkey").drop("p_partkey"), master, "name_key", "p_partkey",
        ["brand", "part_id"])
    return rows.groupBy("l_linenumber", "brand").agg(
        F.count(F.lit(1)).alias("n"), F.max("part_id").alias("top_part"))


@query("tagged_union", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::INT AS size,
       NULL::VARCHAR AS status, 'Customer' AS flag FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, NULL, 'Supplier' FROM supplier
UNION ALL SELECT p_partkey, p_name, NULL, p_size, NULL, 'Part' FROM part
UNION ALL SELECT o_orderkey, NULL, o_totalprice, NULL, o_orderstatus, 'Order' FROM orders""")
def tagged_union(t: Source) -> DataFrame:
    col = F.col
    return unions.tagged({
        "Customer": t.customer.select(col("c_custkey").alias("id"), col("c_name").alias("name"),
                                      col("c_acctbal").alias("balance")),
        "Supplier": t.supplier.select(col("s_suppkey").alias("id"), col("s_name").alias("name"),
                                      col("s_acctbal").alias("balance")),
        "Part": t.part.select(col("p_partkey").alias("id"), col("p_name").alias("name"),
                              col("p_size").alias("size")),
        "Order": t.orders.select(col("o_orderkey").alias("id"),
                                 col("o_totalprice").alias("balance"),
                                 col("o_orderstatus").alias("status")),
    })


@query("union_distinct_sources", """
SELECT o_custkey AS person, o_orderstatus AS state, 'order' AS kind FROM orders
UNION SELECT c_custkey, c_mktsegment, 'segment' FROM customer
UNION SELECT user_id, event_type, 'event' FROM events""")
def union_distinct_sources(t: Source) -> DataFrame:
    def aligned(df: DataFrame, person: str, state: str, kind: str) -> DataFrame:
        return df.select(F.col(person).alias("person"), F.col(state).alias("state"),
                         F.lit(kind).alias("kind"))

    return unions.distinct_stack(
        aligned(t.orders, "o_custkey", "o_orderstatus", "order"),
        aligned(t.customer, "c_custkey", "c_mktsegment", "segment"),
        aligned(t.events, "user_id", "event_type", "event"))
