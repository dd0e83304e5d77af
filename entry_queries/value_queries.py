"""Aggregates, classifiers, scalar functions, cleaning and validation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entry_queries import expected
from entry_queries.registry import ORACLES, Source, clock, day, ids, query, ts
from tallyroute.functions import (
    catalog, cleaning, dates, durations, idlists, payload, rules,
)
from tallyroute.operators import audit, measures
from tallyroute.operators.validate import (
    Check, all_failures, first_failure, last_failure, remark_text,
)
from tallyroute.session import scratch_path
from tallyroute.sources import schema

AS_OF = datetime(2001, 7, 15, 12, 0, 0)
EVENTS_AS_OF = datetime(2024, 1, 20, 9, 30, 0)

STATUSES, PRIORITIES = ("F", "O", "P"), ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
FUNNEL = {
    **{f"status_{s.lower()}": f"o_orderstatus = '{s}'" for s in STATUSES},
    **{f"{s.lower()}_{p[0]}": f"o_orderstatus = '{s}' AND o_orderpriority = '{p}'"
       for s in STATUSES for p in PRIORITIES},
    **{f"recent_{s.lower()}": f"o_orderstatus = '{s}' AND recent" for s in STATUSES},
    "steady_or_recent": "o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT') AND recent",
}


@query("funnel_measures", f"""
SELECT n_name, {', '.join(f"count(CASE WHEN {c} THEN 1 END)::BIGINT AS {n}" for n, c in FUNNEL.items())},
       sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total
FROM (SELECT *, o_orderdate >= TIMESTAMP '2001-05-16' AS recent FROM orders)
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def funnel_measures(t: Source) -> DataFrame:
    orders = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderpriority", "o_totalprice",
        dates.since_days("o_orderdate", AS_OF, 60).alias("recent"))
    placed = orders.join(
        t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey"
    ).join(t.nation.select("n_nationkey", "n_name"), "n_nationkey")
    return placed.groupBy("n_name").agg(
        *measures.counts_where(FUNNEL), measures.money("o_totalprice").alias("total"))


CALLS = {"called": "value <= 5", "detailed": "value >= 200 OR event_type = 'purchase' AND value > 150",
         "phone": "value > 100 AND value < 200"}


@query("call_buckets", f"""
SELECT user_id, {day('date_trunc(' + "'day'" + ', ts)')} AS day,
  {', '.join(f"count(CASE WHEN {c} THEN 1 END)::BIGINT AS {n}" for n, c in CALLS.items())},
  sum(CASE WHEN event_type = 'click' THEN CAST(round(value) AS BIGINT) ELSE 0 END)::BIGINT AS click_seconds
FROM (SELECT user_id, ts, event_type, round_even(value, 0) AS v, value FROM events)
GROUP BY 1, 2 HAVING called > 0 OR detailed > 0 OR phone > 0""".replace(
    "CAST(round(value) AS BIGINT)", "CAST(v AS BIGINT)"))
def call_buckets(t: Source) -> DataFrame:
    counted = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        *measures.counts_where(CALLS),
        *measures.sums_where(
            {"click_seconds": ("event_type = 'click'", "CAST(rint(value) AS BIGINT)")}))
    return measures.any_positive(counted, CALLS)


CLOCK = ("lpad(CAST(CAST(floor(value) AS BIGINT) % 24 AS {0}), 2, '0') || ':' ||"
         " lpad(CAST(event_id % 60 AS {0}), 2, '0') || ':' ||"
         " lpad(CAST((event_id * 7) % 60 AS {0}), 2, '0')")
WATCHED = ("CASE WHEN event_id % 10 = 0 THEN 'n/a' WHEN event_id % 10 = 1 THEN"
           " CAST(event_id % 5000 AS {0}) ELSE " + CLOCK + " END")


@query("watch_time_by_group", f"""
WITH e AS (SELECT user_id, event_type, {WATCHED.format('VARCHAR')} AS watched FROM events),
s AS (SELECT user_id, event_type, sum(CASE
    WHEN regexp_full_match(watched, '\\d\\d:\\d\\d:\\d\\d') THEN
      CAST(watched[1:2] AS BIGINT) * 3600 + CAST(watched[4:5] AS BIGINT) * 60 + CAST(watched[7:8] AS BIGINT)
    WHEN event_type = 'view' AND regexp_full_match(watched, '\\d+') THEN CAST(watched AS BIGINT)
    ELSE 0 END)::BIGINT AS seconds FROM e GROUP BY user_id, event_type)
SELECT user_id, {', '.join(f"{clock(f'sum(CASE WHEN event_type = {q} THEN seconds ELSE 0 END)::BIGINT')} AS {n}"
                           for n, q in (('clicks', "'click'"), ('views', "'view'"), ('buys', "'purchase'")))},
       {clock('sum(seconds)::BIGINT')} AS total_time, (sum(seconds) % 86400)::BIGINT AS wrapped
FROM s GROUP BY user_id""")
def watch_time_by_group(t: Source) -> DataFrame:
    events = t.events.select("user_id", "event_type",
                             F.expr(WATCHED.format("STRING")).alias("watched"))
    seconds = F.when(F.col("event_type") == "view",
                     durations.clock_seconds("watched", plain_numbers=True)).otherwise(
        durations.clock_seconds("watched"))
    groups = {"clicks": "click", "views": "view", "buys": "purchase"}
    totals = events.withColumn("seconds", seconds).groupBy("user_id").agg(
        *[F.sum(F.when(F.col("event_type") == kind, F.col("seconds")).otherwise(0)).alias(name)
          for name, kind in groups.items()],
        F.sum("seconds").alias("total"))
    return totals.select(
        "user_id", *[durations.clock_text(name).alias(name) for name in groups],
        durations.clock_text("total").alias("total_time"),
        durations.clock_seconds(durations.clock_text("total", wrap=True)).alias("wrapped"))


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query("event_counts_pivot", f"""
SELECT user_id, {', '.join(f"count(*) FILTER (WHERE event_type = '{e}')::BIGINT AS {e}" for e in EVENT_TYPES)}
FROM events GROUP BY user_id""")
def event_counts_pivot(t: Source) -> DataFrame:
    return measures.pivot_counts(t.events, ["user_id"], "event_type", EVENT_TYPES)


@query("colour_pivot", f"""
SELECT {day("date_trunc('month', o_orderdate)")} AS month,
  {', '.join(f'''count(*) FILTER (WHERE o_orderpriority = '{p}')::BIGINT AS "{p}"''' for p in PRIORITIES)}
FROM orders GROUP BY 1""")
def colour_pivot(t: Source) -> DataFrame:
    months = t.orders.select(F.trunc(F.to_date("o_orderdate"), "MM").alias("month"),
                             "o_orderpriority")
    return measures.pivot_counts(months, ["month"], "o_orderpriority", PRIORITIES)


@query("string_agg_distinct", """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types
FROM events GROUP BY user_id""")
def string_agg_distinct(t: Source) -> DataFrame:
    return measures.distinct_list(t.events, ["user_id"], "event_type", "types")


@query("string_agg_conditional", """
SELECT l_orderkey, string_agg(CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey AS VARCHAR) END, ','
  ORDER BY l_linenumber, l_partkey, l_suppkey) AS returned
FROM lineitem GROUP BY l_orderkey""")
def string_agg_conditional(t: Source) -> DataFrame:
    value = F.when(F.col("l_returnflag") == "R", F.col("l_partkey").cast("string"))
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    return t.lineitem.groupBy("l_orderkey").agg(
        measures.ordered_text(value, order).alias("returned"))


@query("ordered_mixed_agg", """
SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS amount,
  max(l_quantity) AS top_quantity,
  arg_min(l_partkey, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS first_part,
  arg_max(l_partkey, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS last_part,
  string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS flags
FROM lineitem GROUP BY l_orderkey""")
def ordered_mixed_agg(t: Source) -> DataFrame:
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    return t.lineitem.groupBy("l_orderkey").agg(
        measures.money("l_extendedprice").alias("amount"),
        F.max("l_quantity").alias("top_quantity"),
        measures.first_along("l_partkey", order).alias("first_part"),
        measures.last_along("l_partkey", order).alias("last_part"),
        # at most three different flags exist, so the set is bounded
        F.array_join(F.sort_array(F.collect_set("l_returnflag")), ", ").alias("flags"))


@query("two_stage_agg", """
WITH a AS (SELECT l_orderkey, l_suppkey, max(l_partkey) AS top_part, count(*) AS n,
  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY l_orderkey, l_suppkey)
SELECT l_orderkey, sum(n)::BIGINT AS n_lines, count(*)::BIGINT AS n_suppliers,
  arg_max(l_suppkey, (top_part, l_suppkey)) AS last_supplier, max(top_part) AS top_part, sum(s)::DOUBLE AS amount
FROM a GROUP BY l_orderkey""")
def two_stage_agg(t: Source) -> DataFrame:
    first = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(
        F.max("l_partkey").alias("top_part"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_extendedprice").cast(measures.MONEY)).alias("s"))
    return first.groupBy("l_orderkey").agg(
        F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_suppliers"),
        measures.last_along("l_suppkey", ["top_part", "l_suppkey"]).alias("last_supplier"),
        F.max("top_part").alias("top_part"), F.sum("s").cast("double").alias("amount"))


@query("id_set_per_key", f"""
SELECT l_orderkey, {day('l_shipdate')} AS ship_day, {ids('list_sort(list(DISTINCT l_partkey))')} AS parts
FROM lineitem GROUP BY l_orderkey, l_shipdate""")
def id_set_per_key(t: Source) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey", F.to_date("l_shipdate").alias("ship_day")).agg(
        F.sort_array(F.collect_set("l_partkey")).alias("parts"))


@query("login_logout_by_local_day", f"""
WITH l AS (SELECT user_id, ts + INTERVAL 330 MINUTE AS seen FROM events)
SELECT user_id, {day("date_trunc('day', seen)")} AS login_date,
  strftime(min(seen), '%d-%m-%Y %H:%M:%S') AS login_time,
  strftime(max(seen), '%d-%m-%Y %H:%M:%S') AS logout_time FROM l GROUP BY 1, 2""")
def login_logout_by_local_day(t: Source) -> DataFrame:
    local = t.events.select("user_id", dates.local_time("ts").alias("at"))
    spans = local.groupBy("user_id", F.to_date("at").alias("login_date")).agg(
        F.min("at").alias("first"), F.max("at").alias("last"))
    return spans.select("user_id", "login_date", dates.stamp_text("first").alias("login_time"),
                        dates.stamp_text("last").alias("logout_time"))


SOURCE = "p_type || ' ' || p_name"
SOURCE_RULES = [
    ("source = 'ECONOMY small ring'", "Exact"),
    ("source ILIKE '%RING%' OR source ILIKE '%bolt%'", "Metal"),
    ("source ILIKE '%promo%' AND (source ILIKE '%red%' OR source ILIKE '%blue%')", "Promo colour"),
    ("lower(source) ILIKE '%small%'", "Small"),
]


@query("source_grouping", f"""
WITH p AS (SELECT p_partkey, {SOURCE} AS source, CASE p_size % 14 WHEN 0 THEN 'quora'
  WHEN 1 THEN 'YouTube' WHEN 2 THEN 'Youtube' WHEN 3 THEN 'YAHOO' WHEN 4 THEN 'my WhatsApp ' || p_name
  WHEN 5 THEN 'Google Display' WHEN 6 THEN 'google brand' WHEN 7 THEN 'Google' WHEN 8 THEN 'GeoAds x'
  WHEN 9 THEN 'fball' WHEN 10 THEN 'old customer' WHEN 11 THEN 'Missed Call' WHEN 12 THEN NULL
  ELSE p_name END AS channel FROM part)
SELECT p_partkey, {expected.first_of(SOURCE_RULES, 'Other')} AS kind, CASE
  WHEN channel = 'quora' THEN 'Quora' WHEN channel = 'Missed Call' THEN 'Missed Call'
  WHEN channel IN ('youtube', 'Youtube') THEN 'Youtube' WHEN lower(channel) = 'yahoo' THEN 'Yahoo'
  WHEN regexp_matches(lower(channel), 'organic|direct traffic|zopim|whatsapp|moengage|website') THEN 'Organic'
  WHEN regexp_matches(lower(channel), 'customer') THEN 'Customer Referral'
  WHEN contains(lower(channel), 'fball') THEN 'Facebook'
  WHEN contains(lower(channel), 'google') AND regexp_matches(lower(channel), 'discovery|display') THEN 'Google Discovery'
  WHEN contains(lower(channel), 'google') AND contains(lower(channel), 'brand') THEN 'Google Search (NB)'
  WHEN regexp_matches(lower(channel), 'affiliate|digismart|geoads') THEN 'Affiliate' ELSE 'Other' END AS channel_group
FROM p""")
def source_grouping(t: Source) -> DataFrame:
    channel = F.expr("""CASE p_size % 14 WHEN 0 THEN 'quora' WHEN 1 THEN 'YouTube' WHEN 2 THEN
        'Youtube' WHEN 3 THEN 'YAHOO' WHEN 4 THEN 'my WhatsApp ' || p_name WHEN 5 THEN
        'Google Display' WHEN 6 THEN 'google brand' WHEN 7 THEN 'Google' WHEN 8 THEN 'GeoAds x'
        WHEN 9 THEN 'fball' WHEN 10 THEN 'old customer' WHEN 11 THEN 'Missed Call'
        WHEN 12 THEN NULL ELSE p_name END""")
    rows = t.part.select("p_partkey", F.expr(SOURCE).alias("source"), channel.alias("channel"))
    return rows.select(
        "p_partkey", rules.classify(SOURCE_RULES, "Other").alias("kind"),
        F.expr(catalog.source_group_text("channel")).alias("channel_group"))


MODE_RULES = [
    ("l_returnflag = 'R' AND l_linestatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT')", "Rush return"),
    ("l_returnflag IN ('R', 'A') AND l_linestatus = 'F'", "Closed"),
    ("l_returnflag = 'N' AND o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')", "Open"),
    ("l_returnflag IN ('R', 'A') AND l_linestatus = 'F'", "Never reached"),
]


@query("mode_classifier", f"""
SELECT {expected.first_of(MODE_RULES, 'Unknown')} AS mode,
  CASE WHEN l_linenumber = 1 AND l_quantity IN (1, 2, 3) THEN 'Retail' WHEN l_linenumber = 2 THEN 'Bundle' END AS family,
  CASE WHEN o_orderstatus = 'F' THEN 'GROUP F' ELSE o_orderpriority END AS status_group,
  count(*)::BIGINT AS n
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3""")
def mode_classifier(t: Source) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber",
                              "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority",
                             "o_orderstatus")
    family = rules.classify([("l_linenumber = 1 AND l_quantity IN (1, 2, 3)", "Retail"),
                             ("l_linenumber = 2", "Bundle")])
    return lines.join(orders, "l_orderkey").groupBy(
        rules.classify(MODE_RULES, "Unknown").alias("mode"), family.alias("family"),
        F.when(F.col("o_orderstatus") == "F", "GROUP F").otherwise(F.col("o_orderpriority"))
        .alias("status_group"),
    ).agg(F.count(F.lit(1)).alias("n"))


BUCKETS = catalog.bucket_conditions("substatus")


@query("bucket_flags", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 1 + o_orderkey % 71 END AS substatus,
  o_orderstatus = 'F' AS done, o_orderdate AS due, o_totalprice / 100000 AS duration FROM orders)
SELECT o_orderkey,
  CASE WHEN substatus IS NOT NULL AND substatus NOT IN (1, 2, 3) THEN 1 ELSE 0 END AS touched,
  CASE WHEN substatus IN (6, 7, 13, 14, 54, 55, 57, 60) OR substatus BETWEEN 16 AND 28 THEN 1 ELSE 0 END AS workable,
  CASE WHEN substatus IN (9, 10, 11, 15, 56, 58, 59, 61, 64, 65) THEN 1 ELSE 0 END AS non_workable,
  CASE WHEN substatus = 5 THEN 1 ELSE 0 END AS not_pitched,
  CASE WHEN substatus BETWEEN 29 AND 50 OR substatus IN (52, 53, 71) THEN 1 ELSE 0 END AS converted,
  CASE WHEN done THEN 'completed' WHEN NOT done AND due < TIMESTAMP '2001-07-15 12:00:00' THEN 'overdue' END AS follow_up,
  CASE WHEN duration < 5 AND (o_orderkey % 4 = 0 OR o_orderkey % 4 = 1 AND o_orderkey % 3 = 0) THEN 1 END AS unanswered
FROM o""")
def bucket_flags(t: Source) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 1 + o_orderkey % 71 END")
        .alias("substatus"),
        (F.col("o_orderstatus") == "F").alias("done"), F.col("o_orderdate").alias("due"),
        (F.col("o_totalprice") / 100000).alias("duration"),
        F.expr("element_at(array('NoAnswer', 'NormalUnspecified', 'Busy', 'Other'),"
               " CAST(o_orderkey % 4 + 1 AS INT))").alias("details"),
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'not_answered' ELSE 'answered' END")
        .alias("call_status"))
    state = F.when(F.col("done"), "completed").when(
        ~F.col("done") & dates.in_range("due", end=AS_OF), "overdue")
    return rows.select(
        "o_orderkey", *measures.flags_where(BUCKETS), state.alias("follow_up"),
        F.expr(catalog.unanswered_call_text("duration", "details", "call_status"))
        .alias("unanswered"))


@query("relative_date_filters", """
SELECT 'yesterday' AS span, count(*)::BIGINT AS n, min(event_id) AS first_id FROM events
  WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20'
UNION ALL SELECT 'last_7_days', count(*), min(event_id) FROM events WHERE ts >= TIMESTAMP '2024-01-13'
UNION ALL SELECT 'month_to_date', count(*), min(event_id) FROM events WHERE ts >= TIMESTAMP '2024-01-01'
UNION ALL SELECT 'older_than_10', count(*), min(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-10 09:30:00'
UNION ALL SELECT 'from_day', count(*), min(event_id) FROM events WHERE ts >= TIMESTAMP '2024-01-25'
UNION ALL SELECT 'between', count(*), min(event_id) FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-06 23:59:59'""")
def relative_date_filters(t: Source) -> DataFrame:
    spans = {
        "yesterday": dates.yesterday("ts", EVENTS_AS_OF),
        "last_7_days": dates.since_days("ts", EVENTS_AS_OF, 7),
        "month_to_date": dates.month_to_date("ts", EVENTS_AS_OF),
        "older_than_10": dates.older_than_days("ts", EVENTS_AS_OF, 10),
        "from_day": dates.from_day("ts", "2024-01-25"),
        "between": F.expr("ts BETWEEN TIMESTAMP_NTZ '2024-01-05'"
                          " AND TIMESTAMP_NTZ '2024-01-06 23:59:59'"),
    }
    # every span from one scan
    facts = F.array(*[
        F.struct(F.lit(name).alias("span"), F.count_if(inside).alias("n"),
                 F.min(F.when(inside, F.col("event_id"))).alias("first_id"))
        for name, inside in spans.items()])
    return t.events.agg(facts.alias("facts")).select(F.inline("facts"))


@query("array_filters", """
WITH a AS (SELECT l_orderkey, CASE WHEN l_orderkey % 11 > 0 THEN list(DISTINCT l_linenumber) END AS nums
  FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, list_contains(nums, 4) AS has_four, list_has_any(nums, [1, 2]) AS overlaps
FROM a WHERE NOT list_contains(nums, 7)""")
def array_filters(t: Source) -> DataFrame:
    arrays = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("nums"))
    arrays = arrays.withColumn("nums", F.when(F.col("l_orderkey") % 11 > 0, F.col("nums")))
    return arrays.where(idlists.lacks("nums", 7)).select(
        "l_orderkey", idlists.has("nums", 4).alias("has_four"),
        idlists.overlaps("nums", [1, 2]).alias("overlaps"))


@query("json_extract", """
WITH e AS (SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, k, CASE WHEN event_id % 5 = 0 THEN 'job' || k WHEN event_id % 5 = 1 THEN 'tag' || k
    WHEN event_id % 5 = 2 THEN 'deep' || k WHEN event_id % 5 = 3 THEN 'quoted' || k END AS found,
  CASE WHEN event_id % 5 = 4 THEN NULL ELSE k % 2 = 0 END AS outgoing,
  CASE WHEN k >= 10 THEN CAST(k AS VARCHAR)[1] END AS first_digit,
  '{"k":' || k || ',"kind":"x"}' AS rebuilt
FROM e""")
def json_extract(t: Source) -> DataFrame:
    k = payload.field("props", "$.k").cast("bigint")
    text, bs = F.col("k").cast("string"), "\\"
    answer = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('{"occupation": "job'), text, F.lit('"}')))
        .when(F.col("event_id") % 5 == 1,
              F.concat(F.lit("<a><occupation>tag"), text, F.lit("</occupation></a>")))
        .when(F.col("event_id") % 5 == 2, F.concat(
            F.lit('{"signing_parties": [{"pki_signature_details": {"occupation": "deep'), text,
            F.lit('"}}]}')))
        .when(F.col("event_id") % 5 == 3, F.concat(
            F.lit(f'"{{{bs}"pan_details{bs}": {{{bs}"occupation{bs}": {bs}"quoted'), text,
            F.lit(f'{bs}"}}}}"')))
        .otherwise(F.lit('{"occupation": ')))
    messages = F.when(F.col("event_id") % 5 < 4, F.concat(
        F.lit('{"msgs": [{"category": "Incoming"}, {"category": "'),
        F.when(F.col("k") % 2 == 0, "Outgoing").otherwise("Other"), F.lit('"}]}')))
    rows = t.events.select("event_id", "props").withColumn("k", k)
    digit = F.nullif(F.regexp_extract("props", r"(\d)\d", 1), F.lit(""))
    return rows.select(
        "event_id", "k", payload.occupation(answer).alias("found"),
        payload.any_item(messages, "$.msgs", "category", "Outgoing").alias("outgoing"),
        digit.alias("first_digit"),
        payload.object_of(k=F.col("k"), kind=F.lit("x")).alias("rebuilt"))


@query("json_array_items", """
WITH e AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT 'item' || (k % 7) AS name, event_type, count(*)::BIGINT AS n, sum(k)::BIGINT AS total
FROM (SELECT event_type, k, unnest(CASE WHEN k % 3 = 0 THEN [1] ELSE [1, 2] END) FROM e) GROUP BY 1, 2""")
def json_array_items(t: Source) -> DataFrame:
    one = F.concat(F.lit('{"name": "item'), (F.col("k") % 7).cast("string"), F.lit('", "v": '),
                   F.col("k").cast("string"), F.lit("}"))
    body = F.concat(F.lit('{"list": ['), one, F.when(F.col("k") % 3 == 0, F.lit(""))
                    .otherwise(F.concat(F.lit(", "), one)), F.lit("]}"))
    rows = t.events.select("event_type", payload.field("props", "$.k").cast("bigint").alias("k"))
    items = rows.select(
        "event_type",
        F.explode(payload.items(body, "$.list", "name: STRING, v: BIGINT")).alias("item"))
    return items.groupBy("item.name", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("item.v").alias("total"))


@query("scalar_dates", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text, strftime(o_orderdate, '%d %b %y') AS short_text,
  strftime(o_orderdate, '%d-%m-%Y %H:%M:%S') AS stamp, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS parsed,
  CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day_first,
  CASE WHEN o_orderdate <= TIMESTAMP '2001-07-15'
    THEN date_part('year', age(TIMESTAMP '2001-07-15', o_orderdate))::BIGINT END AS years,
  date_diff('day', o_orderdate, TIMESTAMP '2001-07-15')::INT AS days_old,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
  strftime(o_orderdate + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS local,
  strftime(o_orderdate - INTERVAL 61 DAY, '%Y-%m-%d %H:%M:%S') AS edge
FROM orders""")
def scalar_dates(t: Source) -> DataFrame:
    typed = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy")) \
        .otherwise(F.lit("31/02/2001"))
    stamp = dates.stamp_text("o_orderdate")
    at = F.lit(datetime(2001, 7, 15)).cast("timestamp_ntz")
    return t.orders.select(
        "o_orderkey", dates.day_text("o_orderdate").alias("day_text"),
        dates.short_day_text("o_orderdate").alias("short_text"), stamp.alias("stamp"),
        dates.parse_stamp(stamp).alias("parsed"),
        cleaning.day_first_date(typed).alias("day_first"),
        dates.completed_years("o_orderdate", at).alias("years"),
        F.date_diff(F.lit(datetime(2001, 7, 15)).cast("date"), F.to_date("o_orderdate"))
        .alias("days_old"),
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("month_start"),
        dates.local_time("o_orderdate").alias("local"),
        (F.col("o_orderdate") - F.make_dt_interval(F.lit(61))).alias("edge"))


@query("scalar_strings", """
WITH p AS (SELECT p_partkey, '  ' || p_name || ' ' AS padded, '"' || p_type || '"' AS quoted,
  CAST(p_size AS VARCHAR) || ', ' || CAST(p_partkey % 100 AS VARCHAR) || ',x,' || CAST(p_size AS VARCHAR) AS id_text FROM part)
SELECT p_partkey, lower(trim(padded)) AS low, upper(trim(padded)) AS up, trim(quoted, '"') AS bare,
  replace(id_text, ',', ' |') AS piped, low || '-' || up AS joined,
  array_to_string(list_sort(list_distinct([CAST(trim(x) AS BIGINT) FOR x IN string_split(id_text, ',')
    IF regexp_full_match(trim(x), '[0-9]+')])), ', ') AS ids
FROM p""")
def scalar_strings(t: Source) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    size, key = F.col("p_size").cast("string"), (F.col("p_partkey") % 100).cast("string")
    id_text = F.concat(size, F.lit(", "), key, F.lit(",x,"), size)
    low, up = cleaning.canonical(padded), cleaning.code(padded)
    return t.part.select(
        "p_partkey", low.alias("low"), up.alias("up"),
        F.btrim(F.concat(F.lit('"'), F.col("p_type"), F.lit('"')), F.lit('"')).alias("bare"),
        cleaning.pipe_separated(id_text).alias("piped"),
        F.concat(low, F.lit("-"), up).alias("joined"), idlists.clean_ids(id_text).alias("ids"))


@query("scalar_math_types", """
WITH l AS (SELECT *, CASE WHEN l_linenumber = 3 THEN 0 ELSE l_extendedprice END AS price FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN price <> 0 THEN l_discount / price * 100 END AS percent,
  round_even(l_quantity / 2, 0)::INT AS half, coalesce(nullif(l_returnflag, 'N'), 'none') AS flag,
  TRY_CAST(CASE WHEN l_linenumber = 1 THEN 'abc' ELSE CAST(l_partkey AS VARCHAR) END AS INT) AS safe_int,
  l_orderkey + l_linenumber * 2 AS calc, CAST(trunc(l_extendedprice) AS BIGINT) AS whole
FROM l""")
def scalar_math_types(t: Source) -> DataFrame:
    price = F.when(F.col("l_linenumber") == 3, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
    typed = F.when(F.col("l_linenumber") == 1, "abc").otherwise(F.col("l_partkey").cast("string"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        cleaning.percent("l_discount", price).alias("percent"),
        cleaning.half_even_int(F.col("l_quantity") / 2).alias("half"),
        F.coalesce(F.nullif(F.col("l_returnflag"), F.lit("N")), F.lit("none")).alias("flag"),
        typed.try_cast("int").alias("safe_int"),
        (F.col("l_orderkey") + F.col("l_linenumber") * 2).alias("calc"),
        F.col("l_extendedprice").cast("bigint").alias("whole"))


@query("scalar_arrays", """
WITH a AS (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS s FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, list_contains(s, 5) AS has_five, list_has_any(s, [1, 2, 3]) AS overlap,
  len(s)::INT AS n, s[-1] AS last_item, s[2] AS second FROM a""")
def scalar_arrays(t: Source) -> DataFrame:
    arrays = t.lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set("l_suppkey")).alias("s"))
    return arrays.select(
        "l_orderkey", idlists.has("s", 5).alias("has_five"),
        idlists.overlaps("s", [1, 2, 3], "bigint").alias("overlap"), F.size("s").alias("n"),
        idlists.last_item("s").alias("last_item"),
        F.try_element_at("s", F.lit(2)).alias("second"))


# --- dirty rows: made from the tables, cleaned back ----------------------------------------

DIRTY = {
    "email": "CASE WHEN o_orderkey % 7 = 0 THEN ' nan ' WHEN o_orderkey % 7 = 1 THEN '' ELSE"
             " '  User' || CAST(o_custkey AS {0}) || '@X.org' END",
    "amount": "CASE WHEN o_orderkey % 40 = 0 THEN 'n/a' WHEN o_orderkey % 40 = 8 THEN 'nan'"
              " WHEN o_orderkey % 40 = 16 THEN '-inf' WHEN o_orderkey % 40 = 24 THEN '12d'"
              " WHEN o_orderkey % 40 = 32 THEN '1e400' ELSE CAST(CAST(floor(o_totalprice / 1000)"
              " AS BIGINT) AS {0}) || ',' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000"
              " AS {0}), 3, '0') || '.50' END",
    "due": "CASE WHEN o_orderkey % 6 = 0 THEN '31/02/2001' ELSE"
           " CASE o_orderkey % 5 WHEN 1 THEN '2001-' || {m} || '-' || {d} || ' 00:00:00'"
           " WHEN 2 THEN {d} || '.' || {m} || '.01' WHEN 3 THEN {d} || ' ' ||"
           " substr('JanFebMarAprMayJunJulAugSepOctNovDec',"
           " CAST(1 + 3 * (o_orderkey % 12) AS INT), 3) || ' 2001'"
           " WHEN 4 THEN {d} || '/' || {m} || '/2001 14:30' ELSE {d} || '/' || {m} || '/2001' END"
           " END",
    "code": "CASE WHEN o_orderkey % 5 = 0 THEN 'A' || CAST(o_orderkey AS {0}) ELSE"
            " ' ' || CAST(o_orderkey AS {0}) END",
    "answer": "CASE o_orderkey % 3 WHEN 0 THEN ' Yes' WHEN 1 THEN 'NO ' ELSE 'maybe' END",
    "mode": "CASE o_orderkey % 4 WHEN 0 THEN 'NEFT' WHEN 1 THEN 'Razorpay' WHEN 2 THEN"
            " 'Razorpay-New' ELSE 'Cash' END",
    "quota": "CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '-1' WHEN 2 THEN 'abc' WHEN 3 THEN"
             " ' 12 ' ELSE CAST(o_orderkey % 50 AS {0}) END",
}


def dirty_rows(t: Source) -> DataFrame:
    return t.orders.select(
        "o_orderkey", *[F.expr(text.format(
            "STRING", d="CAST(1 + o_orderkey % 28 AS STRING)",
            m="CAST(1 + o_orderkey % 12 AS STRING)")).alias(name) for name, text in DIRTY.items()])


def cleaned_rows(t: Source) -> DataFrame:
    return dirty_rows(t).select(
        "o_orderkey", cleaning.null_if_token("email").alias("email"),
        cleaning.number("amount").alias("amount"), cleaning.day_first_date("due").alias("due"),
        cleaning.digits("code").alias("code"), cleaning.yes_no("answer").alias("answer"),
        cleaning.mapped("mode", catalog.METHOD_BY_MODE).alias("method"),
        cleaning.positive_int("quota").alias("quota"))


CLEAN_SQL = """clean AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 > 1 THEN 'user' || o_custkey || '@x.org' END AS email,
  CASE WHEN o_orderkey % 8 > 0 THEN floor(o_totalprice) + 0.5 END AS amount,
  CASE WHEN o_orderkey % 6 > 0 THEN make_date(2001, CAST(1 + o_orderkey % 12 AS INT), CAST(1 + o_orderkey % 28 AS INT)) END AS due,
  CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey END AS code,
  CASE o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS answer,
  CASE o_orderkey % 4 WHEN 0 THEN 111 WHEN 3 THEN NULL ELSE 166 END AS method,
  CASE o_orderkey % 5 WHEN 3 THEN 12 WHEN 4 THEN nullif(o_orderkey % 50, 0) END::INT AS quota FROM orders)"""
CLEAN_CHECKS = (("EMAIL MISSING", "email"), ("AMOUNT INVALID", "amount"), ("DATE INVALID", "due"),
                ("CODE INVALID", "code"), ("MODE NOT MAPPED", "method"))


def _checks() -> list[Check]:
    return [Check(text, F.col(name).isNull()) for text, name in CLEAN_CHECKS]


def _case(checks) -> str:
    return "CASE " + " ".join(f"WHEN {c} IS NULL THEN '{m}'" for m, c in checks) + " END"


def _status_sql(checks) -> str:
    return (f"WITH {CLEAN_SQL} SELECT o_orderkey, email, amount, {day('due')} AS due, code, answer,"
            f" method::INT AS method, quota, {_case(checks)} AS remarks,"
            " CASE WHEN remarks IS NULL THEN 'PENDING' ELSE 'FAILED' END AS process_status"
            " FROM clean")


@query("clean_and_validate_first", _status_sql(CLEAN_CHECKS))
def clean_and_validate_first(t: Source) -> DataFrame:
    return first_failure(cleaned_rows(t), _checks())


@query("clean_and_validate_last", _status_sql(tuple(reversed(CLEAN_CHECKS))))
def clean_and_validate_last(t: Source) -> DataFrame:
    return last_failure(cleaned_rows(t), _checks())


@query("clean_and_validate_all", f"""
WITH {CLEAN_SQL}, e AS (SELECT o_orderkey, list_filter([
  {', '.join(f"CASE WHEN {c} IS NULL THEN '{m}' END" for m, c in CLEAN_CHECKS)}], lambda x: x IS NOT NULL) AS errors FROM clean)
SELECT o_orderkey, len(errors)::INT AS n_errors,
  CASE WHEN len(errors) = 0 THEN 'OK' ELSE array_to_string(errors, ' | ') END AS remarks FROM e""")
def clean_and_validate_all(t: Source) -> DataFrame:
    return all_failures(cleaned_rows(t), _checks()).select(
        "o_orderkey", F.size("errors").alias("n_errors"), remark_text().alias("remarks"))


@query("run_summary", f"""
WITH {CLEAN_SQL}, s AS (SELECT CASE WHEN email IS NULL OR amount IS NULL OR due IS NULL OR code IS NULL
  OR method IS NULL THEN 'failed' ELSE 'success' END AS status FROM clean)
SELECT 'run-1' AS run_id, count(*)::BIGINT AS total, count(*) FILTER (WHERE status = 'success')::BIGINT AS succeeded,
  count(*) FILTER (WHERE status = 'failed')::BIGINT AS failed FROM s""")
def run_summary(t: Source) -> DataFrame:
    judged = all_failures(cleaned_rows(t), _checks())
    status = F.when(F.size("errors") == 0, "success").otherwise("failed")
    lines = audit.audit_frame(judged.withColumn("transfer_status", status),
                              ["o_orderkey", "remarks", "transfer_status"], "errors")
    return audit.run_summary(lines, "run-1")


@query("run_summary_written", ORACLES["run_summary"])
def run_summary_written(t: Source) -> DataFrame:
    """The same figures from the pass that writes the audit."""
    judged = all_failures(cleaned_rows(t), _checks())
    status = F.when(F.size("errors") == 0, "success").otherwise("failed")
    lines = audit.audit_frame(judged.withColumn("transfer_status", status),
                              ["o_orderkey", "remarks", "transfer_status"], "errors")
    return audit.write_with_summary(lines, scratch_path(t.spark, "audit"), "run-1")[1]


@query("status_counts", f"""
WITH {CLEAN_SQL} SELECT coalesce({_case(CLEAN_CHECKS)}, 'none') AS remarks, count(*)::BIGINT AS rows
FROM clean GROUP BY 1""")
def status_counts(t: Source) -> DataFrame:
    judged = first_failure(cleaned_rows(t), _checks())
    return audit.status_counts(judged.withColumn("remarks", F.coalesce("remarks", F.lit("none"))),
                               "remarks")


@query("header_contract", """
SELECT 'c_acctbal' AS column_name, 'required' AS state, count(c_acctbal)::BIGINT AS filled, count(*)::BIGINT AS total FROM customer
UNION ALL SELECT 'c_custkey', 'required', count(c_custkey), count(*) FROM customer
UNION ALL SELECT 'c_mktsegment', 'extra', count(nullif(c_mktsegment, 'BUILDING')), count(*) FROM customer
UNION ALL SELECT 'c_nationkey', 'extra', count(c_nationkey), count(*) FROM customer
UNION ALL SELECT 'client_name', 'required', count(c_name), count(*) FROM customer
UNION ALL SELECT 'phone_no', 'missing', 0, count(*) FROM customer""")
def header_contract(t: Source) -> DataFrame:
    messy = t.customer.select(
        F.col("c_custkey").alias("  C_CustKey "), F.col("c_name").alias("Client\nName"),
        F.col("c_nationkey").alias("C_NationKey"), F.col("c_acctbal").alias("C AcctBal."),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c-mktsegment"))
    return schema.contract(messy, ["c_custkey", "client_name", "c_acctbal", "phone_no"])


@query("date_range_report", f"""
SELECT c_mktsegment, count(*)::BIGINT AS n_orders, {ts('max(o_orderdate)')} AS last_order
FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
  AND o_orderpriority = '2-HIGH' GROUP BY c_mktsegment""")
def date_range_report(t: Source) -> DataFrame:
    """Typed arguments in, a frame out, published as a view and read back by name."""
    from tallyroute.sources.files import publish_view

    def report(start: datetime, end: datetime, priority: str | None = None) -> DataFrame:
        rows = t.orders.where(dates.in_range("o_orderdate", start, end))
        if priority is not None:
            rows = rows.where(F.col("o_orderpriority") == priority)
        customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
        return rows.join(customers, "o_custkey").groupBy("c_mktsegment").agg(
            F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order"))

    publish_view(report(datetime(1997, 1, 1), datetime(1999, 1, 1), "2-HIGH"), "range_report")
    return t.spark.table("range_report")


@query("plan_price_lookup", """
SELECT CASE l_linenumber WHEN 1 THEN 'Card' WHEN 2 THEN 'Bank' WHEN 3 THEN 'Cash' END AS mode,
  count(*)::BIGINT AS n FROM lineitem GROUP BY 1""")
def plan_price_lookup(t: Source) -> DataFrame:
    number = F.col("l_linenumber").cast("string")
    names = {"1": "Card", "2": "Bank", "3": "Cash"}
    return t.lineitem.groupBy(cleaning.mapped(number, names).alias("mode")).agg(
        F.count(F.lit(1)).alias("n"))
