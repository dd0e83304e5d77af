"""CRM-shaped tables derived row by row from the driver's tables.

Each table is one projection of one base table, written once for both engines: Spark runs it as
``selectExpr``, the oracle as a common table expression.  Work therefore grows with the data.
Dates of the star schema are moved by ``SHIFT`` days so that they meet the event dates.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SHIFT = 8200
OWNER_SPAN = 150  # orders per supplier at every scale


class Spark:
    text = "STRING"
    stamp = "TIMESTAMP_NTZ"

    @staticmethod
    def arr(*items: str) -> str:
        return f"array({', '.join(items)})"

    @staticmethod
    def pick(index: str, *items: str) -> str:
        return f"element_at(array({', '.join(items)}), CAST(({index}) % {len(items)} + 1 AS INT))"

    @staticmethod
    def days(moment: str, count: str) -> str:
        return f"({moment} + make_dt_interval(CAST({count} AS INT)))"

    @staticmethod
    def div(a: str, b: object) -> str:
        return f"({a} div {b})"


class Duck:
    text = "VARCHAR"
    stamp = "TIMESTAMP"

    @staticmethod
    def arr(*items: str) -> str:
        return f"[{', '.join(items)}]"

    @staticmethod
    def pick(index: str, *items: str) -> str:
        return f"list_extract([{', '.join(items)}], CAST(({index}) % {len(items)} + 1 AS INT))"

    @staticmethod
    def days(moment: str, count: str) -> str:
        return f"({moment} + to_days(CAST({count} AS INT)))"

    @staticmethod
    def div(a: str, b: object) -> str:
        return f"({a} // {b})"


def _int(text: str) -> str:
    return f"CAST({text} AS INT)"


def _big(text: object) -> str:
    return f"CAST({text} AS BIGINT)"


def tables(d: type[Spark] | type[Duck]) -> dict[str, tuple[str, str, dict[str, str]]]:
    """name -> (base table, row condition, column -> expression)."""

    def txt(value: str) -> str:
        return f"CAST({value} AS {d.text})"

    def stamp(value: str) -> str:
        return f"CAST('{value}' AS {d.stamp})"

    def null(kind: str) -> str:
        return f"CAST(NULL AS {kind})"

    plans = ("1", "2", "3", "4", "5", "8", "11", "23", "24")
    o, c, ln = "o_orderkey", "o_custkey", "l_orderkey"
    plan = _int(d.pick(o, *plans))
    product = _int(f"CASE WHEN {plan} <= 4 THEN 1 WHEN {plan} <= 11 THEN 2 ELSE 3 END")
    made = d.days("o_orderdate", str(SHIFT))
    owner = d.div(o, OWNER_SPAN)
    pair = d.div(o, 2)
    substatus = _int(
        f"CASE WHEN {o} % 4 = 0 THEN 29 ELSE 1 + ({o} * 13 + {c} * 7) % 71 END")
    status_of = (
        "CASE WHEN {0} IN (1, 2, 3, 62) THEN 1 WHEN {0} IN (5, 6, 7, 9, 10, 57, 58, 59, 65) THEN 2"
        " WHEN {0} IN (11, 56, 61) THEN 3 WHEN {0} IN (13, 14, 15, 64) THEN 4"
        " WHEN {0} BETWEEN 16 AND 28 OR {0} IN (54, 55, 60) THEN 5"
        " WHEN {0} BETWEEN 29 AND 36 OR {0} IN (52, 53, 71) THEN 6"
        " WHEN {0} BETWEEN 37 AND 50 THEN 7 ELSE 2 END")
    status = _int(status_of.format(substatus))
    line_id = _big(
        f"(({ln} * 8 + l_linenumber) * 100003 + l_partkey % 100003) * 101 + l_suppkey % 101")
    ship = d.days("l_shipdate", str(SHIFT))
    event_lead = d.div("event_id", 4)
    event_owner = d.div(event_lead, OWNER_SPAN)
    loss_mix = ("10", "11", "15", "56", "29", "61")
    clock = (
        "'0' || " + txt("event_id % 3") + " || ':' || lpad(" + txt("event_id % 60")
        + ", 2, '0') || ':' || lpad(" + txt("(event_id * 7) % 60") + ", 2, '0')")
    event_names = ("'Login'", "'Content Abandoned'", "'Content Completed'",
                   "'Course Video Abandoned'", "'Course Video Completed'",
                   "'Podcast Abandoned'", "'Podcast Completed'", "'Workshop Abandoned'",
                   "'Workshop Completed'", "'Quiz Started'", "'Quiz Completed'",
                   "'Course Purchased'", "'Workshop Purchased'")
    categories = ("'Trends that matter'", "'Insightful Shorts'", "'All About Investing'",
                  "'Mission & Vision'", "'Success Stories'", "'ThreeCFrame'", "'Other'")
    sub_categories = ("'Latest Trends'", "'Weekly roundup'", "'Success Stories'",
                      "'Learn From Legends'", "'Invest Like a Pro'", "'Investing Fundas'")
    courses = ("' Investing Basics Course'", "'Fundamental Analysis Course'",
               "'India Story Course'", "'How to Analyse and Invest in CPVC Pipes?'")
    watched = (f"CASE WHEN event_id % 9 = 0 THEN 'n/a' WHEN event_id % 9 = 1 THEN "
               f"{txt('event_id % 500')} ELSE {clock} END")
    length = f"CASE WHEN event_id % 8 = 0 THEN '' ELSE {clock} END"
    points = (f"CASE WHEN event_id % 6 = 0 THEN ', \"User_Points\": \"' || {txt('event_id % 90')}"
              f" || '\"' WHEN event_id % 6 = 1 THEN ', \"User_Points\": \"\"' ELSE '' END")
    meta = (
        "'{\"payload\": {\"Event_Name\": \"' || " + d.pick("event_id", *event_names)
        + " || '\", \"Content_Category\": \"' || " + d.pick(d.div("event_id", 13), *categories)
        + " || '\", \"Content_Sub_Category\": \"' || "
        + d.pick(d.div("event_id", 5), *sub_categories)
        + " || '\", \"Course_Name\": \"' || " + d.pick(d.div("event_id", 3), *courses)
        + " || '\", \"Workshop_Name\": \"Workshop ' || " + txt("event_id % 5")
        + " || '\", \"User_Watched_Time\": \"' || " + watched
        + " || '\", \"Actual_Content_Video_Length\": \"' || " + length + " || '\"' || " + points
        + " || '}, \"status\": \"' || " + d.pick("event_id", "'Sent'", "'Failed'", "'Pending'")
        + " || '\", \"msgs\": [{\"category\": \"' || "
        + d.pick(d.div("event_id", 2), "'Outgoing'", "'Incoming'") + " || '\"}]}'")
    bs = "chr(92)"
    job = "'Job ' || " + txt(f"{c} % 40")
    answers = (
        f"CASE WHEN {o} % 7 = 0 THEN '{{\"occupation\": \"' || {job} || '\"}}'"
        f" WHEN {o} % 7 = 1 THEN '{{\"signing_parties\": [{{\"pki_signature_details\":"
        f" {{\"occupation\": \"' || {job} || '\"}}}}]}}'"
        f" WHEN {o} % 7 = 2 THEN '{{\"actions\": [{{\"a\": 1}}, {{\"details\": {{\"pan\":"
        f" {{\"occupation\": \"' || {job} || '\"}}}}}}]}}'"
        f" WHEN {o} % 7 = 3 THEN '<kyc><occupation>' || {job} || '</occupation></kyc>'"
        f" WHEN {o} % 7 = 4 THEN '\"{{' || {bs} || '\"pan_details' || {bs} || '\": {{' || {bs}"
        f" || '\"occupation' || {bs} || '\": ' || {bs} || '\"' || {job} || {bs} || '\"}}}}\"'"
        f" WHEN {o} % 7 = 5 THEN '{{\"occupation\": ' ELSE '{{\"kyc\": 1}}' END")
    sources = ("'quora'", "'Missed Call'", "'Youtube'", "'YAHOO'", "'organic search'",
               "'Inbound Phone call'", "'Old customer'", "'fball_ads'", "'Outbrain_x'",
               "'Google_Discovery'", "'google_nonbrand'", "'Affiliate_z'", "'DSP_programmatic'",
               "'my Website'", "'radio'", null(d.text), null(d.text))
    chat_info = (
        "CASE WHEN " + o + " % 8 = 0 THEN '{}' ELSE '{\"utm_medium\": \"m' || "
        + txt(f"{o} % 4") + " || '\", \"utm_source\": \"s' || " + txt(f"{o} % 5")
        + " || '\", \"page_url\": \"/p/' || " + txt(f"{o} % 6") + " || '\"}' END")
    who = {"created_by": _big("1"), "updated_by": _big("1")}

    def master(key: str, label: str, **more: str) -> tuple[str, str, dict[str, str]]:
        """A master table with a row per part; facts use its first ids, it grows with the data."""
        return ("part", "",
                {key: _int("p_partkey"), "name": f"'{label} ' || {txt('p_partkey')}", **more})

    return {
        "contact": ("customer", "", {
            "contact_id": "c_custkey", "full_name": "c_name",
            "mobile_number": f"'9' || lpad({txt('c_custkey')}, 9, '0')",
            "email_address": f"CASE WHEN c_custkey % 7 = 0 THEN ' User' || {txt('c_custkey')}"
                             f" || '@Example.org ' ELSE 'user' || {txt('c_custkey')}"
                             " || '@example.org' END",
            "is_active": "c_custkey % 17 <> 0",
            "created_at": d.days(stamp("2017-01-01"), "c_custkey % 2000")}),
        "contact_demography": ("customer", "", {
            "contact_demography_id": "c_custkey", "contact_id": d.div("c_custkey", 2),
            "gender": d.pick("c_custkey", "'F'", "'M'", null(d.text)),
            "income": "c_mktsegment"}),
        "contact_address_detail": ("orders", "", {
            "contact_address_detail_id": o, "contact_id": c, "is_primary": f"{o} % 2 = 0",
            "pin_code": f"lpad({txt(f'{o} % 999983')}, 6, '1')", "state_id": _int(f"{o} % 25"),
            "city_id": _int(f"{o} % 30"), "updated_at": made}),
        "lead": ("orders", "", {
            "lead_id": o, "lead_number": _big(f"100000 + {o}"), "contact_id": c,
            "rm_id": owner, "company_id": _int("1"),
            "lead_source_id": _int(f"CASE WHEN {o} % 23 = 0 THEN 57 ELSE 1 + {o} % 6 END"),
            "product_id": product,
            "sub_product_ids": f"CASE WHEN {o} % 19 = 0 THEN NULL ELSE "
                               + d.arr(plan, _int(d.pick(d.div(o, 7), "1", "4", "5", "99")))
                               + " END",
            "status_id": status, "substatus_id": substatus, "is_active": f"{o} % 10 <> 0",
            "utm_source": d.pick(o, *sources), "utm_medium": f"'m' || {txt(f'{o} % 4')}",
            "utm_campaign": f"'c' || {txt(f'{o} % 9')}",
            "utm_content": f"'t' || {txt(f'{o} % 3')}", "page_url": f"'/p/' || {txt(f'{o} % 6')}",
            "created_at": made,
            "updated_at": f"CASE WHEN {o} % 11 = 0 THEN NULL ELSE {d.days(made, f'{o} % 90')} END",
            **who}),
        "lead_log": ("lineitem", "", {
            "log_id": line_id, "lead_id": ln, "rm_id": "l_suppkey",
            "status_id": _int(status_of.format("(1 + (l_partkey + l_linenumber) % 70)")),
            "substatus_id": _int("1 + (l_partkey + l_linenumber) % 70"),
            "product_id": _int("1 + l_linenumber % 3"),
            "sub_product_ids": d.arr(_int("l_linenumber"), _int("l_partkey % 35")),
            "utm_source": "l_returnflag", "utm_medium": "l_linestatus",
            "utm_campaign": f"'c' || {txt('l_linenumber')}",
            "utm_content": f"'t' || {txt('l_linenumber')}",
            "page_url": f"'/p/' || {txt('l_linenumber')}", "created_at": ship,
            "updated_at": d.days(ship, "3"), "log_timestamp": d.days(ship, "1")}),
        "payment": ("orders", f"{o} % 6 <> 5", {
            "payment_id": f"{o} + 1", "onboarding_id": o, "contact_id": c, "lead_id": o,
            "external_customer_id": f"{c} + 500000", "sub_product_id": plan,
            "payment_provider": _int(d.pick(o, "166", "167", "304", "305", "168", "231")),
            "payment_method": _int(
                d.pick(d.div(o, 3), "110", "115", "117", "113", "111", "112", "109", "114")),
            "amount": "o_totalprice", "provider_reference_id": f"'ref' || {txt(o)}",
            "payment_date": d.days(made, f"{o} % 40"), "created_by": owner}),
        "offline_payment": ("orders", f"{o} % 8 = 0", {
            "offline_payment_id": f"{o} + 1",
            "payment_id": f"CASE WHEN {o} % 16 = 0 THEN {o} + 1 END", "onboarding_id": o,
            "contact_id": c, "external_customer_id": f"{c} + 500000", "lead_id": o,
            "amount": _big("floor(o_totalprice)"), "sub_product_id": plan, "payment_method": _int("111"),
            "payment_utr_number": f"'utr' || {txt(o)}",
            "payment_date": d.days(made, f"{o} % 25"), "net_amount": _big("floor(o_totalprice)"),
            "status": f"CASE WHEN {o} % 16 = 0 THEN 'Approved' ELSE 'Pending' END",
            "company_id": _int("1"), "instalment_id": d.arr(_big(o)),
            "meta_info": "'{}'", "discount_amount": _big("0"),
            "discount_percentage": _big("0"), "created_at": made, "updated_at": made, **who}),
        "instalment": ("lineitem", "", {
            "instalment_id": line_id, "lead_id": ln, "onboarding_id": ln,
            "external_customer_id": f"{ln} + 700000", "sub_product_id": _int(d.pick(ln, *plans)),
            "instalment_number": _int("l_linenumber - 1"), "amount": "l_extendedprice",
            "balance_amount": "CASE WHEN l_linestatus = 'O' THEN l_extendedprice"
                              " ELSE CAST(0 AS DOUBLE) END",
            "payment_id": f"CASE WHEN l_linenumber <= 5 THEN {d.arr(f'{ln} + 1')}"
                          f" WHEN l_linenumber = 6 THEN {d.arr(f'{ln} + 1', f'{ln} + 2')} END",
            "payable_on": ship, "created_at": ship}),
        "onboarding": ("orders", "", {
            "onboarding_id": o, "contact_id": c, "lead_id": o, "sub_product_id": plan,
            "status_id": _int(f"CASE WHEN {o} % 13 = 0 THEN 35 ELSE 6 END"),
            "substatus_id": substatus, "subscription_start_date": made,
            "subscription_expiry_date": d.days(made, f"200 + ({o} * 37) % 700"),
            "adjustment_amount": "o_totalprice", "rm_id": owner, "created_by": owner,
            "created_at": made}),
        "onboarding_detail": ("orders", "", {
            "onboarding_detail_id": o, "onboarding_id": pair,
            "date_of_birth": f"CASE WHEN {o} % 7 = 0 THEN NULL ELSE "
                             + d.days(stamp("1960-01-01"), f"({c} * 11) % 16000") + " END"}),
        "onboarding_api_response": ("orders", "", {
            "response_id": o, "onboarding_id": o, "response": answers}),
        "activity": ("events", "", {
            "activity_id": "event_id", "lead_id": event_lead, "contact_id": "user_id",
            "rm_id": event_owner, "meta_info": meta,
            "created_by": f"CASE WHEN event_id % 7 = 0 THEN 1 ELSE {event_owner} END",
            "activity_type_id": _int(
                "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 7 WHEN 'signup' THEN 2"
                " WHEN 'purchase' THEN 3 ELSE 4 END"),
            "origin": d.pick("event_id", "'Outbound'", "'inbound'"),
            "call_duration": "CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1"
                             " THEN CAST(0 AS DOUBLE) ELSE value * 10 END",
            "status_id": _int("2"), "substatus_id": _int(d.pick("event_id", *loss_mix)),
            "comment_ids": "CASE WHEN event_id % 4 = 0 THEN " + d.arr("33", "40")
                           + " WHEN event_id % 4 = 1 THEN " + d.arr("36")
                           + " WHEN event_id % 4 = 2 THEN " + d.arr("61", "62", "61") + " END",
            "additional_comments": f"'note ' || {txt('event_id')}", "created_at": "ts"}),
        "status_log": ("events", "", {
            "status_log_id": "event_id", "lead_id": event_lead, "contact_id": "user_id",
            "status_id": _int("2"), "rm_id": event_owner,
            "substatus_id": _int(
                "CASE WHEN event_type IN ('error', 'view') THEN "
                + d.pick("event_id", *loss_mix) + " ELSE "
                + d.pick("event_id", "1", "2", "3", "29", "35") + " END"),
            "created_at": "ts", "updated_at": d.days("ts", "1")}),
        "call_log": ("events", "event_type IN ('click', 'signup', 'purchase')", {
            "created_by": event_owner,
            "lead_id": f"CASE WHEN event_id % 10 = 0 THEN NULL ELSE {event_lead} END",
            "created_at": "ts",
            "call_duration": "CASE WHEN event_id % 6 = 0 THEN CAST(0 AS DOUBLE) ELSE value * 7 END",
            "status_details": d.pick("event_id", "'NoAnswer'", "'NormalCallClearing'",
                                     "'NormalUnspecified'", "'Busy'"),
            "call_status": d.pick(d.div("event_id", 2), "'not_answered'", "'answered'")}),
        "user_login_log": ("events", "", {
            "user_id": event_owner, "log_time": "ts"}),
        "follow_up": ("orders", "", {
            "follow_up_id": o, "company_id": _int("1"), "lead_id": pair, "onboarding_id": pair,
            "contact_id": c, "rm_id": d.div(pair, OWNER_SPAN), "customer_id": null("BIGINT"),
            "activity_type_id": _int("1"), "status_id": _int("6"),
            "substatus_id": _int(f"CASE WHEN {o} % 3 = 1 THEN 29 ELSE 5 END"),
            "follow_up": d.days(made, f"{o} % 30"), "is_completed": f"{o} % 3 = 0",
            "completed_on": f"CASE WHEN {o} % 3 = 0 THEN {d.days(made, f'{o} % 35')} END",
            "reference_id": o, "source": d.pick(o, "'whatsapp'", "'app'", "'web'"),
            "source_info": chat_info, "created_at": made, "updated_at": d.days(made, "2"),
            **who}),
        "feedback_response": ("orders", "", {
            "feedback_response_id": o, "company_id": _int("1"), "lead_id": pair,
            "contact_id": c, "onboarding_id": pair,
            "assigned_to": f"CASE WHEN {o} % 29 = 0 THEN NULL ELSE {d.div(pair, OWNER_SPAN)} END",
            "color": d.pick(d.div(o, 2), "'GREEN'", null(d.text), "'RED'", null(d.text),
                            "'ORANGE'"),
            "type": d.pick(o, "'FEEDBACK'", "'FEEDBACK'", "'OTHER'"),
            "completed_on": f"CASE WHEN {o} % 4 = 0 THEN {d.days(made, '9')} END",
            "feedback_for_date": made, "created_at": made, "updated_at": made, **who}),
        "contact_mapping": ("orders", "", {
            "mapping_id": o, "contact_id": c, "rm_id": owner,
            "lead_id": f"CASE WHEN {o} % 3 = 2 THEN {o} - 1 ELSE {o} END",
            "type": f"CASE WHEN {o} % 5 = 4 THEN 'Customer Service' ELSE 'Sales' END",
            "is_transferred": f"{o} % 12 IN (1, 2)", "from_date": f"CAST({made} AS DATE)",
            "end_date": f"CASE WHEN {o} % 12 IN (1, 2) THEN {d.days(made, '50')} END",
            "company_id": _int("1"), "created_at": made, "updated_at": d.days(made, "50"),
            **who}),
        "contact_mapping_log": ("orders", "", {
            "log_id": o, "mapping_id": d.div(o, 3), "rm_id": owner,
            "end_date": f"CASE WHEN {o} % 2 = 0 THEN {d.days(made, '5')} END",
            "is_transferred": f"{o} % 2 = 0", "updated_at": made, "updated_by": _big("1"),
            "log_timestamp": made}),
        "contact_transfer_backup": ("orders", f"{o} % 36 = 1", {
            "lead_id": o, "rm_id": f"{owner} + 1", "old_rm_id": owner, "status_id": status,
            "substatus_id": substatus, "mapping_id": o, "created_at": made,
            "session_id": _big(f"1 + {o} % 5")}),
        "pool_contact_mapping": ("orders", "", {
            "pool_mapping_id": o, "lead_id": pair, "location_id": _int(f"{o} % 25"),
            "rm_id": f"CASE WHEN {o} % 5 = 0 THEN NULL ELSE {owner} END",
            "is_taken": f"{o} % 3 <> 0", "is_mapped": f"{o} % 4 = 0",
            "is_active": f"{o} % 7 <> 0"}),
        "sales_flat_data": ("orders", f"{o} % 2 = 0", {
            "lead_id": pair, "payment_date": d.days(made, "11")}),
        "payment_collection": ("orders", "", {
            "payment_collection_id": o, "lead_id": pair, "assigned_to": d.div(pair, OWNER_SPAN),
            "status_id": _int("7"), "substatus_id": _int(f"CASE WHEN {o} % 3 = 0 THEN 43 ELSE 41 END"),
            "department_id": _int("18")}),
        "refund": ("orders", f"{o} % 100 = 0", {"refund_id": f"{o} + 1", "contact_id": c}),
        "target_management": ("supplier", "", {
            "rm_id": "s_suppkey", "created_at": stamp("2024-01-01"),
            "start_date": d.days(stamp("2024-01-01"), "s_suppkey % 28"),
            "conversion_count": _int("s_suppkey % 20"), "arpa_amount": "s_acctbal",
            "arft_amount": "s_acctbal", "emandate_count": _int("s_suppkey % 7"),
            "cash_flow_amount": "s_acctbal", "cash_flow_count": _int("s_suppkey % 9")}),
        "mst_user": ("supplier", "", {
            "user_id": "s_suppkey",
            "full_name": f"CASE WHEN s_suppkey % 7 > 0 THEN 'Owner ' || {txt(d.div('s_suppkey', 2))} END",
            "email_address": f"'owner' || {txt('s_suppkey')} || '@example.org'",
            "is_active": "s_suppkey % 9 <> 0", "location_id": "s_nationkey",
            "department_id": _int("s_suppkey % 5"),
            "reporting_manager_id": f"CASE WHEN s_suppkey > 0 THEN {d.div('s_suppkey', 3)} END",
            "sub_product_ids": d.arr(_int("s_suppkey % 31"), _int("1 + s_suppkey % 4"),
                                     _int("23 + s_suppkey % 9")),
            "sip_number": f"CASE WHEN s_suppkey % 5 > 0 THEN 'sip' || {txt('s_suppkey')} END"}),
        "mst_location": ("nation", "", {
            "location_id": "n_nationkey", "name": "n_name"}),
        "mst_state": ("nation", "", {"state_id": "n_nationkey", "name": "n_name"}),
        "mst_city": ("nation", "", {"city_id": "n_nationkey", "name": "'City of ' || n_name"}),
        "mst_department": ("region", "", {
            "department_id": "r_regionkey", "short_name": "r_name",
            "group_name": "CASE WHEN r_regionkey % 2 = 0 THEN 'Inside SALES'"
                          " ELSE 'Support' END"}),
        "mst_status": master("status_id", "Status"),
        "mst_substatus": master("substatus_id", "Substatus"),
        "mst_lead_source": master("lead_source_id", "Source"),
        "mst_product": master("product_id", "Product", code=f"'PR' || {txt('p_partkey')}"),
        "mst_subproduct": master(
            "sub_product_id", "Plan", code=f"'PL' || {txt('p_partkey')}",
            product_id=_int("CASE WHEN p_partkey <= 4 THEN 1 WHEN p_partkey <= 11 THEN 2"
                            " ELSE 3 END"),
            is_active="p_partkey % 10 <> 9"),
        "mst_comment": ("part", "", {
            "comment_id": _int("p_partkey"),
            "name": "CASE p_partkey WHEN 33 THEN 'Detail conversation-Sales Pitch'"
                    " WHEN 36 THEN 'Not Answered' WHEN 61 THEN 'Detail Conversation'"
                    " WHEN 62 THEN 'Had a Phone Conversation' ELSE 'Other note' END"}),
        "mst_reason": ("part", "", {
            "reason_id": _int("p_partkey"),
            "code": f"' Reason ' || {txt('p_partkey % 12')} || ' '"}),
    }


_SPARK, _DUCK = tables(Spark), tables(Duck)


class CrmTables(dict):
    """Lazily built CRM tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        super().__init__()
        self.spark, self.folder = spark, folder
        self._bases: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        """Base table, opened once, so that its footer is read once per query."""
        if name not in self._bases:
            self._bases[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._bases[name]

    def __missing__(self, name: str) -> DataFrame:
        base, condition, columns = _SPARK[name]
        df = self.base(base)
        if condition:
            df = df.where(condition)
        self[name] = df.selectExpr(*[f"{text} AS `{column}`" for column, text in columns.items()])
        return self[name]


def oracle_tables(names: Iterable[str]) -> str:
    """``name AS (SELECT …)`` list for a WITH clause; each table is called ``crm_<name>``."""
    parts = []
    for name in names:
        base, condition, columns = _DUCK[name]
        body = ", ".join(f"{text} AS {column}" for column, text in columns.items())
        where = f" WHERE {condition}" if condition else ""
        parts.append(f"crm_{name} AS (SELECT {body} FROM {base}{where})")
    return ",\n".join(parts)
