"""What the reports must say, written out for the oracles alone.

Nothing here is used by a plan, and nothing here comes from one: rule lists, measures and event
names stand as text, so a slip in the library shows as a difference.  Fixed values.
"""

from __future__ import annotations

from collections.abc import Iterable


def first_of(rules: Iterable[tuple[str, str]], default: str) -> str:
    """Label of the first rule that holds."""
    tried = ", ".join(f"CASE WHEN {condition} THEN '{label}' END" for condition, label in rules)
    return f"coalesce({tried}, '{default}')"


def by_family(lists: dict[str, list[tuple[str, str]]], default: str) -> str:
    return "CASE family " + " ".join(
        f"WHEN '{family}' THEN {first_of(rules, default)}" for family, rules in lists.items()
    ) + f" ELSE '{default}' END"


#: what a noted comment tells of a call, and what the length of a call itself tells
OUTCOME_OF_COMMENT = {36: "called", 33: "detail_conversation", 61: "detail_conversation",
                      62: "phone_conversation"}
OUTCOME_OF_LENGTH = {"none": "called", "short": "phone_conversation",
                     "long": "detail_conversation"}
#: a call without length counts by itself only if it is logged as a call
LOGGED_CALL, LONG_SECONDS = 1, 600

_SWITCH = "opening AND prior_opening AND (refunded OR (other_plan AND in_force))"

PAYMENT_STATUS = by_family({
    "retail": [
        ("later", "Partpayment"),
        ("opening AND same_plan AND in_force", "Retail Renewal"),
        ("first_opening OR (opening AND prior_family = 'bundle') OR (opening AND lapsed)",
         "New Retail"),
        (_SWITCH, "New Retail"),
    ],
    "retail_plus": [
        ("later", "Partpayment"),
        ("first_opening OR (opening AND prior_family = 'bundle')"
         " OR (opening AND prior_family = 'advisory')", "New Retail Plus"),
        ("prior_family = 'retail' AND (lapsed OR (opening AND prior_opening AND refunded))",
         "New Retail Plus"),
        ("prior_family = 'retail' AND in_force", "Existing Upgrade"),
    ],
    "advisory": [
        ("later", "Partpayment"),
        ("opening AND same_plan AND in_force", "Renewal Advisory"),
        ("first_opening OR (opening AND lapsed)", "New Advisory"),
        ("opening AND prior_family IN ('retail', 'retail_plus', 'bundle')", "New Advisory"),
        (_SWITCH, "New Advisory"),
    ],
    "advisory_plus": [
        ("later", "Partpayment"),
        ("first_opening", "New Advisory Plus"),
        ("opening AND in_force AND prior_family IN ('retail', 'retail_plus', 'bundle')",
         "New Advisory Plus"),
        ("prior_family = 'advisory' AND (lapsed OR (opening AND prior_opening AND refunded))",
         "New Advisory Plus"),
        ("prior_family = 'advisory' AND in_force", "Existing Upgrade"),
    ],
    "bundle": [
        ("same_plan AND in_force", "Renewal Bundle"),
        ("first_opening", "New Bundle"),
        ("opening AND other_plan", "New Bundle"),
        ("same_plan AND lapsed", "New Bundle"),
    ],
}, "Unknown Status")

SCENARIO = by_family({
    "retail": [
        ("first_opening", "New Retail"),
        ("opening AND same_plan AND in_force", "Before Expiry"),
        ("later", "Retail Renewal Tranche 2"),
        ("opening AND prior_family = 'bundle'", "Existing upgrade to Retail"),
        ("opening AND lapsed", "Expired to customer"),
        ("opening AND prior_opening AND refunded", "Refund to customer"),
        ("opening AND prior_opening AND other_plan AND in_force", "Deactivated to customer"),
    ],
    "retail_plus": [
        ("first_opening", "New Retail Plus"),
        ("opening AND (prior_family = 'bundle' OR prior_family = 'advisory')", "New Retail Plus"),
        ("later", "Retail Plus Partpayment"),
        ("prior_family = 'retail' AND lapsed", "Expired to customer"),
        ("prior_family = 'retail' AND opening AND prior_opening AND refunded",
         "Refund to customer"),
        ("prior_family = 'retail' AND in_force", "Existing Upgrade To Retail Plus"),
    ],
    "advisory": [
        ("first_opening", "New Advisory"),
        ("opening AND same_plan AND in_force", "Before Expiry"),
        ("later", "Advisory Renewal Tranche 2"),
        ("opening AND prior_family IN ('retail', 'retail_plus', 'bundle')", "New Advisory"),
        ("opening AND lapsed", "Expired to customer"),
        ("opening AND prior_opening AND refunded", "Refund to customer"),
        ("opening AND prior_opening AND other_plan AND in_force", "Deactivated to customer"),
    ],
    "advisory_plus": [
        ("first_opening", "New Advisory Plus"),
        ("opening AND in_force AND prior_family IN ('retail', 'retail_plus', 'bundle')",
         "New Advisory Plus (Existing Upgrade)"),
        ("prior_family = 'advisory' AND lapsed", "Expired to customer"),
        ("prior_family = 'advisory' AND opening AND prior_opening AND refunded",
         "Refund to customer"),
        ("prior_family = 'advisory' AND in_force", "Existing Upgrade To Advisory Plus"),
        ("later", "Advisory Plus Partpayment"),
    ],
    "bundle": [
        ("first_opening", "New Bundle"),
        ("opening AND other_plan", "New Bundle"),
        ("same_plan AND in_force", "Before Expiry"),
        ("same_plan AND lapsed", "Expired to customer"),
    ],
}, "Unknown Scenario")

#: substatus -> measure, per status
FUNNEL = {
    1: {1: "untagged", 2: "new_lead", 3: "repeat_lead", 62: "existing_customer"},
    2: {5: "not_pitched", 6: "pitched", 7: "forwarded", 9: "language_barrier",
        10: "not_reachable", 57: "pre_sales_qualified", 58: "invalid", 59: "dnd",
        65: "work_to_non_work_c"},
    3: {11: "not_interested", 56: "customer_declined", 61: "no_progress"},
    4: {13: "hot", 14: "warm", 15: "cold", 64: "work_to_non_work_i"},
    5: {16: "in_process", 17: "email_otp_verified", 18: "mobile_otp_verified",
        19: "pan_verified", 20: "ckyc_verified", 21: "kra_verified", 22: "risk_profile",
        23: "portfolio_selection", 24: "suitability_assessment", 25: "agreement_signed",
        26: "payment_pending", 27: "payment_received", 28: "subscription_started",
        54: "payment_adjusted", 55: "onboarding_closed", 60: "self_kyc_verified"},
    6: {29: "active", 30: "deactivated_s", 31: "extended", 32: "expired", 33: "refund_requested",
        34: "refund_processing", 35: "refunded", 36: "cancelled", 52: "upgraded",
        53: "downgraded", 71: "refund_rejected"},
    7: {37: "assigned", 38: "unreachable", 39: "contacted", 40: "neutral_response",
        41: "positive_response", 42: "ticket_raised", 43: "payment_link_sent",
        44: "payment_collected", 45: "transfer_requested", 46: "transferred",
        47: "deactivation_requested", 48: "deactivation_request_rejected", 49: "deactivated_c",
        50: "closed"},
}
#: measures of a whole status
WHOLE_STATUS = {1: "status_new_lead", 4: "status_interested", 5: "status_onboarding",
                6: "status_subscription", 7: "status_collections"}
#: measures that count rows of the last 60 days only
RECENT = ("language_barrier", "not_reachable", "not_interested")


def funnel_measures() -> dict[str, str]:
    """Measure -> condition, as of 5 February 2024."""
    seen = "coalesce(updated_at, created_at)"
    since_60, since_59 = "TIMESTAMP '2023-12-07'", "TIMESTAMP '2023-12-08'"
    out = {}
    for status, names in FUNNEL.items():
        if status in WHOLE_STATUS:
            out[WHOLE_STATUS[status]] = f"status_id = {status}"
        for substatus, name in names.items():
            recent = f" AND {seen} >= {since_60}" if name in RECENT else ""
            out[name] = f"substatus_id = {substatus} AND status_id = {status}{recent}"
    out["status_contacted"] = (
        "is_active AND (substatus_id IN (5, 6, 7, 57, 58, 59, 65)"
        f" OR (substatus_id BETWEEN 9 AND 10 AND {seen} >= {since_60}))")
    out["status_not_interested"] = (
        f"is_active AND (substatus_id IN (56, 61) OR (substatus_id = 11 AND {seen} >= {since_60}))")
    out["grand_total"] = (
        f"is_active AND substatus_id IS NOT NULL AND (substatus_id NOT BETWEEN 9 AND 11"
        f" OR {seen} >= {since_59})")
    return out


#: notes of a call or a note activity
NOTES = {
    "not_answered": "Not Answered",
    "sales_pitch": "Detail conversation-Sales Pitch",
    "detail_conversation": "Detail Conversation",
    "phone_conversation": "Had a Phone Conversation",
}
CALL_MEASURES = (
    "called", "phone_conversation", "detailed_conversation", "notes_not_answered",
    "notes_sales_pitch", "notes_detail_conversation", "notes_phone_conversation",
    "call_not_answered", "call_sales_pitch", "call_detail_conversation",
    "call_phone_conversation",
)

PAYLOAD_FIELDS = (
    "Event_Name", "Content_Category", "Content_Sub_Category", "Course_Name", "Workshop_Name",
    "User_Watched_Time", "Actual_Content_Video_Length", "User_Points",
)
#: group, condition, stem of its two event names
WATCH = (
    ("latest_trends", "Content_Sub_Category = 'Latest Trends'"
     " AND Content_Category = 'Trends that matter'", "Content"),
    ("weekly_roundup", "Content_Sub_Category = 'Weekly roundup'"
     " AND Content_Category = 'Trends that matter'", "Content"),
    ("insightful_shorts", "Content_Category = 'Insightful Shorts'", "Content"),
    ("success_stories", "Content_Sub_Category = 'Success Stories'"
     " AND Content_Category = 'All About Investing'", "Content"),
    ("learn_from_legends", "Content_Sub_Category = 'Learn From Legends'"
     " AND Content_Category = 'All About Investing'", "Content"),
    ("invest_like_a_pro", "Content_Sub_Category = 'Invest Like a Pro'"
     " AND Content_Category = 'All About Investing'", "Content"),
    ("investing_fundas", "Content_Sub_Category = 'Investing Fundas'"
     " AND Content_Category = 'All About Investing'", "Content"),
    ("mission_vision", "regexp_full_match(Content_Category, 'Mission (& )?Vision')", "Content"),
    ("testimonials", "Content_Category = 'Success Stories'", "Content"),
    ("framework", "Content_Category = 'ThreeCFrame'", "Content"),
    ("basics_course", "Course_Name = ' Investing Basics Course'", "Course Video"),
    ("fundamental_course", "trim(Course_Name) = 'Fundamental Analysis Course'", "Course Video"),
    ("india_course", "trim(Course_Name) = 'India Story Course'", "Course Video"),
    ("pipes_course", "trim(Course_Name) = 'How to Analyse and Invest in CPVC Pipes?'",
     "Course Video"),
    ("podcasts", "TRUE", "Podcast"),
    ("workshops", "TRUE", "Workshop"),
)


def _quiz(event: str, course: str) -> str:
    return f"trim(Course_Name) = '{course}' AND trim(Event_Name) = '{event}'"


EVENTS = {
    "logins": "Event_Name = 'Login'",
    "quiz_started_basics": _quiz("Quiz Started", "Investing Basics Course"),
    "quiz_started_fundamental": _quiz("Quiz Started", "Fundamental Analysis Course"),
    "quiz_started_india": _quiz("Quiz Started", "India Story Course"),
    "quiz_completed_basics": _quiz("Quiz Completed", "Investing Basics Course"),
    "quiz_completed_fundamental": _quiz("Quiz Completed", "Fundamental Analysis Course"),
    "quiz_completed_india": _quiz("Quiz Completed", "India Story Course"),
    "courses_purchased": "trim(Event_Name) = 'Course Purchased'",
    "workshops_purchased": "trim(Event_Name) = 'Workshop Purchased'",
}

LINKS = ("utm_medium", "utm_source", "utm_campaign", "utm_content", "page_url")
