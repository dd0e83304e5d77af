"""Fixed values of the CRM domain: ids, names and the ordered rule lists built on them.

Display names of plan families are parameters, so a site puts its own names into the labels.
"""

from __future__ import annotations

from collections.abc import Mapping

from tallyroute.functions.rules import Rule, case_text, in_list, nested_case_text

# --- plan families (fixed values) ---------------------------------------------------------

FAMILY_PLANS: dict[str, tuple[int, ...]] = {
    "retail": (1, 2, 3),
    "retail_plus": (4,),
    "advisory": (5, 8),
    "advisory_plus": (11,),
    "bundle": (23, 24, 25, 26, 27, 28, 29, 30),
}

FAMILY_NAMES: dict[str, str] = {
    "retail": "Retail",
    "retail_plus": "Retail Plus",
    "advisory": "Advisory",
    "advisory_plus": "Advisory Plus",
    "bundle": "Bundle",
}

REFUNDED_STATUS = 35


def family_text(column: str) -> str:
    """Family key of a plan id column, NULL for a plan outside every family."""
    return case_text(
        [(in_list(column, plans), family) for family, plans in FAMILY_PLANS.items()], None
    )


# --- payment scenarios --------------------------------------------------------------------
#
# The rules read these facts about one payment and the payment before it:
#   family, prior_family    plan family now / before
#   first_opening           first payment of the contact and opening instalment
#   opening, later          instalment number is 0 / at least 1
#   same_plan, other_plan   plan equals / differs from the plan before
#   in_force, lapsed        plan before ends on or after / before the payment day
#   prior_opening           the payment before was an opening instalment
#   refunded                the contract before was refunded
# A fact about a missing payment before is NULL, and a NULL condition never holds.


def payment_rules(names: Mapping[str, str] = FAMILY_NAMES) -> dict[str, list[Rule]]:
    """Coarse status per family; an instalment after the opening one is always a part payment."""
    part = ("later", "Partpayment")

    def new(family: str) -> str:
        return f"New {names[family]}"

    return {
        "retail": [
            part,
            ("opening AND same_plan AND in_force", f"{names['retail']} Renewal"),
            ("first_opening", new("retail")),
            ("opening AND (prior_family = 'bundle' OR lapsed)", new("retail")),
            ("opening AND prior_opening AND (refunded OR other_plan AND in_force)", new("retail")),
        ],
        "retail_plus": [
            part,
            ("first_opening", new("retail_plus")),
            ("opening AND prior_family IN ('bundle', 'advisory')", new("retail_plus")),
            ("prior_family = 'retail' AND lapsed", new("retail_plus")),
            ("prior_family = 'retail' AND opening AND prior_opening AND refunded",
             new("retail_plus")),
            ("prior_family = 'retail' AND in_force", "Existing Upgrade"),
        ],
        "advisory": [
            part,
            ("opening AND same_plan AND in_force", f"Renewal {names['advisory']}"),
            ("first_opening", new("advisory")),
            ("opening AND (prior_family IN ('bundle', 'retail', 'retail_plus') OR lapsed)",
             new("advisory")),
            ("opening AND prior_opening AND (refunded OR other_plan AND in_force)",
             new("advisory")),
        ],
        "advisory_plus": [
            part,
            ("first_opening", new("advisory_plus")),
            ("opening AND in_force AND prior_family IN ('bundle', 'retail', 'retail_plus')",
             new("advisory_plus")),
            ("prior_family = 'advisory' AND lapsed", new("advisory_plus")),
            ("prior_family = 'advisory' AND opening AND prior_opening AND refunded",
             new("advisory_plus")),
            ("prior_family = 'advisory' AND in_force", "Existing Upgrade"),
        ],
        "bundle": [
            ("same_plan AND in_force", f"Renewal {names['bundle']}"),
            ("first_opening OR opening AND other_plan OR same_plan AND lapsed", new("bundle")),
        ],
    }


def scenario_rules(names: Mapping[str, str] = FAMILY_NAMES) -> dict[str, list[Rule]]:
    """Fine label per family; here the plan before may decide ahead of the instalment number."""
    expired, refund, moved = "Expired to customer", "Refund to customer", "Deactivated to customer"

    def comeback(scope: str) -> list[Rule]:
        return [
            (f"{scope} AND lapsed", expired),
            (f"{scope} AND opening AND refunded AND prior_opening", refund),
        ]

    def repeat_sale(family: str, crossing: Rule) -> list[Rule]:
        return [
            ("first_opening", f"New {names[family]}"),
            ("opening AND same_plan AND in_force", "Before Expiry"),
            ("later", f"{names[family]} Renewal Tranche 2"),
            crossing,
            *comeback("opening"),
            ("opening AND other_plan AND prior_opening AND in_force", moved),
        ]

    return {
        "retail": repeat_sale(
            "retail",
            ("opening AND prior_family = 'bundle'", f"Existing upgrade to {names['retail']}"),
        ),
        "advisory": repeat_sale(
            "advisory",
            ("opening AND prior_family IN ('bundle', 'retail', 'retail_plus')",
             f"New {names['advisory']}"),
        ),
        "retail_plus": [
            ("first_opening", f"New {names['retail_plus']}"),
            ("opening AND prior_family IN ('bundle', 'advisory')", f"New {names['retail_plus']}"),
            ("later", f"{names['retail_plus']} Partpayment"),
            *comeback("prior_family = 'retail'"),
            ("prior_family = 'retail' AND in_force",
             f"Existing Upgrade To {names['retail_plus']}"),
        ],
        "advisory_plus": [
            ("first_opening", f"New {names['advisory_plus']}"),
            ("opening AND in_force AND prior_family IN ('bundle', 'retail', 'retail_plus')",
             f"New {names['advisory_plus']} (Existing Upgrade)"),
            *comeback("prior_family = 'advisory'"),
            ("prior_family = 'advisory' AND in_force",
             f"Existing Upgrade To {names['advisory_plus']}"),
            ("later", f"{names['advisory_plus']} Partpayment"),
        ],
        "bundle": [
            ("first_opening OR opening AND other_plan", f"New {names['bundle']}"),
            ("same_plan AND in_force", "Before Expiry"),
            ("same_plan AND lapsed", expired),
        ],
    }


def payment_status_text(names: Mapping[str, str] = FAMILY_NAMES) -> str:
    return nested_case_text("family", payment_rules(names), "Unknown Status")


def scenario_text(names: Mapping[str, str] = FAMILY_NAMES) -> str:
    return nested_case_text("family", scenario_rules(names), "Unknown Scenario")


# --- payment modes (fixed values) ---------------------------------------------------------

ANY_BANK = (168, 169, 170, 304, 305)
GATEWAY_METHODS = (109, 110, 111, 112, 113, 114, 115, 116)

#: mode, payment methods, payment providers, payment type (None: either)
PAYMENT_MODES = (
    ("Cheque", (110,), ANY_BANK, None),
    ("Old-Razorpay", GATEWAY_METHODS, (166,), "Offline"),
    ("New-Razorpay", GATEWAY_METHODS, (166,), "Online"),
    ("Instamojo", (109, 115), (167,), None),
    ("Other", (114, 115), (304,), None),
    ("Razorpay-Emandate", (117,), (166, 231), "Online"),
    ("INTERNET BANKING", (113,), ANY_BANK, None),
    ("NEFT", (111,), ANY_BANK, None),
    ("RTGS", (112,), (168, 304, 305), None),
    ("UPI", (109,), (168, 170, 300, 301, 304, 305), None),
)


def payment_mode_text(method: str, provider: str, payment_type: str) -> str:
    rules = []
    for mode, methods, providers, wanted in PAYMENT_MODES:
        condition = f"{in_list(method, methods)} AND {in_list(provider, providers)}"
        if wanted:
            condition += f" AND {payment_type} = '{wanted}'"
        rules.append((condition, mode))
    return case_text(rules, "Unknown")


# --- lead sources (fixed values) ----------------------------------------------------------

#: group, exact spellings, any of these parts, and also any of these parts (case ignored)
SOURCE_GROUPS = (
    ("DSP_programmatic", ("DSP_programmatic",), (), ()),
    ("Quora", ("quora",), (), ()),
    ("Missed Call", ("Missed Call",), (), ()),
    ("Youtube", ("youtube", "Youtube"), (), ()),
    ("Yahoo", (), ("yahoo",), None),
    ("Organic", (), ("organic", "direct traffic", "zopim", "whatsapp", "moengage", "website"), ()),
    ("Inbound Phone call", ("Inbound Phone call",), (), ()),
    ("Customer Referral", (), ("customer",), ()),
    ("Facebook", (), ("fball",), ()),
    ("Outbrain", (), ("outbrain",), ()),
    ("Google Discovery", (), ("google",), ("discovery", "display")),
    ("Google Search (NB)", (), ("google",), ("brand",)),
    ("Affiliate", (), ("affiliate", "digismart", "geoads"), ()),
)


def source_group_text(column: str) -> str:
    """``None`` as second part list means the whole text must equal the part, case ignored."""
    rules = []
    for group, exact, parts, also in SOURCE_GROUPS:
        if exact:
            rules.append((" OR ".join(f"{column} = '{word}'" for word in exact), group))
            continue
        pattern = "{0} ILIKE '{1}'" if also is None else "{0} ILIKE '%{1}%'"
        tests = [
            "(" + " OR ".join(pattern.format(column, word) for word in words) + ")"
            for words in (parts, also or ())
            if words
        ]
        rules.append((" AND ".join(tests), group))
    return case_text(rules, "Other")


# --- owner product families (fixed values) ------------------------------------------------

#: product id, family keys of its plans
PRODUCT_FAMILIES = (
    (1, ("retail",), "retail"),
    (1, ("retail_plus",), "retail_plus"),
    (3, ("bundle",), "bundle"),
    (2, ("advisory", "advisory_plus"), "advisory"),
)


def product_family_text(
    product: str, plan: str, names: Mapping[str, str] = FAMILY_NAMES
) -> str:
    rules = []
    for product_id, families, label in PRODUCT_FAMILIES:
        plans = sorted(plan_id for family in families for plan_id in FAMILY_PLANS[family])
        rules.append((f"{product} = {product_id} AND {in_list(plan, plans)}", names[label]))
    return case_text(rules, None)


# --- substatus buckets (fixed values) -----------------------------------------------------

UNTOUCHED = (1, 2, 3)
REPEAT_SUBSTATUS = 3
NEW_SUBSTATUS = (1, 2)
NOT_PITCHED = 5
ACTIVE_SUBSCRIPTION = 29
WORKABLE = (6, 7, 13, 14, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 54, 55, 57, 60)
NON_WORKABLE = (9, 10, 11, 15, 56, 58, 59, 61, 64, 65)
CONVERTED = (
    29, 30, 31, 32, 33, 34, 35, 36, 37, 38, 39, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 50, 52,
    53, 71,
)
WORKABLE_FOLLOW_UP = (
    3, 6, 7, 13, 14, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 54, 55, 57, 60,
)
WORKABLE_UNTOUCHED = (2, 3, 5, 6, 13, 16, 18, 19, 21, 24, 25, 57, 60)
NON_WORKABLE_UNTOUCHED = (14, 26, 27, 28, 32, 35, 52, 53, 55)
LOSS_SUBSTATUS = (10, 11, 15, 56, 58, 59, 61, 64, 65)
TRANSFERABLE = (
    1, 2, 3, 5, 6, 7, 9, 10, 11, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28,
    54, 55, 56, 57, 58, 59, 60, 61, 62, 64, 65,
)
EXPIRED_SUBSTATUS = (30, 32, 35)


def bucket_conditions(column: str) -> dict[str, str]:
    """Five 0/1 buckets of one substatus column; NULL falls in none of them."""
    return {
        "touched": f"NOT {in_list(column, UNTOUCHED)}",
        "workable": in_list(column, WORKABLE),
        "non_workable": in_list(column, NON_WORKABLE),
        "not_pitched": f"{column} = {NOT_PITCHED}",
        "converted": in_list(column, CONVERTED),
    }


#: status id -> substatus ids shown under a fixed label; elsewhere the substatus name is shown
STATUS_GROUPS = (
    (5, (2, 3, 16, 17, 18, 19, 20, 21, 22, 24, 25, 26, 27, 28, 54, 55, 58, 66, 67, 68, 73, 74,
         75), "ONBOARDING"),
    (6, (21, 29, 30, 32, 33, 34, 35, 36, 52, 53), "SUBSCRIPTION"),
    (7, (37, 38, 39, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 50, 71), "SUBSCRIPTION"),
)


def status_group_text(status: str, substatus: str, name: str) -> str:
    whens = " ".join(
        f"WHEN {status} = {status_id} AND {in_list(substatus, ids)} THEN '{label}'"
        for status_id, ids, label in STATUS_GROUPS
    )
    return f"CASE {whens} ELSE {name} END"


# --- funnel measures (fixed values) -------------------------------------------------------

RECENT_DAYS = 60

#: status id -> (measure of the whole status, {substatus id: measure})
FUNNEL: dict[int, tuple[str | None, dict[int, str]]] = {
    1: ("status_new_lead", {1: "untagged", 2: "new_lead", 3: "repeat_lead",
                            62: "existing_customer"}),
    2: (None, {5: "not_pitched", 6: "pitched", 7: "forwarded", 9: "language_barrier",
               10: "not_reachable", 57: "pre_sales_qualified", 58: "invalid", 59: "dnd",
               65: "work_to_non_work_c"}),
    3: (None, {11: "not_interested", 56: "customer_declined", 61: "no_progress"}),
    4: ("status_interested", {13: "hot", 14: "warm", 15: "cold", 64: "work_to_non_work_i"}),
    5: ("status_onboarding", {
        16: "in_process", 17: "email_otp_verified", 18: "mobile_otp_verified",
        19: "pan_verified", 20: "ckyc_verified", 21: "kra_verified", 22: "risk_profile",
        23: "portfolio_selection", 24: "suitability_assessment", 25: "agreement_signed",
        26: "payment_pending", 27: "payment_received", 28: "subscription_started",
        54: "payment_adjusted", 55: "onboarding_closed", 60: "self_kyc_verified"}),
    6: ("status_subscription", {
        29: "active", 30: "deactivated_s", 31: "extended", 32: "expired",
        33: "refund_requested", 34: "refund_processing", 35: "refunded", 36: "cancelled",
        52: "upgraded", 53: "downgraded", 71: "refund_rejected"}),
    7: ("status_collections", {
        37: "assigned", 38: "unreachable", 39: "contacted", 40: "neutral_response",
        41: "positive_response", 42: "ticket_raised", 43: "payment_link_sent",
        44: "payment_collected", 45: "transfer_requested", 46: "transferred",
        47: "deactivation_requested", 48: "deactivation_request_rejected",
        49: "deactivated_c", 50: "closed"}),
}

#: substatus ids that count only while recent
FADING = (9, 10, 11)
CONTACTED_STEADY = (5, 6, 7, 57, 58, 59, 65)
CONTACTED_FADING = (9, 10)
NOT_INTERESTED_STEADY = (56, 61)
NOT_INTERESTED_FADING = (11,)


def funnel_conditions(
    status: str, substatus: str, active: str, recent: str, very_recent: str
) -> dict[str, str]:
    """Measure name to condition.  ``recent`` holds from the day RECENT_DAYS back,
    ``very_recent`` only after that day."""
    found: dict[str, str] = {}
    for status_id, (whole, parts) in FUNNEL.items():
        if whole:
            found[whole] = f"{status} = {status_id}"
        for substatus_id, measure in parts.items():
            condition = f"{status} = {status_id} AND {substatus} = {substatus_id}"
            found[measure] = condition + (f" AND {recent}" if substatus_id in FADING else "")
    for measure, steady, fading in (
        ("status_contacted", CONTACTED_STEADY, CONTACTED_FADING),
        ("status_not_interested", NOT_INTERESTED_STEADY, NOT_INTERESTED_FADING),
    ):
        found[measure] = (
            f"{active} AND ({in_list(substatus, steady)}"
            f" OR {in_list(substatus, fading)} AND {recent})"
        )
    found["grand_total"] = (
        f"{active} AND (NOT {in_list(substatus, FADING)}"
        f" OR {in_list(substatus, FADING)} AND {very_recent})"
    )
    return found


# --- calls and notes (fixed values) -------------------------------------------------------

LONG_CALL_SECONDS = 600
SHORT_CALL_SECONDS = 5
CALL_ACTIVITY, NOTE_ACTIVITY = 1, 7
NOTE_COMMENTS = (33, 36, 61, 62)
UNANSWERED_DETAILS = ("NoAnswer", "NoResponse")
CLEARED_DETAILS = ("NormalCallClearing", "NormalUnspecified")

#: measure suffix -> comment name
NOTE_KINDS = {
    "not_answered": "Not Answered",
    "sales_pitch": "Detail conversation-Sales Pitch",
    "detail_conversation": "Detail Conversation",
    "phone_conversation": "Had a Phone Conversation",
}


def call_outcome_conditions(comment: str, activity_type: str, duration: str) -> dict[str, str]:
    return {
        "called": (
            f"{comment} = 36 OR {activity_type} = {CALL_ACTIVITY}"
            f" AND ({duration} IS NULL OR {duration} <= 0)"
        ),
        "detail_conversation": f"{comment} IN (33, 61) OR {duration} >= {LONG_CALL_SECONDS}",
        "phone_conversation": (
            f"{comment} = 62 OR {duration} > 0 AND {duration} < {LONG_CALL_SECONDS}"
        ),
    }


def unanswered_call_text(duration: str, details: str, status: str) -> str:
    plain = ", ".join(f"'{word}'" for word in UNANSWERED_DETAILS)
    cleared = ", ".join(f"'{word}'" for word in CLEARED_DETAILS)
    return (
        f"CASE WHEN {duration} < {SHORT_CALL_SECONDS} AND ({details} IN ({plain})"
        f" OR {details} IN ({cleared}) AND {status} = 'not_answered') THEN 1 END"
    )


# --- watched content (fixed values) -------------------------------------------------------

#: measure, payload condition, stem of the "... Abandoned" / "... Completed" event pair
WATCH_GROUPS = (
    ("latest_trends", "Content_Category = 'Trends that matter'"
     " AND Content_Sub_Category = 'Latest Trends'", "Content"),
    ("weekly_roundup", "Content_Category = 'Trends that matter'"
     " AND Content_Sub_Category = 'Weekly roundup'", "Content"),
    ("insightful_shorts", "Content_Category = 'Insightful Shorts'", "Content"),
    ("success_stories", "Content_Category = 'All About Investing'"
     " AND Content_Sub_Category = 'Success Stories'", "Content"),
    ("learn_from_legends", "Content_Category = 'All About Investing'"
     " AND Content_Sub_Category = 'Learn From Legends'", "Content"),
    ("invest_like_a_pro", "Content_Category = 'All About Investing'"
     " AND Content_Sub_Category = 'Invest Like a Pro'", "Content"),
    ("investing_fundas", "Content_Category = 'All About Investing'"
     " AND Content_Sub_Category = 'Investing Fundas'", "Content"),
    ("mission_vision", "Content_Category IN ('Mission Vision', 'Mission & Vision')", "Content"),
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

#: only these groups may also carry bare seconds
PLAIN_SECONDS_GROUPS = ("workshops",)

QUIZ_COURSES = {
    "basics": "Investing Basics Course",
    "fundamental": "Fundamental Analysis Course",
    "india": "India Story Course",
}

PAYLOAD_FIELDS = [
    "Event_Name", "Content_Category", "Content_Sub_Category", "Course_Name", "Workshop_Name",
    "User_Watched_Time", "Actual_Content_Video_Length", "User_Points",
]

# --- file dictionaries (fixed values) -----------------------------------------------------

PLAN_BY_NAME = {"premium membership program": 4, "pmp": 4}
METHOD_BY_MODE = {"NEFT": 111, "Razorpay": 166, "Razorpay-New": 166}
SERVICE_COLOUR_DEFAULT = "ORANGE"
PULLBACK_SOURCE = 57
