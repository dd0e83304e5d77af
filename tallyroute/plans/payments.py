"""Payment report: seven branches under one another, and the scenario of every payment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import catalog, dates, payload
from tallyroute.operators import lookup, measures, unions
from tallyroute.operators.pick import any_by, earliest_by, latest_by
from tallyroute.operators.running import running_by
from tallyroute.plans.shared import Codes, Need, ReadOnce
from tallyroute.session import cut_lineage, shuffles_removed, stored

Crm = Mapping[str, DataFrame]


def named(dim: DataFrame, key: str, as_key: str, **columns: str) -> DataFrame:
    """A dimension reduced to its key and renamed columns, ready for an equality join."""
    return dim.select(
        F.col(key).alias(as_key), *[F.col(old).alias(new) for new, old in columns.items()]
    )


def people(crm: Crm, as_key: str, prefix: str, **extra: str) -> DataFrame:
    """Users with their centre name; ``<prefix>_user`` tells a known user, named or not."""
    return lookup.star(
        named(crm["mst_user"], "user_id", as_key, location_id="location_id",
              **{f"{prefix}_user": "user_id", f"{prefix}_name": "full_name"}, **extra),
        (named(crm["mst_location"], "location_id", "location_id", **{f"{prefix}_center": "name"}),
         "location_id"),
    ).drop("location_id")


def typed_payments(crm: Crm) -> DataFrame:
    """Payments with ``payment_type``: Offline if an offline payment refers to them."""
    offline = (
        crm["offline_payment"].select("payment_id").where(F.col("payment_id").isNotNull())
        .distinct().withColumn("__offline", F.lit(True))
    )
    return crm["payment"].join(offline, "payment_id", "left").select(
        *crm["payment"].columns,
        F.when(F.col("__offline"), "Offline").otherwise("Online").alias("payment_type"),
    )


def paid_instalments(crm: Crm) -> DataFrame:
    """One row per (instalment, payment id)."""
    return crm["instalment"].withColumnRenamed("payment_id", "payment_ids").withColumn(
        "payment_id", F.explode(F.array_distinct("payment_ids"))
    )


def payment_sequence(crm: Crm) -> DataFrame:
    """Payments in order per contact with the values of the payment before.

    A payment counts through its earliest instalment, if that is for the same plan.
    """
    first = earliest_by(
        paid_instalments(crm).select(
            "payment_id", "sub_product_id", "instalment_number", "created_at", "instalment_id"
        ),
        ["payment_id"], "created_at", "instalment_id",
    ).select("payment_id", "sub_product_id", "instalment_number")
    contract = crm["onboarding"].select(
        "onboarding_id", F.to_date("subscription_expiry_date").alias("expiry_date"),
        "status_id", "substatus_id",
    )
    rows = (
        crm["payment"]
        .select("payment_id", "sub_product_id", "contact_id", "onboarding_id", "payment_date")
        .join(first, ["payment_id", "sub_product_id"])
        .join(contract, "onboarding_id", "left")
    )
    return running_by(
        rows, ["contact_id"], ["payment_date", "payment_id"],
        number="installment_rank",
        previous={
            "previous_expiry_date": "expiry_date",
            "previous_status_id": "status_id",
            "previous_substatus_id": "substatus_id",
            "previous_sub_product_id": "sub_product_id",
            "previous_instalment_number": "instalment_number",
        },
        sample_of=crm["payment"],
    )


def scenario_facts(refund_column: str = "previous_status_id") -> dict[str, Column]:
    """Named facts the scenario rules read.  The refund mark is looked up in the status of the
    contract before; pass ``previous_substatus_id`` to look in its substatus."""
    col = F.col
    opening = col("instalment_number") == 0
    return {
        "family": F.expr(catalog.family_text("sub_product_id")),
        "prior_family": F.expr(catalog.family_text("previous_sub_product_id")),
        "first_opening": (col("installment_rank") == 1) & opening,
        "opening": opening,
        "later": col("instalment_number") >= 1,
        "same_plan": col("previous_sub_product_id") == col("sub_product_id"),
        "other_plan": col("previous_sub_product_id") != col("sub_product_id"),
        "in_force": col("previous_expiry_date") >= F.to_date("payment_date"),
        "lapsed": col("previous_expiry_date") < F.to_date("payment_date"),
        "prior_opening": col("previous_instalment_number") == 0,
        "refunded": col(refund_column) == catalog.REFUNDED_STATUS,
    }


def payment_scenarios(
    crm: Crm,
    names: Mapping[str, str] = catalog.FAMILY_NAMES,
    refund_column: str = "previous_status_id",
) -> DataFrame:
    """Coarse ``payment_status`` and fine ``scenario`` per payment."""
    facts = payment_sequence(crm).withColumns(scenario_facts(refund_column))
    return facts.select(
        "payment_id", "contact_id", "sub_product_id", "installment_rank",
        F.expr(catalog.payment_status_text(names)).alias("payment_status"),
        F.expr(catalog.scenario_text(names)).alias("scenario"),
    )


def lead_types(crm: Crm) -> DataFrame:
    """Repeat / new / NA from the log of every lead that paid.

    The log is reduced to a row per lead first, so that only these are dealt out.
    """
    history = lookup.keyed_fetch(
        crm["lead_log"].groupBy("lead_id").agg(
            measures.ever(f"substatus_id = {catalog.REPEAT_SUBSTATUS}").alias("is_repeat"),
            measures.ever(catalog.in_list("substatus_id", catalog.NEW_SUBSTATUS)).alias("is_new"),
        ),
        crm["payment"], "lead_id")
    return history.select(
        "lead_id",
        F.when(F.col("is_repeat") == 1, "repeat_lead").when(F.col("is_new") == 1, "New_lead")
        .otherwise("NA").alias("lead_type"),
    )


def birth_details(crm: Crm, as_of) -> DataFrame:
    """Date of birth and completed years per paid contract, earliest detail row first."""
    known = lookup.keyed_fetch(
        crm["onboarding_detail"].where(F.col("date_of_birth").isNotNull()),
        crm["payment"], "onboarding_id")
    return earliest_by(known, ["onboarding_id"], "onboarding_detail_id").select(
        "onboarding_id", F.to_date("date_of_birth").alias("date_of_birth"),
        dates.completed_years(
            F.to_date("date_of_birth"), F.lit(dates.midnight(as_of)).cast("timestamp_ntz")
        ).cast("int").alias("age"),
    )


def demography(crm: Crm) -> DataFrame:
    """Gender and income of the contacts behind paid contracts."""
    contracts = lookup.keyed_fetch(
        crm["onboarding"].select("onboarding_id", "contact_id"), crm["payment"], "onboarding_id")
    known = lookup.keyed_fetch(
        crm["contact_demography"].where(F.col("gender").isNotNull()), contracts, "contact_id")
    return any_by(known, ["contact_id"], "contact_demography_id").select(
        "contact_id", "gender", "income"
    )


def occupations(crm: Crm) -> DataFrame:
    """Stated occupation per paid contract."""
    answers = (
        crm["onboarding_api_response"]
        .where(F.col("response").ilike("%occupation%"))
        .select("onboarding_id", "response_id", payload.occupation("response").alias("occupation"))
        .where(F.col("occupation").isNotNull())
    )
    paid = lookup.keyed_fetch(answers, crm["payment"], "onboarding_id")
    return any_by(paid, ["onboarding_id"], "response_id").select("onboarding_id", "occupation")


def primary_addresses(crm: Crm) -> DataFrame:
    """Latest primary address of the contacts that paid."""
    primary = crm["contact_address_detail"].where(F.col("is_primary"))
    latest = latest_by(
        lookup.keyed_fetch(primary, crm["payment"], "contact_id"), ["contact_id"],
        "updated_at", "contact_address_detail_id",
    ).select("contact_id", "pin_code", "state_id", "city_id")
    return lookup.star(
        latest,
        (named(crm["mst_state"], "state_id", "state_id", state_name="name"), "state_id"),
        (named(crm["mst_city"], "city_id", "city_id", city_name="name"), "city_id"),
    ).drop("state_id", "city_id")


def managers(crm: Crm) -> DataFrame:
    return named(crm["mst_user"], "user_id", "manager_id", manager_user="user_id",
                 manager_name="full_name")


def payments_detail(
    crm: Crm, as_of, scenarios: DataFrame | None = None, excluded_owner: int = 1518,
    in_steps: bool = False,
) -> DataFrame:
    """One row per payment that settles an instalment of its own plan.

    At size every join deals its left side anew, so dimensions are joined to the narrow rows that
    refer to them, joins by one key follow one another, and what is widest joins last.  ``in_steps``
    stores the amounts, and the rows before contracts are joined, so that what was shuffled for them
    does not stay until the end.
    """
    def step(df: DataFrame, label: str) -> DataFrame:
        return stored(df, label) if in_steps else df

    scenarios = payment_scenarios(crm) if scenarios is None else scenarios
    plans = lookup.star(
        crm["mst_subproduct"].select("sub_product_id", "product_id",
                                     F.col("name").alias("sub_product")),
        (named(crm["mst_product"], "product_id", "product_id", product="name"), "product_id"),
    ).drop("product_id")
    amount = step(lookup.star(
        any_by(
            paid_instalments(crm).select("payment_id", "sub_product_id", "instalment_id", "amount"),
            ["payment_id", "sub_product_id"], "instalment_id",
        ).select("payment_id", "sub_product_id", F.col("amount").alias("amount_received")),
        (plans, "sub_product_id"),
    ), "amounts")
    contract = lookup.star(
        crm["onboarding"].select(
            "onboarding_id", F.col("lead_id").alias("contract_lead_id"),
            F.col("contact_id").alias("contract_contact_id"), "adjustment_amount",
            F.col("rm_id").alias("contract_rm_id"), "status_id", "substatus_id",
            F.col("created_by").alias("onboarded_by"),
        ),
        (named(crm["mst_status"], "status_id", "status_id", status="name"), "status_id"),
        (named(crm["mst_substatus"], "substatus_id", "substatus_id", substatus="name"),
         "substatus_id"),
        (demography(crm).withColumnRenamed("contact_id", "contract_contact_id"),
         "contract_contact_id"),
        (people(crm, "onboarded_by", "onboarding"), "onboarded_by"),
    )
    owner = lookup.star(
        people(crm, "owner_id", "rm", manager_id="reporting_manager_id"),
        (managers(crm), "manager_id"),
    )
    typed = F.col("lead_type").isNotNull()
    lead_info = lookup.star(
        lookup.star(
            crm["lead"].select("lead_id", F.col("rm_id").alias("owner_id"), "utm_source",
                               "lead_source_id", "created_at"),
            (named(crm["mst_lead_source"], "lead_source_id", "lead_source_id",
                   source_name="name"), "lead_source_id"),
            (owner, "owner_id"),
        ).select(
            "lead_id", "owner_id", "rm_user", "rm_name", "rm_center", "manager_user",
            "manager_name", F.coalesce("source_name", "utm_source").alias("lead_source"),
            F.date_diff(F.lit(dates.midnight(as_of)).cast("date"),
                        F.to_date("created_at")).alias("lead_age"),
        ),
        (lead_types(crm), "lead_id"),
    ).withColumns({"lead_source": F.when(typed, F.col("lead_source")),
                   "lead_age": F.when(typed, F.col("lead_age"))})
    rows = step(
        typed_payments(crm)
        .join(scenarios.select("payment_id", "payment_status", "scenario"), "payment_id", "left")
        .join(amount, ["payment_id", "sub_product_id"])
        .join(named(crm["contact"], "contact_id", "contact_id", lead_name="full_name",
                    lead_email="email_address"), "contact_id", "left")
        .join(primary_addresses(crm), "contact_id", "left")
        .join(lead_info, "lead_id", "left")
        .where(F.col("rm_user").isNull() | (F.col("owner_id") != excluded_owner)),
        "paid-rows")
    rows = (
        rows.join(contract, "onboarding_id", "left")
        .join(birth_details(crm, as_of), "onboarding_id", "left")
        .join(occupations(crm), "onboarding_id", "left")
    )
    return rows.select(
        F.col("payment_date").alias("refresh_date"), "contact_id",
        F.col("contract_lead_id").alias("lead_id"), "payment_date", "lead_name", "lead_email",
        "product", "sub_product", "lead_type", "rm_name",
        F.col("contract_rm_id").alias("rm_id"), "rm_center", "manager_name",
        F.col("manager_user").alias("manager_id"), "lead_age",
        F.col("onboarding_name").alias("onboarded_by_name"),
        F.col("onboarding_center").alias("onboarding_location"), "status", "substatus",
        "lead_source", "adjustment_amount", "amount_received", "state_name", "city_name",
        "pin_code", "onboarding_id", F.col("payment_provider").alias("payment_provider_id"),
        "payment_type",
        F.expr(catalog.payment_mode_text("payment_method", "payment_provider", "payment_type"))
        .alias("payment_mode"),
        "payment_id", "payment_status", "scenario", "date_of_birth", "age", "gender",
        "occupation", "income",
    )


def listed_users(crm: Crm, user_ids: Sequence[int] | None) -> DataFrame:
    users = crm["mst_user"]
    return users if user_ids is None else users.where(F.col("user_id").isin(list(user_ids)))


def owners_without_payment(
    crm: Crm, as_of, user_ids: Sequence[int] | None = None
) -> DataFrame:
    """Listed users who booked no payment since the first of the month."""
    booked = crm["payment"].where(dates.month_to_date("payment_date", as_of)).select(
        F.col("created_by").alias("user_id")
    )
    idle = lookup.without(listed_users(crm, user_ids), booked, ["user_id"])
    return lookup.star(
        idle.select("user_id", F.col("full_name").alias("rm_name"), "location_id",
                    F.col("reporting_manager_id").alias("manager_id")),
        (named(crm["mst_location"], "location_id", "location_id", rm_center="name"),
         "location_id"),
        (managers(crm), "manager_id"),
    ).select("rm_name", F.col("user_id").alias("rm_id"), "rm_center", "manager_name")


def owner_plans(
    crm: Crm, users: DataFrame, names: Mapping[str, str] = catalog.FAMILY_NAMES
) -> DataFrame:
    """One row per user with the smallest plan of the user's plan list and its family."""
    plans = lookup.star(
        crm["mst_subproduct"].select("sub_product_id", "product_id",
                                     F.col("name").alias("owner_sub_product")),
        (named(crm["mst_product"], "product_id", "product_id", owner_product="name"),
         "product_id"),
    )
    smallest = any_by(
        lookup.array_member_join(
            users.select("user_id", "sub_product_ids"), "sub_product_ids", plans, "sub_product_id"
        ),
        ["user_id"], "sub_product_id",
    )
    family = catalog.product_family_text("product_id", "sub_product_id", names)
    return smallest.select(
        "user_id", "owner_product", "owner_sub_product", F.expr(family).alias("product_family")
    )


def owner_directory(
    crm: Crm, as_of, user_ids: Sequence[int] | None = None,
    names: Mapping[str, str] = catalog.FAMILY_NAMES,
) -> DataFrame:
    """Per listed user: centre, manager, e-mail and product family."""
    users = listed_users(crm, user_ids)
    rows = lookup.star(
        users.select("user_id", F.col("full_name").alias("rm_name"), "location_id",
                     F.col("reporting_manager_id").alias("manager_id"),
                     F.col("email_address").alias("rm_email"), "is_active"),
        (named(crm["mst_location"], "location_id", "location_id", rm_center="name"),
         "location_id"),
        (managers(crm), "manager_id"),
        (owner_plans(crm, users, names), "user_id"),
    )
    return rows.select(
        F.lit(dates.midnight(as_of)).cast("timestamp_ntz").alias("payment_date"), "rm_name",
        F.col("user_id").alias("rm_id"), "rm_center", "manager_name",
        F.col("manager_user").alias("manager_id"),
        "rm_email", "is_active", "owner_product", "owner_sub_product", "product_family",
    )


def lead_pickups(
    crm: Crm, since, user_ids: Sequence[int] | None = None,
    names: Mapping[str, str] = catalog.FAMILY_NAMES,
) -> DataFrame:
    """First log entry per (lead, owner) since a start day."""
    log = crm["lead_log"].where(dates.from_day("created_at", since))
    if user_ids is not None:
        log = log.where(F.col("rm_id").isin(list(user_ids)))
    picked = any_by(log.select("lead_id", "rm_id", "log_id", "created_at"),
                    ["lead_id", "rm_id"], "log_id")
    directory = owner_directory(crm, since, user_ids, names).drop("payment_date")
    known = directory.withColumn("rm_user", F.col("rm_id"))
    return picked.join(known, "rm_id", "left").select(
        F.col("created_at").alias("refresh_date"), "rm_name",
        F.col("rm_user").alias("rm_id"), "rm_center",
        "manager_name", "rm_email", "is_active", "owner_product", "owner_sub_product",
        "product_family", "created_at", F.col("rm_id").alias("log_rm_id"), "lead_id",
    )


def noted_activities(activities: DataFrame) -> DataFrame:
    """One row per outcome comment of an activity, or one without comment."""
    wanted = F.array(*[F.lit(c) for c in catalog.NOTE_COMMENTS])
    members = F.array_intersect(F.col("comment_ids").cast("array<int>"), wanted)
    return activities.withColumn("comment_id", F.explode_outer(members))


OUTCOMES = ("called", "detail_conversation", "phone_conversation")


def _outcomes() -> list[Column]:
    conditions = catalog.call_outcome_conditions("comment_id", "activity_type_id",
                                                 "call_duration")
    total = F.sum(F.col("call_duration").cast("decimal(18,6)")).cast("double")
    return [*measures.counts_where(conditions), total.alias("call_duration")]


def _is_call() -> Column:
    return F.col("activity_type_id").isin(catalog.CALL_ACTIVITY, catalog.NOTE_ACTIVITY)


def _is_recent(as_of, days: int) -> Column:
    """Calls of the last days, and whatever was done with a lead that is far along."""
    return (_is_call() & dates.since_days("created_at", as_of, days)) | (F.col("status_id") >= 5)


def call_outcomes(crm: Crm) -> DataFrame:
    """Outcomes per (owner, moment, lead) of the calls with known contacts, if there is one."""
    calls = crm["activity"].where(_is_call()).select(
        "lead_id", "contact_id", "rm_id", "activity_type_id", "call_duration", "comment_ids",
        "created_at")
    return measures.any_positive(
        noted_activities(
            calls.join(crm["contact"].select("contact_id"), "contact_id", "left_semi")
        ).groupBy("rm_id", "created_at", "lead_id").agg(*_outcomes()),
        OUTCOMES,
    )


def recent_outcomes(crm: Crm, as_of, days: int) -> DataFrame:
    """Outcomes per (lead, owner, moment) of recent activity."""
    return noted_activities(
        crm["activity"].where(_is_recent(as_of, days)).select(
            "lead_id", "rm_id", "activity_type_id", "call_duration", "comment_ids", "created_at")
    ).groupBy("lead_id", "rm_id", "created_at").agg(*_outcomes())


def both_outcomes(crm: Crm, as_of, days: int) -> tuple[DataFrame, DataFrame]:
    """:func:`call_outcomes` and :func:`recent_outcomes` from one pass over the activities, which
    are counted for both by one aggregate."""
    known = crm["contact"].select("contact_id").distinct().withColumn("__known", F.lit(True))
    kinds = {"call": _is_call() & F.coalesce("__known", F.lit(False)),
             "recent": F.coalesce(_is_recent(as_of, days), F.lit(False))}
    conditions = catalog.call_outcome_conditions("comment_id", "activity_type_id",
                                                 "call_duration")
    marked = noted_activities(
        crm["activity"].where(_is_call() | _is_recent(as_of, days))
        .join(known, "contact_id", "left").withColumns(kinds).where("call OR recent"))
    counted: list[Column] = []
    for kind in kinds:
        counted.append(F.bool_or(kind).alias(f"is_{kind}"))
        counted += [F.count_if(F.col(kind) & F.expr(text)).alias(f"{kind}_{name}")
                    for name, text in conditions.items()]
        counted.append(F.sum(F.when(F.col(kind), F.col("call_duration").cast("decimal(18,6)")))
                       .cast("double").alias(f"{kind}_call_duration"))
    both = stored(marked.groupBy("lead_id", "rm_id", "created_at").agg(*counted), "outcomes")

    def of(kind: str) -> DataFrame:
        return both.where(F.col(f"is_{kind}")).select(
            "lead_id", "rm_id", "created_at",
            *[F.col(f"{kind}_{name}").alias(name) for name in (*OUTCOMES, "call_duration")])

    return measures.any_positive(of("call"), OUTCOMES), of("recent")


def call_activity(crm: Crm, counted: DataFrame | None = None) -> DataFrame:
    """Call outcomes per (owner, moment, lead); only groups with an outcome."""
    counted = call_outcomes(crm) if counted is None else counted
    lead = crm["lead"].where("is_active").select("lead_id", "status_id", "substatus_id")
    rows = lookup.star(
        counted.join(lead, "lead_id"),
        (people(crm, "rm_id", "rm"), "rm_id"),
        (named(crm["mst_substatus"], "substatus_id", "substatus_id", substatus_name="name"),
         "substatus_id"),
    )
    return rows.select(
        F.col("created_at").alias("refresh_date"), "rm_name",
        F.col("rm_user").alias("rm_id"), "rm_center",
        "created_at", "lead_id", *OUTCOMES, "call_duration",
        F.expr(catalog.status_group_text("status_id", "substatus_id", "substatus_name"))
        .alias("group_substatus"),
    )


def lead_activity_payment(
    crm: Crm, as_of, scenarios: DataFrame | None = None, days: int = 91,
    names: Mapping[str, str] = catalog.FAMILY_NAMES, counted: DataFrame | None = None,
) -> DataFrame:
    """Active leads with their owner's recent activity and their payments side by side.

    Outcomes are counted per (lead, owner, moment) before plans and payments multiply the rows.
    """
    scenarios = payment_scenarios(crm, names) if scenarios is None else scenarios
    counted = recent_outcomes(crm, as_of, days) if counted is None else counted
    counted = counted.withColumnsRenamed(
        {"rm_id": "owner_id", "created_at": "activity_at"}).withColumn(
            "activity_lead_id", F.col("lead_id"))
    plan_names = named(crm["mst_subproduct"], "sub_product_id", "sub_product_id",
                       sub_product="name")
    lead_plans = lookup.array_member_join(
        crm["lead"].where("is_active").select("lead_id", "sub_product_ids"),
        "sub_product_ids", plan_names, "sub_product_id",
    ).select("lead_id", "sub_product").distinct()
    owner_all_plans = lookup.array_member_join(
        crm["mst_user"].select("user_id", "sub_product_ids"), "sub_product_ids",
        crm["mst_subproduct"].select(
            "sub_product_id", "product_id", F.col("name").alias("owner_sub_product")),
        "sub_product_id",
    ).join(named(crm["mst_product"], "product_id", "product_id", owner_product="name"),
           "product_id", "left").select(
        F.col("user_id").alias("owner_id"), "owner_product", "owner_sub_product",
        F.expr(catalog.product_family_text("product_id", "sub_product_id", names))
        .alias("product_family"),
    )
    paid = crm["payment"].select("lead_id", "payment_id", "payment_date", "onboarding_id").join(
        scenarios.select("payment_id", "payment_status", "scenario"), "payment_id", "left"
    )
    lead = crm["lead"].where("is_active").select(
        "lead_id", "contact_id", F.col("rm_id").alias("owner_id"), "product_id", "created_at"
    )
    named_leads = lead.join(
        named(crm["contact"], "contact_id", "contact_id", lead_name="full_name",
              lead_email="email_address"), "contact_id")
    rows = (
        lookup.many_left_join(named_leads, counted, ["lead_id", "owner_id"])
        .join(lead_plans, "lead_id", "left")
        .join(paid, "lead_id", "left")
        .join(people(crm, "owner_id", "rm"), "owner_id", "left")
        .join(owner_all_plans, "owner_id", "left")
        .join(named(crm["mst_product"], "product_id", "product_id", product="name"),
              "product_id", "left")
    )
    zero = [F.coalesce(name, F.lit(0)).alias(name) for name in OUTCOMES if name != "called"]
    # a lead without activity still is one row without call length, which counts as not called
    called = F.when(F.col("activity_lead_id").isNull(), F.lit(0)).otherwise(F.col("called"))
    return rows.select(
        F.col("activity_at").alias("refresh_date"), "contact_id", "lead_id", "payment_date",
        "lead_name", "lead_email", "product", "sub_product", "rm_name",
        F.col("rm_user").alias("rm_id"), "rm_center",
        "onboarding_id", "payment_id", "payment_status", "scenario", "owner_product",
        "owner_sub_product", "product_family", "created_at", "activity_lead_id",
        called.alias("called"), *zero, "call_duration",
    )


def lead_details(crm: Crm) -> DataFrame:
    """Active leads with one payment, lead type and channel group."""
    payment = any_by(crm["payment"].select("lead_id", "payment_id", "payment_date"),
                     ["lead_id"], "payment_id")
    repeat = f"substatus_id = {catalog.REPEAT_SUBSTATUS}"
    kinds = crm["lead_log"].groupBy("lead_id").agg(
        F.when(F.bool_or(F.expr(repeat)), "repeat_lead").otherwise("new_lead").alias("lead_type")
    )
    source = F.coalesce("utm_source", "source_name")
    rows = lookup.star(
        crm["lead"].where("is_active").select(
            "lead_id", "contact_id", "created_at", "utm_source", "utm_campaign", "utm_medium",
            "lead_source_id", "rm_id", "status_id", "substatus_id"),
        (payment, "lead_id"),
        (kinds, "lead_id"),
        (named(crm["mst_lead_source"], "lead_source_id", "lead_source_id", source_name="name"),
         "lead_source_id"),
        (people(crm, "rm_id", "rm"), "rm_id"),
        (named(crm["mst_status"], "status_id", "status_id", status="name"), "status_id"),
        (named(crm["mst_substatus"], "substatus_id", "substatus_id", substatus="name"),
         "substatus_id"),
    ).withColumn("lead_source", source)
    return rows.select(
        F.col("created_at").alias("refresh_date"), "contact_id", "payment_date", "lead_type",
        F.col("rm_center").alias("onboarding_location"), "status", "substatus", "lead_source",
        "payment_id", "created_at", "lead_id",
        F.expr(catalog.source_group_text("lead_source")).alias("lead_source_group"),
        "utm_campaign", "utm_medium",
    )


#: days of activity the combined branch looks back
ACTIVITY_DAYS = 91


def payment_facts() -> dict[str, Need]:
    """What the seven branches read of each fact table."""
    return {
        "payment": Need(("payment_id", "sub_product_id", "contact_id", "onboarding_id", "lead_id",
                         "payment_date", "payment_provider", "payment_method", "created_by")),
        "instalment": Need(("payment_id", "sub_product_id", "instalment_number", "created_at",
                            "instalment_id", "amount"), F.size("payment_id") > 0),
        "onboarding": Need(("onboarding_id", "lead_id", "contact_id", "adjustment_amount", "rm_id",
                            "status_id", "substatus_id", "created_by",
                            "subscription_expiry_date")),
        "lead": Need(("lead_id", "contact_id", "rm_id", "product_id", "sub_product_ids",
                      "lead_source_id", "utm_source", "utm_campaign", "utm_medium", "created_at",
                      "is_active", "status_id", "substatus_id")),
        "lead_log": Need(("lead_id", "rm_id", "log_id", "created_at", "substatus_id")),
        "contact": Need(("contact_id", "full_name", "email_address")),
    }


def payment_masters() -> dict[str, Codes]:
    """Where the seven branches look up each master table."""
    def by(code: str, *tables: str) -> Codes:
        return Codes(code, tuple((table, code) for table in tables))

    plans = F.explode("sub_product_ids")
    return {
        "mst_subproduct": Codes("sub_product_id", (
            ("instalment", "sub_product_id"), ("lead", plans), ("mst_user", plans))),
        "mst_product": by("product_id", "mst_subproduct", "lead"),
        "mst_lead_source": by("lead_source_id", "lead"),
        "mst_status": by("status_id", "lead", "onboarding"),
        "mst_substatus": by("substatus_id", "lead", "onboarding"),
    }


def payments_report(
    crm: Crm,
    as_of,
    pickups_since,
    user_ids: Sequence[int] | None = None,
    names: Mapping[str, str] = catalog.FAMILY_NAMES,
    excluded_owner: int = 1518,
) -> DataFrame:
    """All seven branches, each marked in ``flag``.

    Every fact table is read once: what the branches need of it is stored, activities are counted for
    both of their branches together, and scenarios are computed once.  Branches that shuffle their
    rows are stored as they are computed, but for the longest, so that what one shuffles is gone
    before the next begins."""
    crm = ReadOnce(crm, payment_facts(), payment_masters())
    with shuffles_removed(crm["payment"].sparkSession):
        scenarios = cut_lineage(payment_scenarios(crm, names))
    calls, recent = both_outcomes(crm, as_of, ACTIVITY_DAYS)
    return unions.tagged(
        {
            "Payment": stored(
                payments_detail(crm, as_of, scenarios, excluded_owner, in_steps=True), "detail"),
            "Payment (none)": owners_without_payment(crm, as_of, user_ids),
            "Counsellor Details": owner_directory(crm, as_of, user_ids, names),
            "Lead Taken": stored(lead_pickups(crm, pickups_since, user_ids, names), "taken"),
            "Activity": stored(call_activity(crm, calls), "calls"),
            "Combine": lead_activity_payment(crm, as_of, scenarios, ACTIVITY_DAYS, names, recent),
            "Lead Details": stored(lead_details(crm), "leads"),
        }
    ).withColumn("flag", F.regexp_replace("flag", r" \(none\)$", ""))
