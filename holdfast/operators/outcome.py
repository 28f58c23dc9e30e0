"""Experiment outcome table: contacts, cancels, stops, status."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import labels
from holdfast.functions.dates import FILE_DATE_OVERRIDES, email_date, inference_date
from holdfast.functions.keys import account_key
from holdfast.operators.reduction import restrict
from holdfast.sources.cohort import BILLING_SYSTEM
from holdfast.sources.tables import stage

PAIR = ["billing_account", "id_subscrip"]

# The columns of the outcome table, in order.
OUTCOME_COLUMNS = [
    "billing_account", "id_subscrip", "cohort", "Treatment", "email_date",
    "pricing_effective_date", "current_rate", "new_rate", "offered_rate", "called_in",
    "opened_cancel_page", "__called_in_date", "__open_cancel_page_date", "contact_channel",
    "__earlist_contact_date", "__call_cancel_date", "__ol_cancel_date",
    "__earlist_cancel_date", "__create_date", "perm_stoped", "perm_stop_date",
    "inference_date",
]


def clean_assignments(
    applied: DataFrame, overrides: Mapping[dt.date, dt.date] = FILE_DATE_OVERRIDES
) -> DataFrame:
    """Experiment assignments with normalised key, labels and calendar."""
    inference = inference_date("filedate", overrides)
    return applied.select(
        account_key("subscription").alias("billing_account"),
        F.col("currentrate").alias("current_rate"),
        F.col("newrate").alias("new_rate"),
        F.col("stopsave").alias("offered_rate"),
        F.to_date("effective").alias("pricing_effective_date"),
        labels.cohort_label("modeltype").alias("cohort"),
        labels.treatment_label("grouptype").alias("Treatment"),
        inference.alias("inference_date"),
        email_date(inference).alias("email_date"),
    ).distinct()


def link_subscriptions(
    assignments: DataFrame, link: DataFrame, weekly_source: DataFrame
) -> DataFrame:
    """Attach subscription ids: by billing link for Two-Offer, by week for Three-Offer."""
    linked = (
        link.where(
            (F.col("billing_system") == BILLING_SYSTEM) & (F.col("circ_site") != "PLAY")
        )
        .select(
            account_key("billing_account").alias("billing_account"),
            F.col("circ_idsubscrip").alias("id_subscrip"),
            "product_type",
        )
        .distinct()
    )
    weekly = weekly_source.select(
        account_key("billing_account").alias("billing_account"), "inference_date", "id_subscrip"
    )
    two = assignments.where(F.col("cohort") == labels.TWO_OFFER).join(
        linked.drop("product_type"), "billing_account", "left"
    )
    three = assignments.where(F.col("cohort") == labels.THREE_OFFER).join(
        weekly, ["billing_account", "inference_date"], "left"
    )
    columns = ["id_subscrip", *assignments.columns]
    return two.select(columns).unionByName(three.select(columns))


def _anchors(linked: DataFrame) -> DataFrame:
    """First email per (account, subscription); later emails cannot move a minimum."""
    return (
        linked.where(F.col("id_subscrip").isNotNull())
        .groupBy(*PAIR)
        .agg(F.min("email_date").alias("first_email"))
    )


@dataclass(frozen=True)
class ContactDays:
    """Calls and visits of the assigned accounts, reduced to days; outcome and history both read them."""

    calls: DataFrame
    visits: DataFrame


def days_of_calls(linked: DataFrame, calls: DataFrame) -> DataFrame:
    """Call days of the assigned accounts, and whether a call of the day was unsaved.

    Calls of other accounts go before anything is shuffled by day.
    """
    own = restrict(calls.withColumn("billing_account", account_key("Account")), linked, "billing_account")
    return own.groupBy(
        "billing_account", F.col("idSubscrip").alias("id_subscrip"), "event_date"
    ).agg(F.max(F.when(F.col("Saves__Digital_to_Digital_") == 0, 1).otherwise(0)).alias("unsaved"))


def days_of_visits(linked: DataFrame, online: DataFrame) -> DataFrame:
    """Days on which an assigned subscription opened the cancel page or confirmed a cancel, and which of both."""
    either = online.where((F.col("entered_acc_mng") == 1) | (F.col("confirmed_cancel") == 1))
    return restrict(either, linked, "id_subscrip").groupBy("id_subscrip", "event_date").agg(
        F.max("entered_acc_mng").alias("opened"), F.max("confirmed_cancel").alias("confirmed")
    )


def contact_days(linked: DataFrame, calls: DataFrame, online: DataFrame) -> ContactDays:
    """Both, as tables: each source is scanned once however many steps read its days."""
    return ContactDays(
        stage(days_of_calls(linked, calls), "call_days"), stage(days_of_visits(linked, online), "visit_days")
    )


def first_calls(
    linked: DataFrame, calls: DataFrame, strict_subscription: bool = False
) -> DataFrame:
    """First call and first unsaved call on or after the email date.

    By default an unsaved call on any subscription of the account counts as the
    cancel; `strict_subscription` limits it to the subscription itself. Calls are
    reduced to days first, so a hot account contributes at most one row per day.
    """
    days = days_of_calls(linked, calls)
    if not strict_subscription:
        days = stage(days, "call_days")  # read for the account and for the subscription
    return first_call_days(linked, days, strict_subscription)


def first_call_days(
    linked: DataFrame, days: DataFrame, strict_subscription: bool = False
) -> DataFrame:
    """`first_calls` from the days of `days_of_calls`."""
    called = (
        _anchors(linked)
        .join(days, PAIR)
        .where(F.col("event_date") >= F.col("first_email"))
        .groupBy(*PAIR)
        .agg(
            F.min("first_email").alias("first_email"),
            F.min("event_date").alias("__called_in_date"),
            F.min(F.when(F.col("unsaved") == 1, F.col("event_date"))).alias("own_cancel"),
        )
    )
    result = [*PAIR, F.lit(1).alias("called_in"), "__called_in_date"]
    if strict_subscription:
        return called.select(*result, F.col("own_cancel").alias("__call_cancel_date"))
    # One row per account, holding at most one entry per calendar day: the join
    # stays one to one however many calls or subscriptions the account has.
    unsaved = (
        days.where(F.col("unsaved") == 1)
        .groupBy("billing_account")
        .agg(F.collect_set("event_date").alias("cancel_days"))
    )
    later = F.filter("cancel_days", lambda d: d >= F.col("first_email"))
    return called.join(unsaved, "billing_account", "left").select(
        *result, F.array_min(later).alias("__call_cancel_date")
    )


def first_online(linked: DataFrame, online: DataFrame) -> DataFrame:
    """First cancel-page visit and first confirmed cancel on or after the email date."""
    return first_visit_days(linked, days_of_visits(linked, online))


def first_visit_days(linked: DataFrame, days: DataFrame) -> DataFrame:
    """`first_online` from the days of `days_of_visits`."""
    return (
        _anchors(linked)
        .join(days, "id_subscrip")
        .where(F.col("event_date") >= F.col("first_email"))
        .groupBy(*PAIR)
        .agg(
            F.min(F.when(F.col("opened") == 1, F.col("event_date"))).alias(
                "__open_cancel_page_date"
            ),
            F.min(F.when(F.col("confirmed") == 1, F.col("event_date"))).alias(
                "__ol_cancel_date"
            ),
        )
        .where(F.col("__open_cancel_page_date").isNotNull())
        .select(
            *PAIR,
            F.lit(1).alias("opened_cancel_page"),
            "__open_cancel_page_date",
            "__ol_cancel_date",
        )
    )


def permanent_stops(start_stop: DataFrame) -> DataFrame:
    """Distinct permanent-stop facts."""
    return (
        start_stop.where(F.col("is_perm_stop") == 1)
        .select(
            "id_subscrip",
            F.lit(1).alias("perm_stoped"),
            F.col("transaction_date").alias("perm_stop_date"),
            "create_date",
        )
        .distinct()
    )


def attach_stops(linked: DataFrame, start_stop: DataFrame) -> DataFrame:
    """Permanent stops created on or after the email date, one row per stop."""
    stops = permanent_stops(start_stop).withColumnRenamed("id_subscrip", "stop_id")
    return linked.join(
        stops,
        (F.col("id_subscrip") == F.col("stop_id"))
        & (F.col("create_date") >= F.col("email_date")),
        "left",
    ).drop("stop_id")


def assemble(
    linked: DataFrame,
    calls: DataFrame,
    online: DataFrame,
    start_stop: DataFrame,
    strict_subscription: bool = False,
) -> DataFrame:
    """Assignments with contact, cancel and stop facts, flags defaulted to 0."""
    days = contact_days(linked, calls, online)
    return assemble_days(linked, days, start_stop, strict_subscription)


def assemble_days(
    linked: DataFrame, days: ContactDays, start_stop: DataFrame, strict_subscription: bool = False
) -> DataFrame:
    """`assemble` from days of contact."""
    contacts = linked.join(first_call_days(linked, days.calls, strict_subscription), PAIR, "left").join(
        first_visit_days(linked, days.visits), PAIR, "left"
    )
    return (
        attach_stops(contacts, start_stop)
        .withColumnRenamed("create_date", "__create_date")
        .fillna(0, ["called_in", "opened_cancel_page", "perm_stoped"])
        .distinct()
    )


def derive_contacts(base: DataFrame) -> DataFrame:
    """Contact channel and the earliest contact and cancel dates."""
    return base.withColumns(
        {
            "contact_channel": labels.contact_channel(
                "called_in", "opened_cancel_page", "__called_in_date", "__open_cancel_page_date"
            ),
            "__earlist_contact_date": labels.earliest(
                "__called_in_date", "__open_cancel_page_date"
            ),
            "__earlist_cancel_date": labels.earliest("__call_cancel_date", "__ol_cancel_date"),
        }
    ).select(*OUTCOME_COLUMNS)


def classify(contacts: DataFrame) -> DataFrame:
    """Status, churn label and contact timing."""
    signals = ("__earlist_contact_date", "__earlist_cancel_date", "perm_stoped")
    return contacts.withColumns(
        {
            "status": labels.status(*signals),
            "churned": labels.churned(*signals),
            "contact_timing": labels.contact_timing(
                "__earlist_contact_date", "pricing_effective_date"
            ),
        }
    )


def attach_behaviour(
    outcomes: DataFrame, weekly_source: DataFrame, metrics: DataFrame
) -> DataFrame:
    """Risk tier by account and week, behaviour metrics by subscription and week.

    The tier join ignores the subscription on purpose, so an account with several
    subscriptions fans out; run the cardinality guardrail first.
    """
    tiers = weekly_source.select(
        account_key("billing_account").alias("billing_account"),
        "inference_date",
        F.col("risk_tier").alias("src_risk_tier"),
    )
    behaviour = metrics.select(
        "inference_date", "id_subscrip", "frequency", "breadth", "tenure", "tt_cost"
    )
    return outcomes.join(tiers, ["billing_account", "inference_date"], "left").join(
        behaviour, ["id_subscrip", "inference_date"], "left"
    )
