"""Web cancel-flow events attributed to subscriptions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.dates import EXPERIMENT_START
from holdfast.functions.labels import web_flags
from holdfast.operators.intervals import effective_join
from holdfast.sources.tables import stage

FLAGS = ("entered_acc_mng", "confirmed_cancel", "success_save")
VISIT_KEYS = ("event_date", "anonymous_id", "website_id")


def flag_events(events: DataFrame) -> DataFrame:
    """Cancel-flow flags per web event."""
    flags = web_flags("d027_event_detail")
    return events.select(
        "event_date",
        F.col("d049_user_anonymous_id").alias("anonymous_id"),
        F.col("d031_website_id").alias("website_id"),
        *[expr.alias(name) for name, expr in flags.items()],
    )


def roll_up_flags(flagged: DataFrame) -> DataFrame:
    """One row per date, visitor and site.

    MAX makes a prior DISTINCT redundant, so a hot visitor combines map-side.
    """
    return flagged.groupBy(*VISIT_KEYS).agg(*[F.max(f).alias(f) for f in FLAGS])


def subscription_consumers(subscriptions: DataFrame) -> DataFrame:
    """One row per subscription version and consumer; empty lists disappear."""
    return subscriptions.select(
        "id_subscrip",
        F.explode("consumer_ids").alias("consumer_id"),
        "effective_date",
        "end_date",
        "mdm_product_id",
    ).distinct()


def consumer_visitors(known: DataFrame) -> DataFrame:
    """Consumer and anonymous-id pairs from the three id columns."""
    ids = ["anonymous_id_1", "anonymous_id_2", "anonymous_id_3"]
    return (
        known.unpivot(["consumer_id"], ids, "anon", "anonymous_id")
        .where(F.col("anonymous_id").isNotNull())
        .select("consumer_id", "anonymous_id")
        .distinct()
    )


def identity_map(
    subscriptions: DataFrame,
    known: DataFrame,
    product: DataFrame,
    visits: DataFrame | None = None,
) -> DataFrame:
    """Which visitor on which site stands for which subscription, and when.

    With `visits` only visitors seen there are mapped, so a consumer with many
    ids and many subscriptions is expanded for the ids that matter.
    """
    visitors = consumer_visitors(known)
    if visits is not None:
        visitors = visitors.join(visits.select("anonymous_id"), "anonymous_id", "left_semi")
    sites = product.select(F.col("product_id").alias("mdm_product_id"), "website_id")
    return (
        subscription_consumers(subscriptions)
        .join(visitors, "consumer_id")
        .join(sites, "mdm_product_id")
        .select("id_subscrip", "effective_date", "end_date", "anonymous_id", "website_id")
        .distinct()
    )


def attribute_events(
    visits: DataFrame, identities: DataFrame, day: dt.date | None = None
) -> DataFrame:
    """Give each visit the subscriptions its visitor held on that day; `day` if all visits are of one."""
    return effective_join(
        visits, identities, on=["anonymous_id", "website_id"], date="event_date", day=day
    )


def online_cancel_events(
    events: DataFrame,
    subscriptions: DataFrame,
    known: DataFrame,
    product: DataFrame,
    run_date: dt.date,
    experiment_start: dt.date = EXPERIMENT_START,
) -> DataFrame:
    """Cancel-flow visits of one day (never before the experiment) by subscription."""
    date = max(run_date, experiment_start)
    day = F.lit(date)
    # Small after the roll-up and read twice below; events are scanned once.
    visits = stage(roll_up_flags(flag_events(events.where(F.col("event_date") == day))), "visits")
    # Versions not valid that day cannot match; drop them before they fan out.
    current = subscriptions.where(day.between(F.col("effective_date"), F.col("end_date")))
    return attribute_events(visits, identity_map(current, known, product, visits), date)
