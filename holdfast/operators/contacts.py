"""Contact history per subscription: who contacted how, in which order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import labels
from holdfast.operators.outcome import PAIR, ContactDays, _anchors, days_of_calls, days_of_visits


def _after_email(linked: DataFrame, days: DataFrame, on: str | list[str]) -> DataFrame:
    return (
        _anchors(linked)
        .join(days, on)
        .where(F.col("event_date") >= F.col("first_email"))
        .select(*PAIR, "event_date")
    )


def call_days(linked: DataFrame, calls: DataFrame) -> DataFrame:
    """Distinct call days on or after the email date."""
    return _after_email(linked, days_of_calls(linked, calls), PAIR)


def page_days(linked: DataFrame, online: DataFrame) -> DataFrame:
    """Distinct cancel-page days on or after the email date."""
    opened = online.where(F.col("entered_acc_mng") == 1)
    return _after_email(linked, days_of_visits(linked, opened), "id_subscrip")


def contact_events(linked: DataFrame, calls: DataFrame, online: DataFrame) -> DataFrame:
    """Both contact kinds, tagged. Each side is distinct already."""
    opened = online.where(F.col("entered_acc_mng") == 1)
    return events_of_days(linked, ContactDays(days_of_calls(linked, calls), days_of_visits(linked, opened)))


def events_of_days(linked: DataFrame, days: ContactDays) -> DataFrame:
    """`contact_events` from days of contact."""
    called = _after_email(linked, days.calls, PAIR)
    opened = _after_email(linked, days.visits.where(F.col("opened") == 1), "id_subscrip")
    return called.withColumn("event_type", F.lit("Called In")).unionByName(
        opened.withColumn("event_type", F.lit("Opened Cancel Page"))
    )


def contact_sequence(events: DataFrame) -> DataFrame:
    """Rank of each contact day. A partition holds one row per day and kind."""
    by_day = Window.partitionBy(*PAIR).orderBy("event_date")
    return events.withColumn("rank_num", F.dense_rank().over(by_day))


def contact_steps(sequence: DataFrame) -> DataFrame:
    """One row per contact step: its kinds, joined alphabetically, and its dates."""
    return (
        sequence.withColumn("contact_order", labels.ordinal("rank_num"))
        .groupBy(*PAIR, "contact_order")
        .agg(
            F.array_join(F.array_sort(F.collect_set("event_type")), " & ").alias("contact_types"),
            F.collect_list("event_date").alias("contact_date"),
        )
    )


def contact_history(outcomes: DataFrame, steps: DataFrame, ordered: bool = True) -> DataFrame:
    """Outcome rows, one per contact step, defaulting to no action."""
    history = outcomes.join(steps, PAIR, "left").fillna(
        labels.NO_ACTION, ["contact_order", "contact_types"]
    )
    return history.orderBy("billing_account", "contact_order") if ordered else history
