"""The experiment chain: cohort, outcome, revenue, contact history.

Each function stages what the next steps read more than once, where the
warehouse version of this work wrote a table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from holdfast.functions.dates import EXPERIMENT_START, FILE_DATE_OVERRIDES
from holdfast.operators import contacts, outcome, revenue
from holdfast.sources.tables import stage


@dataclass(frozen=True)
class ExperimentTables:
    """Source tables of the outcome chain."""

    applied: DataFrame
    link: DataFrame
    weekly_source: DataFrame
    calls: DataFrame
    online: DataFrame
    start_stop: DataFrame
    metrics: DataFrame
    payments: DataFrame


def linked_assignments(
    t: ExperimentTables, overrides: Mapping[dt.date, dt.date] = FILE_DATE_OVERRIDES
) -> DataFrame:
    """Assignments with subscription ids; every contact step starts here."""
    assigned = outcome.clean_assignments(t.applied, overrides)
    return stage(outcome.link_subscriptions(assigned, t.link, t.weekly_source), "linked")


def contact_days(t: ExperimentTables, linked: DataFrame) -> outcome.ContactDays:
    """Calls and visits as days; hand them to `outcomes` and `contact_history` so that both scan them once."""
    return outcome.contact_days(linked, t.calls, t.online)


def outcomes(
    t: ExperimentTables,
    linked: DataFrame,
    strict_subscription: bool = False,
    days: outcome.ContactDays | None = None,
) -> DataFrame:
    """The outcome table, read by revenue, history, rates and journey."""
    days = days or contact_days(t, linked)
    base = outcome.assemble_days(linked, days, t.start_stop, strict_subscription)
    classified = outcome.classify(outcome.derive_contacts(base))
    return stage(
        outcome.attach_behaviour(classified, t.weekly_source, t.metrics), "outcomes"
    )


def revenue_outcomes(
    t: ExperimentTables, outcome_rows: DataFrame, start: dt.date = EXPERIMENT_START
) -> DataFrame:
    return revenue.revenue_table(outcome_rows, t.payments, start)


def contact_history(
    t: ExperimentTables,
    linked: DataFrame,
    outcome_rows: DataFrame,
    ordered: bool = True,
    days: outcome.ContactDays | None = None,
) -> DataFrame:
    events = contacts.events_of_days(linked, days or contact_days(t, linked))
    steps = contacts.contact_steps(contacts.contact_sequence(events))
    return contacts.contact_history(outcome_rows, steps, ordered)
