"""Analysis population: labels, named subsets, funnel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import labels
from holdfast.functions.dates import MATURITY_CUTOFF
from holdfast.functions.keys import nan_to_null

ACCOUNT = "billing_account"
METRICS = ("frequency", "breadth", "tenure", "tt_cost")
SEGMENT_FIELDS = ("contact_channel_group", "contact_timing", "cohort", "src_risk_tier")
SUMMARY_FIELDS = (
    "src_risk_tier", "cohort", "Treatment", "contact_channel_group", "outcome", "contact_timing",
)

# Funnel rows in reporting order.
FUNNEL = (
    ("0. All mature notified users", "all"),
    ("1. No Action yet", "no_action"),
    ("1. Contacted users", "contacted"),
    ("2. Likely gamers — diagnostic only", "gamer"),
    ("2. Called once — primary analysis", "analysis"),
    ("3. Called once and Saved", "saved"),
    ("3. Called once and Stopped", "stopped"),
)
# Populations compared in the distribution summary.
CONTEXT_POPULATIONS = (
    ("No Action yet", "no_action"),
    ("Called once — primary", "analysis"),
    ("Called once and Saved", "saved"),
    ("Called once and Stopped", "stopped"),
)


def label_population(
    outcomes: DataFrame,
    cutoff: dt.date = MATURITY_CUTOFF,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Mature rows with channel group, shopper class, outcome and clean metrics."""
    group = labels.channel_group("contact_channel")
    return outcomes.where(F.col("email_date") < F.lit(cutoff)).withColumns(
        {
            "contact_channel_group": group,
            "likely_discount_shopper": labels.shopper_class("repeatedly_called", group),
            "outcome": labels.outcome("status"),
            "src_risk_tier": labels.risk_tier("src_risk_tier"),
            **{m: nan_to_null(m) for m in metrics},
        }
    )


def members(name: str) -> Column:
    """Membership predicate of a named subset; never NULL."""
    contacted = F.col("status").isin("saved", "stoped")
    once = contacted & (F.col("likely_discount_shopper") == "Other")
    predicates = {
        "all": F.lit(True),
        "no_action": F.col("status") == labels.NO_ACTION,
        "contacted": contacted,
        "gamer": contacted & (F.col("likely_discount_shopper") != "Other"),
        "analysis": once,
        "saved": once & (F.col("outcome") == labels.SAVED),
        "stopped": once & (F.col("outcome") == labels.STOPPED),
    }
    return F.coalesce(predicates[name], F.lit(False))


def subset(labelled: DataFrame, name: str) -> DataFrame:
    return labelled.where(members(name))


def funnel(labelled: DataFrame) -> DataFrame:
    """Distinct accounts per population and their share of all.

    Reduced to one row per account first: one shuffle on the account instead of
    one DISTINCT per population.
    """
    accounts = (
        labelled.where(F.col(ACCOUNT).isNotNull())
        .groupBy(ACCOUNT)
        .agg(*[F.max(members(name)).alias(name) for _, name in FUNNEL])
    )
    return funnel_rows(accounts.agg(*[F.count_if(F.col(name)).alias(name) for _, name in FUNNEL]))


def funnel_rows(totals: DataFrame) -> DataFrame:
    """The funnel from one row with the accounts of each population."""
    rows = F.array(
        *[
            F.struct(F.lit(title).alias("population"), F.col(name).alias("accounts"))
            for title, name in FUNNEL
        ]
    )
    share = F.try_divide(F.col("accounts") * 100.0, F.col("all"))
    return totals.select(F.inline(rows), "all").select(
        "population", "accounts", share.alias("share_of_all_pct")
    )
