"""Payments after contact, revenue, churn rate and CNRC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import labels
from holdfast.functions.dates import EXPERIMENT_START
from holdfast.functions.keys import account_key, null_safe_join
from holdfast.operators.outcome import PAIR
from holdfast.operators.reduction import restrict

STRATEGY = ["cohort", "Treatment"]
TERMS = ["churned", "offered_rate", "new_rate", "pricing_effective_date", "__earlist_contact_date"]
CNRC_WINDOWS = (30, 60, 90)


def settle_payments(payments: DataFrame) -> DataFrame:
    """Invoices with their settlement status."""
    return payments.withColumn(
        "payment_status",
        labels.payment_status("id_payment_date", "id_decline_date", "amount", "status"),
    )


def payment_facts(payments: DataFrame, start: dt.date = EXPERIMENT_START) -> DataFrame:
    """Paid invoices since `start`; the billed amount is missing if either part is."""
    recent = payments.where(
        (F.col("id_payment_date") >= F.lit(start)) & (F.col("balance") >= 0)
    )
    return (
        settle_payments(recent)
        .where(F.col("payment_status") == "Paid")
        .select(
            account_key("account").alias("billing_account"),
            "id_subscrip",
            "invoice_number",
            (F.col("amount_without_tax") + F.col("balance")).alias("billing_amount"),
            "balance",
            "id_payment_date",
            "payment_status",
        )
    )


def evaluable(outcomes: DataFrame) -> DataFrame:
    """Rows with a churn label, plus the treatment and tier label."""
    return outcomes.where(F.col("churned").isNotNull()).withColumn(
        "treatment_plus_tier", F.concat("Treatment", F.lit(" - "), "src_risk_tier")
    )


def qualifying_payments(
    population: DataFrame, facts: DataFrame, by: Sequence[str] = STRATEGY
) -> DataFrame:
    """Payments after the first contact and not before the new price.

    Payments are limited to contacted accounts and then counted per account, day
    and amount: an account with a flood of invoices brings one row per distinct
    day and amount to the join. `payments` is that count and weighs every later
    sum. The columns `by` of the population stay.
    """
    contacted = population.where(F.col("__earlist_contact_date").isNotNull())
    own = restrict(facts, contacted, PAIR)
    daily = own.groupBy(*PAIR, "id_payment_date", "billing_amount").agg(
        F.count(F.lit(1)).alias("payments")
    )
    terms = contacted.select(*PAIR, *by, *TERMS)
    return terms.join(daily, PAIR).where(
        (F.col("id_payment_date") > F.col("__earlist_contact_date"))
        & (F.col("id_payment_date") >= F.col("pricing_effective_date"))
    )


def flag_payments(qualifying: DataFrame) -> DataFrame:
    """Amount had the offer been kept, below-offer and at-new-rate flags."""
    billed, offered = F.col("billing_amount"), F.col("offered_rate")
    return qualifying.withColumns(
        {
            "bill_amount_save_once": F.when(billed < offered, offered).otherwise(billed),
            "repeatedly_called": F.when(billed < offered, 1).otherwise(0),
            "skpi_gap_wip": F.when(billed == F.col("new_rate"), 1).otherwise(0),
        }
    )


def account_revenue(flagged: DataFrame) -> DataFrame:
    """Totals and any-flags per account and subscription."""
    return flagged.groupBy(*PAIR).agg(
        F.sum(F.col("billing_amount") * F.col("payments")).alias("tt_paid_raw"),
        F.sum(F.col("bill_amount_save_once") * F.col("payments")).alias("tt_paid_save_once"),
        F.max("repeatedly_called").alias("repeatedly_called"),
        F.max("skpi_gap_wip").alias("skpi_gap_wip"),
    )


def attach_revenue(population: DataFrame, revenue: DataFrame) -> DataFrame:
    """Population with revenue, nothing paid counted as 0."""
    return (
        population.join(revenue, PAIR, "left")
        .fillna(0, ["tt_paid_raw", "tt_paid_save_once", "repeatedly_called", "skpi_gap_wip"])
        .distinct()
    )


def exclude_rate_gap(df: DataFrame) -> DataFrame:
    """Drop retained accounts billed at the new rate: their offer is unresolved."""
    return df.where((F.col("skpi_gap_wip") == 0) | (F.col("churned") == 1))


def retained_revenue(df: DataFrame) -> DataFrame:
    """Churned rows earn nothing; the helper flag goes."""

    def kept(name: str) -> Column:
        return F.when(F.col("churned") == 0, F.col(name)).otherwise(0).alias(name)

    paid = ["tt_paid_raw", "tt_paid_save_once"]
    others = [c for c in df.columns if c not in (*paid, "skpi_gap_wip")]
    return df.select(*others, *[kept(name) for name in paid])


def revenue_table(
    outcomes: DataFrame, payments: DataFrame, start: dt.date = EXPERIMENT_START
) -> DataFrame:
    """Outcome rows with revenue: the table the behavioural analysis reads."""
    population = evaluable(outcomes)
    revenue = account_revenue(
        flag_payments(qualifying_payments(population, payment_facts(payments, start)))
    )
    return retained_revenue(exclude_rate_gap(attach_revenue(population, revenue)))


def churn_rate(outcomes: DataFrame, by: Sequence[str] = STRATEGY) -> DataFrame:
    """Share of contacted, evaluable rows that churned, per strategy."""
    return (
        outcomes.where(F.col("churned").isNotNull() & F.col("__earlist_contact_date").isNotNull())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("churned").alias("churned"),
            F.avg("churned").alias("churn_rate"),
        )
    )


def cnrc(
    outcomes: DataFrame,
    facts: DataFrame,
    windows: Sequence[int] = CNRC_WINDOWS,
    by: Sequence[str] = STRATEGY,
) -> DataFrame:
    """Cumulative net revenue per caller: what retained customers paid within N
    days of contact, divided by all contacted accounts of the group.

    Groups are `by`, a missing value being a group. An account that stands in
    several groups, as one with several risk tiers, counts in each.
    """
    contacted = evaluable(outcomes).where(F.col("__earlist_contact_date").isNotNull())
    callers = contacted.groupBy(*by).agg(
        F.count_distinct("billing_account").alias("callers")
    )
    # The tier join may fan an account out; revenue must count each row once.
    terms = contacted.select(*PAIR, *by, *TERMS).distinct()
    age = F.date_diff("id_payment_date", "__earlist_contact_date")
    amount = F.col("billing_amount") * F.col("payments")
    paid = (
        qualifying_payments(terms.where(F.col("churned") == 0), facts, by)
        .groupBy(*by)
        .agg(*[F.sum(F.when(age <= days, amount)).alias(f"d{days}") for days in windows])
    )
    spread = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(days).alias("window_days"),
                    F.coalesce(F.col(f"d{days}"), F.lit(0)).alias("revenue"),
                )
                for days in windows
            ]
        )
    )
    return (
        null_safe_join(callers, paid, list(by), "left")
        .select(*by, "callers", spread.alias("w"))
        .select(
            *by,
            "w.window_days",
            "callers",
            "w.revenue",
            (F.col("w.revenue") / F.col("callers")).alias("cnrc"),
        )
    )
