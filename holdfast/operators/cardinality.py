"""Guardrail: accounts that stand for more than one subscription."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.keys import account_key
from holdfast.sources.cohort import BILLING_SYSTEM


def keys_with_many_children(df: DataFrame, keys: Sequence[str], child: str) -> DataFrame:
    """Keys with more than one distinct child id, with that number.

    MIN < MAX would be enough for a yes/no answer; the count is reported too, and
    the distinct (key, child) step already spreads a hot key by child.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count_distinct(child).alias("children"))
        .where(F.col("children") > 1)
    )


def account_violations(
    assignments: DataFrame, link: DataFrame, weekly_source: DataFrame
) -> DataFrame:
    """Assigned rows per model type whose account has several subscriptions."""
    linked = link.where(
        (F.col("billing_system") == BILLING_SYSTEM)
        & (F.col("circ_status") == "Active")
        & (F.col("circ_site") != "PLAY")
    ).select(
        F.lit("MIDPOINT").alias("modeltype"),
        account_key("billing_account").alias("account"),
        F.col("circ_idsubscrip").alias("id_subscrip"),
    )
    weekly = weekly_source.select(
        F.lit("PCHURN").alias("modeltype"),
        account_key("billing_account").alias("account"),
        "id_subscrip",
    )
    violating = keys_with_many_children(
        linked.unionByName(weekly), ["modeltype", "account"], "id_subscrip"
    )
    assigned = assignments.where(F.col("modeltype").isin("MIDPOINT", "PCHURN")).select(
        "modeltype", account_key("subscription").alias("account")
    )
    # A violating (model type, account) is unique, so the left join cannot fan out
    # and both model types are reported even when neither has a violation.
    flagged = violating.select("modeltype", "account", F.lit(1).alias("hit"))
    return assigned.join(flagged, ["modeltype", "account"], "left").groupBy("modeltype").agg(
        F.count("hit").alias("cnt")
    )


def verdict(violations: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("cnt"), F.lit(0))
    return violations.agg(
        F.when(total == 0, "No violations").otherwise("Some violations").alias("Result")
    )
