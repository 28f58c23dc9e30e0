"""Monthly rate history of the experiment accounts (A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import labels
from holdfast.functions.keys import account_key
from holdfast.sources.cohort import BILLING_SYSTEM


def rate_links(
    subscriptions: DataFrame,
    link: DataFrame,
    product: DataFrame,
    publication: DataFrame,
    excluded_publication: str,
) -> DataFrame:
    """Account and subscription pairs outside one publication."""
    catalogue = product.select("product_id", "publication_id").join(
        publication.where(F.col("publication_name") != excluded_publication).select(
            "publication_id"
        ),
        "publication_id",
    )
    # Products and versions only decide which subscriptions count: a semi join
    # keeps the pair from multiplying by its versions.
    eligible = subscriptions.select(
        "id_subscrip", F.col("mdm_product_id").alias("product_id")
    ).join(catalogue, "product_id", "left_semi")
    return (
        link.where(F.col("billing_system") == BILLING_SYSTEM)
        .select(
            account_key("billing_account").alias("billing_account"),
            F.col("circ_idsubscrip").alias("id_subscrip"),
        )
        .join(eligible, "id_subscrip", "left_semi")
        .select("billing_account", "id_subscrip")
        .distinct()
    )


def earliest_cancels(outcomes: DataFrame) -> DataFrame:
    return outcomes.select(
        "billing_account",
        "current_rate",
        "email_date",
        labels.earliest("__call_cancel_date", "__ol_cancel_date").alias("__cancel_date"),
        "cohort",
    )


def attach_rates(accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Rates that had not ended by the email date; accounts without any remain."""
    r = rates.select(
        F.col("id_subscrip").alias("rate_id"),
        "effective_date",
        "end_date",
        "rate_key_value",
        "rate_key_system",
    )
    return accounts.join(
        r,
        (F.col("id_subscrip") == F.col("rate_id"))
        & (F.col("end_date") >= F.col("email_date")),
        "left",
    )


def map_rate_keys(rated: DataFrame, mapping: DataFrame) -> DataFrame:
    """Price of each rate key; the system name matches in any case."""
    m = mapping.select(
        F.col("rate_key_value").alias("map_value"),
        F.lower("rate_key_system").alias("map_system"),
        "monthly_price",
    )
    return rated.join(
        m,
        (F.col("rate_key_value") == F.col("map_value"))
        & (F.lower("rate_key_system") == F.col("map_system")),
        "left",
    ).drop("map_value", "map_system")


def month_cost(price: str = "monthly_price"):
    """Price floored at 0, in cents; an unknown price stays unknown."""
    value = F.col(price).cast("double")
    return F.when(value.isNotNull(), F.round(F.greatest(value, F.lit(0.0)), 2))


def rate_history(
    outcomes: DataFrame, links: DataFrame, rates: DataFrame, mapping: DataFrame
) -> DataFrame:
    """Every rate an experiment account was on since its email date."""
    # DISTINCT before the fan-out: the final rows depend on the account row only
    # through these columns.
    accounts = earliest_cancels(outcomes).distinct().join(links, "billing_account")
    return (
        map_rate_keys(attach_rates(accounts, rates), mapping)
        .select(
            "billing_account", "current_rate", "email_date", "__cancel_date", "cohort",
            F.col("rate_id").alias("id_subscrip"), "effective_date", "end_date",
            month_cost().alias("month_cost"),
        )
        .distinct()
    )
