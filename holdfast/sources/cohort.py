"""Weekly risk-tier cohort: subscriptions, markets, billing links."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import labels
from holdfast.functions.dates import target_date
from holdfast.operators.intervals import effective_join

BILLING_SYSTEM = "ZUORA"

# Publications reported under one market name.
MARKET_RULES = ("Bergen", "Detroit", "Palm Beach")

# Markets taking part in the experiment.
PARTICIPATING_MARKETS = (
    "Cambridge", "Sarasota", "Peoria", "York Dispatch", "Marion", "DoverNH",
    "East Brunswick", "Massillon", "Palm Beach", "WilmingtonNC", "Daytona Beach",
    "Topeka", "Newark", "York Daily Record", "MonroeMI", "Beaver", "Lancaster",
    "Canandaigua", "Worcester", "Bloomington", "Mansfield", "Staunton", "Port Huron",
    "Zanesville", "Stroudsburg", "Anderson", "Thibodaux", "ND Insider", "Yreka",
    "Salinas", "Spencer", "Monmouth", "Geneseo", "Des Moines", "Cincinnati", "Naples",
    "Bergen", "Palm Springs", "Greenville", "Green Bay", "Louisville", "Asheville",
    "Brevard", "JacksonMS", "Pensacola", "Evansville", "Appleton", "Detroit", "Phoenix",
    "Indianapolis", "Milwaukee", "Rochester", "Alliance", "Hattiesburg", "Lubbock",
    "St. Augustine", "Utica", "ColumbiaTN", "Providence", "Erie", "JacksonvilleFL",
    "Kitsap", "Gainesville", "Wooster", "Spartanburg", "Fall River", "Norwich", "Adrian",
    "Wausau", "Bridgewater", "Fort Myers", "Corpus Christi", "Nashville", "Westchester",
    "Asbury", "Lansing", "Treasure Coast", "Reno", "Memphis", "Sioux Falls",
    "BurlingtonVT",
)


def normalize_market(
    df: DataFrame, name: str = "publication_name", rules: Sequence[str] = MARKET_RULES
) -> DataFrame:
    return df.withColumn("market", labels.market(name, rules))


def subscription_publications(
    subscriptions: DataFrame,
    product: DataFrame,
    publication: DataFrame,
    rules: Sequence[str] = MARKET_RULES,
) -> DataFrame:
    """Which publication and market a subscription belonged to, and when."""
    return _placed_versions(subscriptions, product, publication, rules).distinct()


def _placed_versions(
    subscriptions: DataFrame, product: DataFrame, publication: DataFrame, rules: Sequence[str]
) -> DataFrame:
    catalogue = product.select("product_id", "publication_id").join(
        publication.select("publication_id", "publication_name"), "publication_id"
    )
    named = subscriptions.select(
        "id_subscrip",
        "effective_date",
        "end_date",
        F.col("mdm_product_id").alias("product_id"),
    ).join(catalogue, "product_id")
    return normalize_market(named, rules=rules).select(
        "id_subscrip", "effective_date", "end_date", "market", "publication_id",
        "publication_name",
    )


def billing_links(link: DataFrame, billing_system: str = BILLING_SYSTEM) -> DataFrame:
    """Distinct subscription and billing-account pairs of one billing system."""
    return (
        link.where(F.col("billing_system") == billing_system)
        .select("circ_idsubscrip", "billing_account")
        .distinct()
    )


def week_of(tiers: DataFrame, run_date: dt.date | str) -> DataFrame:
    """Rows of the Sunday week of `run_date`; filters the bare partition column."""
    return tiers.where(F.col("inference_date") == F.lit(target_date(run_date, "sunday")))


def in_markets(df: DataFrame, markets: Sequence[str] = PARTICIPATING_MARKETS) -> DataFrame:
    """Allow-list filter. The list is configuration, so it stays a pushed-down IN."""
    return df.where(F.col("market").isin(list(markets)))


def in_market_table(df: DataFrame, markets: DataFrame) -> DataFrame:
    """Allow-list kept in a table with a `market` column."""
    return df.join(markets.select("market"), "market", "left_semi")


def weekly_risk_source(
    tiers: DataFrame,
    subscriptions: DataFrame,
    product: DataFrame,
    publication: DataFrame,
    link: DataFrame,
    run_date: dt.date | str,
    markets: Sequence[str] = PARTICIPATING_MARKETS,
    rules: Sequence[str] = MARKET_RULES,
) -> DataFrame:
    """The weekly cohort: risk tier, billing account and market per subscription."""
    day = F.lit(target_date(run_date, "sunday"))
    # The week is known, so superseded and future versions never reach the join.
    current = subscriptions.where(day.between(F.col("effective_date"), F.col("end_date")))
    # The final DISTINCT covers repeated versions; one more here would only shuffle.
    places = in_markets(_placed_versions(current, product, publication, rules), markets)
    placed = effective_join(
        week_of(tiers, run_date), places, on=["id_subscrip"], date="inference_date",
        day=target_date(run_date, "sunday"),
    )
    links = billing_links(link).withColumnRenamed("circ_idsubscrip", "id_subscrip")
    return (
        placed.join(links, "id_subscrip")
        .select(
            "inference_date", "billing_account", "id_subscrip", "risk_tier", "market",
            "publication_name",
        )
        .distinct()
    )
