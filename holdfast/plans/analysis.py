"""The behavioural analysis from one labelled population to its result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.labels import TREATMENTS
from holdfast.operators import distribution, population, profile, quality
from holdfast.sources.tables import export_csv, stage


@dataclass(frozen=True)
class Settings:
    metrics: Sequence[str] = population.METRICS
    segment_fields: Sequence[str] = population.SEGMENT_FIELDS
    summary_fields: Sequence[str] = population.SUMMARY_FIELDS
    min_profile_users: int = profile.MIN_PROFILE_USERS
    min_treatment_users: int = profile.MIN_TREATMENT_USERS
    top_contrasts: int = profile.TOP_CONTRASTS
    bootstrap_iterations: int = 2000
    confidence_level: float = 0.95
    seed: int = 42


def analyze(labelled: DataFrame, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Every result table of the analysis, by name.

    The labelled population is staged once; the reference and the contrasts,
    which are metric- and segment-sized, are staged because later steps read them
    several times.
    """
    s = settings
    labelled = stage(labelled, "labelled")
    analysis = population.subset(labelled, "analysis")
    contacted = population.subset(labelled, "contacted")
    quality.require_valid_population(analysis, population.ACCOUNT, s.metrics, whole=labelled)
    contexts = {title: population.members(n) for title, n in population.CONTEXT_POPULATIONS}

    counts = profile.population_counts(analysis, s.metrics, s.segment_fields)
    reference = stage(profile.reference_from_counts(counts, s.metrics), "reference")
    profiles = stage(
        profile.behavior_profiles(
            analysis, reference, s.metrics, ["outcome", *s.segment_fields], s.min_profile_users,
            counts,
        ),
        "profiles",
    )
    profile.require_rows(profiles, f"No behavior profiles meet min_n={s.min_profile_users}.")
    contrasts = stage(
        profile.outcome_contrasts(profiles, s.metrics, s.segment_fields), "contrasts"
    )
    profile.require_rows(contrasts, "No Saved and Stopped profile rows share a segment.")
    treatments = stage(
        profile.treatment_contrasts(
            analysis, contrasts, reference, s.metrics, s.segment_fields, s.top_contrasts,
            s.min_treatment_users, counts,
        ),
        "treatments",
    )
    details = profile.segment_details(
        analysis, treatments, reference, s.metrics, [*s.segment_fields, "Treatment"],
        top_n=s.top_contrasts * 3, bootstrap_iterations=s.bootstrap_iterations,
        confidence_level=s.confidence_level, seed=s.seed, counts=counts,
    )
    return {
        "population_counts": population.funnel(labelled),
        "distribution_summary": distribution.population_summaries(labelled, s.metrics, contexts),
        "primary_segment_summaries": distribution.segment_summaries(
            analysis, s.summary_fields, s.metrics
        ),
        "likely_discount_shopper_behavior_summary": distribution.distribution_summary(
            contacted, s.metrics, ["likely_discount_shopper"]
        ),
        "primary_behavior_reference": reference,
        "behavior_profiles": profiles,
        "saved_minus_stopped_contrasts": contrasts,
        "selected_segment_treatment_contrasts": treatments,
        "selected_segment_details": details,
    }


def export(
    results: dict[str, DataFrame], folder: str, segment_fields: Sequence[str] = population.SEGMENT_FIELDS
) -> None:
    """CSV per result, rows in the order of the report: a staged table has none."""
    order = {
        "behavior_profiles": [
            F.desc_nulls_last("profile_magnitude"), F.desc("users"), "outcome", *segment_fields
        ],
        "saved_minus_stopped_contrasts": ["segment_rank"],
        "selected_segment_treatment_contrasts": [
            "segment_rank", F.array_position(F.array(*map(F.lit, TREATMENTS)), F.col("Treatment"))
        ],
    }
    for name, df in results.items():
        export_csv(df.orderBy(*order[name]) if name in order else df, f"{folder}/{name}")
