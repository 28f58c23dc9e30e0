"""Behaviour reference, robust scores, profiles and contrasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import scores
from holdfast.functions.keys import null_safe_join
from holdfast.functions.labels import (
    LABEL_SEPARATOR,
    OUTCOMES,
    SAVED,
    STOPPED,
    TREATMENTS,
    segment_label,
)
from holdfast.operators.bootstrap import median_difference_intervals
from holdfast.operators.population import ACCOUNT, METRICS, SEGMENT_FIELDS
from holdfast.operators.quantiles import (
    BinnedCounts,
    binned_counts,
    interpolate,
    order_statistics,
    regroup_counts,
    value_counts,
)

MIN_PROFILE_USERS = 20
MIN_TREATMENT_USERS = 5
TOP_CONTRASTS = 8


# --- reference and scaling (D8-D10) ---------------------------------------------


def fit_reference(df: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Clipping bounds, center and spread per metric.

    The spread is the IQR; where that is zero the clipped range, and finally 1.
    One row per metric, a metric without values included.
    """
    return reference_from_counts(value_counts(df, [], metrics), metrics)


def population_counts(
    df: DataFrame,
    metrics: Sequence[str] = METRICS,
    segment_fields: Sequence[str] = SEGMENT_FIELDS,
) -> BinnedCounts:
    """Value counts at the finest grouping the steps below use, with the bins of their values.

    Passed as `counts`, it serves the reference, the profiles, the treatment
    drill-down and the details from one scan of the account rows.
    """
    return binned_counts(df, ["outcome", *segment_fields, "Treatment"], metrics)


def reference_from_counts(counts: DataFrame | BinnedCounts, metrics: Sequence[str]) -> DataFrame:
    """Reference from counts of any grouping that has a row per metric and value."""
    binned = isinstance(counts, BinnedCounts)
    if not binned and set(counts.columns) != {"metric", "value", "n"}:
        counts = regroup_counts(counts, [])
    wanted = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    fitted = order_statistics(counts, ["metric"], wanted).select(
        "metric", *[interpolate(p).alias(p) for p in wanted]
    )
    listed = df_of_names(counts.totals if binned else counts, metrics)
    spread = F.coalesce(
        F.nullif(F.col("p75") - F.col("p25"), F.lit(0.0)),
        F.nullif(F.col("p99") - F.col("p01"), F.lit(0.0)),
        F.lit(1.0),
    )
    return listed.join(fitted, "metric", "left").select(
        "metric", "p01", F.col("p50").alias("center"), spread.alias("spread"), "p99"
    )


def df_of_names(like: DataFrame, names: Sequence[str]) -> DataFrame:
    """The metric names as rows; as many as the caller lists."""
    return like.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("metric")
    )


def reference_columns(reference: DataFrame, metrics: Sequence[str]) -> dict[str, Column]:
    """Per metric one struct column, read from the reference by scalar subquery.

    The reference has one row per metric, so nothing is joined or broadcast.
    """
    fields = "p01, center, spread, p99"
    return {
        m: reference.where(F.col("metric") == m)
        .agg(F.expr(f"first(struct({fields}))").alias("r"))
        .scalar()
        for m in metrics
    }


def clip_metrics(df: DataFrame, metrics: Sequence[str], reference: DataFrame) -> DataFrame:
    """Metrics clipped to the reference bounds, in place."""
    refs = reference_columns(reference, metrics)
    return df.withColumns(
        {m: scores.clip(F.col(m), r["p01"], r["p99"]) for m, r in refs.items()}
    )


def score_metrics(df: DataFrame, metrics: Sequence[str], reference: DataFrame) -> DataFrame:
    """Metrics as clipped, centered and scaled scores, in place."""
    refs = reference_columns(reference, metrics)
    return df.withColumns(
        {
            m: scores.robust_score(F.col(m), r["p01"], r["p99"], r["center"], r["spread"])
            for m, r in refs.items()
        }
    )


def _with_reference(stats: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference next to long-form statistics; one row per metric, so it is small."""
    return stats.join(F.broadcast(reference), "metric")


def _clipped(value: Column) -> Column:
    return scores.clip(value, F.col("p01"), F.col("p99"))


def _scored(value: Column) -> Column:
    return (_clipped(value) - F.col("center")) / F.col("spread")


# --- profiles and contrasts (D11-D16) -------------------------------------------


def _medians(
    counts: DataFrame | BinnedCounts, keys: Sequence[str], metrics: Sequence[str], reference: DataFrame
) -> DataFrame:
    """Raw and score medians in wide form: `raw__m`, `score__m` per group.

    Scaling is monotone, so one set of order statistics serves both.
    """
    stats = order_statistics(counts, [*keys, "metric"], {"p50": 0.5})
    long = _with_reference(stats, reference).select(
        *keys,
        "metric",
        interpolate("p50").alias("raw"),
        interpolate("p50", _scored).alias("score"),
    )
    return long.groupBy(*keys).agg(
        *[
            F.expr(f"max(if(metric = '{m}', {kind}, null))").alias(f"{kind}__{m}")
            for kind in ("raw", "score")
            for m in metrics
        ]
    )


def behavior_profiles(
    df: DataFrame,
    reference: DataFrame,
    metrics: Sequence[str] = METRICS,
    segment_fields: Sequence[str] = ("outcome", *SEGMENT_FIELDS),
    min_n: int = MIN_PROFILE_USERS,
    counts: BinnedCounts | None = None,
) -> DataFrame:
    """Profile of every segment with enough accounts, strongest first."""
    if counts is None:
        counts = value_counts(df, segment_fields, metrics)
    users = (
        df.groupBy(*segment_fields)
        .agg(F.count_distinct(ACCOUNT).alias("users"))
        .where(F.col("users") >= min_n)
    )
    medians = _medians(counts, segment_fields, metrics, reference)
    named = {m: F.col(f"score__{m}") for m in metrics}
    return (
        null_safe_join(users, medians, segment_fields, "left")
        .select(
            *segment_fields,
            segment_label(segment_fields).alias("segment_label"),
            "users",
            *[F.col(f"raw__{m}").alias(f"median__{m}") for m in metrics],
            *[f"score__{m}" for m in metrics],
            scores.magnitude(list(named.values())).alias("profile_magnitude"),
            scores.dominant(named).alias("dominant_metric"),
        )
        .orderBy(
            F.desc_nulls_last("profile_magnitude"), F.desc("users"), *segment_fields
        )
    )


def outcome_contrasts(
    profiles: DataFrame,
    metrics: Sequence[str] = METRICS,
    segment_fields: Sequence[str] = SEGMENT_FIELDS,
) -> DataFrame:
    """Saved minus Stopped profile per segment, ranked by contrast.

    A segment has at most one profile per outcome, so a grouped pivot pairs them;
    grouping also matches a missing field with a missing field.
    """

    def of(outcome: str, column: str) -> Column:
        return F.expr(f"max(if(outcome = '{outcome}', `{column}`, null))")

    sides = ((SAVED, "saved"), (STOPPED, "stopped"))
    paired = (
        profiles.where(F.col("outcome").isin(*OUTCOMES))
        .groupBy(*segment_fields)
        .agg(
            *[of(o, "users").alias(f"n__{s}") for o, s in sides],
            *[of(o, f"median__{m}").alias(f"median_{s}__{m}") for o, s in sides for m in metrics],
            *[of(o, f"score__{m}").alias(f"score_{s}__{m}") for o, s in sides for m in metrics],
        )
        .where(F.col("n__saved").isNotNull() & F.col("n__stopped").isNotNull())
    )
    deltas = paired.withColumns(
        {f"delta__{m}": F.col(f"score_saved__{m}") - F.col(f"score_stopped__{m}") for m in metrics}
    ).withColumn("total_users", F.col("n__saved") + F.col("n__stopped"))
    named = {m: F.col(f"delta__{m}") for m in metrics}
    by_contrast = Window.orderBy(
        F.desc_nulls_last("contrast_magnitude"), F.desc("total_users"), *segment_fields
    )
    described = deltas.withColumns(
        {
            "observed_saved_share": F.col("n__saved") / F.col("total_users"),
            "contrast_magnitude": scores.magnitude(list(named.values())),
            "dominant_metric": scores.dominant(named),
        }
    )
    lead = F.create_map(*[x for m in metrics for x in (F.lit(m), F.col(f"delta__{m}"))])
    lead = F.try_element_at(lead, F.col("dominant_metric"))
    return described.select(
        # Segment-sized input: one row per matched segment, never account rows.
        (F.row_number().over(by_contrast) - 1).alias("segment_rank"),
        *segment_fields,
        segment_label(segment_fields).alias("segment_label"),
        "n__saved",
        "n__stopped",
        *[f"median_{s}__{m}" for _, s in sides for m in metrics],
        *[f"delta__{m}" for m in metrics],
        "total_users",
        "observed_saved_share",
        "contrast_magnitude",
        "dominant_metric",
        F.when(lead >= 0, SAVED).when(lead.isNotNull(), STOPPED).alias("dominant_outcome"),
    ).orderBy("segment_rank")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise when a step found nothing, before later steps build on it."""
    if df.isEmpty():
        raise ValueError(message)
    return df


# --- drill-down of the strongest contrasts (D14, D17, D18) ------------------------


def top_segments(contrasts: DataFrame, top_n: int, *tie_break: str) -> DataFrame:
    return contrasts.orderBy("segment_rank", *tie_break).limit(top_n)


def match_segments(
    df: DataFrame, selected: DataFrame, segment_fields: Sequence[str]
) -> DataFrame:
    """Rows of the selected segments, missing fields matching missing fields.

    A `selected` that is small when it is measured is broadcast by AQE.
    """
    return null_safe_join(df, selected, segment_fields)


def treatment_contrasts(
    df: DataFrame,
    contrasts: DataFrame,
    reference: DataFrame,
    metrics: Sequence[str] = METRICS,
    segment_fields: Sequence[str] = SEGMENT_FIELDS,
    top_n: int = TOP_CONTRASTS,
    min_n: int = MIN_TREATMENT_USERS,
    counts: BinnedCounts | None = None,
) -> DataFrame:
    """The strongest segments split by treatment, empty cells included."""
    selected = top_segments(contrasts, top_n).select(
        "segment_rank", "segment_label", *segment_fields
    )
    cell = ["segment_rank", "Treatment"]
    by_outcome = [*cell, "outcome"]

    def in_cells(rows: DataFrame) -> DataFrame:
        return match_segments(rows, selected.drop("segment_label"), segment_fields).where(
            F.col("Treatment").isin(*TREATMENTS) & F.col("outcome").isin(*OUTCOMES)
        )

    rows = in_cells(df)
    if counts is None:
        counts = value_counts(rows, by_outcome, metrics)
    else:
        counts = counts.map(in_cells)
    users = rows.groupBy(*by_outcome).agg(F.count_distinct(ACCOUNT).alias("users"))
    medians = _medians(counts, by_outcome, metrics, reference)
    stats = null_safe_join(users, medians, by_outcome, "left")

    sides = ((SAVED, "saved"), (STOPPED, "stopped"))
    wide = stats.groupBy(*cell).agg(
        *[
            F.expr(f"max(if(outcome = '{o}', users, null))").alias(f"n__{s}") for o, s in sides
        ],
        *[
            F.expr(f"max(if(outcome = '{o}', `raw__{m}`, null))").alias(f"median_{s}__{m}")
            for o, s in sides
            for m in metrics
        ],
        *[
            F.expr(f"max(if(outcome = '{o}', `score__{m}`, null))").alias(f"score_{s}__{m}")
            for o, s in sides
            for m in metrics
        ],
    )
    treatments = F.array(*[F.lit(t) for t in TREATMENTS])
    grid = selected.select("*", F.posexplode(treatments).alias("treatment_order", "Treatment"))
    full = grid.join(wide, cell, "left").fillna(0, ["n__saved", "n__stopped"])
    supported = (F.col("n__saved") >= min_n) & (F.col("n__stopped") >= min_n)
    full = full.withColumn("supported", supported).withColumns(
        {
            "total_users": F.col("n__saved") + F.col("n__stopped"),
            **{
                f"delta__{m}": F.when(
                    F.col("supported"),
                    F.col(f"score_saved__{m}") - F.col(f"score_stopped__{m}"),
                )
                for m in metrics
            },
        }
    )
    named = {m: F.col(f"delta__{m}") for m in metrics}
    return full.orderBy("segment_rank", "treatment_order").select(
        "segment_rank",
        F.concat("segment_label", F.lit(LABEL_SEPARATOR), "Treatment").alias("segment_label"),
        *segment_fields,
        "Treatment",
        "n__saved",
        "n__stopped",
        "total_users",
        F.expr("try_divide(n__saved, total_users)").alias("observed_saved_share"),
        "supported",
        *[f"median_{s}__{m}" for _, s in sides for m in metrics],
        *[f"delta__{m}" for m in metrics],
        scores.magnitude(list(named.values())).alias("contrast_magnitude"),
        scores.dominant(named).alias("dominant_metric"),
    )


def segment_details(
    df: DataFrame,
    contrasts: DataFrame,
    reference: DataFrame,
    metrics: Sequence[str] = METRICS,
    segment_fields: Sequence[str] = SEGMENT_FIELDS,
    top_n: int = TOP_CONTRASTS,
    bootstrap_iterations: int = 0,
    confidence_level: float = 0.95,
    seed: int = 42,
    counts: BinnedCounts | None = None,
) -> DataFrame:
    """Business-unit spread of the selected segments, one row per metric.

    Counts and medians come from the contrast row; quartiles of the clipped
    values and bootstrap intervals from the accounts.
    """
    tie_break = [f for f in segment_fields if f == "Treatment"]
    selected = top_segments(contrasts, top_n, *tie_break)
    cell = ["segment_rank", *tie_break]
    wanted = selected.select("segment_rank", *segment_fields)

    def in_segments(rows: DataFrame) -> DataFrame:
        return match_segments(rows.drop("segment_rank"), wanted, segment_fields).where(
            F.col("outcome").isin(*OUTCOMES)
        )

    if counts is None:
        counts = value_counts(in_segments(df), [*cell, "outcome"], metrics)
    else:
        counts = counts.map(in_segments)
    stats = _with_reference(
        order_statistics(counts, [*cell, "outcome", "metric"], {"p25": 0.25, "p75": 0.75}),
        reference,
    ).select(
        *cell,
        "metric",
        "outcome",
        "n",
        interpolate(F.col("p25"), _clipped).alias("q25"),
        interpolate(F.col("p75"), _clipped).alias("q75"),
    )
    sides = ((SAVED, "saved"), (STOPPED, "stopped"))
    wide = stats.groupBy(*cell, "metric").agg(
        *[
            F.expr(f"max(if(outcome = '{o}', {source}, null))").alias(f"{name}__{s}")
            for o, s in sides
            for source, name in (
                ("n", "non_null"), ("q25", "clipped_q25"), ("q75", "clipped_q75"),
            )
        ]
    )
    # One row per selected segment and metric, with the contrast row's own medians.
    entries = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"median_saved__{m}").alias("raw_saved"),
                F.col(f"median_stopped__{m}").alias("raw_stopped"),
            )
            for m in metrics
        ]
    )
    grid = _with_reference(
        selected.select(
            "segment_rank", "segment_label", *segment_fields, "n__saved", "n__stopped",
            F.inline(entries),
        ),
        reference,
    ).withColumns(
        {
            f"clipped_median__{s}": scores.clip(F.col(f"raw_{s}"), F.col("p01"), F.col("p99"))
            for _, s in sides
        }
    )
    full = null_safe_join(grid, wide, [*cell, "metric"], "left").fillna(
        0, ["non_null__saved", "non_null__stopped"]
    )
    if bootstrap_iterations > 0:
        intervals = median_difference_intervals(
            counts, cell, reference, bootstrap_iterations, confidence_level, seed
        )
        full = null_safe_join(full, intervals, [*cell, "metric"], "left")
    else:
        missing = F.lit(None).cast("double")
        full = full.withColumns({"ci_lower": missing, "ci_upper": missing})

    def side(s: str) -> list[Column]:
        return [
            F.col(f"n__{s}"),
            F.col(f"non_null__{s}"),
            F.col(f"clipped_median__{s}"),
            F.col(f"clipped_q25__{s}"),
            F.col(f"clipped_q75__{s}"),
            (F.col(f"clipped_q75__{s}") - F.col(f"clipped_q25__{s}")).alias(f"clipped_iqr__{s}"),
        ]

    return full.orderBy(*cell, "metric").select(
        "segment_rank",
        "segment_label",
        *segment_fields,
        "metric",
        *side("saved"),
        *side("stopped"),
        (F.col("clipped_median__saved") - F.col("clipped_median__stopped")).alias(
            "clipped_median_difference"
        ),
        F.col("ci_lower").alias("clipped_median_difference_ci_lower"),
        F.col("ci_upper").alias("clipped_median_difference_ci_upper"),
        F.lit(bootstrap_iterations).alias("bootstrap_iterations"),
        F.lit(confidence_level).alias("confidence_level"),
    )
