"""Chart-ready tables: the computation behind the plots, not the plots (V1-V8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import scores
from holdfast.functions.keys import nan_to_null, null_safe_join
from holdfast.functions.labels import OUTCOMES, TREATMENTS, second_stage
from holdfast.operators.population import ACCOUNT, METRICS, SEGMENT_FIELDS
from holdfast.operators.profile import (
    clip_metrics,
    match_segments,
    reference_from_counts,
    score_metrics,
    top_segments,
)
from holdfast.operators.quantiles import interpolate, order_statistics, value_counts
from holdfast.sources.tables import stage

SCALES = ("original", "clipped", "standardized")
WHISKER_REACH = 1.5

# Stage names shown in the journey chart.
STAGE_NAMES = {
    "Three-Offer Cohort": "Three-Variant Test",
    "Two-Offer Cohort": "Two-Variant Test",
    "Called-In first": "Called-In Cancel Flow",
    "Online first": "Online Cancel Flow",
}


def three_scales(
    df: DataFrame, group: str, groups: Sequence[str], metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Long frame of original, clipped and standardised values of listed groups.

    The reference is refitted on exactly these rows. One value column per scale,
    so the frame has one row per row and metric.
    """
    rows = df.where(F.col(group).isin(*groups))
    counts = value_counts(rows, [], metrics)
    long = (
        rows.select(group, *[nan_to_null(m).alias(m) for m in metrics])
        .unpivot([group], list(metrics), "metric", "original")
        .where(F.col("original").isNotNull())
    )
    return _scaled(long, reference_from_counts(counts, metrics), "original").select(
        group, "metric", *SCALES
    )


def _scaled(long: DataFrame, reference: DataFrame, value: str) -> DataFrame:
    """All scales next to a long-form value; the reference has one row per metric."""
    clipped = scores.clip(F.col(value), F.col("p01"), F.col("p99"))
    return long.join(F.broadcast(reference), "metric").withColumns(
        {
            "original": F.col(value),
            "clipped": clipped,
            "standardized": (clipped - F.col("center")) / F.col("spread"),
        }
    )


def group_accounts(df: DataFrame, group: str, groups: Sequence[str]) -> DataFrame:
    return (
        df.where(F.col(group).isin(*groups))
        .groupBy(group)
        .agg(F.count_distinct(ACCOUNT).alias("accounts"))
    )


def box_statistics(
    df: DataFrame, group: str, groups: Sequence[str], metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Quartiles, whiskers and fliers per group, metric and scale.

    Works on counted values: every scale is a function of the original value, and
    a monotone one, so its quartiles follow from the original order statistics.
    """
    counts = value_counts(df.where(F.col(group).isin(*groups)), [group], metrics)
    # Staged: read for the scales of the values and of the quartiles.
    reference = stage(reference_from_counts(counts, metrics), "reference")
    keys = [group, "metric"]
    values = _scaled(counts, reference, "value")
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    stats = order_statistics(counts, [group, "metric"], quartiles).join(
        F.broadcast(reference), "metric"
    )
    transforms = {
        "original": lambda v: v,
        "clipped": lambda v: scores.clip(v, F.col("p01"), F.col("p99")),
        "standardized": lambda v: scores.robust_score(
            v, F.col("p01"), F.col("p99"), F.col("center"), F.col("spread")
        ),
    }
    # All scales in one pass over the values: a column each, spread out at the end.
    boxes = stats.select(
        *keys,
        *[interpolate(q, transforms[s]).alias(f"{q}_{s}") for s in SCALES for q in quartiles],
    )
    fences = boxes.withColumns(
        {
            f"{side}_{s}": F.col(f"{edge}_{s}")
            + sign * WHISKER_REACH * (F.col(f"q3_{s}") - F.col(f"q1_{s}"))
            for s in SCALES
            for side, edge, sign in (("low", "q1", -1), ("high", "q3", 1))
        }
    )
    shown = [f"{q}_{s}" for s in SCALES for q in quartiles]
    wide = (
        null_safe_join(values, fences, keys)
        .groupBy(*keys, *shown)
        .agg(
            F.sum("n").alias("n"),
            *[
                F.expr(rule.format(s=s)).alias(f"{name}_{s}")
                for s in SCALES
                for name, rule in {
                    "whisker_low": "least(min(if({s} >= low_{s}, {s}, null)), q1_{s})",
                    "whisker_high": "greatest(max(if({s} <= high_{s}, {s}, null)), q3_{s})",
                    "fliers": "sum(if({s} < low_{s} or {s} > high_{s}, n, 0))",
                }.items()
            ],
        )
    )
    columns = [*quartiles, "whisker_low", "whisker_high", "fliers"]
    by_scale = [
        F.struct(F.lit(s).alias("scale"), *[F.col(f"{c}_{s}").alias(c) for c in columns])
        for s in SCALES
    ]
    return wide.select(*keys, "n", F.inline(F.array(*by_scale))).select(
        *keys, "scale", "n", *columns
    )


def heatmap(
    table: DataFrame, kind: str, metrics: Sequence[str] = METRICS, max_rows: int = 30
) -> DataFrame:
    """Row label and metric cells of the first rows of profiles or contrasts."""
    if kind == "profile":
        order = [F.desc_nulls_last("profile_magnitude"), F.desc("users"), "segment_label"]
        label, prefix = "concat(segment_label, ' (n=', users, ')')", "score"
    else:
        order = ["segment_rank", "segment_label"]
        label = "concat(segment_rank, '. ', segment_label, ' (n=', n__saved, '/', n__stopped, ')')"
        prefix = "delta"
    return (
        table.orderBy(*order)
        .limit(max_rows)
        .select(F.expr(label).alias("row_label"), *[F.col(f"{prefix}__{m}").alias(m) for m in metrics])
    )


def _panel_rows(
    df: DataFrame, contrasts: DataFrame, segment_fields: Sequence[str], top_n: int
) -> tuple[DataFrame, list[str]]:
    """Rows of the selected panels. A treatment drill-down has one panel per rank,
    with the treatments its contrast rows name."""
    if "Treatment" not in segment_fields:
        selected = top_segments(contrasts, top_n).select("segment_rank", *segment_fields)
        return match_segments(df, selected, segment_fields), []
    ranks = contrasts.select("segment_rank").distinct().orderBy("segment_rank").limit(top_n)
    selected = contrasts.join(F.broadcast(ranks), "segment_rank", "left_semi").where(
        F.col("Treatment").isin(*TREATMENTS)
    ).select("segment_rank", *segment_fields)
    return match_segments(df, selected, segment_fields), ["Treatment"]


def contrast_panels(
    df: DataFrame,
    contrasts: DataFrame,
    reference: DataFrame,
    metrics: Sequence[str] = METRICS,
    segment_fields: Sequence[str] = SEGMENT_FIELDS,
    top_n: int = 8,
) -> DataFrame:
    """Long scores of the strongest contrasts, by outcome (and treatment)."""
    rows, extra = _panel_rows(df, contrasts, segment_fields, top_n)
    ids = ["segment_rank", "outcome", *extra]
    return score_metrics(rows, metrics, reference).select(*ids, *metrics).unpivot(
        ids, list(metrics), "metric", "score"
    )


def panel_accounts(
    df: DataFrame,
    contrasts: DataFrame,
    segment_fields: Sequence[str] = SEGMENT_FIELDS,
    top_n: int = 8,
) -> DataFrame:
    """Accounts per panel and outcome (and treatment)."""
    rows, extra = _panel_rows(df, contrasts, segment_fields, top_n)
    return (
        rows.where(F.col("outcome").isin(*OUTCOMES))
        .groupBy("segment_rank", *extra, "outcome")
        .agg(F.count_distinct(ACCOUNT).alias("accounts"))
    )


def clipped_panels(
    df: DataFrame,
    contrasts: DataFrame,
    reference: DataFrame,
    metrics: Sequence[str] = METRICS,
    segment_fields: Sequence[str] = SEGMENT_FIELDS,
    top_n: int = 8,
) -> DataFrame:
    """Clipped business-unit values of the selected segments, by outcome."""
    tie_break = [f for f in segment_fields if f == "Treatment"]
    selected = top_segments(contrasts, top_n, *tie_break).select("segment_rank", *segment_fields)
    ids = ["segment_rank", *tie_break, "outcome"]
    rows = match_segments(df, selected, segment_fields)
    return (
        clip_metrics(rows, metrics, reference)
        .select(*ids, *metrics)
        .unpivot(ids, list(metrics), "metric", "value")
        .where(F.col("value").isNotNull())
    )


# --- journey ----------------------------------------------------------------------


def journey_stages(outcomes: DataFrame) -> DataFrame:
    """Cohort, first and second contact stage per account row."""
    return outcomes.select(
        "cohort",
        F.col("contact_channel").alias("contact_channel_1st"),
        second_stage("contact_channel").alias("contact_channel_2nd"),
        ACCOUNT,
    )


def journey_links(
    stages: DataFrame,
    columns: Sequence[str] = ("cohort", "contact_channel_1st", "contact_channel_2nd"),
    names: Mapping[str, str] = STAGE_NAMES,
    aggregate: bool = False,
) -> DataFrame:
    """Accounts moving between consecutive stages.

    Self-links are dropped; a source without a display name becomes missing, a
    target keeps its own. Two stages may share a display name: their links stay
    separate unless `aggregate` is set.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"), F.col(a).alias("source"), F.col(b).alias("target")
            )
            for i, (a, b) in enumerate(zip(columns, columns[1:]))
        ]
    )
    raw = (
        stages.select(F.inline(pairs), ACCOUNT)
        .where(F.col("source") != F.col("target"))
        .groupBy("step", "source", "target")
        .agg(F.count_distinct(ACCOUNT).alias("value"))
    )
    display = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    links = raw.select(
        F.try_element_at(display, "source").alias("source"),
        F.coalesce(F.try_element_at(display, "target"), "target").alias("target"),
        "value",
    )
    if aggregate:
        links = links.groupBy("source", "target").agg(F.sum("value").alias("value"))
    return links


def journey_nodes(links: DataFrame) -> DataFrame:
    """Every stage name once, indexed from 0 in label order. Label-sized."""
    labels = (
        links.select(F.explode(F.array("source", "target")).alias("label"))
        .where(F.col("label").isNotNull())
        .distinct()
    )
    return labels.select(
        (F.row_number().over(Window.orderBy("label")) - 1).alias("node"), "label"
    )


def index_links(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links with the node index of both ends."""
    source = nodes.select(F.col("label").alias("source"), F.col("node").alias("source_idx"))
    target = nodes.select(F.col("label").alias("target"), F.col("node").alias("target_idx"))
    return links.join(source, "source", "left").join(target, "target", "left").select(
        "source", "target", "value", "source_idx", "target_idx"
    )
