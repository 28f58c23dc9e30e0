"""Distribution and segment summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.keys import null_safe_join
from holdfast.operators.population import ACCOUNT
from holdfast.operators.quantiles import (
    SUMMARY_PERCENTILES,
    interpolate,
    order_statistics,
    regroup_counts,
    value_counts,
)
from holdfast.sources.tables import stage

OUTLIER_REACH = 1.5


def distribution_summary(
    df: DataFrame, fields: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """One row per group and numeric field: quality, moments, percentiles, outliers."""
    return _summarize(value_counts(df, keys, fields, keep_missing=True), fields, keys)


def population_summaries(
    labelled: DataFrame,
    fields: Sequence[str],
    populations: Mapping[str, Column],
) -> DataFrame:
    """The same summary for several, possibly overlapping, populations.

    Values are counted once per set of memberships and spread over the
    populations afterwards, so the data is scanned and shuffled once.
    """
    names = F.array(*[F.when(rule, F.lit(name)) for name, rule in populations.items()])
    tagged = labelled.withColumn("memberships", F.array_compact(names)).where(
        F.size("memberships") > 0
    )
    spread = value_counts(tagged, ["memberships"], fields, keep_missing=True).select(
        F.explode("memberships").alias("population"), "metric", "value", "n"
    )
    # Staged: the explode above would otherwise run once per use.
    counts = stage(regroup_counts(spread, ["population"]), "value_counts")
    return _summarize(counts, fields, ["population"])


def _summarize(all_counts: DataFrame, fields: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Summary of counted values, the missing ones included."""
    group = [*keys, "metric"]
    counts = all_counts.where(F.col("value").isNotNull())
    basics = all_counts.groupBy(*group).agg(
        F.sum("n").alias("row_count"),
        F.expr("sum(if(value = 0, n, 0))").alias("zero_count"),
        F.expr("sum(if(value < 0, n, 0))").alias("negative_count"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.expr("try_divide(sum(value * n), sum(if(value is null, 0, n)))").alias("mean"),
    )
    if not keys:
        # An empty frame still reports every field.
        listed = all_counts.sparkSession.createDataFrame([(f,) for f in fields], "metric string")
        basics = F.broadcast(listed).join(basics, "metric", "left").fillna(
            0, ["row_count", "zero_count", "negative_count"]
        )
    quantiles = order_statistics(counts, group, SUMMARY_PERCENTILES).select(
        *group,
        F.col("n").alias("non_null_count"),
        *[interpolate(p).alias(p) for p in SUMMARY_PERCENTILES],
    )
    # Staged: read for the fences and for the result. One row per group and field.
    fenced = stage(
        null_safe_join(basics, quantiles, group, "left")
        .fillna(0, ["non_null_count"])
        .withColumn("iqr", F.col("p75") - F.col("p25"))
        .withColumns(
            {
                "lower_bound": F.col("p25") - OUTLIER_REACH * F.col("iqr"),
                "upper_bound": F.col("p75") + OUTLIER_REACH * F.col("iqr"),
            }
        ),
        "fenced",
    )
    # Second pass over the counted values: squared deviations about the known mean
    # and values outside the fences.
    spread = (
        null_safe_join(counts, fenced.select(*group, "mean", "lower_bound", "upper_bound"), group)
        .groupBy(*group)
        .agg(
            F.expr("sum((value - mean) * (value - mean) * n)").alias("squares"),
            F.expr("sum(if(value < lower_bound or value > upper_bound, n, 0))").alias(
                "outlier_count"
            ),
        )
    )
    full = null_safe_join(fenced, spread, group, "left").fillna(0, ["outlier_count"])
    return full.select(
        *keys,
        F.col("metric").alias("field"),
        "row_count",
        "non_null_count",
        (F.col("row_count") - F.col("non_null_count")).alias("null_count"),
        F.expr("try_divide((row_count - non_null_count) * 100.0D, row_count)").alias("null_pct"),
        "zero_count",
        "negative_count",
        "min",
        "max",
        "mean",
        F.col("p50").alias("median"),
        F.expr("if(non_null_count > 1, sqrt(squares / (non_null_count - 1)), null)").alias("std"),
        *SUMMARY_PERCENTILES,
        "iqr",
        "lower_bound",
        "upper_bound",
        "outlier_count",
        F.expr("try_divide(outlier_count * 100.0D, non_null_count)").alias("outlier_pct"),
    )


def segment_summary(
    df: DataFrame, segment: str, metrics: Sequence[str], id_col: str = ACCOUNT
) -> DataFrame:
    """Accounts, mean, median and p90 per segment value; missing is a segment."""
    return segment_summaries(df, [segment], metrics, id_col).select(
        F.col("segment_value").alias(segment),
        *[c for c in segment_summary_columns(metrics) if c not in ("segment_field", "segment_value")],
    )


def segment_summary_columns(metrics: Sequence[str]) -> list[str]:
    stats = [f"{stat}_{m}" for m in metrics for stat in ("avg", "median", "p90")]
    return ["segment_field", "segment_value", "users", *stats]


def segment_summaries(
    df: DataFrame, segments: Sequence[str], metrics: Sequence[str], id_col: str = ACCOUNT
) -> DataFrame:
    """Segment summaries for several fields, stacked.

    Values are counted per combination of all fields first; only those counts,
    not the rows, are repeated once per field.
    """
    keys = ["segment_field", "segment_value"]
    fields = ", ".join(f"struct('{s}' as segment_field, cast(`{s}` as string) as segment_value)" for s in segments)
    spread = F.inline(F.expr(f"array({fields})"))
    # One row per account with the few values it has in each field; the count after
    # that needs no second DISTINCT and combines map-side.
    values = [F.collect_set(F.struct(F.col(s).cast("string").alias("v"))).alias(s) for s in segments]
    spread_users = F.array(*[F.struct(F.lit(s).alias("segment_field"), F.col(s).alias("values")) for s in segments])
    users = (
        df.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg(*values)
        .select(F.inline(spread_users))
        .select("segment_field", F.explode("values").alias("value"))
        .groupBy("segment_field", F.col("value.v").alias("segment_value"))
        .agg(F.count(F.lit(1)).alias("users"))
    )
    repeated = value_counts(df, segments, metrics).select(spread, "metric", "value", "n")
    counts = stage(regroup_counts(repeated, keys), "value_counts")
    means = counts.groupBy(*keys, "metric").agg(F.expr("sum(value * n) / sum(n)").alias("avg"))
    quantiles = order_statistics(counts, [*keys, "metric"], {"median": 0.5, "p90": 0.9}).select(
        *keys, "metric", *[interpolate(q).alias(q) for q in ("median", "p90")]
    )
    wide = (
        null_safe_join(means, quantiles, [*keys, "metric"])
        .groupBy(*keys)
        .agg(
            *[
                F.expr(f"max(if(metric = '{m}', {stat}, null))").alias(f"{stat}_{m}")
                for m in metrics
                for stat in ("avg", "median", "p90")
            ]
        )
    )
    return (
        null_safe_join(users, wide, keys, "left")
        .select(*segment_summary_columns(metrics))
        .orderBy("segment_field", F.desc("users"), "segment_value")
    )
