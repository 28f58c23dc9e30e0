"""Data-quality measurements and contracts (Q1-Q7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEVIATION_THRESHOLD = 0.10


def is_missing(name: str, kind: str) -> Column:
    """NULL, or NaN where the type has it."""
    col = F.col(f"`{name}`")
    return col.isNull() | F.isnan(col) if kind in ("float", "double") else col.isNull()


def table_measures(df: DataFrame) -> DataFrame:
    """Row count and null percentage over all cells, in one pass; NaN is missing too."""
    nulls = " + ".join(
        f"count_if(`{c}` is null{f' or isnan(`{c}`)' if kind in ('float', 'double') else ''})"
        for c, kind in df.dtypes
    )
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.expr(f"coalesce(({nulls}) * 100.0D / nullif(count(1) * {len(df.columns)}, 0), 0.0D)").alias(
            "null_percentage"
        ),
    )


def history_baseline(history: DataFrame, sql_file: str) -> DataFrame:
    """Mean row count and null percentage of earlier runs of the same script."""
    return history.where(
        (F.col("sql_file") == sql_file) & F.col("row_count").isNotNull()
    ).agg(
        F.avg("row_count").alias("avg_row_count"),
        F.avg("null_percentage").alias("avg_null_percentage"),
    )


def within_deviation(
    current: Column | str, average: Column | str, threshold: float = DEVIATION_THRESHOLD
) -> Column:
    """False only when a non-zero baseline is missed by more than the threshold."""
    current = F.col(current) if isinstance(current, str) else current
    average = F.col(average) if isinstance(average, str) else average
    exceeded = F.abs(current - average) / F.nullif(average, F.lit(0.0)) > threshold
    return ~F.coalesce(exceeded, F.lit(False))


def assess(measures: DataFrame, baseline: DataFrame) -> DataFrame:
    """Both verdicts for one measured table; no history passes.

    The baseline is one row by construction and enters as a scalar subquery.
    """
    average = baseline.select(F.struct("avg_row_count", "avg_null_percentage")).scalar()
    return measures.withColumn("avg", average).select(
        "row_count",
        "null_percentage",
        within_deviation("row_count", F.col("avg.avg_row_count")).alias("row_count_passed"),
        within_deviation("null_percentage", F.col("avg.avg_null_percentage")).alias(
            "nulls_passed"
        ),
    )


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that are missing or occur more than once."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col(key).isNull() | (F.col("rows") > 1))
    )


def metric_coverage(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Rows of the population and non-missing values per metric."""
    entries = ", ".join(f"struct('{m}' as metric, count(nanvl(`{m}`, null)) as non_null)" for m in metrics)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"array({entries})").alias("m")
    ).select(F.inline("m"), "rows").select("metric", "rows", "non_null")


def require_valid_population(
    df: DataFrame, key: str, metrics: Sequence[str], whole: DataFrame | None = None
) -> None:
    """Raise when the population is empty, has a bad key or an empty metric.

    The key is checked over `whole`, of which `df` is the analysed part.
    """
    coverage = metric_coverage(df, metrics).collect()
    if coverage[0]["rows"] == 0:
        raise ValueError("The analysis population is empty.")
    if not key_violations(df if whole is None else whole, key).isEmpty():
        raise ValueError(f"{key} must be present and unique on every row.")
    empty = [row["metric"] for row in coverage if row["non_null"] == 0]
    if empty:
        raise ValueError(f"Metrics without any value: {empty}")
