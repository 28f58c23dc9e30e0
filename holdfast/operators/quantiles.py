"""Exact order statistics that never hold a group in one task.

Spark's built-in `percentile` keeps every distinct value of a group in one
executor's memory. Here values are first counted per (group, value), which
combines map-side and spreads a hot group over all tasks. Approximate percentiles
of a group's distinct values cut it into bins of about equal size, wherever its
values lie; bin totals say at which rank each bin starts, and only the bins that
hold a wanted rank are sorted. The cuts decide the work per task, not the result.

Analyses that group the same values in several ways bin them once (:class:`BinnedCounts`): bins common
to all groups are ascending within each of them, so every grouping takes its ranks from the bins' totals
and reads the values once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.keys import nan_to_null, null_safe_join
from holdfast.sources.tables import stage

# Bins of a group; no bin holds much more than this share of its distinct values.
BINS = 64
STEP = 8

# The percentiles of a distribution summary.
SUMMARY_PERCENTILES = {
    "p01": 0.01,
    "p05": 0.05,
    "p10": 0.10,
    "p25": 0.25,
    "p50": 0.50,
    "p75": 0.75,
    "p90": 0.90,
    "p95": 0.95,
    "p99": 0.99,
}


def melt(
    df: DataFrame, ids: Sequence[str], metrics: Sequence[str], keep_missing: bool = False
) -> DataFrame:
    """One row per (row, metric) with a double `value`, missing ones left out."""
    picked = df.select(*ids, *[nan_to_null(m).alias(m) for m in metrics])
    long = picked.unpivot(list(ids), list(metrics), "metric", "value")
    return long if keep_missing else long.where(F.col("value").isNotNull())


def value_counts(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], keep_missing: bool = False
) -> DataFrame:
    """Rows per (keys, metric, value): the compressed form all quantiles start from.

    Staged, because rank lookups read it twice and Spark does not reuse a shuffle
    above an unpivot; the source itself is then scanned once.
    """
    counts = (
        melt(df, keys, metrics, keep_missing)
        .groupBy(*keys, "metric", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return stage(counts, "value_counts")


@dataclass(frozen=True)
class BinnedCounts:
    """Counts of a fine grouping whose bins are those of the metric, shared by all groups.

    `counts` has a row per (keys, metric, value) with `n` and `bin`; `totals` sums `n` per
    (keys, metric, bin). Coarser groupings name fewer keys; nothing is regrouped before its ranks are known.
    """

    counts: DataFrame
    totals: DataFrame

    def map(self, change: Callable[[DataFrame], DataFrame]) -> BinnedCounts:
        """The same filter or join on keys for both tables."""
        return BinnedCounts(change(self.counts), change(self.totals))


def binned_counts(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> BinnedCounts:
    """Value counts per `keys`, binned by metric once for all groupings of them."""
    placed = stage(_placed(value_counts(df, keys, metrics), ["metric"]), "binned")
    totals = placed.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))
    return BinnedCounts(placed, stage(totals, "bin_totals"))


def regroup_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of a coarser grouping, from counts of a finer one."""
    return counts.groupBy(*keys, "metric", "value").agg(F.sum("n").alias("n"))


def with_bins(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds `bin`, ascending with the value within a group."""
    return _placed(counts, keys).select(*keys, "value", "n", "bin")


def _placed(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of `counts` with the `bin` of their value within the group of `keys`.

    The cuts are approximate percentiles of the distinct values: a sketch of fixed
    size per group that combines map-side.
    """
    shares = [i / BINS for i in range(1, BINS)]
    cuts = counts.groupBy(*keys).agg(
        F.percentile_approx("value", shares, 20 * BINS).alias("cuts")
    )
    # Every STEP-th cut first, then those between two of them: a value meets few of the cuts.
    coarse = F.expr(f"filter(cuts, (c, i) -> i % {STEP} = {STEP - 1})")
    # Staged, its size is known (a row a group): a few groups are broadcast, and the counts stay where they are.
    cuts = stage(cuts.select(*keys, "cuts", coarse.alias("coarse")), "cuts")
    placed = null_safe_join(counts, cuts, keys).withColumn(
        "above", F.expr(f"{STEP} * size(filter(coarse, c -> c < value))")
    )
    within = F.expr(f"size(filter(slice(cuts, above + 1, {STEP - 1}), c -> c < value))")
    return placed.select(*counts.columns, (F.col("above") + within).alias("bin"))


def _binned(counts: DataFrame | BinnedCounts, keys: Sequence[str]) -> BinnedCounts:
    """Counts and totals with bins, for `keys` or any finer grouping."""
    if isinstance(counts, BinnedCounts):
        return counts
    binned = with_bins(counts, keys)
    return BinnedCounts(binned, binned)


def _bin_starts(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rank at which each bin of a group starts, with the group's total."""
    totals = totals.groupBy(*keys, "bin").agg(F.sum("n").alias("bin_n"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return totals.select(
        *keys,
        "bin",
        "bin_n",
        (F.sum("bin_n").over(upto) - F.col("bin_n")).alias("bin_start"),
        F.sum("bin_n").over(group).alias("total"),
    )


def _stops(binned: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values of the target bins with the rank at which each one's run ends.

    `targets` holds `keys`, `bin` and `bin_start`; its other columns stay. A value that has several rows,
    of finer groups, is summed up in the target bins only: there rows are few.
    """
    place = [*keys, "bin"]
    wanted = null_safe_join(binned, targets.select(*place), place, "left_semi")
    summed = wanted.groupBy(*place, "value").agg(F.sum("n").alias("n"))
    upto = (
        Window.partitionBy(*keys, "bin")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return null_safe_join(summed, targets, place).withColumn(
        "stop", F.col("bin_start") + F.sum("n").over(upto)
    )


def order_statistics(
    counts: DataFrame | BinnedCounts, keys: Sequence[str], probabilities: Mapping[str, float]
) -> DataFrame:
    """Neighbouring order statistics per group for each probability.

    Returns `keys`, `n` and one struct `(lo, hi, frac)` per probability; see
    :func:`interpolate` for turning a struct into a linear quantile.
    """
    probs = ", ".join(f"{float(p)!r}D" for p in probabilities.values())
    ranks = f"""flatten(transform(array({probs}), (p, i) -> array(
        named_struct('rank', cast(floor(p * (total - 1)) as bigint), 'slot', 2 * i, 'total', total),
        named_struct('rank', cast(ceil(p * (total - 1)) as bigint), 'slot', 2 * i + 1, 'total', total)
    )))"""
    in_bin = "w -> w.rank >= bin_start and w.rank < bin_start + bin_n"
    binned = _binned(counts, keys)
    targets = (
        _bin_starts(binned.totals, keys)
        .select(*keys, "bin", "bin_start", F.expr(f"filter({ranks}, {in_bin})").alias("wanted"))
        .where("size(wanted) > 0")
    )
    targets = stage(targets, "targets")  # a few rows a group: its known size lets the counts stay where they are
    # Two entries per probability, so the per-group map has a fixed size.
    hits = F.expr("filter(wanted, w -> w.rank >= stop - n and w.rank < stop)")
    ranked = _stops(binned.counts, targets, keys).select(*keys, "value", F.explode(hits).alias("w"))
    picked = ranked.select(*keys, "w.*", "value").groupBy(*keys).agg(
        F.max("total").alias("n"),
        F.expr("map_from_entries(collect_list(struct(slot, value)))").alias("at"),
    )
    return picked.select(
        *keys,
        "n",
        *[
            F.expr(
                f"named_struct('lo', at[{2 * i}], 'hi', at[{2 * i + 1}],"
                f" 'frac', {float(p)!r}D * (n - 1) - floor({float(p)!r}D * (n - 1)))"
            ).alias(name)
            for i, (name, p) in enumerate(probabilities.items())
        ],
    )


def values_at_ranks(
    counts: DataFrame | BinnedCounts, keys: Sequence[str], draw: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Values at many ranks per group, for callers that draw ranks.

    `draw` turns groups (`keys`, `total`) into rows with `keys`, a 0-based `rank`
    and payload columns; a fixed number per group. Returns those rows with `value`.
    """
    binned = _binned(counts, keys)
    bins = _bin_starts(binned.totals, keys)
    ranks = draw(bins.where(F.col("bin_start") == 0).select(*keys, "total"))
    payload = [c for c in ranks.columns if c not in keys]
    wanted = ranks.select(*keys, F.col("rank").alias("pos"), F.struct(*payload).alias("w"))
    # Locate each rank's bin as-of: bin starts and ranks share one sorted pass.
    events = bins.select(
        *keys,
        F.col("bin_start").alias("pos"),
        F.struct("bin", "bin_start").alias("at"),
    ).unionByName(wanted, allowMissingColumns=True)
    upto = (
        Window.partitionBy(*keys)
        .orderBy("pos", F.col("w").isNotNull())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    located = (
        events.withColumn("at", F.last("at", ignorenulls=True).over(upto))
        .where(F.col("w").isNotNull())
        .select(*keys, F.col("at.bin").alias("bin"), F.col("at.bin_start").alias("bin_start"), "pos", "w")
    )
    # Staged: read twice, a fixed number of rows a group; the few bins are broadcast by their known size.
    located = stage(located, "located")
    targets = stage(located.select(*keys, "bin", "bin_start").distinct(), "targets")
    # Then its value, alike: downwards, the last run end above a rank is its value's.
    runs = _stops(binned.counts, targets, keys).select(
        *keys, "bin", F.col("stop").alias("pos"), F.struct("value").alias("v")
    )
    merged = runs.unionByName(located.drop("bin_start"), allowMissingColumns=True)
    down = (
        Window.partitionBy(*keys, "bin")
        .orderBy(F.desc("pos"), F.col("v").isNotNull())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        merged.withColumn("v", F.last("v", ignorenulls=True).over(down))
        .where(F.col("w").isNotNull())
        .select(*keys, "w.*", "v.value")
    )


def interpolate(
    stat: Column | str, transform: Callable[[Column], Column] = lambda v: v
) -> Column:
    """Linear quantile from neighbouring order statistics.

    A monotone `transform` (clipping, scaling) may be applied to the order
    statistics: the result equals the quantile of the transformed values.
    """
    stat = F.col(stat) if isinstance(stat, str) else stat
    lo, hi = transform(stat["lo"]), transform(stat["hi"])
    return lo + (hi - lo) * stat["frac"]
