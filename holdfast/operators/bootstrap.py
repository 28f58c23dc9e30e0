"""Bootstrap intervals for a difference of independent medians.

Resampling n values with replacement and taking the median is the same as
resampling n sorted positions and taking the middle one. The middle of n uniform
draws has a Beta distribution, so a replicate needs one Beta draw per side instead
of n draws: the cost is the number of replicates, whatever the group size, and the
distribution of the interval is exactly that of full resampling.

Draws come from hashes of (seed, group, metric, side, replicate), so a retried
task repeats them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.labels import SAVED, STOPPED
from holdfast.functions.scores import clip
from holdfast.operators.quantiles import BinnedCounts, values_at_ranks

# A gamma proposal is rejected in under 5 % of cases, so the chance that none of
# these is accepted is below 1e-40; the query fails then rather than bend a draw.
PROPOSALS = 32


def uniform(digest: str, start: int) -> str:
    """SQL for a uniform in (0, 1) from eight hex digits of a hash."""
    digits = f"conv(substr({digest}, {start}, 8), 16, 10)"
    return f"((cast({digits} as double) + 0.5D) / 4294967296.0D)"


def gamma(shape: str, key: str) -> str:
    """SQL for a Gamma(shape, 1) draw, shape >= 1, by Marsaglia and Tsang's method.

    `key` is a string expression; proposal number `a` hashes it together with `a`.
    The one-element transforms only serve to compute a value once.
    """
    d = f"({shape} - 1.0D / 3.0D)"
    normal = f"sqrt(-2.0D * ln({uniform('h', 1)})) * cos(6.283185307179586D * {uniform('h', 9)})"
    drawn = (
        f"transform(array(md5(concat({key}, '|', a))),"
        f" h -> struct({normal} as z, {uniform('h', 17)} as u))"
    )
    cubed = (
        f"transform({drawn},"
        f" p -> struct(p.z as z, p.u as u, pow(1.0D + p.z / sqrt(9.0D * {d}), 3) as v))"
    )
    accept = (
        f"p.v > 0.0D and ln(p.u) < 0.5D * p.z * p.z + {d} - {d} * p.v + {d} * ln(p.v)"
    )
    proposal = f"transform({cubed}, p -> if({accept}, {d} * p.v, cast(null as double)))[0]"
    return (
        f"coalesce(aggregate(sequence(0, {PROPOSALS - 1}), cast(null as double),"
        f" (found, a) -> if(found is null, {proposal}, found)),"
        " cast(raise_error('no gamma proposal was accepted') as double))"
    )


def draw_median_ranks(groups: DataFrame, keys: Sequence[str], iterations: int, seed: int) -> DataFrame:
    """Sorted positions of the resampled median, two rows per replicate.

    With n odd the median is order statistic (n + 1) / 2 of the resample; with n
    even it is the mean of number n / 2 and the next one. That next one is the
    smallest of n / 2 draws above the first, which needs one more uniform.
    """
    named = ", ".join(f"coalesce(cast(`{k}` as string), '')" for k in keys)
    replicates = groups.select(
        *keys,
        "total",
        F.expr("cast(floor((total + 1) / 2) as double)").alias("half"),
        F.explode(F.sequence(F.lit(1), F.lit(iterations))).alias("replicate"),
    ).withColumn("key", F.expr(f"concat_ws('|', '{seed}', {named}, cast(replicate as string))"))
    drawn = replicates.withColumns(
        {
            "x": F.expr(gamma("half", "concat(key, '|x')")),
            "y": F.expr(gamma("(total - half + 1.0D)", "concat(key, '|y')")),
            "w": F.expr(uniform("md5(concat(key, '|w'))", 1)),
        }
    ).withColumn("first", F.expr("x / (x + y)"))
    following = F.expr("first + (1.0D - first) * (1.0D - pow(w, 1.0D / (total - half)))")
    second = F.when(F.expr("total % 2 = 1"), F.col("first")).otherwise(following)
    rank = "least(cast(floor(at * total) as bigint), total - 1)"
    return drawn.select(
        *keys, "total", "replicate", F.explode(F.array("first", second)).alias("at")
    ).select(*keys, "replicate", F.expr(rank).alias("rank"))


def median_difference_intervals(
    counts: DataFrame | BinnedCounts,
    cell: Sequence[str],
    reference: DataFrame,
    iterations: int = 2000,
    confidence_level: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """Percentile interval of median(Saved) - median(Stopped) per cell and metric.

    `counts` holds `cell`, `outcome`, `metric`, `value`, `n`. A cell with one side
    only gets no interval.
    """
    keys = [*cell, "outcome", "metric"]
    drawn = values_at_ranks(
        counts, keys, lambda groups: draw_median_ranks(groups, keys, iterations, seed)
    )
    values = drawn.join(F.broadcast(reference), "metric")
    clipped = clip(F.col("value"), F.col("p01"), F.col("p99"))
    # Clipping is monotone, so the clipped median is the mean of the clipped middle.
    replicates = values.groupBy(*cell, "metric", "replicate").agg(
        *[
            F.avg(F.when(F.col("outcome") == outcome, clipped)).alias(side)
            for outcome, side in ((SAVED, "saved"), (STOPPED, "stopped"))
        ]
    )
    tail = (1 - confidence_level) / 2
    # At most `iterations` values per group: the built-in percentile is bounded.
    return (
        replicates.where(F.col("saved").isNotNull() & F.col("stopped").isNotNull())
        .groupBy(*cell, "metric")
        .agg(F.percentile(F.col("saved") - F.col("stopped"), [tail, 1 - tail]).alias("ci"))
        .select(
            *cell, "metric", F.col("ci")[0].alias("ci_lower"), F.col("ci")[1].alias("ci_upper")
        )
    )
