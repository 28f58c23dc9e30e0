import numpy as np
import pytest

from holdfast.operators import bootstrap, profile, quantiles
from holdfast.sources.tables import stage


def intervals(spark, saved, stopped, iterations=400, seed=42):
    rows = [("k", "Saved", float(v)) for v in saved] + [("k", "Stopped", float(v)) for v in stopped]
    df = spark.createDataFrame(rows, "cell string, outcome string, m double")
    wide = spark.createDataFrame([("m", -1e18, 0.0, 1.0, 1e18)], "metric string, p01 double, center double, spread double, p99 double")
    counts = quantiles.value_counts(df, ["cell", "outcome"], ["m"])
    rows = bootstrap.median_difference_intervals(counts, ["cell"], wide, iterations, 0.95, seed)
    return [(r["ci_lower"], r["ci_upper"]) for r in rows.collect()]


@pytest.mark.parametrize("n_saved,n_stopped", [(31, 40), (200, 7), (1, 2)])
def test_interval_agrees_with_full_resampling(spark, n_saved, n_stopped):
    rng = np.random.default_rng(n_saved)
    saved, stopped = rng.normal(10, 3, n_saved), rng.normal(7, 2, n_stopped)
    draws = np.median(rng.choice(saved, (20000, n_saved)), axis=1) - np.median(
        rng.choice(stopped, (20000, n_stopped)), axis=1
    )
    expected = np.quantile(draws, [0.025, 0.975])
    ((low, high),) = intervals(spark, saved, stopped, 2000)
    width = max(expected[1] - expected[0], 1e-9)
    assert abs(low - expected[0]) < 0.12 * width
    assert abs(high - expected[1]) < 0.12 * width


def test_draws_repeat_for_a_seed_and_change_with_it(spark):
    rng = np.random.default_rng(0)
    saved, stopped = rng.normal(0, 1, 50), rng.normal(0, 1, 50)
    first = intervals(spark, saved, stopped)
    assert intervals(spark, saved, stopped) == first
    assert intervals(spark, saved, stopped, seed=7) != first


def test_one_sided_cell_has_no_interval(spark):
    assert intervals(spark, [1.0, 2.0], []) == []


def test_drawn_positions_follow_the_resampled_median(spark):
    n = 11
    groups = spark.createDataFrame([("g", n)], "k string, total bigint")
    drawn = bootstrap.draw_median_ranks(groups, ["k"], 4000, 1).collect()
    assert len(drawn) == 8000  # both halves of an odd group fall on one position
    by_replicate = {}
    for r in drawn:
        by_replicate.setdefault(r["replicate"], set()).add(r["rank"])
    ranks = np.array([next(iter(s)) for s in by_replicate.values()])
    assert all(len(s) == 1 for s in by_replicate.values())
    rng = np.random.default_rng(3)
    brute = np.median(rng.integers(0, n, (200000, n)), axis=1)
    got, expected = (np.bincount(x.astype(int), minlength=n) / len(x) for x in (ranks, brute))
    assert np.abs(got - expected).max() < 0.03


def test_clipping_applies_to_the_interval(spark, accounts):
    reference = stage(profile.fit_reference(accounts, ["frequency"]))
    counts = quantiles.value_counts(accounts, ["cohort", "outcome"], ["frequency"])
    row = bootstrap.median_difference_intervals(counts, ["cohort"], reference, 100).first()
    bounds = reference.first()
    assert row["ci_upper"] <= bounds["p99"] - bounds["p01"]
