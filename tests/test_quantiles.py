import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import profile
from holdfast.operators import quantiles as q
from holdfast.sources import tables


def fixture(spark):
    """Groups of very different shape; one holds most rows, one key is missing."""
    rng = np.random.default_rng(1)
    data = {
        "hot": np.round(rng.lognormal(8, 2, 6000), 2),
        "ints": rng.integers(-20, 20, 500).astype(float),
        "one": np.array([7.25]),
        "same": np.full(300, 3.0),
        "offset": 1e9 + rng.integers(0, 50, 400).astype(float),
        "tiny": rng.uniform(-1e-9, 1e-9, 200),
        None: rng.normal(0, 1e6, 301),
    }
    rows = [(k, float(v)) for k, values in data.items() for v in values]
    rows += [("hot", None), ("ints", float("nan"))]
    return data, spark.createDataFrame(rows, "g string, m double")


def test_order_statistics_equal_linear_quantiles(spark):
    data, df = fixture(spark)
    counts = q.value_counts(df, ["g"], ["m"])
    stats = q.order_statistics(counts, ["g", "metric"], q.SUMMARY_PERCENTILES).select(
        "g", "n", *[q.interpolate(p).alias(p) for p in q.SUMMARY_PERCENTILES]
    )
    got = {r["g"]: r for r in stats.collect()}
    assert set(got) == set(data)
    for key, values in data.items():
        assert got[key]["n"] == len(values)
        for name, p in q.SUMMARY_PERCENTILES.items():
            assert got[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-15)


def test_transform_before_interpolation_equals_quantile_of_transformed(spark):
    data, df = fixture(spark)
    counts = q.value_counts(df, ["g"], ["m"])
    clipped = q.interpolate("p50", lambda v: F.least(v, F.lit(2.0)))
    stats = q.order_statistics(counts, ["g", "metric"], {"p50": 0.5}).select("g", clipped.alias("p"))
    for row in stats.collect():
        expected = np.median(np.minimum(data[row["g"]], 2.0))
        assert row["p"] == pytest.approx(expected, abs=1e-12)


def test_values_at_ranks_returns_every_rank(spark):
    values = [5.0, 1.0, 1.0, 3.0, 300.0, -2.0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, m double")

    def every_rank(groups):
        return groups.select(
            "g", "metric", F.explode(F.sequence(F.lit(0), F.col("total") - 1)).alias("rank"),
            F.lit("x").alias("tag"),
        )

    got = q.values_at_ranks(q.value_counts(df, ["g"], ["m"]), ["g", "metric"], every_rank)
    pairs = sorted((r["rank"], r["value"]) for r in got.collect())
    assert pairs == list(enumerate(sorted(values)))


@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(0).normal(0, 1e5, 4000),
        np.random.default_rng(1).uniform(0, 0.0039, 4000),  # rates
        1_001_000 + np.random.default_rng(2).uniform(0, 3000, 4000),  # narrow, far from 0
        np.concatenate([np.full(5000, 7.0), np.arange(4000.0)]),  # one value repeated
        np.concatenate([-np.geomspace(1e-300, 1e300, 2000), np.geomspace(1e-300, 1e300, 2000), [np.inf, -np.inf, 0.0]]),
    ],
    ids=["wide", "rates", "narrow", "repeated", "extreme"],
)
def test_bins_follow_the_data(spark, values):
    """Ascending with the value, and none holds more than a few times its share."""
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, m double")
    binned = q.with_bins(q.value_counts(df, ["g"], ["m"]), ["g", "metric"]).orderBy("value").collect()
    bins = [r["bin"] for r in binned]
    assert bins == sorted(bins) and len(binned) == len(set(values))
    assert max(bins.count(b) for b in set(bins)) <= 3 * len(binned) / q.BINS


def test_many_draws_in_a_narrow_group_stay_in_small_partitions(spark):
    """Neither the values nor the draws of a group meet in one window partition."""
    values = [0.5 + 1e-7 * i for i in range(20_000)]
    counts = q.value_counts(spark.createDataFrame([("g", v) for v in values], "g string, m double"), ["g"], ["m"])
    keys = ["g", "metric"]

    def draw(groups):
        every = F.explode(F.sequence(F.lit(0), F.lit(1999)))
        return groups.select(*keys, every.alias("i")).select(*keys, (F.col("i") * 7919 % 20_000).cast("long").alias("rank"))

    got = {r["rank"]: r["value"] for r in q.values_at_ranks(counts, keys, draw).collect()}
    assert got == {i * 7919 % 20_000: values[i * 7919 % 20_000] for i in range(2000)}
    sizes = q.with_bins(counts, keys).groupBy("bin").count().collect()
    assert max(r["count"] for r in sizes) <= 3 * 20_000 / q.BINS


def test_ranks_are_found_without_sorting_whole_groups(spark):
    """The value sort is partitioned by bin, not by group."""
    _, df = fixture(spark)
    plan = q.order_statistics(q.value_counts(df, ["g"], ["m"]), ["g", "metric"], {"p50": 0.5})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "value#" in text and "bin#" in text
    windows = [line for line in text.splitlines() if "Window [sum(n#" in line]
    assert windows and all("bin#" in line.split("windowspecdefinition(")[1] for line in windows)


def _value_scans(df):
    """Scans of the plan that read values."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation [" in line and "value#" in line for line in plan.splitlines())


def test_every_grouping_takes_its_ranks_from_bins_made_once(spark, monkeypatch):
    """Binned once, coarser groupings fit no cuts and read the values a single time."""
    rng = np.random.default_rng(4)
    rows = [(g, t, float(v)) for g in ("a", "b", None) for t in ("x", "y") for v in rng.integers(0, 300, 400) - 0.5]
    rows += [("a", "x", 0.0), ("a", "y", -0.0), ("a", "x", None), ("b", "y", float("nan")), ("only", "x", 7.0)]
    df = spark.createDataFrame(rows, "g string, t string, m double")
    fine = q.binned_counts(df, ["g", "t"], ["m"])
    staged = []

    def stage(df, name="stage"):
        staged.append((name, _value_scans(df)))
        return tables.stage(df, name)

    monkeypatch.setattr(q, "stage", stage)
    for keys in ([], ["g"], ["g", "t"]):
        stats = q.order_statistics(fine, [*keys, "metric"], q.SUMMARY_PERCENTILES).select(
            *keys, "n", *[q.interpolate(p).alias(p) for p in q.SUMMARY_PERCENTILES]
        )
        assert _value_scans(stats) == 1
        assert staged.pop() == ("targets", 0) and not staged
        got = {tuple(r[k] for k in keys): r for r in stats.collect()}
        data = {}
        for g, t, v in rows:
            if v is not None and not np.isnan(v):
                data.setdefault(tuple({"g": g, "t": t}[k] for k in keys), []).append(v)
        assert set(got) == set(data)
        for key, values in data.items():
            assert got[key]["n"] == len(values)
            for name, p in q.SUMMARY_PERCENTILES.items():
                assert got[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-15)


def test_values_at_ranks_sums_the_rows_of_finer_groups(spark):
    values = {"x": [3.0, 1.0, 3.0, 8.0], "y": [3.0, -2.0, 8.0]}
    df = spark.createDataFrame([(t, v) for t, own in values.items() for v in own], "t string, m double")

    def every_rank(groups):
        return groups.select("metric", F.explode(F.sequence(F.lit(0), F.col("total") - 1)).alias("rank"))

    got = q.values_at_ranks(q.binned_counts(df, ["t"], ["m"]), ["metric"], every_rank)
    assert sorted((r["rank"], r["value"]) for r in got.collect()) == list(enumerate(sorted(sum(values.values(), []))))


def test_steps_of_the_analysis_bin_the_population_once(accounts, monkeypatch):
    """Reference, profiles, treatments and details read one set of bins (F1, F2)."""
    metrics = ["frequency", "breadth", "tenure", "tt_cost"]
    made = []

    def stage(df, name="stage"):
        made.append(name)
        return tables.stage(df, name)

    monkeypatch.setattr(q, "stage", stage)
    counts = profile.population_counts(accounts, metrics)
    reference = tables.stage(profile.reference_from_counts(counts, metrics))
    profiles = profile.behavior_profiles(accounts, reference, metrics, min_n=1, counts=counts)
    contrasts = tables.stage(profile.outcome_contrasts(profiles, metrics))
    treatments = tables.stage(profile.treatment_contrasts(accounts, contrasts, reference, metrics, min_n=1, counts=counts))
    fields = [*profile.SEGMENT_FIELDS, "Treatment"]
    steps = {"top_n": 30, "bootstrap_iterations": 20}
    details = profile.segment_details(accounts, treatments, reference, metrics, fields, counts=counts, **steps).collect()
    assert made.count("cuts") == 1 and made.count("value_counts") == 1
    alone = profile.segment_details(accounts, treatments, reference, metrics, fields, **steps).collect()
    assert details == alone and len(details) > 0
