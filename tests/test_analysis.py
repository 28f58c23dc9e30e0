import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import CELLS, COLUMNS, METRICS, SEGMENTS, account_rows
from holdfast.operators import charts, distribution, population, profile
from holdfast.plans import analysis
from holdfast.sources.tables import stage

MIN_USERS = 6


@pytest.fixture(scope="module")
def reference(accounts):
    return stage(profile.fit_reference(accounts, METRICS))


@pytest.fixture(scope="module")
def profiles(accounts, reference):
    keys = ["outcome", *SEGMENTS]
    return stage(profile.behavior_profiles(accounts, reference, METRICS, keys, min_n=MIN_USERS))


@pytest.fixture(scope="module")
def contrasts(profiles):
    return stage(profile.outcome_contrasts(profiles, METRICS, SEGMENTS))


def values(metric, outcome=None, segment=None):
    """Values of the fixture, without missing ones."""
    rows = [dict(zip(COLUMNS, r, strict=True)) for r in account_rows()]
    picked = [
        r[metric]
        for r in rows
        if outcome in (None, r["outcome"]) and (segment is None or tuple(r[s] for s in SEGMENTS) == segment)
    ]
    return np.array([v for v in picked if v is not None])


def bounds(metric):
    """Clip bounds, centre and spread by hand."""
    v = values(metric)
    low, q1, mid, q3, high = np.quantile(v, [0.01, 0.25, 0.5, 0.75, 0.99])
    return low, mid, (q3 - q1) or (high - low) or 1.0, high


def score(metric, v):
    low, mid, spread, high = bounds(metric)
    return (np.clip(v, low, high) - mid) / spread


MATCHED = [segment for segment, saved, stopped in CELLS if min(saved, stopped) >= MIN_USERS]


def test_distribution_summary_equals_numpy(accounts):
    got = {(r["outcome"], r["field"]): r for r in distribution.distribution_summary(accounts, METRICS, ["outcome"]).collect()}
    assert len(got) == 2 * len(METRICS)
    for (outcome, metric), row in got.items():
        v = values(metric, outcome)
        users = sum(c[1 if outcome == "Saved" else 2] for c in CELLS)
        assert (row["row_count"], row["non_null_count"]) == (users, len(v))
        assert row["null_pct"] == pytest.approx(100 * (users - len(v)) / users)
        assert (row["zero_count"], row["negative_count"]) == ((v == 0).sum(), (v < 0).sum())
        assert (row["min"], row["max"]) == (v.min(), v.max())
        assert row["mean"] == pytest.approx(v.mean()) and row["std"] == pytest.approx(v.std(ddof=1))
        q1, q3 = np.quantile(v, [0.25, 0.75])
        assert row["iqr"] == pytest.approx(q3 - q1) and row["p10"] == pytest.approx(np.quantile(v, 0.1))
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert row["outlier_count"] == ((v < low) | (v > high)).sum()


def test_distribution_summary_of_nothing(spark):
    none = spark.createDataFrame([(None,), (float("nan"),), (None,)], "m double")
    row = distribution.distribution_summary(none, ["m"]).first()
    assert (row["row_count"], row["null_count"], row["null_pct"], row["p50"], row["outlier_pct"]) == (3, 3, 100.0, None, None)
    row = distribution.distribution_summary(none.limit(0), ["m"]).first()
    assert (row["field"], row["row_count"], row["null_pct"]) == ("m", 0, None)


def test_segment_summary_counts_an_account_once_a_value(accounts):
    """Repeated rows count once; an account in two tiers counts in both."""
    moved = accounts.where("billing_account = 'web-1-Sa-0'").withColumn("src_risk_tier", F.lit("1. Low"))
    rows = accounts.unionByName(accounts).unionByName(moved)
    users = {r["src_risk_tier"]: r["users"] for r in distribution.segment_summary(rows, "src_risk_tier", METRICS).collect()}
    assert users == {None: 23, "2. Medium": 29, "1. Low": 6, "3. High": 14}
    got = {r["src_risk_tier"]: r for r in distribution.segment_summary(accounts, "src_risk_tier", METRICS).collect()}
    tier = values("tt_cost", segment=CELLS[1][0])
    assert got["2. Medium"]["avg_tt_cost"] == pytest.approx(tier.mean())
    assert got["2. Medium"]["p90_tt_cost"] == pytest.approx(np.quantile(tier, 0.9))


def test_reference_equals_numpy(reference):
    for row in reference.collect():
        assert (row["p01"], row["center"], row["spread"], row["p99"]) == pytest.approx(bounds(row["metric"]))
    assert {r["metric"]: r["spread"] for r in reference.collect()}["flat"] == 1.0


def test_scores_are_finite_and_centred(accounts, reference):
    scored = profile.score_metrics(accounts, METRICS, reference).select(*METRICS).collect()
    for metric in METRICS:
        got = sorted(r[metric] for r in scored if r[metric] is not None)
        assert got == pytest.approx(sorted(score(metric, values(metric)))) and all(map(math.isfinite, got))


def test_reference_of_metric_without_values(spark):
    df = spark.createDataFrame([(None, 4.0), (None, 6.0)], "empty double, full double")
    row = profile.fit_reference(df, ["empty", "full"]).where("metric = 'empty'").first()
    assert tuple(row) == ("empty", None, None, 1.0, None)


def test_profiles_and_contrasts_equal_numpy(profiles, contrasts):
    cells = {(o, c[0]) for c in CELLS for o, n in (("Saved", c[1]), ("Stopped", c[2])) if n >= MIN_USERS}
    assert {(r["outcome"], tuple(r[s] for s in SEGMENTS)) for r in profiles.collect()} == cells
    rows = contrasts.orderBy("segment_rank").collect()
    assert {tuple(r[s] for s in SEGMENTS) for r in rows} == set(MATCHED)
    sizes = [r["contrast_magnitude"] for r in rows]
    assert sizes == sorted(sizes, reverse=True)
    for r in rows:
        segment = tuple(r[s] for s in SEGMENTS)
        _, saved, stopped = next(c for c in CELLS if c[0] == segment)
        assert (r["n__saved"], r["n__stopped"]) == (saved, stopped)
        assert r["observed_saved_share"] == pytest.approx(saved / (saved + stopped))
        for metric in METRICS:
            one, two = (values(metric, o, segment) for o in ("Saved", "Stopped"))
            assert r[f"median_saved__{metric}"] == pytest.approx(np.median(one))
            delta = np.median(score(metric, one)) - np.median(score(metric, two))
            assert r[f"delta__{metric}"] == pytest.approx(delta)


def test_one_sided_profiles_have_no_contrast(profiles):
    alone = profile.outcome_contrasts(profiles.where("outcome = 'Stopped'"), METRICS, SEGMENTS)
    with pytest.raises(ValueError, match="share a segment"):
        profile.require_rows(alone, "No rows share a segment.")


def test_treatment_grid_is_full_and_ordered(accounts, contrasts, reference):
    rows = profile.treatment_contrasts(accounts, contrasts, reference, METRICS, SEGMENTS, top_n=3, min_n=2).collect()
    assert [(r["segment_rank"], r["Treatment"]) for r in rows] == [
        (k, t) for k in range(len(MATCHED)) for t in ("Control", "Midpoint", "Tiered")
    ]
    raw = account_rows()
    for r in rows:
        cell = [x for x in raw if x[2:6] == tuple(r[s] for s in SEGMENTS) and x[6] == r["Treatment"]]
        sides = [sum(x[1] == o for x in cell) for o in ("Saved", "Stopped")]
        assert [r["n__saved"], r["n__stopped"]] == sides
        assert r["supported"] == (min(sides) >= 2)
        assert (r["delta__frequency"] is None) == (min(sides) < 2)


def test_treatment_without_accounts_stays(accounts, contrasts, reference):
    rest = accounts.where("Treatment <> 'Midpoint'")
    rows = profile.treatment_contrasts(rest, contrasts, reference, METRICS, SEGMENTS, 3, 2).collect()
    gone = [r for r in rows if r["Treatment"] == "Midpoint"]
    assert len(gone) == len(MATCHED)
    assert all((r["total_users"], r["supported"], r["observed_saved_share"], r["contrast_magnitude"]) == (0, False, None, None) for r in gone)


def test_detail_intervals_hold_the_difference(accounts, contrasts, reference):
    rows = profile.segment_details(
        accounts, contrasts, reference, METRICS, SEGMENTS, top_n=3, bootstrap_iterations=200, seed=3
    ).collect()
    assert len(rows) == len(MATCHED) * len(METRICS)
    for r in rows:
        low, high = r["clipped_median_difference_ci_lower"], r["clipped_median_difference_ci_upper"]
        assert low <= r["clipped_median_difference"] <= high
        assert r["n__saved"] - r["non_null__saved"] == (r["metric"] == "tt_cost")


def test_detail_clips_the_median_and_profile_takes_the_median_of_clipped(spark):
    """With an even count at a clip edge the two differ; both are kept."""
    values = [0.0] * 50 + [10.0] * 49 + [1000.0]
    rows = [(f"s{i}", "Saved", "x", v) for i, v in enumerate(values)]
    rows += [("s-a", "Saved", "edge", 10.0), ("s-b", "Saved", "edge", 1000.0)]
    rows += [(f"t{i}", "Stopped", "edge", 5.0) for i in range(2)]
    df = spark.createDataFrame(rows, "billing_account string, outcome string, seg string, m double")
    ref = stage(profile.fit_reference(df, ["m"]))
    profs = stage(profile.behavior_profiles(df, ref, ["m"], ["outcome", "seg"], min_n=2))
    contrast = stage(profile.outcome_contrasts(profs, ["m"], ["seg"]))
    detail = profile.segment_details(df, contrast, ref, ["m"], ["seg"], top_n=1).first()
    bounds = ref.first()
    upper, center, spread = bounds["p99"], bounds["center"], bounds["spread"]
    score = profs.where("outcome = 'Saved' and seg = 'edge'").first()["score__m"]
    assert detail["clipped_median__saved"] == min(505.0, upper)
    clipped_pair = (10.0 + min(1000.0, upper)) / 2
    assert score == pytest.approx((clipped_pair - center) / spread)
    assert clipped_pair != detail["clipped_median__saved"]


# Published example: profiles of seven matched segments, and their contrasts.
CHANNEL = {"C": "Called-In Cancel Flow", "O": "Online Cancel Flow"}
TIMING = {"A": "Contact On/After Pricing", "B": "Contact Before Pricing"}
COHORT = {"3": "Three-Offer Cohort", "2": "Two-Offer Cohort"}
TIERS = {"l": "1. Low risk", "m": "2. Med-Low risk", "d": "3. Medium risk", "-": None}
PROFILES = [
    ("Stopped", "OA2-", 55, (-0.589041095890411, -0.5714285714285714, -0.4631217838765009, -0.2739511132843024)),
    ("Stopped", "CA3m", 28, (-0.3150684931506849, 0.0, 0.6552315608919382, 0.603296753151827)),
    ("Stopped", "CB3m", 37, (-0.1506849315068493, 0.0, 0.6260720411663808, 0.5841604621503503)),
    ("Stopped", "CA3d", 27, (-0.6027397260273972, -0.5714285714285714, -0.14922813036020582, 0.11884643885127792)),
    ("Saved", "CA3l", 78, (0.5821917808219178, 0.42857142857142855, 0.13036020583190394, -0.04726455183816702)),
    ("Stopped", "CB3l", 117, (0.5068493150684932, 0.42857142857142855, 0.16123499142367068, 0.034243889160537604)),
    ("Saved", "CB3l", 124, (0.5273972602739726, 0.2857142857142857, 0.2006861063464837, -0.2437359169661808)),
    ("Stopped", "OB3l", 100, (0.4246575342465753, 0.42857142857142855, 0.2118353344768439, 0.17244791482883587)),
    ("Saved", "OB3l", 27, (0.3287671232876712, 0.42857142857142855, 0.00686106346483705, -0.2970858516864357)),
    ("Stopped", "CA3l", 59, (0.4657534246575342, 0.14285714285714285, 0.005145797598627788, -0.15510467443302414)),
    ("Stopped", "CA2-", 50, (-0.3972602739726027, -0.2857142857142857, -0.10634648370497427, 0.029208023107517283)),
    ("Saved", "CA2-", 78, (0.3424657534246575, 0.2857142857142857, -0.04288164665523156, -0.1651764065390646)),
    ("Stopped", "CB2-", 89, (-0.3287671232876712, -0.14285714285714285, -0.20926243567753003, -0.05841604621503526)),
    ("Saved", "CB3m", 34, (-0.0136986301369863, 0.0, 0.26157804459691253, 0.21402430725336102)),
    ("Saved", "CB2-", 82, (0.26712328767123283, 0.14285714285714285, 0.048027444253859346, -0.027697263291611516)),
    ("Saved", "CA3m", 20, (-0.02054794520547945, 0.07142857142857142, -0.01972555746140652, 0.09215634877027062)),
]
CONTRASTS = [
    ("CA2-", 78, 50, 0.609375, 0.9568376559712769, "frequency", "Saved"),
    ("CA3m", 20, 28, 0.4166666666666667, 0.8992641539533657, "tenure", "Stopped"),
    ("CB2-", 82, 89, 0.47953216374269003, 0.7098307973548352, "frequency", "Saved"),
    ("CB3m", 34, 37, 0.4788732394366197, 0.5372354171684017, "tt_cost", "Stopped"),
    ("OB3l", 27, 100, 0.2125984251968504, 0.5212210477223542, "tt_cost", "Stopped"),
    ("CA3l", 78, 59, 0.5693430656934306, 0.34999811987776686, "breadth", "Saved"),
    ("CB3l", 124, 117, 0.5145228215767634, 0.3156889994921813, "tt_cost", "Stopped"),
]


def _segment(code):
    return CHANNEL[code[0]], TIMING[code[1]], COHORT[code[2]], TIERS[code[3]]


def test_published_contrasts_follow_from_published_profiles(spark):
    metrics = METRICS[:4]
    rows = [(o, *_segment(c), n, *scores, *scores) for o, c, n, scores in PROFILES]
    columns = ", ".join(f"{k}__{m} double" for k in ("median", "score") for m in metrics)
    fields = ", ".join(f"{f} string" for f in SEGMENTS)
    profs = spark.createDataFrame(rows, f"outcome string, {fields}, users bigint, {columns}")
    got = profile.outcome_contrasts(profs, metrics, SEGMENTS).collect()
    assert [r["segment_rank"] for r in got] == list(range(7))
    for r, (code, saved, stopped, share, size, metric, outcome) in zip(got, CONTRASTS):
        assert tuple(r[f] for f in SEGMENTS) == _segment(code)
        assert (r["n__saved"], r["n__stopped"], r["total_users"]) == (saved, stopped, saved + stopped)
        assert r["observed_saved_share"] == pytest.approx(share)
        assert r["contrast_magnitude"] == pytest.approx(size, rel=1e-12)
        assert (r["dominant_metric"], r["dominant_outcome"]) == (metric, outcome)
    assert got[0]["segment_label"].endswith("Two-Offer Cohort · Missing")


def test_population_labels_and_funnel(spark):
    schema = (
        "billing_account string, email_date date, status string, contact_channel string,"
        " repeatedly_called int, src_risk_tier string, frequency double, breadth double,"
        " tenure double, tt_cost double"
    )
    import datetime as dt

    early, late = dt.date(2026, 4, 3), dt.date(2026, 5, 1)
    m = (1.0, 2.0, 3.0, float("nan"))
    data = [
        ("a", early, "saved", "Called-In Cancel Flow", 0, "1. Low", *m),
        ("b", early, "stoped", "Online first", 1, None, *m),
        ("c", early, "saved", "Online Cancel Flow", 1, "1. Low risk", *m),
        ("d", early, "No Action yet", "No Action yet", None, "1. Low", *m),
        ("e", late, "saved", "Called-In Cancel Flow", 0, "1. Low", *m),
        ("f", early, "unknown saved", "Called-In Cancel Flow", 0, "1. Low", *m),
    ]
    labelled = population.label_population(spark.createDataFrame(data, schema))
    classes = {r["billing_account"]: r["likely_discount_shopper"] for r in labelled.collect()}
    assert classes == {
        "a": "Other", "b": "Contacted both ways", "c": "Pay less than start rate", "d": "Other",
        "f": "Other",
    }
    assert labelled.where("tt_cost is not null").isEmpty()
    counts = [r["accounts"] for r in population.funnel(labelled).collect()]
    assert counts == [5, 1, 3, 2, 1, 1, 0]


def test_three_scales_and_boxes_equal_numpy(accounts):
    groups = ["Saved", "Stopped"]
    long = charts.three_scales(accounts, "outcome", groups, METRICS)
    assert long.count() == sum(len(values(m)) for m in METRICS)
    people = {r["outcome"]: r["accounts"] for r in charts.group_accounts(accounts, "outcome", groups).collect()}
    assert people == {"Saved": 44, "Stopped": 27}
    boxes = charts.box_statistics(accounts, "outcome", groups, METRICS).collect()
    assert len(boxes) == 2 * len(METRICS) * 3
    for box in boxes:
        low, _, _, high = bounds(box["metric"])
        v = values(box["metric"], box["outcome"])
        scale = {"original": v, "clipped": np.clip(v, low, high), "standardized": score(box["metric"], v)}[box["scale"]]
        q1, mid, q3 = np.quantile(scale, [0.25, 0.5, 0.75])
        inside = scale[(scale >= q1 - 1.5 * (q3 - q1) - 1e-12) & (scale <= q3 + 1.5 * (q3 - q1) + 1e-12)]
        assert (box["q1"], box["median"], box["q3"]) == pytest.approx((q1, mid, q3))
        assert (box["n"], box["fliers"]) == (len(v), len(v) - len(inside))
        assert box["whisker_low"] == pytest.approx(min(inside.min(), q1))
        assert box["whisker_high"] == pytest.approx(max(inside.max(), q3))


def test_panels(accounts, contrasts, reference):
    top = contrasts.where("segment_rank = 0").first()
    segment = tuple(top[s] for s in SEGMENTS)
    panels = charts.contrast_panels(accounts, contrasts, reference, METRICS, SEGMENTS, top_n=1)
    assert panels.where("score is not null").count() == sum(len(values(m, None, segment)) for m in METRICS)
    people = charts.panel_accounts(accounts, contrasts, SEGMENTS, top_n=1).collect()
    assert {(r["segment_rank"], r["outcome"], r["accounts"]) for r in people} == {
        (0, "Saved", top["n__saved"]), (0, "Stopped", top["n__stopped"])
    }
    labels = [r["row_label"] for r in charts.heatmap(contrasts, "contrast", METRICS, 1).collect()]
    assert len(labels) == 1 and labels[0].endswith(f"(n={top['n__saved']}/{top['n__stopped']})")


def _labelled(accounts):
    status = F.when(F.col("outcome") == "Saved", "saved").otherwise("stoped")
    return accounts.withColumns({"status": status, "likely_discount_shopper": F.lit("Other")})


def test_full_analysis_exports_in_order(spark, accounts, tmp_path):
    settings = analysis.Settings(
        min_profile_users=MIN_USERS, min_treatment_users=2, top_contrasts=2, bootstrap_iterations=50
    )
    results = analysis.analyze(_labelled(accounts), settings)
    analysis.export(results, str(tmp_path))
    tables = {n: spark.read.option("header", True).csv(f"{tmp_path}/{n}").collect() for n in results}
    assert {n: len(t) for n, t in tables.items()} == {
        "population_counts": 7, "distribution_summary": 12, "primary_segment_summaries": 15,
        "likely_discount_shopper_behavior_summary": 4, "primary_behavior_reference": 4,
        "behavior_profiles": 6, "saved_minus_stopped_contrasts": 3,
        "selected_segment_treatment_contrasts": 6, "selected_segment_details": 24,
    }
    sizes = [float(r["profile_magnitude"]) for r in tables["behavior_profiles"]]
    assert sizes == sorted(sizes, reverse=True)
    ranks = [int(r["segment_rank"]) for r in tables["saved_minus_stopped_contrasts"]]
    assert ranks == sorted(ranks)


def test_key_is_checked_over_the_whole_population(accounts):
    """A repeated account outside the analysed part stops the analysis."""
    untouched = accounts.where("billing_account = 'web-1-Sa-0'").withColumns(
        {"billing_account": F.lit("twice"), "outcome": F.lit("No Action")}
    )
    labelled = _labelled(accounts.unionByName(untouched).unionByName(untouched))
    with pytest.raises(ValueError, match="unique"):
        analysis.analyze(labelled, analysis.Settings(min_profile_users=MIN_USERS, bootstrap_iterations=10))
