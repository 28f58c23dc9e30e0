"""Account numbers and bitmaps against plain distinct counts."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from holdfast.operators import account_bitmaps, population
from holdfast.sources.tables import scratch_path

SCHEMA = "billing_account string, day int, status string, likely_discount_shopper string, outcome string, cohort string"


def _rows(seed, n, accounts):
    rng = random.Random(seed)
    return [
        (
            None if rng.random() < 0.05 else f"a{rng.randrange(accounts)}", rng.randrange(3),
            rng.choice(["saved", "stoped", "No Action", None]), rng.choice(["Other", "x", None]),
            rng.choice(["Saved", "Stopped", None]), rng.choice(["c", "d", None]),
        )
        for _ in range(n)
    ]


@pytest.fixture
def labelled(spark):
    # One account holds a third of all rows.
    return spark.createDataFrame(_rows(1, 400, 90) + [("hot", k % 3, "saved", "Other", "Saved", "c") for k in range(200)], SCHEMA)


def test_numbers_are_dense_and_kept(spark, labelled, monkeypatch):
    monkeypatch.setattr(account_bitmaps, "ACCOUNTS_PER_PART", 10)
    path = scratch_path(spark, "numbers")
    first = {r[0]: r[1] for r in account_bitmaps.register_accounts(labelled.where("day = 0"), path, 1).collect()}
    again = {r[0]: r[1] for r in account_bitmaps.register_accounts(labelled.where("day = 0"), path, 1).collect()}
    assert first == again
    every = {r[0]: r[1] for r in account_bitmaps.register_accounts(labelled, path, 2).collect()}
    wanted = {r[0] for r in labelled.select("billing_account").collect()} - {None}
    assert set(every) == wanted and sorted(every.values()) == list(range(1, len(wanted) + 1))
    assert first.items() <= every.items() and len(first) < len(every)
    account_bitmaps.register_accounts(labelled, path, 3)
    assert account_bitmaps.account_numbers(spark, path).count() == len(wanted)
    account_bitmaps.register_accounts(labelled.limit(0), scratch_path(spark, "numbers"), 1)
    # Run 2 holds numbers that others may have used since.
    with pytest.raises(ValueError):
        account_bitmaps.register_accounts(labelled, path, 1)


def test_funnels_of_days_merge_to_that_of_all(spark, labelled):
    path = scratch_path(spark, "numbers")
    days = []
    for day in range(3):
        rows = labelled.where(F.col("day") == day)
        numbers = account_bitmaps.register_accounts(rows, path, day + 1)
        days.append(account_bitmaps.funnel_bitmaps(rows, numbers))
        assert account_bitmaps.funnel_of_bitmaps(days[-1]).collect() == population.funnel(rows).collect()
    two = account_bitmaps.funnel_of_bitmaps(days[0].unionByName(days[1]))
    assert two.collect() == population.funnel(labelled.where("day < 2")).collect()
    whole = account_bitmaps.funnel_of_bitmaps(days[0].unionByName(days[1]).unionByName(days[2]))
    assert whole.collect() == population.funnel(labelled).collect()
    none = account_bitmaps.funnel_bitmaps(labelled.limit(0), numbers)
    assert account_bitmaps.funnel_of_bitmaps(none).collect() == population.funnel(labelled.limit(0)).collect()


def test_segments_roll_up_from_finer_groups(spark, labelled):
    numbers = account_bitmaps.register_accounts(labelled, scratch_path(spark, "numbers"), 1)
    fine = account_bitmaps.account_bitmaps(labelled, numbers, ["cohort", "status", "day"])
    for by in (["cohort", "status"], ["cohort"], ["day"]):
        want = labelled.where("billing_account is not null").groupBy(*by).agg(F.count_distinct("billing_account").alias("accounts"))
        got = account_bitmaps.distinct_accounts(fine, by)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_numbers_beyond_one_bitmap(spark):
    numbers = spark.range(1, 70_001).select(F.col("id").cast("string").alias("billing_account"), F.col("id").alias("number"))
    rows = numbers.select("billing_account", (F.col("number") % 2).alias("half")).unionByName(numbers.select("billing_account", F.lit(1).cast("long").alias("half")))
    bitmaps = account_bitmaps.account_bitmaps(rows, numbers, ["half"])
    assert bitmaps.count() == 2 * 3
    assert {tuple(r) for r in account_bitmaps.distinct_accounts(bitmaps, ["half"]).collect()} == {(0, 35_000), (1, 70_000)}


def test_an_account_without_a_number_is_an_error(spark, labelled):
    numbers = account_bitmaps.register_accounts(labelled.where("billing_account != 'hot'"), scratch_path(spark, "numbers"), 1)
    with pytest.raises(PySparkException):
        account_bitmaps.account_bitmaps(labelled, numbers, ["day"]).collect()
