"""The effective-dated join against pairing by hand, and what it makes on a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from holdfast.operators import intervals

D0 = dt.date(1969, 11, 1)  # day numbers of both signs
FACTS = "a string, b int, date date, fact int, day int"
VERSIONS = "a string, b int, effective_date date, end_date date, version int, fact string"


def day(n):
    return None if n is None else D0 + dt.timedelta(days=n)


def tables(seed):
    rng = random.Random(seed)
    key = lambda: (rng.choice(["x", "y", None]), rng.choice([1, 2, None]))
    facts = [(*key(), day(rng.choice([None, rng.randrange(400)])), k, k % 3) for k in range(150)]
    facts += facts[:10]
    versions = []
    for k in range(80):
        start = rng.randrange(-50, 420)
        end = rng.choice([None, start, start - 1, start + rng.randrange(300), start + rng.randrange(20), 3_000_000 // 2])
        versions.append((*key(), day(rng.choice([start, start, None])), day(end), k, f"v{k}"))
    versions += versions[:7]
    return facts, versions


def by_hand(facts, versions, left=False):
    out = []
    for f in facts:
        found = [
            (*f, v[4], v[5])
            for v in versions
            if None not in (*f[:3], *v[:4]) and v[:2] == f[:2] and v[2] <= f[2] <= v[3]
        ]
        out += found or ([(*f, None, None)] if left else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_equals_pairing_by_hand(spark, seed, how):
    facts, versions = tables(seed)
    got = intervals.effective_join(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), ["a", "b"], "date", how=how
    )
    assert got.columns == ["a", "b", "date", "fact", "day", "version", "fact"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(facts, versions, how == "left")


def test_facts_of_one_day(spark):
    facts, versions = tables(4)
    one = [(*f[:2], day(77), *f[3:]) for f in facts]
    got = intervals.effective_join(
        spark.createDataFrame(one, FACTS), spark.createDataFrame(versions, VERSIONS), ["a", "b"], "date", day=day(77)
    )
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(one, versions)


def test_empty_sides_and_versions_without_columns(spark):
    facts, versions = (spark.createDataFrame(t, s) for t, s in zip(tables(5), (FACTS, VERSIONS), strict=True))
    bare = versions.select("a", "b", "effective_date", "end_date")
    join = lambda f, v, **k: intervals.effective_join(f, v, ["a", "b"], "date", **k)
    assert join(facts, bare).columns == facts.columns
    assert join(facts, bare).count() == join(facts, versions).count() > 0
    assert join(facts.limit(0), versions).count() == 0
    assert join(facts, versions.limit(0)).count() == 0
    assert join(facts, versions.limit(0), how="left").count() == facts.count()


def test_hot_key_makes_no_dead_pairs(spark):
    """10^5 facts and 10^4 versions of one key; pairing all of them would make 10^9 rows."""
    start = F.lit(dt.date(2000, 1, 1))
    facts = spark.range(100_000).select(F.lit("hot").alias("k"), F.date_add(start, (F.col("id") % 10_000).cast("int")).alias("date"))
    versions = spark.range(10_000).select(
        F.lit("hot").alias("k"), F.date_add(start, F.col("id").cast("int")).alias("effective_date"),
        F.date_add(start, (F.col("id") + F.col("id") % 3).cast("int")).alias("end_date"), "id",
    )
    result = intervals.effective_join(facts, versions, ["k"], "date").count()
    low, high = F.unix_date(start), F.unix_date(F.date_add(start, 9_999))
    cells = intervals.fact_cells(facts, ["k"], "date")
    spans = intervals.version_spans(versions, ["k"], "effective_date", "end_date", low, high)
    days = intervals.version_days(spans, cells, ["k"])
    assert result == sum(10 for k in range(10_000) for d in range(k % 3 + 1) if k + d < 10_000)
    assert spans.count() + cells.count() + days.count() + result < 2 * result
    assert days.groupBy("k0", "day").count().agg(F.max("count")).first()[0] <= 3
