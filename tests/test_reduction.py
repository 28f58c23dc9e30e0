"""Semi-joins behind a Bloom filter: the same rows, few of them shuffled; each event source scanned once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from holdfast.operators import outcome, reduction
from holdfast.plans import experiment


def shuffled_rows(spark, run):
    """Rows that the stages of `run` wrote to a shuffle."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    store = spark.sparkContext._jsc.sc().statusStore()

    def rows():
        stages = store.stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = rows()
    result = run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return result, rows() - before


@pytest.fixture
def filtered(spark, monkeypatch):
    """No keys are few enough to be broadcast, by this library or by the planner."""
    monkeypatch.setattr(reduction, "BROADCAST_KEYS", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_cohort_of_one_in_a_hundred_shuffles_few_rows(spark, filtered):
    events = spark.range(200_000).select((F.col("id") % 20_000).cast("string").alias("account"), F.col("id").alias("n"))
    keys = spark.range(0, 20_000, 100).select(F.col("id").cast("string").alias("account"))
    got, rows = shuffled_rows(spark, lambda: reduction.restrict(events, keys, "account").collect())
    assert sorted(r["n"] for r in got) == [n for n in range(200_000) if n % 20_000 % 100 == 0]
    own, filter_rows = len(got), rows - len(got)
    assert rows < 0.05 * 200_000 + 3 * reduction.MIN_BITS // 64, (own, filter_rows)
    passed = _passing(events, keys, reduction.filter_bits(200))
    assert 2_000 <= passed < 0.05 * 200_000


def _passing(events, keys, bits):
    pages = reduction.bloom_filter(keys, ["account"], bits).scalar()
    return events.where(reduction.may_hold(pages, ["account"], bits)).count()


@pytest.mark.parametrize("keys", [1, 5_000, 60_000])
def test_no_key_is_lost_and_few_strangers_pass(spark, keys):
    bits = reduction.filter_bits(keys)
    wanted = spark.range(keys).select(F.col("id").alias("account"))
    assert _passing(wanted, wanted, bits) == keys
    strangers = spark.range(10**9, 10**9 + 100_000).select(F.col("id").alias("account"))
    assert _passing(strangers, wanted, bits) < 2_000


def test_filter_sizes():
    assert reduction.filter_bits(0) == reduction.filter_bits(5) == reduction.MIN_BITS
    assert reduction.filter_bits(10_000) == 1 << 17
    assert reduction.filter_bits(10**9) == reduction.MAX_BITS


@pytest.mark.parametrize("broadcast", [True, False])
def test_pairs_nulls_repeats_and_empty_sides(spark, monkeypatch, broadcast):
    monkeypatch.setattr(reduction, "BROADCAST_KEYS", 10 if broadcast else -1)
    schema = "a string, b string, n int"
    events = spark.createDataFrame([("x", "1", 1), ("x", "2", 2), ("x", None, 3), (None, "1", 4), ("x", "1", 5), ("y", "1", 6)], schema)
    keys = spark.createDataFrame([("x", "1"), ("x", "1"), (None, "1"), ("x", None), ("y", "2")], "a string, b string")
    got = reduction.restrict(events, keys, ["a", "b"])
    assert got.columns == ["a", "b", "n"]
    assert sorted(r["n"] for r in got.collect()) == [1, 5]
    assert reduction.restrict(events, keys.limit(0), ["a", "b"]).count() == 0
    assert reduction.restrict(events.limit(0), keys, ["a", "b"]).count() == 0


def test_contacts_are_the_same_behind_the_filter(spark, monkeypatch):
    day = dt.date(2024, 3, 1)
    linked = spark.createDataFrame([(f"a{i}", f"a{i}-0", day) for i in range(30)], "billing_account string, id_subscrip string, email_date date")
    calls = spark.createDataFrame(
        [(f" A{i % 60} ", f"a{i % 60}-0", day + dt.timedelta(days=i % 9 - 3), i % 2) for i in range(600)],
        "Account string, idSubscrip string, event_date date, Saves__Digital_to_Digital_ int",
    )
    want = sorted(map(tuple, outcome.first_calls(linked, calls).collect()))
    monkeypatch.setattr(reduction, "BROADCAST_KEYS", 0)
    assert sorted(map(tuple, outcome.first_calls(linked, calls).collect())) == want
    assert len(want) == 30


def test_outcome_and_history_scan_each_source_once(spark, tmp_path):
    """The days are tables of their own: the sources can go before outcome and history read them."""
    day = dt.date(2024, 3, 1)
    linked = spark.createDataFrame([("a", "s", day), ("b", "t", day)], "billing_account string, id_subscrip string, email_date date")
    schema = "Account string, idSubscrip string, event_date date, Saves__Digital_to_Digital_ int"
    rows = [("A ", "s", day, 0), ("c", "u", day, 0)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    calls = spark.createDataFrame(rows, schema).mapInPandas(counted, schema)
    online_schema = "event_date date, id_subscrip string, entered_acc_mng int, confirmed_cancel int"
    online = spark.createDataFrame([(day, "t", 1, 0), (day, "u", 1, 1)], online_schema).mapInPandas(counted, online_schema)
    sources = experiment.ExperimentTables(None, None, None, calls, online, None, None, None)
    days = experiment.contact_days(sources, linked)
    first = {r["billing_account"] for r in outcome.first_call_days(linked, days.calls).collect()}
    visited = {r["billing_account"] for r in outcome.first_visit_days(linked, days.visits).collect()}
    from holdfast.operators import contacts

    events = {tuple(r) for r in contacts.events_of_days(linked, days).collect()}
    assert first == {"a"} and visited == {"b"}
    assert events == {("a", "s", day, "Called In"), ("b", "t", day, "Opened Cancel Page")}
    assert read.value == 4  # two calls and two visits, once each
