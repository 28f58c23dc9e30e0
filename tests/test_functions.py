import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from holdfast.functions import dates, keys, labels, scores

D = dt.date


def rows(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_account_key_strips_every_whitespace(spark):
    data = [("\t  AbC-1  \n",), ("x y",), (None,)]
    assert rows(spark, data, "a string", keys.account_key("a")) == [("abc-1",), ("x y",), (None,)]


def test_null_safe_join_matches_missing_with_missing(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("b", 20)], "k string, y int")
    assert [tuple(r) for r in keys.null_safe_join(left, right, ["k"]).collect()] == [(None, 1, 10)]
    left_rows = keys.null_safe_join(left, right, ["k"], "left").collect()
    assert sorted(tuple(r) for r in left_rows if r["k"]) == [("a", 2, None)]


@pytest.mark.parametrize("offset", range(7))
def test_target_date(spark, offset):
    day = D(2026, 4, 5) + dt.timedelta(days=offset)  # 2026-04-05 is a Sunday
    assert dates.target_date(day.isoformat(), "exact") == day
    assert dates.target_date(day, "Sunday") == D(2026, 4, 5)
    both = rows(
        spark, [(day,)], "d date", dates.target_date_col("d", "exact"),
        dates.target_date_col("d", "sunday"),
    )
    assert both == [(day, D(2026, 4, 5))]


def test_unknown_date_mode():
    with pytest.raises(ValueError):
        dates.target_date("2026-04-05", "monthly")


@pytest.mark.parametrize("days,mode", list(itertools.product([-3, 0, 1, 6, 7, 15], ["exact", "sunday"])))
def test_missing_dates_list_and_column_agree(spark, days, mode):
    start = D(2026, 4, 5)
    end = start + dt.timedelta(days=days)
    step = 1 if mode == "exact" else 7
    expected = [start + dt.timedelta(days=d) for d in range(step, days + 1, step)]
    assert dates.missing_dates(start, end, mode) == expected
    column = rows(spark, [(start, end)], "s date, e date", dates.missing_dates_col("s", "e", mode))
    assert column == [(expected,)]


def test_inference_and_email_dates(spark):
    data = [(D(2026, 4, 8),), (D(2026, 4, 9),), (D(2026, 4, 15),)]
    week = dates.inference_date("f")
    assert rows(spark, data, "f date", week, dates.email_date(week)) == [
        (D(2026, 3, 29), D(2026, 4, 3)),
        (D(2026, 4, 5), D(2026, 4, 10)),
        (D(2026, 4, 12), D(2026, 4, 17)),
    ]


def test_floor_date(spark):
    data = [(D(2026, 4, 1),), (D(2026, 4, 9),)]
    assert rows(spark, data, "d date", dates.floor_date("d")) == [
        (D(2026, 4, 3),), (D(2026, 4, 9),),
    ]


def test_contact_channel_truth_table(spark):
    a, b = D(2026, 5, 1), D(2026, 5, 2)
    data = [
        (0, 0, None, None), (1, 1, b, a), (1, 1, a, a), (1, 1, a, b), (1, 0, a, None),
        (0, 1, None, a),
    ]
    got = rows(
        spark, data, "c int, o int, cd date, od date", labels.contact_channel("c", "o", "cd", "od"),
        labels.earliest("cd", "od"),
    )
    assert got == [
        ("No Action yet", None), ("Online first", a), ("Online first", a), ("Called-In first", a),
        ("Called-In Cancel Flow", a), ("Online Cancel Flow", a),
    ]


def test_status_and_churn_truth_table(spark):
    d = D(2026, 5, 1)
    data = [
        (None, None, 0), (None, None, 1), (None, d, 0), (None, d, 1), (d, d, 1), (d, None, 1),
        (d, None, 0), (d, d, 0),
    ]
    got = rows(
        spark, data, "contact date, cancel date, stop int",
        labels.status("contact", "cancel", "stop"), labels.churned("contact", "cancel", "stop"),
    )
    assert got == [
        ("No Action yet", 0), ("No Action yet", 0), ("No Action yet", 0), ("No Action yet", 1),
        ("stoped", 1), ("unknown stoped", None), ("saved", 0), ("unknown saved", None),
    ]


def test_no_contact_counts_as_after_pricing(spark):
    p = D(2026, 5, 1)
    data = [(None, p), (D(2026, 4, 30), p), (p, p)]
    got = rows(spark, data, "c date, p date", labels.contact_timing("c", "p"))
    assert [g[0] for g in got] == [labels.AFTER_PRICING, labels.BEFORE_PRICING, labels.AFTER_PRICING]


def test_payment_status_every_arm(spark):
    a, b = D(2026, 5, 1), D(2026, 5, 2)
    data = [
        (a, None, 5.0, "Posted"), (b, a, 5.0, "Posted"), (a, a, 5.0, "Posted"),
        (None, None, 0.0, "Posted"), (None, None, 0.0, "Draft"), (None, None, None, "Posted"),
        (None, a, 0.0, "Posted"), (a, b, 0.0, "Posted"),
    ]
    got = rows(
        spark, data, "p date, d date, amount double, status string",
        labels.payment_status("p", "d", "amount", "status"),
    )
    assert [g[0] for g in got] == ["Paid"] * 4 + ["Not Paid"] * 4


def test_web_flags(spark):
    data = [
        ("ManageSubscription|CANCEL",), ("snap|CancelSubscription",),
        ("snap|cancelsubscription winback-zuora",), ("snapXcancelsubscription",),
        ("stopsave success",), (None,),
    ]
    flags = labels.web_flags("d")
    got = rows(spark, data, "d string", *flags.values())
    assert list(flags) == ["entered_acc_mng", "confirmed_cancel", "success_save"]
    assert got == [(1, 0, 0), (0, 1, 0), (0, 0, 0), (0, 0, 0), (0, 0, 1), (0, 0, 0)]


def test_ordinals(spark):
    got = rows(spark, [(i,) for i in range(1, 12)], "r int", labels.ordinal("r"))
    assert [g[0] for g in got] == [
        "1st", "2nd", "3rd", "4th", "5th", "6th", "7th", "8th", "9th", "10", "11",
    ]


def test_market_first_rule_wins(spark):
    data = [("The DETROIT Bergen Times",), ("Palm beach Post",), ("Reno",), (None,)]
    got = rows(spark, data, "n string", labels.market("n", ("Bergen", "Detroit", "Palm Beach")))
    assert [g[0] for g in got] == ["Bergen", "Palm Beach", "Reno", None]


def test_risk_tier_suffix_once(spark):
    got = rows(spark, [("1. Low",), ("1. Low risk",), (None,)], "t string", labels.risk_tier("t"))
    assert [g[0] for g in got] == ["1. Low risk", "1. Low risk", None]


def test_shopper_class(spark):
    data = [(1, "x"), (None, "x"), (0, "x"), (1, labels.BOTH_WAYS)]
    got = rows(spark, data, "r int, g string", labels.shopper_class("r", "g"))
    assert [g[0] for g in got] == [labels.PAY_LESS, "Other", "Other", labels.BOTH_WAYS]


def test_magnitude_and_dominant_metric(spark):
    nan = float("nan")
    data = [(3.0, -4.0), (None, None), (2.0, -2.0), (nan, 1.0), (float("inf"), 1.0)]
    x, y = F.col("x"), F.col("y")
    got = rows(
        spark, data, "x double, y double", scores.magnitude([x, y]), scores.dominant({"x": x, "y": y})
    )
    assert got == [(5.0, "y"), (None, None), (math.sqrt(8), "x"), (1.0, "y"), (1.0, "x")]


def test_clip_keeps_missing_and_open_bounds(spark):
    data = [(5.0, 0.0, 3.0), (-1.0, 0.0, 3.0), (None, 0.0, 3.0), (9.0, None, None)]
    got = rows(
        spark, data, "v double, a double, b double", scores.clip(F.col("v"), F.col("a"), F.col("b"))
    )
    assert [g[0] for g in got] == [3.0, 0.0, None, 9.0]
