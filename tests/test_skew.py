"""One account with a third of all calls, visits and payments: results by brute force, plans by shape."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from holdfast.operators import contacts, outcome, revenue

DAY = dt.date(2024, 3, 1)
HOT = "hot"


def _day(n):
    return DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(12)
    accounts = [HOT, *[f"a{i}" for i in range(40)]]
    linked = [(a, f"{a}-{k}", _day(rng.randrange(10))) for a in accounts for k in range(1 + (a == HOT))]

    def pick():
        return HOT if rng.random() < 0.33 else rng.choice([*accounts[1:], "stranger"])

    calls, visits, payments = [], [], []
    for n in range(3000):
        a = pick()
        calls.append((f" {a.upper()} ", f"{a}-{rng.randrange(2)}", _day(rng.randrange(-20, 40)), rng.randrange(2)))
        a = pick()
        visits.append((_day(rng.randrange(-20, 40)), f"{a}-{rng.randrange(2)}", rng.randrange(2), rng.randrange(2)))
        a = pick()
        payments.append((a, f"{a}-{rng.randrange(2)}", f"i{n}", float(rng.randrange(1, 4)), 0.0, _day(rng.randrange(60)), "Paid"))
    return (
        (linked, spark.createDataFrame(linked, "billing_account string, id_subscrip string, email_date date")),
        (calls, spark.createDataFrame(calls, "Account string, idSubscrip string, event_date date, Saves__Digital_to_Digital_ int")),
        (visits, spark.createDataFrame(visits, "event_date date, id_subscrip string, entered_acc_mng int, confirmed_cancel int")),
        (
            payments,
            spark.createDataFrame(
                payments,
                "billing_account string, id_subscrip string, invoice_number string, billing_amount double,"
                " balance double, id_payment_date date, payment_status string",
            ),
        ),
    )


def test_first_calls_of_a_hot_account(tables):
    (linked, l_df), (calls, c_df), _, _ = tables
    want = {}
    for account, sub, email in linked:
        own = [(d, saved) for a, s, d, saved in calls if a.strip().lower() == account and s == sub and d >= email]
        if own:
            unsaved = [d for a, _, d, saved in calls if a.strip().lower() == account and not saved and d >= email]
            want[account, sub] = (min(d for d, _ in own), min(unsaved, default=None))
    got = {
        (r["billing_account"], r["id_subscrip"]): (r["__called_in_date"], r["__call_cancel_date"])
        for r in outcome.first_calls(l_df, c_df).collect()
    }
    assert got == want
    days = outcome.days_of_calls(l_df, c_df).where(F.col("billing_account") == HOT).count()
    assert days <= 2 * 60  # one row per day and subscription, however many calls


def test_contact_days_of_a_hot_account(tables):
    (linked, l_df), (calls, c_df), (visits, v_df), _ = tables
    want = {
        (account, sub, d)
        for account, sub, email in linked
        for a, s, d, _ in calls
        if a.strip().lower() == account and s == sub and d >= email
    }
    assert {tuple(r) for r in contacts.call_days(l_df, c_df).collect()} == want
    pages = {
        (account, sub, d) for account, sub, email in linked for d, s, opened, _ in visits if opened and s == sub and d >= email
    }
    assert {tuple(r) for r in contacts.page_days(l_df, v_df).collect()} == pages


def test_payments_of_a_hot_account(spark, tables):
    (linked, _), _, _, (payments, p_df) = tables
    rows = [(a, s, "c", "T", 0, 2.0, 3.0, _day(0), _day(5) if i % 3 else None) for i, (a, s, _) in enumerate(linked)]
    population = spark.createDataFrame(
        rows,
        "billing_account string, id_subscrip string, cohort string, Treatment string, churned int, offered_rate double,"
        " new_rate double, pricing_effective_date date, __earlist_contact_date date",
    )
    qualifying = revenue.qualifying_payments(population, p_df)
    got = {(r["billing_account"], r["id_subscrip"]): r["tt_paid_raw"] for r in revenue.account_revenue(revenue.flag_payments(qualifying)).collect()}
    want = {}
    for account, sub, *_, contact in rows:
        paid = [amount for a, s, _, amount, _, d, _ in payments if (a, s) == (account, sub) and contact and d > contact]
        if paid:
            want[account, sub] = sum(paid)
    assert got == pytest.approx(want)
    assert qualifying.groupBy("billing_account", "id_subscrip").count().agg(F.max("count")).first()[0] <= 3 * 60
    plan = qualifying._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan  # payments of other accounts go before they are counted


def test_cnrc_by_a_column_with_missing_values(spark, tables):
    """A group without a name keeps its revenue."""
    _, _, _, (payments, p_df) = tables
    rows = [(HOT, f"{HOT}-{k}", "c", "T", tier, 0, 2.0, 3.0, _day(0), _day(5)) for k in (0, 1) for tier in (None, "low")]
    population = spark.createDataFrame(
        rows,
        "billing_account string, id_subscrip string, cohort string, Treatment string, src_risk_tier string, churned int,"
        " offered_rate double, new_rate double, pricing_effective_date date, __earlist_contact_date date",
    )
    by = ["cohort", "src_risk_tier"]
    got = {(r["src_risk_tier"], r["window_days"]): (r["callers"], r["revenue"]) for r in revenue.cnrc(population, p_df, by=by).collect()}
    for days in revenue.CNRC_WINDOWS:
        paid = sum(amount for a, _, _, amount, _, d, _ in payments if a == HOT and _day(5) < d <= _day(5 + days))
        assert got[None, days] == got["low", days] == (1, pytest.approx(paid))
