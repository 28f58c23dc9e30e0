"""The outcome chain against row-by-row brute force, and its agreed quirks."""

import datetime as dt
import random

import pytest

from holdfast.operators import cardinality, contacts, outcome, rates, revenue
from holdfast.sources import cohort, web

BASE = dt.date(2026, 4, 3)
LINKED = (
    "id_subscrip string, billing_account string, current_rate double, new_rate double,"
    " offered_rate double, pricing_effective_date date, cohort string, Treatment string,"
    " inference_date date, email_date date"
)
CALLS = "Account string, idSubscrip string, event_date date, Saves__Digital_to_Digital_ int"
ONLINE = "event_date date, id_subscrip string, entered_acc_mng int, confirmed_cancel int"
STOPS = "id_subscrip string, transaction_date date, create_date date, is_perm_stop int"
PAYMENTS = (
    "account string, id_subscrip string, invoice_number string, amount_without_tax double,"
    " balance double, amount double, id_payment_date date, id_decline_date date, status string"
)


def day(n):
    return BASE + dt.timedelta(days=n)


def assignment(account, sub, email, pricing=14):
    return (sub, account, 10.0, 12.5, 7.5, day(pricing), "Two-Offer Cohort", "Control", day(email - 5), day(email))


@pytest.fixture(scope="module")
def random_tables(spark):
    """Few accounts, many events, one account holding a third of all calls."""
    rng = random.Random(5)
    subs = {f"a{i}": [f"s{i}x", f"s{i}y"][: 1 + i % 2] for i in range(8)}
    linked = [
        assignment(a, s, rng.randrange(0, 20)) for a, ss in subs.items() for s in ss for _ in range(2)
    ] + [assignment("a-nosub", None, 3)]
    pick = lambda: rng.choice(["a0"] * 4 + list(subs))
    calls, online = [], []
    for _ in range(150):
        a = pick()
        calls.append((f" {a.upper()} ", rng.choice(subs[a]), day(rng.randrange(40)), rng.randrange(2)))
        online.append((day(rng.randrange(40)), rng.choice(subs[pick()]), rng.randrange(2), rng.randrange(2)))
    return (
        linked, calls, online,
        spark.createDataFrame(linked, LINKED), spark.createDataFrame(calls, CALLS),
        spark.createDataFrame(online, ONLINE),
    )


@pytest.mark.parametrize("strict", [False, True])
def test_first_calls_equal_brute_force(random_tables, strict):
    linked, calls, _, linked_df, calls_df, _ = random_tables
    expected = {}
    for sub, account, *_, email in linked:
        own = [c for c in calls if c[0].strip().lower() == account and c[1] == sub and c[2] >= email]
        if not own:
            continue
        cancels = [
            c[2] for c in calls
            if c[0].strip().lower() == account and c[3] == 0 and c[2] >= email
            and (not strict or c[1] == sub)
        ]
        called, cancel = expected.get((account, sub), (dt.date.max, dt.date.max))
        expected[(account, sub)] = (
            min([called, *[c[2] for c in own]]), min([cancel, *cancels]),
        )
    got = {
        (r["billing_account"], r["id_subscrip"]): (
            r["__called_in_date"], r["__call_cancel_date"] or dt.date.max
        )
        for r in outcome.first_calls(linked_df, calls_df, strict).collect()
    }
    assert got == expected and len(got) > 5


def test_first_online_equals_brute_force(random_tables):
    linked, _, online, linked_df, _, online_df = random_tables
    expected = {}
    for sub, account, *_, email in linked:
        opened = [o[0] for o in online if o[1] == sub and o[2] == 1 and o[0] >= email]
        if not opened:
            continue
        confirmed = [o[0] for o in online if o[1] == sub and o[3] == 1 and o[0] >= email]
        page, cancel = expected.get((account, sub), (dt.date.max, dt.date.max))
        expected[(account, sub)] = (min([page, *opened]), min([cancel, *confirmed]))
    got = {
        (r["billing_account"], r["id_subscrip"]): (
            r["__open_cancel_page_date"], r["__ol_cancel_date"] or dt.date.max
        )
        for r in outcome.first_online(linked_df, online_df).collect()
    }
    assert got == expected and len(got) > 5


def one(spark, linked, calls=(), online=(), stops=()):
    base = outcome.assemble(
        spark.createDataFrame(list(linked), LINKED), spark.createDataFrame(list(calls), CALLS),
        spark.createDataFrame(list(online), ONLINE), spark.createDataFrame(list(stops), STOPS),
    )
    return outcome.classify(outcome.derive_contacts(base)).collect()


def test_unsaved_call_on_another_subscription_counts(spark):
    calls = [("a", "s1", day(6), 1), ("a", "s2", day(7), 0)]
    row = one(spark, [assignment("a", "s1", 5)], calls)[0]
    assert (row["__called_in_date"], row["__call_cancel_date"]) == (day(6), day(7))
    assert row["status"] == "unknown saved" and row["churned"] is None


def test_first_contact_is_shared_by_every_email_row(spark):
    rows = one(spark, [assignment("a", "s", 0), assignment("a", "s", 20)], [("a", "s", day(5), 1)])
    assert [r["__called_in_date"] for r in rows] == [day(5), day(5)]


def test_missing_subscription_never_matches(spark):
    row = one(
        spark, [assignment("a", None, 0)], [("a", None, day(5), 0)], [(day(5), None, 1, 1)],
        [(None, day(9), day(8), 1)],
    )[0]
    assert (row["status"], row["churned"], row["perm_stoped"]) == ("No Action yet", 0, 0)
    assert row["contact_timing"] == "Contact On/After Pricing"


def test_every_later_stop_gives_a_row(spark):
    stops = [("s", day(30), day(9), 1), ("s", day(31), day(10), 1), ("s", day(1), day(1), 1), ("s", day(33), day(12), 0)]
    rows = one(spark, [assignment("a", "s", 5)], stops=stops)
    assert sorted(r["perm_stop_date"] for r in rows) == [day(30), day(31)]


def test_tier_join_ignores_the_subscription(spark):
    outcomes = spark.createDataFrame(
        [("s1", "a", day(0)), ("s2", "a", day(0))],
        "id_subscrip string, billing_account string, inference_date date",
    )
    weekly = spark.createDataFrame(
        [(day(0), " A", "s1", "1. Low"), (day(0), "a ", "s2", "5. High")],
        "inference_date date, billing_account string, id_subscrip string, risk_tier string",
    )
    metrics = spark.createDataFrame(
        [(day(0), "s1", 1.0, 2.0, 3.0, 4.0)],
        "inference_date date, id_subscrip string, frequency double, breadth double, tenure double,"
        " tt_cost double",
    )
    rows = outcome.attach_behaviour(outcomes, weekly, metrics).collect()
    assert len(rows) == 4
    assert {r["frequency"] for r in rows if r["id_subscrip"] == "s2"} == {None}


def test_assignment_labels_and_overrides(spark):
    applied = spark.createDataFrame(
        [("\tAB ", 1.0, 2.0, 3.0, dt.datetime(2026, 5, 1, 8), m, g, f) for m, g, f in (
            ("PCHURN", "RISK3", dt.date(2026, 4, 8)), ("PCHURN", "RISK3", dt.date(2026, 4, 8)),
            ("MIDPOINT", "CONTROL", dt.date(2026, 4, 16)), ("MIDPOINT", "MIDPOINT", dt.date(2026, 4, 16)),
        )],
        "subscription string, currentrate double, newrate double, stopsave double, effective timestamp,"
        " modeltype string, grouptype string, filedate date",
    )
    rows = outcome.clean_assignments(applied).collect()
    assert sorted((r["cohort"], r["Treatment"], str(r["inference_date"])) for r in rows) == [
        ("Three-Offer Cohort", "Tiered", "2026-03-29"),
        ("Two-Offer Cohort", "Control", "2026-04-12"),
        ("Two-Offer Cohort", "Midpoint", "2026-04-12"),
    ]
    assert {r["billing_account"] for r in rows} == {"ab"}


def outcomes_frame(spark, rows):
    """(account, churned, contact day): terms are offer 7.5, new rate 12.5, pricing day 14."""
    data = [
        ("Two-Offer Cohort", "Control", a, "s" + a, c, 7.5, 12.5, day(14), day(k) if k is not None else None, None)
        for a, c, k in rows
    ]
    return spark.createDataFrame(
        data,
        "cohort string, Treatment string, billing_account string, id_subscrip string, churned int,"
        " offered_rate double, new_rate double, pricing_effective_date date,"
        " __earlist_contact_date date, src_risk_tier string",
    )


def payment(account, when, amount, balance=0.0, declined=None):
    date = day(when) if when is not None else None
    return (f" {account.upper()}", "s" + account, "i", amount, balance, amount, date, declined, "Posted")


def test_missing_payment_dates_are_filtered_but_still_classified(spark):
    payments = spark.createDataFrame([payment("a", None, 0.0), payment("a", 20, 9.0)], PAYMENTS)
    statuses = [r["payment_status"] for r in revenue.settle_payments(payments).collect()]
    assert statuses == ["Paid", "Paid"]
    assert revenue.payment_facts(payments).count() == 1


def test_revenue_with_a_flood_of_payments(spark):
    """One account holds most payments; sums must count each of them."""
    payments = [payment("hot", 20 + i % 3, 8.0) for i in range(300)]
    payments += [payment("low", 20, 5.0), payment("low", 21, None), payment("low", 10, 50.0)]
    payments += [payment("gap", 20, 12.5), payment("gone", 20, 12.5), payment("hot", 22, 9.0, -1.0)]
    rows = [("hot", 0, 3), ("low", 0, 3), ("gap", 0, 3), ("gone", 1, 3), ("quiet", 0, None), ("odd", None, 3)]
    table = revenue.revenue_table(outcomes_frame(spark, rows), spark.createDataFrame(payments, PAYMENTS))
    got = {
        r["billing_account"]: (r["tt_paid_raw"], r["tt_paid_save_once"], r["repeatedly_called"])
        for r in table.collect()
    }
    assert got == {
        "hot": (2400.0, 2400.0, 0), "low": (5.0, 7.5, 1), "gone": (0.0, 0.0, 0), "quiet": (0.0, 0.0, 0),
    }


def test_churn_rate_and_cnrc(spark):
    rows = [("a", 0, 1), ("b", 1, 1), ("c", 0, 1), ("d", 0, None), ("e", None, 1)]
    frame = outcomes_frame(spark, rows)
    rate = revenue.churn_rate(frame).first()
    assert (rate["rows"], rate["churned"], rate["churn_rate"]) == (3, 1, pytest.approx(1 / 3))
    payments = [payment("a", 14, 6.0), payment("a", 31, 6.0), payment("a", 62, 6.0), payment("b", 20, 99.0)]
    facts = revenue.payment_facts(spark.createDataFrame(payments, PAYMENTS))
    got = {r["window_days"]: (r["callers"], r["revenue"]) for r in revenue.cnrc(frame, facts).collect()}
    assert got == {30: (3, 12.0), 60: (3, 12.0), 90: (3, 18.0)}


def test_contact_history_steps(spark):
    linked = spark.createDataFrame([assignment("a", "s", 0), assignment("b", "t", 0)], LINKED)
    calls = spark.createDataFrame([("A", "s", day(3), 0), ("A", "s", day(3), 1), ("A", "s", day(9), 1)], CALLS)
    online = spark.createDataFrame([(day(3), "s", 1, 0), (day(4), "s", 0, 1)], ONLINE)
    steps = contacts.contact_steps(contacts.contact_sequence(contacts.contact_events(linked, calls, online)))
    got = sorted((r["contact_order"], r["contact_types"], r["contact_date"]) for r in steps.collect())
    # The dates of one step are equal by construction; the array repeats them.
    assert got == [
        ("1st", "Called In & Opened Cancel Page", [day(3), day(3)]), ("2nd", "Called In", [day(9)]),
    ]
    history = contacts.contact_history(linked, steps).collect()
    assert [(r["billing_account"], r["contact_order"]) for r in history] == [
        ("a", "1st"), ("a", "2nd"), ("b", "No Action yet"),
    ]


def test_month_cost_keeps_unknown_prices(spark):
    df = spark.createDataFrame([("-3",), ("12.345",), (None,)], "monthly_price string")
    assert [r[0] for r in df.select(rates.month_cost()).collect()] == [0.0, 12.35, None]


def test_guardrail_counts_and_verdict(spark):
    applied = spark.createDataFrame(
        [(" A ", "MIDPOINT"), ("b", "MIDPOINT"), ("c", "PCHURN"), ("d", "PCHURN")],
        "subscription string, modeltype string",
    )
    link_schema = (
        "billing_account string, circ_idsubscrip string, billing_system string, circ_status string,"
        " circ_site string"
    )
    ok = ("ZUORA", "Active", "MAIN")
    link = spark.createDataFrame(
        [("a", "1", *ok), ("A", "2", *ok), ("b", "3", *ok), ("b", "4", "ZUORA", "Active", "PLAY")], link_schema
    )
    weekly = spark.createDataFrame([("c", "5"), ("d", "6"), ("d", "6")], "billing_account string, id_subscrip string")
    counts = cardinality.account_violations(applied, link, weekly)
    assert {r["modeltype"]: r["cnt"] for r in counts.collect()} == {"MIDPOINT": 1, "PCHURN": 0}
    assert cardinality.verdict(counts).first()["Result"] == "Some violations"
    clean = cardinality.account_violations(applied, link.where("circ_idsubscrip <> '2'"), weekly)
    assert cardinality.verdict(clean).first()["Result"] == "No violations"
    none = cardinality.account_violations(applied.limit(0), link, weekly)
    assert cardinality.verdict(none).first()["Result"] == "No violations"


def test_weekly_source_and_online_events(spark):
    subs = spark.createDataFrame(
        [("s1", day(-30), day(1), "p1", ["c1"]), ("s1", day(2), dt.date(9999, 12, 31), "p2", ["c1", "c2"]),
         ("s2", day(-30), day(100), "p1", [])],
        "id_subscrip string, effective_date date, end_date date, mdm_product_id string, consumer_ids array<string>",
    )
    product = spark.createDataFrame(
        [("p1", "u1", "w1"), ("p2", "u2", "w2")], "product_id string, publication_id string, website_id string"
    )
    publication = spark.createDataFrame([("u1", "Bergen Daily"), ("u2", "Elsewhere")], "publication_id string, publication_name string")
    link = spark.createDataFrame(
        [("s1", "A1", "ZUORA"), ("s2", "A2", "OTHER")], "circ_idsubscrip string, billing_account string, billing_system string"
    )
    sunday = dt.date(2026, 4, 5)  # day(2): the second version of s1
    tiers = spark.createDataFrame(
        [(sunday, "s1", "1. Low"), (sunday, "s2", "1. Low"), (dt.date(2026, 3, 29), "s1", "5. High")],
        "inference_date date, id_subscrip string, risk_tier string",
    )
    weekly = lambda run: cohort.weekly_risk_source(tiers, subs, product, publication, link, run)
    assert weekly("2026-04-07").collect() == []  # Elsewhere does not take part
    assert [tuple(r) for r in weekly("2026-04-01").collect()] == [
        (dt.date(2026, 3, 29), "A1", "s1", "5. High", "Bergen", "Bergen Daily")
    ]
    known = spark.createDataFrame(
        [("c1", "v1", None, "v1"), ("c2", "v2", "v3", None)],
        "consumer_id string, anonymous_id_1 string, anonymous_id_2 string, anonymous_id_3 string",
    )
    assert web.consumer_visitors(known).count() == 3
    events = spark.createDataFrame(
        [(day(0), "v1", "w1", "managesubscription cancel"), (day(3), "v3", "w2", "snap|cancelsubscription"),
         (day(3), "v3", "w2", None), (day(3), "v3", "w1", "stopsave success")],
        "event_date date, d049_user_anonymous_id string, d031_website_id string, d027_event_detail string",
    )
    got = lambda d: [
        (r["id_subscrip"], r["entered_acc_mng"], r["confirmed_cancel"])
        for r in web.online_cancel_events(events, subs, known, product, d).collect()
    ]
    assert got(day(3)) == [("s1", 0, 1)]
    assert got(day(-9)) == [("s1", 1, 0)]  # clamped to the experiment start
