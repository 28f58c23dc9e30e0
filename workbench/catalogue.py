"""One query per operator, over the derived retention tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast.functions import dates, keys, labels, scores
from holdfast.operators import (
    account_bitmaps,
    bootstrap,
    cardinality,
    charts,
    contacts,
    distribution,
    outcome,
    population,
    profile,
    quality,
    quality_state,
    rates,
    revenue,
)
from holdfast.operators.intervals import effective_join
from holdfast.plans import experiment, incremental
from holdfast.schemas import CALL_CENTER
from holdfast.sources import cohort, loads, tables, versions, web
from holdfast.sources.tables import scratch_path, stage
from workbench.adapter import (
    CUTOFF,
    MARKET_RULES,
    MARKETS,
    OVERRIDES,
    RUN_DATE,
    START,
    WEEK,
    Views,
)

METRICS = list(population.METRICS)
SEGMENTS = list(population.SEGMENT_FIELDS)
TOP = 8
BOOTSTRAP = 2000

EVENT_TYPES = ("view", "click", "purchase", "signup", "error")

_QUERIES: dict[str, Callable[[Views], DataFrame]] = {}


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, so both engines print the same value."""
    return df.select(
        *[
            F.round(F.col(f"`{name}`"), digits).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def printable_ints(df: DataFrame, *names: str) -> DataFrame:
    """Integer columns with missing values as doubles: result readers disagree on
    how to show a missing integer, not on a missing double."""
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, path: build(Views(spark, path))

    return {name: bind(build) for name, build in _QUERIES.items()}


# --- sources and sinks ----------------------------------------------------------


@query
def s1_scan_projection(v: Views) -> DataFrame:
    return tables.scan(
        v.spark, f"{v.path}/customer.parquet", ["c_custkey", "c_name", "c_mktsegment"]
    )


@query
def s2_run_date_query(v: Views) -> DataFrame:
    sql = """select event_type, count(*) as n from {events}
             where event_date >= :run_date group by event_type"""
    return tables.run_query(v.spark, sql, RUN_DATE, events=v.events)


def _call_rows(v: Views, kind: str) -> DataFrame:
    return v.events.where(F.col("event_type") == kind).selectExpr(
        "concat('Customer#', user_id) as Account",
        "cast(10 * user_id as string) as idSubscrip",
        "event_date",
        "k % 2 as Saves__Digital_to_Digital_",
    )


@query
def s3_csv_append(v: Views) -> DataFrame:
    base = scratch_path(v.spark, "s3")
    for kind in EVENT_TYPES:
        tables.export_csv(_call_rows(v, kind), f"{base}/csv/{kind}")
        tables.append_csv(v.spark, f"{base}/csv/{kind}", CALL_CENTER, f"{base}/table")
    return v.spark.read.parquet(f"{base}/table")


@query
def s3_exactly_once_load(v: Views) -> DataFrame:
    """Files come one by one, two kinds of them malformed; every call sees the whole folder."""
    base = scratch_path(v.spark, "s3")
    for kind in EVENT_TYPES:
        rows = _call_rows(v, kind)
        if kind == "error":
            rows = rows.withColumn("event_date", F.date_format("event_date", "'day' D"))
        if kind == "signup":
            rows = rows.withColumn("one_too_many", F.lit("x"))
        tables.export_csv(rows, f"{base}/csv/{kind}")
        for _ in range(2):
            loads.load_files(v.spark, f"{base}/csv", CALL_CENTER, f"{base}/table")
    good = loads.read(v.spark, f"{base}/table", CALL_CENTER)
    bad = loads.quarantine(v.spark, f"{base}/table", CALL_CENTER)
    return good.select("Account", "event_date", F.lit(False).alias("quarantined")).unionByName(
        bad.select(F.split("line", ",")[0].alias("Account"), F.lit(None).cast("date").alias("event_date"), F.lit(True).alias("quarantined"))
    )


@query
def s4_versioned_table(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "s4")
    versions.replace_table(v.applied, path, "first")
    versions.replace_table(v.applied.where("modeltype = 'PCHURN'"), path, "second")
    versions.replace_table(v.applied, path, "first")  # a late retry: nothing happens
    return versions.read(v.spark, path, v.applied.schema)


@query
def s4_replace_table(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "s4")
    tables.replace_table(v.applied, path)
    tables.replace_table(v.applied.where("modeltype = 'PCHURN'"), path)
    return v.spark.read.parquet(path)


def _daily(v: Views) -> DataFrame:
    return v.events.groupBy("event_date", "user_id").agg(F.count("*").alias("n"))


def _loaded(v: Views, name: str) -> str:
    """The daily table as an incremental run finds it, loaded up to the run date."""
    return _partitioned(v, name, _daily(v).where(F.col("event_date") <= F.lit(RUN_DATE)))


def _partitioned(v: Views, name: str, daily: DataFrame) -> str:
    path = scratch_path(v.spark, name)
    daily.write.partitionBy("event_date").parquet(path)
    return path


@query
def s5_replace_partition(v: Views) -> DataFrame:
    path, day = _loaded(v, "s5"), dt.date(2024, 1, 5)
    one = _daily(v).where(F.col("event_date") == F.lit(day))
    tables.replace_partition(one.where("n > 1"), path, "event_date", day)
    empty_day = dt.date(2024, 1, 6)
    none = _daily(v).where(F.col("event_date") == F.lit(empty_day)).where("n < 0")
    tables.replace_partition(none, path, "event_date", empty_day)
    return v.spark.read.parquet(path).select("event_date", "user_id", "n")


@query
def s5_versioned_partitions(v: Views) -> DataFrame:
    path, days = scratch_path(v.spark, "s5"), [dt.date(2024, 1, d) for d in range(3, 8)]
    daily = stage(_daily(v), "daily")
    of = lambda day: daily.where(F.col("event_date") == F.lit(day))
    for day in days:
        versions.replace_partition(of(day), path, "event_date", day, "load")
    versions.replace_partition(of(days[1]).where("n > 1"), path, "event_date", days[1], "again")
    versions.replace_partition(of(days[2]).where("n < 0"), path, "event_date", days[2], "again")
    versions.replace_partition(of(days[3]).where("n < 0"), path, "event_date", days[3], "again")
    versions.roll_back(v.spark, path, "event_date", days[3], "load")
    return versions.read(v.spark, path, daily.schema, "event_date")


@query
def s6_latest_partition(v: Views) -> DataFrame:
    path = _partitioned(v, "s6", _daily(v))
    latest = tables.latest_partition(v.spark, path, "event_date")
    absent = tables.latest_partition(v.spark, f"{path}-absent", "event_date")
    return v.spark.createDataFrame([(latest, absent)], "latest date, absent date")


@query
def s7_snapshot_partition(v: Views) -> DataFrame:
    path, day = _partitioned(v, "s7", _daily(v)), dt.date(2024, 1, 5)
    copy = tables.snapshot(v.spark, path, "event_date", day, f"{path}-copy.parquet")
    return v.spark.read.parquet(copy).select("event_date", "user_id", "n")


@query
def s8_read_snapshot(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "s8")
    tables.replace_table(_daily(v), path)
    copy = tables.snapshot(v.spark, path, None, None, f"{path}-copy.csv")
    return tables.read_snapshot(v.spark, copy).selectExpr(
        "event_date", "cast(user_id as bigint) as user_id", "cast(n as bigint) as n"
    )


@query
def s9_run_log(v: Views) -> DataFrame:
    log = scratch_path(v.spark, "s9")
    for kind in EVENT_TYPES:
        measured = quality.table_measures(v.events.where(F.col("event_type") == kind)).first()
        tables.append_run_record(
            v.spark,
            log,
            {"run_date": "2024-01-10", "target_table": "events", "sql_file": f"sql/{kind}.sql",
             **measured.asDict(), "row_count_passed": True, "nulls_passed": True},
        )
    return tidy(tables.load_history(v.spark, log).drop("execution_timestamp"))


@query
def s10_export_csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "s10")
    tables.export_csv(population.funnel(v.labelled), path)
    schema = "population string, accounts bigint, share_of_all_pct double"
    return tidy(v.spark.read.schema(schema).option("header", True).csv(path))


# --- incremental pipeline -------------------------------------------------------


@query
def p1_target_date(v: Views) -> DataFrame:
    return v.events.select(
        "event_date",
        dates.target_date_col("event_date", "exact").alias("exact_date"),
        dates.target_date_col("event_date", "sunday").alias("sunday_date"),
    ).distinct()


@query
def p2_missing_dates(v: Views) -> DataFrame:
    spans = v.events.groupBy("user_id").agg(
        F.min("event_date").alias("first_day"), F.max("event_date").alias("last_day")
    )
    return spans.select(
        "user_id",
        F.explode(dates.missing_dates_col("first_day", "last_day", "sunday")).alias("missing_date"),
    )


@query
def p3_availability(v: Views) -> DataFrame:
    ready = incremental.available(v.risk_source, WEEK).withColumn("day", F.lit(WEEK))
    late = dt.date(2024, 2, 4)
    return ready.unionByName(
        incremental.available(v.risk_source, late).withColumn("day", F.lit(late))
    )


def _target(v: Views, name: str, snapshots: bool = False) -> incremental.Target:
    path = _loaded(v, name)
    return incremental.Target(
        table=path, script=f"sql/{name}.sql", log=f"{path}-log", partition_field="event_date",
        snapshot_folder=f"{path}-snapshots" if snapshots else None,
    )


@query
def p4_catch_up_dates(v: Views) -> DataFrame:
    days, _ = incremental.dates_to_run(
        v.spark, dt.date(2024, 1, 15), "exact", _target(v, "p4"), catch_up=True
    )
    return v.spark.createDataFrame([(d,) for d in days], "day date")


def _one_day(v: Views) -> incremental.Query:
    def build(_: SparkSession, day: dt.date) -> DataFrame:
        rows = _daily(v).where(F.col("event_date") == F.lit(day))
        if day.day == 13:
            raise RuntimeError("source unavailable")
        if day.day == 15:
            raise RuntimeError()
        return rows

    return build


@query
def p5_error_isolation(v: Views) -> DataFrame:
    days = [dt.date(2024, 1, d) for d in range(11, 17)]
    status = incremental.run(v.spark, _one_day(v), _target(v, "p5"), days)
    return printable_ints(status.select("run_date", "ok", "rows", "error"), "rows")


@query
def p5_side_by_side(v: Views) -> DataFrame:
    days = [dt.date(2024, 1, d) for d in range(11, 17)]
    target = incremental.Target(
        table=scratch_path(v.spark, "p5"), script="sql/daily.sql", log=scratch_path(v.spark, "log"),
        partition_field="event_date", versioned=True,
    )
    status = incremental.run_side_by_side(v.spark, _one_day(v), target, days, workers=3)
    return printable_ints(status.select("run_date", "ok", "rows", "error"), "rows")


@query
def p6_extract_date(v: Views) -> DataFrame:
    target = _target(v, "p6", snapshots=True)
    path, _ = incremental.extract(v.spark, _one_day(v), dt.date(2024, 1, 11), target)
    return tables.read_snapshot(v.spark, path).select("event_date", "user_id", "n")


@query
def p7_log_only(v: Views) -> DataFrame:
    target = _target(v, "p7")
    incremental.run(v.spark, _one_day(v), target, [dt.date(2024, 1, 11), dt.date(2024, 1, 12)])
    history = tables.load_history(v.spark, target.log)
    return printable_ints(history.select("run_date", "sql_file", "row_count"), "row_count")


@query
def p8_floor_clamp(v: Views) -> DataFrame:
    return v.events.select(
        "event_date", dates.floor_date("event_date", RUN_DATE).alias("clamped")
    ).distinct()


# --- cohort source --------------------------------------------------------------


@query
def r1_market_normalization(v: Views) -> DataFrame:
    named = v.table("customer").selectExpr("c_custkey", "c_mktsegment as publication_name")
    return cohort.normalize_market(named, rules=("Build", "auto"))


@query
def r2_subscription_publication(v: Views) -> DataFrame:
    return cohort.subscription_publications(
        v.subscriptions, v.product, v.publication, MARKET_RULES
    )


@query
def r3_billing_links(v: Views) -> DataFrame:
    return cohort.billing_links(v.link)


@query
def r4_effective_dated_join(v: Views) -> DataFrame:
    facts = v.risk_tiers.select("inference_date", "id_subscrip", "risk_tier")
    versions = v.subscriptions.select(
        "id_subscrip", "effective_date", "end_date", "mdm_product_id"
    )
    return effective_join(facts, versions, ["id_subscrip"], "inference_date")


@query
def r5_week_alignment(v: Views) -> DataFrame:
    return cohort.week_of(v.risk_source, RUN_DATE).select(
        "inference_date", "id_subscrip", "risk_tier"
    )


@query
def r6_market_allow_list(v: Views) -> DataFrame:
    return cohort.in_markets(v.risk_source, ("BUILDING", "MACHINERY")).select(
        "id_subscrip", "market"
    )


@query
def r7_weekly_risk_source(v: Views) -> DataFrame:
    return cohort.weekly_risk_source(
        v.risk_tiers, v.subscriptions, v.product, v.publication, v.link, RUN_DATE, MARKETS,
        MARKET_RULES,
    )


@query
def r8_web_event_flags(v: Views) -> DataFrame:
    return web.flag_events(v.web_events)


@query
def r9_flag_rollup(v: Views) -> DataFrame:
    return web.roll_up_flags(web.flag_events(v.web_events))


@query
def r10_unnest_consumers(v: Views) -> DataFrame:
    return web.subscription_consumers(v.subscriptions)


@query
def r11_unpivot_visitor_ids(v: Views) -> DataFrame:
    return web.consumer_visitors(v.known_consumers)


@query
def r12_identity_map(v: Views) -> DataFrame:
    return web.identity_map(v.subscriptions, v.known_consumers, v.product)


@query
def r13_event_attribution(v: Views) -> DataFrame:
    # Read for the visitors to map and for the attribution; events are scanned once.
    visits = stage(web.roll_up_flags(web.flag_events(v.web_events)), "visits")
    identities = web.identity_map(v.subscriptions, v.known_consumers, v.product, visits)
    return web.attribute_events(visits, identities)


def _cancel_day(v: Views, day: dt.date) -> DataFrame:
    return web.online_cancel_events(
        v.web_events, v.subscriptions, v.known_consumers, v.product, day, RUN_DATE
    )


@query
def r13_cancel_events_of_a_day(v: Views) -> DataFrame:
    return _cancel_day(v, dt.date(2024, 1, 20))


@query
def r13_cancel_events_before_the_start(v: Views) -> DataFrame:
    """A run before the experiment takes the experiment's first day."""
    return _cancel_day(v, dt.date(2024, 1, 2))


# --- cardinality guardrail ------------------------------------------------------


@query
def g1_keys_with_many_children(v: Views) -> DataFrame:
    accounts = v.link.withColumn("account", keys.account_key("billing_account"))
    return cardinality.keys_with_many_children(accounts, ["account"], "circ_idsubscrip")


@query
def g2_violations_by_model(v: Views) -> DataFrame:
    return cardinality.account_violations(v.applied, v.link, v.risk_source)


@query
def g3_verdict(v: Views) -> DataFrame:
    return cardinality.verdict(cardinality.account_violations(v.applied, v.link, v.risk_source))


# --- outcome table --------------------------------------------------------------


def _assigned(v: Views) -> DataFrame:
    return outcome.clean_assignments(v.applied, OVERRIDES)


def _linked(v: Views) -> DataFrame:
    return v.linked


def _base(v: Views) -> DataFrame:
    return outcome.assemble_days(_linked(v), v.days, v.start_stop)


def _classified(v: Views) -> DataFrame:
    return outcome.classify(outcome.derive_contacts(_base(v)))


def _outcomes(v: Views) -> DataFrame:
    return v.outcomes


@query
def e1_clean_assignments(v: Views) -> DataFrame:
    return tidy(_assigned(v))


@query
def e2_inference_date(v: Views) -> DataFrame:
    return v.applied.select(
        keys.account_key("subscription").alias("billing_account"),
        "filedate",
        dates.inference_date("filedate", OVERRIDES).alias("inference_date"),
    )


@query
def e3_email_date(v: Views) -> DataFrame:
    return v.risk_tiers.select(
        "id_subscrip", dates.email_date("inference_date").alias("email_date")
    )


@query
def e4_link_subscriptions(v: Views) -> DataFrame:
    return tidy(outcome.link_subscriptions(_assigned(v), v.link, v.risk_source))


@query
def e5_first_calls(v: Views) -> DataFrame:
    return outcome.first_calls(_linked(v), v.calls)


@query
def e5_first_calls_strict(v: Views) -> DataFrame:
    return outcome.first_calls(_linked(v), v.calls, strict_subscription=True)


@query
def e6_first_online(v: Views) -> DataFrame:
    return outcome.first_online(_linked(v), v.online)


@query
def e7_permanent_stops(v: Views) -> DataFrame:
    columns = ["billing_account", "id_subscrip", "email_date"]
    stops = outcome.attach_stops(_linked(v).select(*columns), v.start_stop)
    return printable_ints(stops, "perm_stoped")


@query
def e8_base_assembly(v: Views) -> DataFrame:
    return tidy(_base(v))


@query
def e9_contact_channel(v: Views) -> DataFrame:
    return outcome.derive_contacts(_base(v)).select(
        "billing_account", "id_subscrip", "email_date", "perm_stop_date", "contact_channel"
    )


@query
def e10_earliest_dates(v: Views) -> DataFrame:
    return outcome.derive_contacts(_base(v)).select(
        "billing_account", "id_subscrip", "email_date", "perm_stop_date",
        "__earlist_contact_date", "__earlist_cancel_date",
    )


@query
def e11_status(v: Views) -> DataFrame:
    return _classified(v).groupBy("cohort", "Treatment", "status").agg(F.count("*").alias("n"))


@query
def e12_churn_label(v: Views) -> DataFrame:
    labelled = _classified(v).select("billing_account", "id_subscrip", "perm_stop_date", "churned")
    return printable_ints(labelled, "churned")


@query
def e13_contact_timing(v: Views) -> DataFrame:
    return _classified(v).groupBy("contact_timing", "status").agg(F.count("*").alias("n"))


@query
def e14_tier_and_metrics(v: Views) -> DataFrame:
    assigned = _linked(v).select("billing_account", "id_subscrip", "inference_date")
    return tidy(outcome.attach_behaviour(assigned, v.risk_source, v.features))


@query
def e15_outcome_table(v: Views) -> DataFrame:
    table = outcome.attach_behaviour(_classified(v), v.risk_source, v.features)
    return printable_ints(tidy(table), "churned")


# --- revenue --------------------------------------------------------------------


def _facts(v: Views) -> DataFrame:
    return revenue.payment_facts(v.payments, START)


def _flagged(v: Views) -> DataFrame:
    population_rows = revenue.evaluable(_outcomes(v))
    return revenue.flag_payments(revenue.qualifying_payments(population_rows, _facts(v)))


def _attached(v: Views) -> DataFrame:
    return revenue.attach_revenue(
        revenue.evaluable(_outcomes(v)), revenue.account_revenue(_flagged(v))
    )


@query
def m1_payment_status(v: Views) -> DataFrame:
    return revenue.settle_payments(v.payments).select("invoice_number", "payment_status")


@query
def m2_payment_facts(v: Views) -> DataFrame:
    return tidy(_facts(v))


@query
def m3_evaluable(v: Views) -> DataFrame:
    return revenue.evaluable(_outcomes(v)).select(
        "billing_account", "id_subscrip", "perm_stop_date", "churned", "treatment_plus_tier"
    )


@query
def m4_qualifying_payments(v: Views) -> DataFrame:
    qualifying = revenue.qualifying_payments(revenue.evaluable(_outcomes(v)), _facts(v))
    return tidy(
        qualifying.select(
            "billing_account", "id_subscrip", "id_payment_date", "billing_amount", "payments"
        )
    )


@query
def m5_payment_flags(v: Views) -> DataFrame:
    return tidy(
        _flagged(v).select(
            "billing_account", "id_subscrip", "id_payment_date", "billing_amount",
            "bill_amount_save_once", "repeatedly_called", "skpi_gap_wip",
        )
    )


@query
def m6_account_revenue(v: Views) -> DataFrame:
    return tidy(revenue.account_revenue(_flagged(v)))


@query
def m7_attach_revenue(v: Views) -> DataFrame:
    return tidy(_attached(v))


@query
def m8_exclude_rate_gap(v: Views) -> DataFrame:
    return tidy(
        revenue.exclude_rate_gap(_attached(v)).select(
            "billing_account", "id_subscrip", "churned", "tt_paid_raw", "skpi_gap_wip"
        )
    )


@query
def m9_revenue_table(v: Views) -> DataFrame:
    return tidy(experiment.revenue_outcomes(v.tables, _outcomes(v), START))


@query
def m10_churn_rate(v: Views) -> DataFrame:
    return tidy(revenue.churn_rate(_outcomes(v)))


@query
def m11_cnrc(v: Views) -> DataFrame:
    return tidy(revenue.cnrc(_outcomes(v), _facts(v)))


@query
def m11_cnrc_by_tier(v: Views) -> DataFrame:
    return tidy(
        revenue.cnrc(_outcomes(v), _facts(v), by=[*revenue.STRATEGY, "src_risk_tier"])
    )


# --- contact history and rates --------------------------------------------------


def _contacts(v: Views) -> DataFrame:
    return contacts.contact_events(_linked(v), v.calls, v.online)


def _steps(v: Views) -> DataFrame:
    return contacts.contact_steps(contacts.contact_sequence(_contacts(v)))


def _printable(df: DataFrame) -> DataFrame:
    joined = F.concat_ws(",", F.col("contact_date").cast("array<string>"))
    return df.withColumn(
        "contact_date", F.when(F.col("contact_date").isNotNull(), joined)
    )


@query
def c1_call_days(v: Views) -> DataFrame:
    return contacts.call_days(_linked(v), v.calls)


@query
def c2_page_days(v: Views) -> DataFrame:
    return contacts.page_days(_linked(v), v.online)


@query
def c3_contact_events(v: Views) -> DataFrame:
    return _contacts(v)


@query
def c4_contact_sequence(v: Views) -> DataFrame:
    return contacts.contact_sequence(_contacts(v))


@query
def c5_ordinal_label(v: Views) -> DataFrame:
    # Ranks well beyond nine: every event day of every user.
    days = v.events.selectExpr(
        "cast(user_id as string) as billing_account", "event_type as id_subscrip", "event_date"
    ).distinct()
    return contacts.contact_sequence(days).withColumn(
        "contact_order", labels.ordinal("rank_num")
    )


@query
def c6_contact_steps(v: Views) -> DataFrame:
    return _printable(_steps(v))


@query
def c7_contact_history(v: Views) -> DataFrame:
    history = experiment.contact_history(v.tables, _linked(v), _outcomes(v), days=v.days)
    return printable_ints(tidy(_printable(history)), "churned")


def _rate_links(v: Views) -> DataFrame:
    return rates.rate_links(v.subscriptions, v.link, v.product, v.publication, "ASIA")


def _rated(v: Views) -> DataFrame:
    accounts = rates.earliest_cancels(_outcomes(v)).distinct().join(
        _rate_links(v), "billing_account"
    )
    return rates.attach_rates(accounts, v.rates)


@query
def a1_rate_links(v: Views) -> DataFrame:
    return _rate_links(v)


@query
def a2_earliest_cancel(v: Views) -> DataFrame:
    return tidy(rates.earliest_cancels(_outcomes(v)))


@query
def a3_rate_history_attach(v: Views) -> DataFrame:
    return _rated(v).select(
        "billing_account", "id_subscrip", "email_date", "effective_date", "end_date",
        "rate_key_value", "rate_key_system",
    )


@query
def a4_rate_key_mapping(v: Views) -> DataFrame:
    return rates.map_rate_keys(v.rates, v.rate_mapping).select(
        "id_subscrip", "effective_date", "rate_key_value", "rate_key_system", "monthly_price"
    )


@query
def a5_month_cost(v: Views) -> DataFrame:
    return tidy(rates.rate_history(_outcomes(v), _rate_links(v), v.rates, v.rate_mapping))


# --- data quality ---------------------------------------------------------------


@query
def q1_null_percentage(v: Views) -> DataFrame:
    return tidy(quality.table_measures(v.labelled).select("null_percentage"), 6)


@query
def q1_nan_percentage(v: Views) -> DataFrame:
    """Small frequencies as NaN: missing, like nulls."""
    low = F.when(F.col("frequency") < 20, F.lit(float("nan"))).otherwise(F.col("frequency"))
    rows = v.labelled.select("billing_account", low.alias("frequency"))
    return tidy(quality.table_measures(rows).select("null_percentage"), 6)


@query
def q2_row_count(v: Views) -> DataFrame:
    return quality.table_measures(v.labelled).select("row_count")


@query
def q3_history_baseline(v: Views) -> DataFrame:
    return tidy(quality.history_baseline(v.run_log, "click.sql"))


@query
def q4_deviation_verdicts(v: Views) -> DataFrame:
    baselines = (
        v.run_log.where("row_count is not null")
        .groupBy("sql_file")
        .agg(F.avg("row_count").alias("average"))
    )
    return v.run_log.join(baselines, "sql_file").select(
        "sql_file", "run_date", quality.within_deviation("row_count", "average").alias("passed")
    )


@query
def q5_assessment_record(v: Views) -> DataFrame:
    log = scratch_path(v.spark, "log")
    v.run_log.write.json(log)
    for kind in EVENT_TYPES:
        target = incremental.Target(table=scratch_path(v.spark, "q5"), script=f"{kind}.sql", log=log)
        tables.replace_table(v.events.where(F.col("event_type") == kind), target.table)
        path = tables.snapshot(v.spark, target.table, None, None, f"{target.table}.csv")
        incremental.assess_snapshot(v.spark, path, RUN_DATE, target)
    return tidy(
        tables.load_history(v.spark, log)
        .where("target_table <> 'runs'")
        .select(
            "run_date", "sql_file", "row_count", "null_percentage", "row_count_passed",
            "nulls_passed",
        )
    )


@query
def q6_key_contract(v: Views) -> DataFrame:
    return quality.key_violations(v.events, "user_id")


def _measured_weeks(v: Views) -> tuple[StructType, str]:
    """Events by week with their quality state; then the first week is replaced, and only it is measured again."""
    base = scratch_path(v.spark, "q_state")
    weeks = stage(v.events.withColumn("week", F.trunc("event_date", "week")), "weeks")
    days = [r["week"] for r in weeks.select("week").distinct().orderBy("week").collect()]  # a row a week
    for day in days:
        versions.replace_partition(weeks.where(F.col("week") == F.lit(day)), f"{base}/table", "week", day, "load")
    quality_state.refresh(v.spark, f"{base}/table", weeks.schema, "week", f"{base}/state", ["user_id"])
    kept = weeks.where(F.col("week") == F.lit(days[0])).where("event_id % 2 = 0")
    versions.replace_partition(kept, f"{base}/table", "week", days[0], "again")
    quality_state.refresh(v.spark, f"{base}/table", weeks.schema, "week", f"{base}/state", ["user_id"])
    return weeks.schema, f"{base}/state"


@query
def q1_merged_measures(v: Views) -> DataFrame:
    schema, state = _measured_weeks(v)
    return tidy(quality_state.merged_measures(v.spark, schema, "week", state), 6)


@query
def q6_merged_key_contract(v: Views) -> DataFrame:
    schema, state = _measured_weeks(v)
    return quality_state.merged_violations(v.spark, schema, "week", state, ["user_id"])


@query
def q7_metric_coverage(v: Views) -> DataFrame:
    return quality.metric_coverage(v.analysis, METRICS)


# --- behavioural analysis -------------------------------------------------------


def _reference(v: Views) -> DataFrame:
    return stage(profile.reference_from_counts(v.analysis_counts, METRICS), "reference")


def _profiles(v: Views, reference: DataFrame) -> DataFrame:
    return profile.behavior_profiles(
        v.staged_analysis, reference, METRICS, counts=v.analysis_counts
    )


def _contrasts(v: Views, reference: DataFrame) -> DataFrame:
    return stage(profile.outcome_contrasts(_profiles(v, reference), METRICS), "contrasts")


def _treatments(v: Views, reference: DataFrame) -> DataFrame:
    return stage(
        profile.treatment_contrasts(
            v.staged_analysis, _contrasts(v, reference), reference, METRICS,
            counts=v.analysis_counts,
        ),
        "treatments",
    )


@query
def d1_label_population(v: Views) -> DataFrame:
    return v.labelled.select(
        "billing_account", "contact_channel_group", "likely_discount_shopper", "outcome",
        "src_risk_tier", "email_date",
    )


@query
def d2_population_split(v: Views) -> DataFrame:
    names = ["no_action", "contacted", "gamer", "analysis", "saved", "stopped"]
    return v.labelled.select(
        "billing_account", *[population.members(n).alias(n) for n in names]
    )


@query
def d3_funnel(v: Views) -> DataFrame:
    return tidy(population.funnel(v.labelled))


@query
def d3_funnel_from_daily_bitmaps(v: Views) -> DataFrame:
    """Accounts are numbered in two runs; bitmaps of days add up to the funnel of all."""
    path = tables.scratch_path(v.labelled.sparkSession, "account_numbers")
    account_bitmaps.register_accounts(v.labelled.where(F.dayofmonth("email_date") <= 15), path, 1)
    numbers = account_bitmaps.register_accounts(v.labelled, path, 2)
    return tidy(account_bitmaps.funnel_of_bitmaps(account_bitmaps.funnel_bitmaps(v.labelled, numbers, ["email_date"])))


@query
def d6_segment_accounts_from_bitmaps(v: Views) -> DataFrame:
    """Distinct accounts per segment, rolled up from bitmaps of segments and days."""
    path = tables.scratch_path(v.labelled.sparkSession, "account_numbers")
    numbers = account_bitmaps.register_accounts(v.labelled, path, 1)
    daily = account_bitmaps.account_bitmaps(v.labelled, numbers, ["cohort", "contact_channel_group", "email_date"])
    return account_bitmaps.distinct_accounts(daily, ["cohort", "contact_channel_group"])


@query
def d4_distribution_summary(v: Views) -> DataFrame:
    return tidy(distribution.distribution_summary(v.labelled, METRICS))


@query
def d5_population_summaries(v: Views) -> DataFrame:
    populations = {title: population.members(n) for title, n in population.CONTEXT_POPULATIONS}
    return tidy(distribution.population_summaries(v.labelled, METRICS, populations))


@query
def d5_repeated_call_summary(v: Views) -> DataFrame:
    contacted = population.subset(v.labelled, "contacted")
    return tidy(
        distribution.distribution_summary(contacted, METRICS, ["likely_discount_shopper"])
    )


@query
def d6_segment_summary(v: Views) -> DataFrame:
    return tidy(distribution.segment_summary(v.analysis, "src_risk_tier", METRICS))


@query
def d7_segment_summaries(v: Views) -> DataFrame:
    return tidy(
        distribution.segment_summaries(v.analysis, list(population.SUMMARY_FIELDS), METRICS)
    )


@query
def d8_behavior_reference(v: Views) -> DataFrame:
    return tidy(profile.fit_reference(v.analysis, METRICS), 6)


@query
def d9_clipped_metrics(v: Views) -> DataFrame:
    clipped = profile.clip_metrics(v.staged_analysis, METRICS, _reference(v))
    return tidy(clipped.select("billing_account", *METRICS))


@query
def d10_robust_scores(v: Views) -> DataFrame:
    scored = profile.score_metrics(v.staged_analysis, METRICS, _reference(v))
    return tidy(scored.select("billing_account", *METRICS), 6)


@query
def d11_segment_label(v: Views) -> DataFrame:
    return v.analysis.select(
        "billing_account", labels.segment_label(["outcome", *SEGMENTS]).alias("segment_label")
    )


@query
def d12_vector_magnitude(v: Views) -> DataFrame:
    return tidy(
        v.labelled.select(
            "billing_account",
            scores.magnitude([F.col(m) for m in METRICS]).alias("magnitude"),
        ),
        6,
    )


@query
def d13_dominant_metric(v: Views) -> DataFrame:
    named = {
        "frequency": F.col("frequency") - 46,
        "breadth": (F.col("breadth") - 4) * 10,
        "tenure": (F.col("tenure") - 1200) / 30,
        "tt_cost": (F.col("tt_cost") - 150000) / 4000,
    }
    return v.labelled.select("billing_account", scores.dominant(named).alias("dominant_metric"))


@query
def d14_segment_match(v: Views) -> DataFrame:
    saved = v.analysis.where(F.col("outcome") == labels.SAVED).select(*SEGMENTS).distinct()
    return profile.match_segments(v.analysis, saved, SEGMENTS).select(
        "billing_account", *SEGMENTS
    )


@query
def d15_behavior_profiles(v: Views) -> DataFrame:
    return tidy(_profiles(v, _reference(v)), 6)


@query
def d16_outcome_contrasts(v: Views) -> DataFrame:
    return tidy(profile.outcome_contrasts(_profiles(v, _reference(v)), METRICS), 6)


@query
def d17_treatment_contrasts(v: Views) -> DataFrame:
    reference = _reference(v)
    treatments = profile.treatment_contrasts(
        v.staged_analysis, _contrasts(v, reference), reference, METRICS, counts=v.analysis_counts
    )
    return tidy(treatments, 6)


@query
def d18_segment_details(v: Views) -> DataFrame:
    reference = _reference(v)
    details = profile.segment_details(
        v.staged_analysis, _treatments(v, reference), reference, METRICS, [*SEGMENTS, "Treatment"],
        30, bootstrap_iterations=BOOTSTRAP, counts=v.analysis_counts,
    )
    return tidy(details, 6)


@query
def d19_bootstrap_intervals(v: Views) -> DataFrame:
    reference = _reference(v)
    selected = profile.top_segments(_contrasts(v, reference), TOP).select("segment_rank", *SEGMENTS)
    counts = v.analysis_counts.map(lambda rows: profile.match_segments(rows, selected, SEGMENTS))
    return tidy(
        bootstrap.median_difference_intervals(
            counts, ["segment_rank"], reference, BOOTSTRAP, 0.95, seed=42
        ),
        6,
    )


# --- from the revenue table on ---------------------------------------------------


def _notebook_population(v: Views) -> DataFrame:
    """The revenue table, labelled as the analysis reads it."""
    return stage(population.label_population(experiment.revenue_outcomes(v.tables, _outcomes(v), START), CUTOFF))


@query
def chain_funnel(v: Views) -> DataFrame:
    return tidy(population.funnel(_notebook_population(v)))


@query
def chain_behavior_profiles(v: Views) -> DataFrame:
    contacted = population.subset(_notebook_population(v), "contacted")
    reference = stage(profile.fit_reference(contacted, METRICS), "reference")
    return tidy(profile.behavior_profiles(contacted, reference, METRICS, min_n=2), 6)


# --- chart data -----------------------------------------------------------------


@query
def v1_three_scales(v: Views) -> DataFrame:
    return tidy(charts.three_scales(v.analysis, "outcome", list(labels.OUTCOMES), METRICS))


@query
def v1_group_accounts(v: Views) -> DataFrame:
    return charts.group_accounts(v.analysis, "outcome", list(labels.OUTCOMES))


@query
def v2_box_statistics(v: Views) -> DataFrame:
    groups = [labels.PAY_LESS, labels.BOTH_WAYS, "Other"]
    contacted = population.subset(v.labelled, "contacted")
    return tidy(charts.box_statistics(contacted, "likely_discount_shopper", groups, METRICS))


@query
def v3_profile_heatmap(v: Views) -> DataFrame:
    return tidy(charts.heatmap(_profiles(v, _reference(v)), "profile", METRICS, 30), 6)


@query
def v3_contrast_heatmap(v: Views) -> DataFrame:
    contrasts = profile.outcome_contrasts(_profiles(v, _reference(v)), METRICS)
    return tidy(charts.heatmap(contrasts, "contrast", METRICS, 20), 6)


@query
def v4_contrast_panels(v: Views) -> DataFrame:
    reference = _reference(v)
    return tidy(
        charts.contrast_panels(v.staged_analysis, _contrasts(v, reference), reference, METRICS, SEGMENTS, TOP)
    )


@query
def v4_treatment_panel_accounts(v: Views) -> DataFrame:
    treatments = _treatments(v, _reference(v)).where("supported")
    return charts.panel_accounts(v.staged_analysis, treatments, [*SEGMENTS, "Treatment"], TOP)


@query
def v5_clipped_panels(v: Views) -> DataFrame:
    reference = _reference(v)
    return tidy(
        charts.clipped_panels(v.staged_analysis, _contrasts(v, reference), reference, METRICS, SEGMENTS, TOP)
    )


@query
def v6_journey_stages(v: Views) -> DataFrame:
    return charts.journey_stages(_outcomes(v))


@query
def v7_journey_links(v: Views) -> DataFrame:
    return charts.journey_links(charts.journey_stages(_outcomes(v)))


@query
def v8_journey_index(v: Views) -> DataFrame:
    links = stage(charts.journey_links(charts.journey_stages(_outcomes(v))))
    return charts.index_links(links, charts.journey_nodes(links))
