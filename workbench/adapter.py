"""Retention tables derived from the driver's test tables.

Every view is plain arithmetic on the given tables, which the oracle SQL repeats.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.functions.dates import inference_date
from holdfast.operators.population import label_population, subset
from holdfast.operators.profile import population_counts
from holdfast.operators.quantiles import BinnedCounts
from holdfast.operators.outcome import ContactDays
from holdfast.plans.experiment import ExperimentTables, contact_days, linked_assignments, outcomes
from holdfast.sources.tables import stage

OVERRIDES = {dt.date(2024, 1, 17): dt.date(2024, 1, 7)}
RUN_DATE = dt.date(2024, 1, 10)
WEEK = dt.date(2024, 1, 7)
START = dt.date(2024, 1, 1)
CUTOFF = dt.date(2024, 6, 1)
MARKETS = ("AFRICA", "Amer", "EUROPE")
MARKET_RULES = ("Amer", "east")


class Views:
    """The derived tables of one data directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as k",
            "c_name",
            "c_acctbal",
            "c_mktsegment",
            "cast(10 + c_custkey % 40 as double) as rate",
            "date_add(date '2024-01-03', cast(7 * (c_custkey % 3) as int)) as filedate",
        ).withColumn("inference_date", inference_date("filedate", OVERRIDES))

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            "user_id",
            "event_type",
            "cast(ts as date) as event_date",
            "cast(get_json_object(props, '$.k') as int) as k",
        )

    @cached_property
    def applied(self) -> DataFrame:
        return self.customers.selectExpr(
            "concat('  ', upper(c_name), ' ') as subscription",
            "rate as currentrate",
            "rate * 1.25D as newrate",
            "rate * 0.75D as stopsave",
            "date_add(filedate, 14) as effective",
            "if(k % 2 = 0, 'PCHURN', 'MIDPOINT') as modeltype",
            """case when k % 2 = 0 then
                 case k % 6 when 0 then 'MIDPOINT' when 2 then 'CONTROL' else 'RISK1' end
               else if(k % 4 = 1, 'MIDPOINT', 'CONTROL') end as grouptype""",
            "filedate",
        )

    @cached_property
    def link(self) -> DataFrame:
        return self.customers.selectExpr(
            "c_name", "k", "c_mktsegment",
            "explode(if(k % 50 = 0, array(10 * k, 10 * k + 1), array(10 * k))) as sub",
        ).selectExpr(
            "cast(sub as string) as circ_idsubscrip",
            "concat(' ', c_name) as billing_account",
            "if(k % 97 = 0, 'OTHER', 'ZUORA') as billing_system",
            "if(k % 13 = 0, 'Inactive', 'Active') as circ_status",
            "if(k % 31 = 0, 'PLAY', 'MAIN') as circ_site",
            "c_mktsegment as product_type",
        )

    @cached_property
    def risk_tiers(self) -> DataFrame:
        return self.customers.selectExpr(
            "inference_date",
            "cast(10 * k as string) as id_subscrip",
            """case when c_acctbal < 0 then '5. High' when c_acctbal < 2500 then '4. Med-High'
                    when c_acctbal < 5000 then '3. Medium' when c_acctbal < 7500 then '2. Med-Low'
                    else '1. Low' end as risk_tier""",
            "k",
            "c_name",
            "c_mktsegment",
        )

    @cached_property
    def risk_source(self) -> DataFrame:
        """Shape of the weekly cohort; some accounts hold two subscriptions."""
        return self.risk_tiers.selectExpr(
            "inference_date",
            "concat(c_name, '  ') as billing_account",
            "explode(if(k % 100 = 0, array(10 * k, 10 * k + 1), array(10 * k))) as sub",
            "risk_tier",
            "c_mktsegment as market",
            "c_mktsegment as publication_name",
        ).selectExpr(
            "inference_date", "billing_account", "cast(sub as string) as id_subscrip",
            "risk_tier", "market", "publication_name",
        )

    @cached_property
    def product(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "cast(n_nationkey as string) as product_id",
            "cast(n_regionkey as string) as publication_id",
            "concat('site-', n_regionkey) as website_id",
        )

    @cached_property
    def publication(self) -> DataFrame:
        return self.table("region").selectExpr(
            "cast(r_regionkey as string) as publication_id", "r_name as publication_name"
        )

    @cached_property
    def subscriptions(self) -> DataFrame:
        """Effective-dated versions: each order starts one and ends the one before."""
        versions = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
        return (
            self.table("orders")
            .select("o_custkey", "o_orderkey", "o_orderdate")
            .withColumn("following", F.lead("o_orderdate").over(versions))
            .selectExpr(
                "cast(10 * o_custkey as string) as id_subscrip",
                "date_add(cast(o_orderdate as date), 8401) as effective_date",
                "coalesce(date_add(cast(following as date), 8400), date '9999-12-31') as end_date",
                "cast(o_orderkey % 25 as string) as mdm_product_id",
                """if(o_custkey % 3 = 0,
                      array(concat('c', o_custkey), concat('d', o_custkey)),
                      array(concat('c', o_custkey))) as consumer_ids""",
            )
        )

    @cached_property
    def known_consumers(self) -> DataFrame:
        return self.customers.selectExpr(
            "concat('c', k) as consumer_id",
            "concat('a', k) as anonymous_id_1",
            "if(k % 4 = 0, null, concat('b', k)) as anonymous_id_2",
            "if(k % 5 = 0, concat('e', k), null) as anonymous_id_3",
        )

    @cached_property
    def web_events(self) -> DataFrame:
        return self.events.selectExpr(
            "event_date",
            "concat(case event_id % 3 when 0 then 'a' when 1 then 'b' else 'e' end, user_id)"
            " as d049_user_anonymous_id",
            "concat('site-', event_id % 5) as d031_website_id",
            """case when k = 99 then null
                    when event_type = 'click' then 'ManageSubscription|Cancel'
                    when event_type = 'purchase' then
                      if(k % 2 = 1, 'snap|cancelsubscription|winback-zuora', 'snap|CancelSubscription')
                    when event_type = 'signup' then 'StopSave|success'
                    else 'page_view' end as d027_event_detail""",
        )

    @cached_property
    def calls(self) -> DataFrame:
        # Most calls are of a year before the experiment, so few accounts count as contacted.
        return self.events.where("event_type = 'view'").selectExpr(
            "concat(' CUSTOMER#', lpad(cast(user_id as string), 9, '0')) as Account",
            "cast(10 * user_id + if(event_id % 4 = 0 and user_id % 50 = 0, 1, 0) as string)"
            " as idSubscrip",
            "if(k < 6, event_date, date_sub(event_date, 365)) as event_date",
            "k % 2 as Saves__Digital_to_Digital_",
        )

    @cached_property
    def online(self) -> DataFrame:
        opened, confirmed = "event_type = 'click'", "event_type = 'purchase'"
        recent = "k < if(event_type = 'click', 6, 3)"
        return self.events.where(f"({opened}) or ({confirmed})").selectExpr(
            f"if({recent}, event_date, date_sub(event_date, 365)) as event_date",
            "cast(10 * user_id as string) as id_subscrip",
            f"if({opened}, 1, 0) as entered_acc_mng",
            f"if({confirmed}, 1, 0) as confirmed_cancel",
        )

    @cached_property
    def start_stop(self) -> DataFrame:
        return self.events.where("event_type = 'error'").selectExpr(
            "cast(10 * user_id as string) as id_subscrip",
            "date_add(event_date, 7) as transaction_date",
            "event_date as create_date",
            "if(k < 10, 1, 0) as is_perm_stop",
        )

    @cached_property
    def payments(self) -> DataFrame:
        amount = """if(o_orderkey % 109 = 0, null, (10 + o_custkey % 40) *
            case o_orderkey % 3 when 0 then 0.5D when 1 then 1.0D else 1.25D end)"""
        return self.table("orders").selectExpr(
            "concat('Customer#', lpad(cast(o_custkey as string), 9, '0'), ' ') as account",
            "cast(10 * o_custkey as string) as id_subscrip",
            "concat('INV', o_orderkey) as invoice_number",
            f"{amount} as amount_without_tax",
            "if(o_orderkey % 20 = 0, -1.0D, 0.0D) as balance",
            f"if(o_orderkey % 13 = 0, 0.0D, {amount}) as amount",
            "if(o_orderkey % 17 = 0, null, date_add(date '2024-01-01', cast(o_orderkey % 120 as int)))"
            " as id_payment_date",
            "if(o_orderkey % 11 = 0, date_add(date '2024-01-01', cast(o_orderkey % 90 as int)), null)"
            " as id_decline_date",
            "if(o_orderkey % 2 = 0, 'Posted', 'Draft') as status",
        )

    @cached_property
    def features(self) -> DataFrame:
        totals = self.table("orders").groupBy(F.col("o_custkey").alias("k")).agg(
            F.count("*").cast("double").alias("frequency"),
            F.count_distinct("o_orderpriority").cast("double").alias("breadth"),
            F.expr("cast(datediff(date '2001-12-31', min(cast(o_orderdate as date))) as double)").alias("tenure"),
            F.round(F.sum("o_totalprice"), 2).alias("tt_cost"),
        )
        return totals.join(self.customers.select("k", "inference_date"), "k").selectExpr(
            "inference_date", "cast(10 * k as string) as id_subscrip",
            "frequency", "breadth", "tenure", "tt_cost",
        )

    @cached_property
    def rates(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "cast(10 * o_custkey as string) as id_subscrip",
            "date_add(cast(o_orderdate as date), 8401) as effective_date",
            "date_add(cast(o_orderdate as date), 8801) as end_date",
            "concat('R', o_orderkey % 40) as rate_key_value",
            "if(o_orderkey % 2 = 0, 'Zuora', 'CIRC') as rate_key_system",
        )

    @cached_property
    def rate_mapping(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "concat('R', o_orderkey % 40) as rate_key_value",
            "if(o_orderkey % 2 = 0, 'ZUORA', 'circ') as rate_key_system",
            """case when o_orderkey % 40 % 7 = 0 then null when o_orderkey % 40 % 11 = 0 then '-1.5'
                    else cast(cast(o_orderkey % 40 as double) + 0.25D as string) end as monthly_price""",
        ).distinct()

    @cached_property
    def eda_source(self) -> DataFrame:
        """One outcome row per order, before labelling."""
        lines = self.table("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
        three = "(o_orderkey div 20) % 2 = 0"
        return (
            self.table("orders")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .selectExpr(
                "concat('acct-', o_orderkey) as billing_account",
                "cast(o_orderkey as string) as id_subscrip",
                "date_add(date '2024-01-05', cast(7 * (o_orderkey % 23) as int)) as email_date",
                """case o_orderstatus when 'F' then 'saved' when 'O' then 'stoped'
                   else 'No Action yet' end as status""",
                f"""case when {three} then
                      case o_custkey % 3 when 0 then 'Control' when 1 then 'Midpoint' else 'Tiered' end
                    else if(o_custkey % 2 = 0, 'Control', 'Midpoint') end as Treatment""",
                """case when o_orderstatus = 'P' then 'No Action yet'
                        when o_orderkey % 10 < 5 then 'Called-In Cancel Flow'
                        when o_orderkey % 10 < 9 then 'Online Cancel Flow'
                        else 'Online first' end as contact_channel""",
                """if((o_orderkey div 10) % 2 = 0, 'Contact Before Pricing',
                      'Contact On/After Pricing') as contact_timing""",
                f"if({three}, 'Three-Offer Cohort', 'Two-Offer Cohort') as cohort",
                """case when o_orderkey % 97 = 0 then 1 when o_orderkey % 89 = 0 then null
                        else 0 end as repeatedly_called""",
                f"""case when {three} then
                      if(o_orderkey % 7 = 0, concat(o_orderpriority, ' risk'), o_orderpriority)
                    end as src_risk_tier""",
                """if(o_orderkey % 211 = 0, null, cast(o_orderkey * 7919 % 92 as double))
                   as frequency""",
                "cast(lines as double) as breadth",
                "cast(datediff(date '2001-12-31', cast(o_orderdate as date)) as double) as tenure",
                "o_totalprice as tt_cost",
            )
        )

    @cached_property
    def labelled(self) -> DataFrame:
        return label_population(self.eda_source, CUTOFF)

    @cached_property
    def analysis(self) -> DataFrame:
        return subset(self.labelled, "analysis")

    @cached_property
    def staged_analysis(self) -> DataFrame:
        """For analyses that read the population several times."""
        return stage(self.analysis, "analysis")

    @cached_property
    def analysis_counts(self) -> BinnedCounts:
        return population_counts(self.staged_analysis)

    @cached_property
    def tables(self) -> ExperimentTables:
        return ExperimentTables(
            self.applied, self.link, self.risk_source, self.calls, self.online,
            self.start_stop, self.features, self.payments,
        )

    @cached_property
    def linked(self) -> DataFrame:
        return linked_assignments(self.tables, OVERRIDES)

    @cached_property
    def outcomes(self) -> DataFrame:
        return outcomes(self.tables, self.linked, days=self.days)

    @cached_property
    def days(self) -> ContactDays:
        return contact_days(self.tables, self.linked)

    @cached_property
    def run_log(self) -> DataFrame:
        """Run records: one per event day and type."""
        return self.events.groupBy("event_date", "event_type").agg(
            F.count("*").alias("row_count"),
            F.round(F.avg("k"), 4).alias("null_percentage"),
        ).selectExpr(
            "cast(event_date as string) as execution_timestamp",
            "cast(event_date as string) as run_date",
            "'runs' as target_table",
            "concat(event_type, '.sql') as sql_file",
            "if(day(event_date) % 7 = 0, null, row_count) as row_count",
            "null_percentage",
            "true as row_count_passed",
            "true as nulls_passed",
        )
