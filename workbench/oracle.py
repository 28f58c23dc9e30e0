"""The same results as plain SQL on the given tables, for DuckDB.

Written from the definitions, not from the Spark plans: the outcome chain joins
first and takes minima after, percentiles come from `quantile_cont`, and so on.
"""

from __future__ import annotations

import math
import re

from workbench.catalogue import BOOTSTRAP, METRICS, SEGMENTS, TOP

# Each view: the SQL of a CTE. Dependencies are found by name.
VIEWS: dict[str, str] = {}
ORACLE: dict[str, str] = {}

PERCENTILES = {
    "p01": 0.01, "p05": 0.05, "p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90,
    "p95": 0.95, "p99": 0.99,
}


def with_views(sql: str) -> str:
    """Prefix the SQL with the CTEs it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    ctes = ",\n".join(f"{name} as ({VIEWS[name]})" for name in needed)
    return f"with {ctes}\n{sql}" if ctes else sql


def r(expr: str, name: str, digits: int = 4) -> str:
    return f"round({expr}, {digits}) as {name}"


# --- derived tables -------------------------------------------------------------

VIEWS["v_customers"] = """
    select *, case when filedate = date '2024-01-17' then date '2024-01-07'
      else cast(filedate - cast(dayofweek(filedate) as int) as date) end as inference_date
    from (select c_custkey as k, c_name, c_acctbal, c_mktsegment,
      cast(10 + c_custkey % 40 as double) as rate,
      cast(date '2024-01-03' + cast(7 * (c_custkey % 3) as int) as date) as filedate
      from customer)"""
VIEWS["v_events"] = """
    select event_id, user_id, event_type, cast(ts as date) as event_date,
      cast(json_extract_string(props, '$.k') as int) as k from events"""
VIEWS["v_applied"] = """
    select '  ' || upper(c_name) || ' ' as subscription, rate as currentrate,
      rate * 1.25 as newrate, rate * 0.75 as stopsave,
      cast(filedate + 14 as date) as effective,
      case when k % 2 = 0 then 'PCHURN' else 'MIDPOINT' end as modeltype,
      case when k % 6 = 0 then 'MIDPOINT' when k % 6 = 2 then 'CONTROL' when k % 6 = 4 then 'RISK1'
           when k % 4 = 1 then 'MIDPOINT' else 'CONTROL' end as grouptype,
      filedate from v_customers"""
VIEWS["v_link"] = """
    select cast(sub as varchar) as circ_idsubscrip, ' ' || c_name as billing_account,
      case when k % 97 = 0 then 'OTHER' else 'ZUORA' end as billing_system,
      case when k % 13 = 0 then 'Inactive' else 'Active' end as circ_status,
      case when k % 31 = 0 then 'PLAY' else 'MAIN' end as circ_site,
      c_mktsegment as product_type
    from (select k, c_name, c_mktsegment, 10 * k as sub from v_customers union all
          select k, c_name, c_mktsegment, 10 * k + 1 from v_customers where k % 50 = 0)"""
VIEWS["v_risk_tiers"] = """
    select inference_date, cast(10 * k as varchar) as id_subscrip,
      case when c_acctbal < 0 then '5. High' when c_acctbal < 2500 then '4. Med-High'
           when c_acctbal < 5000 then '3. Medium' when c_acctbal < 7500 then '2. Med-Low'
           else '1. Low' end as risk_tier, k, c_name, c_mktsegment from v_customers"""
VIEWS["v_risk_source"] = """
    select inference_date, c_name || '  ' as billing_account, id_subscrip, risk_tier,
      c_mktsegment as market, c_mktsegment as publication_name
    from (select * from v_risk_tiers union all
          select inference_date, cast(10 * k + 1 as varchar), risk_tier, k, c_name, c_mktsegment
          from v_risk_tiers where k % 100 = 0)"""
VIEWS["v_product"] = """
    select cast(n_nationkey as varchar) as product_id, cast(n_regionkey as varchar) as publication_id,
      'site-' || n_regionkey as website_id from nation"""
VIEWS["v_publication"] = """
    select cast(r_regionkey as varchar) as publication_id, r_name as publication_name from region"""
VIEWS["v_subscriptions"] = """
    select cast(10 * o_custkey as varchar) as id_subscrip,
      cast(cast(o_orderdate as date) + 8401 as date) as effective_date,
      coalesce(cast(cast(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey)
        as date) + 8400 as date), date '9999-12-31') as end_date,
      cast(o_orderkey % 25 as varchar) as mdm_product_id,
      case when o_custkey % 3 = 0 then ['c' || o_custkey, 'd' || o_custkey]
           else ['c' || o_custkey] end as consumer_ids
    from orders"""
VIEWS["v_known"] = """
    select 'c' || k as consumer_id, 'a' || k as anonymous_id_1,
      case when k % 4 <> 0 then 'b' || k end as anonymous_id_2,
      case when k % 5 = 0 then 'e' || k end as anonymous_id_3 from v_customers"""
VIEWS["v_web"] = """
    select event_date, (case event_id % 3 when 0 then 'a' when 1 then 'b' else 'e' end) || user_id as visitor,
      'site-' || (event_id % 5) as site,
      lower(case when k = 99 then null when event_type = 'click' then 'ManageSubscription|Cancel'
        when event_type = 'purchase' then case when k % 2 = 1 then 'snap|cancelsubscription|winback-zuora'
          else 'snap|CancelSubscription' end
        when event_type = 'signup' then 'StopSave|success' else 'page_view' end) as detail
    from v_events"""
VIEWS["v_calls"] = """
    select ' CUSTOMER#' || lpad(cast(user_id as varchar), 9, '0') as Account,
      cast(10 * user_id + case when event_id % 4 = 0 and user_id % 50 = 0 then 1 else 0 end as varchar)
        as idSubscrip,
      cast(case when k < 6 then event_date else event_date - 365 end as date) as event_date,
      k % 2 as saves from v_events where event_type = 'view'"""
VIEWS["v_online"] = """
    select cast(case when k < case event_type when 'click' then 6 else 3 end then event_date
        else event_date - 365 end as date) as event_date,
      cast(10 * user_id as varchar) as id_subscrip,
      case when event_type = 'click' then 1 else 0 end as entered_acc_mng,
      case when event_type = 'purchase' then 1 else 0 end as confirmed_cancel
    from v_events where event_type in ('click', 'purchase')"""
VIEWS["v_stops"] = """
    select cast(10 * user_id as varchar) as id_subscrip, 1 as perm_stoped,
      cast(event_date + 7 as date) as perm_stop_date, event_date as create_date
    from v_events where event_type = 'error' and k < 10"""
_AMOUNT = """case when o_orderkey % 109 <> 0 then (10 + o_custkey % 40) *
      case o_orderkey % 3 when 0 then cast(0.5 as double) when 1 then cast(1.0 as double)
      else cast(1.25 as double) end end"""
VIEWS["v_payments"] = f"""
    select 'Customer#' || lpad(cast(o_custkey as varchar), 9, '0') || ' ' as account,
      cast(10 * o_custkey as varchar) as id_subscrip, 'INV' || o_orderkey as invoice_number,
      {_AMOUNT} as amount_without_tax,
      case when o_orderkey % 20 = 0 then cast(-1 as double) else cast(0 as double) end as balance,
      case when o_orderkey % 13 = 0 then cast(0 as double) else {_AMOUNT} end as amount,
      case when o_orderkey % 17 <> 0 then cast(date '2024-01-01' + cast(o_orderkey % 120 as int) as date) end
        as id_payment_date,
      case when o_orderkey % 11 = 0 then cast(date '2024-01-01' + cast(o_orderkey % 90 as int) as date) end
        as id_decline_date,
      case when o_orderkey % 2 = 0 then 'Posted' else 'Draft' end as status
    from orders"""
VIEWS["v_features"] = """
    select c.inference_date, cast(10 * f.k as varchar) as id_subscrip, frequency, breadth, tenure, tt_cost
    from (select o_custkey as k, cast(count(*) as double) as frequency,
        cast(count(distinct o_orderpriority) as double) as breadth,
        cast(date '2001-12-31' - min(cast(o_orderdate as date)) as double) as tenure,
        round(sum(o_totalprice), 2) as tt_cost from orders group by 1) f
    join v_customers c on c.k = f.k"""
VIEWS["v_rates"] = """
    select cast(10 * o_custkey as varchar) as id_subscrip,
      cast(cast(o_orderdate as date) + 8401 as date) as effective_date,
      cast(cast(o_orderdate as date) + 8801 as date) as end_date,
      'R' || (o_orderkey % 40) as rate_key_value,
      case when o_orderkey % 2 = 0 then 'Zuora' else 'CIRC' end as rate_key_system from orders"""
VIEWS["v_rate_mapping"] = """
    select distinct 'R' || (o_orderkey % 40) as rate_key_value,
      case when o_orderkey % 2 = 0 then 'ZUORA' else 'circ' end as rate_key_system,
      case when o_orderkey % 40 % 7 = 0 then null when o_orderkey % 40 % 11 = 0 then '-1.5'
        else cast(cast(o_orderkey % 40 as double) + 0.25 as varchar) end as monthly_price from orders"""
_THREE = "(o_orderkey // 20) % 2 = 0"
VIEWS["v_eda"] = f"""
    select 'acct-' || o_orderkey as billing_account, cast(o_orderkey as varchar) as id_subscrip,
      cast(date '2024-01-05' + cast(7 * (o_orderkey % 23) as int) as date) as email_date,
      case o_orderstatus when 'F' then 'saved' when 'O' then 'stoped' else 'No Action yet' end as status,
      case when {_THREE} then case o_custkey % 3 when 0 then 'Control' when 1 then 'Midpoint' else 'Tiered' end
        else case when o_custkey % 2 = 0 then 'Control' else 'Midpoint' end end as Treatment,
      case when o_orderstatus = 'P' then 'No Action yet' when o_orderkey % 10 < 5 then 'Called-In Cancel Flow'
        when o_orderkey % 10 < 9 then 'Online Cancel Flow' else 'Online first' end as contact_channel,
      case when (o_orderkey // 10) % 2 = 0 then 'Contact Before Pricing'
        else 'Contact On/After Pricing' end as contact_timing,
      case when {_THREE} then 'Three-Offer Cohort' else 'Two-Offer Cohort' end as cohort,
      case when o_orderkey % 97 = 0 then 1 when o_orderkey % 89 = 0 then null else 0 end as repeatedly_called,
      case when {_THREE} then case when o_orderkey % 7 = 0 then o_orderpriority || ' risk'
        else o_orderpriority end end as tier,
      case when o_orderkey % 211 <> 0 then cast(o_orderkey * 7919 % 92 as double) end as frequency,
      cast(l.lines as double) as breadth,
      cast(date '2001-12-31' - cast(o_orderdate as date) as double) as tenure,
      o_totalprice as tt_cost
    from orders left join (select l_orderkey, count(*) as lines from lineitem group by 1) l
      on o_orderkey = l.l_orderkey"""
VIEWS["v_labelled"] = """
    select * exclude (tier),
      case when contact_channel in ('Online first', 'Called-In first') then 'Contacted both ways'
        else contact_channel end as contact_channel_group,
      case when contact_channel in ('Online first', 'Called-In first') then 'Contacted both ways'
        when coalesce(repeatedly_called, 0) = 1 then 'Pay less than start rate' else 'Other' end
        as likely_discount_shopper,
      case status when 'saved' then 'Saved' when 'stoped' then 'Stopped' end as outcome,
      case when tier like '% risk' then tier else tier || ' risk' end as src_risk_tier
    from v_eda where email_date < date '2024-06-01'"""
VIEWS["v_contacted"] = "select * from v_labelled where status in ('saved', 'stoped')"
VIEWS["v_analysis"] = "select * from v_contacted where likely_discount_shopper = 'Other'"
VIEWS["v_run_log"] = """
    select cast(event_date as varchar) as run_date, event_type || '.sql' as sql_file,
      case when day(event_date) % 7 <> 0 then count(*) end as row_count,
      round(avg(k), 4) as null_percentage
    from v_events group by event_date, event_type"""

# --- sources and sinks ----------------------------------------------------------

ORACLE["s1_scan_projection"] = "select c_custkey, c_name, c_mktsegment from customer"
ORACLE["s2_run_date_query"] = """
    select event_type, count(*) as n from v_events where event_date >= date '2024-01-10' group by 1"""
ORACLE["s3_csv_append"] = """
    select 'Customer#' || user_id as "Account", cast(10 * user_id as varchar) as "idSubscrip",
      event_date, k % 2 as "Saves__Digital_to_Digital_"
    from v_events"""
ORACLE["s3_exactly_once_load"] = """
    select 'Customer#' || user_id as "Account", event_type in ('error', 'signup') as quarantined,
      case when event_type not in ('error', 'signup') then event_date end as event_date
    from v_events"""
ORACLE["s4_versioned_table"] = "select * from v_applied where modeltype = 'PCHURN'"
ORACLE["s4_replace_table"] = "select * from v_applied where modeltype = 'PCHURN'"
VIEWS["v_daily"] = "select event_date, user_id, count(*) as n from v_events group by 1, 2"
VIEWS["v_loaded"] = "select * from v_daily where event_date <= date '2024-01-10'"
ORACLE["s5_replace_partition"] = """
    select * from v_loaded where event_date not in (date '2024-01-05', date '2024-01-06')
      or (event_date = date '2024-01-05' and n > 1)"""
ORACLE["s5_versioned_partitions"] = """
    select * from v_daily where event_date between date '2024-01-03' and date '2024-01-07'
      and event_date <> date '2024-01-05' and (event_date <> date '2024-01-04' or n > 1)"""
ORACLE["s6_latest_partition"] = """
    select max(event_date) as latest, cast(null as date) as absent from v_daily"""
ORACLE["s7_snapshot_partition"] = "select * from v_daily where event_date = date '2024-01-05'"
ORACLE["s8_read_snapshot"] = "select * from v_daily"
ORACLE["s9_run_log"] = """
    select '2024-01-10' as run_date, 'events' as target_table, event_type || '.sql' as sql_file,
      count(*) as row_count, cast(0 as double) as null_percentage, true as row_count_passed,
      true as nulls_passed
    from v_events group by event_type"""

# --- incremental pipeline -------------------------------------------------------

ORACLE["p1_target_date"] = """
    select distinct event_date, event_date as exact_date,
      cast(event_date - cast(dayofweek(event_date) as int) as date) as sunday_date from v_events"""
ORACLE["p2_missing_dates"] = """
    select user_id, cast(unnest(generate_series(first_day + interval 7 day, last_day, interval 7 day))
      as date) as missing_date
    from (select user_id, min(event_date) as first_day, max(event_date) as last_day
          from v_events group by 1)"""
ORACLE["p3_availability"] = """
    select d.day, exists (select 1 from v_risk_source s where s.inference_date = d.day) as available
    from (values (date '2024-01-07'), (date '2024-02-04')) d(day)"""
ORACLE["p4_catch_up_dates"] = """
    select cast(unnest(generate_series(max(event_date) + interval 1 day, date '2024-01-15',
      interval 1 day)) as date) as day from v_loaded"""
ORACLE["p5_error_isolation"] = """
    select event_date as run_date, day(event_date) not in (13, 15) as ok,
      cast(case when day(event_date) not in (13, 15) then count(*) end as double) as rows,
      case day(event_date) when 13 then 'source unavailable' when 15 then 'RuntimeError' end as error
    from v_daily where event_date between date '2024-01-11' and date '2024-01-16' group by 1"""
ORACLE["p5_side_by_side"] = ORACLE["p5_error_isolation"]
ORACLE["p6_extract_date"] = "select * from v_daily where event_date = date '2024-01-11'"
ORACLE["p7_log_only"] = """
    select cast(event_date as varchar) as run_date, 'p7.sql' as sql_file, cast(null as double) as row_count
    from v_daily where event_date in (date '2024-01-11', date '2024-01-12') group by 1"""
ORACLE["p8_floor_clamp"] = """
    select distinct event_date, greatest(date '2024-01-10', event_date) as clamped from v_events"""

# --- cohort source --------------------------------------------------------------

ORACLE["r1_market_normalization"] = """
    select c_custkey, c_mktsegment as publication_name,
      case when contains(lower(c_mktsegment), 'build') then 'Build'
           when contains(lower(c_mktsegment), 'auto') then 'auto' else c_mktsegment end as market
    from customer"""
VIEWS["v_places"] = """
    select distinct m.id_subscrip, m.effective_date, m.end_date,
      case when contains(lower(u.publication_name), 'amer') then 'Amer'
           when contains(lower(u.publication_name), 'east') then 'east'
           else u.publication_name end as market, u.publication_id, u.publication_name
    from v_subscriptions m join v_product p on m.mdm_product_id = p.product_id
    join v_publication u on p.publication_id = u.publication_id"""
ORACLE["r2_subscription_publication"] = "select * from v_places"
ORACLE["r3_billing_links"] = """
    select distinct circ_idsubscrip, billing_account from v_link where billing_system = 'ZUORA'"""
ORACLE["r4_effective_dated_join"] = """
    select t.inference_date, t.id_subscrip, t.risk_tier, m.mdm_product_id
    from v_risk_tiers t join v_subscriptions m on t.id_subscrip = m.id_subscrip
      and t.inference_date between m.effective_date and m.end_date"""
ORACLE["r5_week_alignment"] = """
    select inference_date, id_subscrip, risk_tier from v_risk_source
    where inference_date = cast(date '2024-01-10' - cast(dayofweek(date '2024-01-10') as int) as date)"""
ORACLE["r6_market_allow_list"] = """
    select id_subscrip, market from v_risk_source where market in ('BUILDING', 'MACHINERY')"""
ORACLE["r7_weekly_risk_source"] = """
    select distinct t.inference_date, l.billing_account, t.id_subscrip, t.risk_tier, p.market,
      p.publication_name
    from v_risk_tiers t join v_places p on t.id_subscrip = p.id_subscrip
      and t.inference_date between p.effective_date and p.end_date
    join (select distinct circ_idsubscrip, billing_account from v_link where billing_system = 'ZUORA') l
      on t.id_subscrip = l.circ_idsubscrip
    where t.inference_date = date '2024-01-07' and p.market in ('AFRICA', 'Amer', 'EUROPE')"""
VIEWS["v_flagged"] = """
    select event_date, visitor as anonymous_id, site as website_id,
      case when detail like '%managesubscription%' and detail like '%cancel%' then 1 else 0 end
        as entered_acc_mng,
      case when detail like '%snap|cancelsubscription%' and detail not like '%winback-zuora%' then 1 else 0
        end as confirmed_cancel,
      case when detail like '%stopsave%' and detail like '%success%' then 1 else 0 end as success_save
    from v_web"""
ORACLE["r8_web_event_flags"] = "select * from v_flagged"
VIEWS["v_visits"] = """
    select event_date, anonymous_id, website_id, max(entered_acc_mng) as entered_acc_mng,
      max(confirmed_cancel) as confirmed_cancel, max(success_save) as success_save
    from v_flagged group by 1, 2, 3"""
ORACLE["r9_flag_rollup"] = "select * from v_visits"
VIEWS["v_consumers"] = """
    select distinct id_subscrip, unnest(consumer_ids) as consumer_id, effective_date, end_date,
      mdm_product_id from v_subscriptions"""
ORACLE["r10_unnest_consumers"] = "select * from v_consumers"
VIEWS["v_visitors"] = """
    select consumer_id, anonymous_id_1 as anonymous_id from v_known where anonymous_id_1 is not null union
    select consumer_id, anonymous_id_2 from v_known where anonymous_id_2 is not null union
    select consumer_id, anonymous_id_3 from v_known where anonymous_id_3 is not null"""
ORACLE["r11_unpivot_visitor_ids"] = "select * from v_visitors"
VIEWS["v_identities"] = """
    select distinct s.id_subscrip, s.effective_date, s.end_date, a.anonymous_id, p.website_id
    from v_consumers s join v_visitors a on s.consumer_id = a.consumer_id
    join v_product p on s.mdm_product_id = p.product_id"""
ORACLE["r12_identity_map"] = "select * from v_identities"
ORACLE["r13_event_attribution"] = """
    select t.*, s.id_subscrip from v_visits t join v_identities s on t.anonymous_id = s.anonymous_id
      and t.website_id = s.website_id and t.event_date between s.effective_date and s.end_date"""
for _query, _day in (
    ("r13_cancel_events_of_a_day", "2024-01-20"), ("r13_cancel_events_before_the_start", "2024-01-10")
):
    ORACLE[_query] = ORACLE["r13_event_attribution"] + f" where t.event_date = date '{_day}'"

# --- cardinality guardrail ------------------------------------------------------

ORACLE["g1_keys_with_many_children"] = """
    select lower(trim(billing_account)) as account, count(distinct circ_idsubscrip) as children
    from v_link group by 1 having count(distinct circ_idsubscrip) > 1"""
VIEWS["v_violations"] = """
    select 'MIDPOINT' as modeltype, count(*) as cnt from v_applied
    where modeltype = 'MIDPOINT' and lower(trim(subscription)) in (
      select lower(trim(billing_account)) from v_link
      where billing_system = 'ZUORA' and circ_status = 'Active' and circ_site <> 'PLAY'
      group by 1 having count(distinct circ_idsubscrip) > 1)
    union all
    select 'PCHURN', count(*) from v_applied
    where modeltype = 'PCHURN' and lower(trim(subscription)) in (
      select lower(trim(billing_account)) from v_risk_source
      group by 1 having count(distinct id_subscrip) > 1)"""
ORACLE["g2_violations_by_model"] = "select * from v_violations"
ORACLE["g3_verdict"] = """
    select case when (select sum(cnt) from v_violations) = 0 then 'No violations'
      else 'Some violations' end as "Result" """

# --- outcome table --------------------------------------------------------------

VIEWS["v_assigned"] = """
    select *, cast(inference_date + 5 as date) as email_date from (
      select distinct lower(trim(subscription)) as billing_account, currentrate as current_rate,
        newrate as new_rate, stopsave as offered_rate, effective as pricing_effective_date,
        case when modeltype = 'PCHURN' then 'Three-Offer Cohort' else 'Two-Offer Cohort' end as cohort,
        case grouptype when 'MIDPOINT' then 'Midpoint' when 'CONTROL' then 'Control' else 'Tiered' end
          as "Treatment",
        case when filedate = date '2024-01-17' then date '2024-01-07'
          else cast(filedate - cast(dayofweek(filedate) as int) as date) end as inference_date
      from v_applied)"""
ORACLE["e1_clean_assignments"] = """
    select * replace (round(current_rate, 4) as current_rate, round(new_rate, 4) as new_rate,
      round(offered_rate, 4) as offered_rate) from v_assigned"""
ORACLE["e2_inference_date"] = """
    select lower(trim(subscription)) as billing_account, filedate,
      case when filedate = date '2024-01-17' then date '2024-01-07'
        else cast(filedate - cast(dayofweek(filedate) as int) as date) end as inference_date
    from v_applied"""
ORACLE["e3_email_date"] = """
    select id_subscrip, cast(inference_date + 5 as date) as email_date from v_risk_tiers"""
VIEWS["v_linked"] = """
    select l.id_subscrip, a.* from v_assigned a left join (
        select distinct lower(trim(billing_account)) as billing_account, circ_idsubscrip as id_subscrip,
          product_type from v_link where billing_system = 'ZUORA' and circ_site <> 'PLAY') l
      on a.billing_account = l.billing_account where a.cohort = 'Two-Offer Cohort'
    union all
    select p.id_subscrip, a.* from v_assigned a left join v_risk_source p
      on a.billing_account = lower(trim(p.billing_account)) and a.inference_date = p.inference_date
    where a.cohort = 'Three-Offer Cohort'"""
_RATES = """replace (round(current_rate, 4) as current_rate, round(new_rate, 4) as new_rate,
      round(offered_rate, 4) as offered_rate)"""
ORACLE["e4_link_subscriptions"] = f"select * {_RATES} from v_linked"
VIEWS["v_called"] = """
    select distinct a.billing_account, a.id_subscrip, 1 as called_in,
      min(c.event_date) over (partition by a.billing_account, a.id_subscrip) as "__called_in_date",
      min(u.event_date) over (partition by a.billing_account, a.id_subscrip) as "__call_cancel_date"
    from v_linked a
    join v_calls c on a.billing_account = lower(trim(c.Account)) and a.id_subscrip = c.idSubscrip
      and c.event_date >= a.email_date
    left join (select * from v_calls where saves = 0) u on a.billing_account = lower(trim(u.Account))
      and u.event_date >= a.email_date"""
ORACLE["e5_first_calls"] = "select * from v_called"
ORACLE["e5_first_calls_strict"] = """
    select distinct a.billing_account, a.id_subscrip, 1 as called_in,
      min(c.event_date) over (partition by a.billing_account, a.id_subscrip) as "__called_in_date",
      min(u.event_date) over (partition by a.billing_account, a.id_subscrip) as "__call_cancel_date"
    from v_linked a
    join v_calls c on a.billing_account = lower(trim(c.Account)) and a.id_subscrip = c.idSubscrip
      and c.event_date >= a.email_date
    left join (select * from v_calls where saves = 0) u on a.billing_account = lower(trim(u.Account))
      and a.id_subscrip = u.idSubscrip and u.event_date >= a.email_date"""
VIEWS["v_opened"] = """
    select distinct a.billing_account, a.id_subscrip, 1 as opened_cancel_page,
      min(c.event_date) over (partition by a.billing_account, a.id_subscrip) as "__open_cancel_page_date",
      min(u.event_date) over (partition by a.billing_account, a.id_subscrip) as "__ol_cancel_date"
    from v_linked a
    join (select * from v_online where entered_acc_mng = 1) c on a.id_subscrip = c.id_subscrip
      and c.event_date >= a.email_date
    left join (select * from v_online where confirmed_cancel = 1) u on a.id_subscrip = u.id_subscrip
      and u.event_date >= a.email_date"""
ORACLE["e6_first_online"] = "select * from v_opened"
ORACLE["e7_permanent_stops"] = """
    select a.billing_account, a.id_subscrip, a.email_date, cast(s.perm_stoped as double) as perm_stoped, s.perm_stop_date, s.create_date
    from v_linked a left join (select distinct * from v_stops) s on a.id_subscrip = s.id_subscrip
      and s.create_date >= a.email_date"""
VIEWS["v_base"] = """
    select distinct a.*, coalesce(c.called_in, 0) as called_in,
      coalesce(o.opened_cancel_page, 0) as opened_cancel_page, c."__called_in_date",
      c."__call_cancel_date", o."__open_cancel_page_date", o."__ol_cancel_date",
      coalesce(s.perm_stoped, 0) as perm_stoped, s.perm_stop_date, s.create_date as "__create_date"
    from v_linked a
    left join v_called c on a.billing_account = c.billing_account and a.id_subscrip = c.id_subscrip
    left join v_opened o on a.billing_account = o.billing_account and a.id_subscrip = o.id_subscrip
    left join v_stops s on a.id_subscrip = s.id_subscrip and s.create_date >= a.email_date"""
ORACLE["e8_base_assembly"] = f"select * {_RATES} from v_base"
VIEWS["v_derived"] = """
    select *,
      case when called_in + opened_cancel_page = 0 then 'No Action yet'
        when called_in + opened_cancel_page = 2 then
          case when "__called_in_date" >= "__open_cancel_page_date" then 'Online first'
            else 'Called-In first' end
        when called_in = 1 then 'Called-In Cancel Flow' else 'Online Cancel Flow' end as contact_channel,
      case when called_in + opened_cancel_page = 2 then least("__called_in_date", "__open_cancel_page_date")
        else coalesce("__called_in_date", "__open_cancel_page_date") end as "__earlist_contact_date",
      case when "__call_cancel_date" is not null and "__ol_cancel_date" is not null
        then least("__call_cancel_date", "__ol_cancel_date")
        else coalesce("__call_cancel_date", "__ol_cancel_date") end as "__earlist_cancel_date"
    from v_base"""
ORACLE["e9_contact_channel"] = """
    select billing_account, id_subscrip, email_date, perm_stop_date, contact_channel from v_derived"""
ORACLE["e10_earliest_dates"] = """
    select billing_account, id_subscrip, email_date, perm_stop_date, "__earlist_contact_date",
      "__earlist_cancel_date" from v_derived"""
VIEWS["v_classified"] = """
    select *,
      case when "__earlist_contact_date" is null then 'No Action yet'
        when perm_stoped = 1 and "__earlist_cancel_date" is not null then 'stoped'
        when perm_stoped = 1 and "__earlist_cancel_date" is null then 'unknown stoped'
        when perm_stoped = 0 and "__earlist_cancel_date" is null then 'saved'
        when perm_stoped = 0 and "__earlist_cancel_date" is not null then 'unknown saved'
        else 'others' end as status,
      case when perm_stoped = 1 and "__earlist_cancel_date" is not null then 1
        when perm_stoped = 0 and "__earlist_cancel_date" is null then 0
        when "__earlist_contact_date" is null then 0 end as churned,
      case when "__earlist_contact_date" < pricing_effective_date then 'Contact Before Pricing'
        else 'Contact On/After Pricing' end as contact_timing
    from v_derived"""
ORACLE["e11_status"] = """
    select cohort, "Treatment", status, count(*) as n from v_classified group by 1, 2, 3"""
ORACLE["e12_churn_label"] = """
    select billing_account, id_subscrip, perm_stop_date, cast(churned as double) as churned
    from v_classified"""
ORACLE["e13_contact_timing"] = """
    select contact_timing, status, count(*) as n from v_classified group by 1, 2"""
_RATES_AND_CHURN = _RATES[:-1] + ", cast(churned as double) as churned)"
_TIERS = """left join v_risk_source y on lower(trim(y.billing_account)) = b.billing_account
      and y.inference_date = b.inference_date
    left join v_features z on b.inference_date = z.inference_date and b.id_subscrip = z.id_subscrip"""
ORACLE["e14_tier_and_metrics"] = f"""
    select b.billing_account, b.id_subscrip, b.inference_date, y.risk_tier as src_risk_tier,
      z.frequency, z.breadth, z.tenure, round(z.tt_cost, 4) as tt_cost
    from v_linked b {_TIERS}"""
VIEWS["v_outcomes"] = f"""
    select b.*, y.risk_tier as src_risk_tier, z.frequency, z.breadth, z.tenure, z.tt_cost
    from v_classified b {_TIERS}"""
ORACLE["e15_outcome_table"] = f"select * {_RATES_AND_CHURN} from v_outcomes"

# --- revenue --------------------------------------------------------------------

VIEWS["v_settled"] = """
    select *, case
      when id_payment_date is not null and id_decline_date is null then 'Paid'
      when id_payment_date is not null and id_decline_date is not null
        and id_payment_date >= id_decline_date then 'Paid'
      when id_payment_date is null and id_decline_date is null and amount = 0 and status = 'Posted'
        then 'Paid'
      when id_payment_date is null and id_decline_date is not null then 'Not Paid'
      when id_payment_date is not null and id_decline_date is not null
        and id_payment_date < id_decline_date then 'Not Paid'
      when id_payment_date is null and id_decline_date is null then 'Not Paid'
      else 'Other' end as payment_status
    from v_payments"""
ORACLE["m1_payment_status"] = "select invoice_number, payment_status from v_settled"
VIEWS["v_facts"] = """
    select lower(trim(account)) as billing_account, id_subscrip, invoice_number,
      amount_without_tax + balance as billing_amount, balance, id_payment_date, payment_status
    from v_settled
    where id_payment_date >= date '2024-01-01' and payment_status = 'Paid' and balance >= 0"""
ORACLE["m2_payment_facts"] = """
    select * replace (round(billing_amount, 4) as billing_amount) from v_facts"""
VIEWS["v_evaluable"] = """
    select *, "Treatment" || ' - ' || src_risk_tier as treatment_plus_tier
    from v_outcomes where churned is not null"""
ORACLE["m3_evaluable"] = """
    select billing_account, id_subscrip, perm_stop_date, churned, treatment_plus_tier from v_evaluable"""
VIEWS["v_qualifying"] = """
    select e.billing_account, e.id_subscrip, e.cohort, e."Treatment", e.churned, p.id_payment_date,
      p.billing_amount, e."__earlist_contact_date",
      case when p.billing_amount < e.offered_rate then e.offered_rate else p.billing_amount end
        as bill_amount_save_once,
      case when p.billing_amount < e.offered_rate then 1 else 0 end as repeatedly_called,
      case when p.billing_amount = e.new_rate then 1 else 0 end as skpi_gap_wip,
      e.perm_stop_date, e.src_risk_tier, e.email_date
    from v_evaluable e join v_facts p on e.billing_account = p.billing_account
      and e.id_subscrip = p.id_subscrip and p.id_payment_date > e."__earlist_contact_date"
      and p.id_payment_date >= e.pricing_effective_date"""
ORACLE["m6_account_revenue"] = """
    select billing_account, id_subscrip, round(sum(billing_amount), 4) as tt_paid_raw,
      round(sum(bill_amount_save_once), 4) as tt_paid_save_once,
      case when sum(repeatedly_called) > 0 then 1 else 0 end as repeatedly_called,
      case when sum(skpi_gap_wip) > 0 then 1 else 0 end as skpi_gap_wip
    from v_qualifying group by 1, 2"""
VIEWS["v_paid"] = ORACLE["m6_account_revenue"]
VIEWS["v_attached"] = """
    select distinct e.*, coalesce(p.tt_paid_raw, 0) as tt_paid_raw,
      coalesce(p.tt_paid_save_once, 0) as tt_paid_save_once,
      coalesce(p.repeatedly_called, 0) as repeatedly_called, coalesce(p.skpi_gap_wip, 0) as skpi_gap_wip
    from v_evaluable e left join v_paid p on e.billing_account = p.billing_account
      and e.id_subscrip = p.id_subscrip"""
ORACLE["m7_attach_revenue"] = f"select * {_RATES} from v_attached"
ORACLE["m8_exclude_rate_gap"] = """
    select billing_account, id_subscrip, churned, tt_paid_raw, skpi_gap_wip from v_attached
    where skpi_gap_wip = 0 or churned = 1"""
ORACLE["m9_revenue_table"] = """
    select * exclude (skpi_gap_wip) replace (
      round(current_rate, 4) as current_rate, round(new_rate, 4) as new_rate,
      round(offered_rate, 4) as offered_rate,
      case when churned = 0 then tt_paid_raw else 0 end as tt_paid_raw,
      case when churned = 0 then tt_paid_save_once else 0 end as tt_paid_save_once)
    from v_attached where skpi_gap_wip = 0 or churned = 1"""
ORACLE["m5_payment_flags"] = """
    select billing_account, id_subscrip, id_payment_date, round(billing_amount, 4) as billing_amount,
      round(bill_amount_save_once, 4) as bill_amount_save_once, repeatedly_called, skpi_gap_wip
    from (select e.billing_account, e.id_subscrip, e.offered_rate, e.new_rate, e."__earlist_contact_date" as contact, e.pricing_effective_date
          from v_evaluable e) e
    join (select distinct billing_account as acct, id_subscrip as sub, id_payment_date, billing_amount
          from v_facts) p on acct = billing_account and sub = id_subscrip
      and id_payment_date > contact and id_payment_date >= pricing_effective_date,
    lateral (select case when billing_amount < offered_rate then offered_rate else billing_amount end
      as bill_amount_save_once, case when billing_amount < offered_rate then 1 else 0 end
      as repeatedly_called, case when billing_amount = new_rate then 1 else 0 end as skpi_gap_wip)"""
ORACLE["m4_qualifying_payments"] = """
    select e.billing_account, e.id_subscrip, id_payment_date, round(billing_amount, 4) as billing_amount,
      payments
    from v_evaluable e
    join (select billing_account as acct, id_subscrip as sub, id_payment_date, billing_amount,
          count(*) as payments from v_facts group by 1, 2, 3, 4) p
      on acct = billing_account and sub = id_subscrip and id_payment_date > "__earlist_contact_date"
      and id_payment_date >= pricing_effective_date"""
ORACLE["m10_churn_rate"] = """
    select cohort, "Treatment", count(*) as rows, cast(sum(churned) as bigint) as churned,
      round(avg(churned), 4) as churn_rate
    from v_outcomes where churned is not null and "__earlist_contact_date" is not null group by 1, 2"""
def _cnrc(by: list[str]) -> str:
    names = ", ".join(by)
    same = " and ".join(f"r.{b} is not distinct from c.{b}" for b in by)
    return f"""
    select {', '.join(f'c.{b}' for b in by)}, window_days, callers, round(coalesce(revenue, 0), 4) as revenue,
      round(coalesce(revenue, 0) / callers, 4) as cnrc
    from (select {names}, count(distinct billing_account) as callers from v_evaluable
          where "__earlist_contact_date" is not null group by all) c
    cross join (values (30), (60), (90)) w(window_days)
    left join (
      select {', '.join(f'e.{b}' for b in by)}, days, sum(p.billing_amount) as revenue
      from (select distinct billing_account, id_subscrip, {names}, offered_rate, new_rate,
              pricing_effective_date, "__earlist_contact_date" as contact
            from v_evaluable where churned = 0) e
      join v_facts p on e.billing_account = p.billing_account and e.id_subscrip = p.id_subscrip
        and p.id_payment_date > contact and p.id_payment_date >= pricing_effective_date
      join (values (30), (60), (90)) d(days) on p.id_payment_date <= contact + days
      group by all) r
    on {same} and r.days = window_days"""


ORACLE["m11_cnrc"] = _cnrc(["cohort", '"Treatment"'])
ORACLE["m11_cnrc_by_tier"] = _cnrc(["cohort", '"Treatment"', "src_risk_tier"])

# --- contact history and rates --------------------------------------------------

VIEWS["v_call_days"] = """
    select distinct a.billing_account, a.id_subscrip, c.event_date from v_linked a
    join v_calls c on a.billing_account = lower(trim(c.Account)) and a.id_subscrip = c.idSubscrip
      and c.event_date >= a.email_date"""
VIEWS["v_page_days"] = """
    select distinct a.billing_account, a.id_subscrip, c.event_date from v_linked a
    join v_online c on c.entered_acc_mng = 1 and a.id_subscrip = c.id_subscrip
      and c.event_date >= a.email_date"""
ORACLE["c1_call_days"] = "select * from v_call_days"
ORACLE["c2_page_days"] = "select * from v_page_days"
VIEWS["v_contacts"] = """
    select *, 'Called In' as event_type from v_call_days union all
    select *, 'Opened Cancel Page' from v_page_days"""
ORACLE["c3_contact_events"] = "select * from v_contacts"
VIEWS["v_sequence"] = """
    select *, cast(dense_rank() over (partition by billing_account, id_subscrip order by event_date) as int)
      as rank_num from v_contacts"""
ORACLE["c4_contact_sequence"] = "select * from v_sequence"
_ORDINAL = """case rank_num when 1 then '1st' when 2 then '2nd' when 3 then '3rd' when 4 then '4th'
    when 5 then '5th' when 6 then '6th' when 7 then '7th' when 8 then '8th' when 9 then '9th'
    else cast(rank_num as varchar) end"""
ORACLE["c5_ordinal_label"] = f"""
    select *, {_ORDINAL} as contact_order from (
      select *, cast(dense_rank() over (partition by billing_account, id_subscrip order by event_date) as int)
        as rank_num
      from (select distinct cast(user_id as varchar) as billing_account, event_type as id_subscrip,
              event_date from v_events))"""
VIEWS["v_steps"] = f"""
    select billing_account, id_subscrip, {_ORDINAL} as contact_order,
      string_agg(distinct event_type, ' & ' order by event_type) as contact_types,
      string_agg(cast(event_date as varchar), ',') as contact_date
    from v_sequence group by 1, 2, 3"""
ORACLE["c6_contact_steps"] = "select * from v_steps"
ORACLE["c7_contact_history"] = f"""
    select t.* {_RATES_AND_CHURN}, coalesce(s.contact_order, 'No Action yet') as contact_order,
      coalesce(s.contact_types, 'No Action yet') as contact_types, s.contact_date
    from v_outcomes t left join v_steps s on t.billing_account = s.billing_account
      and t.id_subscrip = s.id_subscrip"""
VIEWS["v_rate_links"] = """
    select distinct lower(trim(l.billing_account)) as billing_account, m.id_subscrip
    from v_subscriptions m join v_link l on m.id_subscrip = l.circ_idsubscrip
    join v_product p on m.mdm_product_id = p.product_id
    join v_publication u on p.publication_id = u.publication_id
    where u.publication_name <> 'ASIA' and l.billing_system = 'ZUORA'"""
ORACLE["a1_rate_links"] = "select * from v_rate_links"
VIEWS["v_cancels"] = """
    select billing_account, current_rate, email_date, "__earlist_cancel_date" as "__cancel_date", cohort
    from v_outcomes"""
ORACLE["a2_earliest_cancel"] = "select * from v_cancels"
ORACLE["a3_rate_history_attach"] = """
    select t.billing_account, l.id_subscrip, t.email_date, s.effective_date, s.end_date, s.rate_key_value,
      s.rate_key_system
    from (select distinct * from v_cancels) t join v_rate_links l on t.billing_account = l.billing_account
    left join v_rates s on l.id_subscrip = s.id_subscrip and s.end_date >= t.email_date"""
ORACLE["a4_rate_key_mapping"] = """
    select s.id_subscrip, s.effective_date, s.rate_key_value, s.rate_key_system, m.monthly_price
    from v_rates s left join v_rate_mapping m on m.rate_key_value = s.rate_key_value
      and lower(m.rate_key_system) = lower(s.rate_key_system)"""
ORACLE["a5_month_cost"] = """
    select distinct t.*, s.id_subscrip, s.effective_date, s.end_date,
      case when m.monthly_price is not null then
        round(greatest(cast(m.monthly_price as double), 0), 2) end as month_cost
    from v_cancels t join v_rate_links l on t.billing_account = l.billing_account
    left join v_rates s on l.id_subscrip = s.id_subscrip and s.end_date >= t.email_date
    left join v_rate_mapping m on m.rate_key_value = s.rate_key_value
      and lower(m.rate_key_system) = lower(s.rate_key_system)"""

# --- data quality ---------------------------------------------------------------

_CELLS = [
    "billing_account", "id_subscrip", "email_date", "status", '"Treatment"', "contact_channel",
    "contact_timing", "cohort", "repeatedly_called", "src_risk_tier", *METRICS,
    "contact_channel_group", "likely_discount_shopper", "outcome",
]
ORACLE["q1_null_percentage"] = f"""
    select round(({' + '.join(f'count(*) - count({c})' for c in _CELLS)}) * 100.0
      / (count(*) * {len(_CELLS)}), 6) as null_percentage from v_labelled"""
ORACLE["q2_row_count"] = "select count(*) as row_count from v_labelled"
ORACLE["q3_history_baseline"] = """
    select round(avg(row_count), 4) as avg_row_count, round(avg(null_percentage), 4) as avg_null_percentage
    from v_run_log where sql_file = 'click.sql' and row_count is not null"""
ORACLE["q4_deviation_verdicts"] = """
    select l.sql_file, l.run_date,
      not coalesce(abs(row_count - average) / nullif(average, 0) > 0.10, false) as passed
    from v_run_log l join (select sql_file, avg(row_count) as average from v_run_log
      where row_count is not null group by 1) b on l.sql_file = b.sql_file"""
ORACLE["q1_nan_percentage"] = """
    select round(count(*) filter (frequency is null or frequency < 20) * 100.0 / (count(*) * 2), 6)
      as null_percentage from v_labelled"""
ORACLE["q5_assessment_record"] = """
    select '2024-01-10' as run_date, c.sql_file, c.n as row_count,
      cast(0 as double) as null_percentage,
      coalesce(abs(c.n - b.rows) / b.rows <= 0.10, true) as row_count_passed,
      coalesce(abs(0 - b.nulls) / b.nulls <= 0.10, true) as nulls_passed
    from (select event_type || '.sql' as sql_file, count(*) as n from v_events group by 1) c
    join (select sql_file, avg(row_count) as rows, avg(null_percentage) as nulls from v_run_log
       where row_count is not null group by 1) b on b.sql_file = c.sql_file"""
ORACLE["q6_key_contract"] = """
    select user_id, count(*) as rows from v_events group by 1 having count(*) > 1 or user_id is null"""
_MERGED = """(select *, date_trunc('week', event_date) as week from v_events where event_id % 2 = 0
    or date_trunc('week', event_date) > (select min(date_trunc('week', event_date)) from v_events))"""
ORACLE["q1_merged_measures"] = f"""
    select count(*) as row_count, round((6 * count(*) - count(event_id) - count(user_id) - count(event_type)
      - count(event_date) - count(k) - count(week)) * 100.0 / (6 * count(*)), 6) as null_percentage from {_MERGED}"""
ORACLE["q6_merged_key_contract"] = f"""
    select user_id, cast(count(*) as bigint) as rows from {_MERGED} group by 1 having count(*) > 1 or user_id is null"""
ORACLE["q7_metric_coverage"] = " union all ".join(
    f"select '{m}' as metric, count(*) as rows, count({m}) as non_null from v_analysis" for m in METRICS
)

# --- behavioural analysis -------------------------------------------------------

ORACLE["d1_label_population"] = """
    select billing_account, contact_channel_group, likely_discount_shopper, outcome, src_risk_tier,
      email_date from v_labelled"""
_MEMBER = {
    "no_action": "status = 'No Action yet'",
    "contacted": "status in ('saved', 'stoped')",
    "gamer": "status in ('saved', 'stoped') and likely_discount_shopper <> 'Other'",
    "analysis": "status in ('saved', 'stoped') and likely_discount_shopper = 'Other'",
    "saved": "status = 'saved' and likely_discount_shopper = 'Other'",
    "stopped": "status = 'stoped' and likely_discount_shopper = 'Other'",
}
ORACLE["d2_population_split"] = "select billing_account, " + ", ".join(
    f"{rule} as {name}" for name, rule in _MEMBER.items()
) + " from v_labelled"
_FUNNEL = [
    ("0. All mature notified users", "true"),
    ("1. No Action yet", _MEMBER["no_action"]),
    ("1. Contacted users", _MEMBER["contacted"]),
    ("2. Likely gamers — diagnostic only", _MEMBER["gamer"]),
    ("2. Called once — primary analysis", _MEMBER["analysis"]),
    ("3. Called once and Saved", _MEMBER["saved"]),
    ("3. Called once and Stopped", _MEMBER["stopped"]),
]
ORACLE["d3_funnel"] = " union all ".join(
    f"""select '{title}' as population, count(distinct billing_account) as accounts,
        round(count(distinct billing_account) * 100.0 /
          (select count(distinct billing_account) from v_labelled), 4) as share_of_all_pct
        from v_labelled where {rule}"""
    for title, rule in _FUNNEL
)
ORACLE["s10_export_csv"] = ORACLE["d3_funnel"]
ORACLE["d3_funnel_from_daily_bitmaps"] = ORACLE["d3_funnel"]
ORACLE["d6_segment_accounts_from_bitmaps"] = """
    select cohort, contact_channel_group, count(distinct billing_account) as accounts
    from v_labelled where billing_account is not null group by all"""


def _distribution(source: str, field: str, where: str = "true", extra: str = "", group: str = "") -> str:
    quantiles = ", ".join(f"quantile_cont({field}, {p}) as {n}" for n, p in PERCENTILES.items())
    g = f"{group}, " if group else ""
    by = f" group by {group}" if group else ""
    match = f"and s.{group} = q.{group}" if group else ""
    return f"""
      select {extra} '{field}' as field, row_count, non_null_count, row_count - non_null_count as null_count,
        round((row_count - non_null_count) * 100.0 / row_count, 4) as null_pct, zero_count, negative_count,
        round(low, 4) as min, round(high, 4) as max, round(mean, 4) as mean, round(p50, 4) as median,
        round(sd, 4) as std, {', '.join(r(p, p) for p in PERCENTILES)},
        round(p75 - p25, 4) as iqr, round(p25 - 1.5 * (p75 - p25), 4) as lower_bound,
        round(p75 + 1.5 * (p75 - p25), 4) as upper_bound, outlier_count,
        round(outlier_count * 100.0 / non_null_count, 4) as outlier_pct
      from (
        select q.*, (select count(*) from {source} s where {where} {match} and (s.{field} < p25 - 1.5 * (p75 - p25)
            or s.{field} > p75 + 1.5 * (p75 - p25))) as outlier_count
        from (select {g} count(*) as row_count, count({field}) as non_null_count,
            count(*) filter ({field} = 0) as zero_count, count(*) filter ({field} < 0) as negative_count,
            min({field}) as low, max({field}) as high, avg({field}) as mean, stddev_samp({field}) as sd,
            {quantiles}
          from {source} where {where} {by}) q)"""


ORACLE["d4_distribution_summary"] = " union all ".join(_distribution("v_labelled", m) for m in METRICS)
ORACLE["d5_population_summaries"] = " union all ".join(
    _distribution("v_labelled", m, _MEMBER[name], f"'{title}' as population, ")
    for title, name in (
        ("No Action yet", "no_action"), ("Called once — primary", "analysis"),
        ("Called once and Saved", "saved"), ("Called once and Stopped", "stopped"),
    )
    for m in METRICS
)
ORACLE["d5_repeated_call_summary"] = " union all ".join(
    _distribution(
        "v_contacted", m, extra="likely_discount_shopper, ", group="likely_discount_shopper"
    )
    for m in METRICS
)


def _segment(field: str, head: str) -> str:
    stats = ", ".join(
        f"{r(f'avg({m})', f'avg_{m}')}, {r(f'median({m})', f'median_{m}')},"
        f" {r(f'quantile_cont({m}, 0.9)', f'p90_{m}')}"
        for m in METRICS
    )
    return f"""select {head}, count(distinct billing_account) as users, {stats}
      from v_analysis group by {field}"""


ORACLE["d6_segment_summary"] = _segment("src_risk_tier", "src_risk_tier")
ORACLE["d7_segment_summaries"] = " union all ".join(
    _segment(f, f"'{f}' as segment_field, {f} as segment_value")
    for f in ("src_risk_tier", "cohort", '"Treatment"', "contact_channel_group", "outcome", "contact_timing")
).replace("'\"Treatment\"'", "'Treatment'")


def _reference(source: str) -> str:
    return " union all ".join(
        f"""select '{m}' as metric, p01, center,
          case when iqr <> 0 then iqr when p99 - p01 <> 0 then p99 - p01 else 1 end as spread, p99
          from (select quantile_cont({m}, 0.01) as p01, median({m}) as center,
            quantile_cont({m}, 0.75) - quantile_cont({m}, 0.25) as iqr,
            quantile_cont({m}, 0.99) as p99 from {source})"""
        for m in METRICS
    )


VIEWS["v_reference"] = _reference("v_analysis")
ORACLE["d8_behavior_reference"] = """
    select metric, round(p01, 6) as p01, round(center, 6) as center, round(spread, 6) as spread,
      round(p99, 6) as p99 from v_reference"""


def _clip(m: str, expr: str | None = None) -> str:
    e = expr or m
    return (
        f"case when {e} is not null then least(greatest({e},"
        f" (select p01 from v_reference where metric = '{m}')),"
        f" (select p99 from v_reference where metric = '{m}')) end"
    )


def _score(m: str) -> str:
    return (
        f"({_clip(m)} - (select center from v_reference where metric = '{m}'))"
        f" / (select spread from v_reference where metric = '{m}')"
    )


VIEWS["v_scored"] = "select *, " + ", ".join(
    f"{_clip(m)} as clip__{m}, {_score(m)} as score__{m}" for m in METRICS
) + " from v_analysis"
ORACLE["d9_clipped_metrics"] = "select billing_account, " + ", ".join(
    r(f"clip__{m}", m) for m in METRICS
) + " from v_scored"
ORACLE["d10_robust_scores"] = "select billing_account, " + ", ".join(
    r(f"score__{m}", m, 6) for m in METRICS
) + " from v_scored"


def _label(fields: list[str]) -> str:
    return " || ' · ' || ".join(f"coalesce({f}, 'Missing')" for f in fields)


ORACLE["d11_segment_label"] = f"""
    select billing_account, {_label(['outcome', *SEGMENTS])} as segment_label from v_analysis"""


def _dominant(named: dict[str, str]) -> str:
    sizes = {n: f"abs({e})" for n, e in named.items()}
    top = f"greatest({', '.join(sizes.values())})"
    arms = " ".join(f"when {s} = {top} then '{n}'" for n, s in sizes.items())
    return f"case {arms} end"


ORACLE["d13_dominant_metric"] = f"""
    select billing_account, {_dominant({'frequency': '(frequency - 46)', 'breadth': '((breadth - 4) * 10)',
      'tenure': '((tenure - 1200) / 30)', 'tt_cost': '((tt_cost - 150000) / 4000)'})} as dominant_metric
    from v_labelled"""
_SAME = " and ".join(f"a.{f} is not distinct from s.{f}" for f in SEGMENTS)
ORACLE["d14_segment_match"] = f"""
    select a.billing_account, {', '.join(f'a.{f}' for f in SEGMENTS)} from v_analysis a
    join (select {', '.join(SEGMENTS)} from v_analysis where outcome = 'Saved' group by all) s on {_SAME}"""


def _magnitude(exprs: list[str]) -> str:
    some = " or ".join(f"{e} is not null" for e in exprs)
    return f"case when {some} then sqrt({' + '.join(f'coalesce({e} * {e}, 0)' for e in exprs)}) end"


ORACLE["d12_vector_magnitude"] = f"""
    select billing_account, round({_magnitude(METRICS)}, 6) as magnitude from v_labelled"""


_PROFILE = ["outcome", *SEGMENTS]
VIEWS["v_profiles"] = f"""
    select *, {_magnitude([f'score__{m}' for m in METRICS])} as profile_magnitude,
      {_dominant({m: f'score__{m}' for m in METRICS})} as dominant_metric
    from (select {', '.join(_PROFILE)}, {_label(_PROFILE)} as segment_label,
      count(distinct billing_account) as users,
      {', '.join(f'median({m}) as median__{m}' for m in METRICS)},
      {', '.join(f'median(score__{m}) as score__{m}' for m in METRICS)}
      from v_scored group by {', '.join(_PROFILE)} having count(distinct billing_account) >= 20)"""


def _round_all(names: list[str], digits: int = 6) -> str:
    return "replace (" + ", ".join(r(n, n, digits) for n in names) + ")"


_PROFILE_NUMBERS = [f"{k}__{m}" for k in ("median", "score") for m in METRICS] + ["profile_magnitude"]
ORACLE["d15_behavior_profiles"] = f"select * {_round_all(_PROFILE_NUMBERS)} from v_profiles"

# --- from the revenue table on ----------------------------------------------------

VIEWS["v_revenue"] = ORACLE["m9_revenue_table"]
VIEWS["v_chain"] = (
    VIEWS["v_labelled"]
    .replace("exclude (tier)", "exclude (src_risk_tier)")
    .replace("tier like '% risk' then tier else tier ||", "src_risk_tier like '% risk' then src_risk_tier else src_risk_tier ||")
    .replace("v_eda", "v_revenue")
)
VIEWS["v_chain_contacted"] = "select * from v_chain where status in ('saved', 'stoped')"
ORACLE["chain_funnel"] = ORACLE["d3_funnel"].replace("v_labelled", "v_chain")
VIEWS["v_chain_reference"] = _reference("v_chain_contacted")
VIEWS["v_chain_scored"] = (
    VIEWS["v_scored"].replace("v_reference", "v_chain_reference").replace("v_analysis", "v_chain_contacted")
)
VIEWS["v_chain_profiles"] = VIEWS["v_profiles"].replace("v_scored", "v_chain_scored").replace(">= 20", ">= 2")
ORACLE["chain_behavior_profiles"] = ORACLE["d15_behavior_profiles"].replace("v_profiles", "v_chain_profiles")

# --- contrasts and drill-down -----------------------------------------------------

VIEWS["v_contrasts"] = f"""
    select cast(row_number() over (order by contrast_magnitude desc nulls last, total_users desc,
        {', '.join(f'{f} nulls first' for f in SEGMENTS)}) - 1 as int) as segment_rank, *,
      case when lead_delta >= 0 then 'Saved' when lead_delta < 0 then 'Stopped' end as dominant_outcome
    from (select *, {_magnitude([f'delta__{m}' for m in METRICS])} as contrast_magnitude,
        {_dominant({m: f'delta__{m}' for m in METRICS})} as dominant_metric,
        case {_dominant({m: f'delta__{m}' for m in METRICS})}
          {' '.join(f"when '{m}' then delta__{m}" for m in METRICS)} end as lead_delta
      from (select {', '.join(f'a.{f}' for f in SEGMENTS)},
          {_label([f'a.{f}' for f in SEGMENTS])} as segment_label,
          a.users as n__saved, s.users as n__stopped,
          {', '.join(f'a.median__{m} as median_saved__{m}' for m in METRICS)},
          {', '.join(f's.median__{m} as median_stopped__{m}' for m in METRICS)},
          {', '.join(f'a.score__{m} - s.score__{m} as delta__{m}' for m in METRICS)},
          a.users + s.users as total_users, a.users / (a.users + s.users) as observed_saved_share
        from v_profiles a join v_profiles s on {_SAME} and a.outcome = 'Saved' and s.outcome = 'Stopped'))"""
_CONTRAST_NUMBERS = (
    [f"median_{s}__{m}" for s in ("saved", "stopped") for m in METRICS]
    + [f"delta__{m}" for m in METRICS]
    + ["observed_saved_share", "contrast_magnitude"]
)
ORACLE["d16_outcome_contrasts"] = f"""
    select * exclude (lead_delta) {_round_all(_CONTRAST_NUMBERS)} from v_contrasts"""
VIEWS["v_selected"] = f"select * from v_contrasts order by segment_rank limit {TOP}"
VIEWS["v_treatments"] = f"""
    select *, {_magnitude([f'delta__{m}' for m in METRICS])} as contrast_magnitude,
      {_dominant({m: f'delta__{m}' for m in METRICS})} as dominant_metric
    from (select segment_rank, segment_label, {', '.join(SEGMENTS)}, "Treatment", n__saved, n__stopped,
        n__saved + n__stopped as total_users,
        case when n__saved + n__stopped > 0 then n__saved / (n__saved + n__stopped) end
          as observed_saved_share,
        n__saved >= 5 and n__stopped >= 5 as supported,
        {', '.join(f'median_{s}__{m}' for s in ('saved', 'stopped') for m in METRICS)},
        {', '.join(f'case when n__saved >= 5 and n__stopped >= 5 then sc_saved__{m} - sc_stopped__{m} end as delta__{m}' for m in METRICS)}
      from (select s.segment_rank, s.segment_label || ' · ' || t."Treatment" as segment_label,
          {', '.join(f's.{f}' for f in SEGMENTS)}, t."Treatment",
          {', '.join(f"count(distinct a.billing_account) filter (a.outcome = '{o}') as n__{x}" for o, x in (('Saved', 'saved'), ('Stopped', 'stopped')))},
          {', '.join(f"median(a.{m}) filter (a.outcome = '{o}') as median_{x}__{m}" for o, x in (('Saved', 'saved'), ('Stopped', 'stopped')) for m in METRICS)},
          {', '.join(f"median(a.score__{m}) filter (a.outcome = '{o}') as sc_{x}__{m}" for o, x in (('Saved', 'saved'), ('Stopped', 'stopped')) for m in METRICS)}
        from v_selected s cross join (values ('Control'), ('Midpoint'), ('Tiered')) t("Treatment")
        left join v_scored a on {_SAME} and a."Treatment" = t."Treatment"
        group by all))"""
ORACLE["d17_treatment_contrasts"] = f"select * {_round_all(_CONTRAST_NUMBERS)} from v_treatments"


def _detail(m: str) -> str:
    sides = []
    for o, x in (("Saved", "saved"), ("Stopped", "stopped")):
        rows = f"filter (a.outcome = '{o}')"
        q25, q75 = (f"quantile_cont(a.clip__{m}, {p}) {rows}" for p in (0.25, 0.75))
        sides.append(
            f"t.n__{x}, count(a.clip__{m}) {rows} as non_null__{x},"
            f" round({_clip(m, f't.median_{x}__{m}')}, 6) as clipped_median__{x},"
            f" round({q25}, 6) as clipped_q25__{x}, round({q75}, 6) as clipped_q75__{x},"
            f" round({q75} - {q25}, 6) as clipped_iqr__{x}"
        )
    return f"""select t.segment_rank, t.segment_label, {', '.join(f't.{f}' for f in SEGMENTS)},
        t."Treatment", '{m}' as metric, {', '.join(sides)},
        round({_clip(m, f't.median_saved__{m}')} - {_clip(m, f't.median_stopped__{m}')}, 6)
          as clipped_median_difference,
        any_value(i.ci_lower) as clipped_median_difference_ci_lower,
        any_value(i.ci_upper) as clipped_median_difference_ci_upper,
        {BOOTSTRAP} as bootstrap_iterations, cast(0.95 as double) as confidence_level
      from v_treatments t left join v_scored a on {_SAME.replace('s.', 't.')} and a."Treatment" = t."Treatment"
      left join v_detail_intervals i on i.segment_rank = t.segment_rank and i."Treatment" = t."Treatment"
        and i.metric = '{m}'
      group by t.segment_rank, t.segment_label, {', '.join(f't.{f}' for f in SEGMENTS)}, t."Treatment",
        t.n__saved, t.n__stopped, t.median_saved__{m}, t.median_stopped__{m}"""


ORACLE["d18_segment_details"] = " union all ".join(_detail(m) for m in METRICS)

# --- bootstrap: the same hash draws, written out as a chain of proposals ----------


def _uniform(key: str, start: int) -> str:
    return f"((cast(('0x' || substr(md5({key}), {start}, 8)) as bigint) + 0.5) / 4294967296.0)"


def _gamma(shape: str, key: str) -> str:
    d = f"({shape} - 1.0::double / 3.0::double)"
    arms = []
    for a in range(8):
        k = f"({key} || '|{a}')"
        z = f"(sqrt(-2.0 * ln({_uniform(k, 1)})) * cos({2 * math.pi!r}::double * {_uniform(k, 9)}))"
        v = f"pow(1.0::double + {z} / sqrt(9.0 * {d}), 3)"
        arms.append(
            f"when {v} > 0 and ln({_uniform(k, 17)}) < 0.5 * {z} * {z} + {d} - {d} * {v} + {d} * ln("
            f"case when {v} > 0 then {v} else 1 end) then {d} * {v}"
        )
    return f"case {' '.join(arms)} else {d} end"


def _intervals(name: str, cell: list[str], rows: str) -> str:
    """Views of the sorted values and the draws of each cell; the SQL of its intervals.

    `rows` is a FROM clause over the cells as `s` and the scored accounts as `a`.
    """
    c, s = ", ".join(cell), ", ".join(f"s.{x}" for x in cell)
    side = f"{c}, metric, outcome"
    VIEWS[f"v_sorted_{name}"] = " union all ".join(
        f"""select {s}, '{m}' as metric, a.outcome, a.clip__{m} as value,
            row_number() over (partition by {s}, a.outcome order by a.{m}) - 1 as pos,
            count(*) over (partition by {s}, a.outcome) as total
          from {rows} where a.{m} is not null"""
        for m in METRICS
    )
    VIEWS[f"v_draws_{name}"] = f"""
        select *, {_gamma('half', "(key || '|x')")} as x,
          {_gamma('(total - half + 1)', "(key || '|y')")} as y, {_uniform("(key || '|w')", 1)} as w
        from (select distinct {side}, cast(total as double) as total,
            cast((total + 1) // 2 as double) as half, replicate,
            '42|' || {" || '|' || ".join(cell)} || '|' || outcome || '|' || metric || '|' || replicate as key
          from (select distinct {side}, total from v_sorted_{name})
          cross join generate_series(1, {BOOTSTRAP}) g(replicate))"""
    VIEWS[f"v_ranks_{name}"] = f"""
        select {side}, replicate,
          unnest([least(floor(u * total), total - 1),
            least(floor(case when total % 2 = 1 then u
              else u + (1 - u) * (1 - pow(w, 1.0 / (total - half))) end * total), total - 1)]) as pos
        from (select *, x / (x + y) as u from v_draws_{name})"""
    VIEWS[f"v_medians_{name}"] = f"""
        select {', '.join(f'r.{x}' for x in cell)}, r.metric, r.replicate,
          avg(v.value) filter (r.outcome = 'Saved') as saved,
          avg(v.value) filter (r.outcome = 'Stopped') as stopped
        from v_ranks_{name} r join v_sorted_{name} v on {' and '.join(f'r.{x} = v.{x}' for x in cell)}
          and r.metric = v.metric and r.outcome = v.outcome and r.pos = v.pos
        group by all"""
    return f"""
        select {c}, metric, round(quantile_cont(saved - stopped, 0.025), 6) as ci_lower,
          round(quantile_cont(saved - stopped, 0.975), 6) as ci_upper
        from v_medians_{name} where saved is not null and stopped is not null group by all"""


ORACLE["d19_bootstrap_intervals"] = _intervals(
    "segment", ["segment_rank"], f"v_selected s join v_scored a on {_SAME}"
)
VIEWS["v_detail_intervals"] = _intervals(
    "detail", ["segment_rank", '"Treatment"'],
    f'v_treatments s join v_scored a on {_SAME} and a."Treatment" = s."Treatment"',
)

# --- chart data -----------------------------------------------------------------

VIEWS["v_long"] = " union all ".join(
    f"""select outcome, '{m}' as metric, {m} as original, clip__{m} as clipped,
        score__{m} as standardized from v_scored where {m} is not null"""
    for m in METRICS
)
ORACLE["v1_three_scales"] = """
    select * replace (round(original, 4) as original, round(clipped, 4) as clipped,
      round(standardized, 4) as standardized) from v_long"""
ORACLE["v1_group_accounts"] = """
    select outcome, count(distinct billing_account) as accounts from v_analysis group by 1"""
VIEWS["v_contact_reference"] = _reference("v_contacted")
VIEWS["v_contact_long"] = " union all ".join(
    f"""select likely_discount_shopper, '{m}' as metric, {m} as original,
        least(greatest({m}, f.p01), f.p99) as clipped,
        (least(greatest({m}, f.p01), f.p99) - f.center) / f.spread as standardized
      from v_contacted, (select * from v_contact_reference where metric = '{m}') f
      where {m} is not null"""
    for m in METRICS
)
VIEWS["v_scales"] = " union all ".join(
    f"select likely_discount_shopper, metric, '{s}' as scale, {s} as value from v_contact_long"
    for s in ("original", "clipped", "standardized")
)
ORACLE["v2_box_statistics"] = """
    select likely_discount_shopper, metric, scale, count(*) as n, round(q1, 4) as q1,
      round(med, 4) as median, round(q3, 4) as q3,
      round(least(min(value) filter (value >= q1 - 1.5 * (q3 - q1)), q1), 4) as whisker_low,
      round(greatest(max(value) filter (value <= q3 + 1.5 * (q3 - q1)), q3), 4) as whisker_high,
      count(*) filter (value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)) as fliers
    from v_scales join (select likely_discount_shopper, metric, scale, quantile_cont(value, 0.25) as q1,
      median(value) as med, quantile_cont(value, 0.75) as q3 from v_scales group by 1, 2, 3) b
      using (likely_discount_shopper, metric, scale)
    group by likely_discount_shopper, metric, scale, q1, med, q3"""
ORACLE["v3_profile_heatmap"] = f"""
    select segment_label || ' (n=' || users || ')' as row_label,
      {', '.join(r(f'score__{m}', m, 6) for m in METRICS)}
    from (select * from v_profiles order by profile_magnitude desc nulls last, users desc, segment_label
      limit 30)"""
ORACLE["v3_contrast_heatmap"] = f"""
    select segment_rank || '. ' || segment_label || ' (n=' || n__saved || '/' || n__stopped || ')' as row_label,
      {', '.join(r(f'delta__{m}', m, 6) for m in METRICS)}
    from v_contrasts where segment_rank < 20"""
ORACLE["v4_contrast_panels"] = " union all ".join(
    f"""select s.segment_rank, a.outcome, '{m}' as metric, round(a.score__{m}, 4) as score
      from v_selected s join v_scored a on {_SAME}"""
    for m in METRICS
)
ORACLE["v4_treatment_panel_accounts"] = f"""
    select s.segment_rank, a."Treatment", a.outcome, count(distinct a.billing_account) as accounts
    from v_treatments s join v_scored a on {_SAME} and a."Treatment" = s."Treatment"
    where s.supported group by 1, 2, 3"""
ORACLE["v5_clipped_panels"] = " union all ".join(
    f"""select s.segment_rank, a.outcome, '{m}' as metric, round(a.clip__{m}, 4) as value
      from v_selected s join v_scored a on {_SAME} where a.{m} is not null"""
    for m in METRICS
)
VIEWS["v_stages"] = """
    select cohort, contact_channel as contact_channel_1st,
      case contact_channel when 'Called-In first' then 'Then Online Cancel Flow'
        when 'Online first' then 'Then Called-In Cancel Flow' else contact_channel end
        as contact_channel_2nd, billing_account from v_outcomes"""
ORACLE["v6_journey_stages"] = "select * from v_stages"
_NAMES = """(values ('Three-Offer Cohort', 'Three-Variant Test'), ('Two-Offer Cohort', 'Two-Variant Test'),
    ('Called-In first', 'Called-In Cancel Flow'), ('Online first', 'Online Cancel Flow'))"""
VIEWS["v_links"] = f"""
    select a.shown as source, coalesce(b.shown, target_name) as target, value from (
      select cohort as source_name, contact_channel_1st as target_name,
        count(distinct billing_account) as value from v_stages group by 1, 2 union all
      select contact_channel_1st, contact_channel_2nd, count(distinct billing_account)
        from v_stages group by 1, 2) l
    left join {_NAMES} a(raw, shown) on a.raw = source_name
    left join {_NAMES} b(raw, shown) on b.raw = target_name
    where source_name <> target_name"""
ORACLE["v7_journey_links"] = "select * from v_links"
VIEWS["v_nodes"] = """
    select label, cast(row_number() over (order by label) - 1 as int) as node from (
      select source as label from v_links union select target from v_links) where label is not null"""
ORACLE["v8_journey_index"] = """
    select source, target, value, a.node as source_idx, b.node as target_idx from v_links
    left join v_nodes a on a.label = source left join v_nodes b on b.label = target"""


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in ORACLE.items()}
