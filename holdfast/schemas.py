"""Schemas of the source tables and of the run log, as DDL strings."""

from __future__ import annotations


def _schema(**columns: str) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


SUBSCRIPTIONS = _schema(
    id_subscrip="string", effective_date="date", end_date="date",
    mdm_product_id="string", consumer_ids="array<string>",
)
PRODUCT = _schema(product_id="string", publication_id="string", website_id="string")
PUBLICATION = _schema(publication_id="string", publication_name="string")
SUBSCRIPTION_LINK = _schema(
    circ_idsubscrip="string", billing_account="string", billing_system="string",
    circ_status="string", circ_site="string", product_type="string",
)
RISK_TIERS = _schema(inference_date="date", id_subscrip="string", risk_tier="string")
WEB_EVENTS = _schema(
    event_date="date", d049_user_anonymous_id="string", d031_website_id="string",
    d027_event_detail="string",
)
KNOWN_CONSUMERS = _schema(
    consumer_id="string", anonymous_id_1="string", anonymous_id_2="string",
    anonymous_id_3="string",
)
ASSIGNMENTS = _schema(
    subscription="string", currentrate="decimal(18,2)", newrate="decimal(18,2)",
    stopsave="decimal(18,2)", effective="date", modeltype="string", grouptype="string",
    filedate="date",
)
CALL_CENTER = _schema(
    Account="string", idSubscrip="string", event_date="date", Saves__Digital_to_Digital_="int",
)
START_STOP = _schema(
    id_subscrip="string", transaction_date="date", create_date="date", is_perm_stop="int",
)
METRICS = _schema(
    inference_date="date", id_subscrip="string", frequency="double", breadth="double",
    tenure="double", tt_cost="double",
)
INVOICE_PAYMENTS = _schema(
    account="string", id_subscrip="string", invoice_number="string",
    amount_without_tax="decimal(18,2)", balance="decimal(18,2)", amount="decimal(18,2)",
    id_payment_date="date", id_decline_date="date", status="string",
)
RATE_HISTORY = _schema(
    id_subscrip="string", effective_date="date", end_date="date", rate_key_value="string",
    rate_key_system="string",
)
RATE_MAPPING = _schema(
    rate_key_value="string", rate_key_system="string", monthly_price="string",
)
_RUN_LOG = dict(
    execution_timestamp="string", run_date="string", target_table="string", sql_file="string",
    row_count="bigint", null_percentage="double", row_count_passed="boolean",
    nulls_passed="boolean",
)
RUN_LOG = _schema(**_RUN_LOG)
RUN_LOG_FIELDS = tuple(_RUN_LOG)
