"""Business label rules, each as one column expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label vocabularies shared by the outcome tables and the analysis.
NO_ACTION = "No Action yet"
CALLED_FIRST = "Called-In first"
ONLINE_FIRST = "Online first"
CALL_ONLY = "Called-In Cancel Flow"
ONLINE_ONLY = "Online Cancel Flow"
BOTH_WAYS = "Contacted both ways"
THREE_OFFER = "Three-Offer Cohort"
TWO_OFFER = "Two-Offer Cohort"
TREATMENTS = ("Control", "Midpoint", "Tiered")
BEFORE_PRICING = "Contact Before Pricing"
AFTER_PRICING = "Contact On/After Pricing"
PAY_LESS = "Pay less than start rate"
SAVED, STOPPED = "Saved", "Stopped"
OUTCOMES = (SAVED, STOPPED)
LABEL_SEPARATOR = " · "
MISSING = "Missing"
ORDINALS = ("1st", "2nd", "3rd", "4th", "5th", "6th", "7th", "8th", "9th")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cohort_label(model_type: Column | str) -> Column:
    return F.when(_col(model_type) == "PCHURN", THREE_OFFER).otherwise(TWO_OFFER)


def treatment_label(group_type: Column | str) -> Column:
    group_type = _col(group_type)
    return (
        F.when(group_type == "MIDPOINT", "Midpoint")
        .when(group_type == "CONTROL", "Control")
        .otherwise("Tiered")
    )


def contact_channel(
    called_in: Column | str,
    opened_page: Column | str,
    call_date: Column | str,
    page_date: Column | str,
) -> Column:
    """Which channel a subscriber used, and which came first when both were."""
    called, opened = _col(called_in) == 1, _col(opened_page) == 1
    page_first = _col(call_date) >= _col(page_date)
    return (
        F.when(~called & ~opened, NO_ACTION)
        .when(called & opened & page_first, ONLINE_FIRST)
        .when(called & opened, CALLED_FIRST)
        .when(called, CALL_ONLY)
        .otherwise(ONLINE_ONLY)
    )


def earliest(*dates: Column | str) -> Column:
    """Earliest of the dates that exist; `least` already skips NULL in Spark."""
    return F.least(*[_col(d) for d in dates])


def status(contact: Column | str, cancel: Column | str, stopped: Column | str) -> Column:
    """Outcome status. The spelling `stoped` is part of the data contract."""
    contact, cancel, stopped = _col(contact), _col(cancel), _col(stopped)
    return (
        F.when(contact.isNull(), NO_ACTION)
        .when((stopped == 1) & cancel.isNotNull(), "stoped")
        .when(stopped == 1, "unknown stoped")
        .when((stopped == 0) & cancel.isNull(), "saved")
        .when(stopped == 0, "unknown saved")
        .otherwise("others")
    )


def churned(contact: Column | str, cancel: Column | str, stopped: Column | str) -> Column:
    """1 churned, 0 retained or untouched, NULL when the signals conflict."""
    contact, cancel, stopped = _col(contact), _col(cancel), _col(stopped)
    return (
        F.when((stopped == 1) & cancel.isNotNull(), 1)
        .when((stopped == 0) & cancel.isNull(), 0)
        .when(contact.isNull(), 0)
    )


def contact_timing(contact: Column | str, pricing_date: Column | str) -> Column:
    """No contact at all falls to the On/After side."""
    return F.when(_col(contact) < _col(pricing_date), BEFORE_PRICING).otherwise(
        AFTER_PRICING
    )


def payment_status(
    paid_on: Column | str,
    declined_on: Column | str,
    amount: Column | str,
    invoice_status: Column | str,
) -> Column:
    """Settle an invoice from its payment and decline dates."""
    paid, declined = _col(paid_on), _col(declined_on)
    free_first_invoice = (_col(amount) == 0) & (_col(invoice_status) == "Posted")
    return (
        F.when(paid.isNotNull() & declined.isNull(), "Paid")
        .when(paid >= declined, "Paid")
        .when(paid.isNull() & declined.isNull() & free_first_invoice, "Paid")
        .when(paid.isNull(), "Not Paid")
        .when(paid < declined, "Not Paid")
        .otherwise("Other")
    )


def market(name: Column | str, rules: Sequence[str]) -> Column:
    """First rule contained in the publication name (any case), else the name."""
    name = _col(name)
    result = name
    for rule in reversed(rules):
        result = F.when(F.contains(F.lower(name), F.lit(rule.lower())), rule).otherwise(
            result
        )
    return result


def web_flags(detail: Column | str) -> dict[str, Column]:
    """Cancel-flow flags read from a web event's detail text."""
    text = F.lower(_col(detail))

    def has(token: str) -> Column:
        return F.contains(text, F.lit(token))

    # The tokens the web tracker writes.
    rules = {
        "entered_acc_mng": has("managesubscription") & has("cancel"),
        "confirmed_cancel": has("snap|cancelsubscription") & ~has("winback-zuora"),
        "success_save": has("stopsave") & has("success"),
    }
    return {name: F.when(rule, 1).otherwise(0) for name, rule in rules.items()}


def ordinal(rank: Column | str) -> Column:
    """`1st` to `9th`, then the plain number."""
    rank = _col(rank)
    words = F.array(*[F.lit(word) for word in ORDINALS])
    return F.when(rank.between(1, len(ORDINALS)), F.get(words, rank - 1)).otherwise(
        rank.cast("string")
    )


def segment_label(fields: Sequence[str]) -> Column:
    """Readable segment name, missing parts spelled out."""
    return F.concat_ws(
        LABEL_SEPARATOR,
        *[F.coalesce(F.col(f).cast("string"), F.lit(MISSING)) for f in fields],
    )


def channel_group(channel: Column | str) -> Column:
    channel = _col(channel)
    return F.when(channel.isin(ONLINE_FIRST, CALLED_FIRST), BOTH_WAYS).otherwise(channel)


def shopper_class(repeatedly_called: Column | str, group: Column | str) -> Column:
    """Both-ways contact outranks having paid less than the start rate."""
    return (
        F.when(_col(group) == BOTH_WAYS, BOTH_WAYS)
        .when(F.coalesce(_col(repeatedly_called).cast("int"), F.lit(0)) == 1, PAY_LESS)
        .otherwise("Other")
    )


def outcome(status_col: Column | str) -> Column:
    status_col = _col(status_col)
    return F.when(status_col == "saved", SAVED).when(status_col == "stoped", STOPPED)


def risk_tier(tier: Column | str) -> Column:
    tier = _col(tier).cast("string")
    return F.when(tier.endswith(" risk"), tier).otherwise(F.concat(tier, F.lit(" risk")))


def second_stage(channel: Column | str) -> Column:
    """What a subscriber did after the first contact."""
    channel = _col(channel)
    return (
        F.when(channel == CALLED_FIRST, f"Then {ONLINE_ONLY}")
        .when(channel == ONLINE_FIRST, f"Then {CALL_ONLY}")
        .otherwise(channel)
    )
