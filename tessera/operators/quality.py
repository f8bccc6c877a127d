"""Checks of the channel tables against the rules their rows should follow.

Every report has a row per rule, also when nothing violates it, and reads each table once:
the rules become counts of one global aggregate, combined on the map side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tessera.functions.amounts import INSTALLMENT_AMOUNT, MONTHLY_PAYMENT, UTILIZATION_PCT
from tessera.schemas import (
    CARD,
    DATE_WINDOWS,
    DOMAINS,
    INSTALLMENTS,
    MOBILE,
    PARTNER,
    PARTNER_SEGMENTS,
    RANGES,
    WEB,
    Channel,
)
from tessera.sources.tables import Channels, described


def rule_report(df: DataFrame, channel: Channel, rules: dict[str, str]) -> DataFrame:
    """``rules``: name -> SQL condition that a row breaking it meets. A condition that is
    null does not count."""
    counts = [f"count_if({broken}) as rule_{i}" for i, broken in enumerate(rules.values())]
    rows = ", ".join(f"'{name}', rule_{i}" for i, name in enumerate(rules))
    return df.selectExpr("count(*) as rows_checked", *counts).selectExpr(
        f"'{channel.key}' as channel",
        f"stack({len(rules)}, {rows}) as (rule, violations)",
        "rows_checked",
    )


def _reports(channels: Channels, rules_of) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [rule_report(df, c, rules_of(c)) for c, df in described(channels)],
    )


def _words(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def scan_counts(channels: Channels) -> DataFrame:
    """Rows and customers of each channel table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.selectExpr("count(*) as row_count", "count(distinct email) as customers")
            .selectExpr(f"'{c.key}' as channel", "row_count", "customers")
            for c, df in described(channels)
        ],
    )


def installment_check(mobile: DataFrame) -> DataFrame:
    known = " ".join(f"when '{plan}' then {n}" for plan, n in INSTALLMENTS.items())
    return rule_report(
        mobile,
        MOBILE,
        {"installments_of_plan": f"not (installments <=> case bnpl_plan {known} end)"},
    )


def derived_amount_violations(channels: Channels) -> DataFrame:
    """Stored instalments and monthly payments that differ from their derivation. A divisor of
    zero has no derivation and is a violation of its own."""
    rules = {
        MOBILE.key: {
            "installment_amount": f"installment_amount <> {INSTALLMENT_AMOUNT}",
            "installments_zero": "installments = 0",
        },
        PARTNER.key: {
            "monthly_payment": f"monthly_payment <> {MONTHLY_PAYMENT}",
            "term_months_zero": "term_months = 0",
        },
    }
    given = {k: df for k, df in channels.items() if k in rules}
    return _reports(given, lambda c: rules[c.key])


def utilization_check(card: DataFrame) -> DataFrame:
    return rule_report(
        card,
        CARD,
        {
            "utilization_of_balance": f"abs(utilization_pct - {UTILIZATION_PCT}) > 0.01",
            "utilization_over_100": "utilization_pct > 100",
        },
    )


def funding_rule_violations(web: DataFrame) -> DataFrame:
    share = "funded_amount between bround(requested_amount * 0.6, 2) and requested_amount"
    return rule_report(
        web,
        WEB,
        {
            "unfunded_unless_passed": "kyc_status <> 'passed' and funded_amount <> 0",
            "funded_share_when_passed": f"kyc_status = 'passed' and not ({share})",
        },
    )


def delinquency_rule_violations(card: DataFrame) -> DataFrame:
    return rule_report(
        card,
        CARD,
        {
            "no_days_unless_behind": "payment_behavior <> 'behind' and delinquency_days <> 0",
            "days_30_60_90_when_behind": "payment_behavior = 'behind' and "
            "delinquency_days not in (30, 60, 90)",
        },
    )


def accepted_values_rules(c: Channel) -> dict[str, str]:
    found = {n: f"{n} not in ({_words(words)})" for n, words in DOMAINS[c.key].items()}
    if c is PARTNER:
        pairs = ", ".join(f"({_words(pair)})" for pair in PARTNER_SEGMENTS.items())
        found["partner_and_segment"] = f"(partner_name, partner_segment) not in ({pairs})"
    return found


def accepted_values_report(channels: Channels) -> DataFrame:
    """Values outside the closed lists; partner and segment count as a pair."""
    return _reports(channels, accepted_values_rules)


def _continues(text: str, prefix: str, pattern: str) -> str:
    """Whether ``text`` is ``prefix`` followed by ``pattern``; null if either is."""
    rest = f"substring({text}, length({prefix}) + 1)"
    return f"(startswith({text}, {prefix}) and {rest} rlike '{pattern}')"


def id_format_violations(channels: Channels) -> DataFrame:
    """Ids of the form PREFIX-<customer id>-001 and CUST0001, and e-mails made of the row's
    own names: first.last001@domain. A missing value breaks the rule."""
    names = "concat(lower(first_name), '.', lower(last_name))"

    def rules(c: Channel) -> dict[str, str]:
        prefix = f"concat('{c.id_prefix}-', customer_id, '-')"
        good = {
            c.id_field: _continues(c.id_field, prefix, "^[0-9]{3,}$"),
            "customer_id": "customer_id rlike '^CUST[0-9]{4,}$'",
            "email_names": f"startswith(email, {names})",
            "email": _continues("email", names, "^[0-9]{3,}@[^@]+$"),
        }
        return {name: f"not coalesce({rule}, false)" for name, rule in good.items()}

    return _reports(channels, rules)


def range_rules(c: Channel) -> dict[str, str]:
    first, days = DATE_WINDOWS[c.key]
    start, end = f"date '{first}'", f"date_add(date '{first}', {days})"
    if c is MOBILE:
        start = f"timestamp({start})"
        end = f"timestamp({end}) + interval 1440 minutes"
    found = {c.time_field: f"{c.time_field} not between {start} and {end}"}
    for name, (low, high) in RANGES[c.key].items():
        found[name] = f"{name} not between {low} and {high}"
    if c is CARD:
        most = "bround(credit_limit * 1.05, 2)"
        found["current_balance"] = f"current_balance not between 0 and {most}"
    return found


def range_report(channels: Channels) -> DataFrame:
    """Dates outside their channel's window and numbers outside their range. Order times
    may run to the end of the day after the window's last."""
    return _reports(channels, range_rules)


def null_report(channels: Channels) -> DataFrame:
    """Nulls in each column; none is allowed in any."""
    return _reports(channels, lambda c: {f.name: f"{f.name} is null" for f in c.schema})
