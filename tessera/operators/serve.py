"""The read queries over a profile: statistics, lists, search, lookup, export, display.

All take a profile DataFrame, flat or nested, freshly built or read from a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import display
from tessera.functions.json_rows import json_object
from tessera.schemas import COUNT_COLUMNS, EVENT_COLUMNS, LOOKUP_COLUMNS, SUMMARY_COLUMNS

DEFAULT_LIMIT = 50
MAX_LIMIT = 500

# Statistic -> the profile column it adds up, in the order they are reported.
TOTAL_COUNTS = {
    "total_mobile_orders": "mobile_app_order_count",
    "total_partner_loans": "partner_loan_count",
    "total_web_applications": "web_application_count",
    "total_card_accounts": "card_account_count",
}
TOTAL_AMOUNTS = {
    "total_mobile_spend": "mobile_app_total_spend",
    "total_partner_principal": "partner_total_principal",
    "total_web_funded": "web_total_funded",
    "total_card_balance": "card_total_balance",
}
TILE_LABELS = {
    "total_customers": "Customers",
    "multi_channel_customers": "Multi-channel",
    "total_mobile_orders": "Mobile orders",
    "total_partner_loans": "Partner loans",
    "total_web_applications": "Web apps",
    "total_card_accounts": "Card accounts",
    "total_mobile_spend": "Mobile $",
    "total_partner_principal": "Partner $",
    "total_web_funded": "Web funded $",
    "total_card_balance": "Card balance $",
}


def lowered_email(profiles: DataFrame) -> Column:
    """The stored lower-case e-mail where there is one: a filter on it reaches the scan."""
    return F.col("email_lc") if "email_lc" in profiles.columns else F.lower("email")


def check_limit(limit: int) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be a whole number from 1 to {MAX_LIMIT}, not {limit!r}")
    return limit


def portfolio_stats(profiles: DataFrame) -> DataFrame:
    """One row. Amounts are added as decimals and become floats once, at the end; on an
    empty profile every sum is null."""
    multi = F.when(F.col("channel_count") > 1, 1).otherwise(0)
    return profiles.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(multi).alias("multi_channel_customers"),
        *(F.sum(column).alias(name) for name, column in TOTAL_COUNTS.items()),
        *(F.sum(column).cast("double").alias(name) for name, column in TOTAL_AMOUNTS.items()),
    )


def portfolio_partials(profiles: DataFrame, *keys: str) -> DataFrame:
    """The statistics of each group of profiles, in a form that adds up: a row per key. Kept
    beside the profiles by bucket, they answer `portfolio_of` without reading profiles."""
    return profiles.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(F.when(F.col("channel_count") > 1, 1).otherwise(0)).alias("multi_channel_customers"),
        *(
            F.sum(column).alias(name) for name, column in (TOTAL_COUNTS | TOTAL_AMOUNTS).items()
        ),
    )


def portfolio_of(partials: DataFrame) -> DataFrame:
    """The row of `portfolio_stats` out of partial statistics. Decimals stay exact to the end."""
    return partials.agg(
        F.coalesce(F.sum("total_customers"), F.lit(0)).alias("total_customers"),
        *(F.sum(name).alias(name) for name in ("multi_channel_customers", *TOTAL_COUNTS)),
        *(F.sum(name).cast("double").alias(name) for name in TOTAL_AMOUNTS),
    )


def portfolio_tiles(stats: DataFrame) -> DataFrame:
    """The statistics as labelled texts, one row each."""
    tiles = []
    for position, (name, label) in enumerate(TILE_LABELS.items(), start=1):
        show = display.whole_dollars if name in TOTAL_AMOUNTS else display.grouped_int
        tiles.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(label).alias("label"),
                show(name).alias("value"),
            )
        )
    return stats.select(F.inline(F.array(*tiles)))


def load_report(profiles: DataFrame) -> DataFrame:
    """How many customers, and how many in several channels, in one pass."""
    return profiles.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("channel_count") > 1).alias("multi_channel_customers"),
    )


def multi_channel_customers(profiles: DataFrame) -> DataFrame:
    return profiles.filter(F.col("channel_count") > 1)


def customers_top(profiles: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    check_limit(limit)
    return (
        profiles
        .select(*SUMMARY_COLUMNS)
        .orderBy(F.col("channel_count").desc(), "email")
        .limit(limit)
    )


def customers_search(
    profiles: DataFrame, q: str, limit: int = DEFAULT_LIMIT, wildcard: bool = False
) -> DataFrame:
    """Customers whose e-mail or "first last" contains ``q``, whatever the case.

    ``wildcard`` reads ``%`` and ``_`` in ``q`` as LIKE does. A missing name part leaves
    the e-mail as the only place to match.
    """
    check_limit(limit)
    email, name = lowered_email(profiles), F.lower(display.full_name())
    if wildcard:
        pattern = F.lower(F.lit(f"%{q}%"))
        found = F.like(email, pattern) | F.like(name, pattern)
    else:
        text = F.lower(F.lit(q))
        found = email.contains(text) | name.contains(text)
    return (
        profiles
        .filter(found)
        .select(*SUMMARY_COLUMNS)
        .orderBy("email")
        .limit(limit)
    )


def list_customers(
    profiles: DataFrame,
    q: str | None = None,
    limit: int = DEFAULT_LIMIT,
    wildcard: bool = False,
) -> DataFrame:
    """The search if there is anything to search for, else the top list."""
    q = (q or "").strip()
    if q:
        return customers_search(profiles, q, limit, wildcard)
    return customers_top(profiles, limit)


def _lookup_columns(profiles: DataFrame) -> list[str]:
    return [c for c in LOOKUP_COLUMNS if c in profiles.columns]


def profile_lookup(profiles: DataFrame, email: str) -> DataFrame:
    """The profile of one e-mail in any case: the first by exact e-mail if several differ
    only in case. No row if there is none."""
    found = profiles.filter(lowered_email(profiles) == F.lower(F.lit(email)))
    return found.select(*_lookup_columns(profiles)).orderBy("email").limit(1)


def _wanted(wanted: DataFrame) -> DataFrame:
    return wanted.select(F.lower("email").alias("wanted_lc")).filter("wanted_lc is not null")


def lookup_many(profiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The profiles of many e-mails at once; ``wanted`` has a column ``email``.

    No broadcast hint: the list may be of any length, so its size decides.
    """
    found = profiles.join(
        _wanted(wanted).distinct(),
        lowered_email(profiles) == F.col("wanted_lc"),
        "left_semi",
    )
    return found.select(*_lookup_columns(profiles))


def profiles_missing(profiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted e-mails, as written, that have no profile in any case."""
    known = profiles.select(lowered_email(profiles).alias("known_lc"))
    asked = wanted.select("email").filter("email is not null").distinct()
    return asked.join(known, F.lower("email") == F.col("known_lc"), "left_anti")


def channel_membership(profiles: DataFrame) -> DataFrame:
    """One row per customer and channel."""
    return profiles.select(
        "email", F.explode("channels_used").alias("channel")
    )


def channel_labels(profiles: DataFrame) -> DataFrame:
    labelled = profiles.select(
        "email", display.channel_labels("channels_used").alias("labels")
    )
    return labelled.select("email", F.explode("labels").alias("label"))


def profile_json(profiles: DataFrame) -> DataFrame:
    """One JSON text per row of a nested profile, to write as JSON lines."""
    return profiles.select("email", json_object(profiles.schema, LOOKUP_COLUMNS).alias("json"))


def profile_display(profiles: DataFrame) -> DataFrame:
    """A profile's header and tiles as text."""
    money, number = display.whole_dollars, display.grouped_int
    return profiles.select(
        "email",
        "customer_id",
        display.full_name().alias("display_name"),
        F.array_join(display.channel_labels("channels_used"), ", ").alias("channels"),
        *(
            [display.day_text("profile_last_updated").alias("last_updated")]
            if "profile_last_updated" in profiles.columns
            else []
        ),
        number("channel_count").alias("channel_count"),
        number("mobile_app_order_count").alias("mobile_orders"),
        money("mobile_app_total_spend").alias("mobile_spend"),
        number("partner_loan_count").alias("partner_loans"),
        money("partner_total_principal").alias("partner_principal"),
        number("web_application_count").alias("web_applications"),
        money("web_total_funded").alias("web_funded"),
        number("card_account_count").alias("cards"),
        money("card_total_balance").alias("card_balance"),
    )


def section_titles(profiles: DataFrame) -> DataFrame:
    """The "n events" line of each channel a customer has events in."""
    titles = F.array(*(
        F.struct(F.lit(name).alias("section"), F.col(count).alias("n"))
        for name, count in zip(EVENT_COLUMNS, COUNT_COLUMNS, strict=True)
    ))
    rows = profiles.select("email", F.inline(titles)).filter("n > 0")
    return rows.select("email", "section", display.events_text("n").alias("events"))
