"""The data model: four channel tables in, one wide profile table out.

Every other module is driven by the :class:`Channel` descriptions below, so a column
name, a roll-up or an event field is stated here and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

IDENTITY = ("customer_id", "email", "first_name", "last_name")

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money10": T.DecimalType(10, 2),
    "money12": T.DecimalType(12, 2),
    "pct": T.DecimalType(5, 2),
}


@dataclass(frozen=True)
class Rollup:
    """One per-customer measure: ``how`` is count, sum or max over ``source``."""

    name: str
    how: str
    source: str | None
    type: T.DataType


@dataclass(frozen=True)
class Channel:
    key: str
    label: str
    table: str
    comment: str
    id_prefix: str
    columns: tuple[tuple[str, str], ...]  # the id column first, then all but identity
    events: str  # name of the array column in the profile
    event_fields: tuple[str, ...]
    time_field: str
    status_fields: tuple[str, ...]
    rollups: tuple[Rollup, ...]

    @property
    def id_field(self) -> str:
        return self.columns[0][0]

    @property
    def count(self) -> str:
        """The roll-up that counts the channel's rows; above zero means present."""
        return self.rollups[0].name

    @property
    def schema(self) -> T.StructType:
        (id_name, id_type), *rest = self.columns
        named = [(id_name, id_type), *((name, "string") for name in IDENTITY), *rest]
        return T.StructType([T.StructField(n, _TYPES[t], False) for n, t in named])

    @property
    def event_type(self) -> T.StructType:
        """Fields kept in the profile's array; the time is carried as text."""
        types = dict(self.columns) | {self.time_field: "string"}
        return T.StructType([T.StructField(f, _TYPES[types[f]]) for f in self.event_fields])


def _count(name):
    return Rollup(name, "count", None, T.LongType())


def _sum(name, source, precision):
    # sum() widens a decimal by ten digits; this is the type the profile carries.
    return Rollup(name, "sum", source, T.DecimalType(precision + 10, 2))


def _max(name, source):
    return Rollup(name, "max", source, T.IntegerType())


# Table, column and channel names that callers rely on.
MOBILE = Channel(
    key="mobile_app",
    label="Mobile App",
    table="mobile_app_purchases",
    comment="Purchases made in the mobile app, one row per order",
    id_prefix="MOB",
    columns=(
        ("order_id", "string"),
        ("device_platform", "string"),
        ("app_version", "string"),
        ("merchant_category", "string"),
        ("bnpl_plan", "string"),
        ("installments", "int"),
        ("order_amount", "money10"),
        ("installment_amount", "money10"),
        ("status", "string"),
        ("order_ts", "timestamp"),
    ),
    events="mobile_app_events",
    event_fields=(
        "order_id", "merchant_category", "bnpl_plan", "order_amount", "status", "order_ts",
    ),
    time_field="order_ts",
    status_fields=("status",),
    rollups=(
        _count("mobile_app_order_count"),
        _sum("mobile_app_total_spend", "order_amount", 10),
    ),
)

PARTNER = Channel(
    key="partner_checkout",
    label="Partner Checkout",
    table="partner_checkout_loans",
    comment="Loans taken at partner shops, one row per loan",
    id_prefix="PRT",
    columns=(
        ("loan_id", "string"),
        ("partner_name", "string"),
        ("partner_segment", "string"),
        ("integration_type", "string"),
        ("principal_amount", "money10"),
        ("apr_pct", "pct"),
        ("term_months", "int"),
        ("monthly_payment", "money10"),
        ("approval_status", "string"),
        ("originated_date", "date"),
    ),
    events="partner_loan_events",
    event_fields=(
        "loan_id", "partner_name", "principal_amount", "apr_pct", "term_months",
        "approval_status", "originated_date",
    ),
    time_field="originated_date",
    status_fields=("approval_status",),
    rollups=(
        _count("partner_loan_count"),
        _sum("partner_total_principal", "principal_amount", 10),
    ),
)

WEB = Channel(
    key="web_portal",
    label="Web Portal",
    table="web_portal_signups",
    comment="Loan applications made on the web portal, one row per application",
    id_prefix="WEB",
    columns=(
        ("application_id", "string"),
        ("utm_source", "string"),
        ("loan_purpose", "string"),
        ("requested_amount", "money12"),
        ("funded_amount", "money12"),
        ("credit_score", "int"),
        ("employment_status", "string"),
        ("annual_income", "money12"),
        ("kyc_status", "string"),
        ("applied_date", "date"),
    ),
    events="web_application_events",
    event_fields=(
        "application_id", "utm_source", "loan_purpose", "requested_amount", "funded_amount",
        "credit_score", "kyc_status", "applied_date",
    ),
    time_field="applied_date",
    status_fields=("kyc_status",),
    rollups=(
        _count("web_application_count"),
        _sum("web_total_funded", "funded_amount", 12),
        _max("web_max_credit_score", "credit_score"),
    ),
)

CARD = Channel(
    key="cobranded_card",
    label="Co-branded Card",
    table="cobranded_card_accounts",
    comment="Co-branded card accounts, one row per account",
    id_prefix="CARD",
    columns=(
        ("account_id", "string"),
        ("card_partner", "string"),
        ("credit_limit", "money12"),
        ("current_balance", "money12"),
        ("utilization_pct", "pct"),
        ("rewards_tier", "string"),
        ("payment_behavior", "string"),
        ("delinquency_days", "int"),
        ("account_status", "string"),
        ("account_opened", "date"),
    ),
    events="card_account_events",
    event_fields=(
        "account_id", "card_partner", "credit_limit", "current_balance", "utilization_pct",
        "rewards_tier", "payment_behavior", "delinquency_days", "account_status",
        "account_opened",
    ),
    time_field="account_opened",
    status_fields=("payment_behavior", "account_status"),
    rollups=(
        _count("card_account_count"),
        _sum("card_total_credit_limit", "credit_limit", 12),
        _sum("card_total_balance", "current_balance", 12),
        _max("card_max_delinquency_days", "delinquency_days"),
    ),
)

CHANNELS = (MOBILE, PARTNER, WEB, CARD)  # also the order inside channels_used
BY_KEY = {c.key: c for c in CHANNELS}

EVENT_COLUMNS = tuple(c.events for c in CHANNELS)
ROLLUPS = tuple(r for c in CHANNELS for r in c.rollups)
ROLLUP_COLUMNS = tuple(r.name for r in ROLLUPS)
COUNT_COLUMNS = tuple(c.count for c in CHANNELS)

FLAT_COLUMNS = (*IDENTITY, *ROLLUP_COLUMNS, "channels_used", "channel_count")
PROFILE_COLUMNS = (
    *IDENTITY, *EVENT_COLUMNS, *ROLLUP_COLUMNS,
    "channels_used", "channel_count", "profile_last_updated",
)
# A single-profile answer lists the same columns with the arrays near the end.
LOOKUP_COLUMNS = (
    *IDENTITY, "channels_used", "channel_count", *ROLLUP_COLUMNS, *EVENT_COLUMNS,
    "profile_last_updated",
)
SUMMARY_COLUMNS = (*IDENTITY, "channel_count", "channels_used", *COUNT_COLUMNS)

# The accepted words of each enumerated column.
DOMAINS = {
    "mobile_app": {
        "device_platform": ("iOS", "Android"),
        "app_version": ("6.4.1", "6.5.0", "6.6.2", "7.0.0"),
        "merchant_category": (
            "Electronics", "Apparel", "Home Goods", "Beauty", "Sports", "Travel",
        ),
        "bnpl_plan": ("pay_in_4", "6mo_installments", "12mo_installments"),
        "status": ("completed", "active", "late_payment"),
    },
    "partner_checkout": {
        "integration_type": ("widget", "redirect", "headless_api"),
        "term_months": (3, 6, 9, 12, 18, 24),
        "approval_status": ("approved", "manual_review", "declined"),
    },
    "web_portal": {
        "utm_source": ("google_ads", "meta_ads", "tiktok", "organic", "email", "referral"),
        "loan_purpose": (
            "debt_consolidation", "home_improvement", "auto_repair", "medical", "education",
            "wedding", "travel", "small_business",
        ),
        "kyc_status": ("passed", "manual_review", "failed"),
        "employment_status": (
            "full_time", "self_employed", "part_time", "contractor", "unemployed",
        ),
    },
    "cobranded_card": {
        "card_partner": (
            "PayLater MercadoBuy Visa", "PayLater ModaPlus Mastercard",
            "PayLater ElektroMart Visa", "PayLater ViajaYa World Elite",
        ),
        "credit_limit": (1500, 3000, 5000, 7500, 10000, 15000, 25000),
        "rewards_tier": ("standard", "silver", "gold", "platinum"),
        "payment_behavior": ("pays_full", "pays_minimum", "revolves", "behind"),
        "account_status": ("active", "frozen", "closed"),
    },
}

# The partners and the segment of each.
PARTNER_SEGMENTS = {
    "MercadoBuy": "marketplace",
    "ElektroMart": "electronics",
    "ModaPlus": "fashion",
    "HogarTotal": "home",
    "ViajaYa": "travel",
    "DeporteMax": "sports",
    "FarmaPlus": "pharmacy",
}

# Instalments of each payment plan.
INSTALLMENTS = {"pay_in_4": 4, "6mo_installments": 6, "12mo_installments": 12}

# Sample size and seed per channel.
SAMPLE_SIZE = 100
SAMPLE_SEEDS = {
    "mobile_app": 101,
    "partner_checkout": 202,
    "web_portal": 303,
    "cobranded_card": 404,
}

# First day and number of days of each channel's dates.
DATE_WINDOWS = {
    "mobile_app": ("2026-01-01", 110),
    "partner_checkout": ("2025-11-01", 170),
    "web_portal": ("2025-09-01", 230),
    "cobranded_card": ("2024-06-01", 600),
}

# Lowest and highest plausible value of each number.
RANGES = {
    "mobile_app": {"order_amount": ("35", "1800")},
    "partner_checkout": {"principal_amount": ("150", "6500"), "apr_pct": ("0", "28.5")},
    "web_portal": {
        "requested_amount": ("500", "25000"),
        "credit_score": ("540", "820"),
        "annual_income": ("18000", "180000"),
    },
    "cobranded_card": {"utilization_pct": ("0", "105")},
}
