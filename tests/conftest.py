import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.schemas import BY_KEY, CHANNELS  # noqa: E402
from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": 2,
            "spark.checkpoint.dir": tmp_path_factory.mktemp("shared"),
            "spark.sql.warehouse.dir": tmp_path_factory.mktemp("warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "customer_id": "CUST0001",
    "email": "ada.byron001@x.org",
    "first_name": "Ada",
    "last_name": "Byron",
    "device_platform": "iOS",
    "app_version": "7.0.0",
    "merchant_category": "Travel",
    "bnpl_plan": "pay_in_4",
    "installments": 4,
    "order_amount": Decimal("100.00"),
    "installment_amount": Decimal("25.00"),
    "status": "completed",
    "order_ts": dt.datetime(2026, 1, 2, 3, 4, 5),
    "partner_name": "HogarTotal",
    "partner_segment": "home",
    "integration_type": "widget",
    "principal_amount": Decimal("600.00"),
    "apr_pct": Decimal("10.00"),
    "term_months": 6,
    "monthly_payment": Decimal("110.00"),
    "approval_status": "approved",
    "originated_date": dt.date(2025, 11, 5),
    "utm_source": "email",
    "loan_purpose": "travel",
    "requested_amount": Decimal("1000.00"),
    "funded_amount": Decimal("800.00"),
    "credit_score": 700,
    "employment_status": "full_time",
    "annual_income": Decimal("50000.00"),
    "kyc_status": "passed",
    "applied_date": dt.date(2025, 9, 9),
    "card_partner": "PayLater MercadoBuy Visa",
    "credit_limit": Decimal("5000.00"),
    "current_balance": Decimal("1000.00"),
    "utilization_pct": Decimal("20.00"),
    "rewards_tier": "gold",
    "payment_behavior": "pays_full",
    "delinquency_days": 0,
    "account_status": "active",
    "account_opened": dt.date(2024, 6, 2),
}


@pytest.fixture
def table(spark):
    """table("mobile_app", {...}, {...}): a channel table from what its rows differ in."""

    def make(key, *rows):
        channel = BY_KEY[key]
        nullable = "\n".join(f"{f.name} {f.dataType.simpleString()}" for f in channel.schema)
        values = []
        for i, row in enumerate(rows, start=1):
            full = DEFAULTS | {channel.id_field: f"{channel.id_prefix}-CUST0001-{i:03d}"} | row
            values.append(tuple(full[f.name] for f in channel.schema))
        return spark.createDataFrame(values, nullable.replace("\n", ", "))

    return make


@pytest.fixture
def channels(table):
    """channels(mobile_app=[...], ...): all four channel tables; unnamed ones are empty."""

    def make(**rows):
        return {c.key: table(c.key, *rows.get(c.key, [])) for c in CHANNELS}

    return make
