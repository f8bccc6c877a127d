"""Each rule is broken by hand-made rows and counted once."""

import datetime as dt
from decimal import Decimal

import pytest

from tessera.operators import events, quality
from tessera.schemas import CHANNELS


def violations(report):
    return {(r["channel"], r["rule"]): r["violations"] for r in report.collect()}


def broken(report):
    return {rule: n for (_, rule), n in violations(report).items() if n}


REPORTS = (
    quality.accepted_values_report,
    quality.id_format_violations,
    quality.range_report,
    quality.null_report,
    quality.derived_amount_violations,
)


@pytest.mark.parametrize("report", REPORTS)
def test_good_and_empty_tables_break_nothing(channels, report):
    good = channels(
        mobile_app=[{}],
        partner_checkout=[{"term_months": 6}],
        web_portal=[{}],
        cobranded_card=[{}],
    )
    assert broken(report(good)) == {}
    empty = report(channels()).collect()
    assert empty and all(r["rows_checked"] == 0 and r["violations"] == 0 for r in empty)


def test_accepted_values(channels):
    report = quality.accepted_values_report(
        channels(
            mobile_app=[{"status": "late"}, {"status": None}, {"app_version": "1"}],
            partner_checkout=[{"term_months": 7}],
            cobranded_card=[{"credit_limit": Decimal("1500.01")}],
        )
    )
    assert broken(report) == {
        "status": 1, "app_version": 1, "term_months": 1, "credit_limit": 1,
    }


def test_ids(channels):
    report = quality.id_format_violations(
        channels(
            mobile_app=[
                {"order_id": "MOB-CUST0002-001"},
                {"order_id": "MOB-CUST0001-01"},
                {"customer_id": "CUST1", "order_id": "MOB-CUST1-001"},
                {"email": "ada.byron@x.org"},
                {"email": "eve.byron001@x.org"},
                {"order_id": None},
            ]
        )
    )
    assert broken(report) == {"order_id": 3, "customer_id": 1, "email_names": 1, "email": 2}


def test_ranges(channels):
    report = quality.range_report(
        channels(
            mobile_app=[
                {"order_amount": Decimal("34.99")},
                {"order_amount": Decimal("1800.00")},
                {"order_ts": dt.datetime(2026, 4, 22)},
                {"order_ts": dt.datetime(2026, 4, 22, 0, 1)},
            ],
            partner_checkout=[{"apr_pct": Decimal("28.51")}],
            web_portal=[{"credit_score": 539}, {"applied_date": dt.date(2026, 4, 20)}],
            cobranded_card=[
                {"current_balance": Decimal("5250.01")},
                {"current_balance": Decimal("5250.00")},
                {"account_opened": dt.date(2024, 5, 31)},
            ],
        )
    )
    assert broken(report) == {
        "order_amount": 1, "order_ts": 1, "apr_pct": 1, "credit_score": 1,
        "applied_date": 1, "current_balance": 1, "account_opened": 1,
    }


def test_nulls(channels):
    report = quality.null_report(channels(web_portal=[{"email": None}, {"email": None}, {}]))
    assert broken(report) == {"email": 2}
    assert len(violations(report)) == sum(len(c.schema) for c in CHANNELS)


def test_amount_rules(table, channels):
    mobile = table("mobile_app", {"installments": 6}, {"bnpl_plan": "x"}, {})
    assert broken(quality.installment_check(mobile)) == {"installments_of_plan": 2}
    report = quality.derived_amount_violations(
        channels(
            mobile_app=[{"installment_amount": Decimal("25.01")}],
            partner_checkout=[{"monthly_payment": Decimal("109.99")}, {}],
        )
    )
    assert broken(report) == {"installment_amount": 1, "monthly_payment": 1}
    card = table(
        "cobranded_card",
        {"utilization_pct": Decimal("20.01")},
        {"utilization_pct": Decimal("20.02")},
        {"utilization_pct": Decimal("104.00"), "current_balance": Decimal("5200.00")},
        {"credit_limit": Decimal("0.00")},
    )
    assert broken(quality.utilization_check(card)) == {
        "utilization_of_balance": 1, "utilization_over_100": 1,
    }


def test_funding_and_delinquency(table):
    web = table(
        "web_portal",
        {"kyc_status": "failed"},
        {"kyc_status": "failed", "funded_amount": Decimal("0.00")},
        {"funded_amount": Decimal("599.99")},
        {"funded_amount": Decimal("600.00")},
        {"funded_amount": Decimal("1000.01")},
    )
    assert broken(quality.funding_rule_violations(web)) == {
        "unfunded_unless_passed": 1, "funded_share_when_passed": 2,
    }
    card = table(
        "cobranded_card",
        {"delinquency_days": 30},
        {"payment_behavior": "behind"},
        {"payment_behavior": "behind", "delinquency_days": 90},
    )
    assert broken(quality.delinquency_rule_violations(card)) == {
        "no_days_unless_behind": 1, "days_30_60_90_when_behind": 1,
    }


def test_scan_counts_and_statuses(channels):
    built = channels(
        mobile_app=[{"status": "active"}, {"status": "late_payment"}, {"email": "b@x.org"}],
        cobranded_card=[{"payment_behavior": "behind", "account_status": "closed"}],
    )
    counts = {r["channel"]: (r["row_count"], r["customers"])
              for r in quality.scan_counts(built).collect()}
    assert counts["mobile_app"] == (3, 2) and counts["web_portal"] == (0, 0)
    rows = {(r["field"], r["status"]): (r["severity"], r["events"])
            for r in events.status_severity_summary(built).collect()}
    assert rows == {
        ("status", "active"): ("ok", 1),
        ("status", "late_payment"): ("bad", 1),
        ("status", "completed"): ("ok", 1),
        ("payment_behavior", "behind"): ("bad", 1),
        ("account_status", "closed"): ("bad", 1),
    }
