"""Column functions against plain Python."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import amounts, display
from tessera.functions.json_rows import json_value


def one(spark, value, kind, function):
    return spark.createDataFrame([(value,)], f"x {kind}").select(function("x")).first()[0]


@pytest.mark.parametrize(
    "status, expected",
    [
        ("late_payment", "bad"), ("Declined", "bad"), ("FAILED", "bad"), ("closed", "bad"),
        ("frozen", "bad"), ("behind", "bad"), ("translated", "bad"), ("enclosed", "ok"),
        ("Manual_Review", "warn"), ("late review", "bad"), ("pays_minimum", "warn"),
        ("revolves", "warn"), ("revolves_x", "ok"), ("pays_full", "ok"), ("", "ok"), (None, None),
    ],
)
def test_severity(spark, status, expected):
    assert one(spark, status, "string", display.severity) == expected


@pytest.mark.parametrize(
    "amount, expected",
    [
        ("0.00", "$0"), ("0.50", "$1"), ("1.50", "$2"), ("2.50", "$3"), ("2.49", "$2"),
        ("1234567.50", "$1,234,568"), ("-1234.50", "-$1,235"), ("-0.40", "-$0"), (None, "—"),
        ("12345678901234567.49", "$12,345,678,901,234,567"),
    ],
)
def test_money(spark, amount, expected):
    value = None if amount is None else Decimal(amount)
    assert one(spark, value, "decimal(22,2)", display.whole_dollars) == expected


@pytest.mark.parametrize(
    "function, kind, value, expected",
    [
        (display.grouped_int, "bigint", 1234567, "1,234,567"),
        (display.grouped_int, "bigint", 0, "0"),
        (display.grouped_int, "bigint", None, "—"),
        (display.day_text, "string", "2026-01-02 03:04:05", "2026-01-02"),
        (display.day_text, "string", "", "—"),
        (display.day_text, "string", None, "—"),
        (display.day_text, "timestamp", dt.datetime(2026, 1, 2, 3), "2026-01-02"),
        (display.percent_text, "decimal(5,2)", Decimal("12.50"), "12.5%"),
        (display.percent_text, "decimal(5,2)", Decimal("100.00"), "100%"),
        (display.percent_text, "decimal(5,2)", Decimal("0.00"), "0%"),
        (display.percent_text, "decimal(5,2)", Decimal("0.07"), "0.07%"),
        (display.percent_text, "decimal(5,2)", Decimal("10.10"), "10.1%"),
        (display.percent_text, "decimal(3,0)", Decimal("100"), "100%"),
        (display.months_text, "int", 12, "12mo"),
        (display.channel_label, "string", "cobranded_card", "Co-branded Card"),
        (display.channel_label, "string", "fax", "fax"),
        (amounts.plan_installments, "string", "6mo_installments", 6),
        (amounts.plan_installments, "string", "never", None),
    ],
)
def test_texts(spark, function, kind, value, expected):
    assert one(spark, value, kind, function) == expected


def test_name_needs_both_parts(spark):
    rows = spark.createDataFrame([("A", "B"), ("A", None)], "first_name string, last_name string")
    assert [r[0] for r in rows.select(display.full_name()).collect()] == ["A B", None]


def half_even(value):
    return value.quantize(Decimal("0.01"))


money = st.decimals(min_value=0, max_value=99999, places=2)


@settings(max_examples=3, deadline=None)
@given(
    st.lists(
        st.tuples(
            money,
            st.sampled_from([4, 6, 12]),
            st.decimals(min_value=0, max_value=99, places=2),
            st.sampled_from([3, 6, 9, 12, 18, 24]),
        ),
        min_size=200,
        max_size=200,
    )
)
def test_derived_amounts(spark, rows):
    kind = (
        "order_amount decimal(10,2), installments int, apr_pct decimal(5,2), term_months int"
    )
    got = spark.createDataFrame(rows, kind).withColumn("principal_amount", F.col("order_amount"))
    got = got.select(
        "*", amounts.installment_amount().alias("i"), amounts.monthly_payment().alias("m")
    )
    for row in got.collect():
        assert row.i == half_even(row.order_amount / row.installments)
        rate = 1 + row.apr_pct / 100
        assert row.m == half_even(row.order_amount * rate / row.term_months)


def test_halves_go_to_even(spark):
    rows = [(Decimal("0.02"), 4), (Decimal("0.06"), 4), (Decimal("0.10"), 4)]
    df = spark.createDataFrame(rows, "order_amount decimal(10,2), installments int")
    got = [r[0] for r in df.select(amounts.installment_amount()).collect()]
    assert got == [Decimal("0.00"), Decimal("0.02"), Decimal("0.02")]
    card = spark.sql(
        "select cast(333.33 as decimal(12,2)) current_balance, "
        "explode(array(cast(1000 as decimal(12,2)), 0)) credit_limit"
    )
    got = [r[0] for r in card.select(amounts.utilization_pct()).collect()]
    assert got == [Decimal("33.33"), None]


def test_zero_divisors_give_null(spark):
    row = spark.sql(
        "select cast(5 as decimal(10,2)) order_amount, 0 installments, "
        "cast(5 as decimal(10,2)) principal_amount, cast(1 as decimal(5,2)) apr_pct, "
        "0 term_months"
    ).select(amounts.installment_amount(), amounts.monthly_payment()).first()
    assert tuple(row) == (None, None)


def test_json_values(spark):
    df = spark.sql(
        "select timestamp'2026-01-02 03:04:05' as a, timestamp_ntz'2026-01-02 03:04:05.25' as b, "
        "date'2026-01-02' as c, cast(1.50 as decimal(5,2)) as d, "
        "array(named_struct('x', cast(2 as decimal(5,2)), 'y', cast(null as date))) as e, "
        "cast(null as struct<x: date>) as f, cast(null as array<date>) as g"
    )
    row = df.select(*(json_value(F.col(f.name), f.dataType) for f in df.schema)).first()
    assert row[0] == "2026-01-02T03:04:05+00:00"
    assert row[1] == "2026-01-02T03:04:05.250000"
    assert row[2] == "2026-01-02" and row[3] == 1.5
    assert row[4][0].asDict() == {"x": 2.0, "y": None}
    assert row[5] is None and row[6] is None
