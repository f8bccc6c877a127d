"""Consolidation: identity, zeros, order, types, and the two forms agreeing."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators.events import (
    event_histories,
    event_pages,
    event_rows,
    exploded_events,
)
from tessera.operators.identity import identity_resolution, identity_union
from tessera.operators.rollups import customer_activity
from tessera.plans.profile import profile_flat, profile_flat_joined, profile_nested
from tessera.schemas import BY_KEY, CHANNELS, FLAT_COLUMNS, MOBILE, PROFILE_COLUMNS, ROLLUPS

A, B, UPPER = "a@x.org", "b@x.org", "A@x.org"


def by_email(df):
    return {r["email"]: r.asDict(recursive=True) for r in df.collect()}


@pytest.fixture
def mixed(channels):
    return channels(
        mobile_app=[
            {"email": A, "order_id": "2", "order_amount": Decimal("10.10")},
            {"email": A, "order_id": "1", "order_amount": Decimal("0.05")},
            {"email": B, "customer_id": "CUST0002"},
            {"email": None, "customer_id": "CUST0009"},
            {"email": UPPER, "customer_id": "CUST0003"},
        ],
        partner_checkout=[
            {"email": A, "approval_status": "declined"},
            {"email": B, "customer_id": "CUST0001", "first_name": "Zed", "last_name": None},
            {"email": None},
        ],
        web_portal=[{"email": A, "credit_score": 600}, {"email": A, "credit_score": 640}],
        cobranded_card=[{"email": A, "account_status": "closed"}],
    )


def test_customer_in_all_channels(mixed):
    row = by_email(profile_flat(mixed))[A]
    assert row["mobile_app_order_count"] == 2
    assert row["mobile_app_total_spend"] == Decimal("10.15")
    assert row["partner_total_principal"] == Decimal("600.00")  # declined loans count
    assert row["web_max_credit_score"] == 640
    assert row["card_total_balance"] == Decimal("1000.00")  # closed accounts count
    assert row["channels_used"] == [c.key for c in CHANNELS]
    assert row["channel_count"] == 4


def test_customer_in_one_channel_has_zeros_and_empty_arrays(mixed):
    row = by_email(profile_nested(mixed))[UPPER]
    assert row["channels_used"] == ["mobile_app"] and row["channel_count"] == 1
    assert row["web_max_credit_score"] == 0 and row["card_total_balance"] == 0
    assert row["partner_loan_events"] == [] and row["card_account_events"] == []


def test_case_differs_customer_differs(mixed):
    assert {A, UPPER} <= set(by_email(profile_flat(mixed)))


def test_identity_is_one_whole_row(mixed):
    row = by_email(identity_resolution(mixed))[B]
    assert (row["customer_id"], row["first_name"], row["last_name"]) == ("CUST0001", "Zed", None)


def test_union_is_distinct(mixed):
    rows = identity_union(mixed).collect()
    assert len(rows) == len(set(rows))


@pytest.mark.parametrize("build", [profile_flat, profile_flat_joined, profile_nested])
def test_null_email_is_one_empty_profile(mixed, build):
    row = by_email(build(mixed))[None]
    assert row["customer_id"] == "CUST0001"
    assert all(row[r.name] == 0 for r in ROLLUPS)
    assert row["channels_used"] == [] and row["channel_count"] == 0
    if "mobile_app_events" in row:
        assert row["mobile_app_events"] == []


def test_forms_agree(mixed):
    single, joined = profile_flat(mixed), profile_flat_joined(mixed)
    assert single.columns == joined.columns == list(FLAT_COLUMNS)
    assert [f.dataType for f in single.schema] == [f.dataType for f in joined.schema]
    rows = sorted(map(repr, single.collect()))
    assert rows == sorted(map(repr, joined.collect()))
    nested = profile_nested(mixed).select(*FLAT_COLUMNS)
    assert rows == sorted(map(repr, nested.collect()))


def test_types(mixed):
    nested = profile_nested(mixed)
    assert nested.columns == list(PROFILE_COLUMNS)
    types = {f.name: f.dataType for f in nested.schema}
    for r in ROLLUPS:
        assert types[r.name] == r.type
    assert types["mobile_app_total_spend"].simpleString() == "decimal(20,2)"
    assert types["card_total_balance"].simpleString() == "decimal(22,2)"
    for c in CHANNELS:
        got = [(f.name, f.dataType) for f in types[c.events].elementType]
        assert got == [(f.name, f.dataType) for f in c.event_type]


def test_events_are_ordered_and_times_are_text(mixed):
    events = by_email(profile_nested(mixed))[A]["mobile_app_events"]
    assert [e["order_id"] for e in events] == ["1", "2"]
    assert events[0]["order_ts"] == "2026-01-02 03:04:05"
    assert by_email(profile_nested(mixed))[A]["card_account_events"][0]["account_opened"] == (
        "2024-06-02"
    )


def test_updated_stamp(mixed):
    row = profile_nested(mixed, as_of="2026-05-01 10:00:00").first()
    assert row["profile_last_updated"] == dt.datetime(2026, 5, 1, 10)
    assert profile_nested(mixed).first()["profile_last_updated"] is not None


def test_missing_and_empty_channels(channels, table):
    assert profile_flat(channels()).count() == 0
    only = {"web_portal": table("web_portal", {"email": A})}
    for build in (profile_flat, profile_flat_joined, profile_nested, customer_activity):
        row = by_email(build(only))[A]
        assert row["channels_used"] == ["web_portal"] and row["card_account_count"] == 0
    assert by_email(profile_nested(only))[A]["mobile_app_events"] == []
    with pytest.raises(ValueError):
        profile_flat({"fax": only["web_portal"]})


def test_sums_near_the_declared_precision(channels):
    most = Decimal("99999999.99")
    rows = [{"email": A, "order_id": str(i), "order_amount": most} for i in range(1000)]
    built = channels(mobile_app=rows)
    for build in (profile_flat, profile_flat_joined, profile_nested):
        assert by_email(build(built))[A]["mobile_app_total_spend"] == most * 1000


def test_order_and_partitioning_do_not_matter(mixed):
    def shuffled(seed, parts):
        return {
            k: df.orderBy(F.rand(seed)).repartition(parts) for k, df in mixed.items()
        }

    for build in (profile_flat, lambda c: profile_nested(c, as_of="2026-01-01")):
        first = by_email(build(shuffled(1, 1)))
        assert by_email(build(shuffled(2, 7))) == first


def duplicated(df, times):
    return df.crossJoin(df.sparkSession.range(times)).drop("id")


@pytest.fixture
def hot(channels, table, spark):
    """One customer with most rows, a third of them copies of one event."""
    rows = [{"email": A, "order_id": f"{i:05d}"} for i in range(60)]
    built = channels(
        mobile_app=rows + [{"email": B, "order_id": "7"}, {"email": None}],
        web_portal=[{"email": A}, {"email": B, "customer_id": "CUST0002"}],
    )
    copies = duplicated(table("mobile_app", {"email": A, "order_id": "copy"}), 30)
    return built | {"mobile_app": built["mobile_app"].unionByName(copies)}


@pytest.mark.parametrize("size", [1, 7, 40, 1000])
def test_pages_hold_every_event_in_order(spark, hot, size):
    pages = event_pages(hot["mobile_app"].repartition(3), MOBILE, size).collect()
    assert max(len(p["events"]) for p in pages) <= size
    for email, n in ((A, 90), (B, 1)):
        own = sorted((p for p in pages if p["email"] == email), key=lambda p: p["event_page"])
        ids = [e["order_id"] for p in own for e in p["events"]]
        assert len(ids) == n and ids == sorted(ids)
        assert len({p["event_page"] for p in own}) == len(own)
    assert {p["email"] for p in pages} == {A, B}


def test_a_hot_history_is_spread_over_tasks(spark, table):
    copies = duplicated(table("mobile_app", {"email": A, "order_id": "copy"}), 4000)
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pages = event_pages(copies.repartition(4), MOBILE, 10)
        sizes = pages.groupBy(F.spark_partition_id()).agg(F.sum(F.size("events"))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 2)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(n for _, n in sizes) == 4000 and max(n for _, n in sizes) <= 2400


def test_histories_equal_rows(hot):
    for keys in (["mobile_app"], ["mobile_app", "web_portal"]):
        histories = event_histories({k: hot[k] for k in keys})
        for key in keys:
            a = exploded_events(histories, BY_KEY[key])
            b = event_rows(hot[key], BY_KEY[key])
            assert a.columns == b.columns
            assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert b.count() == 2
