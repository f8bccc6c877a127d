"""Bucketed channel tables: same rows, no shuffle, and another way for oversized buckets."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import serve
from tessera.operators.rollups import customer_activity
from tessera.plans.profile import profile_flat, profile_nested
from tessera.schemas import CHANNELS
from tessera.sources.buckets import bucket_bytes, channels_from_buckets, load_bucketed
from tessera.sources.tables import TableNames

NAMES = TableNames(schema="bucketed_channels")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed_channels")
    yield
    spark.sql("DROP DATABASE bucketed_channels CASCADE")


@pytest.fixture
def loaded(spark, schema, channels):
    """Four channels with a frequent e-mail, one without an e-mail, and an empty channel."""
    many = [{"email": f"c{i % 17}@x.org", "customer_id": f"CUST{i % 17:04d}"} for i in range(60)]
    hot = [{"email": "hot@x.org", "customer_id": "CUST9999"}] * 40
    given = channels(
        mobile_app=many + hot, partner_checkout=many[:20] + [{"email": None}],
        web_portal=hot[:9] + many[30:],
    )
    for c in CHANNELS:
        load_bucketed(given[c.key], c, NAMES, buckets=4, splits=2, enforce_required=False)
    return given


def test_bucketed_tables_need_no_exchange(spark, loaded):
    stored = channels_from_buckets(spark, NAMES)
    for build in (
        profile_flat, customer_activity, lambda c: profile_nested(c, as_of="2026-01-01 00:00:00"),
    ):
        assert "Exchange" not in plan(build(stored))
        assert rows(build(stored)) == rows(build(loaded))


def test_statistics_exchange_their_partial_results_only(spark, loaded):
    text = plan(serve.portfolio_stats(customer_activity(channels_from_buckets(spark, NAMES))))
    assert text.count("Exchange") == 1 and "Exchange SinglePartition" in text


def test_an_oversized_bucket_is_read_in_splits(spark, loaded):
    sizes = bucket_bytes(spark, NAMES.qualified("mobile_app_purchases"))
    assert set(sizes) <= set(range(4)) and min(sizes.values()) > 0
    split = channels_from_buckets(spark, NAMES, largest_bytes=max(sizes.values()) - 1)
    assert "Exchange hashpartitioning" in plan(profile_flat(split))
    assert "Bucketed: true" not in plan(split["mobile_app"])
    assert rows(profile_flat(split)) == rows(profile_flat(loaded))


def test_a_frequent_email_is_written_by_several_tasks(spark, loaded):
    table = spark.table(NAMES.qualified("mobile_app_purchases")).filter("email = 'hot@x.org'")
    assert table.select(F.col("_metadata.file_name")).distinct().count() == 2


def test_loading_again_replaces_and_required_columns_are_required(spark, loaded, table):
    mobile = CHANNELS[0]
    load_bucketed(table("mobile_app", {}), mobile, NAMES, buckets=4)
    assert spark.table(NAMES.qualified(mobile.table)).count() == 1
    with pytest.raises(Exception, match="null in required column"):
        load_bucketed(table("mobile_app", {"email": None}), mobile, NAMES, buckets=4)
    with pytest.raises(ValueError, match="buckets"):
        load_bucketed(table("mobile_app", {}), mobile, NAMES, buckets=0)
