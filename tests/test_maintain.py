"""A profile kept by key equals the full rebuild and leaves other buckets' files alone."""

import glob
import os
from decimal import Decimal

import pytest

from tessera.operators import serve
from tessera.plans.maintain import MaintainedProfile
from tessera.plans.profile import profile_nested
from tessera.sources.tables import TableNames

AS_OF = "2026-05-01 12:30:00"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


@pytest.fixture
def given(channels):
    people = [{"email": f"u{i}@x.org", "customer_id": f"CUST{i:04d}"} for i in range(40)]
    return channels(
        mobile_app=people + people[:9], partner_checkout=people[5:25],
        web_portal=[{"email": None}, *people[30:]], cobranded_card=people[::3],
    )


def after(kept, channel_key, changes, upserts, id_field):
    """The channel's rows after a batch, by hand."""
    ids = [r[id_field] for r in changes.collect()]
    old = kept[channel_key].filter(~kept[channel_key][id_field].isin(ids))
    return kept | {channel_key: old.unionByName(upserts)}


def test_batches_equal_the_rebuild(spark, table, given, tmp_path):
    profile = MaintainedProfile(spark, str(tmp_path), buckets=16)
    profile.build(given, AS_OF)
    assert rows(profile.profiles()) == rows(profile_nested(given, AS_OF))

    def mobile(*changed):
        return table("mobile_app", *changed)

    moved = mobile(  # new, changed, changed under another e-mail, and one without any
        {"order_id": "NEW-1", "email": "u3@x.org", "order_amount": Decimal("7.00")},
        {"order_id": "NEW-2", "email": "fresh@x.org"},
        {"order_id": "MOB-CUST0001-003", "email": "u2@x.org", "status": "late_payment"},
        {"order_id": "MOB-CUST0001-004", "email": "other@x.org"},
    )
    upserts = moved.selectExpr("*", "'upsert' as change", "case order_id when 'MOB-CUST0001-004' "
                               "then 'u3@x.org' end as previous_email")
    gone = given["partner_checkout"].filter("email in ('u7@x.org', 'u8@x.org')")
    deletes = gone.selectExpr("loan_id", "email", "'delete' as change")
    full_deletes = gone.selectExpr("*", "'delete' as change")
    assert deletes.count() == 2
    before = files(tmp_path)
    touched = profile.apply(
        {"mobile_app": upserts, "partner_checkout": full_deletes}, AS_OF
    )
    assert 0 < len(touched) < 16
    expected = after(dict(given), "mobile_app", upserts, moved, "order_id")
    expected["partner_checkout"] = given["partner_checkout"].exceptAll(gone)
    want = rows(profile_nested(expected, AS_OF))
    assert rows(profile.profiles()) == want
    names = {f"email_bucket={b}" for b in touched}
    untouched = {f: t for f, t in before.items() if os.path.basename(os.path.dirname(f))
                 not in names}
    now = files(tmp_path)
    assert untouched and all(now.get(f) == t for f, t in untouched.items())
    profile.apply({"mobile_app": upserts, "partner_checkout": full_deletes}, AS_OF)  # again
    assert rows(profile.profiles()) == want
    stats = rows(serve.portfolio_of(profile.partials()))
    assert stats == rows(serve.portfolio_stats(profile_nested(expected, AS_OF)))


def test_a_bucket_that_loses_its_last_row(spark, channels, tmp_path):
    given = channels(mobile_app=[{"email": "a@x.org"}, {"email": "b@x.org"}])
    profile = MaintainedProfile(spark, str(tmp_path), buckets=64)
    profile.build(given, AS_OF)
    gone = given["mobile_app"].filter("email = 'a@x.org'").selectExpr("*", "'delete' as change")
    assert len(profile.apply({"mobile_app": gone}, AS_OF)) == 1
    assert [r["email"] for r in profile.profiles().collect()] == ["b@x.org"]
    assert profile.apply({"mobile_app": gone.limit(0)}, AS_OF) == []
    only = serve.portfolio_of(profile.partials()).first()
    assert (only["total_customers"], only["total_mobile_orders"]) == (1, 1)


def test_partials_add_up_and_read_themselves_alone(spark, channels, given, tmp_path):
    profile = MaintainedProfile(spark, str(tmp_path), buckets=8)
    profile.build(given, AS_OF)
    stats = serve.portfolio_of(profile.partials())
    assert rows(stats) == rows(serve.portfolio_stats(profile_nested(given, AS_OF)))
    assert stats.inputFiles() and all("/statistics/" in f for f in stats.inputFiles())
    empty = channels()
    assert rows(serve.portfolio_of(serve.portfolio_partials(profile_nested(empty)))) == rows(
        serve.portfolio_stats(profile_nested(empty)))


def test_publish_replaces_in_one_step(spark, given, tmp_path):
    spark.sql("CREATE DATABASE maintained")
    names = TableNames(schema="maintained")
    profile = MaintainedProfile(spark, str(tmp_path), buckets=4)
    profile.build(given, AS_OF)
    profile.publish(names)
    published = spark.table(names.profile)
    assert rows(published.drop("email_lc")) == rows(profile_nested(given, AS_OF))
    spark.sql("DROP DATABASE maintained CASCADE")
