"""Names, typed loading, replacing, comments, the batch job, JSON lines."""

import json

import pytest

from tessera.operators import serve
from tessera.plans.jobs import PROFILE_COMMENT, consolidate
from tessera.plans.profile import profile_nested
from tessera.schemas import CHANNELS, MOBILE
from tessera.sources.sinks import (
    adopt_table,
    comment_on_table,
    load_channel,
    overwrite_table,
    replace_table_as,
    write_json_lines,
)
from tessera.sources.tables import (
    TableNames,
    channels_from_catalog,
    channels_from_parquet,
    conform,
)


@pytest.fixture
def names(spark, request):
    schema = request.node.name
    spark.sql(f"CREATE DATABASE {schema}")
    yield TableNames(schema=schema)
    spark.sql(f"DROP DATABASE {schema} CASCADE")


def test_names(monkeypatch):
    assert TableNames("c", "s").qualified("t") == "`c`.`s`.`t`"
    assert TableNames().profile == "`default`.`customer_profile`"
    monkeypatch.setenv("TESSERA_SCHEMA", "sales")
    monkeypatch.setenv("TESSERA_PROFILE_TABLE", "p`q")
    assert TableNames.from_env().profile == "`sales`.`p``q`"


def test_conform(table):
    loose = table("mobile_app", {}).selectExpr("*", "1 as extra")
    loose = loose.withColumn("installments", loose.installments.cast("bigint"))
    typed = conform(loose, MOBILE)
    assert [(f.name, f.dataType) for f in typed.schema] == [
        (f.name, f.dataType) for f in MOBILE.schema
    ]
    with pytest.raises(ValueError, match="order_ts"):
        conform(loose.drop("order_ts"), MOBILE)


def test_loading_refuses_nulls(table, names):
    with pytest.raises(Exception, match="null in required column mobile_app_purchases.email"):
        load_channel(table("mobile_app", {}, {"email": None}), MOBILE, names)


def test_overwrite_changes_the_schema(spark, names):
    t = names.qualified("t")
    overwrite_table(spark.sql("select 1 as a"), t, "it's \\ one")
    overwrite_table(spark.sql("select 'x' as b, 2 as c"), t)
    assert spark.table(t).columns == ["b", "c"]
    comment_on_table(spark, t, "it's \\ two")
    detail = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t}").collect()}
    assert detail["Comment"] == "it's \\ two"


def versions(spark, names):
    shown = spark.sql(f"SHOW TABLES IN {names.schema}").collect()
    return {r["tableName"] for r in shown if "_v" in r["tableName"]}


def test_replace_is_one_step(spark, names):
    t = names.qualified("t")
    replace_table_as(spark.sql("select 1 as a"), names, "t", "a table's note")
    before = spark.table(t)
    assert [r.a for r in before.collect()] == [1]
    replace_table_as(spark.sql("select 2 as a, 3 as b"), names, "t")
    assert [tuple(r) for r in spark.table(t).collect()] == [(2, 3)]
    assert [r.a for r in before.collect()] == [1]  # a query under way is not disturbed
    assert len(versions(spark, names)) == 2
    with pytest.raises(Exception, match="boom"):
        replace_table_as(spark.sql("select raise_error('boom') as a"), names, "t")
    assert [tuple(r) for r in spark.table(t).collect()] == [(2, 3)]
    replace_table_as(spark.sql("select 4 as a"), names, "t")
    assert [r.a for r in spark.table(t).collect()] == [4]
    assert len(versions(spark, names)) == 2


def test_replace_drops_nothing_it_did_not_publish(spark, names):
    alike = ("u_validated_tmp", "u_v0123456789ab", "u_vabcdefabcdef")
    for table in alike:  # a user's tables, and another replacement's unpublished version
        spark.sql(f"CREATE TABLE {names.qualified(table)} AS SELECT 1 AS mine")
    for i in range(4):
        replace_table_as(spark.sql(f"select {i} as a"), names, "u")
    assert [r.a for r in spark.table(names.qualified("u")).collect()] == [3]
    assert all(spark.catalog.tableExists(names.qualified(t)) for t in alike)
    assert len([v for v in versions(spark, names) if v.startswith("u_v")]) == len(alike) + 2


def test_replace_refuses_a_table_of_its_own_before_writing(spark, names):
    spark.sql(f"CREATE TABLE {names.qualified('plain')} AS SELECT 1 AS a")
    before = versions(spark, names)
    with pytest.raises(ValueError, match="a table of its own"):
        replace_table_as(spark.sql("select 2 as a"), names, "plain")
    assert versions(spark, names) == before
    assert [r.a for r in spark.table(names.qualified("plain")).collect()] == [1]


@pytest.mark.parametrize("buckets", [None, 3])
def test_consolidate(spark, channels, buckets):
    names = TableNames(schema=f"job_{buckets or 0}")
    spark.sql(f"CREATE DATABASE {names.schema}")
    built = channels(
        mobile_app=[{}, {"email": "Other@x.org"}], web_portal=[{}], cobranded_card=[{}]
    )
    for c in CHANNELS:
        loaded = load_channel(built[c.key], c, names)
        assert loaded == built[c.key].count()
    for _ in range(2):
        assert tuple(consolidate(spark, names, buckets=buckets)) == (2, 1)
    stored = spark.table(names.profile)
    fresh = profile_nested(channels_from_catalog(spark, names))
    same = [c for c in fresh.columns if c != "profile_last_updated"]
    assert stored.select(*same).exceptAll(fresh.select(*same)).count() == 0
    found = serve.profile_lookup(stored, "OTHER@X.org")
    assert found.first()["email"] == "Other@x.org"
    plan = found._jdf.queryExecution().toString()
    assert "EqualTo(email_lc,other@x.org)" in plan  # the filter reaches the scan
    if buckets:
        # Shown only while the scan counts as bucketed, but pruned either way.
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        again = serve.profile_lookup(spark.table(names.profile), "OTHER@X.org")
        plan = again._jdf.queryExecution().toString()
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        assert "SelectedBucketsCount: 1 out of 3" in plan
    detail = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {names.profile}").collect()}
    assert detail["Comment"] == PROFILE_COMMENT
    spark.sql(f"DROP DATABASE {names.schema} CASCADE")


def test_parquet_and_json_lines(spark, channels, tmp_path):
    built = channels(mobile_app=[{}, {"email": "b@x.org"}])
    for c in CHANNELS:
        built[c.key].write.parquet(f"{tmp_path}/in/{c.table}")
    read = channels_from_parquet(spark, f"{tmp_path}/in")
    nested = profile_nested(read)
    write_json_lines(serve.profile_json(nested), f"{tmp_path}/out")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert {line["email"] for line in lines} == {"ada.byron001@x.org", "b@x.org"}


def test_a_plain_table_is_adopted_and_then_replaced(spark, names):
    t = names.qualified("t")
    with pytest.raises(ValueError, match="no table"):
        adopt_table(spark, names, "t")
    overwrite_table(spark.sql("select 1 as a"), t)
    with pytest.raises(ValueError, match="table of its own"):
        replace_table_as(spark.sql("select 2 as a"), names, "t")
    adopt_table(spark, names, "t", "taken over")
    assert [r["a"] for r in spark.table(t).collect()] == [1]
    with pytest.raises(ValueError, match="view already"):
        adopt_table(spark, names, "t")
    for value in (2, 3):
        replace_table_as(spark.sql(f"select {value} as a"), names, "t")
        assert [r["a"] for r in spark.table(t).collect()] == [value]
    left = [r["tableName"] for r in spark.sql(f"show tables in {names.schema}").collect()]
    assert len(left) == 3  # the view, its version and the one before; the adopted one is gone


def test_a_failed_adoption_gives_the_name_back(spark, names, monkeypatch):
    from tessera.sources import sinks

    def fail(*_):
        raise RuntimeError("no view")

    t = names.qualified("t")
    overwrite_table(spark.sql("select 1 as a"), t)
    monkeypatch.setattr(sinks, "_point", fail)
    with pytest.raises(RuntimeError):
        adopt_table(spark, names, "t")
    assert [r["a"] for r in spark.table(t).collect()] == [1]
