"""Loads that keep rows which break the declared schema apart, and count rules on the way."""

from decimal import Decimal

import pytest

from tessera.operators import quality
from tessera.schemas import BY_KEY, CHANNELS, MOBILE
from tessera.sources.quarantine import judged, quarantine, reject_summary


@pytest.fixture
def texts(table):
    """A channel table whose columns are all text, as a file would give it."""

    def make(key, *rows):
        df = table(key, *rows)
        return df.selectExpr(*(f"cast({c} as string) as {c}" for c in df.columns))

    return make


def broken(texts):
    good = texts("mobile_app", {}, {"installments": 6}, {"status": "lost"})
    return (
        good.unionByName(texts("mobile_app", {"email": None}, {"email": None, "order_ts": None}))
        .unionByName(texts("mobile_app", {}).replace("4", "four", "installments"))
        .unionByName(texts("mobile_app", {}).replace("100.00", "123456789012.00", "order_amount"))
        .selectExpr("*", "'own' as given", "'own' as is_rejected", "1 as reject_reasons")
    )


def test_good_and_rejected_are_the_input(spark, texts, tmp_path):
    rows = broken(texts)
    load = quarantine(rows, MOBILE, str(tmp_path))
    assert (load.good_rows, load.rejected_rows) == (3, 4) and load.violations == {}
    assert [(f.name, f.dataType) for f in load.good.schema] == [
        (f.name, f.dataType) for f in MOBILE.schema]
    assert sorted(r["installments"] for r in load.good.collect()) == [4, 4, 6]
    reasons = sorted(r["reject_reasons"] for r in load.rejected.collect())
    assert reasons == [
        ["email: is null"], ["email: is null", "order_ts: is null"],
        ["installments: cannot be read as int"], ["order_amount: cannot be read as decimal(10,2)"],
    ]
    given = load.rejected.select("given.*")
    names = [f.name for f in MOBILE.schema]
    back = load.good.selectExpr(*(f"cast({n} as string) as {n}" for n in names))
    everything = back.unionByName(given)
    plain = rows.select(*names)
    assert everything.exceptAll(plain).isEmpty() and plain.exceptAll(everything).isEmpty()
    summary = {r["reason"]: r["rows"] for r in reject_summary(load.rejected).collect()}
    assert summary["email: is null"] == 2 and len(summary) == 4


@pytest.mark.parametrize("key", sorted(BY_KEY))
def test_observed_counts_are_those_of_the_reports(spark, table, tmp_path, key):
    channel = BY_KEY[key]
    rows = table(key, {}, {"status": "x", "kyc_status": "x", "account_status": "x"},
                 {"order_amount": Decimal(5), "principal_amount": Decimal(5), "credit_score": 1,
                  "utilization_pct": Decimal(200)},
                 {"email": None, "status": "x", "kyc_status": "x", "credit_score": 2})
    rules = {**quality.accepted_values_rules(channel), **quality.range_rules(channel)}
    load = quarantine(rows, channel, str(tmp_path), rules)
    assert (load.good_rows, load.rejected_rows) == (3, 1)
    found = quality.rule_report(load.good, channel, rules).collect()
    assert {r["rule"]: r["violations"] for r in found} == load.violations
    assert sum(load.violations.values()) > 0


def test_one_job_reads_the_rows_once(spark, texts, tmp_path):
    broken(texts).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    quarantine(rows.mapInArrow(counted, rows.schema), MOBILE, f"{tmp_path}/out",
               quality.accepted_values_rules(MOBILE))
    assert read.value == 7


def test_empty_tables_and_missing_columns(spark, texts, tmp_path):
    for channel in CHANNELS:
        empty = spark.createDataFrame([], channel.schema)
        load = quarantine(empty, channel, str(tmp_path), {"any": "true"})
        assert (load.good_rows, load.rejected_rows, load.violations) == (0, 0, {"any": 0})
        assert load.good.collect() == load.rejected.collect() == []
    nothing = quarantine(texts("mobile_app", {}).limit(0), MOBILE, str(tmp_path))
    assert (nothing.good_rows, nothing.rejected_rows) == (0, 0)
    with pytest.raises(ValueError, match="email"):
        judged(texts("mobile_app", {}).drop("email"), MOBILE)
