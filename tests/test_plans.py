"""The physical plans are the ones meant: scans, shuffles, joins, push-down."""

import os

import pytest

import __spark_entry__ as entry
from tessera.operators import serve
from tessera.operators.events import event_rows, event_view
from tessera.operators.identity import identity_resolution
from tessera.operators.rollups import customer_activity
from tessera.operators.sampling import customer_sample
from tessera.plans.profile import customers_top, profile_flat, profile_flat_joined, profile_nested
from tessera.schemas import CHANNELS, MOBILE
from tessera.sources.tables import channels_from_parquet


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("channels")
    for c in CHANNELS:
        spark.createDataFrame([], c.schema).write.parquet(f"{root}/{c.table}")
    return channels_from_parquet(spark, str(root))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counts(df):
    text = plan(df)
    return {
        "scans": text.count("FileScan parquet"),
        "shuffles": text.count("Exchange hashpartitioning"),
        "joins": text.count("Join "),
    }


def sorted_rows(text):
    """Of each sorting aggregation that reads no other: what it reads, down to the scans."""
    lines = text.splitlines()
    first = max(i for i, line in enumerate(lines) if "SortAggregate" in line)
    return "\n".join(lines[first:])


def test_flat_reads_once_and_hashes_channel_rows(stored):
    flat = profile_flat(stored)
    assert counts(flat) == {"scans": 4, "shuffles": 5, "joins": 0}
    assert counts(profile_flat_joined(stored))["scans"] == 8
    for df in (flat, identity_resolution(stored), serve.profile_display(flat)):
        # Two sorting steps around the last shuffle, both above rows hashed by identity.
        text = plan(df)
        assert text.count("SortAggregate") == 2
        assert "HashAggregate(keys=[customer_id" in sorted_rows(text)


def test_names_of_a_list_are_resolved_for_its_customers(stored):
    text = plan(customers_top(stored))
    assert text.count("TakeOrderedAndProject") == 2 and counts(customers_top(stored))["scans"] == 8
    assert text.count("SortAggregate") == 2
    assert "BroadcastHashJoin" in sorted_rows(text)  # sorted are rows of wanted customers
    ranked = text[text.rindex("TakeOrderedAndProject"):]
    assert "first_name" not in ranked and "SortAggregate" not in ranked


def test_nested_reads_once(stored):
    nested = profile_nested(stored)
    assert counts(nested) == {"scans": 4, "shuffles": 4, "joins": 0}


def test_activity_hashes_and_reads_little(stored):
    activity = customer_activity(stored)
    assert counts(activity) == {"scans": 4, "shuffles": 4, "joins": 0}
    text = plan(activity)
    assert "Sort" not in text and "first_name" not in text
    assert "ReadSchema: struct<email:string,order_amount:decimal(10,2)>" in text


def test_stats_prune_to_what_they_count(stored):
    text = plan(serve.load_report(customer_activity(stored)))
    assert text.count("ReadSchema: struct<email:string>") == 4


def test_lists_are_top_k(stored):
    flat = profile_flat(stored)
    assert "TakeOrderedAndProject" in plan(serve.customers_top(flat))
    assert "TakeOrderedAndProject" in plan(serve.customers_search(flat, "a"))


def test_event_rows_do_not_shuffle(stored):
    text = plan(event_view(event_rows(stored["mobile_app"], MOBILE), MOBILE))
    assert "Exchange" not in text and "PushedFilters: [IsNotNull(email)]" in text


def test_sample_merges_the_customers_once(stored):
    text = plan(customer_sample(identity_resolution(stored), 100))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert counts(customer_sample(identity_resolution(stored), 100))["scans"] == 4


def test_large_sample_is_a_top_k_per_channel(stored):
    text = plan(customer_sample(identity_resolution(stored), 5000))
    assert text.count("TakeOrderedAndProject") == 4


def test_lookup_scans_each_channel_once(stored):
    found = serve.profile_lookup(profile_flat(stored), "A@x.org")
    assert counts(found) == {"scans": 4, "shuffles": 5, "joins": 0}


def shuffled(node):
    """The columns of every shuffle below a node of a physical plan."""
    children = [node.children().apply(i) for i in range(node.children().size())]
    found = [columns for child in children for columns in shuffled(child)]
    if node.nodeName() == "Exchange":
        output = node.output()
        found.append({output.apply(i).name() for i in range(output.size())})
    return found


@pytest.mark.parametrize("name", ["null_report", "reject_reasons"])
def test_joins_shuffle_given_columns_and_line_items_once(spark, name):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = entry.queries()[name](spark, SF)
        found = shuffled(df._jdf.queryExecution().executedPlan())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    derived = {"customer_id", "email", "first_name", "last_name", "order_id", "loan_id",
               "application_id", "app_version", "bnpl_plan", "utm_source", "loan_purpose"}
    assert not [columns & derived for columns in found if columns & derived]
    # By order, and by supplier where suppliers are too many to broadcast; never by customer.
    assert len([columns for columns in found if "l_linenumber" in columns]) == 2


@pytest.mark.parametrize("name", sorted(entry._queries()))
def test_building_a_query_starts_no_job(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    spark.sparkContext.setJobGroup(f"build-{name}", "building")
    entry._queries()[name](spark, SF)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")


def test_no_python_in_any_plan(stored):
    nested = profile_nested(stored)
    for df in (profile_flat(stored), nested, serve.profile_json(nested)):
        assert "Python" not in plan(df) and "Cartesian" not in plan(df)
        assert "NestedLoop" not in plan(df)
