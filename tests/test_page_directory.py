"""One page of a stored history: right rows, one file, the same pages however often tasks run."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.operators.events import event_pages
from tessera.operators.page_directory import EventPages
from tessera.schemas import MOBILE

HOT, COLD = "hot@x.org", "cold@x.org"


@pytest.fixture
def history(table):
    """A hot customer with many events and a copied one, a cold one, and rows of nobody."""
    rows = [{"email": HOT, "order_id": f"{i:05d}"} for i in range(400)]
    few = [{"email": COLD, "order_id": "b"}, {"email": COLD, "order_id": "a"}, {"email": None}]
    copies = table("mobile_app", {"email": HOT, "order_id": "00100"}).withColumn(
        "n", F.explode(F.sequence(F.lit(1), F.lit(90)))
    ).drop("n")
    return table("mobile_app", *rows, *few).unionByName(copies)


def read_all(pages, email):
    known = {r["email"]: r for r in pages.page_counts().collect()}[email]
    return known, [pages.page(email, n).collect() for n in range(known["pages"])]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pages_together_are_the_history(spark, history, tmp_path, size):
    if size == 1:
        history = history.filter("order_id < '00005' or email = 'cold@x.org'")
    pages = EventPages(spark, str(tmp_path), MOBILE, buckets=3)
    pages.write(history, size, partitions=5)
    for email in (HOT, COLD):
        known, found = read_all(pages, email)
        ids = [r["order_id"] for page in found for r in page]
        wanted = sorted(r["order_id"] for r in history.filter(F.col("email") == email).collect())
        assert ids == wanted and known["events"] == len(wanted)
        assert all(1 <= len(page) <= size for page in found)
    assert found[0][0].asDict().keys() == {f.name for f in MOBILE.event_type}


def test_a_page_of_a_hot_customer_opens_one_file(spark, history, tmp_path):
    pages = EventPages(spark, str(tmp_path), MOBILE, buckets=3)
    pages.write(history, 10, partitions=6)
    parts = pages.directory().filter(F.col("email") == HOT).count()
    assert parts >= 4  # the history is spread over files
    folders = list((tmp_path / "events").glob("part=*"))
    assert len(folders) >= parts
    assert all(len(list(f.glob("*.parquet"))) == 1 for f in folders)
    found = set()
    for n in (0, 17, 30):
        page = pages.page(HOT, n)
        text = page._jdf.queryExecution().executedPlan().toString()
        part = re.search(r"PartitionFilters: \[isnotnull\(part#\d+\), \(part#\d+ = (\d+)\)", text)
        assert "EqualTo(email,hot@x.org)" in text and page.count() == 10
        found.add(part[1])
    assert len(found) > 1


def test_missing_pages_and_customers_are_empty(spark, history, tmp_path):
    pages = EventPages(spark, str(tmp_path), MOBILE, buckets=3)
    pages.write(history, 10)
    for email, n in ((COLD, 1), (COLD, -1), ("nobody@x.org", 0), ("COLD@x.org", 0)):
        empty = pages.page(email, n)
        assert empty.count() == 0 and empty.columns == [f.name for f in MOBILE.event_type]
    with pytest.raises(ValueError, match="page_events"):
        pages.write(history, 0)
    pages.write(history.filter("false"), 10)  # replaces everything
    assert pages.directory().count() == 0 and pages.page(HOT, 0).count() == 0


def test_pages_do_not_depend_on_the_order_of_rows(spark, history):
    def of(df):
        return sorted(map(repr, event_pages(df, MOBILE, 8).collect()))

    first = of(history.repartition(3))
    assert of(history.repartition(3).sortWithinPartitions(F.col("order_id").desc())) == first
    assert "monotonically" not in event_pages(
        history, MOBILE, 8)._jdf.queryExecution().toString()
