"""Every registered query against its SQL answer."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import oracles

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{name}'")
    return con


def test_every_query_has_an_oracle():
    assert set(oracles.oracle_sql()) == set(entry._queries())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query(spark, duck, name):
    df = entry._queries()[name](spark, SF)
    answer = duck.execute(oracles.oracle_sql()[name])
    expected_types = {c[0]: str(c[1]) for c in answer.description}
    types = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    assert types == expected_types
    order = sorted(types)
    position = [c[0] for c in answer.description]
    expected = [tuple(row[position.index(c)] for c in order) for row in answer.fetchall()]
    got = [tuple(row[c] for c in order) for row in df.collect()]
    assert got and sorted(got, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 50 and rows[0]["channel_count"] == 4
