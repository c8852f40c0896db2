"""Every registered query against DuckDB over the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from claimweave.plans.catalog import CATALOG

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_is_registered_with_sql():
    assert CATALOG.keys() <= entry_points.queries().keys()
    assert CATALOG.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", CATALOG)
def test_matches_sql(spark, duck, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    assert result.columns == [column[0] for column in cursor.description]
    assert ordered(result.collect()) == ordered(cursor.fetchall())

    # no nested loops, no cross products, no Python in the plan that ran
    plan = result._jdf.queryExecution().executedPlan().toString()
    for word in ("NestedLoop", "Cartesian", "Python", "InPandas"):
        assert word not in plan, word


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
