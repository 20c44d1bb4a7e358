import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from corpusloom.plans import catalog
from tools.check_queries import TABLES, check

# Compared in every test run; tools/check_queries.py covers all of them.
SLOW = {"process_fuzzy", "near_dup_drop", "crawl_frontier"}


@pytest.fixture(scope="module")
def con(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SLOW))
def test_query_equals_sql(spark, con, folder, name):
    good, note = check(spark, con, folder, name)
    assert good, note


def test_flagship_counts(spark):
    row = entry.entry(spark).selectExpr("sum(chunks)", "sum(estimated_tokens)").first()
    assert tuple(row) == (207, 63034)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_local_checkpoint_and_no_cross_join():
    root = os.path.join(os.path.dirname(entry.__file__), "corpusloom")
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                assert not re.search(r"localCheckpoint|crossJoin|\.toPandas\(", text), name
