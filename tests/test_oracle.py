"""Every registered query against its SQL, values and types, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gantrylake.plans.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
ORDERED = ["hourly_ordered", "flow_q1", "flow_q2", "flow_q3", "flow_q4"]
#: Queries of the subpackage for training text have tests of their own.
NAMES = sorted(set(oracle_sql()))
BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    table = queries()[name](spark, SF_DIR)
    plan = table._jdf.queryExecution().toString()
    assert not [banned for banned in BANNED if banned in plan]
    columns = sorted(table.columns)
    got = [tuple(row[c] for c in columns) for row in table.collect()]
    cursor = duck.execute(oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert {c: KINDS[t] for c, t in table.dtypes} == kinds
    want = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert got, "a query without rows checks nothing"
    if name in ORDERED:
        assert got == want
    assert in_order(got) == in_order(want)


def test_every_query_of_the_reference_has_sql():
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


def final_plan(table):
    table.collect()
    return table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("name", ["endpoint_filter_table", "holiday_flag"])
def test_small_lists_are_broadcast(spark, name):
    plan = final_plan(queries()[name](spark, SF_DIR))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(GantryID" in line]


def test_a_long_list_is_salted(spark, monkeypatch):
    from gantrylake.operators import clean

    want = sorted(queries()["endpoint_filter_table"](spark, SF_DIR).collect())
    monkeypatch.setattr(clean, "LIST_ROWS", 1)
    assert sorted(queries()["endpoint_filter_table"](spark, SF_DIR).collect()) == want


@pytest.mark.parametrize(("name", "column"), [("week_layer", "week_index"), ("day_layer", "day")])
def test_layers_are_read_by_their_folder(spark, name, column):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({column}" in plan


def test_entry_counts_trips(spark):
    assert entry(spark).agg({"counts": "sum"}).first()[0] == 737
