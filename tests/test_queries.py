"""Every registered query against its SQL, and what its plan must not contain."""

import pytest

import __spark_entry__
from feedmill.plans import catalog
from checks import differences, open_tables

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, catalog.SQL


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    for unwanted in ("Cartesian", "NestedLoop", "EvalPython", "InPandas", "InArrow"):
        assert unwanted not in plan, plan
    assert differences(df, tables, SQL[name]) == ""


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"c_mktsegment", "total", "n"}
