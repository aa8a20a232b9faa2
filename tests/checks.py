"""Comparison of a query with its SQL in DuckDB, and the nodes of executed plans."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from decimal import Decimal

import duckdb


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (Decimal, int, str, bool)) or value is None:
        return f"{type(value).__name__}:{value}"
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty text if both give the same columns and rows, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} vs {sorted(relation.columns)}"
    ours = _rows(df.columns, df.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} vs {b}"
    return ""


def plan_nodes(spark):
    """The names of the nodes of all plans executed from now on: call the result to get them.

    New plans are known by their ids: the store drops old plans, so its length may stand still.
    """
    store = spark._jsparkSession.sharedState().statusStore()

    def ids():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.executionsList()
        return {found.apply(k).executionId() for k in range(found.size())}

    last = max(ids(), default=-1)

    def nodes():
        found = []
        for k in sorted(k for k in ids() if k > last):
            graph = store.planGraph(k).allNodes()
            found += [graph.apply(i).name().strip() for i in range(graph.size())]
        return found

    return nodes


def text_scans(nodes):
    """How many of the nodes read text files."""
    return sum(name.startswith("Scan text") for name in nodes)
