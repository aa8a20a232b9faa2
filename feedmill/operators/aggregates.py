"""Grouped and global aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from feedmill.functions.names import column_name, get_column, sql_text

# Accepted spellings of each aggregate.
FUNCTIONS = {
    "sum": "sum",
    "add": "sum",
    "count": "count",
    "tallying": "count",
    "avg": "avg",
    "min": "min",
    "max": "max",
}


def aggregate_column(df: DataFrame, spec: Mapping[str, Any]) -> Column:
    """One declared aggregate ``{field, operation, condition, alias}``.

    A condition is any predicate. Rows that miss it add 0 to sums and counts and
    are ignored by avg, min and max.
    """
    op = str(spec.get("operation") or spec.get("op") or spec.get("function") or "sum").lower()
    function = FUNCTIONS.get(op)
    if function is None:
        raise ValueError(f"unknown aggregate '{op}'")
    field = spec.get("field") or "*"
    if field == "*" and function != "count":
        raise ValueError(f"{function} needs a field")
    alias = spec.get("alias") or f"{op}_{column_name(field)}"
    value = F.lit(1) if field == "*" else df[get_column(df.columns, field)]
    text = spec.get("condition")
    if not text:
        return getattr(F, function)(value).alias(alias)
    met = F.expr(sql_text(text, df.columns))
    if function == "count":
        return F.sum(F.when(met, 1).otherwise(0)).alias(alias)
    if function == "sum":
        return F.sum(F.when(met, value).otherwise(0)).alias(alias)
    return getattr(F, function)(F.when(met, value)).alias(alias)


def aggregate(
    df: DataFrame, group_by: Iterable[str], aggregations: Iterable[Mapping[str, Any]]
) -> DataFrame:
    """Aggregate by columns, or over everything; no aggregations change nothing.

    All functions combine inside each task first, so a hot group reaches the
    shuffle as one row per task.
    """
    columns = [aggregate_column(df, a) for a in aggregations]
    if not columns:
        return df
    keys = [df[get_column(df.columns, g)] for g in group_by]
    return df.groupBy(*keys).agg(*columns) if keys else df.agg(*columns)
