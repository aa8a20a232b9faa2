"""Row filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedmill.functions.names import get_column

# Accepted spellings of each comparison.
COMPARISONS = {
    gt: (">", "gt", "greater", "greater_than"),
    lt: ("<", "lt", "less", "less_than"),
    ge: (">=", "ge", "greater_equal"),
    le: ("<=", "le", "less_equal"),
    ne: ("!=", "<>", "ne", "not_equal", "not_equals"),
    eq: ("==", "=", "eq", "equal", "equals"),
}
IN = ("in", "in_list")
NOT_IN = ("not_in", "not_in_list", "nin")
_COMPARE = {word: op for op, words in COMPARISONS.items() for word in words}
# Numbers of up to 20 places before the point and 18 behind it are compared exactly.
_EXACT = T.DecimalType(38, 18)


def _compared(df: DataFrame, name: str, values: list[Any], test: Callable[[Column, list[Column]], Column]) -> Column:
    """``test`` of the column and the values. Text compared with numbers is read as a number:
    exactly, or as floating point where it has too many digits for that. Text that is no
    number then compares as NULL and the row is dropped.
    """
    name = get_column(df.columns, name)
    column = df[name]
    numbers = all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values)
    if not (values and numbers and isinstance(df.schema[name].dataType, T.StringType)):
        return test(column, [F.lit(v) for v in values])
    rough = test(column.try_cast("double"), [F.lit(float(v)) for v in values])
    if any(not abs(v) < 10**20 for v in values):
        return rough
    exact = test(column.try_cast(_EXACT), [F.lit(repr(v)).cast(_EXACT) for v in values])
    return F.coalesce(exact, rough)


def condition(df: DataFrame, spec: Mapping[str, Any]) -> Column:
    """One declared condition ``{field, operation, value}`` as a predicate."""
    op = str(spec.get("operation") or spec.get("op") or "==").strip().lower()
    value = spec.get("value")
    values = list(value) if isinstance(value, (list, tuple)) else [value]
    field = spec.get("field") or ""
    if op in IN:
        return _compared(df, field, values, lambda column, items: column.isin(items))
    if op in NOT_IN:
        return ~_compared(df, field, values, lambda column, items: column.isin(items))
    if op in _COMPARE:
        return _compared(df, field, [value], lambda column, items: _COMPARE[op](column, items[0]))
    column = df[get_column(df.columns, field)]
    if op == "contains":
        return column.cast("string").contains(str(value))
    if op == "is_null":
        return column.isNull()
    if op == "is_not_null":
        return column.isNotNull()
    raise ValueError(f"unknown filter operation '{op}'")


def filter_rows(df: DataFrame, conditions: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Rows that meet every condition; no conditions keep every row."""
    tests = [condition(df, c) for c in conditions]
    return df.filter(reduce(and_, tests)) if tests else df


def split_rows(df: DataFrame, field: str, values: list[Any]) -> tuple[DataFrame, DataFrame]:
    """Two-way branch: rows whose value is in the list, and rows whose value is not.

    Rows without a value belong to neither branch.
    """
    listed = condition(df, {"field": field, "operation": "in", "value": values})
    return df.filter(listed), df.filter(~listed)
