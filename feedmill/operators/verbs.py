"""Record verbs: ordered column expressions over one frame."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from feedmill.functions.names import column_name, find_column, get_column, sql_text

# Words of a STRING expression that are not columns.
STRING_NOISE = {"BY", "DELIMITED", "SIZE"}

_INTEGER = re.compile(r"[+-]?\d+")
_DECIMAL = re.compile(r"[+-]?\d*\.\d+")


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered projection under column names; ``["*"]`` keeps the frame."""
    if columns == ["*"]:
        return df
    return df.select(
        *[df[get_column(df.columns, c)].alias(column_name(c)) for c in columns]
    )


def _constant(token: str) -> Column | None:
    """A number or quoted text as a literal, else nothing."""
    if _INTEGER.fullmatch(token):
        return F.lit(int(token))
    if _DECIMAL.fullmatch(token):
        return F.lit(Decimal(token))
    if len(token) >= 2 and token[0] == token[-1] and token[0] in "'\"":
        return F.lit(token[1:-1])
    return None


def _value(df: DataFrame, token: str) -> Column:
    """A constant or an existing column; anything else is an error."""
    constant = _constant(token)
    return df[get_column(df.columns, token)] if constant is None else constant


def _source(df: DataFrame, expression: str) -> Column:
    return df[get_column(df.columns, expression.split()[0] if expression.split() else "")]


def _operands(expression: str, sign: str, target: str) -> list[str]:
    """Tokens of an arithmetic expression other than its sign and the target.

    A minus counts as a sign only between blanks: elsewhere it belongs to a
    record name or to a number.
    """
    if sign != "-":
        expression = expression.replace(sign, " ")
    return [t for t in expression.split() if t != "-" and column_name(t) != target]


def _running(df: DataFrame, target: str, start: int) -> Column:
    """The target so far; a target not seen before starts from ``start``."""
    found = find_column(df.columns, target)
    return F.lit(start) if found is None else df[found]


def _move(df: DataFrame, spec: Mapping[str, Any], expression: str) -> Column:
    if spec.get("literal") is True:
        return F.lit(spec.get("value", expression))
    text = expression.strip()
    if not text:
        return F.lit(None).cast("string")
    constant = _constant(text)
    if constant is not None:
        # Point literals of MOVE are floating point.
        return F.lit(float(text)) if _DECIMAL.fullmatch(text) else constant
    found = find_column(df.columns, text)
    return F.lit(text) if found is None else df[found]


# Per verb: its sign, the value of a target not seen before, and the step.
_ARITHMETIC = {
    "add": ("+", 0, lambda total, value: total + value),
    "subtract": ("-", 0, lambda total, value: total - value),
    "multiply": ("*", 1, lambda total, value: total * value),
    "divide": ("/", 0, F.try_divide),
}


def _arithmetic(df: DataFrame, op: str, spec: Mapping[str, Any], expression: str,
                target: str) -> Column:
    sign, start, step = _ARITHMETIC[op]
    tokens = _operands(expression, sign, target)
    if "first" in spec:
        total = _value(df, spec["first"])
    else:
        total = _running(df, target, start)
        if not tokens:
            raise ValueError(f"{op} needs a column or a constant: '{expression}'")
    for token in tokens:
        total = step(total, _value(df, token))
    return total


def _string(df: DataFrame, spec: Mapping[str, Any], expression: str) -> Column:
    tokens = [
        t for t in re.findall(r"'[^']*'|\"[^\"]*\"|\S+", expression)
        if t.upper() not in STRING_NOISE
    ]
    if not tokens:
        raise ValueError("STRING needs at least one column")
    return F.concat_ws(spec.get("delimiter", ""), *[_value(df, t) for t in tokens])


def _unstring(df: DataFrame, spec: Mapping[str, Any], expression: str) -> Column:
    if "length" in spec:
        start = int(spec.get("start", 0)) + 1
        return F.substring(_source(df, expression).cast("string"), start, int(spec["length"]))
    delimiter, index = spec.get("delimiter", ","), int(spec.get("index", 0))
    return F.split_part(_source(df, expression), F.lit(delimiter), F.lit(index + 1))


def verb_column(df: DataFrame, spec: Mapping[str, Any], target: str) -> Column:
    """The column one verb assigns to ``target``."""
    op = str(spec.get("operation") or spec.get("op") or "move").lower()
    expression = str(spec.get("expression") or "")
    if op == "move":
        return _move(df, spec, expression)
    if op in _ARITHMETIC:
        return _arithmetic(df, op, spec, expression, target)
    if op == "initialize":
        return F.lit(spec.get("value", 0))
    if op == "string":
        return _string(df, spec, expression)
    if op == "unstring":
        return _unstring(df, spec, expression)
    if op == "inspect":
        return F.regexp_replace(
            _source(df, expression), F.lit(spec.get("before", "")), F.lit(spec.get("after", ""))
        )
    return F.expr(sql_text(expression, df.columns))


def _documented(spec: Mapping[str, Any]) -> dict[str, Any]:
    """Accept ``output_field`` / ``operands`` as another spelling of a verb."""
    spec = dict(spec)
    spec["target"] = column_name(spec.get("target") or spec.get("output_field") or "")
    if not spec["target"]:
        raise ValueError(f"expression without a target: {spec}")
    operands = spec.pop("operands", None)
    if operands is None:
        return spec
    op, operands = str(spec.get("operation", "move")).lower(), [str(o) for o in operands]
    if op in _ARITHMETIC:
        # A full expression of its own: the first operand is the start value.
        spec.update(first=operands[0], expression=" ".join(operands[1:]))
    elif op == "unstring" and len(operands) == 3:
        spec.update(expression=operands[0], start=int(operands[1]), length=int(operands[2]))
    elif op == "inspect" and len(operands) == 3:
        spec.update(expression=operands[0], before=operands[1], after=operands[2])
    else:
        spec["expression"] = " ".join(operands)
    return spec


def _mentions(spec: Mapping[str, Any]) -> set[str]:
    """Every name the verb could read, whole and split at hyphens."""
    text = f"{spec.get('first', '')} {spec.get('expression') or ''}"
    words = re.findall(r"[A-Za-z_][\w-]*", text)
    return {column_name(w) for w in words} | {p for w in words for p in w.split("-")}


def apply_verbs(df: DataFrame, expressions: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Apply verbs in order; each one sees the columns set before it.

    Targets that are no column yet are working storage: they appear on first
    use, counting from 0 (from 1 for MULTIPLY). Verbs that do not read each
    other's results share one projection.
    """
    pending: dict[str, Column] = {}
    for spec in map(_documented, expressions):
        target = find_column(df.columns, spec["target"]) or spec["target"]
        if pending and (_mentions(spec) | {target}) & set(pending):
            df, pending = df.withColumns(pending), {}
        pending[target] = verb_column(df, spec, spec["target"])
    return df.withColumns(pending) if pending else df
