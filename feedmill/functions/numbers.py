"""Numbers as text: exact, without an exponent, and never cut."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from feedmill.fields import Field

_FLOATING = ("double", "float")
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def is_number(value: Column) -> Column:
    """Whether the column is of a numeric type; known before any row is read."""
    kind = F.typeof(value)
    return kind.isin(*_FLOATING, *_WHOLE) | kind.startswith("decimal")


def _or_raise(found: Column, value: Column) -> Column:
    """``found``, or an error where it is NULL and the value is not."""
    message = F.concat(F.lit("not a number that can be written: "), value.cast("string"))
    return F.when(value.isNotNull() & found.isNull(), F.raise_error(message).cast("string")).otherwise(found)


def whole_text(value: Column) -> Column:
    """The part of a number before its point, in all its digits; text is read as a number."""
    text = value.cast("string")
    small = text.try_cast(T.DecimalType(38, 18))
    whole = F.coalesce(
        F.when(small < 0, F.ceil(small)).otherwise(F.floor(small)).cast(T.DecimalType(38, 0)), text.try_cast(T.DecimalType(38, 0)))
    return _or_raise(whole.cast("string"), value)


def plain_text(value: Column) -> Column:
    """Floating-point numbers without an exponent, other values as their own text."""
    text = value.cast("string")
    digits = F.coalesce(text.try_cast(T.DecimalType(38, 18)).cast("string"), text.try_cast(T.DecimalType(38, 0)).cast("string"))
    short = F.regexp_replace(F.regexp_replace(digits, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    point = F.when(short.contains("."), short).otherwise(F.concat(short, F.lit(".0")))
    floating = F.when(text.contains("E") | text.isin("NaN", "Infinity", "-Infinity"), _or_raise(point, value)).otherwise(text)
    return F.when(F.typeof(value).isin(*_FLOATING), floating).otherwise(text)


def scaled_text(value: Column, scale: int) -> Column:
    """The number rounded half up to so many places behind the point."""
    return _or_raise(value.cast("string").try_cast(T.DecimalType(38, scale)).cast("string"), value)


def fitting(text: Column, field: Field, on_overflow: str) -> Column:
    """The text, or an error if it is longer than its field; ``truncate`` cuts it."""
    if on_overflow == "truncate":
        return F.substring(text, 1, field.length)
    if on_overflow != "error":
        raise ValueError(f"unknown overflow mode '{on_overflow}'")
    message = F.concat(F.lit(f"value does not fit the {field.length} places of '{field.name}': "), text)
    return F.when(F.length(text) > field.length, F.raise_error(message).cast("string")).otherwise(text)
