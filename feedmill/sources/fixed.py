"""Fixed-width feeds: layout projection, envelope fields, width checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedmill.fields import Field, Layout
from feedmill.sources.lines import read_lines, split_envelope

Spec = Field | Mapping[str, Any]


class Feed(NamedTuple):
    """A parsed feed; ``feed`` joins the three frames."""

    data: DataFrame
    header: DataFrame
    trailer: DataFrame


def implied_decimal(digits: Column, precision: int, length: int = 18) -> Column:
    """Digits with an implied point: exact decimal scaling, NULL if not a number.

    Fields of more than 18 places get a wider decimal, up to Spark's 38.
    """
    unit = F.lit(Decimal(1).scaleb(-precision)).cast(T.DecimalType(precision + 1, precision))
    if length <= 18:
        return (digits.try_cast("bigint") * unit).try_cast(T.DecimalType(18, precision))
    # Scaling by text: the product of wide decimals would lose digits.
    whole = digits.try_cast(T.DecimalType(38, 0)).cast("string")
    sign, plain = F.when(whole.startswith("-"), "-").otherwise(""), F.ltrim(whole, F.lit("-"))
    plain = F.when(F.length(plain) <= precision, F.lpad(plain, precision + 1, "0")).otherwise(plain)
    cut = F.length(plain) - precision
    text = F.concat(sign, F.substring(plain, F.lit(1), cut), F.lit("."), F.substring(plain, cut + 1, F.lit(precision)))
    return text.try_cast(T.DecimalType(38, precision))


def field_column(field: Field) -> Column:
    """Value of a data field: trimmed text, or a scaled decimal.

    Other types stay text on purpose, so validation can still see bad input.
    """
    text = F.trim(F.substring("value", field.start, field.length))
    if field.implied:
        text = implied_decimal(text, field.precision, field.length)
    return text.alias(field.column)


def envelope_column(field: Field) -> Column:
    """Value of a header or trailer field; empty if the line is too short."""
    text = F.trim(F.substring("value", field.start, field.length))
    return F.when(F.length("value") >= field.end, text).otherwise("").alias(field.column)


def parse_fixed(lines: DataFrame, layout: Layout, *keep: str) -> DataFrame:
    """Project lines on a layout, all fields in one pass."""
    return lines.select(*keep, *[field_column(f) for f in layout.fields])


def parse_envelope(lines: DataFrame, fields: Iterable[Spec]) -> DataFrame:
    """Project header or trailer lines; one row per line, with its ``line_no``."""
    columns = [envelope_column(f) for f in Layout.of(fields).fields]
    return lines.select("feed", "line_no", *columns)


def last_per_feed(envelope: DataFrame) -> DataFrame:
    """One row per feed: where several envelope lines exist, the last one."""
    values = [c for c in envelope.columns if c not in ("feed", "line_no")]
    last = F.max(F.struct("line_no", *values)).alias("last")
    return envelope.groupBy("feed").agg(last).select(
        "feed", *[F.col(f"last.{c}").alias(c) for c in values]
    )


def width_profile(lines: DataFrame, record_length: int) -> DataFrame:
    """Per feed: number of records above and below the declared width."""
    width = F.length("value")
    return lines.groupBy("feed").agg(
        F.count_if(width > record_length).alias("too_wide"),
        F.count_if(width < record_length).alias("too_short"),
        F.count(F.lit(1)).alias("records"),
    )


def absolute_offset(lines: DataFrame, layout: Layout) -> int:
    """Offset of a layout whose starts count on through several record types.

    Such starts lie past the end of every record; the first start then marks
    position one. A declared record length settles it; without one, a layout
    that does not begin at position one costs a pass for the shortest line.
    """
    first = min((f.start for f in layout.fields), default=1)
    if first <= 1:
        return 0
    shortest = layout.record_length or lines.agg(F.min(F.length("value"))).first()[0]
    return first - 1 if shortest is not None and first - 1 >= shortest else 0


def read_fixed(
    spark: SparkSession,
    path: str | list[str],
    fields: Iterable[Spec] | Layout,
    header_count: int = 0,
    trailer_count: int = 0,
    header_fields: Iterable[Spec] = (),
    trailer_fields: Iterable[Spec] = (),
    unit: str = "auto",
    detect_offset: bool = True,
) -> Feed:
    """Read fixed-width feeds into data, header and trailer frames.

    All files of ``path`` are read together and stay apart by ``feed``. Short
    lines give empty trailing fields; blank lines are no records.
    """
    header_fields, trailer_fields = list(header_fields), list(trailer_fields)
    envelope = split_envelope(read_lines(spark, path), header_count, trailer_count, unit)
    layout = Layout.of(fields)
    if not layout.fields:
        data = envelope.data.select("feed", "value")
    else:
        if detect_offset:
            layout = layout.shifted(absolute_offset(envelope.data, layout))
        data = parse_fixed(envelope.data, layout, "feed")
    return Feed(
        data,
        parse_envelope(envelope.header, header_fields),
        parse_envelope(envelope.trailer, trailer_fields),
    )
