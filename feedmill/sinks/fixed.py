"""Fixed-width writers: lines, envelopes and many feeds at once."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedmill.fields import INTEGRAL, Field, Layout
from feedmill.functions.content import content_hash
from feedmill.functions.dates import spark_pattern
from feedmill.functions.names import find_column, sql_text
from feedmill.functions.numbers import fitting, is_number, plain_text, whole_text
from feedmill.session import keep

Spec = Field | Mapping[str, Any]

# Fixed value: Spark's directory name for rows without a partition value.
NO_FEED = "__HIVE_DEFAULT_PARTITION__"


def refuse_append(mode: str, path: str) -> None:
    """A feed with header or trailer cannot grow: its lines would end up inside."""
    if mode.lower() == "append":
        raise ValueError(f"cannot append to the enveloped feed at '{path}'; write a directory of its own")


def _implied(value: Column, field: Field) -> Column:
    """Digits without their point, sign first, then zeros; longer than the field if they must be."""
    exact = value.try_cast(T.DecimalType(38, field.precision)).cast("string")
    digits = F.ltrim(F.replace(F.ltrim(exact, F.lit("-")), F.lit("."), F.lit("")), F.lit("0"))

    def filled(width: int) -> Column:
        return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)

    minus = F.concat(F.lit("-"), filled(max(1, field.length - 1)))
    return F.when(exact.startswith("-") & (digits != ""), minus).otherwise(filled(field.length))


def _text(value: Column, field: Field) -> Column:
    """A value as text: numbers in the form of the field's type, never with an exponent."""
    if field.type in INTEGRAL:
        # Text stays as it is, so that validation can still see it.
        return F.when(is_number(value), whole_text(value)).otherwise(value.cast("string"))
    return plain_text(value)


def data_piece(value: Column, field: Field, on_overflow: str = "error") -> Column:
    """One field of a data line, padded to its length; NULL is blank.

    Text is cut to its length. A number that does not fit raises an error, since
    its first digits would be another number; ``on_overflow="truncate"`` cuts it.
    """
    if field.implied:
        text = _implied(value, field)
    elif field.format and field.type in ("date", "timestamp"):
        text = F.date_format(value, spark_pattern(field.format))
    else:
        text = _text(value, field)
    text = F.coalesce(text, F.lit(""))
    if field.implied or field.numeric:
        text = fitting(text, field, on_overflow)
    pad = F.lpad if field.numeric or field.just_right else F.rpad
    return pad(text, field.length, " ")


def compose(pieces: list[tuple[Field, Column]], width: int, cut_text: bool = False) -> Column:
    """Pieces set at their starts, gaps blank, the line as wide as declared.

    Every piece has its exact length, so the rest of the line is a constant. Pieces that
    reach beyond the line are an error, since a number cut off would be another one;
    ``cut_text`` lets text fields be cut.
    """
    for field, _ in pieces:
        if field.end > width and (field.numeric or not cut_text):
            raise ValueError(f"'{field.name}' reaches to place {field.end} of a record of {width}")
    out: list[Column] = []
    cursor = 1
    for field, piece in sorted(pieces, key=lambda p: p[0].start):
        if field.start < cursor:
            raise ValueError(f"field '{field.name}' overlaps the one before it")
        if field.start > cursor:
            out.append(F.lit(" " * (field.start - cursor)))
        out.append(piece)
        cursor = field.end + 1
    if width >= cursor:
        out.append(F.lit(" " * (width - cursor + 1)))
    line = F.concat(*out)
    return line if width >= cursor - 1 else F.substring(line, 1, width)


def fixed_line(df: DataFrame, layout: Layout, on_overflow: str = "error") -> Column:
    """A row as one line. Fields the frame lacks are blank.

    If no field name matches any column, fields map to columns by position.
    """
    fields = [f for f in layout.fields if f.record_type == "DATA"]
    found = [find_column(df.columns, f.name) for f in fields]
    if not any(found):
        found = [*df.columns[: len(fields)], *[None] * (len(fields) - len(df.columns))]
    pieces = [
        (f, F.lit(" " * f.length) if c is None else data_piece(df[c], f, on_overflow))
        for f, c in zip(fields, found)
    ]
    return compose(pieces, layout.width, cut_text=True)


def to_lines(df: DataFrame, fields: Iterable[Spec] | Layout, on_overflow: str = "error") -> DataFrame:
    """All rows as fixed-width lines in column ``value``."""
    return df.select(fixed_line(df, Layout.of(fields), on_overflow).alias("value"))


def envelope_piece(field: Field, columns: list[str]) -> Column:
    """One header or trailer field from its expression (literal or aggregate)."""
    value = F.expr(sql_text(field.expression, columns)) if field.expression else F.lit("")
    if field.format and field.type in ("date", "timestamp"):
        value = F.date_format(value, spark_pattern(field.format))
    number = is_number(value)
    text = F.coalesce(_text(value, field), F.lit(""))
    # Numbers fit whatever the field's type says; other text is cut.
    text = F.when(number | F.lit(field.numeric), fitting(text, field, "error")).otherwise(text)
    pad = F.lpad if field.numeric or field.just_right else F.rpad
    return pad(text, field.length, " ")


def envelope_line(fields: Iterable[Spec], columns: list[str], data: Layout) -> Column:
    """A header or trailer line; without fields it is blank.

    It is as wide as a data line, or wider if its own fields need it; fields beyond a
    declared record length are an error.
    """
    layout = Layout.of(fields)
    width = data.record_length or max(data.width, layout.width)
    if not layout.fields:
        return F.lit(" " * data.width)
    return compose([(f, envelope_piece(f, columns)) for f in layout.fields], width)


def write_fixed(
    df: DataFrame,
    fields: Iterable[Spec] | Layout,
    path: str,
    header_count: int = 0,
    trailer_count: int = 0,
    header_fields: Iterable[Spec] = (),
    trailer_fields: Iterable[Spec] = (),
    mode: str = "overwrite",
    on_overflow: str = "error",
    stored: bool = False,
) -> None:
    """Write one feed as ordered part files: header, data, trailer.

    The rows of a feed with header or trailer are computed once and stored, so that its
    totals are those of the very rows it holds; ``stored`` says that they already are.
    A union keeps its inputs in order, so data is written in parallel and never moved.
    Only a feed without header and trailer can be appended to.
    """
    layout = Layout.of(fields)
    if not layout.fields:
        raise ValueError("a fixed-width output needs fields")
    if not (header_count or trailer_count):
        to_lines(df, layout, on_overflow).write.mode(mode).text(path)
        return
    refuse_append(mode, path)
    df = df if stored else keep(df)
    body = to_lines(df, layout, on_overflow)
    ends = df.agg(
        envelope_line(header_fields, df.columns, layout).alias("header"),
        envelope_line(trailer_fields, df.columns, layout).alias("trailer"),
    ).first()
    one = df.sparkSession.range(0, 1, 1, 1)
    parts = [one.select(F.lit(ends["header"]).alias("value"))] * header_count
    parts += [body]
    parts += [one.select(F.lit(ends["trailer"]).alias("value"))] * trailer_count
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    whole.write.mode(mode).text(path)


def write_feeds(
    df: DataFrame,
    feed: str,
    fields: Iterable[Spec] | Layout,
    path: str,
    header_fields: Iterable[Spec] = (),
    trailer_fields: Iterable[Spec] = (),
    order_by: Iterable[str] = (),
    mode: str = "overwrite",
    on_overflow: str = "error",
) -> None:
    """Write one enveloped feed per value of ``feed``, each in its own directory.

    Lines are range-partitioned by feed, section and order, so a large feed is
    spread over many part files whose order is the order of the feed. A blank
    ``order_by`` spreads rows by content. Nothing can be appended to such feeds. The
    rows are computed once and stored; lines and totals come from the same copy.
    """
    refuse_append(mode, path)
    layout = Layout.of(fields)
    if not layout.fields:
        raise ValueError("a fixed-width output needs fields")
    if isinstance(df.schema[feed].dataType, T.StringType):
        # A key that cannot be NULL keeps its order through the partitioned write.
        named = F.coalesce(F.nullif(feed, F.lit("")), F.lit(NO_FEED))
        df = df.withColumn(feed, named)
    df = keep(df)
    order = [F.col(c) for c in order_by]
    body = df.select(
        feed,
        F.lit(1).alias("__section"),
        F.struct(*order, content_hash(df).alias("__hash")).alias("__order"),
        fixed_line(df, layout, on_overflow).alias("value"),
    )
    order_type = body.schema["__order"].dataType
    columns = [c for c in df.columns if c != feed]
    ends = df.groupBy(feed).agg(
        envelope_line(header_fields, columns, layout).alias("header"),
        envelope_line(trailer_fields, columns, layout).alias("trailer"),
    )
    # One unfolded row per feed: the totals are computed once for both ends.
    sections = F.array(
        F.struct(F.lit(0).alias("__section"), F.col("header").alias("value")),
        F.struct(F.lit(2).alias("__section"), F.col("trailer").alias("value")),
    )
    ends = ends.select(feed, F.explode(sections).alias("e")).select(
        feed, "e.__section", F.lit(None).cast(order_type).alias("__order"), "e.value"
    )
    keys = [feed, "__section", "__order"]
    (
        body.union(ends)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(feed, "value")
        .write.mode(mode)
        .partitionBy(feed)
        .text(path)
    )
