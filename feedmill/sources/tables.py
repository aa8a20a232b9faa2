"""Parquet and delimited sources, declared-type casts and empty frames."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedmill.fields import Field
from feedmill.functions.dates import spark_pattern
from feedmill.functions.names import column_name
from feedmill.sources.lines import read_lines, split_envelope

Spec = Field | Mapping[str, Any]


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet source; projection and filters reach the scan."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def empty_frame(spark: SparkSession, fields: Iterable[Spec]) -> DataFrame:
    """No rows, declared types: stands in for an input that was not delivered."""
    return spark.range(0).select(
        *[
            F.lit(None).cast(f.spark_type()).alias(f.column)
            for f in map(Field.of, fields)
        ]
    )


def _typed(source: Column, field: Field) -> Column:
    if field.type == "date" and field.format:
        return F.try_to_date(source.cast("string"), spark_pattern(field.format))
    if field.type == "timestamp" and field.format:
        return F.try_to_timestamp(
            source.cast("string"), F.lit(spark_pattern(field.format))
        )
    return source.try_cast(field.spark_type())


def typed_cast(df: DataFrame, fields: Iterable[Spec]) -> DataFrame:
    """Cast declared columns, by their date format where one is given.

    Values that do not parse become NULL. Declared fields the frame does not
    have are skipped, undeclared columns pass unchanged, and names match
    without regard to case.
    """
    declared = {f.column.lower(): f for f in map(Field.of, fields)}
    return df.select(
        *[
            _typed(F.col(f"`{c}`"), declared[c.lower()]).alias(c)
            if c.lower() in declared
            and declared[c.lower()].type not in ("string", "str")
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    fields: Iterable[Spec] = (),
    delimiter: str = ",",
    header_count: int = 0,
    trailer_count: int = 0,
    unit: str = "auto",
) -> DataFrame:
    """Delimited text whose first kept line names the columns.

    Declared columns are read as text and cast, so that leading zeros and exact
    decimals survive; types are inferred for undeclared columns only. Files whose
    line of names differs from the first one's are refused. ``header_count`` and
    ``trailer_count`` lines around the table are skipped in parallel.
    """
    fields = [Field.of(f) for f in fields]
    if header_count or trailer_count:
        return _read_enveloped(
            spark, path, fields, delimiter, header_count, trailer_count, unit
        )
    reader = spark.read.option("header", True).option("sep", delimiter)
    df = reader.csv(path)
    known = {f.column.lower() for f in fields}
    declared = [column_name(c).lower() in known for c in df.columns]
    schema = df.schema
    if not all(declared):
        guessed = reader.option("inferSchema", True).csv(path).schema
        schema = T.StructType([a if text else b for text, a, b in zip(declared, schema, guessed)])
    df = reader.schema(schema).option("enforceSchema", False).csv(path)
    return typed_cast(df.toDF(*map(column_name, df.columns)), fields)


def _read_enveloped(
    spark: SparkSession,
    path: str | list[str],
    fields: list[Field],
    delimiter: str,
    header_count: int,
    trailer_count: int,
    unit: str,
) -> DataFrame:
    # The line with the column names is one more header line of each feed.
    envelope = split_envelope(
        read_lines(spark, path), header_count + 1, trailer_count, unit
    )
    lines = envelope.header.filter(F.col("line_no") == header_count).select("value").distinct().limit(2).collect()
    if not lines:
        return empty_frame(spark, fields)
    if len(lines) > 1:
        raise ValueError(f"feeds differ in their line of names: {[r['value'] for r in lines]}")
    options = {"sep": delimiter}
    names = [column_name(n) for n in _split_names(lines[0]["value"], delimiter)]
    schema = ", ".join(f"`{n}` STRING" for n in names)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    whole = F.when(quotes % 2 == 0, F.col("value")).otherwise(
        F.raise_error(F.lit("a quoted field spans lines; such files have no line numbers"))
    )
    parsed = envelope.data.select(F.from_csv(whole, schema, options).alias("row"))
    return typed_cast(parsed.select("row.*"), fields)


def _split_names(line: str, delimiter: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([line], delimiter=delimiter))]
