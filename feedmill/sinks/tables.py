"""Parquet, delimited and quoted writers, output columns, control files."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedmill.fields import Field, Layout
from feedmill.functions.content import content_hash
from feedmill.functions.names import column_name, find_column
from feedmill.operators.reconcile import count_column
from feedmill.operators.totals import control_line
from feedmill.sinks.fixed import refuse_append, to_lines


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet directory; ``append`` adds to what is there."""
    df.write.mode(mode.lower()).parquet(path)


def write_days(df: DataFrame, day: Column, base: str, frequency: str, mode: str = "overwrite") -> None:
    """Rows below ``<base>/<FREQUENCY>/load_date=<yyyyMMdd>``, all their days in one write.

    Overwriting replaces the days that have rows and leaves the others as they are, so a
    rerun of some days touches no more than these. Rows are spread by day and content: a
    day that holds most of them takes many part files. A row without a day is an error.
    """
    stamp = F.date_format(day.cast("date"), "yyyyMMdd")
    dated = df.withColumn("load_date", F.when(day.isNull(), F.raise_error(F.lit("a row has no day")).cast("string")).otherwise(stamp))
    spread = dated.repartitionByRange("load_date", content_hash(df)).sortWithinPartitions("load_date")
    spread.write.mode(mode.lower()).option("partitionOverwriteMode", "dynamic").partitionBy("load_date").parquet(f"{base.rstrip('/')}/{frequency.upper()}")


def write_delimited(
    df: DataFrame, path: str, delimiter: str = ",", mode: str = "overwrite"
) -> None:
    """Delimited part files, each with its own line of column names."""
    df.write.mode(mode.lower()).option("header", True).option("sep", delimiter).csv(path)


def write_quoted(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bulk-load export: every value quoted, no line of names, in parallel."""
    df.write.mode(mode.lower()).option("quoteAll", True).option("header", False).csv(path)


def write_delimited_enveloped(
    df: DataFrame,
    path: str,
    delimiter: str = ",",
    header_count: int = 0,
    trailer_count: int = 0,
    mode: str = "overwrite",
) -> None:
    """One delimited feed with delimiter-only lines before and after the table.

    Part files follow each other in part order: header lines, the line of
    names, data, trailer lines. Text with line breaks cannot be written so, and
    nothing can be appended to a feed that is closed by its trailer.
    """
    refuse_append(mode, path)
    spark = df.sparkSession
    row = F.to_csv(F.struct(*[df[c] for c in df.columns]), {"sep": delimiter})
    broken = row.contains("\n") | row.contains("\r")
    row = F.when(broken, F.raise_error(F.lit("a value holds a line break"))).otherwise(row)
    blank = delimiter * (len(df.columns) - 1)
    names = io.StringIO()
    csv.writer(names, delimiter=delimiter, lineterminator="").writerow(df.columns)
    before = [blank] * header_count + [names.getvalue()]

    def fixed(lines: list[str]) -> DataFrame:
        # A single partition: its lines stay in the order of the array.
        one = spark.range(0, 1, 1, 1)
        return one.select(F.explode(F.array(*map(F.lit, lines))).alias("value"))

    whole = fixed(before).union(df.select(row.alias("value")))
    if trailer_count:
        whole = whole.union(fixed([blank] * trailer_count))
    whole.write.mode(mode.lower()).text(path)


def _shared_words(a: str, b: str) -> int:
    """Number of equal words at the end of two names."""
    pairs = zip(reversed(column_name(a).split("_")), reversed(column_name(b).split("_")))
    return next((k for k, (x, y) in enumerate(pairs) if x != y), min(a.count("_"), b.count("_")) + 1)


def _source_for(columns: list[str], wanted: str) -> str | None:
    """Column for an output name: the one with that name, else the one that shares most
    words at the end of its name, and among those the shortest name in words.

    ``OUT_CUST_ID`` is served by ``CUST_ID``, else by ``INP_CUST_ID``; two columns
    that serve equally well are an error.
    """
    named = find_column(columns, wanted)
    if named is not None:
        return named
    ranks = {c: (_shared_words(c, wanted), -column_name(c).count("_")) for c in columns}
    best = max(ranks.values(), default=(0, 0))
    if best[0] == 0:
        return None
    found = [c for c, rank in ranks.items() if rank == best]
    if len(found) > 1:
        raise ValueError(f"output column '{wanted}' could come from any of {found}")
    return found[0]


def output_columns(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    fields: Iterable[Field | Mapping[str, Any]] = (),
) -> DataFrame:
    """Select what an output declares.

    ``columns`` decides if given (an empty list keeps everything), else the
    declared fields. Names with no source are left out. When the list is as long
    as the declared fields, the result carries the declared names.
    """
    fields = [Field.of(f) for f in fields]
    wanted = [column_name(c) for c in columns] if columns is not None else [
        f.column for f in fields
    ]
    if not wanted:
        return df
    names = [f.name for f in fields] if len(fields) == len(wanted) else wanted
    chosen: list[Column] = []
    for want, name in zip(wanted, names):
        source = _source_for(df.columns, want)
        if source is not None:
            chosen.append(df[f"`{source}`"].alias(name))
    return df.select(*chosen)


def write_control_file(
    df: DataFrame,
    path: str,
    fields: Iterable[Field | Mapping[str, Any]] = (),
    include_header: bool = False,
    header: DataFrame | None = None,
    mode: str = "overwrite",
) -> None:
    """Control file of a frame: a plain count line, or one declared record."""
    fields = list(fields)
    if fields:
        record = control_line(df, fields, include_header=include_header, header=header)
    else:
        record = df.agg(F.count(F.lit(1)).cast("string").alias("value"))
    record.write.mode(mode.lower()).text(path)


def write_count_record(
    df: DataFrame,
    path: str,
    fields: Iterable[Field | Mapping[str, Any]],
    mode: str = "overwrite",
) -> None:
    """Structured count file: the first ``count``/``cnt`` field holds the row count."""
    layout = Layout.of(fields)
    count = count_column(layout.columns)
    total = df.agg(F.count(F.lit(1)).alias("__n"))
    row = total.select(
        *[
            (F.col("__n") if f.column == count else F.lit(None)).cast(T.StringType()).alias(f.column)
            for f in layout.fields
        ]
    )
    to_lines(row, layout).write.mode(mode.lower()).text(path)
