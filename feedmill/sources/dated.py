"""Dated dataset directories: ``<base>/<FREQUENCY>/<date>/<file>``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmill.fields import Field, Layout
from feedmill.sources.fixed import Feed, read_fixed


def load_date(source: Column, frequency: str) -> Column:
    """Date directory below ``<FREQUENCY>`` in a file path.

    Accepts both a bare ``20260301`` directory and a ``load_date=20260301`` one.
    """
    below = F.substring_index(source, f"/{frequency.upper()}/", -1)
    return F.replace(F.substring_index(below, "/", 1), F.lit("load_date="), F.lit(""))


def with_load_date(df: DataFrame, frequency: str, source: str = "feed") -> DataFrame:
    """Add the ``load_date`` a row was delivered under, taken from its path."""
    return df.withColumn("load_date", load_date(F.col(source), frequency))


def days_between(first: dt.date, last: dt.date) -> list[dt.date]:
    """All days from ``first`` to ``last``, both included."""
    return [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]


def dated_paths(base: str, frequency: str, days: Iterable[dt.date]) -> str:
    """One path that names the directories of the wanted days, in either form.

    Spark lists the directory of the frequency once and opens only those that exist.
    """
    names = [f"{prefix}{day:%Y%m%d}" for day in days for prefix in ("", "load_date=")]
    if not names:
        raise ValueError("no days to read")
    return f"{base.rstrip('/')}/{frequency.upper()}/{{{','.join(names)}}}"


def read_dated(
    spark: SparkSession,
    base: str,
    frequency: str,
    days: Iterable[dt.date],
    fields: Iterable[Field | Mapping[str, Any]] | Layout,
    **options: Any,
) -> Feed:
    """Fixed-width feeds of the wanted days, each row with its ``load_date``.

    Other days are neither listed nor read; a day without a directory gives no rows,
    and no directory at all is an error. ``options`` are those of ``read_fixed``.
    """
    feed = read_fixed(spark, dated_paths(base, frequency, days), fields, **options)
    return Feed(*(with_load_date(part, frequency) for part in feed))
