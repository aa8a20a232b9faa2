"""Feed reconciliation: counts, continuity and missing dates, for all feeds at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmill.functions.dates import previous_business_day
from feedmill.functions.names import get_column
from feedmill.sources.inventory import path_exists
from feedmill.sources.lines import feed_ends, read_lines


# A field is a record count if its name holds one of these.
COUNT_WORDS = ("count", "cnt")


class CountMismatch(RuntimeError):
    """Raised by the gate on a feed whose trailer count is wrong."""


class MissingInput(RuntimeError):
    """Raised by a flow whose declared inputs were not all delivered."""


class BrokenContinuity(RuntimeError):
    """Raised by the gates on deliveries that are missing or carry a wrong date."""


def count_column(columns: Iterable[str]) -> str:
    """The first column whose name says it is a count."""
    for name in columns:
        if any(word in name.lower() for word in COUNT_WORDS):
            return name
    raise ValueError(f"no count column among {list(columns)}")


def feed_counts(data: DataFrame, key: str = "feed") -> DataFrame:
    """Rows per feed; combined in each task before the shuffle."""
    return data.groupBy(key).agg(F.count(F.lit(1)).alias("actual_count"))


def compare_counts(
    expected: DataFrame,
    data: DataFrame,
    count_field: str | None = None,
    minus: int = 0,
    key: str = "feed",
) -> DataFrame:
    """Expected against actual rows per feed.

    ``expected`` has one row per feed with a count field (by default the first
    one named so), ``minus`` are the envelope lines that count includes. Feeds
    known to one side only are reported, and a count that is no number is NULL
    and never a match.
    """
    names = [c for c in expected.columns if c != key]
    field = get_column(names, count_field) if count_field else count_column(names)
    declared = expected.select(
        key, (F.trim(field).try_cast("bigint") - F.lit(minus)).alias("expected_count")
    )
    actual = F.coalesce("actual_count", F.lit(0).cast("bigint"))
    return declared.join(feed_counts(data, key), key, "full").select(
        key,
        "expected_count",
        actual.alias("actual_count"),
        F.coalesce(F.col("expected_count") == actual, F.lit(False)).alias("matches"),
    )


def require_counts(comparison: DataFrame) -> DataFrame:
    """The comparison itself, or :class:`CountMismatch` with up to five feeds."""
    wrong = comparison.filter(~F.col("matches")).limit(5).collect()
    if wrong:
        raise CountMismatch(f"record counts do not match: {[r.asDict() for r in wrong]}")
    return comparison


def continuity(
    headers: DataFrame,
    file_date: Column,
    header_date: Column,
    holidays: Iterable[Any] = (),
    skip_weekends: bool = False,
    keys: Iterable[str] = (),
) -> DataFrame:
    """Each delivery against the one of its previous business day.

    For every delivery: the date of the previous business day, whether a file
    was delivered for it and the date that file's header carries. ``status`` is
    ``ok``, ``missing`` or ``wrong_date``; the first delivery has none before it
    and is left out. Deliveries are one row each, whatever the feeds hold.
    """
    keys = list(keys)
    days = headers.select(
        *keys, file_date.alias("file_date"), header_date.alias("header_date")
    ).distinct()
    today = days.withColumn(
        "expected_date", previous_business_day(F.col("header_date"), holidays, skip_weekends)
    ).select(*keys, "file_date", "expected_date")
    before = days.select(
        *keys, F.col("file_date").alias("expected_date"), F.col("header_date").alias("actual_date"),
        F.lit(True).alias("delivered"),
    )
    if keys:
        start = days.groupBy(*keys).agg(F.min("file_date").alias("first_date"))
        today = today.join(start, keys).filter("file_date > first_date").drop("first_date")
    else:
        first = days.agg(F.min("file_date")).scalar()
        today = today.filter(F.col("file_date") > first)
    status = (
        F.when(F.col("delivered").isNull(), "missing")
        .when(F.col("actual_date") == F.col("expected_date"), "ok")
        .otherwise("wrong_date")
    )
    return today.join(before, [*keys, "expected_date"], "left").select(
        *keys, "file_date", "expected_date", "actual_date", status.alias("status")
    )


def compare_total(data: DataFrame, expected: Column, source: DataFrame) -> DataFrame:
    """One row: the count that ``expected`` finds in ``source``, its lines with ``line_no``,
    against all rows of ``data``, in the columns of :func:`compare_counts`. The first line
    counts; without one, or if it is no number, the count is NULL and never a match."""
    count = F.trim(expected).try_cast("bigint")
    declared = source.agg(F.min_by(F.struct(count.alias("n")), F.col("line_no")).alias("first")).select("first.n").scalar()
    actual = data.agg(F.count(F.lit(1)).alias("actual_count"))
    return actual.select(
        F.lit("all").alias("feed"), declared.alias("expected_count"), "actual_count",
        F.coalesce(declared == F.col("actual_count"), F.lit(False)).alias("matches"))


def previous_delivery(
    spark: SparkSession,
    run_date: dt.date,
    path_of: Callable[[dt.date], str],
    header_date: Callable[[DataFrame], Column] | None = None,
    holidays: Iterable[Any] = (),
    skip_weekends: bool = False,
) -> DataFrame:
    """The delivery of the business day before ``run_date``, as one row of :func:`continuity`.

    ``path_of`` names the place of a day's delivery. ``header_date`` takes its lines to the
    date its header carries; without it, a delivery that is there is right and no file is
    opened.
    """
    day = spark.range(1).select(previous_business_day(F.lit(run_date), holidays, skip_weekends).alias("d"))
    expected = day.first()["d"]
    actual, status = None, "ok"
    if not path_exists(spark, path_of(expected)):
        status = "missing"
    elif header_date is not None:
        first = feed_ends(read_lines(spark, path_of(expected)), header_count=1)[0]
        actual = first.agg(F.max(header_date(first))).first()[0]
        status = "ok" if actual == expected else "wrong_date"
    return spark.range(1).select(
        F.lit(run_date).alias("file_date"), F.lit(expected).alias("expected_date"), F.lit(actual).cast("date").alias("actual_date"),
        F.lit(status).alias("status"))


def require_continuity(days: DataFrame) -> DataFrame:
    """The continuity check itself, or :class:`BrokenContinuity` with up to five days."""
    wrong = days.filter("status <> 'ok'").limit(5).collect()
    if wrong:
        raise BrokenContinuity(f"deliveries do not follow on: {[r.asDict() for r in wrong]}")
    return days


def require_delivered(listing: DataFrame) -> None:
    """Nothing if every input is there, else :class:`MissingInput` with all that are not."""
    missing = listing.filter("NOT delivered").select("input", "path").collect()
    if missing:
        raise MissingInput(f"inputs were not delivered: {[r.asDict() for r in missing]}")


def require_complete(missing: DataFrame) -> None:
    """Nothing if no date is missing, else :class:`BrokenContinuity` with up to five."""
    gaps = missing.limit(5).collect()
    if gaps:
        raise BrokenContinuity(f"no delivery for {[r.asDict() for r in gaps]}")


def missing_dates(
    deliveries: DataFrame,
    date: str,
    holidays: Iterable[Any] = (),
    skip_weekends: bool = False,
    keys: Iterable[str] = (),
) -> DataFrame:
    """Business days between first and last delivery on which nothing came.

    Deliveries shrink to distinct days first, so the calendar and the days it is
    compared with grow with the length of the period, not with the data.
    """
    keys = list(keys)
    days = deliveries.select(*keys, F.col(date).cast("date").alias("day")).distinct()
    bounds = days.groupBy(*keys).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = bounds.select(*keys, F.explode(F.sequence("lo", "hi")).alias("day"))
    # A day is a business day when it is the previous one of the day after it.
    is_business = (
        previous_business_day(F.date_add("day", 1), holidays, skip_weekends) == F.col("day")
    )
    return calendar.filter(is_business).join(days, [*keys, "day"], "left_anti").select(
        *keys, F.col("day").alias("missing_date")
    )
