"""Date patterns, path dates and the business calendar."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, SparkSession, functions as F

# Fixed value: date part of a dated path.
DAY = "yyyyMMdd"


def spark_pattern(pattern: str) -> str:
    """Turn an upper-case record pattern such as ``YYYYMMDD`` into Spark's letters."""
    return pattern.strip().replace("Y", "y").replace("DD", "dd").replace("SS", "ss")


_TODAY = r"(?:load_date|current_date)\s*\(\s*\)"
# Dated-path expressions: the whole text as a pattern -> its date, from the run date and
# what the pattern's group holds.
_PATH_DATES: dict[str, Callable[[Column, str], Column]] = {
    _TODAY: lambda day, _: F.date_format(day, DAY),
    rf"date_sub\s*\(\s*{_TODAY}\s*,\s*(\d+)\s*\)": lambda day, n: F.date_format(F.date_sub(day, int(n)), DAY),
    rf"date_format\s*\(\s*{_TODAY}\s*,\s*['\"]([^'\"]+)['\"]\s*\)": lambda day, form: F.date_format(day, spark_pattern(form)),
    rf"last_day\s*\(\s*{_TODAY}\s*\)": lambda day, _: F.date_format(F.last_day(day), DAY),
}


def path_date(expression: str, run_date: Column) -> Column:
    """A dated-path expression as a string column, relative to ``run_date``.

    Understands ``load_date()``, ``current_date()``,
    ``date_sub(current_date(), N)``, ``date_format(current_date(), 'fmt')`` and
    ``last_day(current_date())``; any other text is a literal.
    """
    text = expression.strip() or "load_date()"
    matches = ((date, re.fullmatch(pattern, text, re.I)) for pattern, date in _PATH_DATES.items())
    return next((date(run_date, (found.groups() or ("",))[0]) for date, found in matches if found), F.lit(text))


def dated_path(
    spark: SparkSession,
    base: str,
    frequency: str = "",
    run_date: dt.date | None = None,
    expression: str = "load_date()",
    file_name: str = "",
) -> str:
    """``<base>/<FREQUENCY>/<date>/<file>``; empty parts are left out."""
    parts = [base.rstrip("/")] if base else []
    if frequency:
        day = F.lit(run_date or dt.date.today())
        value = spark.sql("SELECT 1").select(path_date(expression, day)).first()[0]
        parts += [frequency.upper(), value]
    if file_name:
        parts.append(file_name)
    return "/".join(parts)


def holiday_dates(holidays: Iterable[Any]) -> list[dt.date]:
    """Active holidays as dates; entries are ISO text, dates or ``{active,name,date}``."""
    days = []
    for entry in holidays or ():
        if isinstance(entry, Mapping):
            if not entry.get("active", True) or not entry.get("date"):
                continue
            entry = entry["date"]
        if not isinstance(entry, dt.date):
            entry = dt.date.fromisoformat(str(entry).strip())
        days.append(entry)
    return sorted(set(days))


def previous_business_day(
    day: Column, holidays: Iterable[Any] = (), skip_weekends: bool = False
) -> Column:
    """Last business day strictly before ``day``.

    Weekends count as business days unless ``skip_weekends``. The holiday list is
    configuration, so it travels in the expression: days are tried back as far as
    the longest closed stretch in that list, and no join or shuffle is needed.
    """
    closed = holiday_dates(holidays)

    def is_closed(d: dt.date) -> bool:
        return d in shut or (skip_weekends and d.weekday() >= 5)

    shut, longest = set(closed), 2 if skip_weekends else 0
    for d in closed:
        first, last = d, d
        while is_closed(first - dt.timedelta(days=1)):
            first -= dt.timedelta(days=1)
        while is_closed(last + dt.timedelta(days=1)):
            last += dt.timedelta(days=1)
        longest = max(longest, (last - first).days + 1)

    def open_day(d: Column) -> Column:
        keep = ~d.isin(closed) if closed else F.lit(True)
        return keep & (F.weekday(d) < 5) if skip_weekends else keep

    candidates = [F.date_sub(day, n) for n in range(1, longest + 2)]
    return F.coalesce(*[F.when(open_day(d), d) for d in candidates])
