import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedmill.fields import Field, Layout
from feedmill.functions.dates import (
    dated_path, holiday_dates, path_date, previous_business_day, spark_pattern)
from feedmill.functions.names import get_column, sql_text

D = dt.date


@pytest.mark.parametrize("text, columns, expected", [
    ("A-B", ["A", "B"], "A - B"),
    ("A-B", ["A_B"], "`A_B`"),
    ("CR-TOTAL _ DB-TOTAL", ["CR_TOTAL", "DB_TOTAL"], "`CR_TOTAL` - `DB_TOTAL`"),
    ("A-B-C", ["A_B", "C"], "`A_B` - C"),
    ("x + -1", ["x"], "x + -1"),
    ("date_format(d, 'yyyy-MM-dd')", ["d"], "date_format(d, 'yyyy-MM-dd')"),
    ("my_col - 1", ["my_col"], "my_col - 1"),
])
def test_expression_names(text, columns, expected):
    assert sql_text(text, columns) == expected


def test_missing_column_is_an_error():
    assert get_column(["CUST_ID"], "CUST-ID") == "CUST_ID"
    with pytest.raises(ValueError, match="no column"):
        get_column(["CUST_ID + 1"], "CUST-ID")


@pytest.mark.parametrize("pattern, expected", [
    ("YYYYMMDD", "yyyyMMdd"), ("DD/MM/YY", "dd/MM/yy"), ("yyyyMMdd HH:mm:SS", "yyyyMMdd HH:mm:ss"),
])
def test_patterns(pattern, expected):
    assert spark_pattern(pattern) == expected


BUSINESS_DAYS = [
    (D(2026, 3, 10), [], False, D(2026, 3, 9)),
    (D(2026, 1, 2), ["2026-01-01"], False, D(2025, 12, 31)),
    (D(2026, 3, 10), ["2026-03-09", "2026-03-08"], False, D(2026, 3, 7)),
    (D(2026, 3, 9), [], False, D(2026, 3, 8)),
    (D(2026, 3, 10), [{"active": False, "date": "2026-03-09"}], False, D(2026, 3, 9)),
    (D(2026, 3, 10), [{"active": True, "date": "2026-03-09"}], False, D(2026, 3, 8)),
    (D(2026, 3, 2), [], True, D(2026, 2, 27)),
    (D(2026, 7, 7), ["2026-07-06", "2026-07-03"], True, D(2026, 7, 2)),
]


@pytest.mark.parametrize("day, holidays, weekends, expected", BUSINESS_DAYS)
def test_previous_business_day(spark, day, holidays, weekends, expected):
    column = previous_business_day(F.lit(day), holidays, weekends)
    assert spark.range(1).select(column).first()[0] == expected


def test_holidays():
    assert holiday_dates(["2026-01-01", {"date": "2026-02-01"}, {"active": False, "date": "2026-03-01"},
                          {"active": True, "date": ""}]) == [D(2026, 1, 1), D(2026, 2, 1)]


@pytest.mark.parametrize("expression, expected", [
    ("load_date()", "20260301"), ("CURRENT_DATE()", "20260301"),
    ("date_sub(current_date(), 1)", "20260228"), ("last_day(current_date())", "20260331"),
    ("date_format(current_date(), 'MM-dd-yyyy')", "03-01-2026"), ("20250101", "20250101"),
])
def test_path_dates(spark, expression, expected):
    assert spark.range(1).select(path_date(expression, F.lit(D(2026, 3, 1)))).first()[0] == expected


def test_dated_path(spark):
    day = D(2026, 3, 1)
    assert dated_path(spark, "s3://b/curated/", "daily", day, file_name="TX.DAT") == \
        "s3://b/curated/DAILY/20260301/TX.DAT"
    assert dated_path(spark, "s3://b/output", "DAILY", day) == "s3://b/output/DAILY/20260301"
    assert dated_path(spark, "/plain", file_name="A") == "/plain/A"


def test_layout_advances_and_shifts():
    layout = Layout.of([{"name": "A-B", "length": 3}, {"name": "C", "start": 10, "length": 2},
                        {"name": "D", "type": "decimal", "precision": 2, "length": 4}])
    assert [(f.column, f.start) for f in layout.fields] == [("A_B", 1), ("C", 10), ("D", 12)]
    assert layout.width == 15
    assert [f.start for f in layout.shifted(-5).fields] == [6, 15, 17]
    assert Field.of({"name": "X", "type": "no-such"}).spark_type().simpleString() == "string"
    assert layout.fields[2].spark_type().simpleString() == "decimal(18,2)"
    with pytest.raises(ValueError):
        Field.of({"length": 3})
