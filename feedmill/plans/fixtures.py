"""Feeds written from the given tables, in the shared folder, for the feed queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedmill.fields import Layout
from feedmill.plans.registry import table
from feedmill.session import new_folder
from feedmill.sinks.fixed import write_feeds

ORDER_FIELDS = [
    {"name": "ORDER-KEY", "type": "long", "start": 1, "length": 10},
    {"name": "STATUS", "type": "string", "start": 11, "length": 2},
    {"name": "AMOUNT", "type": "decimal", "precision": 2, "start": 13, "length": 12},
    {"name": "PRIORITY", "type": "string", "start": 25, "length": 15},
]
ORDER_HEADER = [
    {"name": "REC-ID", "start": 1, "length": 3, "expression": "'HDR'"},
    {"name": "FILE-DATE", "start": 4, "length": 8, "expression": "date_format(max(FILE_DAY), 'yyyyMMdd')"},
]
ORDER_TRAILER = [
    {"name": "REC-ID", "start": 1, "length": 3, "expression": "'TRL'"},
    {"name": "RECORD-COUNT", "start": 4, "length": 10, "expression": "lpad(count(*) + 2, 10, '0')"},
]
ORDER_LAYOUT = Layout.of(ORDER_FIELDS, record_length=40)

# Business holidays that fall into the period of the given tables.
HOLIDAYS = [
    {"active": True, "name": "Christmas Day", "date": "1996-12-25"},
    {"active": True, "name": "Day after Christmas", "date": "1996-12-26"},
    {"active": False, "name": "Withdrawn", "date": "1997-03-10"},
    {"active": True, "name": "New Year's Day", "date": "1998-01-01"},
    {"active": True, "name": "Independence Day", "date": "1999-07-04"},
    {"active": True, "name": "New Year's Day", "date": "2024-01-01"},
    {"active": True, "name": "Martin Luther King Jr. Day", "date": "2024-01-15"},
]


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders under record names, with exact amounts and the year of the feed."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ORDER_KEY"),
        F.col("o_orderstatus").alias("STATUS"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("AMOUNT"),
        F.col("o_orderpriority").alias("PRIORITY"),
        F.year("o_orderdate").alias("order_year"),
        F.to_date("o_orderdate").alias("FILE_DAY"),
    )


def order_feeds(spark: SparkSession, folder: str) -> str:
    """One enveloped feed per order year, in key order; returns their folder."""
    path = new_folder(spark, "orders")
    write_feeds(
        orders(spark, folder), "order_year", ORDER_LAYOUT, path,
        ORDER_HEADER, ORDER_TRAILER, order_by=["ORDER_KEY"],
    )
    return path


def feed_year():
    """Year of a feed from its directory."""
    return F.regexp_extract("feed", r"order_year=(\d+)", 1).cast("int")


EVENT_FIELDS = [
    {"name": "EVENT-ID", "type": "long", "length": 12},
    {"name": "USER-ID", "type": "long", "length": 8},
    {"name": "EVENT-TYPE", "length": 10},
]
EVENT_HEADER = [
    {"name": "REC-ID", "length": 3, "expression": "'HDR'"},
    {"name": "FILE-DATE", "length": 8, "expression": "max(HEADER_DAY)"},
]
EVENT_TRAILER = [
    {"name": "REC-ID", "length": 3, "expression": "'TRL'"},
    {"name": "REC-CNT", "length": 10, "expression": "lpad(count(*) + 2, 10, '0')"},
]
# Deliveries the feed lost, and one that carries the date of another day.
LOST_DAYS = ["2024-01-10", "2024-01-20"]
# Days for which the flows declare an input.
DECLARED_DAYS = [f"202401{day:02d}" for day in range(8, 23)]
WRONG_DAY, WRONG_HEADER = "2024-01-25", "2024-01-23"


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events under record names, with the day of their delivery."""
    day = F.date_format("ts", "yyyy-MM-dd")
    header = F.when(day == WRONG_DAY, F.lit(WRONG_HEADER)).otherwise(day)
    return table(spark, folder, "events").select(
        F.col("event_id").alias("EVENT_ID"),
        F.col("user_id").alias("USER_ID"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.replace(day, F.lit("-"), F.lit("")).alias("load_date"),
        F.replace(header, F.lit("-"), F.lit("")).alias("HEADER_DAY"),
    )


def event_feeds(spark: SparkSession, folder: str, complete: bool = False) -> str:
    """Daily event deliveries below ``DAILY``, two of them lost unless ``complete``;
    returns their base."""
    base = new_folder(spark, "events")
    lost = [] if complete else [d.replace("-", "") for d in LOST_DAYS]
    delivered = events(spark, folder)
    write_feeds(
        delivered.filter(~F.col("load_date").isin(lost)) if lost else delivered, "load_date",
        Layout.of(EVENT_FIELDS, record_length=30), f"{base}/DAILY",
        EVENT_HEADER, EVENT_TRAILER, order_by=["EVENT_ID"],
    )
    return base


def dirty_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as feed text, with defects injected by key."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("CUST_ID"),
        F.when(key % 7 == 0, F.lit("  ")).otherwise(F.col("c_name")).alias("CUST_NAME"),
        F.when(key % 11 == 0, F.lit("ABCDEFGH"))
        .otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("AMOUNT"),
        F.when(key % 13 == 0, F.lit("20250230")).when(key % 17 == 0, F.lit(None))
        .otherwise(F.lit("20250228")).alias("AS_OF"),
        F.when(key % 5 == 0, F.concat(F.lit("c"), key, F.lit(" at example.org")))
        .otherwise(F.concat(F.lit("c"), key, F.lit("@example.org"))).alias("EMAIL"),
        F.col("c_mktsegment").alias("SEGMENT"),
        F.col("c_nationkey").alias("NATION"),
    )


DIRTY_SQL = """(SELECT c_custkey AS CUST_ID,
    CASE WHEN c_custkey % 7 = 0 THEN '  ' ELSE c_name END AS CUST_NAME,
    CASE WHEN c_custkey % 11 = 0 THEN 'ABCDEFGH'
         ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS AMOUNT,
    CASE WHEN c_custkey % 13 = 0 THEN '20250230' WHEN c_custkey % 17 = 0 THEN NULL
         ELSE '20250228' END AS AS_OF,
    CASE WHEN c_custkey % 5 = 0 THEN 'c' || c_custkey || ' at example.org'
         ELSE 'c' || c_custkey || '@example.org' END AS EMAIL,
    c_mktsegment AS SEGMENT, c_nationkey AS NATION FROM customer)"""
