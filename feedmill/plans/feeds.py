"""Queries that write feeds from the given tables and read them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedmill.fields import Layout
from feedmill.functions.dates import dated_path, path_date, spark_pattern
from feedmill.functions.ebcdic import encode_text, pack_decimal
from feedmill.operators.reconcile import MissingInput
from feedmill.operators.sets import union_frames
from feedmill.plans import fixtures
from feedmill.plans.flow import run_flow
from feedmill.plans.registry import query, table
from feedmill.session import new_folder
from feedmill.sinks import fixed as fixed_sink
from feedmill.sinks import tables as sinks
from feedmill.sinks.jdbc import column_types
from feedmill.sources.dated import days_between, read_dated, with_load_date
from feedmill.sources.ebcdic import parse_records, read_ebcdic, read_framed_records
from feedmill.sources.fixed import last_per_feed, read_fixed, width_profile
from feedmill.sources.lines import read_lines, split_envelope, with_positions
from feedmill.sources.tables import empty_frame, read_delimited, read_parquet, typed_cast

_ORDERS = """SELECT o_orderkey AS ORDER_KEY, o_orderstatus AS STATUS,
    CAST(o_totalprice AS DECIMAL(18,2)) AS AMOUNT, o_orderpriority AS PRIORITY FROM orders"""
_COLUMNS = ["ORDER_KEY", "STATUS", "AMOUNT", "PRIORITY"]


def _parsed(df):
    return df.select(F.col("ORDER_KEY").try_cast("bigint").alias("ORDER_KEY"),
                     "STATUS", "AMOUNT", "PRIORITY")


# ---- tables and delimited text -------------------------------------------------------

@query("scan_parquet", """
    SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity > 30""")
def scan_parquet(spark, folder):
    lines = read_parquet(spark, f"{folder}/lineitem.parquet")
    return lines.filter("l_returnflag = 'R' AND l_quantity > 30").select(
        "l_orderkey", "l_linenumber", "l_returnflag")


_CSV_FIELDS = [
    {"name": "ORDER-KEY", "type": "long"},
    {"name": "STATUS", "type": "string"},
    {"name": "AMOUNT", "type": "decimal", "precision": 2},
    {"name": "PRIORITY", "type": "string"},
    {"name": "ORDER-DAY", "type": "date", "format": "YYYYMMDD"},
]


def _csv_orders(spark, folder):
    orders = fixtures.orders(spark, folder)
    return orders.select(F.col("ORDER_KEY").alias("ORDER-KEY"), "STATUS", "AMOUNT", "PRIORITY",
                         F.date_format("FILE_DAY", "yyyyMMdd").alias("ORDER-DAY"))


_CSV_SQL = """SELECT o_orderkey AS ORDER_KEY, o_orderstatus AS STATUS,
    CAST(o_totalprice AS DECIMAL(18,2)) AS AMOUNT, o_orderpriority AS PRIORITY,
    strftime(o_orderdate, '%Y-%m-%d') AS ORDER_DAY FROM orders"""


def _day_text(df):
    return df.withColumn("ORDER_DAY", F.date_format("ORDER_DAY", "yyyy-MM-dd"))


@query("scan_csv", _CSV_SQL)
def scan_csv(spark, folder):
    path = new_folder(spark, "csv")
    _csv_orders(spark, folder).write.option("header", True).option("sep", "|").csv(path)
    return _day_text(read_delimited(spark, path, _CSV_FIELDS, "|"))


@query("scan_csv_enveloped", _CSV_SQL)
def scan_csv_enveloped(spark, folder):
    path = new_folder(spark, "csv-enveloped")
    sinks.write_delimited_enveloped(_csv_orders(spark, folder), path, "|", 2, 1)
    return _day_text(read_delimited(spark, path, _CSV_FIELDS, "|", 2, 1, unit="directory"))


@query("typed_cast", """
    SELECT o_orderkey, try_cast(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
           CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
           CASE WHEN regexp_matches(o_orderstatus, '[0-9]') THEN 1 END AS none
    FROM orders""")
def typed_cast_query(spark, folder):
    text = table(spark, folder, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).alias("rank"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("AMOUNT"),
        F.when(F.col("o_orderkey") % 9 == 0, "31.02.2025")
        .otherwise(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("day"),
        F.col("o_orderstatus").alias("none"),
    )
    typed = typed_cast(text, [
        {"name": "rank", "type": "int"}, {"name": "amount", "type": "decimal", "precision": 2},
        {"name": "day", "type": "date", "format": "DD.MM.YYYY"}, {"name": "none", "type": "int"},
        {"name": "absent", "type": "int"}])
    return typed.select("o_orderkey", "rank", F.col("AMOUNT").alias("amount"),
                        F.date_format("day", "yyyy-MM-dd").alias("day"), "none")


@query("empty_from_schema", """
    SELECT o_orderkey AS ORDER_KEY, o_orderstatus AS STATUS, CAST(NULL AS DECIMAL(18,2)) AS FEE
    FROM orders""")
def empty_from_schema(spark, folder):
    # An input that was not delivered still takes part with its declared columns.
    absent = empty_frame(spark, [{"name": "ORDER-KEY", "type": "long"}, {"name": "STATUS"},
                                 {"name": "FEE", "type": "decimal", "precision": 2}])
    return union_frames([absent, fixtures.orders(spark, folder).select("ORDER_KEY", "STATUS")])


# ---- fixed width ---------------------------------------------------------------------

def _plain_lines(spark, folder):
    """Order lines built column by column, apart from the writer under test."""
    return table(spark, folder, "orders").select(
        F.concat(
            F.lpad(F.col("o_orderkey").cast("string"), 10, "0"),
            F.rpad("o_orderstatus", 2, " "),
            F.lpad((F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint").cast("string"), 12, "0"),
            F.rpad("o_orderpriority", 15, " "),
        ).alias("value"),
        F.col("o_orderkey").alias("key"),
    )


def _ragged(spark, folder):
    """The lines with CRLF ends, blank lines between, and some cut after the status."""
    path = new_folder(spark, "ragged")
    cut = F.when(F.col("key") % 7 == 0, F.substring("value", 1, 12)).otherwise(F.col("value"))
    blanks = F.when(F.col("key") % 10 == 0, F.array(cut, F.lit(""))).otherwise(F.array(cut))
    lines = _plain_lines(spark, folder).select(F.explode(blanks).alias("value"))
    lines.write.option("lineSep", "\r\n").text(path)
    return path


@query("fixed_read", """SELECT o_orderkey AS ORDER_KEY, o_orderstatus AS STATUS,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS AMOUNT,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority ELSE '' END AS PRIORITY FROM orders""")
def fixed_read(spark, folder):
    feed = read_fixed(spark, _ragged(spark, folder), [
        {"name": "ORDER-KEY", "type": "long", "length": 10},
        {"name": "STATUS", "length": 2},
        {"name": "AMOUNT", "type": "decimal", "precision": 2, "length": 12},
        {"name": "PRIORITY", "length": 15}])
    return _parsed(feed.data)


@query("fixed_implied_decimal", """SELECT c_custkey AS CUST_ID,
    CAST(c_acctbal AS DECIMAL(18,2)) AS BALANCE FROM customer""")
def fixed_implied_decimal(spark, folder):
    path = new_folder(spark, "implied")
    cents = (F.col("c_acctbal").cast("decimal(18,2)") * 100).cast("bigint")
    digits = F.when(cents < 0, F.concat(F.lit("-"), F.lpad(F.abs(cents).cast("string"), 10, "0"))
                    ).otherwise(F.lpad(cents.cast("string"), 11, "0"))
    table(spark, folder, "customer").select(
        F.concat(F.lpad(F.col("c_custkey").cast("string"), 8, "0"), digits).alias("value")).write.text(path)
    data = read_fixed(spark, path, [
        {"name": "CUST-ID", "length": 8},
        {"name": "BALANCE", "type": "decimal", "precision": 2, "length": 11}]).data
    return data.select(F.col("CUST_ID").cast("bigint").alias("CUST_ID"), "BALANCE")


@query("fixed_offset_shift", _ORDERS)
def fixed_offset_shift(spark, folder):
    path = new_folder(spark, "offset")
    _plain_lines(spark, folder).select("value").write.text(path)
    absolute = [{**f, "start": f["start"] + 120} for f in fixtures.ORDER_FIELDS]
    return _parsed(read_fixed(spark, path, absolute).data)


@query("fixed_width_profile", """
    SELECT count(CASE WHEN o_orderkey % 4 = 0 THEN 1 END) AS too_wide,
           count(CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 7 = 0 THEN 1 END) AS too_short,
           count(*) AS records FROM orders""")
def fixed_width_profile(spark, folder):
    path = new_folder(spark, "widths")
    key = F.col("key")
    odd = F.when(key % 4 == 0, F.concat("value", F.lit("+"))).when(
        key % 7 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    _plain_lines(spark, folder).select(odd.alias("value")).write.text(path)
    data = split_envelope(read_lines(spark, path), unit="directory").data
    return width_profile(data, 39).drop("feed")


@query("fixed_write", """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, ' ') || rpad(o_orderstatus, 2, ' ') ||
           lpad(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR), 12, '0') ||
           rpad(o_orderpriority, 15, ' ') || ' ' AS value FROM orders""")
def fixed_write(spark, folder):
    return fixed_sink.to_lines(fixtures.orders(spark, folder), fixtures.ORDER_LAYOUT)


@query("fixed_write_justified", """
    SELECT lpad(c_name, 24, ' ') || '  ' ||
           CASE WHEN c_acctbal < 0
                THEN '-' || lpad(CAST(-CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR), 10, '0')
                ELSE lpad(CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR), 11, '0')
           END || rpad(coalesce(substr(nullif(c_mktsegment, 'BUILDING'), 1, 4), ''), 4, ' ') ||
           repeat(' ', 6) AS value FROM customer""")
def fixed_write_justified(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("NAME"), F.col("c_acctbal").alias("BALANCE"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("SEGMENT"))
    return fixed_sink.to_lines(customers, Layout.of([
        {"name": "NAME", "length": 24, "just_right": True},
        {"name": "BALANCE", "type": "decimal", "precision": 2, "start": 27, "length": 11},
        {"name": "SEGMENT", "length": 4}, {"name": "ABSENT", "length": 6}]))


@query("fixed_roundtrip", _ORDERS)
def fixed_roundtrip(spark, folder):
    path = new_folder(spark, "fixed")
    fixed_sink.write_fixed(fixtures.orders(spark, folder), fixtures.ORDER_LAYOUT, path)
    return _parsed(read_fixed(spark, path, fixtures.ORDER_LAYOUT).data)


@query("fixed_positional", _ORDERS)
def fixed_positional(spark, folder):
    path = new_folder(spark, "positional")
    other = fixtures.orders(spark, folder).select(*_COLUMNS).toDF("A", "B", "C", "D")
    fixed_sink.write_fixed(other, fixtures.ORDER_LAYOUT, path)
    return _parsed(read_fixed(spark, path, fixtures.ORDER_LAYOUT).data)


# ---- envelopes and positions ---------------------------------------------------------

def _order_feed(spark, folder):
    return read_fixed(
        spark, fixtures.order_feeds(spark, folder), fixtures.ORDER_LAYOUT, 1, 1,
        fixtures.ORDER_HEADER, fixtures.ORDER_TRAILER, unit="directory")


@query("feed_read", """
    SELECT year(o_orderdate)::INTEGER AS order_year, o_orderkey AS ORDER_KEY, o_orderstatus AS STATUS,
           CAST(o_totalprice AS DECIMAL(18,2)) AS AMOUNT, o_orderpriority AS PRIORITY FROM orders""")
def feed_read(spark, folder):
    data = _order_feed(spark, folder).data
    return data.select(fixtures.feed_year().alias("order_year"),
                       F.col("ORDER_KEY").cast("bigint").alias("ORDER_KEY"),
                       "STATUS", "AMOUNT", "PRIORITY")


@query("feed_header_fields", """
    SELECT year(o_orderdate)::INTEGER AS order_year, 'HDR' AS REC_ID,
           strftime(max(o_orderdate), '%Y%m%d') AS FILE_DATE FROM orders GROUP BY 1""")
def feed_header_fields(spark, folder):
    header = last_per_feed(_order_feed(spark, folder).header)
    return header.select(fixtures.feed_year().alias("order_year"), "REC_ID", "FILE_DATE")


@query("feed_trailer_fields", """
    SELECT year(o_orderdate)::INTEGER AS order_year, 'TRL' AS REC_ID,
           lpad(CAST(count(*) + 2 AS VARCHAR), 10, '0') AS RECORD_COUNT,
           count(*) + 1 AS line_no FROM orders GROUP BY 1""")
def feed_trailer_fields(spark, folder):
    trailer = _order_feed(spark, folder).trailer
    return trailer.select(fixtures.feed_year().alias("order_year"), "REC_ID", "RECORD_COUNT", "line_no")


@query("feed_record_position", """
    SELECT o_orderkey AS ORDER_KEY, year(o_orderdate)::INTEGER AS order_year,
           row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS line_no
    FROM orders""")
def feed_record_position(spark, folder):
    lines = with_positions(read_lines(spark, fixtures.order_feeds(spark, folder)), "directory")
    inner = lines.filter((F.col("line_no") > 0) & (F.col("line_no") < F.col("feed_lines") - 1))
    return inner.select(F.trim(F.substring("value", 1, 10)).cast("bigint").alias("ORDER_KEY"),
                        fixtures.feed_year().alias("order_year"), "line_no")


@query("fixed_double_roundtrip", """
    SELECT o_orderkey * 1000000 AS ORDER_KEY, CAST(o_totalprice AS DECIMAL(18,2)) AS AMOUNT, o_custkey::DOUBLE AS CUSTOMER FROM orders""")
def fixed_double_roundtrip(spark, folder):
    """Floating-point numbers in whole, decimal and plain fields come back as they were."""
    path = new_folder(spark, "doubles")
    layout = Layout.of([{"name": "ORDER-KEY", "type": "long", "length": 14}, {"name": "AMOUNT", "type": "decimal", "precision": 2, "length": 12},
                        {"name": "CUSTOMER", "type": "double", "length": 16}])
    orders = table(spark, folder, "orders").select(
        (F.col("o_orderkey") * F.lit(1e6)).alias("ORDER_KEY"), F.col("o_totalprice").alias("AMOUNT"), F.col("o_custkey").cast("double").alias("CUSTOMER"))
    fixed_sink.write_fixed(orders, layout, path)
    return read_fixed(spark, path, layout).data.select(
        F.col("ORDER_KEY").try_cast("bigint").alias("ORDER_KEY"), "AMOUNT", F.col("CUSTOMER").try_cast("double").alias("CUSTOMER"))


@query("feed_wide_trailer", """
    SELECT strftime(max(o_orderdate), '%Y%m%d') AS FILE_DATE, lpad(CAST(sum(o_orderkey)::BIGINT AS VARCHAR), 18, ' ') AS line_total,
           CAST(sum(o_orderkey) AS BIGINT) AS TOTAL, count(*) AS records FROM orders""")
def feed_wide_trailer(spark, folder):
    """Header and trailer may be wider than the data, and no total is cut."""
    path = new_folder(spark, "wide")
    header = [{"name": "REC-ID", "length": 3, "expression": "'HDR'"},
              {"name": "FILE-DATE", "length": 8, "expression": "date_format(max(FILE_DAY), 'yyyyMMdd')"}]
    trailer = [{"name": "REC-ID", "length": 3, "expression": "'TRL'"}, {"name": "TOTAL", "type": "long", "length": 18, "expression": "sum(ORDER_KEY)"}]
    fields = [{"name": "ORDER-KEY", "type": "long", "length": 9}]
    fixed_sink.write_fixed(fixtures.orders(spark, folder), fields, path, 1, 1, header, trailer)
    feed = read_fixed(spark, path, fields, 1, 1, header, [{"name": "LINE", "start": 4, "length": 18}, {"name": "TOTAL", "start": 4, "length": 18}])
    counted = feed.data.groupBy("feed").agg(F.count(F.lit(1)).alias("records"))
    return counted.join(feed.header, "feed").join(feed.trailer, "feed").select(
        "FILE_DATE", F.lpad("LINE", 18, " ").alias("line_total"), F.col("TOTAL").cast("bigint").alias("TOTAL"), "records")


@query("feed_write_enveloped", """
    SELECT (SELECT rpad('HDR' || strftime(max(o_orderdate), '%Y%m%d'), 40, ' ') FROM orders) AS header,
           (SELECT rpad('TRL' || lpad(CAST(count(*) + 2 AS VARCHAR), 10, '0'), 40, ' ') FROM orders) AS trailer,
           count(*) AS records, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders""")
def feed_write_enveloped(spark, folder):
    path = new_folder(spark, "enveloped")
    fixed_sink.write_fixed(
        fixtures.orders(spark, folder), fixtures.ORDER_LAYOUT, path, 1, 1,
        fixtures.ORDER_HEADER, fixtures.ORDER_TRAILER)
    lines = with_positions(read_lines(spark, path), "directory")
    last = F.col("line_no") == F.col("feed_lines") - 1
    first = F.col("line_no") == 0
    digits = F.substring("value", 13, 12).try_cast("bigint")
    inner = ~first & ~last
    return lines.agg(
        F.max(F.when(first, F.col("value"))).alias("header"),
        F.max(F.when(last, F.col("value"))).alias("trailer"),
        F.count_if(inner).alias("records"),
        F.sum(F.when(inner, (digits * F.expr("0.01BD")).cast("decimal(18,2)"))).alias("amount"))


# ---- dated sets, EBCDIC --------------------------------------------------------------

@query("dated_read", """
    SELECT strftime(ts, '%Y%m%d') AS load_date, event_type AS EVENT_TYPE, count(*) AS n
    FROM events GROUP BY 1, 2""")
def dated_read(spark, folder):
    base = fixtures.event_feeds(spark, folder, complete=True)
    feed = read_fixed(spark, f"{base}/DAILY", fixtures.EVENT_FIELDS, 1, 1, unit="directory")
    dated = with_load_date(feed.data, "daily")
    return dated.groupBy("load_date", "EVENT_TYPE").agg(F.count("*").alias("n"))


@query("dated_read_range", """
    SELECT strftime(ts, '%Y%m%d') AS load_date, event_type AS EVENT_TYPE, count(*) AS n
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY 1, 2""")
def dated_read_range(spark, folder):
    """Only the directories of the wanted days are listed and read."""
    base = fixtures.event_feeds(spark, folder, complete=True)
    days = days_between(dt.date(2024, 1, 5), dt.date(2024, 1, 12))
    feed = read_dated(spark, base, "daily", days, fixtures.EVENT_FIELDS, header_count=1, trailer_count=1)
    return feed.data.groupBy("load_date", "EVENT_TYPE").agg(F.count("*").alias("n"))


@query("dated_path_expressions", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS loaded,
           strftime(o_orderdate - INTERVAL 3 DAY, '%Y%m%d') AS earlier,
           strftime(o_orderdate, '%m-%d-%Y') AS formatted,
           strftime(last_day(o_orderdate), '%Y%m%d') AS month_end, 'STATIC' AS literal FROM orders""")
def dated_path_expressions(spark, folder):
    day = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", path_date("load_date()", day).alias("loaded"),
        path_date("date_sub(current_date(), 3)", day).alias("earlier"),
        path_date("date_format(current_date(), 'MM-dd-yyyy')", day).alias("formatted"),
        path_date("last_day(current_date())", day).alias("month_end"),
        path_date("STATIC", day).alias("literal"))


@query("date_pattern_normalise", """
    SELECT event_id, strftime(ts, '%Y%m%d') AS a, strftime(ts, '%d/%m/%y') AS b,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS c FROM events""")
def date_pattern_normalise(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", *[F.date_format("ts", spark_pattern(p)).alias(name) for name, p in
                      (("a", "YYYYMMDD"), ("b", "DD/MM/YY"), ("c", "YYYY-MM-DD HH:mm:SS"))])


@query("ebcdic_read", """
    SELECT c_custkey AS CUST_ID, c_name AS NAME,
           CAST(c_acctbal AS DECIMAL(31,2)) AS BALANCE FROM customer""")
def ebcdic_read(spark, folder):
    path = new_folder(spark, "ebcdic")
    # 38 bytes a record. The last is a blank filler, written as the line separator.
    record = table(spark, folder, "customer").select(
        F.concat(pack_decimal(F.col("c_custkey"), 6),
                 encode_text(F.rpad("c_name", 24, " ")),
                 pack_decimal(F.col("c_acctbal"), 7, 2)).cast("string").alias("value"))
    record.write.option("lineSep", "\x40").text(path)
    data = read_ebcdic(spark, path, [
        {"name": "CUST-ID", "type": "packed", "length": 6},
        {"name": "NAME", "length": 24},
        {"name": "BALANCE", "type": "packed", "precision": 2, "length": 7},
        {"name": "FILLER", "length": 1}])
    return data.select(F.col("CUST_ID").cast("bigint").alias("CUST_ID"), "NAME", "BALANCE")


@query("ebcdic_framed_read", """
    SELECT c_nationkey AS nation, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS record_id,
           c_custkey AS CUST_ID, c_name AS NAME, CAST(c_acctbal AS DECIMAL(31,2)) AS BALANCE FROM customer""")
def ebcdic_framed_read(spark, folder):
    """A file a nation, with 19 bytes before and after its records of 38 bytes."""
    path = new_folder(spark, "framed")
    customers = table(spark, folder, "customer")
    record = F.concat(pack_decimal(F.col("c_custkey"), 6), encode_text(F.rpad("c_name", 24, " ")),
                      pack_decimal(F.col("c_acctbal"), 7, 2)).cast("string")
    nations = customers.select("c_nationkey").distinct()
    frame = F.explode(F.array(F.lit(0), F.lit(2))).alias("section")
    rows = customers.select("c_nationkey", F.lit(1).alias("section"), "c_custkey", record.alias("value")).unionByName(
        nations.select("c_nationkey", frame).select("c_nationkey", "section", F.lit(None).cast("bigint").alias("c_custkey"), F.lit("f" * 18).alias("value")))
    (rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "section", "c_custkey").select("c_nationkey", "value")
     .write.partitionBy("c_nationkey").option("lineSep", "\x40").text(path))
    records = read_framed_records(spark, path, 38, 19, 19)
    data = parse_records(records, [
        {"name": "CUST-ID", "type": "packed", "length": 6}, {"name": "NAME", "length": 24},
        {"name": "BALANCE", "type": "packed", "precision": 2, "length": 7}], record_id=True)
    nation = F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("int").alias("nation")
    return data.select(nation, "record_id", F.col("CUST_ID").cast("bigint").alias("CUST_ID"), "NAME", "BALANCE")


# ---- sinks ---------------------------------------------------------------------------

@query("sink_parquet_roundtrip", _ORDERS)
def sink_parquet_roundtrip(spark, folder):
    path = new_folder(spark, "parquet")
    sinks.write_parquet(fixtures.orders(spark, folder).select(*_COLUMNS), path, "OVERWRITE")
    return read_parquet(spark, path)


@query("sink_append", _ORDERS + " UNION ALL " + _ORDERS)
def sink_append(spark, folder):
    path = new_folder(spark, "append")
    orders = fixtures.orders(spark, folder).select(*_COLUMNS)
    sinks.write_parquet(orders, path, "OVERWRITE")
    sinks.write_parquet(orders, path, "APPEND")
    return read_parquet(spark, path)


@query("sink_csv_roundtrip", _CSV_SQL)
def sink_csv_roundtrip(spark, folder):
    path = new_folder(spark, "sink-csv")
    sinks.write_delimited(_csv_orders(spark, folder), path, ";")
    return _day_text(read_delimited(spark, path, _CSV_FIELDS, ";"))


@query("sink_csv_enveloped", """
    SELECT n AS line_no, line FROM (VALUES (0, '|||'), (1, '|||'), (2, 'ORDER-KEY|STATUS|AMOUNT|PRIORITY')) t(n, line)
    UNION ALL SELECT count(*) + 3, '|||' FROM orders
    UNION ALL SELECT -1, o_orderkey || '|' || o_orderstatus || '|' || CAST(o_totalprice AS DECIMAL(18,2)) || '|' || o_orderpriority
    FROM orders""")
def sink_csv_enveloped(spark, folder):
    path = new_folder(spark, "sink-enveloped")
    orders = _csv_orders(spark, folder).drop("ORDER-DAY")
    sinks.write_delimited_enveloped(orders, path, "|", 2, 1)
    lines = with_positions(read_lines(spark, path), "directory")
    ends = (F.col("line_no") < 3) | (F.col("line_no") == F.col("feed_lines") - 1)
    # Lines of the table have no number of their own: only the ends have a fixed place.
    return lines.select(F.when(ends, F.col("line_no")).otherwise(-1).alias("line_no"), F.col("value").alias("line"))


@query("sink_quoted_export", """
    SELECT '"' || o_orderkey || '","' || o_orderstatus || '","' || o_orderpriority || '"' AS value FROM orders""")
def sink_quoted_export(spark, folder):
    path = new_folder(spark, "quoted")
    sinks.write_quoted(table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return spark.read.text(path)


@query("sink_dated_roundtrip", """
    SELECT o_orderkey AS ORDER_KEY, o_orderstatus AS STATUS, '20260227' AS load_date FROM orders""")
def sink_dated_roundtrip(spark, folder):
    base = new_folder(spark, "dated")
    path = dated_path(spark, base, "daily", dt.date(2026, 2, 28), "date_sub(current_date(), 1)",
                      "ORDERS.DAT")
    fields = fixtures.ORDER_FIELDS[:2]
    fixed_sink.write_fixed(fixtures.orders(spark, folder), fields, path)
    data = with_load_date(read_fixed(spark, base, fields).data, "daily")
    return data.select(F.col("ORDER_KEY").cast("bigint").alias("ORDER_KEY"), "STATUS", "load_date")


@query("sink_control_file", """
    SELECT 'plain' AS kind, CAST(count(*) AS VARCHAR) AS value FROM orders
    UNION ALL SELECT 'record', rpad('', 8, ' ') || lpad(CAST(count(*) AS VARCHAR), 12, ' ') FROM orders""")
def sink_control_file(spark, folder):
    plain, record = new_folder(spark, "count"), new_folder(spark, "record")
    orders = table(spark, folder, "orders")
    sinks.write_control_file(orders, plain)
    sinks.write_count_record(orders, record, [
        {"name": "FEED", "length": 8}, {"name": "REC-CNT", "type": "long", "length": 12}])
    return spark.read.text(plain).select(F.lit("plain").alias("kind"), "value").union(
        spark.read.text(record).select(F.lit("record"), "value"))


@query("output_columns", 'SELECT c_custkey AS "CUST-ID", c_name AS "CUST-NAME" FROM customer')
def output_columns(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("CUST_NAME"), F.col("c_custkey").alias("CUST_ID"), "c_nationkey")
    return sinks.output_columns(customers, None, [{"name": "CUST-ID", "type": "long"},
                                                  {"name": "CUST-NAME"}])


@query("output_suffix_alias", """
    SELECT c_custkey AS OUT_CUST_ID, c_name AS OUT_NAME, c_nationkey AS NATION_KEY FROM customer""")
def output_suffix_alias(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("INP_CUST_ID"), F.col("c_name").alias("NAME"),
        F.col("c_nationkey").alias("NATION-KEY"))
    return sinks.output_columns(customers, ["OUT-CUST-ID", "OUT-NAME", "NATION-KEY", "NO-SUCH"])


_TYPES = [
    ("L_ORDERKEY", "bigint", "INTEGER EXTERNAL"), ("L_LINENUMBER", "int", "INTEGER EXTERNAL"),
    ("L_QUANTITY", "double", "DECIMAL EXTERNAL"), ("L_RETURNFLAG", "string", "CHAR"),
    ("PRICE", "decimal(18,2)", "DECIMAL EXTERNAL"), ("SHIPPED", "date", 'DATE "YYYY-MM-DD"'),
]


@query("jdbc_column_types", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{s}' AS spark_type, '{d}' AS loader_type, "
    f"count({'nullif(l_returnflag, $$R$$)' if c == 'L_RETURNFLAG' else '*'}) AS values_to_load FROM lineitem"
    for i, (c, s, d) in enumerate(_TYPES)))
def jdbc_column_types(spark, folder):
    return column_types(table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.to_date("l_shipdate").alias("shipped")))


# ---- whole flows ---------------------------------------------------------------------

_ORDER_ROWS = """SELECT o_orderkey AS ORDER_KEY, o_orderstatus AS STATUS,
    CAST(o_totalprice AS DECIMAL(18,2)) AS AMOUNT FROM orders"""
_PLAIN = [{"name": "ORDER-KEY", "type": "long", "length": 12}, {"name": "STATUS", "length": 2},
          {"name": "AMOUNT", "type": "decimal", "precision": 2, "length": 14}]


def _order_rows(spark, folder):
    return fixtures.orders(spark, folder).select("ORDER_KEY", "STATUS", "AMOUNT")


def _typed_rows(df):
    return df.select(F.col("ORDER_KEY").cast("bigint").alias("ORDER_KEY"), "STATUS",
                     F.col("AMOUNT").cast("decimal(18,2)").alias("AMOUNT"))


@query("feed_default_unit", _ORDER_ROWS)
def feed_default_unit(spark, folder):
    """Written as many part files, read back as the one feed they are."""
    path = new_folder(spark, "parts")
    fixed_sink.write_fixed(_order_rows(spark, folder).repartition(4, "ORDER_KEY"), _PLAIN, path, 1, 1)
    return _typed_rows(read_fixed(spark, path, _PLAIN, 1, 1).data)


@query("fixed_append", f"{_ORDER_ROWS} UNION ALL {_ORDER_ROWS}")
def fixed_append(spark, folder):
    path = new_folder(spark, "grown")
    for mode in ("overwrite", "append"):
        fixed_sink.write_fixed(_order_rows(spark, folder), _PLAIN, path, mode=mode)
    return _typed_rows(read_fixed(spark, path, _PLAIN).data)


@query("scan_csv_mixed", """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS CODE, CAST(o_totalprice AS DECIMAL(18,2)) AS AMOUNT,
           o_custkey AS CUSTOMER FROM orders""")
def scan_csv_mixed(spark, folder):
    """Leading zeros and exact decimals of declared columns beside an undeclared one."""
    path = new_folder(spark, "mixed")
    table(spark, folder, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("CODE"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("AMOUNT"), F.col("o_custkey").alias("CUSTOMER"),
    ).write.option("header", True).csv(path)
    df = read_delimited(spark, path, [{"name": "CODE"}, {"name": "AMOUNT", "type": "decimal", "precision": 2}])
    return df.withColumn("CUSTOMER", F.col("CUSTOMER").cast("bigint"))


@query("sink_dated_range", """
    SELECT strftime(ts, '%Y%m%d') AS load_date, event_type AS EVENT_TYPE,
           count(*) * CASE WHEN CAST(ts AS DATE) = DATE '2024-01-09' THEN 2 ELSE 1 END AS n
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-10' GROUP BY 1, 2, CAST(ts AS DATE)""")
def sink_dated_range(spark, folder):
    """Three days in one write; rewriting one of them leaves the others."""
    base = new_folder(spark, "days")
    events = fixtures.events(spark, folder)
    days = events.filter(F.col("load_date").between("20240108", "20240110"))
    day = F.to_date("load_date", "yyyyMMdd")
    sinks.write_days(days, day, base, "daily")
    again = days.filter("load_date = '20240109'")
    # The day comes again with every row twice.
    sinks.write_days(again.unionAll(again), day, base, "daily")
    return spark.read.parquet(f"{base}/DAILY").groupBy(F.col("load_date").cast("string").alias("load_date"), "EVENT_TYPE").agg(F.count(F.lit(1)).alias("n"))


# ---- whole flows: feeds in and out --------------------------------------------------

def _copy_flow(spark, folder, output, fields=_PLAIN):
    """Orders written as a feed by one flow; the feed's path."""
    source, target = new_folder(spark, "flow-in"), new_folder(spark, "flow-out")
    _order_rows(spark, folder).repartition(3, "ORDER_KEY").write.parquet(source)
    run_flow(spark, {
        "Inputs": {"ORDERS": {"path": source}},
        "Transformations": {"steps": [{"id": "all", "type": "filter", "source_inputs": ["ORDERS"], "logic": {
            "conditions": [{"field": "ORDER-KEY", "operation": ">=", "value": 0}]}}]},
        "Outputs": {"OUT": {"format": "fixed", "path": target, "source_inputs": ["all"], "fields": fields,
                            "header_count": 1, "trailer_count": 1, **output}}})
    return target


@query("flow_feed_roundtrip", _ORDER_ROWS)
def flow_feed_roundtrip(spark, folder):
    target = new_folder(spark, "flow-back")
    run_flow(spark, {
        "Inputs": {"FEED": {"format": "fixed", "path": _copy_flow(spark, folder, {}), "fields": _PLAIN,
                            "header_count": 1, "trailer_count": 1}},
        "Transformations": {"steps": [{"id": "all", "type": "filter", "source_inputs": ["FEED"], "logic": {
            "conditions": [{"field": "ORDER-KEY", "operation": "!=", "value": ""}]}}]},
        "Outputs": {"OUT": {"path": target, "source_inputs": ["all"]}}})
    return _typed_rows(read_parquet(spark, target))


@query("flow_fixed_output_columns", """
    SELECT CAST(NULL AS BIGINT) AS ORDER_KEY, o_orderstatus AS STATUS, CAST(o_totalprice AS DECIMAL(18,2)) AS AMOUNT
    FROM orders""")
def flow_fixed_output_columns(spark, folder):
    """A column that the output does not list stays blank."""
    path = _copy_flow(spark, folder, {"output_columns": ["STATUS", "AMOUNT"]})
    feed = read_fixed(spark, path, _PLAIN, 1, 1).data
    return _typed_rows(feed.withColumn("ORDER_KEY", F.nullif("ORDER_KEY", F.lit(""))))


@query("flow_fixed_suffix_alias", _ORDER_ROWS)
def flow_fixed_suffix_alias(spark, folder):
    """Output names are served by columns that end like them."""
    fields = [{**f, "name": f"OUT-{f['name']}"} for f in _PLAIN]
    return _typed_rows(read_fixed(spark, _copy_flow(spark, folder, {}, fields), _PLAIN, 1, 1).data)


@query("flow_feed_to_table", """
    SELECT o_orderpriority AS PRIORITY, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS TOTAL, count(*) AS N
    FROM orders WHERE o_orderstatus IN ('O', 'F') AND CAST(o_totalprice AS DECIMAL(18,2)) > 1000
    GROUP BY 1""")
def flow_feed_to_table(spark, folder):
    target = new_folder(spark, "flow")
    run_flow(spark, {
        "Inputs": {"ORDERS": {
            "format": "fixed", "path": fixtures.order_feeds(spark, folder), "unit": "directory",
            "fields": fixtures.ORDER_FIELDS, "record_length": 40, "header_count": 1, "trailer_count": 1,
            "trailer_fields": fixtures.ORDER_TRAILER}},
        "Transformations": {"steps": [
            {"id": "checked", "type": "validate", "source_inputs": ["ORDERS"], "logic": {
                "fail_mode": "DROP", "record_count_check": True, "record_count_trailer_field": "RECORD-COUNT",
                "header_count": 1, "trailer_count": 1, "rules": [
                    {"field": "STATUS", "check": "in_list", "params": {"values": ["O", "F"]}}]}},
            {"id": "large", "type": "filter", "source_inputs": ["checked"], "logic": {
                "conditions": [{"field": "AMOUNT", "operation": ">", "value": 1000}]}},
            {"id": "totals", "type": "aggregate", "source_inputs": ["large"], "logic": {
                "group_by": ["PRIORITY"], "aggregations": [
                    {"field": "AMOUNT", "operation": "sum", "alias": "TOTAL"},
                    {"field": "*", "operation": "count", "alias": "N"}]}}]},
        "Outputs": {"REPORT": {"format": "parquet", "path": target, "source_inputs": ["totals"]}}})
    return read_parquet(spark, target)


@query("flow_previous_day_check", """
    SELECT event_type AS EVENT_TYPE, count(*) AS n FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09' GROUP BY 1""")
def flow_previous_day_check(spark, folder):
    """One day's feed, let through because the day before was delivered with its own date."""
    base, target, run = fixtures.event_feeds(spark, folder, complete=True), new_folder(spark, "checked"), dt.date(2024, 1, 9)
    run_flow(spark, {
        "Inputs": {"EVENTS": {
            "format": "fixed", "source_path": base, "frequency": "DAILY", "partition_col": "load_date=20240109",
            "fields": fixtures.EVENT_FIELDS, "header_count": 1, "trailer_count": 1,
            "header_fields": fixtures.EVENT_HEADER}},
        "Transformations": {"steps": [
            {"id": "checked", "type": "validate", "source_inputs": ["EVENTS"], "logic": {
                "fail_mode": "DROP", "rules": [{"field": "EVENT-TYPE", "check": "not_null"}], "previous_day_check": True,
                "previous_day_file_path": base, "previous_day_frequency": "DAILY", "partition_column": "load_date=20240108",
                "previous_day_header_field": {"name": "FILE-DATE", "start": 4, "length": 8, "format": "YYYYMMDD"}}},
            {"id": "counts", "type": "aggregate", "source_inputs": ["checked"], "logic": {
                "group_by": ["EVENT-TYPE"], "aggregations": [{"field": "*", "operation": "count", "alias": "n"}]}}]},
        "Outputs": {"OUT": {"path": target, "source_inputs": ["counts"]}}}, run)
    return read_parquet(spark, target)


@query("flow_count_file", _ORDER_ROWS)
def flow_count_file(spark, folder):
    """A feed that its count file, a record of its own, agrees with."""
    path, target = new_folder(spark, "counted"), new_folder(spark, "counted-out")
    control = [{"name": "KIND", "length": 3}, {"name": "REC-CNT", "type": "long", "length": 12}]
    rows = _order_rows(spark, folder)
    fixed_sink.write_fixed(rows, _PLAIN, path, 1, 1)
    sinks.write_count_record(rows, f"{path}-count", control)
    run_flow(spark, {
        "Inputs": {"FEED": {"format": "fixed", "path": path, "fields": _PLAIN, "header_count": 1, "trailer_count": 1,
                            "count_file_path": f"{path}-count", "control_fields": control}},
        "Transformations": {"steps": [{"id": "all", "type": "filter", "source_inputs": ["FEED"], "logic": {
            "conditions": [{"field": "ORDER-KEY", "operation": "!=", "value": ""}]}}]},
        "Outputs": {"OUT": {"path": target, "source_inputs": ["all"]}}})
    return _typed_rows(read_parquet(spark, target))


@query("flow_curated_control", """
    SELECT lpad(CAST(count(*) AS VARCHAR), 9, '0') || lpad(CAST(sum(o_custkey) AS VARCHAR), 18, '0') AS value
    FROM orders WHERE o_orderstatus <> 'P'""")
def flow_curated_control(spark, folder):
    """The control file beside a curated output counts the rows of that output."""
    base, fields = new_folder(spark, "curated"), [
        {"name": "CNT", "type": "INT", "length": 9}, {"name": "KEYS", "type": "LONG", "length": 18, "expression": "sum(o_custkey)"}]
    run_flow(spark, {
        "Inputs": {"ORDERS": {"path": f"{folder}/orders.parquet"}},
        "Transformations": {"steps": [
            {"id": "open", "type": "filter", "source_inputs": ["ORDERS"], "logic": {
                "conditions": [{"field": "o_orderstatus", "operation": "!=", "value": "P"}]}},
            {"id": "control", "type": "ctrl_file", "source_inputs": ["open"], "logic": {
                "path": f"{base}/raw", "ctrl_file_name": "ORDERS.CTL", "ctrl_file_fields": fields}}]},
        "Outputs": {"OUT": {"path": f"{base}/out", "source_inputs": ["control"]}}})
    return spark.read.text(f"{base}/ORDERS.CTL")


@query("flow_missing_input", f"""
    SELECT 'feedmill.days.D' || d || '.input_file_missing' AS finding, NULL::BIGINT AS n
    FROM (SELECT unnest([{", ".join(f"'{d}'" for d in fixtures.DECLARED_DAYS)}]) AS d)
    WHERE d NOT IN (SELECT strftime(ts, '%Y%m%d') FROM events WHERE strftime(ts, '%Y-%m-%d') NOT IN ({", ".join(f"'{d}'" for d in fixtures.LOST_DAYS)}))
    UNION ALL
    SELECT event_type, count(*) FROM events WHERE strftime(ts, '%Y%m%d') IN ({", ".join(f"'{d}'" for d in fixtures.DECLARED_DAYS)})
      AND strftime(ts, '%Y-%m-%d') NOT IN ({", ".join(f"'{d}'" for d in fixtures.LOST_DAYS)}) GROUP BY 1""")
def flow_missing_input(spark, folder):
    """Days that were not delivered stop a flow with an alert each, or stand as empty inputs."""
    base, target, found = fixtures.event_feeds(spark, folder), new_folder(spark, "days"), new_folder(spark, "alerts")
    day_input = {"format": "fixed", "unit": "directory", "fields": fixtures.EVENT_FIELDS, "header_count": 1, "trailer_count": 1}
    inputs = {f"D{d}": day_input | {"path": f"{base}/DAILY/load_date={d}"} for d in fixtures.DECLARED_DAYS}
    flow = {
        "name": "days", "alerts_path": found, "Inputs": inputs,
        "Transformations": {"steps": [
            {"id": "all", "type": "union", "source_inputs": list(inputs), "logic": {}},
            {"id": "counts", "type": "aggregate", "source_inputs": ["all"], "logic": {
                "group_by": ["EVENT-TYPE"], "aggregations": [{"field": "*", "operation": "count", "alias": "n"}]}}]},
        "Outputs": {"OUT": {"path": target, "source_inputs": ["counts"]}}}
    try:
        run_flow(spark, flow)
    except MissingInput:
        # The alerts tell which; now the same inputs may be empty.
        run_flow(spark, flow | {"Inputs": {k: i | {"if_missing": "empty"} for k, i in inputs.items()}})
    alerts = spark.read.parquet(found).select(F.col("alert_key").alias("finding"), F.lit(None).cast("bigint").alias("n"))
    return alerts.unionByName(read_parquet(spark, target).withColumnRenamed("EVENT_TYPE", "finding"))
