"""Queries over row validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedmill.fields import Layout
from feedmill.operators import validate as v
from feedmill.plans.fixtures import DIRTY_SQL, dirty_customers
from feedmill.plans.registry import query, table
from feedmill.plans.steps import run_step
from feedmill.session import new_folder


def _rules_sql(name: str, *cases: tuple[str, str], source: str = DIRTY_SQL, key: str = "CUST_ID") -> str:
    """SQL of annotated rows: one CASE per rule, in order."""
    texts = ", ".join(f"CASE WHEN {test} THEN '{text}' END" for test, text in cases)
    return f"""SELECT {key}, _validation_errors, length(_validation_errors) = 0 AS _is_valid
        FROM (SELECT {key}, concat_ws('; ', {texts}) AS _validation_errors FROM {source} AS s) AS {name}"""


def _annotated(spark, folder, rules, key="CUST_ID"):
    step = {"id": "v", "type": "validate", "source_inputs": ["in"], "logic": {"rules": rules}}
    return run_step(step, {"in": dirty_customers(spark, folder)})[1].select(
        key, "_validation_errors", "_is_valid")


_NOT_NULL = "''CUST_NAME'' must not be null or empty"
_NUMBER = "''AMOUNT'' is not a valid decimal"
_DATE = "''AS_OF'' is not a valid date (expected: yyyyMMdd)"
_IS_NAME = "CUST_NAME IS NULL OR trim(CUST_NAME) = ''"
_IS_NUMBER = "NOT regexp_full_match(trim(AMOUNT), '[+-]?[0-9]+([.][0-9]+)?')"
_IS_DATE = "AS_OF IS NOT NULL AND try_strptime(AS_OF, '%Y%m%d') IS NULL"
_MAIN = [
    {"field": "CUST-NAME", "nullable": False},
    {"field": "AMOUNT", "data_type": "decimal"},
    {"field": "AS-OF", "data_type": "date", "date_format": "yyyyMMdd"},
]
_MAIN_CASES = ((_IS_NAME, _NOT_NULL), (_IS_NUMBER, _NUMBER), (_IS_DATE, _DATE))
_MARKED = _rules_sql("m", *_MAIN_CASES)


@query("validate_not_null", _rules_sql(
    "r", (_IS_NAME, _NOT_NULL), ("AS_OF IS NULL OR trim(AS_OF) = ''", "''AS_OF'' must not be null or empty")))
def validate_not_null(spark, folder):
    return _annotated(spark, folder, [{"field": "CUST-NAME", "nullable": False},
                                      {"field": "AS_OF", "nullable": False}])


@query("validate_data_type", _rules_sql(
    "r", (_IS_NUMBER, _NUMBER),
    ("trim(CUST_NAME) <> '' AND NOT regexp_full_match(trim(CUST_NAME), '[+-]?[0-9]+')",
     "''CUST_NAME'' is not a valid int")))
def validate_data_type(spark, folder):
    return _annotated(spark, folder, [{"field": "AMOUNT", "data_type": "decimal"},
                                      {"field": "CUST_NAME", "data_type": "int"},
                                      {"field": "CUST_ID", "data_type": "long"},
                                      {"field": "SEGMENT", "data_type": "text"},
                                      {"field": "NO-SUCH", "data_type": "int"}])


@query("validate_date", _rules_sql("r", (_IS_DATE, _DATE)))
def validate_date(spark, folder):
    return _annotated(spark, folder, [{"field": "AS_OF", "data_type": "date"}])


@query("validate_timestamp", """
    SELECT event_id, CASE WHEN event_id % 6 = 0
        THEN '''STAMP'' is not a valid timestamp (expected: yyyyMMdd HH:mm:ss)' ELSE '' END AS _validation_errors,
        event_id % 6 <> 0 AS _is_valid FROM events""")
def validate_timestamp(spark, folder):
    stamp = F.date_format("ts", "yyyyMMdd HH:mm:ss")
    late = F.concat(F.date_format("ts", "yyyyMMdd"), F.lit(" 25:61:00"))
    events = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 6 == 0, late).otherwise(stamp).alias("STAMP"))
    return v.annotate(events, [{"field": "STAMP", "data_type": "timestamp"}]).drop("STAMP")


@query("validate_max_length", _rules_sql(
    "r", ("length(SEGMENT) > 8", "''SEGMENT'' exceeds max length 8"),
    ("length(CAST(CUST_ID AS VARCHAR)) > 3", "''CUST_ID'' exceeds max length 3")))
def validate_max_length(spark, folder):
    return _annotated(spark, folder, [{"field": "SEGMENT", "max_length": 8},
                                      {"field": "CUST_ID", "max_length": "3"}])


@query("validate_formats", _rules_sql(
    "r", ("NOT regexp_matches(SEGMENT, '^[A-Za-z\\s]+$')", "''SEGMENT'' is not a valid alpha value"),
    ("NOT regexp_matches(AMOUNT, '^\\d+(\\.\\d+)?$')", "''AMOUNT'' is not a valid numeric value"),
    ("NOT regexp_matches(CUST_NAME, '^[A-Za-z0-9\\s]+$')", "''CUST_NAME'' is not a valid alphanumeric value"),
    ("NOT regexp_matches(EMAIL, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$')", "''EMAIL'' is not a valid email value")))
def validate_formats(spark, folder):
    return _annotated(spark, folder, [
        {"field": "SEGMENT", "format": "ALPHA"}, {"field": "AMOUNT", "format": "numeric"},
        {"field": "CUST_NAME", "format": "alphanumeric"}, {"field": "EMAIL", "format": "email"}])


@query("validate_format_date", _rules_sql(
    "r", (_IS_DATE, "''AS_OF'' does not match date format ''YYYYMMDD''")))
def validate_format_date(spark, folder):
    return _annotated(spark, folder, [{"field": "AS_OF", "format": "date", "pattern": "YYYYMMDD"}])


@query("validate_regex", _rules_sql(
    "r", ("NOT regexp_matches(EMAIL, '[0-9]@ex')", "''EMAIL'' does not match pattern ''[0-9]@ex''"),
    ("NOT regexp_matches(SEGMENT, '^B')", "''SEGMENT'' does not match pattern ''^B''")))
def validate_regex(spark, folder):
    return _annotated(spark, folder, [
        {"field": "EMAIL", "format": "regex", "pattern": "[0-9]@ex"},
        {"field": "SEGMENT", "check": "regex", "params": {"pattern": "^B"}}])


@query("validate_in_range", _rules_sql(
    "r", ("try_cast(AMOUNT AS DOUBLE) IS NULL OR try_cast(AMOUNT AS DOUBLE) < 0 OR try_cast(AMOUNT AS DOUBLE) > 5000",
          "''AMOUNT'' is not between 0 and 5000"),
    ("NATION > 20", "''NATION'' is not between None and 20")))
def validate_in_range(spark, folder):
    return _annotated(spark, folder, [
        {"field": "AMOUNT", "check": "in_range", "params": {"min": 0, "max": 5000}},
        {"field": "NATION", "check": "in_range", "params": {"max": 20}}])


@query("validate_in_list", _rules_sql(
    "r", ("SEGMENT NOT IN ('BUILDING', 'MACHINERY')", "''SEGMENT'' is not one of BUILDING, MACHINERY"),
    ("length(CUST_NAME) < 5", "''CUST_NAME'' is below min length 5"),
    ("AS_OF IS NULL", "''AS_OF'' must not be null or empty")))
def validate_in_list(spark, folder):
    return _annotated(spark, folder, [
        {"field": "SEGMENT", "check": "in_list", "params": {"values": ["BUILDING", "MACHINERY"]}},
        {"field": "CUST_NAME", "check": "length", "params": {"min": 5, "max": 40}},
        {"field": "AS_OF", "check": "not_null"}])


@query("validate_flag", _MARKED)
def validate_flag(spark, folder):
    return _annotated(spark, folder, _MAIN)


@query("validate_drop", f"SELECT CUST_ID, CUST_NAME, AMOUNT, SEGMENT FROM ({_MARKED}) JOIN {DIRTY_SQL} d USING (CUST_ID) WHERE _is_valid")
def validate_drop(spark, folder):
    step = {"id": "v", "type": "validate", "source_inputs": ["in"],
            "logic": {"rules": _MAIN, "mode": "DROP"}}
    return run_step(step, {"in": dirty_customers(spark, folder)})[1].select(
        "CUST_ID", "CUST_NAME", "AMOUNT", "SEGMENT")


@query("validate_rejects", f"SELECT CUST_ID, _validation_errors, _is_valid FROM ({_MARKED}) WHERE NOT _is_valid")
def validate_rejects(spark, folder):
    return v.rejected(dirty_customers(spark, folder), _MAIN).select(
        "CUST_ID", "_validation_errors", "_is_valid")


@query("validate_summary", f"""
    SELECT count(*) AS total_rows, count(CASE WHEN _is_valid THEN 1 END) AS valid_rows,
           count(CASE WHEN NOT _is_valid THEN 1 END) AS invalid_rows FROM ({_MARKED})""")
def validate_summary(spark, folder):
    return v.summary(dirty_customers(spark, folder), _MAIN)


@query("validate_error_counts", f"""
    SELECT error, count(*) AS failures FROM (
        SELECT '{_NOT_NULL}' AS error FROM {DIRTY_SQL} a WHERE {_IS_NAME}
        UNION ALL SELECT '{_NUMBER}' FROM {DIRTY_SQL} b WHERE {_IS_NUMBER}
        UNION ALL SELECT '{_DATE}' FROM {DIRTY_SQL} c WHERE {_IS_DATE}) GROUP BY 1""")
def validate_error_counts(spark, folder):
    return v.error_counts(dirty_customers(spark, folder), _MAIN)


@query("validate_split_roundtrip", f"""
    SELECT CUST_ID, CASE WHEN _is_valid THEN 'accepted' ELSE 'rejected' END AS outcome,
           _validation_errors FROM ({_MARKED})""")
def validate_split_roundtrip(spark, folder):
    path = new_folder(spark, "split")
    v.write_split(dirty_customers(spark, folder), _MAIN, path)
    return spark.read.parquet(path).select("CUST_ID", "outcome", "_validation_errors")


_SPLIT_LAYOUT = [
    {"name": "CUST-ID", "type": "long", "length": 10}, {"name": "CUST-NAME", "length": 20},
    {"name": "AMOUNT", "type": "number", "length": 12}, {"name": "AS-OF", "length": 8}]


@query("validate_split_fixed", f"""
    SELECT CASE WHEN _is_valid THEN 'accepted' ELSE 'rejected' END AS outcome,
           lpad(CAST(CUST_ID AS VARCHAR), 10, ' ') || rpad(CUST_NAME, 20, ' ') || lpad(AMOUNT, 12, ' ') ||
           rpad(coalesce(AS_OF, ''), 8, ' ') AS value
    FROM ({_MARKED}) JOIN {DIRTY_SQL} d USING (CUST_ID)""")
def validate_split_fixed(spark, folder):
    path = new_folder(spark, "split-fixed")
    v.write_split(dirty_customers(spark, folder), _MAIN, path, Layout.of(_SPLIT_LAYOUT))
    return spark.read.text(path).select("outcome", "value")


@query("validate_in_list_numeric", """
    SELECT l_orderkey, l_linenumber,
           l_linenumber IN (1, 2) AS few, l_quantity IN (1, 2.5, 30) AS listed,
           CAST(l_extendedprice AS DECIMAL(18,2)) BETWEEN 1000.10 AND 20000.25 AS priced FROM lineitem""")
def validate_in_list_numeric(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    rules = [
        {"field": "l_linenumber", "check": "in_list", "params": {"values": [1, "2"]}},
        {"field": "l_quantity", "check": "in_list", "params": {"values": [1, 2.5, "30"]}},
        {"field": "price", "check": "in_range", "params": {"min": 1000.10, "max": "20000.25"}}]
    errors = F.col(v.ERRORS)
    return v.annotate(rows, rules).select(
        "l_orderkey", "l_linenumber", (~errors.contains("'l_linenumber'")).alias("few"),
        (~errors.contains("'l_quantity'")).alias("listed"), (~errors.contains("'price'")).alias("priced"))
