"""Queries over filters, verbs, joins, aggregates, unions, sorts and step lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedmill.operators.filters import split_rows
from feedmill.operators.sets import merge_frames
from feedmill.operators.verbs import apply_verbs
from feedmill.plans.registry import query, table
from feedmill.plans.steps import resolve_outputs, row_counts, run_step, run_steps


def _filtered(spark: SparkSession, folder: str, name: str, conditions: list[dict],
              columns: list[str]) -> DataFrame:
    frames = {"in": table(spark, folder, name)}
    steps = [
        {"id": "kept", "type": "filter", "source_inputs": ["in"],
         "logic": {"conditions": conditions}},
        {"id": "out", "type": "select", "source_inputs": ["kept"], "logic": {"columns": columns}},
    ]
    return run_steps(frames, steps)["out"]


# ---- filters -------------------------------------------------------------------------

_ORDER = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
_ORDER_SQL = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE "


@query("filter_and", _ORDER_SQL + "o_totalprice > 100000 AND o_orderstatus = 'F' AND o_custkey <= 900")
def filter_and(spark, folder):
    return _filtered(spark, folder, "orders", [
        {"field": "o_totalprice", "operation": ">", "value": 100000},
        {"field": "o_orderstatus", "operation": "==", "value": "F"},
        {"field": "O_CUSTKEY".lower(), "operation": "le", "value": 900},
    ], _ORDER)


@query("filter_gt", _ORDER_SQL + "o_totalprice > 250000.5")
def filter_gt(spark, folder):
    return _filtered(spark, folder, "orders",
                     [{"field": "o-totalprice", "operation": "greater_than", "value": 250000.5}], _ORDER)


@query("filter_lt", _ORDER_SQL + "o_totalprice < 250000.5")
def filter_lt(spark, folder):
    return _filtered(spark, folder, "orders",
                     [{"field": "o_totalprice", "operation": "lt", "value": 250000.5}], _ORDER)


@query("filter_ge", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_quantity >= 40")
def filter_ge(spark, folder):
    return _filtered(spark, folder, "lineitem",
                     [{"field": "l_quantity", "operation": ">=", "value": 40}],
                     ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("filter_le", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_quantity <= 10")
def filter_le(spark, folder):
    return _filtered(spark, folder, "lineitem",
                     [{"field": "l_quantity", "operation": "less_equal", "value": 10}],
                     ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("filter_ne", _ORDER_SQL + "nullif(o_orderstatus, 'P') <> 'O'")
def filter_ne(spark, folder):
    # Rows without a status must be dropped by a comparison.
    orders = table(spark, folder, "orders")
    frames = {"in": orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))}
    step = {"id": "out", "type": "filter", "source_inputs": ["in"],
            "logic": {"conditions": [{"field": "status", "operation": "not_equals", "value": "O"}]}}
    return run_step(step, frames)[1].select(_ORDER)


@query("filter_eq", _ORDER_SQL + "o_orderpriority = '1-URGENT'")
def filter_eq(spark, folder):
    return _filtered(spark, folder, "orders",
                     [{"field": "o_orderpriority", "operation": "equals", "value": "1-URGENT"}], _ORDER)


@query("filter_in", _ORDER_SQL + "o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('O')")
def filter_in(spark, folder):
    return _filtered(spark, folder, "orders", [
        {"field": "o_orderpriority", "operation": "in", "value": ["1-URGENT", "2-HIGH"]},
        {"field": "o_orderstatus", "operation": "in_list", "value": "O"},
    ], _ORDER)


@query("filter_not_in", _ORDER_SQL + "nullif(o_orderpriority, '5-LOW') NOT IN ('1-URGENT', '2-HIGH')")
def filter_not_in(spark, folder):
    orders = table(spark, folder, "orders")
    frames = {"in": orders.withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))}
    step = {"id": "out", "type": "filter", "source_inputs": ["in"], "logic": {"conditions": [
        {"field": "priority", "operation": "nin", "value": ["1-URGENT", "2-HIGH"]}]}}
    return run_step(step, frames)[1].select(_ORDER)


@query("filter_else_branch", """
    SELECT c_mktsegment, 'listed' AS branch, count(*) AS n FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1
    UNION ALL
    SELECT c_mktsegment, 'else' AS branch, count(*) AS n FROM customer
    WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 1""")
def filter_else_branch(spark, folder):
    customer = table(spark, folder, "customer")
    listed, _ = split_rows(customer, "c_mktsegment", ["BUILDING", "MACHINERY"])
    rest = run_step({"id": "rest", "type": "filter", "source_inputs": ["c"], "logic": {
        "else_branch": True, "field": "c-mktsegment", "value_list": ["BUILDING", "MACHINERY"]}},
        {"c": customer})[1]
    both = listed.withColumn("branch", F.lit("listed")).union(rest.withColumn("branch", F.lit("else")))
    return both.groupBy("c_mktsegment", "branch").agg(F.count("*").alias("n"))


@query("filter_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def filter_contains(spark, folder):
    return _filtered(spark, folder, "part",
                     [{"field": "p_name", "operation": "contains", "value": "ring"}],
                     ["p_partkey", "p_name"])


@query("filter_null_checks", """
    SELECT o_orderstatus, 'null' AS side, count(*) AS n FROM orders
    WHERE nullif(o_orderpriority, '5-LOW') IS NULL GROUP BY 1
    UNION ALL
    SELECT o_orderstatus, 'value' AS side, count(*) AS n FROM orders
    WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL GROUP BY 1""")
def filter_null_checks(spark, folder):
    orders = table(spark, folder, "orders")
    frames = {"in": orders.withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))}
    sides = []
    for side, op in (("null", "is_null"), ("value", "is_not_null")):
        kept = run_step({"id": side, "type": "filter", "source_inputs": ["in"], "logic": {
            "conditions": [{"field": "priority", "operation": op}]}}, frames)[1]
        sides.append(kept.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
                     .select("o_orderstatus", F.lit(side).alias("side"), "n"))
    return sides[0].union(sides[1])


@query("filter_text_number", """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE) >= 3""")
def filter_text_number(spark, folder):
    orders = table(spark, folder, "orders").withColumn("rank", F.substring("o_orderpriority", 1, 1))
    step = {"id": "out", "type": "filter", "source_inputs": ["in"],
            "logic": {"conditions": [{"field": "rank", "operation": ">=", "value": 3}]}}
    return run_step(step, {"in": orders})[1].select("o_orderkey", "o_orderpriority")


# ---- projection and verbs ------------------------------------------------------------

def _verbs(spark: SparkSession, folder: str, name: str, expressions: list[dict],
           columns: list[str]) -> DataFrame:
    frames = {"in": table(spark, folder, name)}
    step = {"id": "out", "type": "select", "source_inputs": ["in"],
            "logic": {"expressions": expressions}}
    return run_step(step, frames)[1].select(columns)


@query("select_columns", "SELECT s_name, s_suppkey, s_nationkey FROM supplier")
def select_columns(spark, folder):
    return run_step({"id": "out", "type": "select", "source_inputs": ["s"], "logic": {
        "columns": ["s-name", "s-suppkey", "s_nationkey"]}},
        {"s": table(spark, folder, "supplier")})[1]


@query("verb_move", """
    SELECT c_custkey, c_name AS CUST_NAME, 16 AS CODE, 'OK' AS STATUS, 'ACTIVE' AS STATE,
           1.5::DOUBLE AS RATE, 'N/A' AS NOTE FROM customer""")
def verb_move(spark, folder):
    return _verbs(spark, folder, "customer", [
        {"target": "CUST-NAME", "operation": "move", "expression": "c-name"},
        {"target": "CODE", "operation": "move", "expression": "16"},
        {"target": "STATUS", "operation": "move", "expression": "OK"},
        {"target": "STATE", "operation": "move", "expression": "'ACTIVE'"},
        {"target": "RATE", "expression": "1.5"},
        {"target": "NOTE", "operation": "move", "literal": True, "value": "N/A"},
    ], ["c_custkey", "CUST_NAME", "CODE", "STATUS", "STATE", "RATE", "NOTE"])


@query("verb_add", """
    SELECT l_orderkey, l_linenumber, l_orderkey + l_suppkey + 7 AS TOTAL,
           l_linenumber + l_partkey AS l_partkey FROM lineitem""")
def verb_add(spark, folder):
    return _verbs(spark, folder, "lineitem", [
        {"target": "TOTAL", "operation": "add", "expression": "TOTAL + l-orderkey + l_suppkey + 7"},
        {"target": "l-partkey", "operation": "add", "expression": "l-partkey + l-linenumber"},
    ], ["l_orderkey", "l_linenumber", "TOTAL", "l_partkey"])


@query("verb_subtract", """
    SELECT l_orderkey, l_linenumber, l_orderkey - l_suppkey AS NET, -l_linenumber AS DOWN,
           l_partkey - 5 AS l_partkey FROM lineitem""")
def verb_subtract(spark, folder):
    return _verbs(spark, folder, "lineitem", [
        {"output_field": "NET", "operation": "SUBTRACT", "operands": ["l_orderkey", "l_suppkey"]},
        {"target": "DOWN", "operation": "subtract", "expression": "l_linenumber"},
        {"target": "l_partkey", "operation": "subtract", "expression": "5"},
    ], ["l_orderkey", "l_linenumber", "NET", "DOWN", "l_partkey"])


@query("verb_multiply", """
    SELECT l_orderkey, l_linenumber, l_linenumber * l_suppkey AS l_suppkey,
           l_orderkey AS FACTOR FROM lineitem""")
def verb_multiply(spark, folder):
    return _verbs(spark, folder, "lineitem", [
        {"target": "l_suppkey", "operation": "multiply", "expression": "l_suppkey * l_linenumber"},
        {"target": "FACTOR", "operation": "multiply", "expression": "l_orderkey"},
    ], ["l_orderkey", "l_linenumber", "l_suppkey", "FACTOR"])


@query("verb_divide", """
    SELECT p_partkey, p_retailprice / nullif(p_size % 5, 0) AS UNIT_COST FROM part""")
def verb_divide(spark, folder):
    part = table(spark, folder, "part").withColumn("divisor", F.col("p_size") % 5)
    return apply_verbs(part, [
        {"output_field": "UNIT_COST", "operation": "DIVIDE", "operands": ["p_retailprice", "divisor"]},
    ]).select("p_partkey", "UNIT_COST")


@query("verb_compute", """
    SELECT l_orderkey, l_linenumber, l_quantity * 2 - l_linenumber AS NET,
           l_orderkey - 1 AS BEFORE FROM lineitem""")
def verb_compute(spark, folder):
    return _verbs(spark, folder, "lineitem", [
        {"target": "NET", "operation": "compute", "expression": "l-quantity * 2 _ l-linenumber"},
        {"target": "BEFORE", "operation": "compute", "expression": "l_orderkey -1"},
    ], ["l_orderkey", "l_linenumber", "NET", "BEFORE"])


@query("verb_initialize", "SELECT c_custkey, 0 AS WS_TOTAL, 'X' AS WS_FLAG FROM customer")
def verb_initialize(spark, folder):
    return _verbs(spark, folder, "customer", [
        {"target": "WS-TOTAL", "operation": "initialize"},
        {"target": "WS-FLAG", "operation": "initialize", "value": "X"},
    ], ["c_custkey", "WS_TOTAL", "WS_FLAG"])


@query("verb_string", """
    SELECT p_partkey, concat_ws('/', p_brand, nullif(p_type, 'ECONOMY'), p_name) AS LABEL FROM part""")
def verb_string(spark, folder):
    part = table(spark, folder, "part").withColumn("kind", F.nullif("p_type", F.lit("ECONOMY")))
    return apply_verbs(part, [
        {"target": "LABEL", "operation": "string", "delimiter": "/",
         "expression": "p-brand kind p-name DELIMITED BY SIZE"},
    ]).select("p_partkey", "LABEL")


@query("verb_unstring", """
    SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS RANK,
           split_part(o_orderpriority, '-', 2) AS WORD, substr(o_orderpriority, 1, 3) AS HEAD
    FROM orders""")
def verb_unstring(spark, folder):
    return _verbs(spark, folder, "orders", [
        {"target": "RANK", "operation": "unstring", "delimiter": "-", "expression": "o_orderpriority"},
        {"target": "WORD", "operation": "unstring", "delimiter": "-", "index": 1,
         "expression": "o_orderpriority"},
        {"output_field": "HEAD", "operation": "UNSTRING", "operands": ["o_orderpriority", "0", "3"]},
    ], ["o_orderkey", "RANK", "WORD", "HEAD"])


@query("verb_inspect", """
    SELECT c_custkey, regexp_replace(c_name, '[^A-Za-z]', '', 'g') AS CLEAN,
           regexp_replace(c_name, '0+', '0', 'g') AS SHORT FROM customer""")
def verb_inspect(spark, folder):
    return _verbs(spark, folder, "customer", [
        {"output_field": "CLEAN", "operation": "INSPECT", "operands": ["c_name", "[^A-Za-z]", ""]},
        {"target": "SHORT", "operation": "inspect", "expression": "c_name", "before": "0+",
         "after": "0"},
    ], ["c_custkey", "CLEAN", "SHORT"])


@query("verb_expr", """
    SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'HIGH' ELSE 'LOW' END AS BAND,
           upper(o_orderstatus) || '-' || o_custkey AS CODE FROM orders""")
def verb_expr(spark, folder):
    return _verbs(spark, folder, "orders", [
        {"target": "BAND", "operation": "evaluate",
         "expression": "case when o-totalprice > 200000 then 'HIGH' else 'LOW' end"},
        {"target": "CODE", "operation": "expr",
         "expression": "upper(o_orderstatus) || '-' || o_custkey"},
    ], ["o_orderkey", "BAND", "CODE"])


@query("verb_working_storage", """
    SELECT l_returnflag, sum(l_partkey - l_suppkey)::BIGINT AS net_total, sum(l_partkey)::BIGINT AS debit
    FROM lineitem GROUP BY 1""")
def verb_working_storage(spark, folder):
    frames = {"in": table(spark, folder, "lineitem")}
    steps = [
        {"id": "ws", "type": "select", "source_inputs": ["in"], "logic": {
            "working_storage": ["WS-DEBIT", "WS-CREDIT"],
            "expressions": [
                {"target": "WS-DEBIT", "operation": "add", "expression": "WS-DEBIT + l_partkey"},
                {"target": "WS-CREDIT", "operation": "add", "expression": "WS-CREDIT + l_suppkey"},
                {"target": "WS-NET", "operation": "compute", "expression": "WS-DEBIT _ WS-CREDIT"},
            ]}},
        {"id": "out", "type": "aggregate", "source_inputs": ["ws"], "logic": {
            "group_by": ["l_returnflag"], "aggregations": [
                {"field": "WS-NET", "operation": "sum", "alias": "net_total"},
                {"field": "WS-DEBIT", "operation": "sum", "alias": "debit"}]}},
    ]
    return run_steps(frames, steps)["out"]


# ---- joins ---------------------------------------------------------------------------

def _joined(spark, folder, left, right, on, how, columns, **more):
    frames = {"l": left, "r": right}
    step = {"id": "j", "type": "join", "source_inputs": ["l"],
            "logic": {"left": "l", "right": "r", "on": on, "how": how, **more}}
    return run_step(step, frames)[1].select(columns)


def _moved_customers(spark, folder):
    """All customers, every third under another key, so that outer joins have rows
    without a match on either side."""
    return table(spark, folder, "customer").withColumn("c_custkey", F.expr(_MOVED).cast("bigint"))


def _moved_orders(spark, folder):
    """All orders, those of every fifth customer under another key."""
    return table(spark, folder, "orders").withColumn("o_custkey", F.expr(_MOVED_ORDER).cast("bigint"))


_MOVED = "CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END"
_MOVED_ORDER = "CASE WHEN o_custkey % 5 = 0 THEN -o_custkey ELSE o_custkey END"
_CUSTOMERS = f"(SELECT * REPLACE ({_MOVED} AS c_custkey) FROM customer) c"
_ORDERS = f"(SELECT * REPLACE ({_MOVED_ORDER} AS o_custkey) FROM orders) o"


@query("join_inner", """
    SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(spark, folder):
    return _joined(spark, folder, table(spark, folder, "orders"), table(spark, folder, "customer"),
                   [["o-custkey", "c-custkey"]], "inner",
                   ["o_orderkey", "o_custkey", "c_custkey", "c_name"])


@query("join_left", f"""
    SELECT o_orderkey, c_name FROM orders LEFT JOIN {_CUSTOMERS} ON o_custkey = c_custkey""")
def join_left(spark, folder):
    return _joined(spark, folder, table(spark, folder, "orders"), _moved_customers(spark, folder),
                   [["o_custkey", "c_custkey"]], "left", ["o_orderkey", "c_name"])


@query("join_right", f"""
    SELECT o_orderkey, c_name FROM {_ORDERS}
    RIGHT JOIN customer ON o_custkey = c_custkey""")
def join_right(spark, folder):
    orders = _moved_orders(spark, folder)
    return _joined(spark, folder, orders, table(spark, folder, "customer"),
                   [["o_custkey", "c_custkey"]], "right", ["o_orderkey", "c_name"])


@query("join_full", f"""
    SELECT o_orderkey, c_name FROM {_ORDERS}
    FULL JOIN {_CUSTOMERS} ON o_custkey = c_custkey""")
def join_full(spark, folder):
    orders = _moved_orders(spark, folder)
    return _joined(spark, folder, orders, _moved_customers(spark, folder),
                   [["o_custkey", "c_custkey"]], "outer", ["o_orderkey", "c_name"])


@query("join_semi", f"""
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM {_ORDERS} WHERE o_custkey = c_custkey)""")
def join_semi(spark, folder):
    orders = _moved_orders(spark, folder)
    return _joined(spark, folder, table(spark, folder, "customer"), orders,
                   [["c_custkey", "o_custkey"]], "left_semi", ["c_custkey", "c_name"])


@query("join_anti", f"""
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM {_ORDERS} WHERE o_custkey = c_custkey)""")
def join_anti(spark, folder):
    orders = _moved_orders(spark, folder)
    return _joined(spark, folder, table(spark, folder, "customer"), orders,
                   [["c_custkey", "o_custkey"]], "anti", ["c_custkey", "c_name"])


@query("join_using", """
    SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)""")
def join_using(spark, folder):
    return _joined(spark, folder, table(spark, folder, "documents"), table(spark, folder, "labels"),
                   ["doc-id"], "inner", ["doc_id", "lang", "quality", "toxic"])


@query("join_multi_key", """
    SELECT s_suppkey, c_custkey FROM supplier JOIN customer
    ON s_nationkey = c_nationkey AND s_suppkey = c_custkey""")
def join_multi_key(spark, folder):
    return _joined(spark, folder, table(spark, folder, "supplier"), table(spark, folder, "customer"),
                   [["s_nationkey", "c_nationkey"], ["s_suppkey", "c_custkey"]], "inner",
                   ["s_suppkey", "c_custkey"])


@query("join_cross", """
    SELECT c_custkey, n_name FROM customer CROSS JOIN nation WHERE c_nationkey = n_nationkey""")
def join_cross(spark, folder):
    return _joined(spark, folder, table(spark, folder, "customer"), table(spark, folder, "nation"),
                   [["c_nationkey", "n_nationkey"]], "cross", ["c_custkey", "n_name"])


# Orders of every third customer are moved to customer 7: one key holds over a third.
_HOT = "CASE WHEN o_custkey % 3 = 0 THEN 7 ELSE o_custkey END"


def _hot_orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.expr(_HOT).cast("bigint").alias("o_custkey"))


@query("join_skewed", f"""
    SELECT o_orderkey, c_custkey, c_mktsegment
    FROM (SELECT o_orderkey, {_HOT} AS k FROM orders) o LEFT JOIN {_CUSTOMERS} ON k = c_custkey""")
def join_skewed(spark, folder):
    return _joined(spark, folder, _hot_orders(spark, folder), _moved_customers(spark, folder),
                   [["o_custkey", "c_custkey"]], "left",
                   ["o_orderkey", "c_custkey", "c_mktsegment"], skew_parts=8)


@query("join_skewed_right_side", f"""
    SELECT c_custkey, o_orderkey
    FROM {_CUSTOMERS} LEFT JOIN (SELECT o_orderkey, {_HOT} AS k FROM orders) o ON c_custkey = k""")
def join_skewed_right_side(spark, folder):
    """A hot key of the right side of a left join, which no engine splits by itself."""
    return _joined(spark, folder, _moved_customers(spark, folder), _hot_orders(spark, folder),
                   [["c_custkey", "o_custkey"]], "left", ["c_custkey", "o_orderkey"], skew_parts=8)


@query("join_skewed_full", f"""
    SELECT o_orderkey, c_custkey, c_mktsegment
    FROM (SELECT o_orderkey, {_HOT} AS k FROM orders) o FULL JOIN {_CUSTOMERS} ON k = c_custkey""")
def join_skewed_full(spark, folder):
    return _joined(spark, folder, _hot_orders(spark, folder), _moved_customers(spark, folder),
                   [["o_custkey", "c_custkey"]], "full",
                   ["o_orderkey", "c_custkey", "c_mktsegment"], skew_parts=8)


# ---- aggregates ----------------------------------------------------------------------

_MONEY = "CAST({} AS DECIMAL(18,2))"


def _lines(spark, folder):
    """Line items with exact money columns."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate",
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))


_LINES = """(SELECT l_orderkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate,
    CAST(l_quantity AS BIGINT) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
    FROM lineitem)"""


def _aggregated(frame, group_by, aggregations):
    return run_step({"id": "a", "type": "aggregate", "source_inputs": ["in"], "logic": {
        "group_by": group_by, "aggregations": aggregations}}, {"in": frame})[1]


@query("agg_global", f"""
    SELECT count(*) AS n, sum(price) AS total, min(qty) AS low, max(qty) AS high FROM {_LINES}""")
def agg_global(spark, folder):
    return _aggregated(_lines(spark, folder), [], [
        {"field": "*", "operation": "count", "alias": "n"},
        {"field": "price", "operation": "sum", "alias": "total"},
        {"field": "qty", "operation": "min", "alias": "low"},
        {"field": "qty", "operation": "max", "alias": "high"}])


@query("agg_sum", f"""
    SELECT l_returnflag, l_linestatus, sum(price) AS sum_price, sum(qty)::BIGINT AS add_qty
    FROM {_LINES} GROUP BY 1, 2""")
def agg_sum(spark, folder):
    return _aggregated(_lines(spark, folder), ["l-returnflag", "l-linestatus"], [
        {"field": "price", "operation": "sum"}, {"field": "qty", "operation": "add"}])


@query("agg_count", """
    SELECT o_orderstatus, count(*) AS n, count(nullif(o_orderpriority, '5-LOW')) AS with_priority
    FROM orders GROUP BY 1""")
def agg_count(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return _aggregated(orders, ["o_orderstatus"], [
        {"field": "*", "function": "count", "alias": "n"},
        {"field": "priority", "operation": "tallying", "alias": "with_priority"}])


@query("agg_avg_min_max", f"""
    SELECT l_suppkey, round(avg(qty), 4) AS mean_qty, min(price) AS low, max(price) AS high
    FROM {_LINES} GROUP BY 1""")
def agg_avg_min_max(spark, folder):
    return _aggregated(_lines(spark, folder), ["l_suppkey"], [
        {"field": "qty", "operation": "avg", "alias": "mean_qty"},
        {"field": "price", "operation": "min", "alias": "low"},
        {"field": "price", "operation": "max", "alias": "high"},
    ]).withColumn("mean_qty", F.round("mean_qty", 4))


@query("agg_sum_if", f"""
    SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN price ELSE 0 END) AS returned
    FROM {_LINES} GROUP BY 1""")
def agg_sum_if(spark, folder):
    return _aggregated(_lines(spark, folder), ["l_suppkey"], [
        {"field": "price", "operation": "sum", "condition": "l-returnflag = 'R'",
         "alias": "returned"}])


@query("agg_count_if", """
    SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)::BIGINT AS accepted
    FROM lineitem GROUP BY 1""")
def agg_count_if(spark, folder):
    return _aggregated(_lines(spark, folder), ["l_suppkey"], [
        {"field": "*", "operation": "count", "condition": "l_returnflag = 'A'",
         "alias": "accepted"}])


@query("agg_avg_if", f"""
    SELECT l_linestatus, round(avg(CASE WHEN l_returnflag = 'N' THEN qty END), 4) AS mean_open
    FROM {_LINES} GROUP BY 1""")
def agg_avg_if(spark, folder):
    return _aggregated(_lines(spark, folder), ["l_linestatus"], [
        {"field": "qty", "operation": "avg", "condition": "l_returnflag = 'N'",
         "alias": "mean_open"}]).withColumn("mean_open", F.round("mean_open", 4))


@query("agg_complex_condition", f"""
    SELECT l_suppkey,
           sum(CASE WHEN l_returnflag = 'R' AND (qty > 25 OR l_linenumber <> 1) THEN price ELSE 0 END) AS big,
           max(CASE WHEN qty BETWEEN 5 AND 15 THEN price END) AS best_small
    FROM {_LINES} GROUP BY 1""")
def agg_complex_condition(spark, folder):
    return _aggregated(_lines(spark, folder), ["l_suppkey"], [
        {"field": "price", "operation": "sum", "alias": "big",
         "condition": "l-returnflag = 'R' and (qty > 25 or l-linenumber <> 1)"},
        {"field": "price", "operation": "max", "alias": "best_small",
         "condition": "qty between 5 and 15"}])


# ---- unions and sorts ----------------------------------------------------------------

@query("union_by_name", """
    SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier""")
def union_by_name(spark, folder):
    customers = table(spark, folder, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_nationkey AS nation", "s_name AS name")
    return run_step({"id": "u", "type": "union", "source_inputs": ["c", "s"]},
                    {"c": customers, "s": suppliers})[1]


@query("union_three", """
    SELECT 'c' AS kind, c_name AS name FROM customer UNION ALL
    SELECT 's', s_name FROM supplier UNION ALL SELECT 'p', p_name FROM part""")
def union_three(spark, folder):
    frames = {
        kind: table(spark, folder, name).select(F.lit(kind).alias("kind"), F.col(f"{kind}_name").alias("name"))
        for kind, name in (("c", "customer"), ("s", "supplier"), ("p", "part"))
    }
    return run_step({"id": "u", "type": "union", "source_inputs": ["c", "s", "p"]}, frames)[1]


@query("merge_sorted", """
    SELECT c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_name, s_nationkey FROM supplier ORDER BY nation, name""")
def merge_sorted(spark, folder):
    customers = table(spark, folder, "customer").selectExpr("c_name AS name", "c_nationkey AS nation")
    suppliers = table(spark, folder, "supplier").selectExpr("s_name AS name", "s_nationkey AS nation")
    return merge_frames([customers, suppliers], ["nation", "name"])


def _sorted(spark, folder, logic):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return run_step({"id": "s", "type": "custom", "source_inputs": ["o"],
                     "logic": {"operation": "sort", **logic}}, {"o": orders})[1]


@query("sort_asc", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderstatus, o_orderkey")
def sort_asc(spark, folder):
    return _sorted(spark, folder, {"key": ["o-orderstatus", "o_orderkey"], "ascending": True})


@query("sort_desc", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_custkey DESC, o_orderkey DESC""")
def sort_desc(spark, folder):
    return _sorted(spark, folder, {"keys": ["o_custkey", "o_orderkey"], "order": "desc"})


# ---- step lists ----------------------------------------------------------------------

FLAGSHIP_STEPS = [
    {"id": "joined", "type": "join", "source_inputs": ["CUSTOMER", "ORDERS"],
     "logic": {"left": "CUSTOMER", "right": "ORDERS", "on": [["c-custkey", "o-custkey"]],
               "how": "inner"}},
    {"id": "large", "type": "filter", "source_inputs": ["joined"],
     "logic": {"conditions": [{"field": "o-totalprice", "operation": ">", "value": 50000}]}},
    {"id": "amounts", "type": "select", "source_inputs": ["large"],
     "logic": {"expressions": [{"target": "AMOUNT", "operation": "compute",
                                "expression": "cast(o-totalprice as decimal(18,2))"}]}},
    {"id": "totals", "type": "aggregate", "source_inputs": ["amounts"],
     "logic": {"group_by": ["c-mktsegment"],
               "aggregations": [{"field": "AMOUNT", "operation": "sum", "alias": "total"},
                                {"field": "*", "operation": "count", "alias": "n"}]}},
]


def _inputs(spark, folder):
    return {"CUSTOMER": table(spark, folder, "customer"), "ORDERS": table(spark, folder, "orders")}


@query("steps_join_filter_agg", """
    SELECT c_mktsegment, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n
    FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 50000 GROUP BY 1""")
def steps_join_filter_agg(spark, folder):
    return run_steps(_inputs(spark, folder), FLAGSHIP_STEPS)["totals"]


@query("steps_single", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def steps_single(spark, folder):
    df = run_step({"type": "filter", "input": "ORDERS", "name": "final", "conditions": [
        {"field": "o_orderstatus", "operation": "equals", "value": "F"}]}, _inputs(spark, folder))[1]
    return df.select("o_orderkey", "o_custkey")


@query("steps_passthrough_output", "SELECT c_custkey, c_name FROM customer")
def steps_passthrough_output(spark, folder):
    inputs = _inputs(spark, folder)
    results = {s["id"]: df for s, df in [(FLAGSHIP_STEPS[0], run_step(FLAGSHIP_STEPS[0], inputs)[1])]}
    outputs = resolve_outputs(inputs, results, {"CUSTOMER": {}, "REPORT": {"source_inputs": ["joined"]}})
    return outputs["CUSTOMER"].select("c_custkey", "c_name")


@query("steps_row_counts", """
    SELECT 'joined' AS output, count(*) AS row_count FROM customer JOIN orders ON c_custkey = o_custkey
    UNION ALL SELECT 'CUSTOMER', count(*) FROM customer
    UNION ALL SELECT 'totals', count(DISTINCT c_mktsegment) FROM customer JOIN orders
    ON c_custkey = o_custkey WHERE o_totalprice > 50000""")
def steps_row_counts(spark, folder):
    named = run_steps(_inputs(spark, folder), FLAGSHIP_STEPS)
    return row_counts({k: named[k] for k in ("joined", "CUSTOMER", "totals")})
