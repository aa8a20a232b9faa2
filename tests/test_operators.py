"""Operator semantics beyond the registered queries, and what must be refused."""

from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feedmill.operators.aggregates import aggregate
from feedmill.operators.filters import COMPARISONS, filter_rows, split_rows
from feedmill.operators.joins import KINDS, hot_keys, join_frames
from feedmill.operators.sets import sort_rows, union_frames
from feedmill.operators.verbs import apply_verbs, select_columns
from feedmill.plans.steps import resolve_outputs, row_counts, run_step, run_steps


@pytest.fixture
def txn(spark):
    return spark.createDataFrame(
        [("T001", 100, "CR", "OK"), ("T002", -5, "DR", None), ("T003", 60, "DR", "OK"),
         ("T004", 0, "CR", "BAD"), ("T005", 7, "CR", "OK")],
        "TXN_ID string, AMOUNT long, TXN_TYPE string, STATUS string")


def _ids(df):
    return sorted(r.TXN_ID for r in df.collect())


def test_reported_sample(txn):
    kept = filter_rows(txn, [{"field": "AMOUNT", "operation": ">", "value": 0}])
    assert _ids(kept) == ["T001", "T003", "T005"]
    assert filter_rows(txn, [{"field": "AMOUNT", "operation": ">", "value": 10**6}]).count() == 0


@pytest.mark.parametrize("op, value, expected", [
    *[(w, 60, {"gt": 1, "lt": 3, "ge": 2, "le": 4, "ne": 4, "eq": 1}[fn.__name__])
      for fn, words in COMPARISONS.items() for w in words],
    ("in", [60, 7], 2), ("in_list", 60, 1), ("not_in", [60, 7], 3), ("nin", 60, 4),
    ("not_in_list", [0], 4), ("contains", "0", 3),
])
def test_filter_operations(txn, op, value, expected):
    assert filter_rows(txn, [{"field": "AMOUNT", "op": op, "value": value}]).count() == expected


def test_filter_nulls(txn):
    def status(op, value=None):
        return _ids(filter_rows(txn, [{"field": "STATUS", "operation": op, "value": value}]))

    assert status("not_equals", "OK") == ["T004"]
    assert status("not_in", ["OK"]) == ["T004"]
    assert status("is_null") == ["T002"]
    assert status("is_not_null") == ["T001", "T003", "T004", "T005"]
    assert filter_rows(txn, []).count() == 5
    listed, other = split_rows(txn, "STATUS", ["OK"])
    assert (_ids(listed), _ids(other)) == (["T001", "T003", "T005"], ["T004"])


def test_filter_text_against_number(spark):
    df = spark.createDataFrame([("12",), ("x",), ("3.5",), (None,)], "v string")
    assert filter_rows(df, [{"field": "v", "operation": ">", "value": 3}]).count() == 2
    assert filter_rows(df, [{"field": "v", "operation": "in", "value": [12, 4]}]).count() == 1


@pytest.mark.parametrize("bad", [
    {"field": "AMOUNT", "operation": "like", "value": 1}, {"field": "NO", "value": 1}])
def test_filter_refuses(txn, bad):
    with pytest.raises(ValueError):
        filter_rows(txn, [bad])


@pytest.mark.parametrize("spec, expected", [
    ({"target": "WS-T", "operation": "add", "expression": "WS-T + A-B + 5"}, 15),
    ({"target": "A-B", "operation": "add", "expression": "A-B + C"}, 13),
    ({"target": "WS", "operation": "add", "expression": "C 1.5"}, 4.5),
    ({"target": "WS", "operation": "subtract", "expression": "A-B"}, -10),
    ({"target": "A-B", "operation": "subtract", "expression": "A-B - C"}, 7),
    ({"target": "A_B", "operation": "subtract", "expression": "-4"}, 14),
    ({"target": "WS", "operation": "multiply", "expression": "WS * A-B"}, 10),
    ({"target": "C", "operation": "multiply", "expression": "4"}, 12),
    ({"target": "A-B", "operation": "divide", "expression": "4"}, 2.5),
    ({"target": "A-B", "operation": "divide", "expression": "Z"}, None),
    ({"target": "WS", "operation": "divide", "expression": "A-B"}, 0.0),
    ({"target": "WS", "operation": "compute", "expression": "A-B _ C"}, 7),
    ({"target": "WS", "operation": "compute", "expression": "A-B * -1"}, -10),
    ({"target": "WS", "operation": "compute", "expression": "C-Z"}, 3),
    ({"target": "WS", "operation": "move", "expression": "-3"}, -3),
    ({"target": "WS", "operation": "move", "expression": ""}, None),
    ({"target": "WS", "operation": "string", "expression": "A-B ' ' N", "delimiter": ""}, "10 p,q"),
    ({"target": "WS", "operation": "unstring", "expression": "N"}, "p"),
    ({"target": "WS", "operation": "unstring", "expression": "D", "delimiter": ".", "index": 1}, "y"),
    ({"output_field": "WS", "operation": "MULTIPLY", "operands": ["C", "C", "2"]}, 18),
    ({"output_field": "WS", "operation": "STRING", "operands": ["N", "' '", "D"]}, "p,q x.y"),
    ({"output_field": "WS", "operation": "MOVE", "operands": ["N"]}, "p,q"),
    ({"output_field": "WS", "operation": "COMPUTE", "operands": ["A_B + C - 1"]}, 12),
])
def test_verbs(spark, spec, expected):
    df = spark.createDataFrame([(10, 3, 0, "p,q", "x.y")], "A_B long, C long, Z long, N string, D string")
    out = apply_verbs(df, [spec])
    target = (spec.get("target") or spec["output_field"]).replace("-", "_")
    value = out.first()[target]
    assert value == expected or float(value) == expected
    assert Counter(out.columns).most_common(1)[0][1] == 1


def test_verbs_see_earlier_results(spark):
    df = spark.createDataFrame([(10, 3)], "A long, B long")
    out = apply_verbs(df, [
        {"target": "T", "operation": "add", "expression": "A"},
        {"target": "T", "operation": "add", "expression": "T + B"},
        {"target": "A", "operation": "initialize", "value": 1},
        {"target": "U", "operation": "compute", "expression": "T * A"},
        {"target": "V", "operation": "move", "expression": "B"},
    ])
    assert out.first().asDict() == {"A": 1, "B": 3, "T": 13, "U": 13, "V": 3}


@pytest.mark.parametrize("spec", [
    {"target": "X", "operation": "add", "expression": "NOPE"},
    {"target": "X", "operation": "subtract", "expression": ""},
    {"target": "X", "operation": "divide", "expression": "NOPE"},
    {"target": "X", "operation": "compute", "expression": "NOPE + 1"},
    {"target": "X", "operation": "string", "expression": "DELIMITED BY SIZE"},
    {"operation": "move", "expression": "1"},
])
def test_verbs_refuse(spark, spec):
    with pytest.raises((ValueError, AnalysisException), match="NOPE|needs|without a target|unknown"):
        apply_verbs(spark.range(1), [spec]).collect()


def test_columns_win_over_expressions(txn):
    step = {"type": "select", "source_inputs": ["t"], "logic": {
        "columns": ["TXN-ID"], "expressions": [{"target": "X", "expression": "1"}]}}
    assert run_step(step, {"t": txn})[1].columns == ["TXN_ID"]
    assert select_columns(txn, ["*"]).columns == txn.columns


def _rows(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


@pytest.mark.parametrize("how", sorted(set(KINDS.values())))
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(600).selectExpr(
        "case when id % 3 = 0 then 7 when id % 11 = 0 then null else id % 40 end as k", "id as v", "'l' as side")
    right = spark.range(90).selectExpr(
        "case when id % 13 = 0 then null when id < 5 then 7 else id end as k", "id as v", "'r' as side")
    plain = join_frames(left, right, [["k", "k"]], how)
    salted = join_frames(left, right, [["k", "k"]], how, skew_parts=4)
    assert salted.columns == plain.columns
    assert _rows(salted) == _rows(plain)
    assert [r[0] for r in hot_keys(left, ["k"], 4).collect()] == [7]


@pytest.mark.parametrize("parts", [0, 3])
@pytest.mark.parametrize("how", sorted(set(KINDS.values())))
def test_joins_equal_sparks_own(spark, how, parts):
    left = spark.range(60).selectExpr(
        "case when id % 7 = 0 then null else id % 20 end as k", "id % 2 as j", "id as v")
    right = spark.range(30).selectExpr(
        "case when id % 11 = 0 then null else id end as k", "id % 2 as j", "-id as w")
    ours = join_frames(left, right, ["k", "j"], how, parts)
    theirs = left.join(right, ["k", "j"], how)
    assert ours.columns == theirs.columns
    assert _rows(ours) == _rows(theirs)
    pairs = join_frames(left, right, [["k", "k"], ["j", "j"]], how, parts)
    assert _rows(pairs) == _rows(left.join(right, (left.k == right.k) & (left.j == right.j), how))


@pytest.mark.parametrize("parts", [0, 3])
@pytest.mark.parametrize("how, n", [("inner", 90), ("full", 90), ("left_anti", 0), ("right", 90)])
def test_join_of_frames_from_one_source(spark, how, n, parts):
    df = spark.range(90).selectExpr("id % 9 as k", "id as v")
    totals = aggregate(df, ["k"], [{"field": "v", "alias": "total"}])
    assert join_frames(df, totals, [["k", "k"]], how, parts).count() == n
    assert join_frames(df, df.filter("v >= 0"), ["v"], how, parts).count() == n


def test_join_shapes(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "`K-1` long, x string").toDF("K_1", "x")
    right = spark.createDataFrame([(1, "c")], "K_1 long, y string")
    assert join_frames(left, right, ["K-1"]).columns == ["K_1", "x", "y"]
    assert join_frames(left, right, [["K-1", "K-1"]]).columns == ["K_1", "x", "K_1", "y"]
    for on, how in (([], "inner"), ([], "cross"), (["K_1"], "sideways"), (["NO"], "inner")):
        with pytest.raises(ValueError):
            join_frames(left, right, on, how)
    with pytest.raises(ValueError, match="no frame"):
        run_step({"type": "join", "logic": {"left": "a", "right": "b", "on": ["k"]}}, {"a": left})


def test_aggregates(txn):
    out = aggregate(txn, [], [
        {"field": "AMOUNT"}, {"operation": "count"}, {"field": "STATUS", "operation": "tallying"},
        {"field": "AMOUNT", "operation": "min", "condition": "TXN-TYPE = 'CR' and AMOUNT > 0", "alias": "low"},
    ]).first().asDict()
    assert out == {"sum_AMOUNT": 162, "count_*": 5, "tallying_STATUS": 4, "low": 7}
    assert aggregate(txn, ["TXN_TYPE"], []) is txn
    for bad in ({"field": "*", "operation": "sum"}, {"field": "AMOUNT", "operation": "median"},
                {"field": "NO"}, {"field": "AMOUNT", "condition": "NO = 1"},
                {"field": "AMOUNT", "condition": "AMOUNT = = 1"}):
        with pytest.raises((ValueError, AnalysisException), match="needs a field|unknown aggregate|NO|PARSE_SYNTAX_ERROR"):
            aggregate(txn, [], [bad]).collect()


def test_sort_orders_totally_and_splits_a_hot_key(spark, small_splits):
    df = spark.range(8000).selectExpr("case when id % 3 > 0 then 5 else id % 10 end as k", "id as v")
    ordered = sort_rows(df, "k", ascending=False)
    keys = [r.k for r in ordered.collect()]
    assert keys == sorted(keys, reverse=True) and len(keys) == 8000
    tasks = ordered.filter("k = 5").select(F.spark_partition_id()).distinct().count()
    assert tasks > 1
    with pytest.raises(ValueError):
        sort_rows(df, [])


def test_steps(txn, spark):
    flat = {"type": "filter", "name": "big", "input": "t",
            "conditions": [{"field": "AMOUNT", "operation": "greater_than", "value": 50}]}
    named = run_steps({"t": txn}, [
        flat,
        {"id": "u", "type": "union", "source_inputs": ["big", "t", "big"]},
        {"id": "m", "type": "custom", "source_inputs": ["missing", "u"],
         "logic": {"operation": "sort", "key": "AMOUNT", "order": "desc"}},
    ])
    assert [named[k].count() for k in ("big", "u", "m")] == [2, 9, 9]
    assert named["m"].first().AMOUNT == 100
    for bad in ({"type": "explode", "input": "t"}, {"type": "filter", "input": "nope"},
                {"type": "custom", "input": "t", "logic": {"operation": "shuffle"}}):
        with pytest.raises(ValueError):
            run_steps({"t": txn}, [bad])
    assert union_frames([txn]).count() == 5
    with pytest.raises(ValueError):
        union_frames([])


def test_outputs(txn, spark):
    other = spark.range(2)
    inputs, results = {"IN": txn}, {"a": other}
    assert resolve_outputs(inputs, results, {"a": {}})["a"] is other
    assert resolve_outputs(inputs, results, {"X": {"source_inputs": ["no", "a"]}})["X"] is other
    assert resolve_outputs(inputs, results, {"IN": {}})["IN"] is txn
    assert resolve_outputs(inputs, results, {"REPORT": {}})["REPORT"] is other
    with pytest.raises(ValueError):
        resolve_outputs(inputs, {**results, "b": txn}, {"REPORT": {}})
    counts = {r.output: r.row_count for r in row_counts({"a": other, "IN": txn}).collect()}
    assert counts == {"a": 2, "IN": 5}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_hot_keys_of_either_side(spark, how):
    """Keys hot on the left, on the right, on both and on neither, and no key at all."""
    left = spark.range(400).selectExpr("case when id % 4 = 0 then 1 when id % 4 = 1 then 2 when id % 9 = 0 then null else id end as k", "id as l")
    right = spark.range(300).selectExpr("case when id % 3 = 0 then 2 when id % 3 = 1 then 3 when id % 7 = 0 then null else id end as k", "id as r")
    right = right.unionByName(spark.createDataFrame([(1, -1), (77, -2)], "k long, r long"))
    wanted = left.join(right, left.k == right.k, {"full": "full_outer"}.get(how, how))
    got = join_frames(left, right, [["k", "k"]], how, skew_parts=4)
    order = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert order(got) == order(wanted)
