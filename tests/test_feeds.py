"""Fixed-width, delimited, EBCDIC and table sinks; control totals and reconciliation."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from checks import plan_nodes, text_scans
from feedmill.fields import Layout
from feedmill.functions.ebcdic import encode_text, pack_decimal
from feedmill.operators import alerts, reconcile, totals
from feedmill.operators import validate as v
from feedmill.plans.flow import write_output
from feedmill.plans.steps import run_step
from feedmill.session import cut, new_folder, shared_folder
from feedmill.sinks import jdbc, tables
from feedmill.sinks.fixed import to_lines, write_feeds, write_fixed
from feedmill.sources.dated import days_between, load_date, read_dated
from feedmill.sources.ebcdic import read_ebcdic, read_framed_records
from feedmill.sources.fixed import parse_fixed, read_fixed
from feedmill.sources.tables import empty_frame, read_delimited, typed_cast

LAYOUT = Layout.of([
    {"name": "ID", "type": "long", "length": 8},
    {"name": "NAME", "length": 12, "start": 11},
    {"name": "AMT", "type": "decimal", "precision": 2, "length": 9},
    {"name": "CODE", "length": 5, "just_right": True},
], record_length=40)

_text = st.text("abcXYZ09-.,'é", max_size=12).map(str.strip)
_row = st.tuples(
    st.one_of(st.none(), st.integers(-999_999, 9_999_999)), st.one_of(st.none(), _text),
    st.one_of(st.none(), st.decimals(Decimal("-99999.99"), Decimal("99999.99"), places=2)),
    st.one_of(st.none(), _text.map(lambda s: s[:5].strip())))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(_row.filter(lambda r: any(x not in (None, "") for x in r)), min_size=1, max_size=30))
def test_write_then_read_is_identity(spark, rows):
    df = spark.createDataFrame(rows, "ID long, NAME string, AMT decimal(18,2), CODE string")
    path = new_folder(spark, "identity")
    write_fixed(df, LAYOUT, path)
    assert {len(r.value) for r in spark.read.text(path).collect()} == {40}
    back = read_fixed(spark, path, LAYOUT).data
    got = [(int(r.ID) if r.ID else None, r.NAME, r.AMT, r.CODE) for r in back.collect()]
    want = [(i, n or "", a, c or "") for i, n, a, c in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_fixed_line_details(spark):
    df = spark.createDataFrame(
        [(123456789012, None, Decimal("-1.50"), "AB", dt.date(2026, 3, 1))],
        "ID long, NAME string, AMT decimal(18,2), CODE string, DAY date")
    fields = [{"name": "CODE", "length": 4}, {"name": "AMT", "type": "decimal", "precision": 2, "length": 7},
              {"name": "DAY", "type": "date", "format": "DDMMYYYY", "length": 8},
              {"name": "ID", "type": "long", "length": 5}, {"name": "NAME", "length": 3}]
    # The first digits of a number would be another number: only an explicit wish cuts it.
    with pytest.raises(SparkRuntimeException, match="does not fit the 5 places of 'ID'"):
        to_lines(df, fields).collect()
    assert to_lines(df, fields, "truncate").first().value == "AB  -000150010320261234" + "5" + "   "
    for width, expected in ((3, "AB "), (4, "AB  "), (6, "AB    ")):
        assert to_lines(df, Layout.of(fields[:1], width)).first().value == expected
    with pytest.raises(ValueError, match="overlaps"):
        to_lines(df, [{"name": "CODE", "length": 4}, {"name": "ID", "start": 3, "length": 2}])


def test_delimited_quotes_and_inference(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 'say "x"', None), ("", "z", "1")], "A string, `B-C` string, N string")
    path = str(tmp_path / "env")
    tables.write_delimited_enveloped(df, path, "|", 1, 2)
    back = read_delimited(spark, path, [{"name": "N", "type": "int"}], "|", 1, 2, unit="directory")
    assert back.columns == ["A", "B_C", "N"]
    # As in every delimited file of Spark's, empty text reads as NULL.
    assert sorted(map(str, back.collect())) == [
        "Row(A='a|b', B_C='say \"x\"', N=None)", "Row(A=None, B_C='z', N=1)"]
    plain = str(tmp_path / "plain")
    tables.write_delimited(spark.range(3).selectExpr("id", "id * 1.5 as x"), plain)
    assert dict(read_delimited(spark, plain).dtypes) == {"id": "int", "x": "double"}
    declared = read_delimited(spark, plain, [{"name": "ID", "type": "string"}, {"name": "X", "type": "decimal"}])
    assert dict(declared.dtypes) == {"id": "string", "x": "decimal(18,4)"}


def test_line_breaks_in_values_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("a\nb",)], "A string")
    with pytest.raises(Exception, match="line break"):
        tables.write_delimited_enveloped(df, str(tmp_path / "w"), ",", 1)
    (tmp_path / "r").write_text('X\nA,B\n"one\ntwo",2\n')
    with pytest.raises(Exception, match="spans lines"):
        read_delimited(spark, str(tmp_path / "r"), header_count=1).collect()


def test_typed_cast_and_empty(spark):
    df = spark.createDataFrame([("2026-03-01", "x", "1.23456", "yes")], "D string, i string, n string, s string")
    out = typed_cast(df, [{"name": "d", "type": "date", "format": "yyyy-MM-dd"}, {"name": "I", "type": "int"},
                          {"name": "n", "type": "decimal"}, {"name": "zz", "type": "int"}]).first()
    assert tuple(out) == (dt.date(2026, 3, 1), None, Decimal("1.2346"), "yes")
    empty = empty_frame(spark, [{"name": "A-B", "type": "bool"}, {"name": "C", "type": "bytes"}])
    assert empty.dtypes == [("A_B", "boolean"), ("C", "binary")] and empty.count() == 0


def test_load_date_layouts(spark):
    paths = ["/b/DAILY/20260301/F.DAT", "/b/DAILY/load_date=20260301/part-0", "/b/DAILY/load_date=20260301"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r[0] for r in df.select(load_date(F.col("p"), "daily")).collect()} == {"20260301"}


def test_ebcdic_numbers_and_offsets(spark, tmp_path):
    rows = [("HÉLLO", Decimal("-12.34"), -5, "0012}"), ("A B", Decimal("99.99"), 300, "00123")]
    records = b"".join(
        n.ljust(6).encode("cp037") + bytes.fromhex(f"{abs(int(a * 100)):05d}" + ("D" if a < 0 else "C"))
        + c.to_bytes(2, "big", signed=True) + z.encode("cp037") for n, a, c, z in rows)
    fields = [{"name": "N", "length": 6}, {"name": "A", "type": "packed", "precision": 2, "length": 3},
              {"name": "C", "type": "comp", "length": 2}, {"name": "Z", "type": "zoned", "precision": 1, "length": 5}]
    want = {("HÉLLO", Decimal("-12.34"), -5, Decimal("-12.0")), ("A B", Decimal("99.99"), 300, Decimal("12.3"))}
    (tmp_path / "plain").write_bytes(records)
    (tmp_path / "framed").write_bytes(b"head" + records + b"tl")
    assert {tuple(r) for r in read_ebcdic(spark, str(tmp_path / "plain"), fields).collect()} == want
    framed = read_ebcdic(spark, str(tmp_path / "framed"), fields, start_offset=4, end_offset=2, record_id=True)
    assert {tuple(r)[2:] for r in framed.collect()} == want
    assert sorted(r.record_id for r in framed.collect()) == [0, 1]
    with pytest.raises(Exception, match="no whole number"):
        read_ebcdic(spark, str(tmp_path / "framed"), fields, start_offset=3).collect()
    enc = spark.range(1).select(encode_text(F.lit("Aé")), pack_decimal(F.lit(-1.5), 2, 1)).first()
    assert (bytes(enc[0]), bytes(enc[1])) == ("Aé".encode("cp037"), b"\x01\x5d")


# ---- totals --------------------------------------------------------------------------

def test_framed_records_by_many_tasks(spark, tmp_path):
    """One file is read by several tasks, at whatever offsets; nothing bounds its size."""
    rng = random.Random(6)
    for name, n, start, end in (("a", 700, 7, 0), ("b", 0, 7, 0), ("deep/c", 33, 7, 0)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"h" * start + b"".join(bytes(rng.randrange(256) for _ in range(8)) + k.to_bytes(4, "big") for k in range(n)) + b"t" * end)
    found = read_framed_records(spark, str(tmp_path), 12, 7, 0, split_bytes=1000)
    assert [n for n in found.select("path").distinct().toPandas().path.map(lambda x: x.rsplit("/", 1)[1]).sort_values()] == ["a", "c"]
    rows = found.collect()
    assert len(rows) == 733 and all(int.from_bytes(r.record[8:], "big") == r.record_id and len(r.record) == 12 for r in rows)
    whole = read_framed_records(spark, str(tmp_path / "a"), 7, 7, 0, split_bytes=1000)
    assert whole.rdd.getNumPartitions() > 5
    assert b"".join(r.record for r in whole.orderBy("record_id").collect()) == (tmp_path / "a").read_bytes()[7:]
    with pytest.raises(SparkRuntimeException, match="no whole number"):
        read_framed_records(spark, str(tmp_path), 13, 7, 0).collect()
    with pytest.raises(ValueError, match="at least one byte"):
        read_framed_records(spark, str(tmp_path), 0)


def test_control_line_forms(spark):
    df = spark.createDataFrame([(1, -2.5, "x"), (2, 1.0, "y")], "n int, d double, s string")

    def line(*fields, **more):
        return [r.value for r in totals.control_line(df, fields, **more).collect()]

    assert line({"name": "N", "type": "INTEGER"}) == ["2".zfill(15)]
    assert line({"name": "N", "type": "LONG", "length": 5, "expression": "-sum(n)"}) == ["-0003"]
    assert line({"name": "N", "type": "LONG", "length": 4, "expression": "sum(d)"}) == ["-001"]
    assert line({"name": "D", "type": "DOUBLE", "length": 6, "expression": "sum(d)"}) == ["  -1.5"]
    assert line({"name": "S", "type": "STRING"}) == [" " * 20]
    assert line({"name": "S", "length": 3, "expression": "'ABCDE'"}) == ["ABC"]
    assert line({"name": "S", "length": 4, "expression": "max(s)", "just_right": True}) == ["   y"]
    assert line({"name": "T", "type": "TIMESTAMP", "length": 14, "expression": "timestamp'2026-03-01 04:05:06'"}
                ) == ["20260301040506"]
    assert line({"name": "AB", "type": "INT", "length": 3, "begin": 4}, {"name": "C", "length": 2,
                "expression": "'Z'"}, include_header=True) == ["C  AB ", "Z  002"]


def test_header_reference_without_rows(spark):
    header = spark.createDataFrame([("20260301",)], "FILE_DATE string")
    data = spark.range(0)
    fields = [{"name": "N", "type": "INT", "length": 2}, {"name": "D", "type": "DATE", "length": 8,
              "expression": "last_day(to_date(first(FILE-DATE), 'yyyyMMdd'))"}]
    assert totals.control_line(data, fields, header=header).first().value == "0020260331"
    with pytest.raises(AnalysisException, match="FILE"):
        totals.control_line(data, fields).collect()


def test_control_step_and_count_record(spark, tmp_path):
    df = spark.range(7)
    path = str(tmp_path / "ctl")
    step = {"type": "ctrl_file", "input": "d", "logic": {"path": path, "ctrl_include_header": True,
            "ctrl_file_fields": [{"name": "CNT", "type": "INT", "length": 5, "expression": "count(*)"}]}}
    assert run_step(step, {"d": df})[1] is df
    assert [r.value for r in spark.read.text(path).collect()] == ["CNT  ", "00007"]
    dated = {"type": "ctrl_file", "input": "d", "logic": {
        "ctrl_output_path": path + "-dated", "frequency": "daily", "ctrl_file_name": "D.CTL"}}
    run_step(dated, {"d": df}, dt.date(2026, 3, 1))
    assert spark.read.text(path + "-dated/DAILY/20260301/D.CTL").first().value == "7"
    with pytest.raises(ValueError, match="no path"):
        run_step({"type": "ctrl_file", "input": "d", "logic": {}}, {"d": df})


# ---- validation ----------------------------------------------------------------------

RULES = [{"field": "A", "data_type": "int", "nullable": False, "max_length": 3}]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([("1",), ("x",), ("  ",), (None,), ("12345",)], "A string")


def test_modes(rows):
    flagged = {r.A: (r._is_valid, r._validation_errors) for r in v.validate(rows, {"rules": RULES}).collect()}
    assert flagged["1"] == (True, "")
    assert flagged["x"] == (False, "'A' is not a valid int")
    assert flagged["  "] == flagged[None] == (False, "'A' must not be null or empty")
    assert flagged["12345"] == (False, "'A' exceeds max length 3")
    assert v.validate(rows, {"rules": RULES, "fail_mode": "DROP"}).collect() == [("1",)]
    assert v.validate(rows, {"rules": RULES, "mode": "FLAGGED"}).count() == 5
    assert v.validate(rows, {}).filter("_is_valid and _validation_errors = ''").count() == 5
    assert v.summary(rows, RULES).first().asDict() == {"total_rows": 5, "valid_rows": 1, "invalid_rows": 4}
    for logic in ({"mode": "ABORT"}, {"mode": "FLAG", "on_invalid": "abort"}):
        with pytest.raises(v.InvalidRows) as error:
            v.validate(rows, {"rules": RULES, **logic})
        assert error.value.count == 4 and len(error.value.samples) == 4
    assert v.validate(rows.filter("A = '1'"), {"rules": RULES, "mode": "ABORT"}).count() == 1
    for bad in ({"mode": "IGNORE"}, {"rules": [{"field": "A", "check": "nope"}]}):
        with pytest.raises(ValueError):
            v.validate(rows, bad)


def test_error_counts_merge_and_empty(rows):
    counts = {r.error: r.failures for r in v.error_counts(rows, RULES + RULES).collect()}
    assert counts == {"'A' must not be null or empty": 4, "'A' is not a valid int": 2, "'A' exceeds max length 3": 2}
    assert v.error_counts(rows, []).count() == 0


def test_split_write_counts(rows, spark):
    path = new_folder(spark, "split")
    assert v.write_split(rows, RULES, path) == {"accepted": 1, "rejected": 4}
    v.validate(rows, {"rules": RULES, "output_path": path})
    stored = spark.read.parquet(path).groupBy("outcome").count().collect()
    assert {tuple(r) for r in stored} == {("rejected", 8), ("accepted", 2)}


def test_sides_to_their_own_paths(rows, spark):
    good, bad = new_folder(spark, "good"), new_folder(spark, "bad")
    v.validate(rows, {"rules": RULES, "validated_path": good, "error_path": bad})
    assert spark.read.parquet(good).columns == ["A"] and spark.read.parquet(good).count() == 1
    assert spark.read.parquet(bad).filter("_validation_errors <> '' and not _is_valid").count() == 4
    text = new_folder(spark, "text")
    v.validate(rows, {"rules": RULES, "error_path": text, "layout": [{"name": "A", "length": 6}]})
    assert sorted(r.value for r in spark.read.text(text).collect()) == [" " * 6, " " * 6, "12345 ", "x     "]


# ---- reconciliation and alerts -------------------------------------------------------

def test_compare_counts_keeps_every_feed(spark):
    expected = spark.createDataFrame([("a", "4"), ("b", "x"), ("c", "2")], "feed string, `REC_CNT` string")
    data = spark.createDataFrame([("a",), ("a",), ("b",), ("d",)], "feed string")
    out = reconcile.compare_counts(expected, data, minus=2)
    got = {r.feed: (r.expected_count, r.actual_count, r.matches) for r in out.collect()}
    assert got == {"a": (2, 2, True), "b": (None, 1, False), "c": (0, 0, True), "d": (None, 1, False)}
    with pytest.raises(reconcile.CountMismatch):
        reconcile.require_counts(out)
    assert reconcile.require_counts(out.filter("matches")).count() == 2
    keys = {r.alert_key for r in alerts.count_alerts(out, "flow").collect()}
    assert keys == {f"feedmill.flow.{f}.record_count_check_failed" for f in "bd"}
    with pytest.raises(ValueError, match="no count column"):
        reconcile.count_column(["A", "B"])


def test_missing_dates_and_continuity_skip_closed_days(spark):
    days = ["2026-03-02", "2026-03-03", "2026-03-05", "2026-03-09"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    got = {str(r[0]) for r in reconcile.missing_dates(df, "d", ["2026-03-04"], skip_weekends=True).collect()}
    assert got == {"2026-03-06"}
    out = reconcile.continuity(df, F.col("d"), F.col("d"), ["2026-03-04"], True).collect()
    with pytest.raises(reconcile.BrokenContinuity):
        reconcile.require_complete(reconcile.missing_dates(df, "d"))
    reconcile.require_complete(reconcile.missing_dates(df, "d", ["2026-03-04", "2026-03-06"], True))
    checked = reconcile.continuity(df, F.col("d"), F.col("d"), ["2026-03-04"], True)
    with pytest.raises(reconcile.BrokenContinuity):
        reconcile.require_continuity(checked)
    assert reconcile.require_continuity(checked.filter("status = 'ok'")).count() == 2
    assert {(str(r.file_date), r.status) for r in out} == {
        ("2026-03-03", "ok"), ("2026-03-05", "ok"), ("2026-03-09", "missing")}


@pytest.mark.parametrize("kind, suffix", [
    ("previous_run_missing", "last_run_file_missing"), ("input_missing", "input_file_missing")])
def test_missing_date_alerts(spark, kind, suffix):
    days = spark.createDataFrame([(dt.date(2026, 3, 4),)], "missing_date date")
    row = alerts.missing_date_alerts(days, "flow", "F.DAT", kind).first()
    assert (row.alert_key, row.severity) == (f"feedmill.flow.F.DAT.2026-03-04.{suffix}", "CRITICAL")


def test_alert_levels(spark):
    one = spark.range(1)
    row = alerts.alerts(one, "generic", "f", F.lit("s"), F.lit("text"), {"n": F.col("id")}, "low").first()
    assert (row.severity_code, row.alert_key, row.tags) == (2, "feedmill.f.s.generic", {"pipeline": "f", "n": "0"})
    assert alerts.SEVERITIES["HIGH"] == 4
    for kind, level in (("nope", None), ("generic", "URGENT")):
        with pytest.raises(ValueError):
            alerts.alerts(one, kind, "f", F.lit("s"), F.lit("t"), severity=level)


# ---- tables and databases ------------------------------------------------------------

@pytest.mark.parametrize("mode, expected", [
    (None, ("append", "false")), ("INSERT", ("append", "false")), ("TRUNCATE_INSERT", ("overwrite", "true")),
    ("replace", ("overwrite", "true"))])
def test_load_options(mode, expected):
    save, options = jdbc.load_options({"host": "h", "service_name": "S", "schema": "O", "table": "T",
                                       "load_mode": mode, "user": "u"})
    assert (save, options["truncate"]) == expected
    assert options["url"] == "jdbc:oracle:thin:@//h:1521/S"
    assert (options["dbtable"], options["batchsize"], options["user"]) == ("O.T", "10000", "u")


@pytest.mark.parametrize("logic", [
    {"host": "h", "service_name": "S"}, {"table": "T", "host": "h"}, {"url": "jdbc:x", "table": "T", "load_mode": "UPSERT"}])
def test_load_refuses(logic):
    with pytest.raises(ValueError):
        jdbc.load_options(logic)


@pytest.mark.parametrize("spark_type, expected", [
    ("string", "CHAR"), ("bigint", "INTEGER EXTERNAL"), ("short", "INTEGER EXTERNAL"), ("byte", "INTEGER EXTERNAL"),
    ("long", "INTEGER EXTERNAL"), ("int", "INTEGER EXTERNAL"), ("double", "DECIMAL EXTERNAL"),
    ("decimal(18,4)", "DECIMAL EXTERNAL"), ("date", 'DATE "YYYY-MM-DD"'),
    ("timestamp", 'TIMESTAMP "YYYY-MM-DD HH24:MI:SS"'), ("boolean", "CHAR"), ("binary", "RAW"), ("unknown_type", "CHAR")])
def test_loader_types(spark_type, expected):
    assert jdbc.loader_type(spark_type) == expected


def test_output_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "INP_CUST_ID int, NAME int, `X-Y` int")
    assert tables.output_columns(df, []).columns == df.columns
    assert tables.output_columns(df).columns == df.columns
    assert tables.output_columns(df, ["X-Y", "OUT_CUST_ID"]).columns == ["X_Y", "OUT_CUST_ID"]
    assert tables.output_columns(df, None, [{"name": "OUT-CUST-ID"}, {"name": "X-Y"}]).columns == ["OUT-CUST-ID", "X-Y"]


class _Unset:
    """A session without a shared folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(_Unset("local[2]")) == shared_folder(_Unset("local[2]"))
    with pytest.raises(RuntimeError, match="all executors share"):
        shared_folder(_Unset("yarn"))
    stored = cut(spark.range(5).withColumn("x", F.lit(None).cast("string")))
    assert stored.count() == 5 and "Range" not in stored._jdf.queryExecution().toString()


def test_row_steps_run_on_a_stream(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "A string, n long"
    spark.createDataFrame([("1", 5), ("x", 6), ("2", 1)], schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    kept = run_step({"type": "filter", "input": "s", "conditions": [{"field": "n", "operation": ">", "value": 2}]},
                    {"s": stream})[1]
    flagged = v.annotate(kept, RULES)
    query = flagged.writeStream.format("memory").queryName("flagged").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(60)
    assert {(r.A, r._is_valid) for r in spark.table("flagged").collect()} == {("1", True), ("x", False)}


_PLAIN = [{"name": "ID", "type": "long", "length": 6}, {"name": "CODE", "length": 3}]


def test_part_files_are_one_feed(spark, tmp_path):
    path = str(tmp_path / "feed")
    rows = spark.range(100).selectExpr("id AS ID", "'abc' AS CODE").repartition(4, "ID")
    write_fixed(rows, _PLAIN, path, 1, 1)
    assert read_fixed(spark, path, _PLAIN, 1, 1).data.count() == 100
    with pytest.raises(SparkRuntimeException, match="part file"):
        read_fixed(spark, path, _PLAIN, 1, 1, unit="file").data.count()


def test_enveloped_feeds_refuse_append(spark, tmp_path):
    rows = spark.range(3).selectExpr("id AS ID", "'abc' AS CODE")
    path = str(tmp_path / "feed")
    for call in (
        lambda: write_fixed(rows, _PLAIN, path, 1, 1, mode="append"),
        lambda: write_feeds(rows, "CODE", _PLAIN[:1], path, mode="append"),
        lambda: tables.write_delimited_enveloped(rows, path, "|", 1, 1, mode="append"),
    ):
        with pytest.raises(ValueError, match="cannot append"):
            call()
    with pytest.raises(ValueError, match="needs fields"):
        write_fixed(rows, [], path)


def test_wide_decimals_are_exact_or_refused(spark):
    wide = Decimal("1234567890123456789012.34")
    df = spark.createDataFrame([(wide,), (-wide,), (Decimal("0.05"),), (None,)], "AMT decimal(38,2)")
    field = {"name": "AMT", "type": "decimal", "precision": 2, "length": 26}
    lines = to_lines(df, [field])
    assert [r.value for r in lines.collect()] == [
        "00123456789012345678901234", "-0123456789012345678901234", "0" * 25 + "5", " " * 26]
    back = parse_fixed(lines, Layout.of([field])).collect()
    assert [r.AMT for r in back] == [wide, -wide, Decimal("0.05"), None]
    with pytest.raises(SparkRuntimeException, match="does not fit"):
        to_lines(df, [{**field, "length": 12}]).collect()


def test_feeds_with_other_names_are_refused(spark, tmp_path):
    (tmp_path / "one.csv").write_text("H\nA,B\n1,2\n")
    (tmp_path / "two.csv").write_text("H\nB,A\n1,2\n")
    with pytest.raises(ValueError, match="differ in their line of names"):
        read_delimited(spark, str(tmp_path), [{"name": "A"}, {"name": "B"}], header_count=1)


def test_names_are_written_and_read_as_csv(spark, tmp_path):
    path = str(tmp_path / "names")
    tables.write_delimited_enveloped(spark.createDataFrame([("1", "2")], "`A|X` string, B string"), path, "|", 1, 1)
    assert read_delimited(spark, path, (), "|", 1, 1).columns == ["A|X", "B"]


def test_output_names_prefer_the_closest_column(spark):
    df = spark.createDataFrame([(1, 2, 3)], "CUST_ID int, INP_CUST_ID int, NAME int")
    assert tables.output_columns(df, ["OUT-CUST-ID"]).first()[0] == 1
    assert tables.output_columns(df.drop("CUST_ID"), ["OUT-CUST-ID"]).first()[0] == 2
    with pytest.raises(ValueError, match="could come from any of"):
        tables.output_columns(spark.createDataFrame([(1, 2)], "A_CUST_ID int, B_CUST_ID int"), ["OUT_CUST_ID"])


def test_dated_range_opens_only_wanted_days(spark, tmp_path):
    for name in ("20260301", "load_date=20260302", "20260303"):
        folder = tmp_path / "DAILY" / name
        folder.mkdir(parents=True)
        (folder / "F.DAT").write_text("000001abc\n")
    feed = read_dated(spark, str(tmp_path), "daily", days_between(dt.date(2026, 3, 1), dt.date(2026, 3, 2)), _PLAIN)
    assert sorted(r.load_date for r in feed.data.collect()) == ["20260301", "20260302"]
    assert len(feed.data.inputFiles()) == 2


def test_header_references_stay_with_their_feed(spark):
    data = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "feed string, N int")
    header = spark.createDataFrame([("a", 0, "20260301"), ("a", 1, "x"), ("b", 0, "20260302")], "feed string, line_no int, FILE_DATE string")
    fields = [{"name": "CNT", "type": "INT", "length": 3}, {"name": "DAY", "length": 8, "expression": "first(FILE-DATE)"}]
    lines = totals.control_lines_by(data, ["feed"], fields, header)
    assert {r.feed: r.value for r in lines.collect()} == {"a": "00220260301", "b": "00120260302"}
    # Spark wraps what a scalar subquery raises.
    with pytest.raises(Py4JJavaError, match="several feeds"):
        totals.control_line(data, fields, header=header).collect()
    assert totals.control_line(data, fields, header=header.where("feed = 'a'")).first().value == "00320260301"


# ---- exact numbers --------------------------------------------------------------------

def test_control_numbers_are_exact_or_raise(spark):
    df = spark.createDataFrame([(8.9985e10, 6000, Decimal("89985000000.00"), 1e-5)], "d double, n long, m decimal(18,2), s double")

    def line(kind, length, expression, **more):
        on_overflow = more.pop("on_overflow", "error")
        field = {"name": "X", "type": kind, "length": length, "expression": expression} | more
        return totals.control_line(df, [field], on_overflow=on_overflow).first().value

    assert line("LONG", 15, "sum(d)") == "000089985000000"
    assert line("LONG", 15, "-sum(d)") == "-00089985000000"
    assert line("INT", 4, "sum(n)") == "6000" and line("INT", 5, "-sum(n)") == "-6000"
    assert line("DOUBLE", 14, "sum(d)") == " 89985000000.0" and line("DOUBLE", 8, "sum(s)") == " 0.00001"
    assert line("DECIMAL", 14, "sum(m)") == "89985000000.00" and line("DECIMAL", 14, "sum(d)", precision=1) == " 89985000000.0"
    assert line("STRING", 13, "sum(d)") == "89985000000.0"
    assert line("LONG", 6, "cast(null as long)") == "000000" and line("DOUBLE", 3, "cast(null as double)") == "   "
    for kind, length, expression in (("INT", 3, "sum(n)"), ("LONG", 10, "sum(d)"), ("DOUBLE", 8, "sum(d)"), ("DECIMAL", 8, "sum(m)"), ("INT", 4, "-sum(n)")):
        with pytest.raises(SparkRuntimeException, match="does not fit"):
            line(kind, length, expression)
    assert line("INT", 3, "sum(n)", on_overflow="truncate") == "600"
    for value in ("'abc'", "double('NaN')", "1e300"):
        with pytest.raises(SparkRuntimeException, match="not a number"):
            line("LONG", 15, f"max({value})")


def test_floating_numbers_in_data_lines(spark):
    layout = Layout.of([{"name": "N", "type": "long", "length": 10}, {"name": "D", "type": "double", "length": 12}, {"name": "S", "length": 12}])
    df = spark.createDataFrame([(2.9995e7, 2.9995e7, 1.5), (None, -0.5, None), (-3.0, 1e-7, 0.25)], "N double, D double, S double")
    assert [r.value for r in to_lines(df, layout).collect()] == [
        "  29995000  29995000.01.5         ", "                  -0.5            ", "        -3   0.00000010.25        "]
    with pytest.raises(SparkRuntimeException, match="does not fit"):
        to_lines(spark.createDataFrame([(1e10,)], "N double"), layout).collect()
    text = to_lines(spark.createDataFrame([("x1",)], "N string"), layout).first().value
    assert text == "        x1" + " " * 24


def test_lines_are_never_cut(spark, tmp_path):
    df = spark.range(1, 4).selectExpr("id * 100000000 as N")
    data, trailer = [{"name": "N", "type": "long", "length": 9}], [{"name": "T", "length": 3, "expression": "'TRL'"}, {"name": "SUM", "type": "long", "length": 12, "expression": "sum(N)"}]
    path = str(tmp_path / "wide")
    write_fixed(df, data, path, 0, 1, trailer_fields=trailer)
    assert sorted(r.value for r in spark.read.text(path).collect())[-1] == "TRL   600000000"
    with pytest.raises(ValueError, match="place 15 of a record of 9"):
        write_fixed(df, Layout.of(data, 9), path, 0, 1, trailer_fields=trailer)
    with pytest.raises(ValueError, match="place 9 of a record of 6"):
        write_fixed(df, Layout.of(data, 6), path)
    short = [{"name": "SUM", "length": 4, "expression": "sum(N)"}]
    with pytest.raises(SparkRuntimeException, match="does not fit"):
        write_fixed(df, data, path, 1, 0, header_fields=short)


# ---- one pass --------------------------------------------------------------------------

@pytest.mark.parametrize("logic", [
    {"mode": "ABORT"}, {"mode": "DROP", "validated_path": "a", "error_path": "b"}, {"mode": "FLAG", "validated_path": "a", "error_path": "b"},
    {"mode": "FLAG", "output_path": "o", "on_invalid": "abort"}])
def test_gates_sinks_and_result_share_one_pass(spark, tmp_path, logic):
    (tmp_path / "rows.txt").write_text("".join(f"{k}\n" for k in range(300)))
    logic = {k: str(tmp_path / v) if k.endswith("path") else v for k, v in logic.items()}
    rules = [{"field": "value", "data_type": "int", "nullable": False}]
    nodes = plan_nodes(spark)
    found = v.validate(spark.read.text(str(tmp_path / "rows.txt")), {"rules": rules, **logic})
    assert found.count() == 300
    assert text_scans(nodes()) == 1
    for name, count in (("a", 300), ("b", 0)):
        if (tmp_path / name).exists():
            assert spark.read.parquet(str(tmp_path / name)).count() == count
    if "output_path" in logic:
        assert spark.read.parquet(logic["output_path"]).groupBy("outcome").count().collect() == [("accepted", 300)]


def test_gate_reports_a_few_errors(spark):
    rows = spark.range(0, 1000, 1, 4).selectExpr("concat('x', id) as A")
    with pytest.raises(v.InvalidRows) as error:
        v.require_valid(rows, [{"field": "A", "data_type": "int"}])
    assert error.value.count == 1000 and 1 <= len(error.value.samples) <= 5


def test_ends_agree_with_a_source_that_changes(spark, tmp_path):
    """Header, trailer, control file and data are those of one reading of the source."""
    # Every run of the plan draws other numbers.
    drawn = F.expr("cast(java_method('java.lang.Math', 'random') as double)")
    changing = spark.range(0, 400, 1, 4).select(F.col("id").alias("N"), F.floor(drawn * 1000).cast("long").alias("V")).where("V < 500")
    fields = [{"name": "N", "type": "long", "length": 6}, {"name": "V", "type": "long", "length": 6}]
    trailer = [{"name": "T", "length": 1, "expression": "'T'"}, {"name": "C", "type": "long", "length": 5, "expression": "count(*)"},
               {"name": "S", "type": "long", "length": 12, "expression": "sum(V)"}]
    path = str(tmp_path / "out")
    write_output(changing, {"format": "fixed", "path": path, "fields": fields, "header_count": 1, "trailer_count": 1,
                            "header_fields": trailer[1:], "trailer_fields": trailer, "control_file_path": f"{path}-count"}, dt.date(2026, 3, 1))
    feed = read_fixed(spark, path, fields, 1, 1, [{"name": "C", "length": 5}, {"name": "S", "length": 12}],
                      [{"name": "T", "length": 1}, {"name": "C", "length": 5}, {"name": "S", "length": 12}])
    n, total = feed.data.agg(F.count("*"), F.sum(F.col("V").cast("long"))).first()
    for end in (feed.header, feed.trailer):
        row = end.first()
        assert (int(row.C), int(row.S)) == (n, total)
    assert int(spark.read.text(f"{path}-count").first().value) == n


def test_text_meets_numbers_exactly(spark):
    rows = spark.createDataFrame([("9007199254740993",), ("9007199254740992",), ("0.1",), ("1e400",), ("123456789012345678901234",), ("x",), (None,)], "v string")

    def kept(operation, value):
        return [r.v for r in run_step({"id": "f", "type": "filter", "input": "d", "logic": {"conditions": [
            {"field": "v", "operation": operation, "value": value}]}}, {"d": rows})[1].collect()]

    assert kept("==", 9007199254740993) == ["9007199254740993"] and kept("in", [9007199254740992, 7]) == ["9007199254740992"]
    assert kept("==", 0.1) == ["0.1"] and kept("<", 9007199254740993) == ["9007199254740992", "0.1"]
    assert kept(">", 1e22) == ["1e400", "123456789012345678901234"]
    assert kept("not_in", [0.1]) == ["9007199254740993", "9007199254740992", "1e400", "123456789012345678901234"]


def test_days_are_replaced_one_by_one(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(0, 900).select("id", F.date_add(F.lit(dt.date(2026, 3, 1)), F.when(F.col("id") < 800, 0).otherwise((F.col("id") % 3).cast("int"))).alias("day"))
    tables.write_days(rows, F.col("day"), base, "daily")
    before = {p.name: sorted(x.name for x in p.iterdir()) for p in (tmp_path / "DAILY").glob("load_date=*")}
    assert len(before) == 3
    tables.write_days(rows.where("day = date'2026-03-02'").limit(4), F.col("day"), base, "DAILY")
    after = {p.name: sorted(x.name for x in p.iterdir()) for p in (tmp_path / "DAILY").glob("load_date=*")}
    assert {k for k in before if before[k] != after[k]} == {"load_date=20260302"}
    assert spark.read.parquet(f"{base}/DAILY/load_date=20260302").count() == 4
    with pytest.raises(SparkRuntimeException, match="no day"):
        tables.write_days(rows, F.lit(None).cast("date"), base, "DAILY")
