"""Whole flows: declared inputs, steps and outputs."""

import datetime as dt

import pytest

from checks import plan_nodes, text_scans
from feedmill.operators.reconcile import BrokenContinuity, CountMismatch, MissingInput
from feedmill.plans.flow import declared_path, read_input, run_flow
from feedmill.plans.steps import run_steps, shared_frames
from feedmill.sources.lines import read_lines, with_positions

DAY = dt.date(2026, 3, 1)


def _txn(tmp_path, rows):
    source = tmp_path / "in" / "DAILY" / "20260301"
    source.mkdir(parents=True)
    (source / "TXN.csv").write_text("TXN-ID,AMOUNT,TXN-TYPE,STATUS\n" + "\n".join(rows) + "\n")
    return {
        "Inputs": {"TXN": {"format": "csv", "source_path": str(tmp_path / "in"), "frequency": "daily",
                           "source_file_name": "TXN.csv", "partition_col": "load_date()"}},
        "Outputs": {"OUT": {"format": "csv", "source_path": str(tmp_path / "out"), "frequency": "DAILY",
                            "fields": [{"name": "TXN-ID"}, {"name": "AMOUNT", "type": "long"}]}},
        "Transformations": {"steps": [
            {"id": "f", "type": "filter", "source_inputs": ["TXN"], "output_alias": "KEPT",
             "logic": {"conditions": [{"field": "AMOUNT", "operation": ">", "value": 0}]}}]},
    }


ROWS = ["T001,100,CR,OK", "T002,-5,DR,OK", "T003,60,DR,OK", "T004,0,CR,BAD", "T005,7,CR,OK"]


def test_reported_flow(spark, tmp_path):
    config = _txn(tmp_path, ROWS)
    counts = run_flow(spark, config, DAY, dry_run=True)["row_counts"].collect()
    assert [tuple(r) for r in counts] == [("OUT", 3)]
    assert not (tmp_path / "out").exists()
    run_flow(spark, config, DAY)
    written = spark.read.option("header", True).csv(str(tmp_path / "out" / "DAILY" / "20260301"))
    assert written.columns == ["TXN-ID", "AMOUNT"]
    assert sorted(r["TXN-ID"] for r in written.collect()) == ["T001", "T003", "T005"]


def test_empty_result(spark, tmp_path):
    config = _txn(tmp_path, ["T001,-1,CR,OK"])
    assert run_flow(spark, config, DAY)["OUT"].count() == 0


FIELDS = [{"name": "ID", "type": "long", "length": 6}, {"name": "AMT", "type": "decimal", "precision": 2, "length": 8}]
TRAILER = [{"name": "REC", "length": 3, "expression": "'TRL'"},
           {"name": "REC-CNT", "length": 6, "expression": "lpad(count(*) + 2, 6, '0')"}]


def _feed(path, n, declared):
    lines = ["HDR20260301"] + [f"{i:06d}{i * 150:08d}" for i in range(n)] + [f"TRL{declared:06d}"]
    path.write_text("\n".join(lines) + "\n")


def _feed_config(tmp_path):
    return {
        "Inputs": {"F": {"format": "fixed", "path": str(tmp_path / "F.DAT"), "fields": FIELDS, "header_count": 1,
                         "trailer_count": 1, "header_fields": [{"name": "FILE-DATE", "start": 4, "length": 8}],
                         "trailer_fields": [{"name": "REC-CNT", "start": 4, "length": 6}]}},
        "Transformations": {"steps": [
            {"id": "v", "type": "validate", "source_inputs": ["F"], "logic": {
                "rules": [{"field": "ID", "data_type": "long", "nullable": False}], "fail_mode": "DROP",
                "record_count_check": True, "record_count_trailer_field": "REC-CNT",
                "header_count": 1, "trailer_count": 1}},
            {"id": "c", "type": "ctrl_file", "source_inputs": ["v"], "logic": {
                "path": str(tmp_path / "ctl"), "header_input": "F_header", "ctrl_file_fields": [
                    {"name": "CNT", "type": "INT", "length": 5},
                    {"name": "DAY", "length": 8, "expression": "first(FILE-DATE)"}]}}]},
        "Outputs": {"OUT": {"format": "fixed", "path": str(tmp_path / "out"), "source_inputs": ["c"], "fields": FIELDS,
                            "record_length": 20, "header_count": 1, "trailer_count": 1, "trailer_fields": TRAILER,
                            "control_file_path": str(tmp_path / "count")}},
    }


def test_feed_flow(spark, tmp_path):
    _feed(tmp_path / "F.DAT", 50, 52)
    run_flow(spark, _feed_config(tmp_path), DAY)
    back = read_input(spark, "B", {"format": "fixed", "path": str(tmp_path / "out"), "fields": FIELDS,
                                   "header_count": 1, "trailer_count": 1, "trailer_fields": TRAILER,
                                   "unit": "directory"}, DAY)
    assert back["B"].count() == 50 and back["B_trailer"].first().REC_CNT == "000052"
    assert str(back["B"].agg({"AMT": "sum"}).first()[0]) == "1837.50"
    assert spark.read.text(str(tmp_path / "ctl")).first().value == "0005020260301"
    assert spark.read.text(str(tmp_path / "count")).first().value == "50"


def test_wrong_trailer_count_stops_the_flow(spark, tmp_path):
    _feed(tmp_path / "F.DAT", 50, 51)
    with pytest.raises(CountMismatch):
        run_flow(spark, _feed_config(tmp_path), DAY)
    assert not (tmp_path / "out").exists()


def test_paths_and_formats(spark, tmp_path):
    assert declared_path(spark, {"dataset_name": "A.DAT", "frequency": "weekly"}, DAY, "/raw") == \
        "/raw/WEEKLY/20260301/A.DAT"
    assert declared_path(spark, {"source_path": "/o", "frequency": "DAILY", "partition_col": "20250101"}, DAY,
                         output=True) == "/o/DAILY/20250101"
    for bad in ({}, {"path": "/x", "format": "avro"}):
        with pytest.raises(ValueError):
            read_input(spark, "A", bad, DAY)


def test_stored_step(spark):
    steps = [{"id": "s", "type": "filter", "input": "d", "store": True,
              "conditions": [{"field": "id", "operation": "<", "value": 3}]}]
    stored = run_steps({"d": spark.range(9)}, steps)["s"]
    assert stored.count() == 3 and "Range" not in stored._jdf.queryExecution().toString()


def _checked_flow(tmp_path, **options):
    config = _feed_config(tmp_path)
    config["Transformations"]["steps"][0]["logic"] |= options
    return config


def test_declared_checks_are_gates(spark, tmp_path):
    _feed(tmp_path / "F.DAT", 5, 7)
    before = tmp_path / "prev" / "DAILY" / "20260228"
    before.mkdir(parents=True)
    previous = {"previous_day_check": True, "previous_day_file_path": str(tmp_path / "prev"), "previous_day_frequency": "DAILY",
                "previous_day_file_name": "F.DAT",
                "previous_day_header_field": {"name": "FILE-DATE", "start": 4, "length": 8, "format": "YYYYMMDD"}}
    with pytest.raises(BrokenContinuity, match="missing"):
        run_flow(spark, _checked_flow(tmp_path, **previous), dt.date(2026, 3, 1))
    (before / "F.DAT").write_text("HDR20260227\nx\n")
    with pytest.raises(BrokenContinuity, match="wrong_date"):
        run_flow(spark, _checked_flow(tmp_path, **previous), dt.date(2026, 3, 1))
    (before / "F.DAT").write_text("HDR20260228\nx\n")
    run_flow(spark, _checked_flow(tmp_path, **previous), dt.date(2026, 3, 1))
    last = {"last_run_check": True, "last_run_file_path": str(tmp_path / "prev"), "last_run_frequency": "DAILY"}
    run_flow(spark, _checked_flow(tmp_path, **last), dt.date(2026, 3, 1))
    with pytest.raises(BrokenContinuity, match="missing"):
        run_flow(spark, _checked_flow(tmp_path, **last), dt.date(2026, 3, 5))
    with pytest.raises(ValueError, match="unknown validation options"):
        run_flow(spark, _checked_flow(tmp_path, previous_dya_check=True), DAY)


def test_trailer_counts_valid_rows(spark, tmp_path):
    _feed(tmp_path / "F.DAT", 5, 7)
    good = {"trailer_check": True, "trailer_count_field": "REC-CNT"}
    run_flow(spark, _checked_flow(tmp_path, **good), DAY)
    rules = [{"field": "ID", "check": "in_range", "params": {"min": 1}}]
    with pytest.raises(CountMismatch):
        run_flow(spark, _checked_flow(tmp_path, **good, rules=rules), DAY)


def test_count_file_of_an_input(spark, tmp_path):
    _feed(tmp_path / "F.DAT", 5, 7)
    config = _feed_config(tmp_path)
    config["Inputs"]["F"]["count_file_path"] = str(tmp_path / "F.CNT")
    (tmp_path / "F.CNT").write_text("5\n")
    run_flow(spark, config, DAY)
    (tmp_path / "F.CNT").write_text("6\n")
    with pytest.raises(CountMismatch):
        run_flow(spark, config, DAY)


# ---- options, missing inputs, shared results --------------------------------------------

@pytest.mark.parametrize("step, text", [
    ({"type": "filter", "logic": {"condition": [{"field": "AMOUNT", "operation": ">", "value": 0}]}}, "filter options .'condition'"),
    ({"type": "filter", "logic": {"conditions": [{"field": "AMOUNT", "operator": "<", "value": 0}]}}, "conditions: unknown options .'operator'"),
    ({"type": "filter", "logic": {}}, "needs conditions"),
    ({"type": "filter", "logic": {"conditions": []}, "source_input": "d"}, "unknown options .'source_input'"),
    ({"type": "aggregate", "logic": {"groupby": ["STATUS"], "aggregations": []}}, "aggregate options .'groupby'"),
    ({"type": "aggregate", "logic": {"group_by": ["STATUS"], "aggregation": []}}, "aggregate options .'aggregation'"),
    ({"type": "aggregate", "logic": {"aggregations": [{"field": "AMOUNT", "operation": "sum", "as": "x"}]}}, "unknown options .'as'"),
    ({"type": "select", "logic": {"expressions": [{"target": "A", "operation": "move", "expresion": "1"}]}}, "unknown options .'expresion'"),
    ({"type": "validate", "logic": {"rules": [{"field": "A", "nullabel": False}]}}, "rules: unknown options .'nullabel'"),
    ({"type": "union", "logic": {"distinct": True}}, "union options .'distinct'"),
    ({"type": "ctrl_file", "logic": {"path": "x", "ctrl_file_fields": [{"name": "N", "expresion": "count(*)"}]}}, "unknown options .'expresion'"),
])
def test_options_nobody_knows_are_refused(spark, step, text):
    df = spark.createDataFrame([("A", 1)], "STATUS string, AMOUNT long")
    with pytest.raises(ValueError, match=text):
        run_steps({"d": df}, [{"id": "s", "input": "d", **step}])


def test_remarks_are_no_options(spark):
    df = spark.range(3)
    step = {"id": "s", "type": "filter", "source_inputs": ["d"], "description": "all", "logic": {"conditions": [], "comment": "all", "_origin": 1}}
    assert run_steps({"d": df}, [step])["s"].count() == 3


@pytest.mark.parametrize("place, name, change, text", [
    ("Inputs", "TXN", {"filter": "AMOUNT > 0"}, "input 'TXN' of format csv: unknown options .'filter'"),
    ("Inputs", "TXN", {"record_length": 20}, "record_length"), ("Outputs", "OUT", {"compresion": "gzip"}, "compresion"),
    ("Outputs", "OUT", {"on_overflow": "truncate"}, "on_overflow"), ("Inputs", "TXN", {"if_missing": "ignore"}, "if_missing"),
    ("Outputs", "OUT", {"fields": [{"name": "A", "lenght": 3}]}, "lenght"), ("Inputs", "TXN", {"format": "avro"}, "unknown format 'avro'"),
])
def test_places_nobody_knows_are_refused(spark, tmp_path, place, name, change, text):
    config = _txn(tmp_path, ROWS)
    config[place][name] |= change
    with pytest.raises(ValueError, match=text):
        run_flow(spark, config, DAY)
    assert not (tmp_path / "out").exists()


def test_empty_options_of_other_formats_say_nothing(spark, tmp_path):
    config = _txn(tmp_path, ROWS)
    config["Inputs"]["TXN"] |= {"record_length": 0, "header_fields": []}
    assert run_flow(spark, config, DAY)["OUT"].count() == 3


@pytest.mark.parametrize("lines, right", [("5\n100\n", True), ("100\n5\n", False), ("five\n5\n", False), ("", False)])
def test_count_file_of_any_format_by_its_first_line(spark, tmp_path, lines, right):
    config = _txn(tmp_path, ROWS)
    (tmp_path / "count").write_text(lines)
    config["Inputs"]["TXN"]["count_file_path"] = str(tmp_path / "count")
    parquet = str(tmp_path / "p")
    spark.range(5).write.parquet(parquet)
    other = {"Inputs": {"P": {"path": parquet, "count_file_path": str(tmp_path / "count")}}, "Outputs": {"P": {"path": str(tmp_path / "o")}}}
    for flow in (config, other):
        if right:
            run_flow(spark, flow, DAY)
        else:
            with pytest.raises(CountMismatch):
                run_flow(spark, flow, DAY)


def test_inputs_that_were_not_delivered(spark, tmp_path):
    config = _txn(tmp_path, ROWS) | {"name": "daily", "alerts_path": str(tmp_path / "alerts")}
    late = {"format": "csv", "path": str(tmp_path / "late.csv"), "fields": [{"name": "TXN-ID"}, {"name": "AMOUNT", "type": "long"}]}
    config["Inputs"]["LATE"] = late
    with pytest.raises(MissingInput, match="LATE"):
        run_flow(spark, config, DAY)
    assert not (tmp_path / "out").exists()
    found = spark.read.parquet(str(tmp_path / "alerts")).collect()
    assert [(r.alert_key, r.kind, r.severity, r.tags["input"]) for r in found] == [
        ("feedmill.daily.LATE.input_file_missing", "input_missing", "CRITICAL", "LATE")]
    late["if_missing"] = "empty"
    config["Transformations"]["steps"].append({"id": "late", "type": "filter", "source_inputs": ["LATE"], "logic": {"conditions": []}})
    config["Outputs"]["OUT"]["source_inputs"] = ["KEPT"]
    config["Outputs"]["late"] = {"path": str(tmp_path / "late_out")}
    assert run_flow(spark, config, DAY)["late"].dtypes == [("TXN_ID", "string"), ("AMOUNT", "bigint")]
    assert spark.read.parquet(str(tmp_path / "late_out")).count() == 0
    config["Inputs"]["TXN"]["fields"] = []
    config["Transformations"]["steps"][0]["logic"]["conditions"][0]["field"] = "NOPE"
    with pytest.raises(ValueError):
        run_flow(spark, config, DAY)
    kinds = [r.kind for r in spark.read.parquet(str(tmp_path / "alerts")).collect()]
    assert sorted(kinds) == ["generic", "input_missing"]


@pytest.mark.parametrize("spec", [
    {"format": "parquet"}, {"format": "fixed", "header_count": 1, "header_fields": [{"name": "H", "length": 3}]},
    {"format": "ebcdic", "cobrix": {"generate_record_id": True}}, {"format": "csv"}])
def test_missing_inputs_of_every_format_have_their_columns(spark, tmp_path, spec):
    given = spec | {"path": str(tmp_path / "none"), "if_missing": "empty", "fields": [{"name": "A-B", "length": 4}]}
    found = read_input(spark, "X", given, DAY)
    assert "A_B" in found["X"].columns and found["X"].count() == 0
    assert spec["format"] != "fixed" or found["X_header"].columns == ["feed", "line_no", "H"]
    with pytest.raises(ValueError, match="declares no fields"):
        read_input(spark, "X", given | {"fields": []}, DAY)


def test_frames_used_twice_are_stored_once(spark, tmp_path):
    """Two outputs of one text input scan it once, and share the step both come from."""
    lines = "\n".join(f"{k:06d}{k * 100:08d}" for k in range(500))
    (tmp_path / "F.DAT").write_text(lines + "\n")
    config = {
        "Inputs": {"F": {"format": "fixed", "path": str(tmp_path / "F.DAT"), "fields": FIELDS}},
        "Outputs": {"low": {"path": str(tmp_path / "low")}, "high": {"path": str(tmp_path / "high")}, "all": {"path": str(tmp_path / "all"), "source_inputs": ["both"]}},
        "Transformations": {"steps": [
            {"id": "typed", "type": "select", "source_inputs": ["F"], "logic": {"expressions": [{"target": "N", "operation": "expression", "expression": "cast(ID as int)"}]}},
            {"id": "low", "type": "filter", "source_inputs": ["typed"], "logic": {"conditions": [{"field": "N", "operation": "<", "value": 100}]}},
            {"id": "high", "type": "filter", "source_inputs": ["typed"], "logic": {"conditions": [{"field": "N", "operation": ">=", "value": 400}]}},
            {"id": "both", "type": "union", "source_inputs": ["low", "high"], "logic": {}},
            {"id": "unused", "type": "filter", "source_inputs": ["F"], "logic": {"conditions": []}}]},
    }
    nodes = plan_nodes(spark)
    found = run_flow(spark, config, DAY)
    assert {k: df.count() for k, df in found.items()} == {"low": 100, "high": 100, "all": 200}
    assert text_scans(nodes()) == 1
    steps = config["Transformations"]["steps"]
    assert shared_frames(steps, ["F"], ["low", "high", "both"]) == {(0, "typed"), (1, "low"), (2, "high")}
    # What is stored is computed once, so its source is used once.
    assert shared_frames(steps, ["F"], ["low"]) == set()
    assert shared_frames([s | {"store": False} for s in steps], ["F"], ["low", "high"]) == {(0, "typed"), (-1, "F")}
    nodes = plan_nodes(spark)
    counts = run_flow(spark, config, DAY, dry_run=True)["row_counts"].collect()
    assert sorted(map(tuple, counts)) == [("all", 200), ("high", 100), ("low", 100)]
    assert text_scans(nodes()) == 1


def test_stored_results_keep_their_order(spark, tmp_path):
    """A sorted result that two outputs share is written in its order by both."""
    source = str(tmp_path / "in")
    spark.range(0, 2000, 1, 7).selectExpr("(id * 7919) % 2000 as N", "'x' as S").write.parquet(source)
    fields = [{"name": "N", "type": "long", "length": 6}]
    output = {"format": "fixed", "fields": fields, "header_count": 1, "source_inputs": ["checked"], "header_fields": [
        {"name": "C", "type": "long", "length": 6, "expression": "count(*)"}]}
    run_flow(spark, {
        "Inputs": {"D": {"path": source}},
        "Transformations": {"steps": [
            {"id": "sorted", "type": "custom", "source_inputs": ["D"], "logic": {"operation": "sort", "key": "N"}},
            {"id": "checked", "type": "validate", "source_inputs": ["sorted"], "logic": {"mode": "DROP", "on_invalid": "abort", "rules": [{"field": "N", "nullable": False}]}}]},
        "Outputs": {"A": output | {"path": str(tmp_path / "a")}, "B": output | {"path": str(tmp_path / "b")}}})
    for name in "ab":
        rows = with_positions(read_lines(spark, str(tmp_path / name)), "directory").orderBy("line_no").collect()
        assert [int(r.value) for r in rows] == [2000, *range(2000)]
