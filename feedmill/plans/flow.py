"""A declared flow: inputs, steps and outputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedmill.fields import Field, Layout
from feedmill.functions.dates import dated_path
from feedmill.operators import alerts
from feedmill.operators.reconcile import (
    BrokenContinuity, CountMismatch, MissingInput, compare_total, count_column, require_counts, require_delivered)
from feedmill.operators.validate import InvalidRows
from feedmill.plans.options import check_flow, check_input, check_output, format_of
from feedmill.plans.steps import _alias, resolve_outputs, row_counts, run_steps, shared_frames
from feedmill.session import keep
from feedmill.sinks import fixed as fixed_sink
from feedmill.sinks import tables as table_sinks
from feedmill.sources.ebcdic import parse_records, read_ebcdic
from feedmill.sources.fixed import parse_envelope, parse_fixed, read_fixed
from feedmill.sources.inventory import input_listing, path_exists
from feedmill.sources.lines import feed_ends, read_lines
from feedmill.sources.tables import empty_frame, read_delimited, read_parquet

Spec = Mapping[str, Any]


def _number(spec: Spec, key: str) -> int:
    return int(spec.get(key) or 0)


def _delimiter(spec: Spec) -> str:
    return spec.get("delimiter_char") or spec.get("delimiter") or ","


def declared_path(
    spark: SparkSession, spec: Spec, run_date: dt.date, base: str = "", output: bool = False
) -> str:
    """Path of an input or output.

    ``path`` is taken as it is. ``source_path`` (or ``base``, for an entry that
    only names its dataset) is followed by frequency, date and, for inputs, the
    file name.
    """
    if spec.get("path"):
        return spec["path"]
    folder = spec.get("source_path") or base
    if not folder:
        raise ValueError(f"no path declared: {dict(spec)}")
    name = "" if output else spec.get("source_file_name") or spec.get("dataset_name") or ""
    return dated_path(
        spark, folder, spec.get("frequency") or "", run_date, spec.get("partition_col") or "", name
    )


def _require_count(spark: SparkSession, data: DataFrame, spec: Spec) -> None:
    """Gate on the input's count file, its first line: a plain number, or a record with a
    count field. Inputs of every format may have one."""
    first = feed_ends(read_lines(spark, spec["count_file_path"]), header_count=1)[0]
    fields = spec.get("control_fields") or []
    if fields:
        first = parse_fixed(first, Layout.of(fields), "line_no")
        expected = F.col(count_column([c for c in first.columns if c != "line_no"]))
    else:
        expected = F.col("value")
    require_counts(compare_total(data, expected, first))


def _controls(spec: Spec, steps: list[Spec]) -> list[dict[str, Any]]:
    """The control steps that feed an output and declare a file beside it."""
    found = []
    for step in steps:
        logic = {**{k: v for k, v in step.items() if k != "logic"}, **(step.get("logic") or {})}
        feeds = (step.get("output_alias") or step.get("id")) in (spec.get("source_inputs") or [])
        if step.get("type") == "ctrl_file" and feeds and logic.get("ctrl_file_name") and logic.get("ctrl_file_fields"):
            found.append(logic)
    return found


def write_curated_control(
    df: DataFrame, spec: Spec, steps: list[Spec], run_date: dt.date, frames: Mapping[str, DataFrame], base: str = ""
) -> None:
    """The control file of an output, beside its directory, if a control step feeds it.

    ``df`` are the stored rows that were written. A control step feeds an output
    when the output names the step's result among its sources.
    """
    for logic in _controls(spec, steps):
        folder = declared_path(df.sparkSession, spec, run_date, base, output=True).rstrip("/").rpartition("/")[0]
        table_sinks.write_control_file(
            df, f"{folder}/{logic['ctrl_file_name']}", logic["ctrl_file_fields"], bool(logic.get("ctrl_include_header")),
            frames.get(logic.get("header_input") or ""))


def _not_delivered(spark: SparkSession, name: str, spec: Spec) -> dict[str, DataFrame]:
    """Frames without rows, in the columns that the input would have."""
    fields, kind = spec.get("fields") or [], format_of(spec)
    if not fields:
        raise ValueError(f"input '{name}' was not delivered and declares no fields to stand for it")
    if kind == "fixed":
        lines = spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in (("value", "string"), ("feed", "string"), ("line_no", "bigint"))])
        return {
            name: parse_fixed(lines, Layout.of(fields), "feed"),
            f"{name}_header": parse_envelope(lines, spec.get("header_fields") or []),
            f"{name}_trailer": parse_envelope(lines, spec.get("trailer_fields") or [])}
    if kind == "cobol":
        numbered = bool((spec.get("cobrix") or {}).get("generate_record_id"))
        return {name: parse_records(spark.range(0).select(
            F.lit("").alias("path"), F.col("id").alias("record_id"), F.lit(b"").alias("record")), fields,
            (spec.get("cobrix") or {}).get("encoding") or "cp037", numbered)}
    return {name: empty_frame(spark, fields)}


def read_input(
    spark: SparkSession, name: str, spec: Spec, run_date: dt.date, base: str = ""
) -> dict[str, DataFrame]:
    """Frames of one input: itself and, for feeds, ``<name>_header``/``_trailer``.

    A path that is not there is an error; with ``if_missing: empty`` the input has no rows
    then, in its declared columns. A count file is compared with the rows of the input.
    """
    check_input(name, spec)
    path = declared_path(spark, spec, run_date, base)
    if spec.get("if_missing") == "empty" and not path_exists(spark, path):
        return _not_delivered(spark, name, spec)
    kind = format_of(spec)
    fields, unit = spec.get("fields") or [], spec.get("unit") or "auto"
    if kind == "parquet":
        found = {name: read_parquet(spark, path)}
    elif kind == "csv":
        found = {
            name: read_delimited(
                spark, path, fields, _delimiter(spec), _number(spec, "header_count"),
                _number(spec, "trailer_count"), unit,
            )
        }
    elif kind == "fixed":
        feed = read_fixed(
            spark, path, Layout.of(fields, _number(spec, "record_length")),
            _number(spec, "header_count"), _number(spec, "trailer_count"),
            spec.get("header_fields") or [], spec.get("trailer_fields") or [], unit,
        )
        found = {name: feed.data, f"{name}_header": feed.header, f"{name}_trailer": feed.trailer}
    else:
        options = spec.get("cobrix") or {}
        found = {
            name: read_ebcdic(
                spark, path, fields, _number(spec, "record_length"),
                options.get("encoding") or "cp037", _number(options, "file_start_offset"),
                _number(options, "file_end_offset"), bool(options.get("generate_record_id")),
            )
        }
    if spec.get("count_file_path"):
        _require_count(spark, found[name], spec)
    return found


def write_output(
    df: DataFrame, spec: Spec, run_date: dt.date, base: str = "", stored: bool = False
) -> None:
    """Write one output in its declared columns, format and mode.

    ``stored`` says that its rows are; else those of a feed with header, trailer or control
    file are stored first, so that all of them agree.
    """
    check_output(str(spec.get("name") or spec.get("dataset_name") or "output"), spec)
    path = declared_path(df.sparkSession, spec, run_date, base, output=True)
    kind = format_of(spec)
    mode = str(spec.get("write_mode") or "overwrite").lower()
    ends = _number(spec, "header_count"), _number(spec, "trailer_count")
    chosen = spec.get("output_columns", spec.get("columns"))
    fields = [Field.of(f) for f in spec.get("fields") or []]
    shown = table_sinks.output_columns(df, chosen, fields)
    if not shown.columns:
        # No name matches: fields map to columns by position.
        shown = df
    if not (chosen or fields) or shown is df:
        shown = shown.drop("feed")
    if kind in ("fixed", "cobol"):
        layout = Layout.of(spec.get("fields") or [], _number(spec, "record_length"))
        if spec.get("control_file_path") and not stored:
            shown, stored = keep(shown), True
            df = shown
        fixed_sink.write_fixed(
            shown, layout, path, *ends,
            spec.get("header_fields") or [], spec.get("trailer_fields") or [], mode,
            spec.get("on_overflow") or "error", stored,
        )
        if spec.get("control_file_path"):
            control, fields = spec["control_file_path"], spec.get("control_fields") or []
            if fields:
                table_sinks.write_count_record(df, control, fields, mode)
            else:
                table_sinks.write_control_file(df, control, mode=mode)
        return
    if kind == "parquet":
        table_sinks.write_parquet(shown, path, mode)
    elif any(ends):
        table_sinks.write_delimited_enveloped(shown, path, _delimiter(spec), *ends, mode)
    else:
        table_sinks.write_delimited(shown, path, _delimiter(spec), mode)


def _wanted(inputs: Mapping[str, DataFrame], steps: list[Spec], outputs: Mapping[str, Spec]) -> list[str]:
    """The frames the outputs are written from, each as often as it is."""
    results = [_alias(step) for step in steps]
    found = []
    for name, spec in outputs.items():
        candidates = [name, *(spec.get("source_inputs") or [])]
        hit = next((c for c in candidates if c in results), name if name in inputs else None)
        if hit is None and len(outputs) == 1:
            hit = results[-1] if results else None
        found += [hit] if hit else []
    return found


# What ends a flow -> the kind of its alert.
_ENDINGS = {CountMismatch: "record_count", BrokenContinuity: "continuity", InvalidRows: "validation"}


def run_flow(
    spark: SparkSession,
    config: Spec,
    run_date: dt.date | None = None,
    dry_run: bool = False,
    input_base: str = "",
    output_base: str = "",
) -> dict[str, DataFrame]:
    """Load inputs, apply steps, write outputs; returns the frame of each output.

    All options are checked first, then whether all inputs were delivered: one that was not
    stops the flow, unless it says ``if_missing: empty``. With ``alerts_path`` a flow that
    stops adds its alerts to that table. A frame that several outputs or steps compute
    from is stored once. A dry run writes nothing and returns ``row_counts`` of the outputs instead.
    """
    check_flow(config)
    day = run_date or dt.date.today()
    name, path = str(config.get("name") or "flow"), config.get("alerts_path")
    declared = config.get("Inputs") or {}
    listing = input_listing(spark, {k: declared_path(spark, spec, day, input_base) for k, spec in declared.items()
                                    if spec.get("if_missing") != "empty"})
    try:
        require_delivered(listing)
        return _run(spark, config, day, dry_run, input_base, output_base)
    except MissingInput:
        if path:
            alerts.write_alerts(alerts.missing_input_alerts(listing, name), path)
        raise
    except Exception as error:
        if path:
            kind = next((k for e, k in _ENDINGS.items() if isinstance(error, e)), "generic")
            alerts.write_alerts(alerts.alerts(spark.range(1), kind, name, F.lit(type(error).__name__), F.lit(str(error)[:1000])), path)
        raise


def _run(
    spark: SparkSession, config: Spec, day: dt.date, dry_run: bool, input_base: str, output_base: str
) -> dict[str, DataFrame]:
    steps = list((config.get("Transformations") or {}).get("steps") or [])
    declared, outputs = config.get("Inputs") or {}, config.get("Outputs") or {}
    inputs: dict[str, DataFrame] = {}
    for name, spec in declared.items():
        inputs |= read_input(spark, name, spec, day, input_base)
    wanted = _wanted(inputs, steps, outputs)
    for number, name in shared_frames(steps, inputs, wanted):
        # A columnar input is read again at the price of the columns that are used.
        if number < 0 and name in declared and format_of(declared[name]) != "parquet" and declared[name].get("store") is not False:
            inputs[name] = keep(inputs[name])
    named = run_steps(inputs, steps, day, wanted)
    results = {k: df for k, df in named.items() if inputs.get(k) is not df}
    found = resolve_outputs(inputs, results, outputs)
    if dry_run:
        return {"row_counts": row_counts(found)}
    for name, df in found.items():
        stored = bool(_controls(outputs[name], steps) or outputs[name].get("control_file_path"))
        if stored:
            # Data and control file are written from one copy.
            found[name] = df = keep(df)
        write_output(df, outputs[name], day, output_base, stored)
        write_curated_control(df, outputs[name], steps, day, inputs, output_base)
    return found
