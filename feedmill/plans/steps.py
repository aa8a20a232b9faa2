"""Declared steps over named frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from feedmill.fields import Field
from feedmill.functions.dates import dated_path, spark_pattern
from feedmill.operators import aggregates, filters, joins, reconcile, sets, validate, verbs
from feedmill.plans.options import check_step
from feedmill.session import cut, keep
from feedmill.sinks.jdbc import load_table
from feedmill.sinks.tables import write_control_file
from feedmill.sources.fixed import last_per_feed

Frames = Mapping[str, DataFrame]
Step = Mapping[str, Any]

# Keys that describe the step itself; in the flat form all others are its logic.
_STEP_KEYS = {"id", "name", "type", "input", "output_alias", "logic", "store"}


def _logic(step: Step) -> dict[str, Any]:
    if step.get("logic") is not None:
        return dict(step["logic"])
    return {k: v for k, v in step.items() if k not in _STEP_KEYS}


def _alias(step: Step) -> str:
    return step.get("output_alias") or step.get("id") or step.get("name") or "out"


def _names(step: Step, logic: Mapping[str, Any]) -> list[str]:
    names = logic.get("source_inputs") or step.get("source_inputs") or step.get("input") or []
    return [names] if isinstance(names, str) else list(names)


def _frame(frames: Frames, name: str | None) -> DataFrame:
    if name not in frames:
        raise ValueError(f"no frame '{name}' among {sorted(frames)}")
    return frames[name]


def _source(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    names = _names(step, logic)
    known = [n for n in names if n in frames]
    if not known:
        raise ValueError(f"step '{_alias(step)}': none of {names} among {sorted(frames)}")
    return frames[known[0]]


def _filter(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    df = _source(frames, step, logic)
    if logic.get("else_branch") and isinstance(logic.get("value_list"), list):
        return filters.split_rows(df, logic.get("field") or "", logic["value_list"])[1]
    return filters.filter_rows(df, logic.get("conditions") or [])


def _select(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    df = _source(frames, step, logic)
    if logic.get("columns"):
        return verbs.select_columns(df, list(logic["columns"]))
    return verbs.apply_verbs(df, logic.get("expressions") or [])


def _join(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    left, right = _frame(frames, logic.get("left")), _frame(frames, logic.get("right"))
    return joins.join_frames(
        left, right, list(logic.get("on") or []), logic.get("how") or "inner",
        int(logic.get("skew_parts") or 0),
    )


def _aggregate(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    df = _source(frames, step, logic)
    return aggregates.aggregate(df, logic.get("group_by") or [], logic.get("aggregations") or [])


def _union(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    return sets.union_frames([_frame(frames, n) for n in _names(step, logic)])


def _custom(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    op = str(logic.get("operation") or logic.get("op") or "").lower()
    keys = logic.get("key") or logic.get("keys") or []
    ascending = bool(logic.get("ascending", "desc" not in str(logic.get("order") or "asc").lower()))
    if op == "sort":
        return sets.sort_rows(_source(frames, step, logic), keys, ascending)
    if op == "merge":
        return sets.merge_frames([_frame(frames, n) for n in _names(step, logic)], keys, ascending)
    raise ValueError(f"unknown custom operation '{op}'")


def _previous(df: DataFrame, logic: Mapping[str, Any], kind: str) -> None:
    """Gate on the delivery of the business day before the run."""
    spark, run_date = df.sparkSession, logic.get("run_date") or dt.date.today()
    base = logic.get(f"{kind}_file_path")
    if not base:
        raise ValueError(f"'{kind}' check without '{kind}_file_path'")
    frequency, name = logic.get(f"{kind}_frequency") or "", logic.get(f"{kind}_file_name") or ""
    header = Field.of(logic["previous_day_header_field"]) if kind == "previous_day" and logic.get("previous_day_header_field") else None

    def path_of(day: dt.date) -> str:
        # A declared partition is an expression of the run date and is taken as it is.
        if logic.get("partition_column"):
            return dated_path(spark, base, frequency, run_date, logic["partition_column"], name)
        return dated_path(spark, base, frequency, day, "load_date()", name)

    def header_date(lines: DataFrame) -> Column:
        text = F.trim(F.substring("value", header.start, header.length))
        return F.try_to_date(text, spark_pattern(header.format or "yyyyMMdd"))

    reconcile.require_continuity(reconcile.previous_delivery(
        spark, run_date, path_of, header_date if header else None, logic.get("holidays") or [], bool(logic.get("skip_weekends"))))


def _validate(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    """Validation of one input, after its gates: the previous delivery, and record counts.

    ``trailer_check`` compares each feed's trailer with the rows that pass all rules.
    """
    df = _source(frames, step, logic)
    for kind, wanted in (("previous_day", logic.get("previous_day_check")), ("last_run", logic.get("last_run_check"))):
        if wanted:
            _previous(df, logic, kind)
    if logic.get("trailer_check"):
        name = next(n for n in _names(step, logic) if n in frames)
        reconcile.require_counts(reconcile.compare_counts(
            last_per_feed(_frame(frames, f"{name}_trailer")), validate.accepted(df, logic.get("rules") or []),
            logic.get("trailer_count_field"), int(logic.get("header_count") or 0) + int(logic.get("trailer_count") or 0)))
    if logic.get("record_count_check"):
        name = next(n for n in _names(step, logic) if n in frames)
        reconcile.require_counts(
            reconcile.compare_counts(
                last_per_feed(_frame(frames, f"{name}_trailer")),
                df,
                logic.get("record_count_trailer_field"),
                int(logic.get("header_count") or 0) + int(logic.get("trailer_count") or 0),
            )
        )
    return validate.validate(df, logic)


def _control(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    df = _source(frames, step, logic)
    path = logic.get("ctrl_output_path") or logic.get("path") or logic.get("validated_path")
    if not path:
        raise ValueError(f"step '{_alias(step)}' declares no path for its control file")
    write_control_file(
        df,
        dated_path(
            df.sparkSession, path, logic.get("frequency") or "", logic.get("run_date"),
            logic.get("partition_column") or "", logic.get("ctrl_file_name") or "",
        ),
        logic.get("ctrl_file_fields") or [],
        bool(logic.get("ctrl_include_header", False)),
        frames.get(logic.get("header_input") or ""),
    )
    return df


def _load(frames: Frames, step: Step, logic: Mapping[str, Any]) -> DataFrame:
    df = _source(frames, step, logic)
    load_table(df, logic)
    return df


STEPS: dict[str, Callable[[Frames, Step, Mapping[str, Any]], DataFrame]] = {
    "filter": _filter,
    "select": _select,
    "join": _join,
    "aggregate": _aggregate,
    "union": _union,
    "custom": _custom,
    "validate": _validate,
    "ctrl_file": _control,
    "table_write": _load,
    "oracle_write": _load,
}


def run_step(
    step: Step, frames: Frames, run_date: dt.date | None = None
) -> tuple[str, DataFrame]:
    """Apply one step; returns its alias and its frame.

    Steps build plans. Only the sinks (``ctrl_file``, ``table_write``, a
    validation with an output path) and the gates of a validation run a job;
    sinks pass their input on. A step with ``store: true`` is written to the
    shared folder once, for a result that several outputs start from. Options
    that a step does not know are refused. Dated paths follow ``run_date``, by
    default today.
    """
    check_step(step, _logic(step))
    kind = str(step.get("type") or "select").lower()
    df = STEPS[kind](frames, step, {**_logic(step), "run_date": run_date})
    return _alias(step), cut(df, "step") if step.get("store") else df


def _reads(step: Step, named: Iterable[str]) -> list[str]:
    """The frames a step computes from, one entry a time it does."""
    logic, named = _logic(step), set(named)
    kind = str(step.get("type") or "select").lower()
    if kind == "join":
        return [n for n in (logic.get("left"), logic.get("right")) if n in named]
    known = [n for n in _names(step, logic) if n in named]
    if kind == "union" or (kind == "custom" and str(logic.get("operation") or logic.get("op")).lower() == "merge"):
        return known
    times = 1
    if kind == "validate":
        # Count gates compute the rows before the result does.
        times += bool(logic.get("trailer_check")) + bool(logic.get("record_count_check"))
    elif kind in _SINKS:
        times += 1
    return known[:1] * times


# Steps that write what they are given and hand it on.
_SINKS = {"ctrl_file", "table_write", "oracle_write"}


def shared_frames(steps: Iterable[Step], inputs: Iterable[str], wanted: Iterable[str] | None = None) -> set[tuple[int, str]]:
    """The frames that are computed more than once: (number of the step, -1 for an input; name).

    ``wanted`` names the results that are used afterwards, each as often as it is listed; by
    default all of them are. Steps that nothing wanted comes from, and that write nothing,
    are never computed and use nothing. A name may be given again: later steps then see the
    later frame.
    """
    steps = list(steps)
    latest = {name: -1 for name in inputs}
    reads: list[list[tuple[int, str]]] = []
    for number, step in enumerate(steps):
        reads.append([(latest[n], n) for n in _reads(step, latest)])
        latest[_alias(step)] = number
    uses: dict[tuple[int, str], int] = {}
    for name in latest if wanted is None else wanted:
        if name in latest:
            uses[latest[name], name] = uses.get((latest[name], name), 0) + 1
    for number in reversed(range(len(steps))):
        step = steps[number]
        own = (number, _alias(step))
        kind = str(step.get("type") or "select").lower()
        if uses.get(own) or kind in _SINKS or kind == "validate":
            # A stored result is computed once, any other as often as it is used.
            times = 1 if uses.get(own, 0) > 1 and step.get("store") is not False else max(1, uses.get(own, 0))
            for frame in reads[number]:
                uses[frame] = uses.get(frame, 0) + times
    return {frame for frame, n in uses.items() if n > 1}


def run_steps(
    frames: Frames, steps: Iterable[Step], run_date: dt.date | None = None, wanted: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Fold steps over named frames; returns inputs and results by name.

    With ``wanted``, the names that outputs use, a result that several steps or outputs
    compute from is stored by itself, so that all of them start from one copy; ``store: false``
    leaves one out. All options are checked before the first step runs.
    """
    steps = list(steps)
    for step in steps:
        check_step(step, _logic(step))
    shared = shared_frames(steps, frames, wanted) if wanted is not None else set()
    named = dict(frames)
    for number, step in enumerate(steps):
        alias, df = run_step(step, named, run_date)
        passed_on = any(df is other for other in named.values())
        if (number, alias) in shared and "store" not in step and not passed_on:
            df = keep(df)
        named[alias] = df
    return named


def resolve_outputs(
    inputs: Frames, results: Frames, outputs: Mapping[str, Mapping[str, Any]]
) -> dict[str, DataFrame]:
    """The frame of each declared output.

    Looked up by output name, then by its declared sources, then among the
    inputs; a single output takes a single result whatever its name.
    """
    found: dict[str, DataFrame] = {}
    for name, spec in outputs.items():
        candidates = [name, *(spec.get("source_inputs") or [])]
        hit = next((results[c] for c in candidates if c in results), None)
        if hit is None:
            hit = inputs.get(name)
        if hit is None and len(outputs) == len(results) == 1:
            hit = next(iter(results.values()))
        if hit is None:
            raise ValueError(f"no frame for output '{name}'")
        found[name] = hit
    return found


def row_counts(frames: Frames) -> DataFrame:
    """Dry run: one row per output with its number of rows, in a single query."""
    if not frames:
        raise ValueError("no outputs to count")
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("output"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.union, counts)
