"""The options that flows, steps, inputs and outputs know; any other is refused.

An option that nobody reads would leave its meaning out without a word: a filter under a
misspelled name keeps every row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

Spec = Mapping[str, Any]

# Remarks that may stand anywhere, as may names that begin with an underscore.
REMARKS = {"description", "comment", "notes"}

STEP = {"id", "name", "type", "input", "source_inputs", "output_alias", "logic", "store"}
LOGIC = {
    "filter": {"source_inputs", "conditions", "field", "value_list", "else_branch"},
    # Targets come into being when they are first set; declaring them is allowed.
    "select": {"source_inputs", "columns", "expressions", "working_storage"},
    "join": {"source_inputs", "left", "right", "on", "how", "skew_parts"},
    "aggregate": {"source_inputs", "group_by", "aggregations"},
    "union": {"source_inputs"},
    "custom": {"source_inputs", "operation", "op", "key", "keys", "ascending", "order"},
    "validate": {
        "source_inputs", "rules", "fail_mode", "mode", "on_invalid", "layout", "output_path", "validated_path", "error_path", "run_date",
        "record_count_check", "record_count_trailer_field", "header_count", "trailer_count", "trailer_check", "trailer_count_field",
        "previous_day_check", "last_run_check", "previous_day_file_path", "previous_day_file_name", "previous_day_frequency",
        "previous_day_header_field", "last_run_file_path", "last_run_file_name", "last_run_frequency", "partition_column", "holidays",
        "skip_weekends",
    },
    "ctrl_file": {
        "source_inputs", "ctrl_output_path", "path", "validated_path", "frequency", "run_date", "partition_column", "ctrl_file_name",
        "ctrl_file_fields", "ctrl_include_header", "header_input",
    },
    "table_write": {
        "source_inputs", "table", "url", "host", "port", "service_name", "schema", "load_mode", "batch_size", "driver", "user",
        "password", "numPartitions",
    },
}
LOGIC["oracle_write"] = LOGIC["table_write"]
CONDITION = {"field", "operation", "op", "value"}
AGGREGATION = {"field", "operation", "op", "function", "condition", "alias"}
VERB = {
    "target", "output_field", "operation", "op", "expression", "operands", "literal", "value", "delimiter", "start", "length", "index",
    "before", "after",
}
RULE = {"field", "data_type", "nullable", "max_length", "format", "pattern", "date_format", "check", "params"}
PARAMS = {"min", "max", "values", "pattern"}
FIELD = {"name", "type", "length", "start", "begin", "nullable", "format", "precision", "just_right", "record_type", "expression"}

_PLACE = {"name", "format", "path", "source_path", "dataset_name", "frequency", "partition_col"}
_ENDS = {"header_count", "trailer_count"}
_DELIMITED = {"delimiter", "delimiter_char", *_ENDS}
_FIXED = {"record_length", "header_fields", "trailer_fields", *_ENDS}
INPUT = _PLACE | {"source_file_name", "fields", "count_file_path", "control_fields", "if_missing", "store"}
OUTPUT = _PLACE | {"source_inputs", "fields", "columns", "output_columns", "write_mode"}
# What a format knows beside these.
INPUT_FORMATS = {
    "parquet": set(), "csv": _DELIMITED | {"unit"}, "fixed": _FIXED | {"unit"}, "cobol": {"record_length", "cobrix"}}
OUTPUT_FORMATS = {
    "parquet": set(), "csv": _DELIMITED, "fixed": _FIXED | {"on_overflow", "control_file_path", "control_fields"}}
OUTPUT_FORMATS["cobol"] = OUTPUT_FORMATS["fixed"]
COBRIX = {"encoding", "file_start_offset", "file_end_offset", "generate_record_id"}
FLOW = {"name", "Inputs", "Outputs", "Transformations", "alerts_path"}
SAME_FORMAT = {"delimited": "csv", "ebcdic": "cobol"}


def require_known(given: Spec, known: Iterable[str], where: str, what: str = "options") -> None:
    """Refuse options that ``known`` does not list."""
    known = set(known)
    unknown = sorted(k for k in given if k not in known and k not in REMARKS and not k.startswith("_"))
    if unknown:
        raise ValueError(f"{where}: unknown {what} {unknown}; known are {sorted(known)}")


def format_of(spec: Spec) -> str:
    """The format of an input or output, in one spelling."""
    kind = str(spec.get("format") or "parquet").lower()
    return SAME_FORMAT.get(kind, kind)


def _check_place(spec: Spec, known: set[str], formats: Mapping[str, set[str]], where: str) -> None:
    kind = format_of(spec)
    if kind not in formats:
        raise ValueError(f"{where}: unknown format '{kind}'")
    # An empty option of another format says nothing.
    others = set().union(*formats.values()) - formats[kind]
    require_known({k: v for k, v in spec.items() if v or k not in others}, known | formats[kind], f"{where} of format {kind}")
    for name in ("fields", "header_fields", "trailer_fields", "control_fields"):
        for field in spec.get(name) or []:
            if isinstance(field, Mapping):
                require_known(field, FIELD, f"{where}, {name}")


def check_input(name: str, spec: Spec) -> None:
    """Refuse an input with options nobody reads."""
    _check_place(spec, INPUT, INPUT_FORMATS, f"input '{name}'")
    require_known(spec.get("cobrix") or {}, COBRIX, f"input '{name}', cobrix")
    if spec.get("if_missing", "stop") not in ("stop", "empty"):
        raise ValueError(f"input '{name}': if_missing is 'stop' or 'empty'")


def check_output(name: str, spec: Spec) -> None:
    """Refuse an output with options nobody reads."""
    _check_place(spec, OUTPUT, OUTPUT_FORMATS, f"output '{name}'")


def check_step(step: Spec, logic: Spec) -> None:
    """Refuse a step with options nobody reads, down to its conditions, verbs and rules."""
    kind = str(step.get("type") or "select").lower()
    where = f"step '{step.get('id') or step.get('output_alias') or kind}'"
    if kind not in LOGIC:
        raise ValueError(f"{where}: unknown step type '{kind}'")
    if step.get("logic") is not None:
        require_known(step, STEP, where)
    require_known(logic, LOGIC[kind], where, {"validate": "validation options"}.get(kind, f"{kind} options"))
    parts = {"conditions": CONDITION, "aggregations": AGGREGATION, "expressions": VERB, "rules": RULE, "ctrl_file_fields": FIELD}
    for name, known in parts.items():
        for part in logic.get(name) or []:
            if isinstance(part, Mapping):
                require_known(part, known, f"{where}, {name}")
                require_known(part.get("params") or {}, PARAMS, f"{where}, params")
    # An empty list is a decision, a missing one an oversight.
    if kind == "filter" and "conditions" not in logic and not logic.get("else_branch"):
        raise ValueError(f"{where}: a filter needs conditions")
    if kind == "aggregate" and "aggregations" not in logic:
        raise ValueError(f"{where}: an aggregate needs aggregations")


def check_flow(config: Spec) -> None:
    """Refuse a flow with options nobody reads in its inputs and outputs."""
    require_known(config, FLOW, "flow")
    require_known(config.get("Transformations") or {}, {"steps"}, "Transformations")
    for name, spec in (config.get("Inputs") or {}).items():
        check_input(name, spec)
    for name, spec in (config.get("Outputs") or {}).items():
        check_output(name, spec)
