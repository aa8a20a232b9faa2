"""Row validation: every rule is a column that holds an error text or NULL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from feedmill.fields import Layout
from feedmill.functions.dates import spark_pattern
from feedmill.functions.names import column_name, find_column
from feedmill.session import keep
from feedmill.sinks.fixed import fixed_line

ERRORS, VALID = "_validation_errors", "_is_valid"

# Named formats and their patterns.
PATTERNS = {
    "alpha": r"^[A-Za-z\s]+$",
    "numeric": r"^\d+(\.\d+)?$",
    "alphanumeric": r"^[A-Za-z0-9\s]+$",
    "email": r"^[^\s@]+@[^\s@]+\.[^\s@]+$",
}
# Rule data type -> Spark type a value must cast to.
CASTS = {
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "bigint": "bigint",
    "double": "double",
    "float": "float",
    "decimal": "double",
    "number": "double",
    "text": "string",
}
# Patterns of dates and timestamps that declare none.
DATE_FORMAT, TIMESTAMP_FORMAT = "yyyyMMdd", "yyyyMMdd HH:mm:ss"
# Error texts and what joins them.
NULL_ERROR = "'{field}' must not be null or empty"
TYPE_ERROR = "'{field}' is not a valid {type}"
DATE_ERROR = "'{field}' is not a valid date (expected: {pattern})"
TIMESTAMP_ERROR = "'{field}' is not a valid timestamp (expected: {pattern})"
LENGTH_ERROR = "'{field}' exceeds max length {limit}"
DATE_FORMAT_ERROR = "'{field}' does not match date format '{pattern}'"
REGEX_ERROR = "'{field}' does not match pattern '{pattern}'"
FORMAT_ERROR = "'{field}' is not a valid {format} value"
SEPARATOR = "; "
# Error texts of the checks that have no counterpart above.
RANGE_ERROR = "'{field}' is not between {low} and {high}"
SHORT_ERROR = "'{field}' is below min length {limit}"
LIST_ERROR = "'{field}' is not one of {values}"


class InvalidRows(RuntimeError):
    """Raised by the ABORT gate; carries the count and up to five error texts."""

    def __init__(self, count: int, samples: list[str]):
        super().__init__(f"{count} invalid row(s); first errors: {samples}")
        self.count, self.samples = count, samples


def _blank(text: Column) -> Column:
    return F.trim(text) == ""


def _type_failures(column: Column, text: Column, rule: Mapping[str, Any], name: str):
    data_type = str(rule.get("data_type") or "string").lower()
    present = column.isNotNull()
    if data_type in CASTS:
        failed = present & ~_blank(text) & column.try_cast(CASTS[data_type]).isNull()
        yield failed, TYPE_ERROR.format(field=name, type=data_type)
    elif data_type == "date":
        pattern = rule.get("date_format") or DATE_FORMAT
        parsed = F.try_to_date(text, spark_pattern(pattern))
        yield present & parsed.isNull(), DATE_ERROR.format(field=name, pattern=pattern)
    elif data_type == "timestamp":
        pattern = rule.get("date_format") or TIMESTAMP_FORMAT
        parsed = F.try_to_timestamp(text, F.lit(spark_pattern(pattern)))
        yield present & parsed.isNull(), TIMESTAMP_ERROR.format(field=name, pattern=pattern)


def _format_failures(column: Column, text: Column, rule: Mapping[str, Any], name: str):
    form = str(rule.get("format") or "any").lower()
    pattern = rule.get("pattern") or ""
    present = column.isNotNull()
    if form == "date":
        expected = rule.get("date_format") or pattern or DATE_FORMAT
        parsed = F.try_to_date(text, spark_pattern(expected))
        yield present & parsed.isNull(), DATE_FORMAT_ERROR.format(field=name, pattern=expected)
    elif form == "regex" and pattern:
        yield present & ~text.rlike(pattern), REGEX_ERROR.format(field=name, pattern=pattern)
    elif form in PATTERNS:
        yield present & ~text.rlike(PATTERNS[form]), FORMAT_ERROR.format(field=name, format=form)


def _bound(value: Any, kind: T.DataType) -> Column:
    """A limit as an exact literal, unless the column itself is a float."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.lit(float(value))
    return F.lit(Decimal(str(value)))


def _outside(column: Column, kind: T.DataType, low: Any, high: Any) -> Column:
    """Whether a value lies outside its range, compared in its own type; text is compared
    as an exact decimal, and as a double only where it fits none."""
    def beyond(value: Column, as_kind: T.DataType) -> Column:
        found = F.lit(False)
        if low is not None:
            found = found | (value < _bound(low, as_kind))
        if high is not None:
            found = found | (value > _bound(high, as_kind))
        return found

    if not isinstance(kind, T.StringType):
        return beyond(column, kind)
    exact, rough = column.try_cast("decimal(38,12)"), column.try_cast("double")
    return F.when(exact.isNotNull(), beyond(exact, T.DecimalType(38, 12))).otherwise(beyond(rough, T.DoubleType()))


def _check_failures(column: Column, text: Column, rule: Mapping[str, Any], name: str, kind: T.DataType):
    """Rules in the ``{check, params}`` vocabulary; NULL passes all but not_null."""
    check, params = str(rule["check"]).lower(), rule.get("params") or {}
    low, high = params.get("min"), params.get("max")
    present = column.isNotNull()
    if check == "not_null":
        yield column.isNull() | _blank(text), NULL_ERROR.format(field=name)
    elif check == "in_range":
        if not isinstance(kind, (T.NumericType, T.StringType)):
            raise ValueError(f"'{name}' is no number and has no range")
        no_number = text.try_cast("double").isNull() & ~_blank(text)
        yield present & (no_number | F.coalesce(_outside(column, kind, low, high), F.lit(False))), RANGE_ERROR.format(field=name, low=low, high=high)
    elif check == "regex":
        pattern = params.get("pattern") or rule.get("pattern") or ""
        yield present & ~text.rlike(pattern), REGEX_ERROR.format(field=name, pattern=pattern)
    elif check == "length":
        if high is not None:
            yield present & (F.length(text) > high), LENGTH_ERROR.format(field=name, limit=high)
        if low is not None:
            yield present & (F.length(text) < low), SHORT_ERROR.format(field=name, limit=low)
    elif check == "in_list":
        values = [str(v) for v in params.get("values") or []]
        if isinstance(kind, T.StringType):
            listed = text.isin(values)
        else:
            # In the type of the column: 1.0 is 1, and true is True.
            listed = F.coalesce(column.isin([F.lit(v).try_cast(kind) for v in values]), F.lit(False))
        yield present & ~listed, LIST_ERROR.format(field=name, values=", ".join(values))
    else:
        raise ValueError(f"unknown check '{check}'")


def _failures(df: DataFrame, rule: Mapping[str, Any]):
    name = column_name(rule.get("field") or "")
    found = find_column(df.columns, name) if name else None
    if found is None:
        return
    column = df[found]
    text = column.cast("string")
    if rule.get("check"):
        yield from _check_failures(column, text, rule, name, df.schema[found].dataType)
        return
    if not rule.get("nullable", True):
        yield column.isNull() | _blank(text), NULL_ERROR.format(field=name)
    yield from _type_failures(column, text, rule, name)
    if rule.get("max_length") is not None:
        limit = int(rule["max_length"])
        too_long = column.isNotNull() & (F.length(text) > limit)
        yield too_long, LENGTH_ERROR.format(field=name, limit=limit)
    yield from _format_failures(column, text, rule, name)


def rule_errors(df: DataFrame, rules: Iterable[Mapping[str, Any]]) -> list[tuple[str, Column]]:
    """Every check as (error text, column that is the text or NULL).

    Rules on columns the frame does not have are skipped.
    """
    return [
        (text, F.when(failed, F.lit(text)))
        for rule in rules
        for failed, text in _failures(df, rule)
    ]


def annotate(df: DataFrame, rules: Iterable[Mapping[str, Any]]) -> DataFrame:
    """FLAG: all rows, with joined errors and a validity flag. One narrow pass."""
    errors = [column for _, column in rule_errors(df, rules)]
    joined = F.concat_ws(SEPARATOR, *errors) if errors else F.lit("")
    return df.withColumn(ERRORS, joined).withColumn(VALID, F.length(ERRORS) == 0)


def accepted(df: DataFrame, rules: Iterable[Mapping[str, Any]]) -> DataFrame:
    """DROP: the rows that pass every rule, in their own columns."""
    return annotate(df, rules).filter(VALID).drop(ERRORS, VALID)


def rejected(df: DataFrame, rules: Iterable[Mapping[str, Any]]) -> DataFrame:
    """The rows that fail, with their errors."""
    return annotate(df, rules).filter(~F.col(VALID))


def summary(df: DataFrame, rules: Iterable[Mapping[str, Any]]) -> DataFrame:
    """One row: total, valid and invalid row counts."""
    flags = annotate(df, rules).select(VALID)
    return flags.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(VALID).alias("valid_rows"),
        F.count_if(~F.col(VALID)).alias("invalid_rows"),
    )


def error_counts(df: DataFrame, rules: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Failures per error text.

    All counts come from one aggregation and only its single row is unfolded,
    so rows are never multiplied by the number of rules.
    """
    errors = rule_errors(df, rules)
    if not errors:
        return df.sparkSession.range(0).select(
            F.lit("").alias("error"), F.lit(0).cast("bigint").alias("failures")
        )
    one = df.agg(*[F.count(column).alias(f"n{i}") for i, (_, column) in enumerate(errors)])
    pairs = [
        F.struct(F.lit(text).alias("error"), F.col(f"n{i}").alias("failures"))
        for i, (text, _) in enumerate(errors)
    ]
    unfolded = one.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    # Two rules may word an error alike.
    return (
        unfolded.groupBy("error").agg(F.sum("failures").alias("failures"))
        .filter("failures > 0")
    )


# Errors of at most so many rows are reported by a gate.
_SAMPLES = 5


def _counted(marked: DataFrame) -> tuple[DataFrame, Observation]:
    """Marked rows, with counts of both sides and the errors of a few rows, observed when
    they are computed. A row's running number picks the place its errors may take."""
    place = F.monotonically_increasing_id() % _SAMPLES
    seen = Observation()
    samples = [F.min(F.when(~F.col(VALID) & (F.col("_place") == k), F.col(ERRORS))).alias(f"sample{k}") for k in range(_SAMPLES)]
    observed = marked.withColumn("_place", place).observe(
        seen, F.count_if(VALID).alias("accepted"), F.count_if(~F.col(VALID)).alias("rejected"), *samples)
    return observed.drop("_place"), seen


def _require_none(seen: Mapping[str, Any]) -> None:
    if seen["rejected"]:
        samples = [seen[f"sample{k}"] for k in range(_SAMPLES)]
        raise InvalidRows(seen["rejected"], [x for x in samples if x is not None])


def store_marked(df: DataFrame, rules: Iterable[Mapping[str, Any]]) -> tuple[DataFrame, dict[str, Any]]:
    """All rows with their errors, stored, and what was counted on the way: one pass over
    ``df``, however often the rows are used."""
    observed, seen = _counted(annotate(df, rules))
    return keep(observed), seen.get


def require_valid(df: DataFrame, rules: Iterable[Mapping[str, Any]]) -> DataFrame:
    """ABORT: the rows of ``df`` if every one passes, else :class:`InvalidRows`. They are
    computed once: what follows starts from the rows that were checked."""
    marked, seen = store_marked(df, rules)
    _require_none(seen)
    return marked.drop(ERRORS, VALID)


def write_split(
    df: DataFrame,
    rules: Iterable[Mapping[str, Any]],
    path: str,
    layout: Layout | None = None,
    mode: str = "append",
) -> dict[str, int]:
    """Write accepted and rejected rows in one pass; return their counts.

    Rows land under ``outcome=accepted`` and ``outcome=rejected`` of ``path``:
    as fixed-width lines if a layout is given, else as Parquet with the errors.
    Counts are observed during the write, so nothing is read or kept twice.
    """
    observed, seen = _counted(annotate(df, rules))
    _write_split(observed, df.columns, path, layout, mode)
    return {side: seen.get[side] for side in ("accepted", "rejected")}


def _write_split(marked: DataFrame, columns: list[str], path: str, layout: Layout | None, mode: str) -> None:
    outcome = F.when(F.col(VALID), "accepted").otherwise("rejected").alias("outcome")
    if layout is not None:
        lines = marked.select(fixed_line(marked.select(*[f"`{c}`" for c in columns]), layout).alias("value"), outcome)
        lines.write.mode(mode).partitionBy("outcome").text(path)
    else:
        marked.select("*", outcome).drop(VALID).write.mode(mode).partitionBy("outcome").parquet(path)


def write_sides(
    df: DataFrame,
    rules: Iterable[Mapping[str, Any]],
    validated_path: str = "",
    error_path: str = "",
    layout: Layout | None = None,
    mode: str = "append",
) -> None:
    """Write accepted rows to one path and rejected rows, with errors, to another.

    One pass over the input stores the marked rows; each path is written from these.
    """
    _write_sides(store_marked(df, rules)[0], validated_path, error_path, layout, mode)


def _write_sides(marked: DataFrame, validated_path: str, error_path: str, layout: Layout | None, mode: str) -> None:
    passed, failed = marked.filter(VALID).drop(ERRORS, VALID), marked.filter(~F.col(VALID))
    for path, rows in ((validated_path, passed), (error_path, failed)):
        if path and layout is not None:
            rows.select(fixed_line(rows, layout).alias("value")).write.mode(mode).text(path)
        elif path:
            rows.write.mode(mode).parquet(path)


def validate(df: DataFrame, logic: Mapping[str, Any]) -> DataFrame:
    """The validate step. ``fail_mode`` or ``mode`` is FLAG, DROP or ABORT.

    FLAG and DROP never stop a run; add ``on_invalid: abort`` to make them.
    Both sides are written as well if paths are given: together below an
    ``output_path``, or apart to ``validated_path`` and ``error_path``. With paths or
    a gate the rows are computed once and stored; sinks, gate and result share them.
    """
    rules = list(logic.get("rules") or [])
    mode = str(logic.get("fail_mode") or logic.get("mode") or "FLAG").upper()
    mode = "FLAG" if mode == "FLAGGED" else mode
    if mode not in ("FLAG", "DROP", "ABORT"):
        raise ValueError(f"unknown validation mode '{mode}'")
    layout = Layout.of(logic["layout"]) if logic.get("layout") else None
    split, validated, errors = (logic.get(k) or "" for k in ("output_path", "validated_path", "error_path"))
    aborts = mode == "ABORT" or str(logic.get("on_invalid", "")).lower() == "abort"
    if not (split or validated or errors or aborts):
        return accepted(df, rules) if mode == "DROP" else annotate(df, rules)
    marked, seen = store_marked(df, rules)
    if split:
        _write_split(marked, df.columns, split, layout, "append")
    _write_sides(marked, validated, errors, layout, "append")
    if aborts:
        _require_none(seen)
    return marked.filter(VALID).drop(ERRORS, VALID) if mode == "DROP" else marked
