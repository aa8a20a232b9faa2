"""Alerts as an ordinary table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Severity names and their codes.
SEVERITIES = {"CRITICAL": 5, "HIGH": 4, "MEDIUM": 3, "LOW": 2, "INFO": 1}
# Kind of alert -> (suffix of its key, default severity).
KINDS = {
    "validation": ("validation", "HIGH"),
    "previous_run_missing": ("last_run_file_missing", "CRITICAL"),
    "input_missing": ("input_file_missing", "CRITICAL"),
    "continuity": ("prev_day_check_failed", "CRITICAL"),
    "record_count": ("record_count_check_failed", "CRITICAL"),
    "generic": ("generic", "MEDIUM"),
}
# First part of every alert key, unless a caller has one of its own.
KEY_PREFIX = "feedmill"


def alerts(
    findings: DataFrame,
    kind: str,
    flow: str,
    subject: Column,
    summary: Column,
    tags: dict[str, Column] | None = None,
    severity: str | None = None,
    prefix: str = KEY_PREFIX,
) -> DataFrame:
    """One alert per finding; the same finding always gets the same key.

    ``subject`` is the step, input or file that is reported. Write the result
    like any table; delivery to an incident system reads it from there.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown alert kind '{kind}'")
    suffix, default = KINDS[kind]
    level = (severity or default).upper()
    if level not in SEVERITIES:
        raise ValueError(f"unknown severity '{level}'")
    pairs = [F.lit("pipeline"), F.lit(flow)]
    for name, value in (tags or {}).items():
        pairs += [F.lit(name), value.cast("string")]
    return findings.select(
        F.concat_ws(".", F.lit(prefix), F.lit(flow), subject, F.lit(suffix)).alias("alert_key"),
        F.lit(kind).alias("kind"),
        F.lit(level).alias("severity"),
        F.lit(SEVERITIES[level]).alias("severity_code"),
        summary.alias("summary"),
        F.create_map(*pairs).alias("tags"),
    )


def validation_alerts(summary: DataFrame, flow: str, step: str) -> DataFrame:
    """From a validation summary: an alert when any row is invalid."""
    invalid = F.col("invalid_rows")
    return alerts(
        summary.filter(invalid > 0), "validation", flow, F.lit(step),
        F.format_string(f"%d invalid row(s) in '{flow}' step '{step}'", invalid),
        {"step": F.lit(step), "invalid_count": invalid},
    )


def count_alerts(comparison: DataFrame, flow: str, key: str = "feed") -> DataFrame:
    """From a count comparison: an alert per feed that does not match."""
    return alerts(
        comparison.filter(~F.col("matches")), "record_count", flow, F.col(key).cast("string"),
        F.concat(F.lit(f"record count mismatch in '{flow}': expected "),
                 F.coalesce(F.col("expected_count").cast("string"), F.lit("no count")),
                 F.lit(", actual "), F.col("actual_count").cast("string")),
        {"input_file": F.col(key), "expected_count": F.col("expected_count"),
         "actual_count": F.col("actual_count")},
    )


def continuity_alerts(days: DataFrame, flow: str, input_name: str) -> DataFrame:
    """From a continuity check: an alert per delivery that does not follow on."""
    actual = F.coalesce(F.col("actual_date").cast("string"), F.lit("FILE_MISSING"))
    return alerts(
        days.filter("status <> 'ok'"), "continuity", flow,
        F.concat_ws(".", F.lit(input_name), F.col("file_date").cast("string")),
        F.concat(F.lit(f"previous day of '{input_name}' should be "),
                 F.col("expected_date").cast("string"), F.lit(", found "), actual),
        {"input": F.lit(input_name), "expected_date": F.col("expected_date"),
         "actual_date": actual},
    )


def missing_date_alerts(days: DataFrame, flow: str, input_name: str,
                        kind: str = "previous_run_missing") -> DataFrame:
    """From missing dates: an alert per date nothing was delivered for."""
    day = F.col("missing_date").cast("string")
    return alerts(
        days, kind, flow, F.concat_ws(".", F.lit(input_name), day),
        F.concat(F.lit(f"no delivery of '{input_name}' for "), day),
        {"input": F.lit(input_name), "partition_column": day},
    )


def missing_input_alerts(listing: DataFrame, flow: str) -> DataFrame:
    """From a listing of declared inputs: an alert per input that was not delivered."""
    return alerts(
        listing.filter(~F.col("delivered")), "input_missing", flow, F.col("input"),
        F.concat(F.lit("input '"), F.col("input"), F.lit(f"' of '{flow}' was not delivered to "), F.col("path")),
        {"input": F.col("input"), "path": F.col("path")},
    )


def generic_alerts(findings: DataFrame, flow: str, subject: Column, summary: Column,
                   tags: dict[str, Column] | None = None, severity: str | None = None) -> DataFrame:
    """Any other finding, one alert a row, in the caller's words."""
    return alerts(findings, "generic", flow, subject, summary, tags, severity)


def write_alerts(found: DataFrame, path: str) -> None:
    """Add alerts to a table of them."""
    found.write.mode("append").parquet(path)
