"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of cores. Each query
runs once to warm up and once for the clock; results are computed in full and
thrown away by the ``noop`` writer.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from feedmill.plans import catalog
from feedmill.session import clean_up, configure

HEADLINE = [
    "steps_join_filter_agg", "agg_complex_condition", "join_inner", "join_skewed", "join_skewed_full",
    "sort_asc", "merge_sorted", "verb_compute", "verb_working_storage", "scan_csv", "scan_csv_enveloped",
    "fixed_read", "fixed_write", "fixed_roundtrip", "feed_read", "feed_record_position",
    "feed_write_enveloped", "dated_read", "ebcdic_read", "validate_flag", "validate_error_counts",
    "validate_split_roundtrip", "recon_record_count", "recon_control_file", "prev_business_day",
    "feed_continuity", "control_totals", "control_header_ref", "alert_events",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
            clean_up(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
