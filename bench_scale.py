"""Enveloped feed write and read on 1, 4 and 8 cores; prints one JSON line.

The line items of ``BENCH_SF_DIR`` are stored as many small files first, so that
the work can be split; splits of one megabyte stand for the blocks of a large
feed. Times are those of the second of two runs.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession, functions as F

from feedmill.fields import Layout
from feedmill.plans.registry import table
from feedmill.session import configure, new_folder
from feedmill.sinks.fixed import write_feeds, write_fixed
from feedmill.sources.fixed import read_fixed

LAYOUT = Layout.of([
    {"name": "ORDER-KEY", "type": "long", "length": 12},
    {"name": "PART-KEY", "type": "long", "length": 12},
    {"name": "PRICE", "type": "decimal", "precision": 2, "length": 14},
    {"name": "FLAG", "length": 4},
], record_length=80)
HEADER = [{"name": "REC-ID", "length": 3, "expression": "'HDR'"}]
TRAILER = [{"name": "REC-ID", "length": 3, "expression": "'TRL'"},
           {"name": "REC-CNT", "length": 12, "expression": "lpad(count(*) + 2, 12, '0')"}]
COPIES = int(os.environ.get("BENCH_COPIES", "4"))


def measure(cores: int, folder: str) -> dict[str, float]:
    spark = (
        configure(SparkSession.builder.master(f"local[{cores}]").appName("scale"))
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.files.maxPartitionBytes", "1m")
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    source = new_folder(spark, "source")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ORDER_KEY"), F.col("l_partkey").alias("PART_KEY"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("PRICE"),
        F.col("l_returnflag").alias("FLAG"))
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("copy")
    lines.select("*", copies).drop("copy").repartition(16).write.parquet(source)
    stored = spark.read.parquet(source)
    times: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - start, 2)
        return result

    for _ in range(2):
        one, many = new_folder(spark, "one"), new_folder(spark, "many")
        timed("write_one_feed", lambda: write_fixed(stored, LAYOUT, one, 1, 1, HEADER, TRAILER))
        timed("write_feeds", lambda: write_feeds(stored, "FLAG", LAYOUT, many, HEADER, TRAILER))
        feed = timed("count_blocks", lambda: read_fixed(spark, one, LAYOUT, 1, 1, unit="directory"))
        timed("read_feed", lambda: feed.data.write.format("noop").mode("overwrite").save())
    spark.stop()
    return times


if __name__ == "__main__":
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    print(json.dumps({"metric": "scale", "unit": "sec", "copies": COPIES,
                      "cores": {n: measure(n, folder) for n in (1, 4, 8)}}))
