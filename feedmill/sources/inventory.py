"""What was delivered, from file metadata alone."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedmill.sources.dated import load_date
from feedmill.sources.lines import feed_of


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any that matches its pattern, is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def input_listing(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row a declared input: input, path, delivered."""
    rows = [(name, path, path_exists(spark, path)) for name, path in paths.items()]
    return spark.createDataFrame(rows, "input string, path string, delivered boolean")


def file_index(spark: SparkSession, path: str | list[str], frequency: str, unit: str = "auto") -> DataFrame:
    """Every file below the path: feed, file_path, load_date (a date, or NULL where the path
    holds none), bytes, modified.

    Spark lists directories in parallel and opens no file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        feed_of(F.col("path"), unit).alias("feed"), F.col("path").alias("file_path"),
        F.try_to_date(load_date(F.col("path"), frequency), "yyyyMMdd").alias("load_date"),
        F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def deliveries(files: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """From a file index: one row a key and day, with files, bytes and the latest change."""
    return files.where("load_date IS NOT NULL").groupBy(*keys, "load_date").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"))


def last_deliveries(found: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """From deliveries: the last day of each key and what came on it."""
    keys = list(keys)
    last = F.max(F.struct("load_date", "files", "bytes", "modified")).alias("last")
    one = found.groupBy(*keys).agg(last) if keys else found.agg(last)
    return one.select(*keys, "last.*")
