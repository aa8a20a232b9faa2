"""Fixed-length EBCDIC records."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmill.fields import Field, Layout
from feedmill.functions.ebcdic import record_field
from feedmill.session import broadcast_if_small

# A row of a file's path and length.
_FILE_ROW_BYTES = 256


def read_records(spark: SparkSession, path: str, record_length: int) -> DataFrame:
    """Binary records of one length, in column ``record``.

    Files are split at record boundaries, so one large file is read by many
    tasks; the records go straight from the splits into a binary column.
    """
    context = spark.sparkContext._jsc.sc()
    records = context.binaryRecords(path, record_length, context.hadoopConfiguration())
    binary = spark._jvm.org.apache.spark.sql.Encoders.BINARY()
    frame = spark._jsparkSession.createDataset(records, binary).toDF()
    return DataFrame(frame, spark).toDF("record")


def _one_slash(path: Column) -> Column:
    """A path in one spelling: readers differ in the slashes behind the scheme."""
    return F.regexp_replace(path, "^([a-zA-Z][a-zA-Z0-9+.-]*):/+(?=/)", "$1:")


def _chunks(spark: SparkSession, path: str, size: int, split_bytes: int | None = None) -> DataFrame:
    """Pieces of ``size`` bytes of all files below ``path``: path, at (first byte), chunk.

    A partition is one split of one file, which Spark cuts at whole pieces; so the start of
    the split and the place within the partition give each piece's place in its file.
    """
    context = spark.sparkContext._jsc.sc()
    conf = spark._jvm.org.apache.hadoop.conf.Configuration(context.hadoopConfiguration())
    conf.set("mapreduce.input.fileinputformat.input.dir.recursive", "true")
    if split_bytes:
        conf.set("mapreduce.input.fileinputformat.split.maxsize", str(split_bytes))
    pieces = context.binaryRecords(path, size, conf)
    binary = spark._jvm.org.apache.spark.sql.Encoders.BINARY()
    frame = DataFrame(spark._jsparkSession.createDataset(pieces, binary).toDF(), spark).toDF("chunk")
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return frame.select(
        _one_slash(F.input_file_name()).alias("path"), (F.input_file_block_start() + within * size).alias("at"), "chunk")


def read_framed_records(
    spark: SparkSession,
    path: str,
    record_length: int,
    start_offset: int = 0,
    end_offset: int = 0,
    split_bytes: int | None = None,
) -> DataFrame:
    """Records of files with extra bytes before or after them, with ``record_id``.

    Offsets need not be whole records. Files are read in pieces of the greatest common
    divisor of offsets and record length, so one file of any size is read by many tasks;
    where a record is more than one piece, its pieces meet by file and record number. A
    file without a whole number of records is an error. ``split_bytes`` bounds the bytes
    of a task below what the file system would give.
    """
    if record_length < 1 or min(start_offset, end_offset) < 0:
        raise ValueError("a record has at least one byte, and offsets are not negative")
    size = math.gcd(record_length, start_offset, end_offset)
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select(_one_slash(F.col("path")).alias("path"), "length")
    )
    body = F.col("length") - F.lit(start_offset + end_offset)
    files = files.select("path", F.when((body >= 0) & (body % record_length == 0), F.lit(start_offset) + body).otherwise(
        F.raise_error(F.concat(F.lit("no whole number of records in "), F.col("path")))).alias("stop"))
    # A row a file: paths, not contents.
    files = broadcast_if_small(files, files.count(), _FILE_ROW_BYTES)
    inside = (F.col("at") >= start_offset) & (F.col("at") < F.col("stop"))
    number = F.floor((F.col("at") - start_offset) / record_length)
    pieces = _chunks(spark, path, size, split_bytes).join(files, "path").where(inside).select(
        "path", number.alias("record_id"), "at", "chunk")
    if size == record_length:
        return pieces.select("path", "record_id", F.col("chunk").alias("record"))
    together = F.sort_array(F.collect_list(F.struct("at", "chunk")))
    record = F.aggregate(together, F.lit(b""), lambda got, x: F.concat(got, x["chunk"]))
    return pieces.groupBy("path", "record_id").agg(record.alias("record"))


def parse_records(
    records: DataFrame, fields: Iterable[Field | Mapping[str, Any]] | Layout, encoding: str = "cp037", record_id: bool = False
) -> DataFrame:
    """Project records on a layout; with ``record_id`` their file and number come first."""
    columns = [record_field(F.col("record"), f, encoding) for f in Layout.of(fields).fields]
    return records.select(*(["path", "record_id"] if record_id else []), *columns)


def read_ebcdic(
    spark: SparkSession,
    path: str,
    fields: Iterable[Field | Mapping[str, Any]] | Layout,
    record_length: int = 0,
    encoding: str = "cp037",
    start_offset: int = 0,
    end_offset: int = 0,
    record_id: bool = False,
) -> DataFrame:
    """Read fixed-length records by a declared layout."""
    layout = Layout.of(fields)
    length = record_length or layout.width
    if start_offset or end_offset or record_id:
        records = read_framed_records(spark, path, length, start_offset, end_offset)
    else:
        records = read_records(spark, path, length)
    return parse_records(records, layout, encoding, record_id)
