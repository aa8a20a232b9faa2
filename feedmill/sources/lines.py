"""Text lines of a feed with their position, read in parallel."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedmill.session import broadcast_if_small, cut, pin_scan_splits

# Part files that Spark writes: several of them are one table or feed.
_PART_FILE = r"/part-\d+[^/]*$"
# A block row holds two paths and a few numbers.
_BLOCK_ROW_BYTES = 512
_LINE = "struct<scan_id: bigint, value: string>"


class Envelope(NamedTuple):
    """Lines of a feed by role; columns ``value``, ``feed``, ``line_no``."""

    data: DataFrame
    header: DataFrame
    trailer: DataFrame


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines of all files below ``path``, with their scan block and a scan id.

    Line ends may be LF or CRLF. Nothing but the scan runs before the id, so ids
    within one block are consecutive.
    """
    pin_scan_splits(spark)
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select(
            "value",
            F.input_file_name().alias("file_path"),
            F.input_file_block_start().alias("block"),
            F.monotonically_increasing_id().alias("scan_id"),
        )
    )


def feed_of(path: Column, unit: str) -> Column:
    """Name of the feed a file belongs to.

    With ``auto``, the part files of a directory are one feed, in part order, and
    any other file is one by itself. ``directory`` takes all files of a directory
    as one feed; ``file`` takes each by itself and refuses part files, which
    would each lose a first and a last line.
    """
    name = F.substring_index(path, "/", -1)
    folder = F.substring(path, F.lit(1), F.length(path) - F.length(name) - 1)
    is_part = path.rlike(_PART_FILE)
    if unit == "auto":
        return F.when(is_part, folder).otherwise(path)
    if unit == "directory":
        return folder
    if unit == "file":
        refused = F.concat(F.lit("a part file is no feed of its own: "), path)
        return F.when(is_part, F.raise_error(refused).cast("string")).otherwise(path)
    raise ValueError(f"unknown feed unit '{unit}'")


def _part_number(path: Column) -> Column:
    """Number of a Spark part file, so that part 100000 follows part 99999."""
    return F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).try_cast("bigint")


def _ends(size: int, best: Callable[[Column], Column]) -> Column:
    """The ``size`` first or last lines of a block, as ``best`` says: of consecutive ids,
    those with the least or highest id of each remainder. Their number is bounded."""
    line = F.struct("scan_id", "value")
    found = [best(F.when(F.col("scan_id") % size == k, line)) for k in range(size)]
    # An aggregate that holds objects, though none here: beside it Spark hashes the blocks,
    # while aggregates of text by themselves would have it sort all lines.
    none = F.collect_list(F.lit(None).cast(_LINE))
    return F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), none) if found else F.array().cast(f"array<{_LINE}>")


def count_blocks(lines: DataFrame, unit: str = "auto", header_count: int = 0, trailer_count: int = 0) -> DataFrame:
    """One row per scan block: its feed, first scan id, line count and offset, and its
    ``header_count`` first and ``trailer_count`` last lines.

    The scan of the lines is reduced to blocks inside each task, so the window
    below sees one short row per file split and never the lines themselves. The
    result is cut from its lineage: every later use shares this one count, and the
    header and trailer lines of all feeds are among the lines it holds.
    """
    per_block = (
        lines.groupBy("file_path", "block")
        .agg(
            F.min("scan_id").alias("first_id"), F.count(F.lit(1)).alias("lines"),
            _ends(header_count, F.min).alias("firsts"), _ends(trailer_count, F.max).alias("lasts"),
        )
        .withColumn("feed", feed_of(F.col("file_path"), unit))
    )
    in_feed = Window.partitionBy("feed")
    before = in_feed.orderBy(_part_number(F.col("file_path")), "file_path", "block")
    return cut(
        per_block.select(
            "*",
            (F.sum("lines").over(before) - F.col("lines")).alias("offset"),
            F.sum("lines").over(in_feed).alias("feed_lines"),
        ),
        "blocks",
    )


def with_positions(
    lines: DataFrame, unit: str = "auto", blocks: DataFrame | None = None
) -> DataFrame:
    """Add ``feed``, ``line_no`` (0-based in the feed) and ``feed_lines`` to lines.

    Both scans must see the same splits. A line that does not fit the counted
    block raises an error, so a changed split can never give a wrong number.
    Lines find their block by the number of the scan's task, one long, and their id.
    All that comes of the blocks is checked: a later condition on a bare column of theirs
    would make this an inner join, which loses lines without a block and checks a line
    against every block of its task.
    """
    blocks = count_blocks(lines, unit) if blocks is None else blocks
    blocks = blocks.select(
        _task(F.col("first_id")).alias("task"), "first_id", (F.col("first_id") + F.col("lines")).alias("next_id"),
        "feed", F.col("file_path").alias("counted_path"), F.col("block").alias("counted_block"), "offset", "feed_lines")
    blocks = broadcast_if_small(blocks, blocks.count(), _BLOCK_ROW_BYTES)
    own = (F.col("task") == _task(F.col("scan_id"))) & (F.col("scan_id") >= F.col("first_id")) & (F.col("scan_id") < F.col("next_id"))
    fits = F.col("counted_block").eqNullSafe(F.col("block")) & F.col("counted_path").eqNullSafe(F.col("file_path"))
    changed = F.raise_error(F.lit("file splits changed between the count and the read"))

    def checked(value: Column, kind: str = "bigint") -> Column:
        return F.when(fits, value).otherwise(changed).cast(kind)

    return lines.join(blocks, own, "left").select(
        "value",
        checked(F.col("feed"), "string").alias("feed"),
        "file_path",
        checked(F.col("offset") + F.col("scan_id") - F.col("first_id")).alias("line_no"),
        checked(F.col("feed_lines")).alias("feed_lines"),
    )


def _task(scan_id: Column) -> Column:
    """The scan task that gave an id."""
    return F.shiftright(scan_id, 33)


def _held(blocks: DataFrame, lines: str) -> DataFrame:
    """The first or last lines that the blocks hold, with their position in the feed."""
    line_no = F.col("offset") + F.col("line.scan_id") - F.col("first_id")
    return blocks.withColumn("line", F.explode(lines)).select(
        F.col("line.value").alias("value"), "feed", "file_path", line_no.alias("line_no"), "feed_lines")


def feed_ends(
    lines: DataFrame, header_count: int = 0, trailer_count: int = 0, unit: str = "auto"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Header and trailer lines of each feed, and the blocks, from one scan of the lines."""
    keep = ["value", "feed", "file_path", "line_no"]
    blocks = count_blocks(lines, unit, header_count, trailer_count)
    header = _held(blocks, "firsts").filter(F.col("line_no") < header_count)
    trailer = _held(blocks, "lasts").filter(F.col("line_no") >= F.col("feed_lines") - trailer_count)
    return header.select(keep), trailer.select(keep), blocks


def split_envelope(
    lines: DataFrame,
    header_count: int = 0,
    trailer_count: int = 0,
    unit: str = "auto",
) -> Envelope:
    """Split each feed into its first lines, last lines and the lines between.

    Without header and trailer no position is needed and nothing is counted; with
    them the count also brings the header and trailer lines, a few per feed, which are
    stored with it and cost no scan of their own. Blank lines count as lines but are not data.
    """
    keep = ["value", "feed", "file_path", "line_no"]
    not_blank = F.trim("value") != ""
    if not (header_count or trailer_count):
        plain = lines.select(
            "value",
            feed_of(F.col("file_path"), unit).alias("feed"),
            "file_path",
            F.lit(None).cast("bigint").alias("line_no"),
        )
        return Envelope(plain.filter(not_blank), plain.limit(0), plain.limit(0))
    header, trailer, blocks = feed_ends(lines, header_count, trailer_count, unit)
    placed = with_positions(lines, unit, blocks)
    inner = (F.col("line_no") >= header_count) & (F.col("line_no") < F.col("feed_lines") - trailer_count)
    return Envelope(placed.filter(inner & not_blank).select(keep), header, trailer)
