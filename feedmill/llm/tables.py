"""Table access and small frame helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedmill.session import cut

# A word everywhere in this package: a run of anything but blank, tab, line feed,
# vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def task_count(spark: SparkSession) -> int:
    """Partitions for an explicit repartitioning: the session's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_of(column: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def running_total(df: DataFrame, group: list[str], order: list[Column], values: dict[str, str]) -> DataFrame:
    """Add to every row the sums, within its group and in the given order, up to and with the row.

    ``values`` maps new columns to the columns they sum. The rows are range-partitioned by
    group and order and stored, so a group that holds any share of all rows spreads over
    many tasks; each task sums its own rows, and one row a task and group carries the sums
    of the tasks before it.
    """
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in group]
    stored = cut(
        df.repartitionByRange(task_count(spark), *keys, *order).withColumn("_task", F.spark_partition_id()), "running")
    within = Window.partitionBy("_task", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_before_{k}" for k in range(len(values))]
    before = stored.groupBy("_task", *group).agg(*[F.sum(c).alias(n) for n, c in zip(names, values.values(), strict=True)])
    before = before.select(
        F.col("_task").alias("_of_task"), *[F.col(c).alias(f"_of_{c}") for c in group],
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names])
    same = F.col("_task") == F.col("_of_task")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (
        stored.join(before, same)
        .withColumns({new: F.sum(c).over(within) + F.col(n) for (new, c), n in zip(values.items(), names, strict=True)})
        .drop("_task", "_of_task", *[f"_of_{c}" for c in group], *names)
    )


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return next(name for k in range(len(taken) + 1) if (name := f"_{stem}_{k}") not in taken)


def in_steps(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in steps of a few rows, so that a worker holds few texts as objects; what
    the task has freed is handed back when all are done."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def give_back() -> None:
    """Hand what a task has freed back to the system, when the task ends.

    Workers live on from stage to stage, and what the allocators keep would add to the
    memory of every later stage.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
