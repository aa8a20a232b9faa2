"""Hashes of row content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def content_hash(df: DataFrame) -> Column:
    """Hash of a row, of all columns that can be hashed.

    It spreads rows the same way whenever a task is run again, unlike a random
    number or a row number.
    """
    columns = [
        f.name for f in df.schema
        if not any(word in f.dataType.simpleString() for word in ("map<", "variant"))
    ]
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(0).cast("bigint")
