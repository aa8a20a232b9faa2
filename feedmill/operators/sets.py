"""Union, merge and sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from feedmill.functions.content import content_hash
from feedmill.functions.names import get_column


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """All frames by column name; columns a frame lacks are NULL."""
    if not frames:
        raise ValueError("a union needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_rows(df: DataFrame, keys: str | list[str], ascending: bool = True) -> DataFrame:
    """Total order by keys, one direction for all of them.

    A content hash breaks ties. Without it every row of a frequent key would
    fall into one range and so into one task. Every column takes part in it:
    select the wanted ones first.
    """
    names = [get_column(df.columns, k) for k in ([keys] if isinstance(keys, str) else keys)]
    if not names:
        raise ValueError("a sort needs keys")
    order = [F.col(n).asc() if ascending else F.col(n).desc() for n in names]
    return df.orderBy(*order, content_hash(df))


def merge_frames(
    frames: list[DataFrame], keys: str | list[str] | None = None, ascending: bool = True
) -> DataFrame:
    """Union, in key order when keys are given."""
    merged = union_frames(frames)
    return sort_rows(merged, keys, ascending) if keys else merged
