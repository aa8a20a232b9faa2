"""Equi-joins of named frames."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from feedmill.functions.content import content_hash
from feedmill.functions.names import get_column
from feedmill.session import cut

# Join words -> Spark join type. "cross" with keys is an inner join.
KINDS = {
    "inner": "inner",
    "cross": "inner",
    "left": "left",
    "leftouter": "left",
    "left_outer": "left",
    "right": "right",
    "rightouter": "right",
    "right_outer": "right",
    "outer": "full",
    "full": "full",
    "fullouter": "full",
    "full_outer": "full",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "left_semi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
    "left_anti": "left_anti",
}
_SALT, _SALTS, _REPEATED, _DROP = "__salt", "__salts", "__repeated", "__other_repeated"
# A key is hot well below a task's even share, so that no key just under it is left whole.
_HOT_FACTOR = 4


def join_frames(
    left: DataFrame,
    right: DataFrame,
    on: list[Any],
    how: str = "inner",
    skew_parts: int = 0,
) -> DataFrame:
    """Join on ``[["l", "r"], ...]`` pairs, or on ``["k", ...]`` shared names.

    Pairs keep both key columns; shared names are kept once, first. Which side
    is broadcast, if any, is Spark's choice from size statistics, and adaptive
    execution splits skewed partitions. ``skew_parts`` > 1 spreads hot keys
    explicitly as well, see :func:`salted_join`. Both frames may come from the
    same source.
    """
    kind = KINDS.get(how.lower())
    if kind is None:
        raise ValueError(f"unknown join type '{how}'")
    if not on:
        raise ValueError("a join needs keys: every pair of rows is never wanted")
    left_at = {c: f"__l{i}" for i, c in enumerate(left.columns)}
    right_at = {c: f"__r{i}" for i, c in enumerate(right.columns)}
    pairs = [(p, p) if isinstance(p, str) else (p[0], p[1]) for p in on]
    names = [(get_column(left_at, a), get_column(right_at, b)) for a, b in pairs]
    keys = [(left_at[a], right_at[b]) for a, b in names]
    # Names of their own keep the sides apart until the result is named.
    sides = left.toDF(*left_at.values()), right.toDF(*right_at.values())
    joined = salted_join(*sides, keys, kind, skew_parts)
    wide = kind not in ("left_semi", "left_anti")
    shown = []
    if all(isinstance(k, str) for k in on):
        for (a, b), (left_key, right_key) in zip(names, keys):
            both = {"right": [right_key], "full": [left_key, right_key]}.get(kind, [left_key])
            shown.append(F.coalesce(*both).alias(a))
            del left_at[a], right_at[b]
    shown += [F.col(at).alias(c) for c, at in left_at.items()]
    shown += [F.col(at).alias(c) for c, at in right_at.items()] if wide else []
    return joined.select(*shown)


def _equal(keys: list[tuple[str, str]]) -> Column:
    return reduce(and_, [F.col(a) == F.col(b) for a, b in keys])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    kind: str,
    parts: int,
) -> DataFrame:
    """Join that spreads each hot key, of either side, over ``parts`` tasks.

    Rows of a key that is hot on their own side, or of no key, get a salt from their
    own content; the rows of the other side are repeated once per salt. A left row
    repeated for a key that is hot on the right has a match for at least one salt, so
    the salts without one are dropped. Rows of other keys are neither salted nor
    repeated, so the result is the plain join's. For a right join the sides are
    swapped. Every column takes part in the salt: select the wanted ones first. One
    part is the plain join. Semi and anti joins spread the left side only.

    A full join is the left join and the right rows that found no match:
    adaptive execution cannot split a skewed full join, but can split both of
    these, and neither needs to move a left side whose partner is small.
    """
    if kind == "full":
        matched = salted_join(left, right, keys, "left", parts)
        known = left.select(*[F.col(a) for a, _ in keys]).distinct()
        lone = right.join(known, _equal(keys), "left_anti")
        return matched.unionByName(lone, allowMissingColumns=True)
    if parts <= 1:
        return left.join(right, _equal(keys), kind)
    if kind == "right":
        return salted_join(right, left, [(b, a) for a, b in keys], "left", parts)
    left_keys, right_keys = [a for a, _ in keys], [b for _, b in keys]
    hot = _hot_of_both(left, left_keys, right, right_keys, parts) if kind in ("inner", "left") else [
        cut(hot_keys(left, left_keys, parts), "hot"), None]
    # A key that is hot on both sides is spread on the right and repeated on the left.
    salted = _salt_rows(left, left_keys, hot, parts, repeat_first=True)
    repeated = _salt_rows(right, right_keys, hot[::-1], parts, repeat_first=False).withColumnsRenamed({_SALT: _SALTS, _REPEATED: _DROP})
    joined = salted.join(repeated, _equal([*keys, (_SALT, _SALTS)]), kind)
    if kind == "left":
        joined = joined.where(~F.col(_REPEATED) | F.col(_SALTS).isNotNull())
    return joined.drop(_SALT, _SALTS, _REPEATED, _DROP)


def hot_keys(df: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """Keys that hold more than ``1 / (4 * parts)`` of the rows that have a key.

    Fewer than ``4 * parts`` keys can qualify, whatever the size of ``df``: that is
    the bound that makes the result safe to broadcast. Counts are combined in each
    task before they are shuffled.
    """
    per_key = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    total = per_key.agg(F.sum("rows")).scalar()
    return per_key.filter(F.col("rows") * (_HOT_FACTOR * parts) > total).select(
        *[F.col(c).alias(f"__hot_{i}") for i, c in enumerate(columns)]
    )


def _hot_of_both(left: DataFrame, left_keys: list[str], right: DataFrame, right_keys: list[str], parts: int) -> list[DataFrame]:
    """The hot keys of both sides; keys of the same types are counted by one job."""
    found = [hot_keys(left, left_keys, parts), hot_keys(right, right_keys, parts)]
    if [f.dataType for f in found[0].schema] != [f.dataType for f in found[1].schema]:
        return [cut(side, "hot") for side in found]
    both = cut(reduce(DataFrame.unionByName, [df.withColumn("__side", F.lit(k)) for k, df in enumerate(found)]), "hot")
    return [both.where(F.col("__side") == k).drop("__side") for k in range(2)]


def _flag_hot(df: DataFrame, keys: list[str], hot: DataFrame | None, name: str) -> DataFrame:
    if hot is None:
        return df.withColumn(name, F.lit(False))
    named = [f"{name}_{i}" for i in range(len(keys))]
    marks = F.broadcast(hot.toDF(*named).withColumn(name, F.lit(True)))
    flagged = df.join(marks, _equal(list(zip(keys, named))), "left")
    return flagged.withColumn(name, F.col(name).isNotNull()).drop(*named)


def _salt_rows(
    df: DataFrame, keys: list[str], hot: list[DataFrame | None], parts: int, repeat_first: bool
) -> DataFrame:
    """Rows with their salt: ``hot`` has the hot keys of this side and of the other one."""
    flagged = _flag_hot(_flag_hot(df, keys, hot[0], "__own"), keys, hot[1], _REPEATED)
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    spread = F.array(F.pmod(content_hash(df), F.lit(parts)).cast("int"))
    spreads = [(F.col("__own") | no_key, spread)]
    repeats = [(F.col(_REPEATED), F.sequence(F.lit(0), F.lit(parts - 1)))]
    (first, salts), (second, others) = repeats + spreads if repeat_first else spreads + repeats
    salts = F.when(first, salts).when(second, others).otherwise(F.array(F.lit(0)))
    return flagged.select(*df.columns, _REPEATED, F.explode(salts).alias(_SALT))
