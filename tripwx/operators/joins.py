"""Unions and equi-joins of a large fact table to a small dimension.

The reference joins trips to a 265-row zone table and to hourly weather,
both tiny next to the trips.  A broadcast hash join avoids shuffling the
trips, but only while the dimension really is small: its size in bytes, as
the optimizer estimates it, is checked against a bound.  Nothing runs to
find it out.  Beyond the bound the join is planned as any other: adaptive
execution still turns it into a broadcast if the dimension proves small at
run time, and splits hot keys of the fact side.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_MAX_BYTES = 256 * 2 ** 20
SALTED = ("inner", "left", "leftouter", "left_outer", "semi", "leftsemi", "left_semi", "anti", "leftanti", "left_anti")


def union_positional(*frames: DataFrame) -> DataFrame:
    """UNION ALL by position (type widening as Spark applies it)."""
    return functools.reduce(DataFrame.union, frames)


def union_by_name(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    return functools.reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_small(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left",
               max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, salt_buckets: int = 0) -> DataFrame:
    """Equi-join ``fact`` to a dimension with USING semantics (keys once,
    first in the output).

    * dimension estimated within ``max_bytes``: broadcast hash join, no
      shuffle of the fact side;
    * otherwise a join as adaptive execution chooses it.  With
      ``salt_buckets > 1`` the fact rows are spread over that many sub-keys
      by a hash of the row (the same for a retried task) and the dimension
      is replicated per sub-key, so no single key lands in one task.  That
      holds for joins that keep no unmatched dimension row; others are
      refused.
    """
    on = list(on)
    if estimated_bytes(dim) <= max_bytes:
        return fact.join(F.broadcast(dim), on, how)
    if salt_buckets and salt_buckets > 1:
        if how.lower() not in SALTED:
            raise ValueError(f"a {how} join would repeat unmatched dimension rows per salt")
        salt = "__salt"
        row = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
        salted_fact = fact.withColumn(salt, F.pmod(row, F.lit(salt_buckets)).cast("int"))
        salted_dim = dim.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        return salted_fact.join(salted_dim, on + [salt], how).drop(salt)
    return fact.join(dim, on, how)
