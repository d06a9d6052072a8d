"""Set operations and merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None, keep_old: bool = False) -> DataFrame:
    """One row per key: the new one replaces the old, or stays out with ``keep_old``; within a side the largest
    ``order`` (then the largest row) wins."""
    both = old.withColumn("_side", F.lit(1 if keep_old else 0)).unionByName(new.withColumn("_side", F.lit(0 if keep_old else 1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys, "_side")]
    rank = F.struct("_side", *([order] if order else []), *rest)
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))


def difference(rows: DataFrame, remove: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(remove.select(*keys).distinct(), keys, "left_anti")


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in an explicit order; an aggregation, so a hot key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, *rest)).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))
