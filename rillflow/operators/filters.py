"""Projections, filters and conditional columns."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def complete_rows(df: DataFrame, key: str, fields: list[str], where: str | None = None) -> DataFrame:
    """The key and the fields of rows in which no field is null."""
    out = df.filter(where) if where else df
    return out.filter(reduce(and_, (F.col(f).isNotNull() for f in fields), F.lit(True))).select(key, *fields)


def matching_fields(df: DataFrame, target: list[str]) -> DataFrame:
    """Only the columns that the target has too, in its order and without regard to case."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*(F.col(have[t.lower()]).alias(t) for t in target if t.lower() in have))


def clamp(value: Column, low: float, high: float) -> Column:
    """Null stays null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def first_wins(cases: list[tuple[Column, object]], default: object = None) -> Column:
    out = F
    for cond, value in cases:
        out = out.when(cond, value)
    return out.otherwise(default)


def last_wins(cases: list[tuple[Column, object]], default: object = None) -> Column:
    """The effect of one UPDATE after another: the last condition that holds decides."""
    return first_wins(cases[::-1], default)


def sentinel_to_null(value: Column, *sentinels: object) -> Column:
    return F.when(~value.isin(*sentinels), value)


def empty_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def ladder(value: Column, edges: list[float], labels: list, closed: str = "right", above: object = None) -> Column:
    """Class of a value by upper edges; ``closed`` says on which side an edge belongs to its class.

    A value beyond the last edge gets ``above``; null gets null.
    """
    inside = (lambda v, e: v <= e) if closed == "right" else (lambda v, e: v < e)
    return F.when(value.isNull(), None).otherwise(first_wins([(inside(value, F.lit(e)), x) for e, x in zip(edges, labels, strict=True)], above))


def longest_prefix_with(df: DataFrame, code: str, lengths: list[int], at_least: int) -> DataFrame:
    """Per code, the longest of its prefixes that at least so many rows share: (code, prefix, n_rows).

    One aggregation over all prefix lengths; the codes are joined to the counts of their prefixes.
    """
    prefixes = lambda c: F.array_distinct(F.array(*(F.substring(c, 1, n) for n in lengths)))
    counts = df.select(F.explode(prefixes(code)).alias("prefix")).groupBy("prefix").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") >= at_least)
    codes = df.select(F.col(code).alias("code")).distinct().withColumn("prefix", F.explode(prefixes("code")))
    return codes.join(counts, "prefix").groupBy("code").agg(F.max_by("prefix", F.length("prefix")).alias("prefix"), F.max_by("n_rows", F.length("prefix")).alias("n_rows"))


def rescale(value: Column, old_low: float, old_high: float, low: float = 0.0, high: float = 1.0) -> Column:
    """A range of values mapped to another one."""
    return low + (value - old_low) / (float(old_high) - old_low) * (high - low)
