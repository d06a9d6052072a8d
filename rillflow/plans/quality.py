"""Data-quality rules: rows of (rule, count) and of (test, status, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n): how many rows break each rule, in one pass; an unknown outcome breaks none."""
    counts = [F.struct(F.lit(name).alias("rule"), F.count_if(~cond).alias("n")) for name, cond in rules.items()]
    return df.agg(F.array(*counts).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def threshold_tests(df: DataFrame, code: str, limits: dict[str, tuple[int, int]]) -> DataFrame:
    """(test, status, message) for codes that must occur at least so often: (error below, warning below)."""
    tests = []
    for c, (error, warning) in limits.items():
        n = F.count_if(F.col(code) == c)
        status = F.when(n < error, "Error").when(n < warning, "Warning").otherwise("Pass")
        tests.append(F.struct(F.lit(c).alias("test"), status.alias("status"), F.concat(F.lit(f"{c}: "), n.cast("string"), F.lit(" rows")).alias("message")))
    return df.agg(F.array(*tests).alias("t")).select(F.explode("t").alias("t")).select("t.*")
