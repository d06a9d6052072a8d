"""Intervals (a, b) along streams: union, splitting, confinement; a stream is cut in stretches, so none is one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _carried(rows: DataFrame, keys: list[str], value: Column, how, name: str) -> DataFrame:
    """(keys, _s, name): per stretch, ``value`` aggregated by ``how`` over all stretches of the key before it.

    There is a row per stretch, of which a key has few.
    """
    per = rows.groupBy(*keys, "_s").agg(value.alias("_v"))
    before = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*keys, "_s", how("_v").over(before).alias(name))


def _with(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Null keys meet each other too.  What is carried, a row per stretch, is hashed in each partition, and the rows stay dealt by
    stretch whichever side is smaller."""
    c = carried.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_s").alias("_ks"), *(x for x in carried.columns if x not in (*keys, "_s")))
    on = F.col("_s") == F.col("_ks")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(c.hint("shuffle_hash"), on).drop("_ks", *(f"_k{i}" for i in range(len(keys))))


def dissolve(df: DataFrame, keys: list[str], a: str, b: str, stretch: float) -> DataFrame:
    """(keys, a, b): overlapping and touching intervals of a key joined into one.

    A stream is cut in stretches of the given length, so a long one is many tasks; how far the stretches before one reach, and
    where the last island before it began, is handed on by a row per stretch.  Intervals without a beginning or an end
    say nothing.
    """
    rows = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*keys, a).agg(F.max(b).alias(b)).withColumn("_s", F.floor(F.col(a) / stretch))
    w = Window.partitionBy(*keys, "_s").orderBy(a)
    rows = _with(rows, _carried(rows, keys, F.max(b), F.max, "_before"), keys)
    reached = F.greatest(F.max(b).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_before"))
    marked = rows.withColumn("_first", F.when(F.coalesce(F.col(a) > reached, F.lit(True)), F.col(a))).drop("_before")
    marked = _with(marked, _carried(marked, keys, F.max("_first"), F.max, "_open"), keys)
    island = F.coalesce(F.max("_first").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("_open"))
    return marked.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(a).alias(a), F.max(b).alias(b)).drop("_island")


def split(df: DataFrame, keys: list[str], a: str, b: str, flags: dict[str, Column], stretch: float) -> DataFrame:
    """(keys, a, b, flags): the pieces between neighbouring ends of a key's intervals that any interval covers, and for each
    flag whether an interval of that kind covers the piece.

    An interval is +1 where it begins and -1 where it ends; running sums along the stream tell what covers a piece, so no
    interval is compared with another.  A stream is cut in stretches of the given length: what is open at the beginning
    of a stretch is the sum of the stretches before, and its last piece ends where the next stretch with ends begins.
    """
    ends = F.explode(F.array(F.struct(F.col(a).alias("x"), F.lit(1).alias("d")), F.struct(F.col(b).alias("x"), F.lit(-1).alias("d"))))
    kinds = {name: F.coalesce(c, F.lit(False)).cast("int") for name, c in flags.items()}
    events = df.filter(F.col(a) < F.col(b)).select(*keys, *(c.alias(n) for n, c in kinds.items()), ends.alias("e"))
    counts = ["_all", *kinds]
    steps = events.groupBy(*keys, F.col("e.x").alias(a)).agg(F.sum("e.d").alias("_all"), *(F.sum(F.col("e.d") * F.col(n)).alias(n) for n in kinds)).withColumn("_s", F.floor(F.col(a) / stretch))
    per = steps.groupBy(*keys, "_s").agg(F.min(a).alias("_least"), *(F.sum(n).alias(f"_sum_{n}") for n in counts))
    along = Window.partitionBy(*keys).orderBy("_s")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_s", F.lead("_least").over(along).alias("_next"), *(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_open_{n}") for n in counts))
    w = Window.partitionBy(*keys, "_s").orderBy(a)
    runs = _with(steps, per, keys)
    open_now = {n: F.sum(n).over(w) + F.col(f"_open_{n}") for n in counts}
    runs = runs.select(*keys, a, F.coalesce(F.lead(a).over(w), F.col("_next")).alias(b), *((c > 0).alias(n) for n, c in open_now.items()))
    return runs.filter(F.col(b).isNotNull() & F.col("_all")).drop("_all")


def confinement(pieces: DataFrame, keys: list[str], left: str, right: str, a: str = "a", b: str = "b") -> DataFrame:
    """(keys, length, ratio, constriction) of pieces that are confined on the left, on the right, on both sides or not.

    A piece confined on both sides counts for either side in the ratio, which is 1 at most.
    """
    size = F.col(b) - F.col(a)
    of = lambda c: F.sum(F.when(c, size).otherwise(0.0))
    total = F.nullif(F.sum(size), F.lit(0.0))
    return pieces.groupBy(*keys).agg(F.sum(size).alias("length"), F.least((of(F.col(left)) + of(F.col(right))) / total, F.lit(1.0)).alias("ratio"), (of(F.col(left) & F.col(right)) / total).alias("constriction"))
