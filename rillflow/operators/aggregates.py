"""Grouped statistics: shares, weighted means, majorities, bins, pivots, profiles, percentiles, regressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """Null where the divisor is zero or null."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def share_of_total(df: DataFrame, zone: list[str], part: list[str], value: str, name: str = "share") -> DataFrame:
    """(zone, part, value, share): each part's sum over its zone's.  The window sees one row per zone and part."""
    parts = df.groupBy(*zone, *part).agg(F.sum(value).alias(value))
    return parts.withColumn(name, ratio(F.col(value), F.sum(value).over(Window.partitionBy(*zone))))


def share_of_everything(df: DataFrame, part: list[str], value: str, name: str = "share") -> DataFrame:
    """The same over the whole table: a cross join with one row."""
    parts = df.groupBy(*part).agg(F.sum(value).alias(value))
    total = df.agg(F.sum(value).alias("_total"))
    return parts.crossJoin(F.broadcast(total)).select(*part, value, ratio(F.col(value), F.col("_total")).alias(name))


def weighted_mean(value: Column, weight: Column, null_weighs: bool = False) -> Column:
    """An aggregate.  With ``null_weighs``, a row without a value still counts in the divisor."""
    w = weight if null_weighs else F.when(value.isNotNull(), weight)
    return ratio(F.sum(value * weight), F.sum(w))


def majority(df: DataFrame, zone: list[str], attribute: str, weight: str) -> DataFrame:
    """The attribute with the largest weight per zone; of equal weights the smallest attribute."""
    sums = df.groupBy(*zone, attribute).agg(F.sum(weight).alias("_w"))
    return sums.groupBy(*zone).agg(F.min_by(attribute, F.struct(-F.col("_w"), F.col(attribute))).alias(attribute), F.max("_w").alias(weight))


def over_share(df: DataFrame, zone: list[str], part: str, value: str, threshold: float) -> DataFrame:
    """The parts with more than such a share of their zone, sorted and joined by commas."""
    shares = share_of_total(df, zone, [part], value)
    return shares.groupBy(*zone).agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("share") > threshold, F.col(part).cast("string")))), ",").alias("parts"))


def majority_flag(condition: Column, weight: Column, share: float = 0.5) -> Column:
    """An aggregate: whether the condition holds for more than such a share of the weight."""
    return F.coalesce(ratio(F.sum(F.when(condition, weight).otherwise(0.0)), F.sum(weight)) > share, F.lit(False))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, max, min, avg, n, n_null) in one pass."""
    per = [F.struct(F.lit(c).alias("field"), F.max(c).cast("double").alias("max"), F.min(c).cast("double").alias("min"), F.avg(c).alias("avg"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("n_null")) for c in columns]
    return df.agg(F.array(*per).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def mode(df: DataFrame, zone: list[str], value: str) -> DataFrame:
    """The most frequent value; of equal counts the smallest."""
    counts = df.groupBy(*zone, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*zone).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n"))


def value_counts(df: DataFrame, zone: list[str], value: str) -> DataFrame:
    """Rows per zone and value, with the running count in the order of the values.  What follows a group of any size is
    as large as its distinct values."""
    w = Window.partitionBy(*zone).orderBy(value)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*zone, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(*zone)))


def percentile_by_rank(df: DataFrame, zone: list[str], value: str, percents: list[int]) -> DataFrame:
    """The value at index floor(n * p / 100) of the sorted values, as one column ``d<p>`` per percent."""
    c = value_counts(df, zone, value)
    at = lambda p: F.least(F.floor(F.col("total") * p / 100), F.col("total") - 1)
    holds = lambda p: (F.col("upto") > at(p)) & (F.col("upto") - F.col("n") <= at(p))
    return c.groupBy(*zone).agg(*(F.max(F.when(holds(p), F.col(value))).alias(f"d{p}") for p in percents))


def percentile_log(classes: DataFrame, zone: list[str], low: str, high: str, n: str, percents: list[int]) -> DataFrame:
    """Percentiles of counted size classes by interpolation between the logarithms of a class's bounds."""
    w = Window.partitionBy(*zone).orderBy(high)
    c = classes.withColumn("_upto", 100 * F.sum(n).over(w) / F.nullif(F.sum(n).over(Window.partitionBy(*zone)), F.lit(0)))
    c = c.withColumn("_before", F.coalesce(F.lag("_upto").over(w), F.lit(0.0)))
    inside = lambda p: (F.col("_before") < p) & (F.col("_upto") >= p)
    part = lambda p: (p - F.col("_before")) / (F.col("_upto") - F.col("_before"))
    value = lambda p: F.when(F.col(low) > 0, F.exp(F.log(low) + part(p) * (F.log(high) - F.log(low)))).otherwise(part(p) * F.col(high))
    return c.groupBy(*zone).agg(*(F.max(F.when(inside(p), value(p))).alias(f"d{p}") for p in percents))


def cumulative_percent(df: DataFrame, zone: list[str], order: str, value: str) -> DataFrame:
    parts = df.groupBy(*zone, order).agg(F.sum(value).alias(value))
    w = Window.partitionBy(*zone).orderBy(order)
    return parts.withColumn("cumulative_pct", 100 * ratio(F.sum(value).over(w), F.sum(value).over(Window.partitionBy(*zone))))


def binned_sum(df: DataFrame, zone: list[str], label: Column, value: str) -> DataFrame:
    return df.select(*zone, label.alias("bin"), value).filter("bin is not null").groupBy(*zone, "bin").agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("n"))


def equal_width_histogram(df: DataFrame, value: str, weight: str, bins: int) -> DataFrame:
    """(bin, low, high, weight, n): bins of equal width over min..max, the last one closed."""
    span = df.agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    rows = df.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(span))
    width = (F.col("_hi") - F.col("_lo")) / bins
    number = F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1)))
    out = rows.groupBy(number.cast("int").alias("bin"), "_lo", "_hi").agg(F.sum(weight).alias(weight), F.count(F.lit(1)).alias("n"))
    return out.select("bin", (F.col("_lo") + F.col("bin") * width).alias("low"), (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"), weight, "n")


def pivot_sum(df: DataFrame, keys: list[str], column: str, values: list, value: str) -> DataFrame:
    """Conditional sums with the list of values given, so that no pass over the data looks for them."""
    return df.groupBy(*keys).pivot(column, values).agg(F.sum(value)).na.fill(0, [str(v) for v in values])


def eav_to_wide(df: DataFrame, keys: list[str], attribute: str, value: str, columns: dict[object, tuple[str, str]]) -> DataFrame:
    """A long table of texts as one row per key; ``columns`` maps an attribute to its column's name and type."""
    return df.groupBy(*keys).agg(*(F.max(F.when(F.col(attribute) == k, F.col(value))).try_cast(kind).alias(name) for k, (name, kind) in columns.items()))


def regression_choice(df: DataFrame, zone: list[str], x: str, y: str) -> DataFrame:
    """Of a line through the origin and a power law (a line through logarithms), the one with the larger R squared.

    (zone, kind, slope, intercept, r2).  Rows with x = 0 teach nothing; the power law uses rows with x, y > 0.
    """
    rows = df.filter((F.col(x) != 0) & F.col(y).isNotNull()).select(*zone, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    positive = (F.col("x") > 0) & (F.col("y") > 0)
    lx, ly = F.when(positive, F.log10("x")), F.when(positive, F.log10("y"))
    fit = rows.groupBy(*zone).agg(
        ratio(F.sum(F.col("x") * F.col("y")), F.sum(F.col("x") * F.col("x"))).alias("b"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.count(F.lit(1)).cast("double").alias("n"),
        F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("cxy"),
        F.regr_slope(ly, lx).alias("ls"), F.regr_intercept(ly, lx).alias("li"), F.regr_r2(ly, lx).alias("lr"),
    )
    b = F.col("b")
    # from centred moments, so that large values far from zero don't cancel
    off = F.col("my") - b * F.col("mx")
    residual = F.col("vy") - 2 * b * F.col("cxy") + b * b * F.col("vx") + off * off
    r2 = 1 - ratio(residual, F.col("vy"))
    power = F.coalesce(F.col("lr") > r2, F.col("lr").isNotNull())
    pick = lambda p, o: F.when(power, p).otherwise(o)
    return fit.select(*zone, pick(F.lit("power"), F.lit("origin")).alias("kind"), pick(F.col("ls"), b).alias("slope"), pick(F.col("li"), F.lit(0.0)).alias("intercept"), pick(F.col("lr"), r2).alias("r2"))


def cumulative_classes(df: DataFrame, zone: list[str], value: str, weight: str, maxima: dict[str, float]) -> DataFrame:
    """Weight of each class, a class ending at its maximum; one pass instead of differences of running sums."""
    steps = sorted(maxima.items(), key=lambda x: x[1])
    cols, before = [], None
    for name, top in steps:
        here = F.col(value) <= top if before is None else (F.col(value) <= top) & (F.col(value) > before)
        cols.append(F.coalesce(F.sum(F.when(here, F.col(weight))), F.lit(0.0)).alias(name))
        before = top
    return df.groupBy(*zone).agg(*cols)


def zero_filled(df: DataFrame, lookup: DataFrame, column: str, key: str, measures: dict[str, Column], empty: dict[str, object]) -> DataFrame:
    """(key, measures) for every key of a lookup; keys without rows get the values of ``empty``."""
    sums = df.groupBy(F.col(column).alias("_k")).agg(*(c.alias(n) for n, c in measures.items()))
    return lookup.select(key).join(sums, F.col(key) == F.col("_k"), "left").select(key, *(F.coalesce(F.col(n), F.lit(empty[n])).alias(n) for n in measures))


def filtered_sums(df: DataFrame, zone: list[str], cases: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Many sums, each over the rows of its own condition, in one aggregation; a case without rows is 0."""
    one = lambda value, cond: F.sum(value) if cond is None else F.sum(F.when(cond, F.col(value)).otherwise(0.0))
    return df.groupBy(*zone).agg(*(one(*case).alias(name) for name, case in cases.items()))


def generated(df: DataFrame, zone: list[str], spec: list[tuple[str, str, str, float, str | None]]) -> DataFrame:
    """Aggregates from rows (name, method, field, factor, filter)."""
    methods = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}
    value = lambda field, cond: F.when(F.expr(cond), F.col(field)) if cond else F.col(field)
    return df.groupBy(*zone).agg(*((methods[m](value(field, cond)) * factor if factor != 1 else methods[m](value(field, cond))).alias(name) for name, m, field, factor, cond in spec))


def electivity(df: DataFrame, column: str, length: str, number: str) -> DataFrame:
    """(class, length, dams, pct_length, pct_dams, electivity): what share of the dams a class has for its share of the length."""
    c = df.groupBy(F.col(column).alias("class")).agg(F.sum(length).alias("length"), F.sum(number).alias("dams"))
    total = c.agg(F.sum("length").alias("_l"), F.sum("dams").alias("_d"))
    pct_l, pct_d = ratio(100 * F.col("length"), F.col("_l")), ratio(100.0 * F.col("dams"), F.col("_d").cast("double"))
    return c.crossJoin(F.broadcast(total)).select("class", "length", "dams", pct_l.alias("pct_length"), pct_d.alias("pct_dams"), ratio(pct_d, pct_l).alias("electivity"))
