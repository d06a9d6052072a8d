"""Field-survey metrics of visits: every function is one aggregation over the rows of a kind of measurement."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import ratio

# Cubic metres of a piece of wood by class of diameter and class of length.
WOOD_VOLUME = {
    "SmallSmall": 0.02035, "SmallMedium": 0.04878, "SmallLarge": 0.10758, "SmallMidLarge": 0.10470, "SmallExtraLarge": 0.23794,
    "MediumSmall": 0.05981, "MediumMedium": 0.15101, "MediumLarge": 0.40012, "MediumMidLarge": 0.33875, "MediumExtraLarge": 0.82393,
    "LargeSmall": 0.22887, "LargeMedium": 0.57739, "LargeLarge": 1.72582,
    "MidLargeSmall": 0.21187, "MidLargeMedium": 0.51680, "MidLargeMidLarge": 1.12232, "MidLargeExtraLarge": 2.71169,
    "ExtraLargeSmall": 0.8432, "ExtraLargeMedium": 1.8900, "ExtraLargeMidLarge": 3.82249, "ExtraLargeExtraLarge": 10.54683,
}
#: A jam's classes: those of pieces without the classes named Large.
JAM_VOLUME = {k: v for k, v in WOOD_VOLUME.items() if not k.replace("MidLarge", "").replace("ExtraLarge", "").count("Large")}


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def preferred_first(df: DataFrame, visit: list[str], kind: str, order: str, value: str, kinds: list[str]) -> DataFrame:
    """(visit, value): of the first record of the first kind that the visit has, in the order of ``kinds``; null without."""
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col(kind))
    known = F.col(kind).isin(*kinds)
    return df.groupBy(*visit).agg(F.min_by(F.when(known, F.col(value)), F.when(known, F.struct(rank, F.col(order)))).alias(value))


def drift_density(df: DataFrame, visit: list[str], order: str, mass: str, portion: str, volume: str) -> DataFrame:
    """Dry mass scaled by the portion of the visit's first result, by the sampled volume; null without a volume."""
    sums = df.groupBy(*visit).agg(F.sum(mass).alias("_m"), F.min_by(portion, order).alias("_p"), F.sum(volume).alias("_v"))
    return sums.select(*visit, F.when(F.col("_v") > 0, F.col("_m") / F.nullif("_p", F.lit(0.0)) / F.col("_v")).alias("density"))


def summed_product(df: DataFrame, visit: list[str], factors: list[str], name: str) -> DataFrame:
    """The sum of products, an unknown factor counting as 0: discharge of stations, volumes of undercut banks."""
    product = F.lit(1.0)
    for f in factors:
        product = product * _zero(F.col(f))
    return df.groupBy(*visit).agg(F.sum(product).alias(name))


def pool_tail_fines(df: DataFrame, visit: list[str], grids: list[tuple[str, str]], cells: int = 50, missing: int = -99) -> DataFrame:
    """Per cent of a grid's cells under fine gravel, mean over all usable grids: (fine, not measurable) of each grid, both
    known, not more than the cells in sum, and some cells measurable."""
    items = F.explode(F.array(*(F.struct(F.col(a).cast("double").alias("fine"), F.col(b).cast("double").alias("lost")) for a, b in grids))).alias("g")
    rows = df.select(*visit, items).select(*visit, "g.fine", "g.lost")
    ok = (F.col("fine") + F.col("lost") <= cells) & (F.col("fine") != missing) & (F.col("lost") != missing) & (F.col("lost") != cells)
    return rows.groupBy(*visit).agg((100 * F.avg(F.when(ok, F.col("fine") / (cells - F.col("lost"))))).alias("fines_pct"))


def both_banks(df: DataFrame, visit: list[str], banks: list[Column], name: str) -> DataFrame:
    """The mean over the banks' known values."""
    return df.select(*visit, F.explode(F.array(*banks)).alias("_v")).groupBy(*visit).agg(F.avg("_v").alias(name))


def wood_volume(pieces: DataFrame, visit: list[str], diameter: str, length: str, wet: Column) -> DataFrame:
    """Volume of measured pieces as cylinders: of all, and of the wet ones."""
    v = math.pi * F.pow(F.col(diameter) / 2, 2) * F.col(length)
    return pieces.groupBy(*visit).agg(F.sum(v).alias("bankfull_volume"), _zero(F.sum(F.when(wet, v))).alias("wetted_volume"))


def class_volume(counts: Column, volumes: dict[str, float]) -> Column:
    """Volume of pieces counted by class (a map of class to number); unknown numbers count as 0."""
    out = F.lit(0.0)
    for name, v in volumes.items():
        out = out + v * _zero(F.try_element_at(counts, F.lit(name)).cast("double"))
    return out


def jam_share(units: DataFrame, jams: DataFrame, jam: str, proportion: str) -> DataFrame:
    """Rows of ``units`` with the volume of their jam times their per cent of it; a jam that isn't there has none."""
    v = jams.groupBy(jam).agg(F.first("volume").alias("_v"))
    return units.filter(F.col(proportion).isNotNull()).join(v, jam, "left").withColumn("volume", _zero(F.col("_v")) * F.col(proportion) / 100).drop("_v")


def tier_means(units: DataFrame, visit: list[str], tier: str, area: str, values: list[str]) -> DataFrame:
    """Means weighed by area over all units of a tier; a unit without a value stays in the divisor."""
    return units.groupBy(*visit, tier).agg(*(ratio(F.sum(F.col(v) * F.col(area)), F.sum(area)).alias(v) for v in values))


def tier_rollup(units: DataFrame, visit: list[str], tier: str, area: str, volume: str, depth: str, length: str) -> DataFrame:
    """Channel units of a tier: area, volume, number, spacing, frequency per 100 of the site's length, per cent of the
    visit's area, largest and mean depth.  ``length`` is the site's, the same in every row of a visit."""
    sums = units.groupBy(*visit, tier).agg(F.sum(area).alias("area"), F.sum(volume).alias("volume"), F.count(F.lit(1)).alias("n"), F.max(depth).alias("max_depth"), F.avg(depth).alias("mean_depth"), F.max(length).alias("_length"))
    total = sums.groupBy(*visit).agg(F.sum("area").alias("_all"))
    n = F.col("n").cast("double")
    return sums.join(total, visit).select(*visit, tier, "area", "volume", "n", "max_depth", "mean_depth", ratio(F.col("_length"), n).alias("spacing"), ratio(100 * n, F.col("_length")).alias("frequency"), ratio(100 * F.col("area"), F.col("_all")).alias("area_pct"))


def cross_sections(stations: DataFrame, section: list[str], at: str, bed: str, wetted: Column) -> DataFrame:
    """Of station points: length, wetted and dry width, the water's level (mean of both ends' beds; null if one is unknown),
    largest and mean positive depth, and width by depth."""
    first, last = F.min_by(bed, at), F.max_by(bed, at)
    ends = stations.groupBy(*section).agg(((first + last) / 2).alias("_level"), (F.max(at) - F.min(at)).alias("length"), (F.max(F.when(wetted, F.col(at))) - F.min(F.when(wetted, F.col(at)))).alias("wetted_width"))
    depth = F.col("_level") - F.col(bed)
    deep = F.when(depth > 0, depth)
    depths = stations.join(ends.select(*section, "_level"), section).groupBy(*section).agg(F.max(deep).alias("max_depth"), F.avg(deep).alias("mean_depth"))
    out = ends.join(depths, section)
    wide = _zero(F.col("wetted_width"))
    return out.select(*section, "length", wide.alias("wetted_width"), (F.col("length") - wide).alias("dry_width"), F.col("_level").alias("level"), "max_depth", "mean_depth", ratio(wide, F.col("max_depth")).alias("width_to_max_depth"), ratio(wide, F.col("mean_depth")).alias("width_to_mean_depth"))


def centerline_summary(lines: DataFrame, visit: list[str], kind: str, length: str, straight: str) -> DataFrame:
    """Numbers and lengths of main and side channels, and the sinuosity of all."""
    is_main = F.col(kind) == "Main"
    of = lambda c: _zero(F.sum(F.when(c, F.col(length))))
    return lines.groupBy(*visit).agg(F.count_if(is_main).alias("n_main"), F.count_if(~is_main).alias("n_side"), of(is_main).alias("main_length"), of(~is_main).alias("side_length"), ratio(F.sum(length), F.sum(straight)).alias("sinuosity"))


def side_channel_pct(units: DataFrame, visit: list[str], small: Column, length: str, width: str, area: str) -> DataFrame:
    """Per cent of the visit's area that small side channels (both sides measured) have; 0 if there is no area at all."""
    side = _zero(F.sum(F.when(small, F.col(length) * F.col(width))))
    total = _zero(F.sum(area))
    return units.groupBy(*visit).agg(F.when(total == 0, F.when(side == 0, 0.0)).otherwise(100 * side / F.nullif(total, F.lit(0.0))).alias("side_channel_pct"))


def undercut(banks: DataFrame, visit: list[str], length: str, area: str, site_length: str, wetted_area: str) -> DataFrame:
    """Length by half the site's length in per cent units, as published no per cent, and per cent of the area."""
    a, total = F.sum(area), F.max(wetted_area)
    return banks.groupBy(*visit).agg(ratio(F.sum(length), F.max(site_length) * 100 / 2).alias("length_pct"), ratio(100 * a, total + a).alias("area_pct"))


def thalweg(lines: DataFrame, key: list[str], line: str, depths: DataFrame, surface: DataFrame, cell_size: float, step: float, centerline: str) -> DataFrame:
    """(key, min, max, mean, stdev, count, length, gradient, gradient_pct, sinuosity, cv, to_centerline) of thalwegs, from a
    raster of depths sampled every ``step`` along each line and from the water surface at its ends (downstream first).

    Minimum and maximum are those of the samples with data; one without makes mean and deviation (of the population) null, as
    a sample of no data does in the original.  ``count`` is the number of samples that are not 0.  A line with an end off the
    water surface has no gradient.
    """
    from ..functions import geometry

    at = lambda c: F.floor(c / cell_size)
    l = F.col(line)
    rows = lines.select(*key, geometry.length(l).alias("length"), geometry.sinuosity(l).alias("sinuosity"), F.col(centerline).alias("_center"), F.explode(geometry.points_along(l, step)).alias("_p"))
    rows = rows.select(*key, "length", "sinuosity", "_center", at(F.col("_p.p.y")).alias("row"), at(F.col("_p.p.x")).alias("col"))
    met = rows.join(depths.select("row", "col", F.col("value").alias("_d")), ["row", "col"], "left")
    whole = F.count(F.lit(1)) == F.count("_d")
    sampled = met.groupBy(*key).agg(
        F.min("_d").alias("min"), F.max("_d").alias("max"), F.when(whole, F.avg("_d")).alias("mean"), F.when(whole, F.stddev_pop("_d")).alias("stdev"),
        (F.count(F.lit(1)) - F.count_if(F.col("_d") == 0)).alias("count"), F.first("length").alias("length"), F.first("sinuosity").alias("sinuosity"), F.first("_center").alias("_center"),
    )
    ends = lines.select(*key, F.explode(F.array(F.struct(F.lit(0).alias("k"), F.element_at(l, 1).alias("p")), F.struct(F.lit(1).alias("k"), F.element_at(l, -1).alias("p")))).alias("_e"))
    ends = ends.select(*key, F.col("_e.k").alias("_k"), at(F.col("_e.p.y")).alias("row"), at(F.col("_e.p.x")).alias("col")).join(surface.select("row", "col", F.col("value").alias("_w")), ["row", "col"], "left")
    rise = ends.groupBy(*key).agg((F.max(F.when(F.col("_k") == 1, F.col("_w"))) - F.max(F.when(F.col("_k") == 0, F.col("_w")))).alias("_rise"))
    out = sampled.join(rise, key).withColumn("gradient", ratio(F.col("_rise"), F.col("length")))
    return out.select(*key, "min", "max", "mean", "stdev", "count", "length", "gradient", (100 * F.col("gradient")).alias("gradient_pct"), "sinuosity", ratio(F.col("stdev"), F.col("mean")).alias("cv"), ratio(F.col("length"), F.col("_center")).alias("to_centerline"))
