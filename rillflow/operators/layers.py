"""Layers of features: copies, selection by location, overlays of boxes and lines, samples, names."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import _segments
from ..session import written
from .joins import boxes_meet, points_in_boxes

#: The name space of domain names, of the published standard for such identifiers.
NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"


def copy_layer(rows: DataFrame, fields: list[str], where: str | None = None, measure: str | None = None, clip: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The fields of rows that pass the filter, whose measure (a length or an area) is not null or zero, and whose point (x, y) lies in the clip box."""
    out = rows.filter(where) if where else rows
    out = out.filter(F.col(measure) > 0) if measure else out
    if clip:
        out = out.filter(F.col("x").between(clip[0], clip[2]) & F.col("y").between(clip[1], clip[3]))
    return out.select(*fields)


def without_small(rows: DataFrame, measure: str, least: float) -> DataFrame:
    """Features of such a length or area at least; unknown ones go."""
    return rows.filter(F.col(measure) >= least)


def select_by_location(points: DataFrame, boxes: DataFrame, key: str, size: float, outside: bool = False) -> DataFrame:
    """The points that lie in any box, or in none; edges belong to a box."""
    inside = points_in_boxes(points, boxes, size).select(key).distinct()
    return points.join(inside, key, "left_anti" if outside else "left_semi").select(*points.columns)


def boxes_overlap(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs of boxes that share an area, columns prefixed ``left_`` and ``right_``, and the area."""
    c = lambda f, x: f(F.col(f"left_{x}"), F.col(f"right_{x}"))
    x0, y0, x1, y1 = c(F.greatest, "xmin"), c(F.greatest, "ymin"), c(F.least, "xmax"), c(F.least, "ymax")
    return boxes_meet(left, right, size).filter((x0 < x1) & (y0 < y1)).withColumn("area", (x1 - x0) * (y1 - y0))


def length_in_box(line: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Length of the part of a line inside a box, as a column expression: each segment is clipped to the range of its
    parameter in which it is inside of both pairs of sides."""

    def inside(p: Column) -> Column:
        ax, ay, dx, dy = p["a"]["x"], p["a"]["y"], p["b"]["x"] - p["a"]["x"], p["b"]["y"] - p["a"]["y"]

        def axis(at: Column, d: Column, low: Column, high: Column) -> tuple[Column, Column]:
            parallel = F.when(at.between(low, high), F.lit(1.0)).otherwise(F.lit(-1.0))
            step = F.nullif(d, F.lit(0.0))
            return F.coalesce(F.least((low - at) / step, (high - at) / step), F.lit(0.0)), F.coalesce(F.greatest((low - at) / step, (high - at) / step), parallel)

        (x_in, x_out), (y_in, y_out) = axis(ax, dx, xmin, xmax), axis(ay, dy, ymin, ymax)
        share = F.least(x_out, y_out, F.lit(1.0)) - F.greatest(x_in, y_in, F.lit(0.0))
        return F.greatest(share, F.lit(0.0)) * F.sqrt(dx * dx + dy * dy)

    return F.aggregate(_segments(line), F.lit(0.0), lambda s, p: s + inside(p))


def lines_in_boxes(lines: DataFrame, boxes: DataFrame, line_keys: list[str], box_keys: list[str], line: str, size: float) -> DataFrame:
    """(line keys, box keys, length): lines with the boxes they run through, and the length inside.  Each segment of a line looks
    for boxes by itself, so a long line is not everywhere that the box around it is."""
    a, b = F.col("s.a"), F.col("s.b")
    segments = lines.select(*line_keys, F.explode(_segments(F.col(line))).alias("s")).select(
        *line_keys, F.array("s.a", "s.b").alias("_segment"), F.least(a["x"], b["x"]).alias("xmin"), F.least(a["y"], b["y"]).alias("ymin"), F.greatest(a["x"], b["x"]).alias("xmax"), F.greatest(a["y"], b["y"]).alias("ymax")
    )
    met = boxes_meet(segments, boxes.select(*dict.fromkeys([*box_keys, "xmin", "ymin", "xmax", "ymax"])), size)
    inside = length_in_box(F.col("left__segment"), *(F.col(f"right_{c}") for c in ("xmin", "ymin", "xmax", "ymax")))
    out = met.groupBy(*(F.col(f"left_{k}").alias(k) for k in line_keys), *(F.col(f"right_{k}").alias(k) for k in box_keys)).agg(F.sum(inside).alias("length"))
    return out.filter("length > 0")


def stratified_sample(points: DataFrame, key: str, extent: tuple[float, float, float, float], cells: int, per_cell: int) -> DataFrame:
    """At most so many points from each cell of a grid over the extent, in the order of a hash of the key; cells with under
    half the mean number of points give none.  Adds (cx, cy).

    The choice per cell keeps the smallest hashes in an aggregation that holds no more than it returns.
    """
    x0, y0, x1, y1 = extent
    p = points.withColumn("cx", F.floor((F.col("x") - x0) / ((x1 - x0) / cells))).withColumn("cy", F.floor((F.col("y") - y0) / ((y1 - y0) / cells)))
    counts = p.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_n"))
    mean = counts.agg(F.avg("_n").alias("_mean"))
    full = counts.crossJoin(F.broadcast(mean)).filter("_n >= 0.5 * _mean").select("cx", "cy")
    rank = F.md5(F.col(key).cast("string").cast("binary"))
    w = Window.partitionBy("cx", "cy").orderBy(rank, key)
    return p.join(F.broadcast(full), ["cx", "cy"], "left_semi").withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= per_cell).drop("_k")


def _largest_remainder(rows: DataFrame, total: Column, size: str, by: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name``: a share of ``total`` for each row in proportion to its size, in whole numbers that sum up to it; what
    rounding down leaves goes to the largest remainders."""
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    # in whole numbers, so that equal remainders are equal
    down = F.expr("_total * `%s` div nullif(_sum, 0)" % size)
    rows = rows.withColumn("_total", total).withColumn("_sum", F.sum(size).over(w)).withColumn("_down", F.coalesce(down, F.lit(0)))
    rows = rows.withColumn("_rest", F.coalesce(F.col("_total") * F.col(size) - F.col("_down") * F.col("_sum"), F.lit(0))).withColumn("_left", F.col("_total") - F.sum("_down").over(w))
    rank = F.row_number().over(w.orderBy(F.desc("_rest"), *order))
    return rows.withColumn(name, F.col("_down") + (rank <= F.col("_left")).cast("int")).drop("_total", "_sum", "_down", "_rest", "_left")


def quota_sample(points: DataFrame, key: str, strata: str, extent: tuple[float, float, float, float], n: int, least: int = 0) -> DataFrame:
    """n of the points (key, stratum, x, y), or all if there are fewer, spread over strata and over the cells of a grid.

    The grid has ceil(sqrt(n)) cells a side; cells with under half the mean number of points give none.  A stratum gets
    ``least`` points (or all it has; in the order of strata if that is more than n altogether), and the rest goes to strata in
    proportion to the points they have left; a stratum's number is dealt to its cells in proportion to their points.  Shares
    are whole numbers by largest remainders, so the numbers are met exactly.  Within a cell and stratum the smallest hashes
    of the key are taken, by a rank over all rows (a range sort), so that no cell is one task.  Adds (cx, cy).
    """
    from .network import ranked

    side = math.ceil(math.sqrt(n))
    x0, y0, x1, y1 = extent
    at = lambda c, low, high: F.least(F.floor((F.col(c) - low) / ((high - low) / side)), F.lit(side - 1))
    p = points.filter(F.col("x").between(x0, x1) & F.col("y").between(y0, y1) & F.col(strata).isNotNull()).withColumn("cx", at("x", x0, x1)).withColumn("cy", at("y", y0, y1))
    cells = p.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_n"))
    total = cells.agg(F.sum("_n").alias("_all"))
    full = cells.crossJoin(F.broadcast(total)).filter(F.col("_n") >= F.ceil(F.col("_all") / (side * side) * 0.5)).select("cx", "cy")
    p = p.join(F.broadcast(full), ["cx", "cy"])  # of at most side^2 rows
    groups = written(p.groupBy(strata, "cx", "cy").agg(F.count(F.lit(1)).alias("_size")))  # strata times cells
    own = groups.groupBy(strata).agg(F.sum("_size").alias("_have"))
    first = F.least(F.col("_have"), F.lit(least))
    before = F.coalesce(F.sum("_first").over(Window.orderBy(strata).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = own.withColumn("_first", first).withColumn("_first", F.greatest(F.least(F.col("_first"), n - before), F.lit(0)))
    own = own.withColumn("_more", F.col("_have") - F.col("_first"))
    everything = Window.partitionBy(F.lit(0))
    spare = F.least(n - F.sum("_first").over(everything), F.sum("_more").over(everything))
    own = _largest_remainder(own, spare, "_more", [], [F.col(strata)], "_second").select(strata, (F.col("_first") + F.col("_second")).alias("_quota"))
    quotas = _largest_remainder(groups.join(own, strata), F.col("_quota"), "_size", [strata], [F.col("cx"), F.col("cy")], "_take").select(strata, "cx", "cy", "_size", "_take")
    # where each group begins among all rows in the order of groups
    order = Window.orderBy(strata, "cx", "cy").rowsBetween(Window.unboundedPreceding, -1)
    quotas = quotas.withColumn("_begins", F.coalesce(F.sum("_size").over(order), F.lit(0)))
    rank = ranked(p.withColumn("_h", F.md5(F.col(key).cast("string").cast("binary"))), [F.col(strata), F.col("cx"), F.col("cy"), F.col("_h"), F.col(key)], "_rank")
    return rank.join(F.broadcast(quotas), [strata, "cx", "cy"]).filter(F.col("_rank") - F.col("_begins") <= F.col("_take")).select(*points.columns, "cx", "cy")


def uuid5(name: Column, namespace: str = NAMESPACE_DNS) -> Column:
    """The identifier that a name has in a name space: bits of its SHA-1 with version 5 and the standard's variant."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), name.cast("binary")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
