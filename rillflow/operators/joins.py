"""Joins beyond the built-in ones: nearest key, spatial by grid cells, overrides, incremental keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


def with_override(base: DataFrame, override: DataFrame, keys: list[str], value: str, by: str) -> DataFrame:
    """A value replaced where the override has one."""
    o = override.select(*keys, F.col(by).alias("_by"))
    return base.join(o, keys, "left").withColumn(value, F.coalesce("_by", value)).drop("_by")


def copy_attributes(target: DataFrame, source: DataFrame, key: str, attributes: list[str], null_first: bool = False) -> DataFrame:
    """Attributes of the source written over those of the target, by key; absent keys keep what they have, or with
    ``null_first`` get null."""
    s = source.select(F.col(key).alias("_k"), *(F.col(a).alias(f"_{a}") for a in attributes))
    out = target.join(s, F.col(key) == F.col("_k"), "left")
    rest = [c for c in target.columns if c not in attributes]
    return out.select(*rest, *((F.coalesce(F.col(f"_{a}"), F.col(a)) if a in target.columns and not null_first else F.col(f"_{a}")).alias(a) for a in attributes))


def not_processed(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def nearest_key(left: DataFrame, right: DataFrame, on: list[str], left_at: str, right_at: str, within: float) -> DataFrame:
    """Each left row with the right row of the same keys nearest to it, within a distance; of two as near the smaller.

    Left rows are asked about once per distinct (keys, place), in cells as long as the distance: a place asks its own cell and
    the two beside it.  The answers are joined back, so rows without a match and equal rows stay.
    """
    cell = lambda c: F.floor(F.col(c) / within).cast("long")
    asked = left.select(*(F.col(k).alias(f"_l_{k}") for k in on), F.col(left_at).alias("_at")).distinct()
    l = asked.withColumn("_cell", F.explode(F.array(cell("_at") - 1, cell("_at"), cell("_at") + 1)))
    r = right.select(*(F.col(c).alias(f"_r_{c}") for c in right.columns)).withColumn("_r_cell", cell(f"_r_{right_at}"))
    cond = F.col("_cell") == F.col("_r_cell")
    for k in on:
        cond = cond & (F.col(f"_l_{k}") == F.col(f"_r_{k}"))
    d = F.abs(F.col("_at") - F.col(f"_r_{right_at}"))
    near = l.join(r, cond).filter(d <= within)
    keys = [*(f"_l_{k}" for k in on), "_at"]
    best = near.groupBy(*keys).agg(F.min_by(F.struct(*(F.col(f"_r_{c}").alias(c) for c in right.columns)), F.struct(d, F.col(f"_r_{right_at}"))).alias("_n"), F.min(d).alias("distance"))
    back = F.col(left_at) == F.col("_at")
    for k in on:
        back = back & (F.col(k) == F.col(f"_l_{k}"))
    return left.join(best, back, "left").select(*left.columns, *(F.col(f"_n.{c}").alias(f"near_{c}") for c in right.columns if c not in on), "distance")


# --- a grid of levels ---------------------------------------------------------------------------------------------------
#
# A box is stored once: at the level of which the cells are as large as it is (each level's are twice as large as those
# of the level below), in the cell of its lower left corner.  So a box that covers everything is one row, and who looks for
# boxes asks a few cells of each level that has any.  Cells that would be more than a task's share are cut by counts taken
# first: the askers and the boxes of such a cell are dealt to parts, and each part of the one meets each part of the other.

#: Rows of either side that a part of a cell has at most, about.
CELL_ROWS = 50_000
_CELL = ("_lv", "_cx", "_cy")
SIDES = ("xmin", "ymin", "xmax", "ymax")


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{prefix}{c}") for c in df.columns))


def stored(boxes: DataFrame, size: float, prefix: str = "") -> DataFrame:
    """Adds the cell (level, cx, cy) at which a box is stored; boxes with a null side are left out."""
    x0, y0, x1, y1 = (F.col(f"{prefix}{c}").cast("double") for c in SIDES)
    extent = F.greatest(x1 - x0, y1 - y0, F.lit(0.0))
    near = F.greatest(F.ceil(F.log2(F.greatest(extent, F.lit(size)) / size)), F.lit(0)).cast("int")
    level = F.when(F.pow(F.lit(2.0), near) * size < extent, near + 1).otherwise(near)  # the logarithm is rounded
    width = F.pow(F.lit(2.0), F.col("_lv")) * size
    return boxes.filter(x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull()).withColumn("_lv", level).withColumns({"_cx": F.floor(x0 / width), "_cy": F.floor(y0 / width)})


def _levels(boxes: DataFrame) -> list[int]:
    """The levels that have boxes: a few dozen numbers at most."""
    return sorted(r[0] for r in boxes.select("_lv").distinct().collect())


def asked(rows: DataFrame, levels: list[int], size: float, box: tuple[Column, Column, Column, Column], own: Column | None = None, above: int = 0) -> DataFrame:
    """A row for each cell that can hold a box that meets the row's own one, at the levels from ``own`` + ``above`` on."""
    x0, y0, x1, y1 = box
    width = F.pow(F.lit(2.0), F.col("_lv")) * size
    at = F.array(*(F.lit(v) for v in levels)) if levels else F.array().cast("array<int>")
    spread = rows.withColumn("_lv", F.explode(at if own is None else F.filter(at, lambda v: v >= own + above)))
    span = lambda low, high: F.sequence(F.floor(low / width) - 1, F.floor(high / width))
    return spread.withColumn("_cx", F.explode(span(x0, x1))).withColumn("_cy", F.explode(span(y0, y1)))


def meet(askers: DataFrame, boxes: DataFrame, cell_rows: int = CELL_ROWS, on: Sequence[str] = _CELL, partitions: int | None = None) -> DataFrame:
    """Joins rows of ``asked`` with those of ``stored`` by cell, dense cells in parts; the columns of the cell go.  With
    ``partitions`` the join has so many, however few rows there are before it."""
    on = list(on)
    n_boxes = boxes.groupBy(*on).agg(F.count(F.lit(1)).alias("_nb"))
    counts = askers.groupBy(*on).agg(F.count(F.lit(1)).alias("_na")).join(n_boxes, on)
    dense = counts.filter((F.col("_na") > cell_rows) | (F.col("_nb") > cell_rows)).select(*on, F.ceil(F.col("_na") / cell_rows).alias("_pa"), F.ceil(F.col("_nb") / cell_rows).alias("_pb"))
    one = F.lit(1).cast("long")
    parts = {c: F.coalesce(c, one) for c in ("_pa", "_pb")}
    dealt = lambda df, own: df.join(dense, on, "left").withColumns(parts).withColumn(f"_{own}", F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.col(f"_p{own}")))
    a = dealt(askers, "a").withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pb") - 1))).drop("_pa", "_pb")
    b = dealt(boxes, "b").withColumn("_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pa") - 1))).drop("_pa", "_pb")
    by = [*on, "_a", "_b"]
    if partitions:
        a, b = a.repartition(partitions, *by), b.repartition(partitions, *by)
    return a.join(b, by).drop(*by)


def distinct_values(rows: DataFrame, on: list[str]) -> DataFrame:
    """The distinct values of the columns ``on``; written, else what is computed of them moves, as part of pushed filters, back
    to all rows."""
    return written(rows.select(*on).distinct())


def for_rows(found: DataFrame, rows: DataFrame, on: list[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """Every row with all that was found, once, for the values it has in the columns ``on`` (a place, a shape).  A null value is
    none.

    There may be far more rows behind the join than before it, so it is not left in the few partitions that those before need.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = dict(rows.dtypes)
    # as text, since Spark takes no partitions made by fractions for a join by fractions; adding 0.0 makes -0.0 equal to 0.0
    key = lambda c: (F.col(c) + 0.0).cast("string") if kinds[c] in ("double", "float") else F.col(c)
    keys = {f"_on_{k}": key(c) for k, c in enumerate(on)}
    return meet(rows.withColumns(keys), written(found).withColumns(keys).drop(*on), cell_rows, list(keys), n)


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Points (x, y, ...) with the boxes (xmin, ymin, xmax, ymax, ...) they lie in; edges belong to a box.  ``size`` is that of
    the smallest boxes worth a level of their own."""
    b = stored(boxes, size)
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    p = asked(points.filter("x is not null and y is not null"), _levels(b), size, (x, y, x, y))
    hit = F.col("x").between(F.col("xmin"), F.col("xmax")) & F.col("y").between(F.col("ymin"), F.col("ymax"))
    return meet(p, b, cell_rows).filter(hit)


def boxes_meet(left: DataFrame, right: DataFrame, size: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Pairs of boxes that touch or overlap, columns prefixed ``left_`` and ``right_``.  The smaller box of a pair asks for the
    larger one, so a pair is found once."""
    a, b = stored(_named(left, "left_"), size, "left_"), stored(_named(right, "right_"), size, "right_")
    sides = lambda p: tuple(F.col(f"{p}{c}").cast("double") for c in SIDES)
    ask = lambda df, p, levels, above: asked(df.withColumnRenamed("_lv", "_own").drop("_cx", "_cy"), levels, size, sides(p), F.col("_own"), above).drop("_own")
    found = meet(ask(a, "left_", _levels(b), 0), b, cell_rows).unionByName(meet(ask(b, "right_", _levels(a), 1), a, cell_rows))
    touch = (F.col("left_xmin") <= F.col("right_xmax")) & (F.col("right_xmin") <= F.col("left_xmax")) & (F.col("left_ymin") <= F.col("right_ymax")) & (F.col("right_ymin") <= F.col("left_ymax"))
    return found.filter(touch)


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, ring: str = "ring") -> DataFrame:
    """The same with polygons given as a ring of points; the box of the ring finds the cells."""
    from ..functions.geometry import in_ring

    b = polygons.withColumn("xmin", F.array_min(F.transform(ring, lambda p: p["x"]))).withColumn("xmax", F.array_max(F.transform(ring, lambda p: p["x"])))
    b = b.withColumn("ymin", F.array_min(F.transform(ring, lambda p: p["y"]))).withColumn("ymax", F.array_max(F.transform(ring, lambda p: p["y"])))
    return points_in_boxes(points, b, size).filter(in_ring(F.col("x"), F.col("y"), F.col(ring))).drop("xmin", "ymin", "xmax", "ymax")


def nearest_point(points: DataFrame, targets: DataFrame, key: str, within: float, least: int = 4) -> DataFrame:
    """Each point (key, x, y) with its nearest target (target columns prefixed ``near_``), within a distance; of targets as near
    the smallest by its columns.

    A place is asked about once, and of the targets at a place only the smallest counts.  Cells are as long as the distance; where
    that leaves many targets to a cell there are levels of cells down to half, a quarter and so on of it.  A target in a place's own
    cell is at most a diagonal away, so the nearest one is in the cells around on the level above: a place asks there about the
    finest of its own cells that has a target, and meets some dozens however dense targets are.
    """
    cols = [f"near_{x}" for x in targets.columns]
    t = targets.select(*(F.col(x).alias(f"near_{x}") for x in targets.columns)).filter("near_x is not null and near_y is not null")
    t = t.groupBy((F.col("near_x") + 0.0).alias("_tx"), (F.col("near_y") + 0.0).alias("_ty")).agg(F.min(F.struct(*cols)).alias("_n"))
    t = written(t.select("_n.*"))
    at = lambda v, level: F.floor(F.col(v) / (F.lit(within) / F.pow(F.lit(2.0), level))).cast("long")
    cell = lambda x, y, level: {"_lv": level, "_cx": at(x, level), "_cy": at(y, level)}
    lv = F.col("_lv")
    per = t.groupBy(at("near_x", F.lit(0)), at("near_y", F.lit(0))).count().agg(F.sum(F.col("count") * F.col("count")) / F.sum("count")).first()[0] or 0.0
    # as a target sees them, so that a dense cell among thin ones counts
    finest = max(0, math.ceil(math.log(max(per, 1.0) / least, 4)) + 1) if per > least else 0  # targets per cell fall to a quarter
    p = distinct_values(points.filter("x is not null and y is not null"), ["x", "y"])
    if finest:
        levels = F.explode(F.array(*(F.lit(k) for k in range(finest + 1))))
        have = t.withColumn("_lv", levels).select(*(c.alias(n) for n, c in cell("near_x", "near_y", lv).items())).distinct()
        own = p.withColumn("_lv", levels).withColumns({n: c for n, c in cell("x", "y", lv).items() if n != "_lv"}).join(have, list(_CELL), "left_semi")
        own = own.groupBy("x", "y").agg(F.max("_lv").alias("_own"))
        p = p.withColumns({"_px": F.col("x") + 0.0, "_py": F.col("y") + 0.0}).join(own.select(F.col("x").alias("_ox"), F.col("y").alias("_oy"), "_own"), (F.col("_px") == F.col("_ox")) & (F.col("_py") == F.col("_oy")), "left")
        p = p.select("x", "y", F.greatest(F.coalesce("_own", F.lit(0)) - 1, F.lit(0)).alias("_lv"))
        stored_at = t.withColumn("_lv", F.explode(F.array(*(F.lit(k) for k in range(finest)))))
    else:
        p, stored_at = p.withColumn("_lv", F.lit(0)), t.withColumn("_lv", F.lit(0))
    around = F.array(*(F.struct((at("x", lv) + i).alias("cx"), (at("y", lv) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    asking = p.withColumn("_c", F.explode(around)).select("x", "y", "_lv", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy"))
    stored_at = stored_at.withColumns({n: c for n, c in cell("near_x", "near_y", lv).items() if n != "_lv"})
    d = F.sqrt(F.pow(F.col("x") - F.col("near_x"), 2) + F.pow(F.col("y") - F.col("near_y"), 2))
    found = asking.join(stored_at, list(_CELL)).withColumn("distance", d).filter(F.col("distance") <= within)
    best = found.groupBy("x", "y").agg(F.min(F.struct("distance", *cols)).alias("_b")).select("x", "y", *(F.col(f"_b.{c}").alias(c) for c in cols), F.col("_b.distance").alias("distance"))
    keys = {"_kx": F.col("x") + 0.0, "_ky": F.col("y") + 0.0}
    return points.withColumns(keys).join(best.withColumns(keys).drop("x", "y"), ["_kx", "_ky"], "left").select(*points.columns, *cols, "distance")
