"""Rasters as tables of cells (raster_id, row, col, value): reclass, overlay, zonal statistics, regions, traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .aggregates import ratio


def reclass(cells: DataFrame, lookup: DataFrame, code: str = "value", to: str = "new_value") -> DataFrame:
    """Codes replaced by a lookup (code, to); codes without a match are null."""
    return cells.join(lookup.select(F.col(code).alias("_code"), F.col(to).alias("_to")), F.col(code) == F.col("_code"), "left").select(*[c for c in cells.columns if c != code], F.col("_to").alias(code))


def overlay(rasters: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    """Cells of several rasters side by side, by row and column."""
    out = None
    for name, cells in rasters.items():
        one = cells.select("row", "col", F.col("value").alias(name))
        out = one if out is None else out.join(one, ["row", "col"], how)
    return out


def mask(cells: DataFrame, by: DataFrame, inverse: bool = False) -> DataFrame:
    """Cells that have a value in another raster, or that have none."""
    return cells.join(by.filter("value is not null").select("row", "col"), ["row", "col"], "left_anti" if inverse else "left_semi")


def mosaic(rasters: list[DataFrame]) -> DataFrame:
    """The first raster with a value wins a cell."""
    from .sets import union_all

    ranked = union_all([r.select("row", "col", "value", F.lit(i).alias("_rank")) for i, r in enumerate(rasters)]).filter("value is not null")
    return ranked.groupBy("row", "col").agg(F.min_by("value", "_rank").alias("value"))


def zonal(cells: DataFrame, zone: list[str], value: str = "value", cell_area: float = 1.0) -> DataFrame:
    """Mean, minimum, maximum, sum, count, mean of distinct values and area of a zone's cells; null is no data."""
    v = F.col(value)
    return cells.groupBy(*zone).agg(F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v).alias("sum"), F.count(v).alias("count"), F.sum_distinct(v).alias("_sum_distinct"), F.count_distinct(v).alias("_n_distinct"), (F.count(v) * cell_area).alias("area")).withColumn("mean_distinct", F.col("_sum_distinct") / F.nullif(F.col("_n_distinct"), F.lit(0))).drop("_sum_distinct", "_n_distinct")


def zonal_counts(cells: DataFrame, zone: list[str], code: str = "value", cell_area: float = 1.0) -> DataFrame:
    """(zone, code, n_cells, area)."""
    return cells.filter(F.col(code).isNotNull()).groupBy(*zone, code).agg(F.count(F.lit(1)).alias("n_cells"), (F.count(F.lit(1)) * F.lit(cell_area)).alias("area"))


def threshold_stats(cells: DataFrame, zone: list[str], thresholds: list[float], cell_area: float = 1.0, length: Column | None = None, value: str = "value") -> DataFrame:
    """(zone, threshold, n_cells, area, pct[, width]) of the cells at or over each threshold, in one pass."""
    counts = [F.struct(F.lit(float(t)).alias("threshold"), F.count_if(F.col(value) >= t).alias("n_cells")) for t in thresholds]
    rows = cells.groupBy(*zone).agg(F.array(*counts).alias("_c"), F.count(value).alias("_n"))
    rows = rows.select(*zone, "_n", F.explode("_c").alias("_c")).select(*zone, "_c.threshold", "_c.n_cells", (F.col("_c.n_cells") * cell_area).alias("area"), (100.0 * ratio(F.col("_c.n_cells").cast("double"), F.col("_n").cast("double"))).alias("pct"))
    return rows.withColumn("width", ratio(F.col("area"), length)) if length is not None else rows


def weighted_scene_mean(cells: DataFrame, zone: list[str], scene: str, value: str, weight: str) -> DataFrame:
    """Mean over a zone per scene with partial cells weighed by their overlap."""
    ok = F.when(F.col(value).isNotNull(), F.col(weight))
    return cells.groupBy(*zone, scene).agg(ratio(F.sum(F.col(value) * F.col(weight)), F.sum(ok)).alias("mean"))


def surface_temperature(raw: Column) -> Column:
    """Scaled Kelvin to degrees Celsius; 0 is no data."""
    return F.nullif(raw, F.lit(0)) * 0.02 - 273.15


def _horn(cells: DataFrame) -> DataFrame:
    """(row, col, dx, dy, n): eight times the rise to the east and to the north over a cell, by Horn's weights, and how many
    of the 3 x 3 cells are there.

    Every cell sends its weighted value to its eight neighbours, and one aggregation sums them up.
    """
    targets = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(float(-j * (2 if i == 0 else 1))).alias("wx"), F.lit(float(i * (2 if j == 0 else 1))).alias("wy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    sent = cells.filter("value is not null").select("row", "col", "value", F.explode(targets).alias("t"))
    sums = sent.groupBy((F.col("row") + F.col("t.i")).alias("row"), (F.col("col") + F.col("t.j")).alias("col")).agg(
        F.sum(F.col("value") * F.col("t.wx")).alias("dx"), F.sum(F.col("value") * F.col("t.wy")).alias("dy"), F.count(F.lit(1)).alias("n"), F.max((F.col("t.i") == 0) & (F.col("t.j") == 0)).alias("own")
    )
    return sums.filter("own").drop("own")


def slope_percent(cells: DataFrame, cell_size: float) -> DataFrame:
    """Slope of a surface from the 3 x 3 neighbourhood; cells with a missing neighbour are null."""
    rise = F.sqrt(F.pow("dx", 2) + F.pow("dy", 2)) / (8 * cell_size)
    return _horn(cells).select("row", "col", F.when(F.col("n") == 9, 100 * rise).alias("value"))


#: Columns of a stretch of a raster's row.
STRETCH = 4096


def regions(cells: DataFrame, diagonal: bool = False, stretch: int = STRETCH) -> DataFrame:
    """Adds ``region`` to the cells with a value: connected cells of one value share the name of their first cell by row and
    column, row * 2^31 + column.

    Runs of equal cells in a row become nodes first, so what is iterated over are runs, not cells.  Rows are cut in
    stretches, and a run that goes on behind a cut is linked with its other part.
    """
    from .network import components
    from pyspark.sql import Window

    own = cells.filter("value is not null").select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "value").withColumn("_s", F.floor(F.col("col") / stretch))
    w = Window.partitionBy("row", "_s").orderBy("col")
    new = F.coalesce((F.lag("col").over(w) != F.col("col") - 1) | (F.lag("value").over(w) != F.col("value")), F.lit(True))
    first = F.max(F.when(F.col("_new"), F.col("col"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = own.withColumn("_new", new).withColumn("run_id", F.col("row") * (1 << 31) + first).drop("_new")
    step = lambda i, j: F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
    down = F.array(*(step(i, j) for i, j in [(1, 0)] + ([(1, 1), (1, -1)] if diagonal else [])))
    steps = F.when((F.col("col") + 1) % stretch == 0, F.concat(down, F.array(step(0, 1)))).otherwise(down)
    there = runs.select(F.col("value").alias("_v"), F.col("run_id").alias("a"), F.explode(steps).alias("t"), "row", "col").select("_v", "a", (F.col("row") + F.col("t.i")).alias("row"), (F.col("col") + F.col("t.j")).alias("col"))
    edges = there.join(runs.select("row", "col", "value", F.col("run_id").alias("b")), ["row", "col"]).filter("_v = value").select("a", "b").distinct()
    roots = components(edges)
    return runs.join(roots, runs["run_id"] == roots["node"], "left").select("row", "col", "value", F.coalesce("component", "run_id").alias("region"))


def without_small_regions(cells: DataFrame, least_cells: int) -> DataFrame:
    r = regions(cells)
    big = r.groupBy("region").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_cells).select("region")
    return r.join(big, "region", "left_semi").select("row", "col", "value")


#: Row and column steps of the eight flow directions, counted from east anticlockwise.
FLOW_STEPS = {1: (0, 1), 2: (-1, 1), 3: (-1, 0), 4: (-1, -1), 5: (0, -1), 6: (1, -1), 7: (1, 0), 8: (1, 1)}


def floodplain_access(cells: DataFrame, valley: str = "in_vb") -> DataFrame:
    """Whether water of a cell reaches the channel: 1 channel, 0 road, rail or canal on the way, 2 a cycle, null off the
    valley bottom.  Flow pointers are doubled, so paths of n cells take log2(n) joins."""
    from .network import pointer_ends

    def step(k: int) -> Column:
        return F.create_map(*(F.lit(x) for d, s in FLOW_STEPS.items() for x in (d, s[k])))[F.col("fd")]

    key = lambda r, c: F.col(r).cast("long") * (1 << 31) + F.col(c).cast("long")
    kind = F.when(F.col("is_channel"), 1).when(F.col("is_road") | F.col("is_rail") | F.col("is_canal"), 0)
    rows = cells.filter(F.col(valley)).withColumn("_kind", kind).withColumn("_r", F.col("row") + step(0)).withColumn("_c", F.col("col") + step(1))
    nodes = written(rows.select("row", "col", key("row", "col").alias("node"), F.when(F.col("_kind").isNull() & F.col("fd").isNotNull(), key("_r", "_c")).alias("next"), "_kind"))
    known = nodes.select(F.col("node").alias("next"))
    open_ended = nodes.join(known, "next", "left_semi").select("node", "next").unionByName(nodes.join(known, "next", "left_anti").select("node", F.lit(None).cast("long").alias("next")))
    ends = pointer_ends(open_ended)
    last = nodes.select(F.col("node").alias("end"), F.col("_kind").alias("at_end"))
    out = nodes.join(ends, "node").join(last, "end", "left")
    return out.select("row", "col", F.when(F.col("cycle"), 2).otherwise(F.col("at_end")).alias("access"))


def outlines(labelled: DataFrame, cell_size: float) -> DataFrame:
    """(region, value, n_cells, area, perimeter, rmin, rmax, cmin, cmax) of ``regions``: what a polygon round each
    region would measure.

    A side counts for the perimeter unless the cell behind it is of the same region: every cell shows its region to its four
    neighbours, and one aggregation per cell tells how many of them share it.
    """
    sides = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 0), (0, 1), (1, 0), (0, -1), (-1, 0))))
    seen = labelled.select("row", "col", "region", "value", F.explode(sides).alias("t"))
    own = (F.col("t.i") == 0) & (F.col("t.j") == 0)
    met = seen.groupBy((F.col("row") + F.col("t.i")).alias("row"), (F.col("col") + F.col("t.j")).alias("col"), "region").agg(F.max(F.when(own, F.col("value"))).alias("value"), (F.count(F.lit(1)) - 1).alias("inner"), F.max(own).alias("own"))
    return met.filter("own").groupBy("region", "value").agg(
        F.count(F.lit(1)).alias("n_cells"), (F.count(F.lit(1)) * cell_size * cell_size).alias("area"), (F.sum(4 - F.col("inner")) * cell_size).alias("perimeter"),
        F.min("row").alias("rmin"), F.max("row").alias("rmax"), F.min("col").alias("cmin"), F.max("col").alias("cmax"),
    )


def tiled(cells: DataFrame, size: int) -> DataFrame:
    """(tile_row, tile_col, values): one row per tile with its values in row-major order; null where there is no cell."""
    at = (F.col("row") % size) * size + F.col("col") % size
    tiles = cells.groupBy(F.floor(F.col("row") / size).alias("tile_row"), F.floor(F.col("col") / size).alias("tile_col")).agg(F.map_from_entries(F.collect_list(F.struct(at.cast("int"), F.col("value")))).alias("m"))
    return tiles.select("tile_row", "tile_col", F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda i: F.try_element_at("m", i)).alias("values"))


def untiled(tiles: DataFrame, size: int) -> DataFrame:
    one = tiles.select("tile_row", "tile_col", F.posexplode("values").alias("_i", "value")).filter("value is not null")
    return one.select((F.col("tile_row") * size + F.floor(F.col("_i") / size)).alias("row"), (F.col("tile_col") * size + F.col("_i") % size).alias("col"), "value")


def rasterize(shapes: DataFrame, ring: str, cell_size: float) -> DataFrame:
    """The columns of ``shapes`` but the ring, with (row, col) of every cell of which the centre lies in the ring."""
    from ..functions.geometry import box, in_ring

    keys = [c for c in shapes.columns if c != ring]
    n = lambda v: F.floor(v / cell_size)
    b = shapes.withColumn("_b", box(F.col(ring)))
    cells = b.withColumn("row", F.explode(F.sequence(n(F.col("_b.ymin")), n(F.col("_b.ymax"))))).withColumn("col", F.explode(F.sequence(n(F.col("_b.xmin")), n(F.col("_b.xmax")))))
    centre = lambda c: (F.col(c) + 0.5) * cell_size
    return cells.filter(in_ring(centre("col"), centre("row"), F.col(ring))).select(*keys, "row", "col")


# --- grow and shrink -------------------------------------------------------------------------------------------------


def _extreme(cells: DataFrame, axis: str, other: str, n: int, how, strip: int) -> DataFrame:
    """Each cell's extreme of the cells up to n away along an axis, in strips with the cells near a border shared."""
    home = F.floor(F.col(axis) / strip)
    near = F.array_distinct(F.array(home, F.floor((F.col(axis) - n) / strip), F.floor((F.col(axis) + n) / strip)))
    dealt = cells.withColumn("_home", home).withColumn("_strip", F.explode(near))
    from pyspark.sql import Window

    w = Window.partitionBy(other, "_strip").orderBy(axis).rangeBetween(-n, n)
    return dealt.select("row", "col", "_home", "_strip", how("value").over(w).alias("value")).filter("_home = _strip").select("row", "col", "value")


def grown(cells: DataFrame, n: int, strip: int = 1024) -> DataFrame:
    """A raster of 0 and 1 with every 1 grown over the cells up to n rows and columns away; cells that are not there stay so."""
    known = cells.filter("value is not null").select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "value")
    if n >= strip:
        raise ValueError("a strip must be wider than n")
    return _square(known, n, F.max, strip, 0)


def shrunk(cells: DataFrame, n: int, strip: int = 1024) -> DataFrame:
    """The other way round: only the 1s stay that have no 0 up to n rows and columns away.  What lies outside of the raster is
    neither."""
    known = cells.filter("value is not null").select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "value")
    if n >= strip:
        raise ValueError("a strip must be wider than n")
    return _square(known, n, F.min, strip, 1)


def _square(known: DataFrame, n: int, how, strip: int, nothing: int) -> DataFrame:
    """The extreme over a square, first along rows and then along columns.

    A cell that is not there may still hand on what is beside it: the first pass also asks for the columns of the rows
    around that have cells there.
    """
    around = F.explode(F.sequence(F.lit(-n), F.lit(n)))
    wanted = known.select("row", "col").withColumn("_k", around).select((F.col("row") + F.col("_k")).alias("row"), "col").distinct()
    there = known.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    padded = wanted.join(there, (F.col("row") == F.col("_r")) & (F.col("col") == F.col("_c")), "left").select("row", "col", "value")
    across = _extreme(padded, "col", "row", n, how, strip)
    down = _extreme(across, "row", "col", n, how, strip)
    return down.join(known.select("row", "col"), ["row", "col"], "left_semi").withColumn("value", F.coalesce("value", F.lit(nothing)))


def closed(cells: DataFrame, n: int) -> DataFrame:
    """Grown and shrunk again: gaps and holes up to 2 n wide are filled."""
    return shrunk(grown(cells, n), n)


def opened(cells: DataFrame, n: int) -> DataFrame:
    """Shrunk and grown again: what is up to 2 n wide is gone."""
    return grown(shrunk(cells, n), n)


def hillshade(cells: DataFrame, cell_size: float, azimuth: float = 315.0, altitude: float = 45.0) -> DataFrame:
    """Brightness 0 to 255 of a surface lit from a direction (degrees clockwise from north) at a height above the horizon;
    cells with a missing neighbour are null."""
    s = _horn(cells)
    dx, dy = F.col("dx") / (8 * cell_size), F.col("dy") / (8 * cell_size)  # towards the east, towards the north
    up, way = F.radians(F.lit(altitude)), F.radians(F.lit(azimuth))
    lit = (F.sin(up) - F.cos(up) * (dx * F.sin(way) + dy * F.cos(way))) / F.sqrt(1 + dx * dx + dy * dy)
    return s.select("row", "col", F.when(F.col("n") == 9, F.greatest(F.lit(0.0), 255 * lit)).alias("value"))
