"""Queries over rasters as tables of cells; the vectors of ``embeddings`` are the rows of a raster of 64 columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify
from ..operators import aggregates, distance, grid, paths, rings
from ..session import written
from .aggregate_queries import _CELLS, cells_of
from .registry import query


def _class(k: int) -> Column:
    return F.floor(F.abs("value") * 1000).cast("long") % k


def _class_sql(k: int) -> str:
    return f"(CAST(floor(abs(value) * 1000) AS BIGINT) % {k})"


@query("embeddings", sql=f"""WITH cells AS (SELECT * FROM {_CELLS}),
w AS (SELECT * FROM (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j)),
sent AS (SELECT row + i AS row, col + j AS col, value * -j * (CASE i WHEN 0 THEN 2 ELSE 1 END) AS dx, value * -i * (CASE j WHEN 0 THEN 2 ELSE 1 END) AS dy, CASE WHEN i = 0 AND j = 0 THEN value END AS own FROM cells, w)
SELECT row, col, CASE WHEN count(*) = 9 THEN round(100 * sqrt(sum(dx) ^ 2 + sum(dy) ^ 2) / 80.0, 6) END AS slope FROM sent GROUP BY row, col HAVING max(own) IS NOT NULL""")
def dem_slope(embeddings: DataFrame) -> DataFrame:
    return grid.slope_percent(cells_of(embeddings), 10.0).select("row", "col", F.round("value", 6).alias("slope"))


#: Sources of distances: about one cell in two hundred.
SOURCES = "value > 0.3"
_NEAREST = f"""cells AS MATERIALIZED (SELECT * FROM {_CELLS}), s AS MATERIALIZED (SELECT row, col FROM cells WHERE {SOURCES}),
near AS (SELECT c.row, c.col, min((c.row - s.row) ^ 2 + (c.col - s.col) ^ 2) AS d2, arg_min((s.row, s.col), ((c.row - s.row) ^ 2 + (c.col - s.col) ^ 2, s.row, s.col)) AS seed FROM cells c, s GROUP BY 1, 2)"""


@query("embeddings", sql=f"WITH {_NEAREST} SELECT row, col, sqrt(d2) * 10.0 AS distance FROM near")
def proximity_raster(embeddings: DataFrame) -> DataFrame:
    """The distance of every cell to its nearest source, however far."""
    cells = cells_of(embeddings)
    return distance.proximity(cells, cells.filter(SOURCES), 10.0).select("row", "col", F.col("value").alias("distance"))


@query("embeddings", sql=f"WITH {_NEAREST} SELECT n.seed[1] AS seed_row, n.seed[2] AS seed_col, count(*) AS n_cells, sqrt(max(d2)) AS farthest, round(avg(c.value), 9) AS mean FROM near n JOIN cells c USING (row, col) GROUP BY 1, 2")
def nearest_seed_zones(embeddings: DataFrame) -> DataFrame:
    """Every cell goes to its nearest seed; cells, farthest distance and mean value of each seed's zone."""
    cells = cells_of(embeddings)
    seeds = cells.filter(SOURCES).select("row", "col", F.col("row").alias("r"), F.col("col").alias("c"))
    zones = distance.seed_zones(cells, seeds, ["r", "c"]).join(cells, ["row", "col"])
    return zones.groupBy(F.col("r").alias("seed_row"), F.col("c").alias("seed_col")).agg(F.count(F.lit(1)).alias("n_cells"), F.max("distance").alias("farthest"), F.round(F.avg("value"), 9).alias("mean"))


_COSTS = f"""costs AS MATERIALIZED (SELECT row, col, row * 64 + col AS id, value, 1.0 + floor(abs(value) * 50) AS cost FROM {_CELLS}), steps(k, i, j) AS MATERIALIZED (VALUES (0, -1, -1), (1, -1, 0), (2, -1, 1), (3, 0, -1), (4, 0, 1), (5, 1, -1), (6, 1, 0), (7, 1, 1))"""
#: Rounds of the neighbours of what was lowered, until nothing is.
_TOTALS = """moves AS MATERIALIZED (SELECT c.id, n.id AS next, k, (c.cost + n.cost) / 2 * sqrt((i * i + j * j)::DOUBLE) AS step FROM (SELECT *, row + i AS r, col + j AS c FROM {passable}, steps) c JOIN {passable} n ON n.row = c.r AND n.col = c.c),
totals(id, total) USING KEY (id) AS (SELECT id, 0.0::DOUBLE FROM {passable} WHERE value > 0.3
UNION SELECT m.next, min(t.total + m.step) FROM totals t JOIN moves m ON m.id = t.id LEFT JOIN recurring.totals o ON o.id = m.next WHERE o.total IS NULL OR t.total + m.step < o.total GROUP BY m.next)"""


def _costs(embeddings: DataFrame) -> DataFrame:
    return cells_of(embeddings).withColumn("cost", 1.0 + F.floor(F.abs("value") * 50))


@query("embeddings", sql=f"WITH RECURSIVE {_COSTS}, {_TOTALS.format(passable='costs')} SELECT row, col, round(total, 6) AS total FROM totals JOIN costs USING (id)")
def least_cost_surface(embeddings: DataFrame) -> DataFrame:
    """The cost of the cheapest way from every cell to the channel."""
    cells = _costs(embeddings)
    return paths.least_costs(cells, cells.filter(SOURCES)).select("row", "col", F.round("total", 6).alias("total"))


@query("embeddings", sql=f"""WITH RECURSIVE {_COSTS}, {_TOTALS.format(passable='costs')}, target AS (SELECT max(row) AS row FROM costs),
way(id, total) AS (SELECT t.id, t.total FROM totals t, target WHERE t.id = target.row * 64 + 31
UNION ALL SELECT b.t[1], b.t[2] FROM (SELECT arg_min((n.id, n.total), (n.total + m.step, m.k)) AS t FROM way w JOIN moves m ON m.id = w.id JOIN totals n ON n.id = m.next WHERE w.total > 0) b WHERE b.t IS NOT NULL)
SELECT row, col FROM way JOIN costs USING (id)""")
def least_cost_path(embeddings: DataFrame) -> DataFrame:
    """The cells of the cheapest way from the middle of the last row to the channel."""
    cells = _costs(embeddings)
    last = cells.agg(F.max("row").alias("row")).select("row", F.lit(31).alias("col"))
    return paths.paths_to(paths.least_costs(cells, cells.filter(SOURCES)), last).select("row", F.col("col").cast("int").alias("col"))


@query("embeddings", sql=f"""WITH RECURSIVE {_COSTS}, flat AS MATERIALIZED (SELECT row, col, id, value, 1.0::DOUBLE AS cost FROM costs WHERE value > 0.3 OR abs(value) < 0.12), {_TOTALS.format(passable='flat')}
SELECT row, col, round(total, 6) AS distance FROM totals JOIN costs USING (id) WHERE total <= 12""")
def valley_growth(embeddings: DataFrame) -> DataFrame:
    """The valley bottom grown from the channel through low cells, up to twelve cells of way."""
    cells = cells_of(embeddings)
    return paths.grown(cells, cells.filter(SOURCES), "abs(value) < 0.12", 12.0).select("row", "col", F.round("distance", 6).alias("distance"))


_REGIONS = f"""cells AS MATERIALIZED (SELECT row, col, {_class_sql(5)} AS value FROM {_CELLS}),
steps AS MATERIALIZED (SELECT a.row AS r1, a.col AS c1, b.row AS r2, b.col AS c2 FROM cells a JOIN cells b ON a.value = b.value AND abs(a.row - b.row) + abs(a.col - b.col) = 1),
seen AS (SELECT row, col, row AS r, col AS c FROM cells UNION SELECT s.row, s.col, t.r2, t.c2 FROM seen s JOIN steps t ON s.r = t.r1 AND s.c = t.c1),
regions AS MATERIALIZED (SELECT row, col, min(r * 2147483648 + c) AS region, count(*) AS n_cells FROM seen GROUP BY row, col)"""


def _regions(embeddings: DataFrame) -> DataFrame:
    return grid.regions(cells_of(embeddings).withColumn("value", _class(5)))


@query("embeddings", sql=f"WITH RECURSIVE {_REGIONS} SELECT row, col, region, n_cells FROM regions")
def region_labels(embeddings: DataFrame) -> DataFrame:
    r = _regions(embeddings)
    return r.join(r.groupBy("region").agg(F.count(F.lit(1)).alias("n_cells")), "region").select("row", "col", "region", "n_cells")


@query("embeddings", sql=f"WITH RECURSIVE {_REGIONS} SELECT row, col, value FROM regions JOIN cells USING (row, col) WHERE n_cells >= 4")
def sieve_small_regions(embeddings: DataFrame) -> DataFrame:
    return grid.without_small_regions(cells_of(embeddings).withColumn("value", _class(5)), 4)


@query("embeddings", sql=f"""WITH RECURSIVE {_REGIONS}, one AS (SELECT DISTINCT region, value, n_cells FROM regions JOIN cells USING (row, col))
SELECT value, max_by(region, (n_cells, -region)) AS region, max(n_cells) AS n_cells FROM one GROUP BY value""")
def largest_region(embeddings: DataFrame) -> DataFrame:
    """Per class the region with the most cells; of equal ones the first."""
    r = _regions(embeddings).groupBy("region", "value").agg(F.count(F.lit(1)).alias("n_cells"))
    return r.groupBy("value").agg(F.max_by("region", F.struct("n_cells", -F.col("region"))).alias("region"), F.max("n_cells").alias("n_cells"))


@query("embeddings", sql=f"""WITH RECURSIVE {_REGIONS}, sides AS (SELECT r1 AS row, c1 AS col, count(*) AS inner_sides FROM steps GROUP BY 1, 2)
SELECT region, value, count(*) AS n_cells, count(*) * 100.0 AS area, CAST(sum(4 - coalesce(inner_sides, 0)) AS BIGINT) * 10.0 AS perimeter, min(row) AS rmin, max(row) AS rmax, min(col) AS cmin, max(col) AS cmax
FROM regions JOIN cells USING (row, col) LEFT JOIN sides USING (row, col) GROUP BY region, value""")
def polygonize_regions(embeddings: DataFrame) -> DataFrame:
    return grid.outlines(_regions(embeddings), 10.0).select("region", "value", "n_cells", "area", "perimeter", "rmin", "rmax", "cmin", "cmax")


_RINGS = f"""{_REGIONS}, named AS MATERIALIZED (SELECT row, col, region FROM regions), sides(d, i, j, a, b, e, f) AS (VALUES (0, -1, 0, 0, 0, 1, 0), (1, 0, 1, 1, 0, 1, 1), (2, 1, 0, 1, 1, 0, 1), (3, 0, -1, 0, 1, 0, 0)),
edges AS MATERIALIZED (SELECT n.region, d, n.col + a AS x0, n.row + b AS y0, n.col + e AS x1, n.row + f AS y1, (n.row * 2147483648 + n.col) * 4 + d AS id FROM named n, sides LEFT JOIN named o ON o.row = n.row + i AND o.col = n.col + j WHERE o.region IS DISTINCT FROM n.region),
succ AS MATERIALIZED (SELECT e.id, arg_min(n.id, CASE (n.d - e.d + 4) % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END) AS next, arg_min(n.d, CASE (n.d - e.d + 4) % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END) <> any_value(e.d) AS turns FROM edges e JOIN edges n ON n.region = e.region AND n.x0 = e.x1 AND n.y0 = e.y1 GROUP BY e.id),
walk AS (SELECT id AS head, id AS here, 1 AS n FROM edges UNION ALL SELECT w.head, s.next, w.n + 1 FROM walk w JOIN succ s ON s.id = w.here WHERE s.next > w.head),
closed AS (SELECT w.head FROM walk w JOIN succ s ON s.id = w.here AND s.next = w.head)"""


@query("embeddings", sql=f"""WITH RECURSIVE {_RINGS}
SELECT region, count(*) AS n_edges, abs(sum(x0 * y1 - x1 * y0)) / 2.0 AS area, sum(x0 * y1 - x1 * y0) < 0 AS hole, min(x0) * 1.0 AS xmin, min(y0) * 1.0 AS ymin FROM walk JOIN closed USING (head) JOIN edges ON id = here GROUP BY region, head""")
def polygonize_rings(embeddings: DataFrame) -> DataFrame:
    """The outer ring and the holes of every region of equal cells."""
    linked = _rings(embeddings)
    box = linked.groupBy("ring").agg(F.min("x0").alias("xmin"), F.min("y0").alias("ymin"))
    return rings.measured(linked, ["region"]).join(box, "ring").drop("ring")


@query("embeddings", sql=f"""WITH RECURSIVE {_RINGS}, cuts AS (SELECT e.region, head, count(*) AS n_corners, count(DISTINCT (e.x1, e.y1)) AS n_places, sum(e.x1 * 2 + e.y1) * 1.0 AS weight FROM walk JOIN closed USING (head) JOIN edges e ON e.id = here JOIN succ ON succ.id = here WHERE turns GROUP BY e.region, head)
SELECT region, n_corners, n_places, weight FROM cuts""")
def ring_corners(embeddings: DataFrame) -> DataFrame:
    """The corners of every ring: how many, at how many places, and their sum."""
    c = rings.corners(_rings(embeddings), ["region"])
    return c.groupBy("region", "ring").agg(F.count(F.lit(1)).alias("n_corners"), F.count_distinct("x", "y").alias("n_places"), F.sum(F.col("x") * 2 + F.col("y")).alias("weight")).drop("ring")


def _rings(embeddings: DataFrame) -> DataFrame:
    return rings.linked(rings.dissolved(rings.region_edges(_regions(embeddings)), ["region"]), ["region"])


@query("embeddings", sql=f"""WITH cells AS (SELECT * FROM {_CELLS})
SELECT row, col, value FROM cells WHERE value >= 0 AND (row * 7 + col) % 5 <> 0""")
def mask_cells(embeddings: DataFrame) -> DataFrame:
    """Cells within one mask and outside another."""
    cells = cells_of(embeddings)
    inside = grid.mask(cells, cells.filter("value >= 0"))
    return grid.mask(inside, cells.filter("(row * 7 + col) % 5 = 0"), inverse=True)


@query("embeddings", sql=f"""WITH cells AS (SELECT * FROM {_CELLS})
SELECT row, col, CASE WHEN value > 0.1 THEN value ELSE CASE WHEN (row + col) % 3 = 0 THEN value * 10 END END AS value FROM cells WHERE value > 0.1 OR (row + col) % 3 = 0""")
def mosaic_first_wins(embeddings: DataFrame) -> DataFrame:
    cells = cells_of(embeddings)
    return grid.mosaic([cells.filter("value > 0.1"), cells.filter("(row + col) % 3 = 0").withColumn("value", F.col("value") * 10)])


@query("embeddings", sql=f"""WITH cells AS MATERIALIZED (SELECT * FROM {_CELLS}), e AS (SELECT row, col, value AS hand FROM cells), s AS (SELECT row - 1 AS row, col, value AS slope FROM cells), c AS (SELECT row, col - 1 AS col, value AS channel FROM cells)
SELECT row, col, round(greatest(0.65 * hand + 0.35 * slope, 0.995 * channel), 9) AS evidence FROM e JOIN s USING (row, col) JOIN c USING (row, col)""")
def evidence_overlay(embeddings: DataFrame) -> DataFrame:
    """Three rasters cell by cell, weighed into one."""
    from ..functions.curves import evidence

    cells = cells_of(embeddings)
    rasters = {"hand": cells, "slope": cells.withColumn("row", F.col("row") - 1), "channel": cells.withColumn("col", F.col("col") - 1)}
    return grid.overlay(rasters).select("row", "col", F.round(evidence(F.col("hand"), F.col("slope"), F.col("channel")), 9).alias("evidence"))


@query("embeddings", sql=f"""WITH cells AS (SELECT row // 50 AS zone, row % 3 AS scene, nullif(round(value, 1), 0.1) AS value, (col % 4 + 1) / 4.0 AS weight FROM {_CELLS})
SELECT CAST(zone AS BIGINT) AS zone, CAST(scene AS BIGINT) AS scene, round(sum(value * weight) / sum(CASE WHEN value IS NOT NULL THEN weight END), 9) AS mean FROM cells GROUP BY 1, 2""")
def weighted_scene_mean(embeddings: DataFrame) -> DataFrame:
    cells = cells_of(embeddings).select(F.floor(F.col("row") / 50).alias("zone"), (F.col("row") % 3).alias("scene"), F.nullif(F.round("value", 1), F.lit(0.1)).alias("value"), ((F.col("col") % 4 + 1) / 4.0).alias("weight"))
    return grid.weighted_scene_mean(cells, ["zone"], "scene", "value", "weight").select("zone", "scene", F.round("mean", 9).alias("mean"))


@query("embeddings", sql=f"SELECT row, col, nullif(CAST(floor(abs(value) * 20000) AS BIGINT), 0) * 0.02 - 273.15 AS celsius FROM {_CELLS}")
def surface_temperature(embeddings: DataFrame) -> DataFrame:
    return cells_of(embeddings).select("row", "col", grid.surface_temperature(F.floor(F.abs("value") * 20000)).alias("celsius"))


_ACCESS = f"""cells AS (SELECT row, col, {_class_sql(8)} + 1 AS fd, {_class_sql(17)} = 0 AS is_channel, {_class_sql(13)} = 1 AS is_road, col % 21 <> 20 AS in_vb FROM {_CELLS}),
steps AS (SELECT * FROM (VALUES (1, 0, 1), (2, -1, 1), (3, -1, 0), (4, -1, -1), (5, 0, -1), (6, 1, -1), (7, 1, 0), (8, 1, 1)) s(fd, i, j)),
nodes AS (SELECT c.row, c.col, CASE WHEN is_channel THEN 1 WHEN is_road THEN 0 END AS kind, row + i AS r, col + j AS c FROM cells c JOIN steps USING (fd) WHERE in_vb),
linked AS (SELECT n.row, n.col, n.kind, CASE WHEN n.kind IS NULL THEN m.row END AS r, CASE WHEN n.kind IS NULL THEN m.col END AS c FROM nodes n LEFT JOIN nodes m ON n.r = m.row AND n.c = m.col),
walk AS (SELECT row, col, row AS ar, col AS ac FROM linked UNION SELECT w.row, w.col, l.r, l.c FROM walk w JOIN linked l ON w.ar = l.row AND w.ac = l.col WHERE l.r IS NOT NULL)"""


@query("embeddings", sql=f"""WITH RECURSIVE {_ACCESS}
SELECT w.row, w.col, CASE WHEN bool_and(l.r IS NOT NULL) THEN 2 ELSE max(CASE WHEN l.r IS NULL THEN l.kind END) END AS access FROM walk w JOIN linked l ON w.ar = l.row AND w.ac = l.col GROUP BY w.row, w.col""")
def floodplain_access(embeddings: DataFrame) -> DataFrame:
    cells = cells_of(embeddings)
    no = F.lit(False)
    rows = cells.select("row", "col", (_class(8) + 1).alias("fd"), (_class(17) == 0).alias("is_channel"), (_class(13) == 1).alias("is_road"), no.alias("is_rail"), no.alias("is_canal"), (F.col("col") % 21 != 20).alias("in_vb"))
    return grid.floodplain_access(rows)


@query("embeddings", sql=f"""WITH cells AS (SELECT row, col, {_class_sql(4)} AS now, {_class_sql(3)} AS before FROM {_CELLS}),
codes AS (SELECT row, col, CASE now WHEN 0 THEN 500 WHEN 1 THEN 100 WHEN 2 THEN 20 ELSE 3 END AS e, CASE before WHEN 0 THEN 500 WHEN 1 THEN 100 ELSE 20 END AS h FROM cells)
SELECT CAST(h - e AS BIGINT) AS conversion, count(*) AS n_cells, round(100.0 * count(*) / (SELECT count(*) FROM cells), 4) AS pct FROM codes GROUP BY 1""")
def vegetation_conversion(embeddings: DataFrame) -> DataFrame:
    """Two rasters recoded by lookups, their difference, and each difference's share."""
    cells = cells_of(embeddings)
    spark = embeddings.sparkSession
    recoded = lambda k, codes: grid.reclass(cells.withColumn("value", _class(k)), F.broadcast(spark.createDataFrame(list(enumerate(codes)), "value long, new_value long")))
    both = grid.overlay({"now": recoded(4, (500, 100, 20, 3)), "before": recoded(3, (500, 100, 20))})
    counts = both.groupBy((F.col("before") - F.col("now")).alias("conversion")).agg(F.count(F.lit(1)).alias("n_cells"))
    return aggregates.share_of_everything(counts, ["conversion"], "n_cells").select("conversion", "n_cells", F.round(100.0 * F.col("share"), 4).alias("pct"))


@query("embeddings", sql=f"""WITH cells AS (SELECT CAST(row // 50 AS BIGINT) AS zone, CAST(floor(value * 20) AS BIGINT) AS bin FROM {_CELLS}), n AS (SELECT zone, bin, count(*) AS n FROM cells GROUP BY 1, 2)
SELECT zone, bin, n * 25.0 AS area, CAST(sum(n) OVER (PARTITION BY zone ORDER BY bin DESC) AS DOUBLE) / sum(n) OVER (PARTITION BY zone) AS share_above FROM n""")
def hypsometric_curve(embeddings: DataFrame) -> DataFrame:
    """Area per band of elevation, and the share of the zone's area in that band or above."""
    bins = cells_of(embeddings).groupBy(F.floor(F.col("row") / 50).alias("zone"), F.floor(F.col("value") * 20).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    z = Window.partitionBy("zone")
    return bins.select("zone", "bin", (F.col("n") * 25.0).alias("area"), (F.sum("n").over(z.orderBy(F.desc("bin"))) / F.sum("n").over(z)).alias("share_above"))


@query("embeddings", sql=f"""WITH epochs AS (SELECT CAST(row // 50 AS BIGINT) AS zone, row % 4 AS epoch, value FROM {_CELLS})
SELECT zone, CAST(epoch AS BIGINT) AS epoch, threshold, count(*) FILTER (WHERE value >= threshold) AS n_cells, count(*) FILTER (WHERE value >= threshold) * 25.0 AS area,
100.0 * count(*) FILTER (WHERE value >= threshold) / count(*) AS pct FROM epochs, (VALUES (0.0::DOUBLE), (0.1::DOUBLE), (0.2::DOUBLE)) t(threshold) GROUP BY ALL""")
def epoch_threshold_stats(embeddings: DataFrame) -> DataFrame:
    cells = cells_of(embeddings).withColumn("zone", F.floor(F.col("row") / 50)).withColumn("epoch", F.col("row") % 4)
    return grid.threshold_stats(cells, ["zone", "epoch"], [0.0, 0.1, 0.2], 25.0)


@query("embeddings", "part", sql=f"""SELECT p_partkey, value FROM (SELECT p_partkey, p_partkey % 500 AS row, p_size AS col FROM part) p LEFT JOIN {_CELLS} c USING (row, col)""")
def pixel_values_at_points(embeddings: DataFrame, part: DataFrame) -> DataFrame:
    points = part.select("p_partkey", (F.col("p_partkey") % 500).alias("row"), F.col("p_size").alias("col"))
    return points.join(cells_of(embeddings), ["row", "col"], "left").select("p_partkey", "value")


@query("embeddings", sql=f"SELECT row, col, value FROM {_CELLS}")
def tile_round_trip(embeddings: DataFrame) -> DataFrame:
    """Cells packed into tiles of 16 x 16, one row per tile, and unpacked again."""
    return grid.untiled(grid.tiled(cells_of(embeddings), 16), 16)


@query("embeddings", sql=f"""WITH cells AS (SELECT row, col FROM {_CELLS}), shapes AS (SELECT k AS shape, k * 37 % 400 AS r0, k * 11 % 40 AS c0 FROM range(20) t(k))
SELECT shape, row, col FROM shapes JOIN cells ON row + 0.5 >= r0 AND row + 0.5 < r0 + 30 AND col + 0.5 >= c0 AND col + 0.5 < c0 + 12""")
def rasterize_polygons(embeddings: DataFrame) -> DataFrame:
    k = F.col("id")
    r0, c0 = (k * 37 % 400).cast("double"), (k * 11 % 40).cast("double")
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    shapes = embeddings.sparkSession.range(20).select(k.alias("shape"), F.array(corner(c0, r0), corner(c0 + 12, r0), corner(c0 + 12, r0 + 30), corner(c0, r0 + 30)).alias("ring"))
    return grid.rasterize(shapes, "ring", 1.0).join(cells_of(embeddings).select("row", "col"), ["row", "col"], "left_semi").select("shape", "row", "col")


@query("embeddings", sql=f"""WITH cells AS (SELECT CAST(row // 50 AS BIGINT) AS zone, {_class_sql(6)} AS code FROM {_CELLS}), n AS (SELECT zone, code, count(*) AS n FROM cells GROUP BY 1, 2)
SELECT zone, 100.0 * sum(n * (code * 10.0)) / sum(n) / 100.0 AS intensity FROM n GROUP BY zone""")
def cell_share_weighted_sum(embeddings: DataFrame) -> DataFrame:
    """Land-use intensity of a zone: each class's intensity weighed by its share of the cells."""
    n = grid.zonal_counts(cells_of(embeddings).withColumn("zone", F.floor(F.col("row") / 50)).withColumn("value", _class(6)), ["zone"])
    return n.groupBy("zone").agg(aggregates.weighted_mean(F.col("value") * 10.0, F.col("n_cells").cast("double")).alias("intensity"))


@query("embeddings", sql=f"""WITH c AS (SELECT CAST(row // 20 AS BIGINT) AS dgo, {_class_sql(3)} = 0 AS riparian, {_class_sql(4)} = 0 AS was_riparian FROM {_CELLS}),
s AS (SELECT dgo, avg(CASE WHEN riparian THEN 1.0 ELSE 0 END) AS e, avg(CASE WHEN was_riparian THEN 1.0 ELSE 0 END) AS h FROM c GROUP BY dgo)
SELECT dgo, e AS existing, h AS historic, e / nullif(h, 0) AS departure, CASE WHEN h = 0 THEN 6 WHEN e / h >= 1 THEN 5 WHEN e / h >= 0.9 THEN 1 WHEN e / h >= 0.66 THEN 2 WHEN e / h >= 0.33 THEN 3 ELSE 4 END AS class FROM s""")
def riparian_departure(embeddings: DataFrame) -> DataFrame:
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    s = cells_of(embeddings).groupBy(F.floor(F.col("row") / 20).alias("dgo")).agg(share(_class(3) == 0).alias("existing"), share(_class(4) == 0).alias("historic"))
    ratio, cls = classify.riparian_departure(F.col("existing"), F.col("historic"))
    return s.select("dgo", "existing", "historic", ratio.alias("departure"), cls.alias("class"))


@query("embeddings", sql=f"""WITH n AS (SELECT CAST(row // 20 AS BIGINT) AS dgo, {_class_sql(12)} AS code, count(*) AS n FROM {_CELLS} GROUP BY 1, 2), s AS (SELECT dgo, code, n * 1.0 / sum(n) OVER (PARTITION BY dgo) AS share FROM n),
m AS (SELECT dgo, max(share) AS top FROM s WHERE code < 11 GROUP BY dgo)
SELECT dgo, CASE WHEN count(*) > 1 THEN 12 ELSE min(code) + 1 END AS conversion, max(share) AS share,
CASE WHEN max(share) < 0.1 THEN 1 WHEN max(share) < 0.25 THEN 2 WHEN max(share) < 0.5 THEN 3 ELSE 4 END AS level FROM s JOIN m USING (dgo) WHERE share = top AND code < 11 GROUP BY dgo""")
def dominant_conversion(embeddings: DataFrame) -> DataFrame:
    cells = cells_of(embeddings).withColumn("dgo", F.floor(F.col("row") / 20)).withColumn("code", _class(12))
    total = F.count(F.lit(1))
    wide = cells.groupBy("dgo").agg(*((F.count_if(F.col("code") == k) * 1.0 / total).alias(f"s{k}") for k in range(11)))
    number, share = classify.dominant([F.col(f"s{k}") for k in range(11)])
    return wide.select("dgo", number.cast("long").alias("conversion"), share.alias("share"), classify.conversion_level(share).alias("level"))


@query("embeddings", sql=f"""WITH c AS (SELECT row % 10 AS site, value FROM {_CELLS}) SELECT CAST(site AS BIGINT) AS site, avg(value) AS mean, min(value) AS low, max(value) AS high, (max(value) - min(value)) / 64.0 AS slope FROM c GROUP BY site""")
def catchment_relief(embeddings: DataFrame) -> DataFrame:
    return grid.zonal(cells_of(embeddings).withColumn("site", F.col("row") % 10), ["site"]).select("site", "mean", F.col("min").alias("low"), F.col("max").alias("high"), ((F.col("max") - F.col("min")) / 64.0).alias("slope"))




_SPREAD = """(SELECT row, col, {f}(m) OVER (PARTITION BY col ORDER BY row RANGE BETWEEN {n} PRECEDING AND {n} FOLLOWING) AS value FROM (SELECT row, col, {f}(value) OVER (PARTITION BY row ORDER BY col RANGE BETWEEN {n} PRECEDING AND {n} FOLLOWING) AS m FROM {t}))"""


@query("embeddings", sql=f"""WITH b AS (SELECT row, col, (value > 0.05)::INT AS value FROM {_CELLS}), g1 AS {_SPREAD.format(f="max", n=1, t="b")}, c1 AS {_SPREAD.format(f="min", n=1, t="g1")}, g2 AS {_SPREAD.format(f="min", n=2, t="c1")}, o2 AS {_SPREAD.format(f="max", n=2, t="g2")}
SELECT row, col, b.value AS before, c1.value AS closed, o2.value AS opened FROM b JOIN c1 USING (row, col) JOIN o2 USING (row, col)""")
def grow_and_shrink(embeddings: DataFrame) -> DataFrame:
    """Gaps of a mask closed, and then what is too small taken away."""
    mask = cells_of(embeddings).select("row", "col", (F.col("value") > 0.05).cast("int").alias("value"))
    closed = written(grid.closed(mask, 1))
    opened = grid.opened(closed, 2).withColumnRenamed("value", "opened")
    return mask.withColumnRenamed("value", "before").join(closed.withColumnRenamed("value", "closed"), ["row", "col"]).join(opened, ["row", "col"])


@query("embeddings", sql=f"""WITH cells AS MATERIALIZED (SELECT * FROM {_CELLS}), w AS (SELECT * FROM (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j)),
sent AS (SELECT row + i AS row, col + j AS col, value * -j * (CASE i WHEN 0 THEN 2 ELSE 1 END) / 80 AS dx, value * i * (CASE j WHEN 0 THEN 2 ELSE 1 END) / 80 AS dy, i = 0 AND j = 0 AS own FROM cells, w),
s AS (SELECT row, col, sum(dx) AS dx, sum(dy) AS dy, count(*) AS n FROM sent GROUP BY row, col HAVING bool_or(own)),
a AS (SELECT *, CASE WHEN dx = 0 AND dy = 0 THEN 0 ELSE atan2(-dx, -dy) END AS aspect, atan(sqrt(dx * dx + dy * dy)) AS slope FROM s)
SELECT row, col, CASE WHEN n = 9 THEN round(greatest(0, 255 * (cos(radians(45)) * cos(slope) + sin(radians(45)) * sin(slope) * cos(radians(315) - aspect))), 6) END AS shade FROM a""")
def hillshade(embeddings: DataFrame) -> DataFrame:
    return grid.hillshade(cells_of(embeddings), 10.0).select("row", "col", F.round("value", 6).alias("shade"))
