"""Distances, paths, rings and polygons against plain versions."""

import heapq
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.operators import distance, grid, intervals, network, paths, polygons, rings

CELLS = "row long, col long"


def plain_nearest(cell, sources):
    return min(((cell[0] - r) ** 2 + (cell[1] - c) ** 2, r, c) for r, c in sources)


def test_nearest_sources_of_odd_rasters(spark, monkeypatch):
    monkeypatch.setattr(distance, "WIDE", 3)
    monkeypatch.setattr(distance, "TALL", 4)
    rng = np.random.default_rng(2)
    cells = sorted({(int(r), int(c)) for r, c in rng.integers(-9, 40, (500, 2))})
    for n in (1, 2, 12, 150):  # sources also where no cell is
        sources = [(int(r), int(c)) for r, c in rng.integers(-15, 55, (n, 2))]
        found = distance.nearest_sources(spark.createDataFrame(cells, CELLS), spark.createDataFrame(sources + sources[:1], CELLS))
        got = {(r.row, r.col): (round(r.distance**2), r.seed_row, r.seed_col) for r in found.collect()}
        assert got == {c: plain_nearest(c, sources) for c in cells}


def test_no_source_and_no_cell(spark):
    some, none = spark.createDataFrame([(0, 0)], CELLS), spark.createDataFrame([], CELLS)
    assert [tuple(r) for r in distance.nearest_sources(some, none).collect()] == [(0, 0, None, None, None)]
    assert distance.nearest_sources(none, some).count() == 0


def test_one_source_in_a_corner(spark):
    n = 2000
    cells = spark.range(n * n).select(F.floor(F.col("id") / n).alias("row"), (F.col("id") % n).alias("col"))
    d = distance.proximity(cells, spark.createDataFrame([(n - 1, 0)], CELLS), 1.0)
    wrong = d.filter(F.abs(F.col("value") - F.sqrt(F.pow(n - 1 - F.col("row"), 2) + F.pow("col", 2))) > 1e-9)
    assert d.count() == n * n and wrong.isEmpty()


def dijkstra(costs, starts):
    total, queue = {}, [(0.0, s) for s in starts if s in costs]
    heapq.heapify(queue)
    while queue:
        t, (r, c) = heapq.heappop(queue)
        if (r, c) in total:
            continue
        total[r, c] = t
        for i, j in paths.STEPS:
            n = (r + i, c + j)
            if n in costs and n not in total:
                heapq.heappush(queue, (t + (costs[r, c] + costs[n]) / 2 * math.hypot(i, j), n))
    return total


def test_least_costs_equal_dijkstra(spark):
    rng = np.random.default_rng(4)
    costs = {(r, c): float(rng.integers(1, 9)) for r in range(-6, 30) for c in range(40) if c % 10 != 7 or r == 12}  # walls with one gap
    costs |= {(100, 100): 1.0, (100, 101): 2.0}  # an island
    starts = [(0, 0), (29, 1), (0, 7)]  # the last has no cost
    cells = spark.createDataFrame([(r, c, x) for (r, c), x in costs.items()] + [(0, 7, None)], "row long, col long, cost double")
    found = paths.least_costs(cells, spark.createDataFrame(starts, CELLS), tile=8).cache()
    wanted = dijkstra(costs, starts)
    got = {(r.row, r.col): r for r in found.collect()}
    assert set(got) == set(costs)
    for cell, r in got.items():
        assert (r.total is None) == (cell not in wanted)
        if r.total is not None:
            assert math.isclose(r.total, wanted[cell], rel_tol=1e-12)
            if r.from_row is not None:
                step = (costs[cell] + costs[r.from_row, r.from_col]) / 2 * math.hypot(cell[0] - r.from_row, cell[1] - r.from_col)
                assert math.isclose(got[r.from_row, r.from_col].total + step, r.total, rel_tol=1e-12)
    way = {(r.row, r.col) for r in paths.paths_to(found, spark.createDataFrame([(20, 39), (100, 100)], CELLS)).collect()}
    at, plain = (20, 39), set()
    while at[0] is not None:
        plain.add(at)
        at = (got[at].from_row, got[at].from_col)
    assert way == plain and way & {(0, 0), (29, 1)}
    ends = {(r.start_row, r.start_col) for r in paths.allocation(found).collect()}
    assert ends == {(0, 0), (29, 1)}


def test_growth_stops_at_high_cells_and_costs_are_positive(spark):
    cells = spark.createDataFrame([(0, c, 1.0 if c == 4 else 0.0) for c in range(9)], "row long, col long, height double")
    g = paths.grown(cells, spark.createDataFrame([(0, 0)], CELLS), "height < 0.5", 2.5)
    assert sorted((r.col, r.distance) for r in g.collect()) == [(0, 0.0), (1, 1.0), (2, 2.0)]
    with pytest.raises(Exception, match="over 0"):
        paths.least_costs(cells, cells, "height").count()


def square(x, y, size=1.0):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


def test_rings_of_regions(spark):
    #  A A A .      one region with a hole, and two that touch at a corner
    #  A . A .
    #  A A A B
    #  . . B .
    cells = [(0, 0), (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1), (2, 2)]
    rows = [(r, c, 1) for r, c in cells] + [(2, 3, 2), (3, 2, 2)]
    edges = rings.dissolved(rings.region_edges(spark.createDataFrame(rows, "row long, col long, region long")), ["region"])
    for apart, wanted in ((True, {(1, 12, 9.0, False), (1, 4, 1.0, True), (2, 4, 1.0, False)}), (False, {(1, 12, 9.0, False), (1, 4, 1.0, True), (2, 8, 2.0, False)})):
        linked = rings.linked(edges, ["region"], apart)
        m = rings.measured(linked, ["region"])
        assert {(r.region, r.n_edges, r.area, r.hole) for r in m.collect()} == wanted
        for ring in {r.ring for r in m.collect()}:  # each edge begins where the one before it ends
            e = sorted(linked.filter(F.col("ring") == ring).collect(), key=lambda r: r.place)
            assert [r.place for r in e] == list(range(len(e)))
            assert all((a.x1, a.y1) == (b.x0, b.y0) for a, b in zip(e, e[1:] + e[:1], strict=True))
    corners = rings.corners(rings.linked(edges, ["region"]), ["region"])
    assert Counter(r.region for r in corners.collect()) == {1: 8, 2: 8}
    with pytest.raises(ValueError, match="close"):
        rings.linked(edges.filter("not (x0 = 0 and y0 = 0)"), ["region"])


def test_areas_of_rings_equal_cell_counts(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 2, (25, 30))
    cells = spark.createDataFrame([(r, c, int(v)) for (r, c), v in np.ndenumerate(values)], "row long, col long, value int")
    labelled = grid.regions(cells, stretch=7).cache()  # runs go on behind cuts
    plain, names = {}, {}
    for cell in np.ndindex(25, 30):  # in the order of names
        stack = [cell]
        while stack:
            r, c = at = stack.pop()
            if at not in plain and 0 <= r < 25 and 0 <= c < 30 and values[at] == values[cell]:
                plain[at] = names.setdefault(cell, cell[0] * 2**31 + cell[1])
                stack += [(r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)]
    assert {(r.row, r.col): r.region for r in labelled.collect()} == plain
    m = rings.measured(rings.linked(rings.dissolved(rings.region_edges(labelled), ["region"]), ["region"]), ["region"])
    area = Counter()
    for r in m.collect():
        area[r.region] += -r.area if r.hole else r.area
    assert area == Counter(plain.values())


def test_region_names_of_wide_rasters(spark):
    cells = spark.range(5000).select(F.lit(0).alias("row"), F.col("id").alias("col"), F.lit(1).alias("value"))
    both = cells.union(cells.withColumn("row", F.lit(4)))
    assert {(r.region, r["count"]) for r in grid.regions(both, stretch=1000).groupBy("region").count().collect()} == {(0, 5000), (4 << 31, 5000)}


def test_a_long_row_and_a_long_stream_are_many_tasks(spark):
    n = 40_000
    cells = spark.range(n).select(F.lit(0).alias("row"), F.col("id").alias("col"), F.lit(1).alias("value"))
    assert grid.regions(cells, stretch=4096).select("region").distinct().count() == 1
    spans = spark.range(n).select(F.lit("x").alias("path"), F.col("id").cast("double").alias("a"), (F.col("id") + 1.5).alias("b"))
    assert [tuple(r) for r in intervals.dissolve(spans, ["path"], "a", "b", 1000.0).collect()] == [("x", 0.0, n + 0.5)]
    pieces = intervals.split(spans, ["path"], "a", "b", {"all": F.lit(True)}, 1000.0)
    assert pieces.count() == 2 * n - 1 and pieces.filter("b - a <> 0.5 and b - a <> 1.0").isEmpty()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert pieces.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_intervals_over_empty_stretches_and_null_keys(spark):
    rows = [(None, 0.0, 100.0, True), (None, 50.0, 60.0, False), ("p", 1.0, 2.0, True), ("p", 2.0, 95.0, False), ("p", 200.0, 201.0, None), ("p", None, 3.0, True)]
    df = spark.createDataFrame(rows, "k string, a double, b double, f boolean")
    assert sorted((tuple(r) for r in intervals.dissolve(df, ["k"], "a", "b", 7.0).collect()), key=str) == [("p", 1.0, 95.0), ("p", 200.0, 201.0), (None, 0.0, 100.0)]
    out = intervals.split(df, ["k"], "a", "b", {"f": F.col("f")}, 7.0)
    assert sorted((tuple(r) for r in out.collect()), key=str) == [("p", 1.0, 2.0, True), ("p", 2.0, 95.0, False), ("p", 200.0, 201.0, False), (None, 0.0, 50.0, True), (None, 50.0, 60.0, True), (None, 60.0, 100.0, True)]


STAR = [(0.3, 0.2), (9.7, 1.1), (6.2, 4.9), (9.1, 9.4), (4.4, 6.1), (-2.6, 8.8), (2.7, 3.9)]
HOLE = [(3.1, 2.2), (4.4, 2.9), (3.6, 4.1)]
RHOMB = [(4.0, -1.5), (8.4, 3.0), (4.1, 7.5), (-0.5, 2.9)]


def shapes(spark, key, parts):
    rows = [(name, [{"x": float(x), "y": float(y)} for x, y in ring], hole) for name, ring, hole in parts]
    df = spark.createDataFrame(rows, f"{key} string, ring array<struct<x:double,y:double>>, hole boolean")
    return polygons.ring_edges(df, [key], hole=F.col("hole"))


def inside(x, y, parts):
    odd = np.zeros_like(x, bool)
    for ring in parts:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if ay != by:
                odd ^= ((ay > y) != (by > y)) & (x < ax + (y - ay) * (bx - ax) / (by - ay))
    return odd


@pytest.mark.parametrize("cell", [0.7, 1.0, 2.5, 40.0])
def test_polygons_by_a_fine_grid(spark, cell):
    fine = 0.01
    x, y = np.meshgrid(np.arange(-4, 12, fine) + fine / 2, np.arange(-4, 12, fine) + fine / 2)
    star, rhomb = inside(x, y, [STAR, HOLE]), inside(x, y, [RHOMB])
    a = polygons.cell_pieces(shapes(spark, "a", [("star", STAR[::-1], False), ("star", HOLE, True)]), ["a"], cell).cache()
    b = polygons.cell_pieces(shapes(spark, "b", [("rhomb", RHOMB, False), ("far", square(50, 50), False), ("tiles", square(2, 2, 2), False), ("tiles", square(4, 2, 2), False)]), ["b"], cell).cache()
    own = {r.a: r.area for r in polygons.areas(a, ["a"], cell).collect()}
    assert abs(own["star"] - star.sum() * fine**2) < 0.02
    fractions = polygons.coverage(a, ["a"])
    assert abs(fractions.agg(F.sum("fraction")).first()[0] * cell**2 - own["star"]) < 1e-9
    assert fractions.filter("fraction > 1 + 1e-9").isEmpty()
    met = {r.right_b: r.area for r in polygons.overlaps(a, b, ["a"], ["b"], cell).collect()}
    tiles = (x > 2) & (x < 6) & (y > 2) & (y < 4)
    assert set(met) == {"rhomb", "tiles"}
    assert abs(met["rhomb"] - (star & rhomb).sum() * fine**2) < 0.02 and abs(met["tiles"] - (star & tiles).sum() * fine**2) < 0.02
    rest = polygons.differences(a, b.filter("b = 'rhomb'"), ["a"], ["b"], cell).first()
    assert abs(rest.rest - (star & ~rhomb).sum() * fine**2) < 0.03
    lines = [("slant", -3.0, -2.0, 9.0, 10.0), ("flat", -4.0, 2.05, 11.0, 2.05), ("upright", 3.3, 11.0, 3.3, -3.0), ("back", 10.0, 8.0, -2.0, 1.0), ("out", 20.0, 20.0, 30.0, 30.0)]
    found = polygons.lengths_inside(spark.createDataFrame(lines, "line string, x0 double, y0 double, x1 double, y1 double"), a, ["line"], ["a"], cell)
    got = {r.line: r.length for r in found.collect()}
    t = (np.arange(200_000) + 0.5) / 200_000
    for name, x0, y0, x1, y1 in lines:
        wanted = inside(x0 + t * (x1 - x0), y0 + t * (y1 - y0), [STAR, HOLE]).mean() * math.hypot(x1 - x0, y1 - y0)
        assert abs(got.get(name, 0.0) - wanted) < 0.01, name


def test_many_nodes_of_one_component(spark):
    n = 400
    edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = network.components(edges)
    assert out.count() == n and out.filter("component <> 0").isEmpty()
