"""Tables whose keys give the same places and areas again and again: each is computed with once, and every row has its answer."""

import math

import numpy as np
import pytest
from oracle import same
from pyspark.sql import functions as F

from rillflow.operators import joins, layers, polygons
from rillflow.plans import ORACLES, QUERIES

#: Keys so far apart give the same place, the same area.
PLACE, AREA = 3600, 59_500


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Sixty places of five customers each, forty areas of three suppliers each."""
    d = str(tmp_path_factory.mktemp("repeated"))
    spark.range(300).select((F.col("id") % 60 * 31 + F.floor(F.col("id") / 60) * PLACE).alias("c_custkey")).toPandas().to_parquet(f"{d}/customer.parquet")
    owners = spark.range(120).select((F.col("id") % 40 * 787 + F.floor(F.col("id") / 40) * AREA).alias("s_suppkey"), (F.col("id") * 37 % 400).cast("double").alias("s_acctbal"))
    owners.toPandas().to_parquet(f"{d}/supplier.parquet")
    return d


def test_rows_get_what_was_found_for_their_values(spark):
    found = spark.createDataFrame([(0.0, "a", 1), (0.0, "a", 2), (1.5, "a", 3), (None, "a", 4)], "x double, k string, n int")
    rows = spark.createDataFrame([(1, -0.0, "a"), (2, 0.0, "a"), (3, 1.5, "a"), (4, 1.5, None), (5, None, "a"), (6, 7.0, "a"), (3, 1.5, "a")], "id int, x double, k string")
    for cell_rows in (50_000, 1):
        assert sorted((r.id, r.n) for r in joins.for_rows(found, rows, ["x", "k"], cell_rows).collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 3), (3, 3)]


def test_reaches_from_one_place_are_measured_once(spark, repeated, monkeypatch):
    asked, inside = [], polygons.lengths_inside
    monkeypatch.setattr(polygons, "lengths_inside", lambda segments, *a: asked.append(segments.count()) or inside(segments, *a))
    same(QUERIES["line_length_in_polygons"](spark, repeated), ORACLES["line_length_in_polygons"], repeated)
    assert asked == [60]


def test_lines_from_one_place_and_equal_boxes_meet_once(spark, repeated, monkeypatch):
    asked, inside = [], layers.lines_in_boxes
    monkeypatch.setattr(layers, "lines_in_boxes", lambda lines, boxes, *a: asked.append((lines.count(), boxes.count())) or inside(lines, boxes, *a))
    same(QUERIES["intersect_with_measure"](spark, repeated), ORACLES["intersect_with_measure"], repeated)
    assert asked == [(60, 40)]


@pytest.mark.parametrize("name", ["majority_owner_by_area", "polygon_overlap"])
def test_ranges_at_one_place_are_overlaid_once(spark, repeated, monkeypatch, name):
    asked, found = [], polygons.overlaps
    monkeypatch.setattr(polygons, "overlaps", lambda left, right, by, *a: asked.append(left.select(*by).distinct().count()) or found(left, right, by, *a))
    same(QUERIES[name](spark, repeated), ORACLES[name], repeated)
    assert asked == [60]


def test_points_at_one_place_are_counted_together(spark, repeated, monkeypatch):
    asked, inside = [], joins.points_in_polygons
    monkeypatch.setattr(joins, "points_in_polygons", lambda points, rings, *a: asked.append((points.count(), rings.count())) or inside(points, rings, *a))
    same(QUERIES["count_points_in_polygons"](spark, repeated), ORACLES["count_points_in_polygons"], repeated)
    assert asked == [(60, 40)]


@pytest.mark.parametrize("name", ["nearest_feature", "nearest_long_enough"])
def test_places_ask_for_the_nearest_once(spark, repeated, monkeypatch, name):
    asked, values = [], joins.distinct_values
    monkeypatch.setattr(joins, "distinct_values", lambda rows, on: asked.append((out := values(rows, on)).count()) or out)
    same(QUERIES[name](spark, repeated), ORACLES[name], repeated)
    assert asked == [60]


@pytest.mark.parametrize("n", [3, 60, 3000])
def test_nearest_among_dense_and_thin_targets(spark, n):
    rng = np.random.default_rng(n)
    targets = [(k, *(float(v) for v in (rng.normal(0, 0.3, 2) if k % 3 else rng.integers(-20, 20, 2)))) for k in range(n)] + [(-1, None, 0.0), (-2, 30.0, 30.0), (-3, 30.0, 30.0)]
    points = [(k, *(float(v) for v in rng.integers(-25, 25, 2))) for k in range(200)] + [(500 + k, *(float(v) for v in rng.normal(0, 0.5, 2))) for k in range(100)]
    points += [(7, 29.0, 30.0), (900, None, 1.0), (901, 38.0, 30.0), (902, 30.0, 38.1), (903, -0.0, 0.0), (904, 0.0, -0.0)]  # 7 is at two places
    df = lambda rows: spark.createDataFrame(rows, "id long, x double, y double")
    found = sorted(((r.id, r.x, r.y, r.near_id, r.distance) for r in joins.nearest_point(df(points), df(targets), "id", 8.0).collect()), key=str)
    wanted = []
    for k, x, y in points:
        near = min(((math.sqrt((x - a) ** 2 + (y - b) ** 2), t) for t, a, b in targets if None not in (x, a)), default=(9.0, None))
        wanted.append((k, x, y, near[1], near[0]) if near[0] <= 8 else (k, x, y, None, None))
    assert [r[:4] for r in found] == [r[:4] for r in sorted(wanted, key=str)]
