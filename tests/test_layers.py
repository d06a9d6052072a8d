"""Spatial joins, own windows, bucketed merges, hulls, chains and samples against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.operators import grid, joins, layers, shapes, windows
from rillflow.streaming import landing

BOX = "name string, xmin double, ymin double, xmax double, ymax double"


def some_boxes(rng, n):
    out = [("all", -1e6, -1e6, 1e6, 1e6), ("point", 3.0, 3.0, 3.0, 3.0), ("null", None, 0.0, 1.0, 1.0), ("line", -5.0, 2.0, 900.0, 2.0)]
    for k in range(n):
        x, y = rng.integers(-40, 40, 2)
        w, h = 2.0 ** rng.integers(-3, 6, 2)
        out.append((f"b{k}", float(x), float(y), float(x + w), float(y + h)))
    return out


@pytest.mark.parametrize("cell_rows", [50_000, 7])
def test_points_and_boxes_of_all_sizes(spark, cell_rows):
    rng = np.random.default_rng(1)
    boxes = some_boxes(rng, 60)
    points = [(k, *(float(v) for v in rng.integers(-45, 45, 2))) for k in range(150)] + [(1000 + k, 3.0, 3.0) for k in range(80)] + [(-1, None, 1.0)]
    found = joins.points_in_boxes(spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(boxes, BOX), 1.0, cell_rows)
    wanted = sorted((i, n) for i, x, y in points if x is not None for n, x0, y0, x1, y1 in boxes if x0 is not None and x0 <= x <= x1 and y0 <= y <= y1)
    assert sorted((r.id, r.name) for r in found.collect()) == wanted


@pytest.mark.parametrize("cell_rows", [50_000, 5])
def test_pairs_of_boxes_once(spark, cell_rows):
    rng = np.random.default_rng(2)
    a, b = some_boxes(rng, 50), some_boxes(rng, 70)
    found = joins.boxes_meet(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX), 0.5, cell_rows)
    meets = lambda p, q: p[1] is not None and q[1] is not None and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]
    assert sorted((r.left_name, r.right_name) for r in found.collect()) == sorted((p[0], q[0]) for p in a for q in b if meets(p, q))


def test_a_dense_cell_is_shared_and_a_large_box_is_one_row(spark):
    boxes = spark.createDataFrame([("all", -1e9, -1e9, 1e9, 1e9), ("hot", 0.0, 0.0, 1.0, 1.0)], BOX)
    assert joins.stored(boxes, 1.0).count() == 2
    points = spark.range(20_000).select("id", (F.col("id") % 7 / 10).alias("x"), F.lit(0.5).alias("y"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = joins.points_in_boxes(points, boxes, 1.0, 1000)
        per = [r["count"] for r in met.groupBy("name", F.spark_partition_id()).count().collect()]
        assert met.count() == 40_000 and max(per) < 0.6 * 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_through_boxes_by_segment(spark):
    line = [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 10.0, "y": 10.0}]
    rows = spark.createDataFrame([(1, line), (2, line[:1])], "id long, line array<struct<x:double,y:double>>")
    found = layers.lines_in_boxes(rows, spark.createDataFrame([("corner", 8.0, -1.0, 12.0, 4.0), ("off", 2.0, 2.0, 8.0, 8.0)], BOX), ["id"], ["name"], "line", 1.0)
    assert [tuple(r) for r in found.collect()] == [(1, "corner", 6.0)]


def test_own_windows(spark):
    rng = np.random.default_rng(3)
    rows = [(("p", None, "q")[k % 3], float(d), None if k % 11 == 0 else float(v)) for k, (d, v) in enumerate(rng.integers(-50, 50, (300, 2)))]
    anchors = [(("p", None, "q", "r")[k % 4], float(c), float(c - a), float(c + b)) for k, (c, a, b) in enumerate(rng.integers(0, 60, (120, 3)))] + [("p", 0.0, 5.0, 4.0), ("p", 1.0, None, 4.0), ("p", 2.0, -1e6, 1e6), ("p", 2.0, -1e6, 1e6)]
    df = spark.createDataFrame(rows, "path string, at double, v double").withColumns({"u": F.col("v"), "w": F.col("v")})
    out = windows.own_windows(spark.createDataFrame(anchors, "path string, at double, low double, high double"), df, "path", "at", F.col("low"), F.col("high"), 16.0, ["v"], ["u"], ["w"])
    found = sorted(((r.path, r.at, r.low, r.high, r.mw_v, r.mw_u, r.mw_w) for r in out.collect()), key=str)
    wanted = []
    for p, at, low, high in anchors:
        inside = [v for q, d, v in rows if q == p and low is not None and low <= d <= high and v is not None]
        wanted.append((p, at, low, high, sum(inside) if inside else None, min(inside, default=None), max(inside, default=None)))
    assert found == sorted(wanted, key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "<= cast(at" not in plan and "Cartesian" not in plan


def test_merges_rewrite_touched_buckets_only(spark, tmp_path):
    schema, target = "k long, n long, v string", str(tmp_path / "target")
    merge = lambda rows, version, kind=schema: landing.merge_batch(spark.createDataFrame(rows, kind), version, target, ["k"], "n", buckets=4)
    read = lambda version=None: {r.k: r.v for r in landing.read_target(spark, target, version).collect()}
    assert landing.read_target(spark, target) is None
    merge([(k, 0, f"a{k}") for k in range(40)], 0)
    assert read() == {k: f"a{k}" for k in range(40)}
    merge([(7, 1, "b"), (7, 2, "c"), (100, 1, "d")], 1)
    changed = {k: f"a{k}" for k in range(40)} | {7: "c", 100: "d"}
    assert read() == changed and read(0)[7] == "a7" and landing.read_target(spark, target, 9) is None
    files = {p.parent.name: p.parent.parent.name for p in (tmp_path / "target").rglob("*.parquet")}
    rewritten = {p.parent.name for p in (tmp_path / "target" / "data" / "v=000000001").rglob("*.parquet")}
    assert 1 <= len(rewritten) <= 2 < len(files)  # two keys, of four buckets
    merge([(7, 1, "b"), (7, 2, "c"), (100, 1, "d")], 1)  # once more
    assert read() == changed
    # a batch that broke after its files and before its manifest
    spark.createDataFrame([(1, 1, "half")], schema).write.parquet(f"{target}/data/v=000000002/bucket__=0")
    assert read() == changed
    merge([(8, 5, "e", 1.5)], 2, schema + ", more double")
    assert read() == changed | {8: "e"}
    assert {r.k: r.more for r in landing.read_target(spark, target).filter("k in (8, 9)").collect()} == {8: 1.5, 9: None}
    for version in range(3, 8):
        merge([(k, version, f"v{version}") for k in range(40)], version)
    assert landing.versions(spark, target) == [5, 6, 7] and landing.read_target(spark, target, 4) is None
    assert read() == {k: "v7" for k in range(40)} | {100: "d"}
    kept = {p.name for p in (tmp_path / "target" / "data").iterdir()}
    assert "v=000000003" not in kept and "v=000000007" in kept


def test_hulls(spark):
    rng = np.random.default_rng(6)
    groups = {"many": [tuple(map(float, p)) for p in rng.integers(0, 30, (400, 2))], "one": [(1.0, 1.0)] * 3, "line": [(float(k), 2.0 * k) for k in range(9)], None: [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (2.0, 2.0), (2.0, 0.0)]}
    rows = [(g, x, y) for g, pts in groups.items() for x, y in pts] + [("many", None, 3.0), ("empty", None, None)]
    found = {}
    for r in shapes.convex_hulls(spark.createDataFrame(rows, "g string, x double, y double").repartition(7), ["g"], slices=5).orderBy("place").collect():
        found.setdefault(r.g, []).append((r.x, r.y))
    assert found["one"] == [(1.0, 1.0)] and found["line"] == [(0.0, 0.0), (8.0, 16.0)] and found[None] == [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    assert set(found) == set(groups)
    h = found["many"]
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    assert all(turn(a, b, c) > 0 for a, b, c in zip(h, h[1:] + h[:1], h[2:] + h[:2], strict=True))
    assert all(turn(a, b, p) >= 0 for a, b in zip(h, h[1:] + h[:1], strict=True) for p in groups["many"])


def test_chains_of_a_star_a_loop_and_single_parts(spark):
    parts = [(1, "s", "m"), (2, "e1", "m"), (3, "m", "e2"), (4, "e2", "e3")]  # three arms from m, one of them of two parts
    parts += [(10, "a", "b"), (11, "c", "b"), (12, "c", "a")]  # a loop
    parts += [(20, "z", "z"), (21, "u", "v"), (22, "w", "v"), (23, "w", "x")]
    out = {r.part: (r.line, r.place, r.turned) for r in shapes.chained(spark.createDataFrame(parts, "part long, a string, b string")).collect()}
    assert out == {1: (1, 0, False), 2: (2, 0, False), 3: (3, 0, False), 4: (3, 1, False), 10: (10, 0, False), 11: (10, 1, True), 12: (10, 2, False), 20: (20, 0, False), 21: (21, 0, False), 22: (21, 1, True), 23: (21, 2, False)}


def test_quota_samples_are_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(k, "rare" if k % 100 == 0 else "ab"[k % 2], *(float(v) for v in rng.random(2) ** 2)) for k in range(2000)]
    df = spark.createDataFrame(rows, "id long, s string, x double, y double")
    sample = lambda n, least: layers.quota_sample(df, "id", "s", (0.0, 0.0, 1.0, 1.0), n, least)
    out = sample(90, 10).collect()
    assert len(out) == 90 and len({r.id for r in out}) == 90
    counts = {s: sum(r.s == s for r in out) for s in ("rare", "a", "b")}
    assert counts["rare"] >= 10 and min(counts["a"], counts["b"]) >= 35
    assert {r.id for r in out} == {r.id for r in sample(90, 10).collect()}
    assert 0 < sample(5000, 0).count() <= 2000
    assert sample(4, 3).count() == 4


def test_grow_and_shrink(spark):
    rng = np.random.default_rng(9)
    a = (rng.random((20, 23)) < 0.3).astype(int)
    gone = {(3, 4), (3, 5), (10, 0)}
    cells = spark.createDataFrame([(r, c, int(v)) for (r, c), v in np.ndenumerate(a) if (r, c) not in gone], "row int, col int, value int")

    def plain(values, n, how):
        return {(r, c): how(v for (i, j), v in values.items() if abs(i - r) <= n and abs(j - c) <= n) for r, c in values}

    values = {(r, c): int(v) for (r, c), v in np.ndenumerate(a) if (r, c) not in gone}
    of = lambda df: {(r.row, r.col): r.value for r in df.collect()}
    for n in (1, 2):
        assert of(grid.grown(cells, n, strip=5)) == plain(values, n, max)
        assert of(grid.shrunk(cells, n, strip=5)) == plain(values, n, min)
        closed = of(grid.closed(cells, n))
        assert closed == plain(plain(values, n, max), n, min) and all(closed[k] >= v for k, v in values.items())
    with pytest.raises(ValueError, match="strip"):
        grid.grown(cells, 5, strip=5)


def test_hillshade_of_planes(spark):
    plane = lambda fx, fy: spark.createDataFrame([(r, c, fx * c + fy * r) for r in range(3) for c in range(3)], "row int, col int, value double")
    shade = lambda *f: grid.hillshade(plane(*f), 1.0, 90.0, 45.0).filter("row = 1 and col = 1").first().value
    assert math.isclose(shade(0.0, 0.0), 255 * math.sin(math.pi / 4))
    assert math.isclose(shade(-1.0, 0.0), 255.0)  # falls towards the light in the east
    assert abs(shade(1.0, 0.0)) < 1e-9
