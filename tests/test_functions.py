"""Functions and operators against values worked out by hand or by brute force."""

from __future__ import annotations

import math
import struct
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.functions import classify, curves, formulas, fuzzy, geometry
from rillflow.operators import aggregates, catalogue, grid, intervals, joins, layers, network, survey, windows
from rillflow.plans.quality import threshold_tests, violations
from rillflow.sources import tables
from rillflow.streaming import landing


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("v")).first().v if values else spark.range(1).select(column.alias("v")).first().v


# --- formulas and curves ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("text", "values", "wanted"), [("1+1", {}, 2), ("(1+1) * 2", {}, 4), ("(1+a) * 2", {"a": 4}, 10), ("0.177 * (a ** 0.397) * (p ** 0.453)", {"a": 1, "p": 1}, 0.177)])
def test_formulas(spark, text, values, wanted):
    assert formulas.evaluate(text, values) == pytest.approx(wanted)
    assert one(spark, formulas.formula(text, {k: F.lit(float(v)) for k, v in values.items()})) == pytest.approx(wanted)


@pytest.mark.parametrize(("text", "values"), [("1/0", {}), ("1 +* 2", {}), ("a + 1", {"a": "x"}), ("__import__('os')", {}), ("1e308 * 1e308", {})])
def test_bad_formulas(text, values):
    with pytest.raises(formulas.FormulaError):
        formulas.evaluate(text, values)


def test_regional_curve(spark):
    q = formulas.regional_curve("2 * DRNAREA ** E", {"E": 0.5}, F.lit(16.0))
    assert one(spark, q) == 8 and one(spark, formulas.regional_curve("2 * DRNAREA ** E", {"E": 0.5}, F.lit(16.0), cubic_metres=True)) == pytest.approx(8 * 0.028316846592)


KNOTS = [(0.0, 0.0), (1.0, 1.0), (2.0, 4.0), (3.0, 9.0), (4.0, 16.0)]


@pytest.mark.parametrize(("kind", "x", "wanted"), [
    ("linear", 1.5, 2.5), ("slinear", 2.5, 6.5), ("nearest", 1.5, 1.0), ("nearest-up", 1.5, 4.0), ("nearest", 1.6, 4.0), ("zero", 1.9, 1.0), ("previous", 2.0, 4.0), ("previous", 2.9, 4.0), ("next", 2.0, 4.0), ("next", 2.1, 9.0),
    ("quadratic", 1.5, 2.25), ("cubic", 2.5, 6.25), ("linear", -1.0, 0.0), ("linear", 5.0, 0.0), ("cubic", 4.0, 16.0),
])
def test_curves(spark, kind, x, wanted):
    assert one(spark, curves.curve(kind, F.lit(x), KNOTS)) == pytest.approx(wanted)


def test_curve_of_an_equation_and_nulls(spark):
    assert one(spark, curves.curve("function", F.lit(3.0), equation="x ** 2 + 1")) == 10
    assert one(spark, curves.curve("linear", F.lit(None).cast("double"), KNOTS)) is None
    assert [one(spark, curves.zone(F.lit(v), [10.0, 20.0, None])) for v in (9.9, 10.0, 20.0, 1e9)] == [0, 1, 2, 2]
    assert one(spark, curves.evidence(F.lit(0.5), F.lit(0.5), F.lit(1.0))) == pytest.approx(0.995)


# --- fuzzy systems ----------------------------------------------------------------------------------------------------


def plain_value(system: fuzzy.System, **inputs: float) -> float:
    """Inference by definition on a fine grid."""
    lo, hi = min(s[0] for s in system.output.values()), max(s[-1] for s in system.output.values())
    grid_x = np.linspace(lo, hi, 200_001)

    def height(x, shape):
        a, b, c, d = shape if len(shape) == 4 else (shape[0], shape[1], shape[1], shape[2])
        up = np.where(x >= b, 1.0, (x - a) / (b - a) if b > a else 0.0)
        down = np.where(x <= c, 1.0, (d - x) / (d - c) if d > c else 0.0)
        return np.clip(np.minimum(up, down), 0, 1)

    joined = np.zeros_like(grid_x)
    for conditions, term in system.rules:
        strength = 1.0
        for name, terms in conditions:
            x = min(max(inputs[name], system.ranges[name][0]), system.ranges[name][1])
            levels = [1 - float(height(x, system.inputs[name][t[1:]])) if t[0] == "!" else float(height(x, system.inputs[name][t])) for t in terms.split("|")]
            strength = min(strength, max(levels))
        joined = np.maximum(joined, np.minimum(strength, height(grid_x, system.output[term])))
    return float((joined * grid_x).sum() / joined.sum())


@pytest.mark.parametrize(("name", "cases"), [
    ("VEGETATION", [(0.5, 0.7), (2.2, 3.4), (4, 4), (0, 0), (1, 2)]),
    ("COMBINED", [(12.0, 900, 160, 0.01), (3.0, 1300, 100, 0.14), (30.0, 2000, 170, 0.001), (0.05, 100, 10, 0.05), (20, 5000, 186, 0.2)]),
    ("CONDITION", [(0.2, 50, 0.6), (0.9, 30, 0.93), (0.6, 99, 0.2), (1.0, 0, 1.0)]),
    ("GRAZING", [(50, 1, 3.7), (600, 12, 2.2), (30000, 20, 1.0), (300, 5, 1.4)]),
])
def test_fuzzy_systems(spark, name, cases):
    system = getattr(fuzzy, name)
    keys = list(system.ranges)
    rows = spark.createDataFrame([tuple(map(float, c)) for c in cases], keys)
    found = [r.v for r in rows.select(system.evaluate(**{k: F.col(k) for k in keys}).alias("v")).collect()]
    assert found == pytest.approx([plain_value(system, **dict(zip(keys, c, strict=True))) for c in cases], abs=2e-3)


def test_capacities(spark):
    lit = lambda *v: [F.lit(float(x)) for x in v]
    assert one(spark, fuzzy.vegetation_capacity(*lit(0, 0))) == 0 and one(spark, fuzzy.vegetation_capacity(*lit(4, 4))) == 40
    assert one(spark, fuzzy.combined_capacity(*lit(0, 100, 10, 0.05, 1), F.lit(46006), F.lit(None).cast("double"))) == 0
    assert one(spark, fuzzy.combined_capacity(*lit(20, 100, 10, 0.05, 9), F.lit(46006), F.lit(5.0))) == 0
    assert one(spark, fuzzy.combined_capacity(*lit(20, 100, 10, 0.05, 9), F.lit(33600), F.lit(5.0))) > 8
    assert [one(spark, fuzzy.dam_count(F.lit(c), F.lit(500.0))) for c in (0.0, 0.5, 12.345)] == [0, 1, 6.17]
    assert one(spark, fuzzy.grazing_likelihood(*lit(10, 1, 0))) == 0
    assert one(spark, fuzzy.riparian_condition(F.lit(None).cast("double"), *lit(1, 1))) is None


# --- classes ----------------------------------------------------------------------------------------------------------


def test_departure_and_dominant(spark):
    cls = lambda e, h: one(spark, classify.riparian_departure(F.lit(e), F.lit(h))[1])
    assert [cls(1.0, 1.0), cls(0.95, 1.0), cls(0.7, 1.0), cls(0.4, 1.0), cls(0.1, 1.0), cls(0.1, 0.0)] == [5, 1, 2, 3, 4, 6]
    pick = lambda *v: one(spark, classify.dominant([F.lit(x) for x in v])[0])
    assert [pick(0.1, 0.5, 0.2), pick(0.4, 0.4, 0.1), pick(0.0, 0.0)] == [2, 12, 12]
    assert [one(spark, classify.conversion_level(F.lit(x))) for x in (0.0, 0.05, 0.1, 0.3, 0.5)] == [0, 1, 2, 3, 4]


def test_limitation_and_opportunity(spark):
    n = F.lit(None).cast("double")
    assert one(spark, classify.dam_limitation(*(F.lit(float(x)) for x in (0, 0, 1, 0.01, 0, 1, 1, 1)), n)) == "Naturally Vegetation Limited"
    assert one(spark, classify.dam_limitation(*(F.lit(float(x)) for x in (5, 5, 0, 0.01, 40, 1, 1, 1)), n)) == "Anthropogenically Limited"
    of = lambda cap: one(spark, classify.dam_opportunity(F.lit(classify.MINOR), F.lit(46006), F.lit(cap), F.lit(9.0), F.lit(95.0), F.lit(1.0), F.lit("Classic")))
    assert of(10.0) == "Natural or Anthropogenic Limitations" and of(10.5) == of(9.9) == "Conservation/Appropriate for Translocation"


def test_rules_as_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", -1)], "code string, v int")
    assert {r.rule: r.n for r in violations(rows, {"positive": F.col("v") > 0}).collect()} == {"positive": 1}
    assert {r.test: r.status for r in threshold_tests(rows, "code", {"a": (1, 2), "b": (1, 2), "c": (1, 2)}).collect()} == {"a": "Pass", "b": "Warning", "c": "Error"}


# --- geometry ---------------------------------------------------------------------------------------------------------


def points(*xy):
    return F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in xy))


def test_geometry(spark):
    line, square = points((0, 0), (3, 4), (3, 10)), points((0, 0), (4, 0), (4, 4), (0, 4))
    assert one(spark, geometry.length(line)) == 11 and one(spark, geometry.straight_length(line)) == pytest.approx(math.hypot(3, 10))
    assert one(spark, geometry.area(square)) == 16 and one(spark, geometry.azimuth(points((0, 0), (1, 0)))) == 90
    inside = lambda x, y: one(spark, geometry.in_ring(F.lit(float(x)), F.lit(float(y)), square))
    assert [inside(2, 2), inside(0, 0), inside(4, 2), inside(2, 4), inside(5, 5)] == [True, True, False, False, False]
    at = one(spark, geometry.point_at(line, F.lit(8.0)))
    assert (at.x, at.y) == (3, 7)
    assert [(p["from"], p["to"]) for p in one(spark, geometry.pieces(F.lit(10.5), 4.0, 2.0))] == [(0, 4), (4, 8), (8, 10.5)]
    assert [(p["from"], p["to"]) for p in one(spark, geometry.pieces(F.lit(9.0), 4.0, 2.0))] == [(0, 4), (4, 9)]
    assert len(one(spark, geometry.without_small_holes(F.array(square, points((1, 1), (2, 1), (2, 2)), points((0, 0), (3, 0), (3, 3))), 2.0))) == 2
    assert one(spark, layers.length_in_box(points((-1, -1), (9, 9)), *(F.lit(float(v)) for v in (0, 0, 4, 4)))) == pytest.approx(4 * math.sqrt(2))


def test_wkb(spark):
    shapes = [("line", [(0.0, 1.0), (2.0, 3.0)]), ("polygon", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]), ("point", [(5.0, 6.0)])]
    rows = spark.createDataFrame([(i, bytearray(geometry.encode_wkb(k, p))) for i, (k, p) in enumerate(shapes)] + [(3, None)], "i int, g binary")
    found = {r.i: r.p and [[(q.x, q.y) for q in part] for part in r.p] for r in rows.select("i", geometry.wkb_points(F.col("g")).alias("p")).collect()}
    assert found == {0: [shapes[0][1]], 1: [[*shapes[1][1], (0.0, 0.0)]], 2: [shapes[2][1]], 3: None}
    big = struct.pack(">BI", 0, 1001) + struct.pack(">ddd", 1, 2, 3)
    assert geometry.decode_wkb(big)[0].tolist() == [[1.0, 2.0]]


def test_uuid(spark):
    assert one(spark, layers.uuid5(F.lit("river.example"))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, "river.example"))


# --- operators on odd input -------------------------------------------------------------------------------------------


def test_nearest_key_keeps_every_row(spark):
    left = spark.createDataFrame([("a", 0), ("a", 0), ("a", 50), ("b", 1), (None, 1)], "k string, x int")
    right = spark.createDataFrame([("a", 2), ("a", -2), ("c", 1)], "k string, x int")
    out = sorted(((r.k or "", r.x, r.near_x) for r in joins.nearest_key(left, right, ["k"], "x", "x", 5).collect()), key=str)
    assert out == [("", 1, None), ("a", 0, -2), ("a", 0, -2), ("a", 50, None), ("b", 1, None)]


def test_networks(spark):
    chain = spark.createDataFrame([(i, i + 1 if i < 99 else None, 1.0) for i in range(100)], "id long, next long, v double")
    assert {r.id: r.upstream for r in network.upstream_sum(chain, "id", "next", "v").collect()} == {i: i + 1 for i in range(100)}
    assert {r.level_path for r in network.level_paths(chain, "id", "next", "v").collect()} == {1}
    ring = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "id long, next long, v double")
    with pytest.raises(ValueError, match="cycle"):
        network.upstream_sum(ring, "id", "next", "v")
    long = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.component for r in network.components(long).collect()} == {0}
    numbers = network.ranked(spark.range(1000).repartition(7), [F.desc("id")])
    assert {r.id: r["rank"] for r in numbers.collect()} == {i: 1000 - i for i in range(1000)}


def test_intervals(spark):
    rows = spark.createDataFrame([("p", 0.0, 4.0, "L"), ("p", 2.0, 6.0, "R"), ("p", 6.0, 7.0, "L"), ("p", 9.0, 10.0, "N"), ("q", 1.0, 1.0, "L")], "path string, a double, b double, k string")
    assert [(r.a, r.b) for r in intervals.dissolve(rows.filter("path = 'p'"), ["path"], "a", "b").orderBy("a").collect()] == [(0, 7), (9, 10)]
    pieces = intervals.split(rows, ["path"], "a", "b", {"l": F.col("k") == "L", "r": F.col("k") == "R"}).orderBy("a")
    assert [(r.a, r.b, r.l, r.r) for r in pieces.collect()] == [(0, 2, True, False), (2, 4, True, True), (4, 6, False, True), (6, 7, True, False), (9, 10, False, False)]
    c = intervals.confinement(pieces, ["path"], "l", "r").first()
    assert (c.length, c.ratio, c.constriction) == (8, 1.0, 0.25)
    total = sum(r.b - r.a for r in pieces.collect())
    assert total == sum(r.b - r.a for r in intervals.dissolve(rows, ["path"], "a", "b").collect())  # the union's length is its pieces'


def test_grid(spark):
    cells = spark.createDataFrame([(r, c, float(10 * c)) for r in range(3) for c in range(3)], "row long, col long, value double")
    slope = {(r.row, r.col): r.value for r in grid.slope_percent(cells, 10.0).collect()}
    assert slope[1, 1] == pytest.approx(100) and slope[0, 0] is None
    assert sorted((r.row, r.col, r.value) for r in grid.untiled(grid.tiled(cells, 2), 2).collect()) == sorted((r.row, r.col, r.value) for r in cells.collect())
    flow = spark.createDataFrame([(0, 0, 1, False, False), (0, 1, 1, False, False), (0, 2, None, True, False), (1, 0, 1, False, False), (1, 1, 5, False, False), (2, 0, 1, False, True)], "row long, col long, fd int, is_channel boolean, is_road boolean")
    no = F.lit(False)
    access = grid.floodplain_access(flow.withColumns({"is_rail": no, "is_canal": no, "in_vb": F.lit(True)}))
    assert {(r.row, r.col): r.access for r in access.collect()} == {(0, 0): 1, (0, 1): 1, (0, 2): 1, (1, 0): 2, (1, 1): 2, (2, 0): 0}


def test_window_width_and_power(spark):
    assert [one(spark, windows.window_width(F.lit(s), F.lit(g))) for s, g in ((0, 50), (0, 150), (4, 1), (2, None))] == [200, 300, 8000, 1200]
    assert one(spark, windows.reach_power(F.lit(0.01), F.lit(100.0))) == round(1000 * 9.80665 * 0.01 * 100 * 0.028316846592, 2)


def test_survey_edges(spark):
    rows = spark.createDataFrame([(1, "Levee", 1, 5.0), (1, "Natural", 3, 7.0), (1, "Natural", 2, 6.0), (2, "Levee", 1, 8.0), (3, "None", 1, 9.0)], "visit int, kind string, i int, v double")
    assert {r.visit: r.v for r in survey.preferred_first(rows, ["visit"], "kind", "i", "v", ["Natural", "Levee"]).collect()} == {1: 6.0, 2: 8.0, 3: None}
    fines = spark.createDataFrame([(1, 10, 0, 60, 0), (2, -99, 0, 5, 50)], "visit int, f1 int, n1 int, f2 int, n2 int")
    assert {r.visit: r.fines_pct for r in survey.pool_tail_fines(fines, ["visit"], [("f1", "n1"), ("f2", "n2")]).collect()} == {1: 20.0, 2: None}
    assert len(survey.WOOD_VOLUME) == 21 and len(survey.JAM_VOLUME) == 16


def test_regression_far_from_zero(spark):
    rows = spark.createDataFrame([("z", 1e8 + i, 2 * (1e8 + i) + (-1) ** i) for i in range(50)], "zone string, x double, y double")
    r = aggregates.regression_choice(rows, ["zone"], "x", "y").first()
    assert r.r2 == pytest.approx(1 - 1 / (4 * np.var(np.arange(50)) + 1), abs=1e-3) or r.kind == "power"


def test_catalogue_errors():
    with pytest.raises(ValueError, match="no calculation"):
        catalogue.read([{"metric_id": 1, "code": "x", "calculation": "magic", "field": "v"}])


# --- sources and streams ----------------------------------------------------------------------------------------------


def test_landing_takes_each_file_once(spark, tmp_path):
    base, schema = str(tmp_path), "k long, n long, v string"

    def drop(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/landing/{name}")

    def run():
        landing.merge_landing(spark, f"{base}/landing/*", schema, f"{base}/target", f"{base}/progress", ["k"], "n", stamp="batch").awaitTermination()
        return {r.k: (r.v, r.batch) for r in landing.read_target(spark, f"{base}/target").collect()}

    drop("a", [(1, 1, "a"), (2, 1, "b"), (1, 2, "c")])
    assert run() == {1: ("c", 0), 2: ("b", 0)}
    assert run() == {1: ("c", 0), 2: ("b", 0)}
    drop("b", [(2, 0, "d"), (3, 1, "e")])
    assert run() == {1: ("c", 0), 2: ("d", 1), 3: ("e", 1)}
    # a batch that is repeated writes its version anew
    landing.merge_batch(spark.createDataFrame([(3, 1, "f")], schema), 1, f"{base}/target", ["k"], "n", "batch")
    assert {r.k: r.v for r in landing.read_target(spark, f"{base}/target").collect()} == {1: "c", 2: "b", 3: "f"}


def test_boxes_hold_their_points(spark, tmp_path):
    rows = spark.createDataFrame([(1, [(0.1, -0.1)]), (2, [(123456.789, 7.7), (-3.3, 1e-9)])], "k int, p array<struct<x:double,y:double>>")
    b = {r.k: r.geometry_bbox for r in tables.with_box(rows, "p").collect()}
    assert b[1].xmin <= 0.1 <= b[1].xmax and b[1].ymin <= -0.1 <= b[1].ymax and b[2].xmax >= 123456.789 and b[2].xmin <= -3.3


def test_scratch_needs_a_shared_folder(spark):
    from rillflow.session import scratch_dir

    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(base)


def test_parts_of_lines(spark):
    line = points((0, 0), (3, 4), (3, 10))
    piece = lambda a, b: [(p.x, p.y) for p in one(spark, geometry.between(line, F.lit(a), F.lit(b))) or []]
    assert piece(2.5, 8.0) == [(1.5, 2.0), (3.0, 4.0), (3.0, 7.0)]
    assert piece(-5.0, 99.0) == [(0.0, 0.0), (3.0, 4.0), (3.0, 10.0)]
    assert piece(5.0, 6.0) == [(3.0, 4.0), (3.0, 5.0)] and piece(6.0, 6.0) == [] and piece(20.0, 30.0) == []
    box = [F.lit(float(v)) for v in (1.5, -1, 9, 6)]
    assert [(s.a.x, s.a.y, s.b.x, s.b.y) for s in one(spark, geometry.inside_box(line, *box))] == [(1.5, 2.0, 3.0, 4.0), (3.0, 4.0, 3.0, 6.0)]
    assert one(spark, geometry.inside_box(points((0, 0), (0, 5), (0, 5)), *box)) == []


def test_wkb_of_rings(spark):
    rings = F.array(points((0, 0), (4, 0), (4, 4), (0, 4)), points((1, 1), (2, 1), (2, 2), (1, 2), (1, 1)))
    back = one(spark, geometry.wkb_points(geometry.as_wkb(rings)))
    assert [[(p.x, p.y) for p in r] for r in back] == [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]
    assert one(spark, geometry.net_area(rings)) == 15


def test_rules_of_missing_tables_and_kinds(spark):
    from rillflow.operators import rules

    a = spark.createDataFrame([(1, "x", 5.0), (1, "x", None), (2, "y", 9.0), (None, "z", 1.0)], "visit long, k string, v double")
    b = spark.createDataFrame([(2, 1.0), (3, 2.0)], "visit long, w double")
    wanted = [rules.Rule("one", "a", "exactly", value=1), rules.Rule("k", "a", "unique", column="k"), rules.Rule("v", "a", "required", column="v", status="Warning"), rules.Rule("sum", "a", "no_more_than", column="v", value="b", other_column="w"), rules.Rule("has", "a", "has_rows_if", value="b")]
    out = {(r.visit, r.rule): (r.status, r.observed) for r in rules.evaluate({"a": a, "b": b}, wanted, "visit").collect()}
    assert out == {
        (1, "one"): ("Error", 2.0), (1, "k"): ("Error", 1.0), (1, "v"): ("Warning", 1.0), (1, "sum"): ("Error", 5.0), (1, "has"): ("Pass", 2.0),
        (2, "one"): ("Pass", 1.0), (2, "k"): ("Pass", 0.0), (2, "v"): ("Pass", 0.0), (2, "sum"): ("Error", 8.0), (2, "has"): ("Pass", 0.0),
        (3, "one"): ("Error", 0.0), (3, "k"): ("Pass", 0.0), (3, "v"): ("Pass", 0.0), (3, "sum"): ("Pass", -2.0), (3, "has"): ("Error", -1.0),
    }
    with pytest.raises(ValueError, match="no kind"):
        rules.evaluate({"a": a}, [rules.Rule("r", "a", "never")], "visit")
