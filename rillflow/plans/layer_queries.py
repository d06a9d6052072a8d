"""Queries of layers: copies, write-backs, locations, overlays, lines and boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import curves, geometry
from ..operators import filters, intervals, joins, layers
from ..session import written
from .registry import query


@query("lineitem", sql="""SELECT l_orderkey, l_linenumber, l_quantity AS length, l_discount + 0.0 AS x FROM lineitem
WHERE l_returnflag = 'R' AND nullif(l_quantity, 1) > 0 AND l_discount BETWEEN 0.02 AND 0.06 AND l_tax BETWEEN 0.01 AND 0.05""")
def copy_layer(lineitem: DataFrame) -> DataFrame:
    rows = lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", F.nullif("l_quantity", F.lit(1.0)).alias("length"), (F.col("l_discount") + 0.0).alias("x"), F.col("l_tax").alias("y"))
    return layers.copy_layer(rows, ["l_orderkey", "l_linenumber", "length", "x"], "l_returnflag = 'R'", measure="length", clip=(0.02, 0.01, 0.06, 0.05))


@query("orders", sql="SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def copy_matching_fields(orders: DataFrame) -> DataFrame:
    return filters.matching_fields(orders.filter("o_orderstatus = 'F'"), ["O_CUSTKEY", "not_there", "o_orderkey", "O_TotalPrice"]).toDF("o_custkey", "o_orderkey", "o_totalprice")


@query("customer", "supplier", sql="SELECT c_custkey, coalesce(s_acctbal, c_acctbal) AS balance, s_name AS name FROM (SELECT *, c_custkey % 200 AS k FROM customer) LEFT JOIN supplier ON k = s_suppkey")
def copy_attributes_by_key(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    target = customer.select("c_custkey", (F.col("c_custkey") % 200).alias("k"), F.col("c_acctbal").alias("balance"))
    source = supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return joins.copy_attributes(target, source, "k", ["balance", "name"]).select("c_custkey", "balance", "name")


@query("customer", "supplier", sql="SELECT c_custkey, s_acctbal AS balance FROM (SELECT *, c_custkey % 200 AS k FROM customer) LEFT JOIN supplier ON k = s_suppkey")
def write_back_null_first(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Values written back by key; what gets none is null, not what it was."""
    target = customer.select("c_custkey", (F.col("c_custkey") % 200).alias("k"), F.col("c_acctbal").alias("balance"))
    source = supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance"))
    return joins.copy_attributes(target, source, "k", ["balance"], null_first=True).select("c_custkey", "balance")


@query("lineitem", sql="SELECT l_returnflag, count(v) AS n, avg(v) AS mean, min(v) AS low FROM (SELECT l_returnflag, CASE WHEN l_quantity NOT IN (1, 50) THEN l_quantity END AS v FROM lineitem) GROUP BY 1")
def exclude_sentinels(lineitem: DataFrame) -> DataFrame:
    v = filters.sentinel_to_null(F.col("l_quantity"), 1.0, 50.0)
    return lineitem.withColumn("v", v).groupBy("l_returnflag").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.min("v").alias("low"))


@query("lineitem", sql="SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 25")
def remove_small_features(lineitem: DataFrame) -> DataFrame:
    return layers.without_small(lineitem.select("l_orderkey", "l_quantity"), "l_quantity", 25.0)


@query("part", sql="""WITH uses AS (SELECT * FROM (VALUES ('ECONOMY', 1.0), ('STANDARD', 0.66), ('PROMO', 0.33)) u(name, intensity))
SELECT p_partkey, name, coalesce(intensity, 0.0) AS intensity FROM part LEFT JOIN uses ON split_part(p_type, ' ', 1) = name""")
def join_on_label(part: DataFrame) -> DataFrame:
    uses = part.sparkSession.createDataFrame([("ECONOMY", 1.0), ("STANDARD", 0.66), ("PROMO", 0.33)], "name string, intensity double")
    labelled = part.select("p_partkey", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("name"))
    found = labelled.join(F.broadcast(uses.withColumnRenamed("name", "label")), F.col("name") == F.col("label"), "left")
    return found.select("p_partkey", F.col("label").alias("name"), F.coalesce("intensity", F.lit(0.0)).alias("intensity"))


# --- locations: suppliers own boxes, customers are points -------------------------------------------------------------

_PLACES = "SELECT c_custkey, (c_custkey * 37 % 3600) / 10.0 - 180 AS x, (c_custkey * 53 % 1800) / 10.0 - 90 AS y FROM customer"
_AREAS = "SELECT s_suppkey, s_suppkey * 71 % 3500 / 10.0 - 180 AS xmin, s_suppkey * 29 % 1700 / 10.0 - 90 AS ymin, s_suppkey * 71 % 3500 / 10.0 - 168 AS xmax, s_suppkey * 29 % 1700 / 10.0 - 81 AS ymax FROM supplier"


def places(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select("c_custkey", (k * 37 % 3600 / 10.0 - 180).alias("x"), (k * 53 % 1800 / 10.0 - 90).alias("y"))


def areas(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    x, y = k * 71 % 3500 / 10.0, k * 29 % 1700 / 10.0
    return supplier.select("s_suppkey", (x - 180).alias("xmin"), (y - 90).alias("ymin"), (x - 168).alias("xmax"), (y - 81).alias("ymax"))


@query("customer", "supplier", sql=f"SELECT c_custkey, x, y FROM ({_PLACES}) p WHERE EXISTS (SELECT 1 FROM ({_AREAS}) a WHERE x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax)")
def select_by_location(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    return layers.select_by_location(places(customer), areas(supplier), "c_custkey", 10.0)


@query("customer", "supplier", sql=f"SELECT c_custkey, x, y FROM ({_PLACES}) p WHERE NOT EXISTS (SELECT 1 FROM ({_AREAS}) a WHERE x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax)")
def select_outside_location(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    return layers.select_by_location(places(customer), areas(supplier), "c_custkey", 10.0, outside=True)


@query("customer", "supplier", sql=f"SELECT s_suppkey, count(c_custkey) AS n FROM ({_AREAS}) a LEFT JOIN ({_PLACES}) p ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax GROUP BY s_suppkey")
def count_points_in_polygons(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    a, box = areas(supplier), list(joins.SIDES)
    # each place counts for as many points as it has, and equal areas are counted once
    at = written(places(customer).groupBy("x", "y").agg(F.count(F.lit(1)).alias("_points")))
    rings = joins.distinct_values(a, box).select(*(F.col(c).alias(f"a_{c}") for c in box), F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax")).alias("ring"))
    n = joins.points_in_polygons(at, rings, 10.0).groupBy(*(F.col(f"a_{c}").alias(c) for c in box)).agg(F.sum("_points").alias("n"))
    return a.join(n, box, "left").groupBy("s_suppkey").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))


_NEAREST = f"""WITH p AS ({_PLACES}), t AS (SELECT s_suppkey, xmin AS tx, ymin AS ty, s_acctbal FROM ({_AREAS}) JOIN supplier USING (s_suppkey)),
d AS (SELECT c_custkey, s_suppkey, s_acctbal, sqrt((x - tx) ^ 2 + (y - ty) ^ 2) AS distance, row_number() OVER (PARTITION BY c_custkey ORDER BY sqrt((x - tx) ^ 2 + (y - ty) ^ 2), s_suppkey) AS k FROM p JOIN t ON abs(x - tx) <= 8 AND abs(y - ty) <= 8)"""


@query("customer", "supplier", sql=f"{_NEAREST} SELECT p.c_custkey, d.s_suppkey AS nearest, d.distance FROM p LEFT JOIN d ON p.c_custkey = d.c_custkey AND k = 1 AND distance <= 8")
def nearest_feature(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    targets = areas(supplier).select("s_suppkey", F.col("xmin").alias("x"), F.col("ymin").alias("y"))
    return joins.nearest_point(places(customer), targets, "c_custkey", 8.0).select("c_custkey", F.col("near_s_suppkey").alias("nearest"), "distance")


@query("customer", "supplier", sql=f"""{_NEAREST}, long AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY k) AS first FROM d WHERE distance <= 8 AND s_acctbal >= 100)
SELECT p.c_custkey, l.s_suppkey AS nearest FROM p LEFT JOIN long l ON p.c_custkey = l.c_custkey AND first = 1""")
def nearest_long_enough(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Of the features within reach the nearest that is long enough."""
    targets = areas(supplier).join(supplier.filter("s_acctbal >= 100").select("s_suppkey"), "s_suppkey").select("s_suppkey", F.col("xmin").alias("x"), F.col("ymin").alias("y"))
    return joins.nearest_point(places(customer), targets, "c_custkey", 8.0).select("c_custkey", F.col("near_s_suppkey").alias("nearest"))


@query("customer", "supplier", sql=f"""WITH p AS ({_PLACES}), lines AS (SELECT c_custkey, x + 3.03 AS mx, y + 4.04 AS my FROM p)
SELECT c_custkey, min(s_suppkey) AS agency FROM lines LEFT JOIN ({_AREAS}) a ON mx BETWEEN xmin AND xmax AND my BETWEEN ymin AND ymax GROUP BY c_custkey""")
def owner_at_midpoint(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """The agency whose land holds the middle of a reach; of several the first."""
    p = places(customer)
    at = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    line = p.select("c_custkey", F.array(at(0, 0), at(3.03, 4.04), at(6.06, 8.08)).alias("line"))
    middle = line.select("c_custkey", geometry.point_at(F.col("line"), geometry.length(F.col("line")) / 2).alias("m")).select("c_custkey", "m.x", "m.y")
    owner = joins.points_in_boxes(middle.select("c_custkey", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")), areas(supplier), 10.0).groupBy("c_custkey").agg(F.min("s_suppkey").alias("agency"))
    return p.select("c_custkey").join(owner, "c_custkey", "left")


_PAIRS = f"""WITH a AS ({_AREAS}), pairs AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b, least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin) AS w, least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin) AS h FROM a JOIN a b ON a.s_suppkey < b.s_suppkey)"""


@query("supplier", sql=f"{_PAIRS} SELECT a, b, round(w * h, 6) AS area FROM pairs WHERE w > 0 AND h > 0")
def intersect_overlay(supplier: DataFrame) -> DataFrame:
    a = areas(supplier)
    met = layers.boxes_overlap(a, a, 12.0).filter("left_s_suppkey < right_s_suppkey")
    return met.select(F.col("left_s_suppkey").alias("a"), F.col("right_s_suppkey").alias("b"), F.round("area", 6).alias("area"))


@query("supplier", "customer", sql=f"""WITH a AS ({_AREAS}), l AS (SELECT c_custkey, x AS x0, x + 20 AS x1, y FROM ({_PLACES})), m AS (SELECT c_custkey, s_suppkey, least(x1, xmax) - greatest(x0, xmin) AS len FROM l JOIN a ON y BETWEEN ymin AND ymax)
SELECT c_custkey, s_suppkey, round(len, 6) AS length FROM m WHERE len > 0""")
def intersect_with_measure(supplier: DataFrame, customer: DataFrame) -> DataFrame:
    """The length of each line within each area; lines from one place are computed with once, and so are equal areas."""
    p, a = places(customer), areas(supplier)
    end = lambda dx: F.struct((F.col("x") + dx).alias("x"), F.col("y").alias("y"))
    lines = joins.distinct_values(p, ["x", "y"]).select("x", "y", F.array(end(0), end(5), end(20)).alias("line"))
    box = list(joins.SIDES)
    found = layers.lines_in_boxes(lines, joins.distinct_values(a, box), ["x", "y"], box, "line", 3.0).withColumn("length", F.round("length", 6))
    return joins.for_rows(joins.for_rows(found, a, box), p, ["x", "y"]).select("c_custkey", "s_suppkey", "length")


# --- intervals along streams -----------------------------------------------------------------------------------------

_SPANS = "SELECT l_suppkey AS path, datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) * 1.0 AS a, datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) + l_quantity AS b, l_returnflag AS kind FROM lineitem"


#: Streams are cut every so many days.
STRETCH = 256.0


def spans(lineitem: DataFrame) -> DataFrame:
    day = F.datediff("l_shipdate", F.lit("1992-01-01")).cast("double")
    return lineitem.select(F.col("l_suppkey").alias("path"), day.alias("a"), (day + F.col("l_quantity")).alias("b"), F.col("l_returnflag").alias("kind"))


_DISSOLVED = """m AS (SELECT path, kind, a, b, max(b) OVER (PARTITION BY path, kind ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM s),
g AS (SELECT path, kind, a, b, sum(CASE WHEN reached IS NULL OR a > reached THEN 1 ELSE 0 END) OVER (PARTITION BY path, kind ORDER BY a, b) AS island FROM m),
u AS (SELECT path, kind, min(a) AS a, max(b) AS b FROM g GROUP BY path, kind, island)"""


@query("lineitem", sql=f"WITH s AS ({_SPANS}), {_DISSOLVED} SELECT path, kind, a, b FROM u")
def dissolve_by_field(lineitem: DataFrame) -> DataFrame:
    return intervals.dissolve(spans(lineitem), ["path", "kind"], "a", "b", STRETCH)


@query("lineitem", sql=f"""WITH s AS (SELECT path, 'all' AS kind, a, b FROM ({_SPANS})), {_DISSOLVED} SELECT path, count(*) AS n_pieces, sum(b - a) AS covered, min(a) AS first, max(b) AS last FROM u GROUP BY path""")
def channel_area_union(lineitem: DataFrame) -> DataFrame:
    """What overlapping channel pieces cover together: overlaps count once."""
    u = intervals.dissolve(spans(lineitem), ["path"], "a", "b", STRETCH)
    return u.groupBy("path").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum(F.col("b") - F.col("a")).alias("covered"), F.min("a").alias("first"), F.max("b").alias("last"))


#: Ends of spans with +1 and -1, summed up along the path: what covers each piece, over all rows.
_PIECES = """e AS (SELECT path, a AS x, 1 AS d, kind FROM s UNION ALL SELECT path, b, -1, kind FROM s),
p AS (SELECT path, x AS a, sum(d) AS n, sum(d) FILTER (WHERE kind = 'R') AS r, sum(d) FILTER (WHERE kind = 'N') AS k FROM e GROUP BY path, x),
k AS (SELECT path, a, lead(a) OVER w AS b, sum(n) OVER w > 0 AS covered, coalesce(sum(r) OVER w, 0) > 0 AS has_r, coalesce(sum(k) OVER w, 0) > 0 AS has_n FROM p WINDOW w AS (PARTITION BY path ORDER BY a))"""


@query("lineitem", sql=f"WITH s AS ({_SPANS}), {_PIECES} SELECT path, a, b, has_r, has_n FROM k WHERE covered AND b IS NOT NULL")
def split_by_overlay(lineitem: DataFrame) -> DataFrame:
    """Streams cut at every end of every span, with the kinds of span that cover each piece."""
    return intervals.split(spans(lineitem), ["path"], "a", "b", {"has_r": F.col("kind") == "R", "has_n": F.col("kind") == "N"}, STRETCH).select("path", "a", "b", "has_r", "has_n")


@query("lineitem", sql=f"WITH s AS ({_SPANS}), {_PIECES} SELECT path, sum(b - a) AS length FROM k WHERE has_n AND NOT has_r GROUP BY path")
def difference_overlay(lineitem: DataFrame) -> DataFrame:
    """How much of a stream one kind of span covers and another doesn't."""
    k = intervals.split(spans(lineitem), ["path"], "a", "b", {"has_r": F.col("kind") == "R", "has_n": F.col("kind") == "N"}, STRETCH)
    return k.filter("has_n and not has_r").groupBy("path").agg(F.sum(F.col("b") - F.col("a")).alias("length"))


@query("lineitem", sql=f"""WITH s AS ({_SPANS} WHERE l_returnflag <> 'A'), {_PIECES}
SELECT path, sum(b - a) AS length, least(sum((b - a) * (has_r::INT + has_n::INT)) / sum(b - a), 1.0) AS ratio, sum(CASE WHEN has_r AND has_n THEN b - a ELSE 0 END) / sum(b - a) AS constriction FROM k WHERE covered AND b IS NOT NULL GROUP BY path""")
def confinement_per_flowline(lineitem: DataFrame) -> DataFrame:
    """A flowline is cut at the ends of its confined stretches; pieces confined on both sides count twice in the ratio."""
    k = intervals.split(spans(lineitem.filter("l_returnflag <> 'A'")), ["path"], "a", "b", {"on_left": F.col("kind") == "R", "on_right": F.col("kind") == "N"}, STRETCH)
    return intervals.confinement(k, ["path"], "on_left", "on_right")


# --- lines -----------------------------------------------------------------------------------------------------------

_LINE = "SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_discount * 100 + 0.0 AS y1, l_quantity + l_tax * 100 + 3 AS x2, l_discount * 100 - 4 AS y2 FROM lineitem"


def lines(lineitem: DataFrame) -> DataFrame:
    """Three points: the origin of a row and two derived ones."""
    x, y = F.col("l_quantity"), F.col("l_discount") * 100 + 0.0
    p = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    return lineitem.select("l_orderkey", "l_linenumber", F.array(p(F.lit(0), F.lit(0)), p(x, y), p(x + F.col("l_tax") * 100 + 3, F.col("l_discount") * 100 - 4)).alias("line"))


@query("lineitem", sql=f"""SELECT l_orderkey, l_linenumber, round(sqrt(x1 ^ 2 + y1 ^ 2) + sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2), 6) AS length, round(sqrt(x2 ^ 2 + y2 ^ 2), 6) AS straight,
round((sqrt(x1 ^ 2 + y1 ^ 2) + sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2)) / nullif(sqrt(x2 ^ 2 + y2 ^ 2), 0), 6) AS sinuosity, round((degrees(atan2(x2, y2)) + 360) % 360, 6) AS azimuth, round(abs(x1 * y2 - x2 * y1) / 2, 6) AS area, 3 AS n_points,
least(0, x1, x2) AS xmin, greatest(0, y1, y2) AS ymax FROM ({_LINE})""")
def line_measures(lineitem: DataFrame) -> DataFrame:
    line = F.col("line")
    r = lambda c: F.round(c, 6)
    return lines(lineitem).select(
        "l_orderkey", "l_linenumber", r(geometry.length(line)).alias("length"), r(geometry.straight_length(line)).alias("straight"), r(geometry.sinuosity(line)).alias("sinuosity"),
        r(geometry.azimuth(line)).alias("azimuth"), r(geometry.area(line)).alias("area"), F.size(line).alias("n_points"), geometry.box(line)["xmin"].alias("xmin"), geometry.box(line)["ymax"].alias("ymax"),
    )


@query("lineitem", sql=f"SELECT l_orderkey, l_linenumber, round(x2, 0) AS x, round(y2, 0) AS y FROM ({_LINE})")
def reduce_precision(lineitem: DataFrame) -> DataFrame:
    last = F.element_at(geometry.rounded(F.col("line"), 0), -1)
    return lines(lineitem).select("l_orderkey", "l_linenumber", last["x"].alias("x"), last["y"].alias("y"))


@query("orders", sql="""WITH r AS (SELECT o_orderkey, o_totalprice AS total FROM orders), n AS (SELECT *, greatest(1, CAST(floor(total / 50000) AS BIGINT) + CASE WHEN total - floor(total / 50000) * 50000 >= 10000 THEN 1 ELSE 0 END) AS n FROM r)
SELECT o_orderkey, (i - 1) * 50000.0 AS "from", CASE WHEN i = n THEN total ELSE i * 50000.0 END AS "to" FROM n, LATERAL (SELECT unnest(range(1, n + 1)) AS i)""")
def chop_lines(orders: DataFrame) -> DataFrame:
    """Lines cut at an interval; a short rest stays with the last piece."""
    return orders.select("o_orderkey", F.explode(geometry.pieces(F.col("o_totalprice"), 50000.0, 10000.0)).alias("p")).select("o_orderkey", "p.from", "p.to")


@query("orders", sql="SELECT o_orderkey, i * 60000.0 AS at, round(i * 60000.0 * 0.6, 4) AS x, round(i * 60000.0 * 0.8, 4) AS y FROM orders, LATERAL (SELECT unnest(range(0, CAST(floor(round(o_totalprice, 2) / 60000) AS BIGINT) + 1)) AS i)")
def points_along_lines(orders: DataFrame) -> DataFrame:
    """A point every 60 km along a straight line."""
    total = F.round("o_totalprice", 2)
    line = F.array(geometry.point(F.lit(0), F.lit(0)), geometry.point(total * 0.6, total * 0.8))
    along = orders.select("o_orderkey", F.explode(geometry.points_along(line, 60000.0)).alias("p"))
    return along.select("o_orderkey", F.col("p.at").alias("at"), F.round("p.p.x", 4).alias("x"), F.round("p.p.y", 4).alias("y"))


_KNOTS = ((0.0, 0.0), (10.0, 1.0), (30.0, 0.4), (45.0, 0.1))


def _knots_sql(kind: str) -> str:
    out = []
    for (x0, y0), (x1, y1) in zip(_KNOTS, _KNOTS[1:]):
        piece = {"linear": f"{y0} + (q - {x0}) * ({y1} - {y0}) / ({x1} - {x0})", "previous": f"CASE WHEN q = {x1} THEN {y1} ELSE {y0} END", "next": f"CASE WHEN q = {x0} THEN {y0} ELSE {y1} END", "nearest": f"CASE WHEN q <= {(x0 + x1) / 2} THEN {y0} ELSE {y1} END"}[kind]
        out.append(f"WHEN q BETWEEN {x0} AND {x1} THEN {piece}")
    return f"CASE {' '.join(out)} ELSE 0.0 END"


@query("lineitem", sql="WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity AS q FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(f"round({_knots_sql(k)}, 9) AS {k}" for k in ("linear", "previous", "next", "nearest")) + " FROM r")
def transform_curves(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", *(F.round(curves.curve(k, F.col("l_quantity"), list(_KNOTS)), 9).alias(k) for k in ("linear", "previous", "next", "nearest")))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 25 THEN 1 ELSE 2 END AS zone FROM lineitem")
def zone_by_upper_bound(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", curves.zone(F.col("l_quantity"), [10.0, 25.0, None]).alias("zone"))


@query("customer", sql=f"""SELECT CAST(floor(x / 30) AS BIGINT) AS tile, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, count(*) AS n FROM ({_PLACES}) GROUP BY 1""")
def extent_by_group(customer: DataFrame) -> DataFrame:
    return places(customer).groupBy(F.floor(F.col("x") / 30).alias("tile")).agg(F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"), F.count(F.lit(1)).alias("n"))


def _rank(c: Column) -> Column:
    return F.md5(c.cast("string").cast("binary"))


@query("customer", sql=f"""WITH p AS (SELECT *, CAST(floor((x + 180) / 72) AS BIGINT) AS cx, CAST(floor((y + 90) / 36) AS BIGINT) AS cy FROM ({_PLACES})), cells AS (SELECT cx, cy, count(*) AS n FROM p GROUP BY 1, 2),
ok AS (SELECT cx, cy FROM cells WHERE n >= 0.5 * (SELECT avg(n) FROM cells)), r AS (SELECT p.*, row_number() OVER (PARTITION BY cx, cy ORDER BY md5(CAST(c_custkey AS VARCHAR))) AS k FROM p JOIN ok USING (cx, cy))
SELECT c_custkey, cx, cy FROM r WHERE k <= 4""")
def stratified_spatial_sample(customer: DataFrame) -> DataFrame:
    """Four reaches from each cell of a grid of 5 x 5; cells with under half the mean number give none."""
    return layers.stratified_sample(places(customer), "c_custkey", (-180.0, -90.0, 180.0, 90.0), 5, 4).select("c_custkey", "cx", "cy")


@query("customer", sql="""SELECT c_custkey, lower(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)) AS uuid
FROM (SELECT c_custkey, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(c_name)) AS h FROM customer)""")
def deterministic_uuid(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", layers.uuid5(F.col("c_name")).alias("uuid"))


# --- cuts and formats ---------------------------------------------------------------------------------------------------


@query("lineitem", sql=f"""WITH l AS (SELECT *, sqrt(x1 ^ 2 + y1 ^ 2) AS a, sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2) AS b FROM ({_LINE})), c AS (SELECT *, a + b AS total, 0.3 * (a + b) AS m0, 0.9 * (a + b) AS m1 FROM l),
p AS (SELECT l_orderkey, l_linenumber, m0 < a AND a < m1 AS bent, CASE WHEN m0 <= a THEN x1 * m0 / a ELSE x1 + (x2 - x1) * (m0 - a) / b END AS fx, CASE WHEN m0 <= a THEN y1 * m0 / a ELSE y1 + (y2 - y1) * (m0 - a) / b END AS fy,
CASE WHEN m1 <= a THEN x1 * m1 / a ELSE x1 + (x2 - x1) * (m1 - a) / b END AS tx, CASE WHEN m1 <= a THEN y1 * m1 / a ELSE y1 + (y2 - y1) * (m1 - a) / b END AS ty, x1, y1 FROM c)
SELECT l_orderkey, l_linenumber, CASE WHEN bent THEN 3 ELSE 2 END AS n_points, round(fx, 6) AS fx, round(fy, 6) AS fy, round(tx, 6) AS tx, round(ty, 6) AS ty, CASE WHEN bent THEN round(x1, 6) END AS bx FROM p""")
def cut_lines(lineitem: DataFrame) -> DataFrame:
    """The piece of each line between three and nine tenths of its length, with its vertices."""
    line = F.col("line")
    piece = lines(lineitem).select("l_orderkey", "l_linenumber", geometry.between(line, geometry.length(line) * 0.3, geometry.length(line) * 0.9).alias("p"))
    at = lambda k, c: F.round(F.element_at("p", k)[c], 6)
    return piece.select("l_orderkey", "l_linenumber", F.size("p").alias("n_points"), at(1, "x").alias("fx"), at(1, "y").alias("fy"), at(-1, "x").alias("tx"), at(-1, "y").alias("ty"), F.when(F.size("p") == 3, at(2, "x")).alias("bx"))


@query("lineitem", sql=f"""WITH l AS MATERIALIZED (SELECT row_number() OVER () AS line, * FROM ({_LINE})), s AS (SELECT line, l_orderkey, l_linenumber, 0.0 AS px, 0.0 AS py, x1 AS qx, y1 AS qy FROM l UNION ALL SELECT line, l_orderkey, l_linenumber, x1, y1, x2, y2 FROM l),
t AS (SELECT *, greatest(0, least((5 - px) / (qx - px), (30 - px) / (qx - px)), CASE WHEN qy = py THEN 0 ELSE least((1 - py) / (qy - py), (6 - py) / (qy - py)) END) AS t0,
least(1, greatest((5 - px) / (qx - px), (30 - px) / (qx - px)), CASE WHEN qy = py THEN CASE WHEN py BETWEEN 1 AND 6 THEN 1 ELSE -1 END ELSE greatest((1 - py) / (qy - py), (6 - py) / (qy - py)) END) AS t1 FROM s)
SELECT l_orderkey, l_linenumber, count(*) AS n_parts, round(sum((t1 - t0) * sqrt((qx - px) ^ 2 + (qy - py) ^ 2)), 6) AS length, round(min(px + t0 * (qx - px)), 6) AS x FROM t WHERE t0 < t1 GROUP BY line, l_orderkey, l_linenumber""")
def clip_lines_to_box(lineitem: DataFrame) -> DataFrame:
    """What of each line lies in the box from (5, 1) to (30, 6)."""
    box = (F.lit(float(v)) for v in (5, 1, 30, 6))
    parts = lines(lineitem).select("l_orderkey", "l_linenumber", geometry.inside_box(F.col("line"), *box).alias("p")).filter(F.size("p") > 0)
    total = F.aggregate("p", F.lit(0.0), lambda s, e: s + geometry.distance(e["a"], e["b"]))
    return parts.select("l_orderkey", "l_linenumber", F.size("p").cast("long").alias("n_parts"), F.round(total, 6).alias("length"), F.round(F.element_at("p", 1)["a"]["x"], 6).alias("x"))


@query("supplier", sql=f"""SELECT s_suppkey, 1 + (s_suppkey % 3 > 0)::INT AS n_rings, 5 + 5 * (s_suppkey % 3 > 0)::INT AS n_vertices, 12 * 9 - CASE WHEN s_suppkey % 3 > 0 THEN 2 * (s_suppkey % 3) ELSE 0 END - 0.25 AS area, 12 * 9 - CASE WHEN s_suppkey % 3 = 2 THEN 4.0 ELSE 0 END AS filled, round(xmin, 6) AS xmin FROM ({_AREAS})""")
def wkb_polygons(supplier: DataFrame) -> DataFrame:
    """Polygons with up to two holes written as WKB and read again: rings, vertices, area, and the area once small holes are
    filled; the smallest hole is gone before the rings are counted."""
    a = areas(supplier).select("s_suppkey", *(F.col(c).cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))
    k = (F.col("s_suppkey") % 3).cast("double")
    ring = lambda x0, y0, x1, y1: F.array(*(geometry.point(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))))
    x, y = F.col("xmin"), F.col("ymin")
    outer = ring(x, y, F.col("xmax"), F.col("ymax"))
    rings = F.concat(F.array(outer), F.when(k > 0, F.array(ring(x + 1, y + 1, x + 1 + k, y + 3))).otherwise(F.array().cast(f"array<{geometry.POINTS}>")), F.array(ring(x + 6, y + 6, x + 6.5, y + 6.5)))
    read = a.select("s_suppkey", geometry.wkb_points(geometry.as_wkb(rings)).alias("r"))
    whole = geometry.without_small_holes(F.col("r"), 0.5)
    return read.select(
        "s_suppkey", F.size(whole).alias("n_rings"), F.aggregate(whole, F.lit(0), lambda s, r: s + F.size(r)).alias("n_vertices"), F.round(geometry.net_area(F.col("r")), 6).alias("area"),
        F.round(geometry.net_area(geometry.without_small_holes(F.col("r"), 3.0)), 6).alias("filled"), F.round(geometry.box(F.element_at("r", 1))["xmin"], 6).alias("xmin"),
    )
