"""Queries of the model stages: capacity, confinement, riparian condition, metrics of segments and their rollups.

Segments come from ``lineitem``: the supplier is the stream, the day the distance, the quantity the length of the centerline
in feet and the price the area in square feet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, formulas
from ..operators import aggregates, filters, joins, windows
from ..operators.aggregates import ratio
from .registry import query

#: Clarke's foot in metres, and its square.
FOOT, FOOT_2 = 0.3047972654, 0.3047972654**2
_DAY = "datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE))"
_DGO = f"SELECT l_suppkey AS path, {_DAY} AS distance, sum(l_quantity) * {FOOT!r} AS length, sum(l_extendedprice) * {FOOT_2!r} AS area, sum(l_quantity * l_discount) * {FOOT_2!r} AS riparian, max(l_tax * 100 + 0.0) AS high, min(l_tax * 100 + 0.0) AS low, max(l_discount * 10 + 0.0) AS lui FROM lineitem GROUP BY 1, 2"


def dgos(lineitem: DataFrame) -> DataFrame:
    day = F.datediff("l_shipdate", F.lit("1992-01-01"))
    rows = lineitem.select(F.col("l_suppkey").alias("path"), day.alias("distance"), "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return rows.groupBy("path", "distance").agg(
        (F.sum("l_quantity") * FOOT).alias("length"), (F.sum("l_extendedprice") * FOOT_2).alias("area"), (F.sum(F.col("l_quantity") * F.col("l_discount")) * FOOT_2).alias("riparian"),
        F.max(F.col("l_tax") * 100 + 0.0).alias("high"), F.min(F.col("l_tax") * 100 + 0.0).alias("low"), F.max(F.col("l_discount") * 10 + 0.0).alias("lui"),
    )


# --- rollups and their denominators -----------------------------------------------------------------------------------


@query("orders", sql="""WITH classes AS (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', '9-NEVER']) AS class)
SELECT class, coalesce(sum(o_totalprice), 0.0) AS total, count(o_orderkey) AS n FROM classes LEFT JOIN orders ON class = o_orderpriority GROUP BY class""")
def rollup_zero_filled(orders: DataFrame) -> DataFrame:
    classes = orders.sparkSession.createDataFrame([(c,) for c in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "9-NEVER")], "class string")
    return aggregates.zero_filled(orders, classes, "o_orderpriority", "class", {"total": F.sum("o_totalprice"), "n": F.count(F.lit(1))}, {"total": 0.0, "n": 0})


@query("orders", sql="""WITH limits AS (SELECT unnest(['F', 'O', 'P', 'X']) AS status) SELECT status, coalesce(n, 0) AS n FROM limits LEFT JOIN (SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') GROUP BY 1) t ON status = o_orderstatus""")
def limitation_tally(orders: DataFrame) -> DataFrame:
    """Reaches per limitation with zeros for the limitations without any; some kinds of reach don't count."""
    lookup = orders.sparkSession.createDataFrame([("F",), ("O",), ("P",), ("X",)], "status string")
    return aggregates.zero_filled(orders.filter(~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")), lookup, "o_orderstatus", "status", {"n": F.count(F.lit(1))}, {"n": 0})


@query("lineitem", sql="SELECT l_suppkey, greatest(0.0, sum(l_tax * l_quantity) - sum(l_discount * l_quantity)) AS potential FROM lineitem GROUP BY 1")
def recovery_potential(lineitem: DataFrame) -> DataFrame:
    q = F.col("l_quantity")
    return lineitem.groupBy("l_suppkey").agg(F.greatest(F.lit(0.0), F.sum(F.col("l_tax") * q) - F.sum(F.col("l_discount") * q)).alias("potential"))


@query("lineitem", sql="""SELECT l_suppkey, sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0) AS mean, min_by(l_returnflag, (-l_quantity, l_returnflag)) AS longest
FROM lineitem GROUP BY l_suppkey""")
def line_attributes_to_zone(lineitem: DataFrame) -> DataFrame:
    """Lines' attributes for the zone they are in: the mean weighed by length, and that of the longest line."""
    return lineitem.groupBy("l_suppkey").agg(aggregates.weighted_mean(F.col("l_discount"), F.col("l_quantity")).alias("mean"), F.min_by("l_returnflag", F.struct(-F.col("l_quantity"), F.col("l_returnflag"))).alias("longest"))


@query("lineitem", sql="""SELECT l_suppkey, sum(l_extendedprice) / nullif(sum(l_quantity), 0) AS per_metre, (sum(l_extendedprice) * 0.000247105) / nullif(sum(l_quantity) / 1609.34, 0) AS acres_per_mile,
(sum(l_extendedprice) / 10000.0) / nullif(sum(l_quantity) / 1000.0, 0) AS hectares_per_km FROM lineitem GROUP BY 1""")
def density_with_units(lineitem: DataFrame) -> DataFrame:
    area, length = F.sum("l_extendedprice"), F.sum("l_quantity")
    return lineitem.groupBy("l_suppkey").agg(ratio(area, length).alias("per_metre"), windows.acres_per_mile(area, length).alias("acres_per_mile"), windows.hectares_per_km(area, length).alias("hectares_per_km"))


_CAPACITY = "CASE WHEN q = 0 THEN 'none' WHEN q <= 10 THEN 'rare' WHEN q <= 25 THEN 'occasional' WHEN q <= 40 THEN 'frequent' ELSE 'pervasive' END"


def _capacity_class(q: Column) -> Column:
    return filters.ladder(q, [0.0, 10.0, 25.0, 40.0], ["none", "rare", "occasional", "frequent"], above="pervasive")


@query("lineitem", sql=f"""WITH r AS (SELECT {_CAPACITY} AS class, l_extendedprice AS length, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS dams FROM (SELECT *, l_quantity AS q FROM lineitem)),
c AS (SELECT class, sum(length) AS length, CAST(sum(dams) AS BIGINT) AS dams FROM r GROUP BY class), t AS (SELECT sum(length) AS all_length, sum(dams) AS all_dams FROM c)
SELECT class, length, dams, 100 * length / all_length AS pct_length, 100.0 * dams / all_dams AS pct_dams, (dams / all_dams) / (length / all_length) AS electivity FROM c, t""")
def electivity_index(lineitem: DataFrame) -> DataFrame:
    rows = lineitem.select(_capacity_class(F.col("l_quantity")).alias("class"), F.col("l_extendedprice").alias("length"), (F.col("l_returnflag") == "R").cast("int").alias("dams"))
    return aggregates.electivity(rows, "class", "length", "dams")


@query("lineitem", sql="""WITH m AS (SELECT l_linestatus AS owner, unnest(['quantity', 'discount', 'tax']) AS metric, unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem),
a AS (SELECT metric, avg(v) AS mean, min(v) AS low, max(v) AS high, count(v) AS n FROM m GROUP BY metric), o AS (SELECT metric, avg(v) AS owner_mean, count(v) AS owner_n FROM m WHERE owner = 'O' GROUP BY metric)
SELECT metric, mean, low, high, n, owner_mean, owner_n FROM a LEFT JOIN o USING (metric)""")
def global_metric_stats(lineitem: DataFrame) -> DataFrame:
    """Statistics of every metric over all segments and over one owner's, in one pass instead of a join with itself."""
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(f"l_{n}").alias("v")) for n in ("quantity", "discount", "tax")))).alias("m")
    rows = lineitem.select(F.col("l_linestatus").alias("owner"), pairs).select("owner", "m.metric", "m.v")
    own = F.when(F.col("owner") == "O", F.col("v"))
    return rows.groupBy("metric").agg(F.avg("v").alias("mean"), F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"), F.avg(own).alias("owner_mean"), F.count(own).alias("owner_n"))


@query("part", sql="""WITH classes AS (SELECT p_brand AS site, p_size - 5 AS low, p_size AS high, count(*) AS n FROM part GROUP BY 1, 2, 3),
c AS (SELECT *, 100.0 * sum(n) OVER (PARTITION BY site ORDER BY high) / sum(n) OVER (PARTITION BY site) AS upto FROM classes), d AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY site ORDER BY high), 0) AS below FROM c),
v AS (SELECT *, CASE WHEN low > 0 THEN exp(ln(low) + (p - below) / (upto - below) * (ln(high) - ln(low))) ELSE (p - below) / (upto - below) * high END AS value FROM d, (VALUES (16), (50), (84)) t(p) WHERE below < p AND upto >= p)
SELECT site, max(CASE WHEN p = 16 THEN value END) AS d16, max(CASE WHEN p = 50 THEN value END) AS d50, max(CASE WHEN p = 84 THEN value END) AS d84 FROM v GROUP BY site""")
def pebble_percentiles_log(part: DataFrame) -> DataFrame:
    classes = part.groupBy(F.col("p_brand").alias("site"), (F.col("p_size") - 5).alias("low"), F.col("p_size").alias("high")).agg(F.count(F.lit(1)).alias("n"))
    return aggregates.percentile_log(classes, ["site"], "low", "high", "n", [16, 50, 84])


@query("lineitem", sql="""SELECT CASE WHEN q = 0 THEN '0' WHEN q <= 1 THEN '0-1' WHEN q <= 5 THEN '1-5' WHEN q <= 15 THEN '5-15' ELSE '15-40' END AS bin, sum(l_extendedprice) AS length, count(*) AS n FROM (SELECT *, l_quantity - 1 AS q FROM lineitem) WHERE q <= 40 GROUP BY 1""")
def capacity_length_bins(lineitem: DataFrame) -> DataFrame:
    label = filters.ladder(F.col("l_quantity") - 1, [0, 1, 5, 15, 40], ["0", "0-1", "1-5", "5-15", "15-40"])
    return aggregates.binned_sum(lineitem.withColumnRenamed("l_extendedprice", "length"), [], label, "length")


@query("lineitem", sql="""SELECT CASE WHEN r < 0.1 THEN '0-10' WHEN r < 0.5 THEN '10-50' WHEN r < 0.85 THEN '50-85' ELSE '85-100' END AS bin, sum(l_quantity) AS length, count(*) AS n FROM (SELECT *, l_quantity / 50 AS r FROM lineitem) WHERE r < 1 GROUP BY 1""")
def confinement_histogram(lineitem: DataFrame) -> DataFrame:
    """An edge belongs to the class above it, so what is confined all along is in none, as published."""
    label = filters.ladder(F.col("l_quantity") / 50, [0.1, 0.5, 0.85, 1.0], ["0-10", "10-50", "50-85", "85-100"], closed="left")
    return aggregates.binned_sum(lineitem.withColumn("length", F.col("l_quantity")), [], label, "length")


@query("orders", sql="""WITH n AS (SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'P') AS p, count(*) FILTER (WHERE o_orderstatus = 'X') AS x FROM orders)
SELECT 'F' AS test, CASE WHEN f < 1 THEN 'Error' WHEN f < 10 THEN 'Warning' ELSE 'Pass' END AS status, 'F: ' || f || ' rows' AS message FROM n UNION ALL
SELECT 'P', CASE WHEN p < 1 THEN 'Error' WHEN p < 100000000 THEN 'Warning' ELSE 'Pass' END, 'P: ' || p || ' rows' FROM n UNION ALL SELECT 'X', CASE WHEN x < 1 THEN 'Error' WHEN x < 2 THEN 'Warning' ELSE 'Pass' END, 'X: ' || x || ' rows' FROM n""")
def count_threshold_tests(orders: DataFrame) -> DataFrame:
    from .quality import threshold_tests

    return threshold_tests(orders, "o_orderstatus", {"F": (1, 10), "P": (1, 100_000_000), "X": (1, 2)})


# --- windows ----------------------------------------------------------------------------------------------------------

_IGO = f"SELECT path, distance, length AS own FROM ({_DGO}) WHERE distance % 5 = 0"
_WINDOW = f"""WITH d AS ({_DGO}), i AS ({_IGO}), w AS (SELECT i.path, i.distance, sum(d.length) AS length, sum(d.area) AS area, sum(d.riparian) AS riparian, max(d.high) AS high, min(d.low) AS low,
sum(d.lui * d.area) / nullif(sum(d.area), 0) AS lui, sum(CASE WHEN d.lui <> 0 THEN d.lui * d.area END) / nullif(sum(CASE WHEN d.lui <> 0 THEN d.area END), 0) AS condition FROM i JOIN d ON d.path = i.path AND d.distance BETWEEN i.distance - 50 AND i.distance + 50 GROUP BY 1, 2)"""


def _windowed(lineitem: DataFrame) -> DataFrame:
    """Points every fifth day with the sums of segments within 50 days."""
    d = dgos(lineitem)
    known = F.col("lui") != 0
    d = d.withColumn("lui_area", F.col("lui") * F.col("area")).withColumn("known_area", F.when(known, F.col("area"))).withColumn("known_lui", F.when(known, F.col("lui") * F.col("area")))
    w = windows.moving_window(d, "path", "distance", 100.0, sums=["length", "area", "riparian", "lui_area", "known_area", "known_lui"], mins=["low"], maxs=["high"])
    return w.filter("distance % 5 = 0")


@query("lineitem", sql=f"WITH d AS ({_DGO}), i AS ({_IGO}) SELECT i.path, i.distance, d.riparian, d.area FROM i JOIN d USING (path, distance)")
def mw_copy_from_segment(lineitem: DataFrame) -> DataFrame:
    """A point takes what its own segment has."""
    d = dgos(lineitem)
    return d.filter("distance % 5 = 0").select("path", "distance").join(d, ["path", "distance"]).select("path", "distance", "riparian", "area")


@query("lineitem", sql=f"{_WINDOW} SELECT path, distance, area * 0.000247105 / nullif(length / 1609.34, 0) AS acres_per_mile, (area / 10000.0) / nullif(length / 1000.0, 0) AS hectares_per_km FROM w")
def mw_acres_per_mile(lineitem: DataFrame) -> DataFrame:
    w = _windowed(lineitem)
    return w.select("path", "distance", windows.acres_per_mile(F.col("mw_area"), F.col("mw_length")).alias("acres_per_mile"), windows.hectares_per_km(F.col("mw_area"), F.col("mw_length")).alias("hectares_per_km"))


@query("lineitem", sql=f"{_WINDOW} SELECT path, distance, condition FROM w")
def mw_riparian_condition(lineitem: DataFrame) -> DataFrame:
    """The mean condition weighed by area; segments without one (0) count neither above nor below."""
    return _windowed(lineitem).select("path", "distance", ratio(F.col("mw_known_lui"), F.col("mw_known_area")).alias("condition"))


@query("lineitem", sql=f"{_WINDOW} SELECT path, distance, area, length, area / nullif(length, 0) AS integrated_width, riparian / nullif(area, 0) AS proportion, (high - low) / nullif(length, 0) AS gradient FROM w")
def mw_valley_metrics(lineitem: DataFrame) -> DataFrame:
    a, n = F.col("mw_area"), F.col("mw_length")
    w = _windowed(lineitem)
    return w.select("path", "distance", a.alias("area"), n.alias("length"), ratio(a, n).alias("integrated_width"), ratio(F.col("mw_riparian"), a).alias("proportion"), windows.gradient(F.col("mw_high"), F.col("mw_low"), n).alias("gradient"))


@query("lineitem", sql=f"{_WINDOW} SELECT path, distance, lui, riparian * 1000 / nullif(length, 0) AS dams_per_km, least(riparian / nullif(length, 0), 1.0) AS confinement FROM w")
def mw_land_use_and_dams(lineitem: DataFrame) -> DataFrame:
    n = F.col("mw_length")
    return _windowed(lineitem).select("path", "distance", ratio(F.col("mw_lui_area"), F.col("mw_area")).alias("lui"), windows.per_length(F.col("mw_riparian"), n, per_km=True).alias("dams_per_km"), windows.per_length(F.col("mw_riparian"), n, most=1.0).alias("confinement"))


# --- reaches ----------------------------------------------------------------------------------------------------------


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, round(1000 * 9.80665 * l_discount * l_quantity * 0.028316846592, 2) AS power FROM lineitem")
def reach_stream_power(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", windows.reach_power(F.col("l_discount"), F.col("l_quantity")).alias("power"))


_REACH = "SELECT l_orderkey, l_linenumber, l_quantity - 1 AS q, l_discount AS slope, l_tax * 1000 AS lui, l_extendedprice AS price FROM lineitem"


@query("lineitem", sql=f"""SELECT l_orderkey, l_linenumber, CASE WHEN q <= 0 THEN 'Naturally Vegetation Limited' WHEN price > 60000 THEN 'Stream Size Limited' WHEN slope * 4 > 0.23 THEN 'Slope Limited'
WHEN lui >= 75 THEN 'Stream Power Limited' WHEN q <= 10 THEN CASE WHEN lui > 30 THEN 'Anthropogenically Limited' ELSE 'Other' END ELSE 'Dam Building Possible' END AS limitation FROM ({_REACH})""")
def dam_limitation(lineitem: DataFrame) -> DataFrame:
    q, lui, price = F.col("l_quantity") - 1, F.col("l_tax") * 1000, F.col("l_extendedprice")
    none = F.lit(0.0)
    return lineitem.select("l_orderkey", "l_linenumber", classify.dam_limitation(q, none, q - 10, F.col("l_discount") * 4, lui, F.when(lui >= 75, 190.0).otherwise(0.0), none, price, F.lit(60000.0)).alias("limitation"))


@query("lineitem", sql=f"""SELECT l_orderkey, l_linenumber, CASE WHEN safe AND ((q > 10) OR (q >= 5 AND q < 10)) THEN CASE WHEN lui > 60 THEN 'Conservation/Appropriate for Translocation' ELSE 'Encourage Beaver Expansion/Colonization' END
WHEN safe THEN CASE WHEN lui > 60 THEN 'Natural or Anthropogenic Limitations' ELSE 'Land Management Change' END WHEN q > 5 THEN 'Conflict Management' ELSE CASE WHEN lui >= 50 THEN 'Natural or Anthropogenic Limitations' ELSE 'Beaver Mimicry' END END AS opportunity
FROM (SELECT *, slope < 0.05 AS safe FROM ({_REACH}))""")
def dam_opportunity(lineitem: DataFrame) -> DataFrame:
    lui = F.col("l_tax") * 1000
    risk = F.when(F.col("l_discount") < 0.05, classify.MINOR).otherwise(classify.SOME)
    low = F.when(lui > 60, 91.0).otherwise(0.0)
    return lineitem.select("l_orderkey", "l_linenumber", classify.dam_opportunity(risk, F.lit(46006), F.col("l_quantity") - 1, F.lit(9.0), low, lui, F.lit("Classic")).alias("opportunity"))


@query("lineitem", "part", "supplier", sql="""WITH v AS (SELECT p_partkey AS veg, p_size % 5 AS suitability FROM part), o AS (SELECT s_suppkey AS veg, s_nationkey % 5 AS override FROM supplier),
t AS (SELECT l_orderkey, sum(l_quantity) AS cells FROM lineitem GROUP BY 1)
SELECT l.l_orderkey, sum(coalesce(override, suitability) * l_quantity) / max(cells) AS suitability FROM lineitem l JOIN v ON l_partkey = v.veg JOIN t USING (l_orderkey) LEFT JOIN o ON o.veg = v.veg GROUP BY l.l_orderkey""")
def vegetation_suitability(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """A reach's suitability: each vegetation type's, or the one that overrides it, weighed by its share of the cells."""
    types = part.select(F.col("p_partkey").alias("veg"), (F.col("p_size") % 5).alias("suitability"))
    override = supplier.select(F.col("s_suppkey").alias("veg"), (F.col("s_nationkey") % 5).alias("override"))
    known = joins.with_override(types, override, ["veg"], "suitability", "override")
    rows = lineitem.select("l_orderkey", F.col("l_partkey").alias("veg"), "l_quantity").join(known, "veg")
    return rows.groupBy("l_orderkey").agg(aggregates.weighted_mean(F.col("suitability"), F.col("l_quantity"), null_weighs=True).alias("suitability"))


_BRAT = f"""SELECT l_suppkey AS watershed, l_extendedprice AS length, q AS capacity, {_CAPACITY} AS class, CASE WHEN l_returnflag = 'N' THEN 'Perennial' WHEN l_returnflag = 'R' THEN 'Intermittent' ELSE 'Canal' END AS flow,
CASE WHEN l_linestatus = 'O' THEN 'BLM' ELSE 'Other' END AS owner FROM (SELECT *, l_quantity - 1 AS q FROM lineitem)"""
_FLOWS, _OWNERS, _CLASSES = ("Perennial", "Intermittent", "Canal"), ("BLM", "Other"), ("none", "rare", "occasional", "frequent", "pervasive")


@query("lineitem", sql=f"SELECT watershed, sum(length) AS length, sum(length * capacity) AS dams, "
       + ", ".join(f"coalesce(sum(length) FILTER (WHERE class = '{c}'), 0.0) AS length_{c}" for c in _CLASSES) + ", "
       + ", ".join(f"coalesce(sum(length * capacity) FILTER (WHERE flow = '{f}' AND owner = '{o}'), 0.0) AS dams_{f.lower()}_{o.lower()}, coalesce(sum(length) FILTER (WHERE flow = '{f}' AND owner = '{o}'), 0.0) AS length_{f.lower()}_{o.lower()}" for f in _FLOWS for o in _OWNERS)
       + f" FROM ({_BRAT}) GROUP BY watershed")
def capacity_rollup(lineitem: DataFrame) -> DataFrame:
    """The capacity rollup: all filtered sums of a watershed in one aggregation."""
    q = F.col("l_quantity") - 1
    flow = F.when(F.col("l_returnflag") == "N", "Perennial").when(F.col("l_returnflag") == "R", "Intermittent").otherwise("Canal")
    rows = lineitem.select(F.col("l_suppkey").alias("watershed"), F.col("l_extendedprice").alias("length"), (F.col("l_extendedprice") * q).alias("dams"), _capacity_class(q).alias("class"), flow.alias("flow"), F.when(F.col("l_linestatus") == "O", "BLM").otherwise("Other").alias("owner"))
    cases = {f"length_{c}": ("length", F.col("class") == c) for c in _CLASSES}
    for f in _FLOWS:
        for o in _OWNERS:
            both = (F.col("flow") == f) & (F.col("owner") == o)
            cases |= {f"dams_{f.lower()}_{o.lower()}": ("dams", both), f"length_{f.lower()}_{o.lower()}": ("length", both)}
    return aggregates.filtered_sums(rows, ["watershed"], {"length": ("length", None), "dams": ("dams", None)} | cases)


@query("lineitem", sql=f"""WITH d AS (SELECT l_suppkey, CAST(floor({_DAY} / 30) AS BIGINT) AS segment, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Both' WHEN l_returnflag = 'R' THEN 'Left' WHEN l_returnflag = 'A' THEN 'Right' ELSE 'None' END AS kind, l_quantity AS len FROM lineitem),
p AS (SELECT l_suppkey, segment, coalesce(sum(len) FILTER (WHERE kind = 'Left'), 0) AS l, coalesce(sum(len) FILTER (WHERE kind = 'Right'), 0) AS r, coalesce(sum(len) FILTER (WHERE kind = 'Both'), 0) AS b, sum(len) AS total FROM d GROUP BY 1, 2)
SELECT l_suppkey, segment, least((l + r + b) / nullif(total, 0), 1.0) AS ratio, b / nullif(total, 0) AS constriction FROM p""")
def confinement_per_segment(lineitem: DataFrame) -> DataFrame:
    kind = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "Both").when(F.col("l_returnflag") == "R", "Left").when(F.col("l_returnflag") == "A", "Right").otherwise("None")
    rows = lineitem.select("l_suppkey", F.floor(F.datediff("l_shipdate", F.lit("1992-01-01")) / 30).alias("segment"), kind.alias("kind"), F.col("l_quantity").alias("len"))
    wide = aggregates.pivot_sum(rows, ["l_suppkey", "segment"], "kind", ["Left", "Right", "Both", "None"], "len")
    total = F.nullif(F.col("Left") + F.col("Right") + F.col("Both") + F.col("None"), F.lit(0.0))
    return wide.select("l_suppkey", "segment", F.least((F.col("Left") + F.col("Right") + F.col("Both")) / total, F.lit(1.0)).alias("ratio"), (F.col("Both") / total).alias("constriction"))


@query("lineitem", "part", sql="""WITH s AS (SELECT l_suppkey AS dgo, CASE WHEN p_type LIKE '%BRASS' THEN 'riparian' WHEN p_type LIKE '%TIN' THEN 'vegetated' ELSE 'other' END AS cover, sum(l_quantity) AS cells FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT dgo, coalesce(sum(cells) FILTER (WHERE cover = 'riparian'), 0) / sum(cells) AS riparian, coalesce(sum(cells) FILTER (WHERE cover IN ('riparian', 'vegetated')), 0) / sum(cells) AS vegetated, sum(cells) AS cells FROM s GROUP BY dgo""")
def riparian_shares(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    cover = F.when(F.col("p_type").endswith("BRASS"), "riparian").when(F.col("p_type").endswith("TIN"), "vegetated").otherwise("other")
    rows = lineitem.select("l_partkey", F.col("l_suppkey").alias("dgo"), "l_quantity").join(part.select("p_partkey", cover.alias("cover")), F.col("l_partkey") == F.col("p_partkey"))
    sums = aggregates.filtered_sums(rows, ["dgo"], {"r": ("l_quantity", F.col("cover") == "riparian"), "v": ("l_quantity", F.col("cover") != "other"), "cells": ("l_quantity", None)})
    return sums.select("dgo", (F.col("r") / F.col("cells")).alias("riparian"), (F.col("v") / F.col("cells")).alias("vegetated"), "cells")


@query("lineitem", sql="""WITH w AS (SELECT l_suppkey AS watershed, 0.5 + l_suppkey % 7 AS a, 0.2 + (l_suppkey % 5) / 10.0 AS b FROM (SELECT DISTINCT l_suppkey FROM lineitem))
SELECT l_orderkey, l_linenumber, round(a * l_quantity ** b * 0.028316846592, 6) AS q2, round(0.177 * (l_quantity ** 0.397) * (l_extendedprice ** 0.453), 6) AS width FROM lineitem JOIN w ON l_suppkey = watershed""")
def regional_curves(lineitem: DataFrame) -> DataFrame:
    """Discharge by each watershed's own parameters, and bankfull width."""
    k = F.col("l_suppkey")
    rows = lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("DRNAREA"), "l_extendedprice", (0.5 + k % 7).alias("a"), (0.2 + k % 5 / 10.0).alias("b"))
    q = formulas.formula("a * DRNAREA ** b * 0.028316846592", {x: F.col(x) for x in ("a", "b", "DRNAREA")})
    return rows.select("l_orderkey", "l_linenumber", F.round(q, 6).alias("q2"), F.round(formulas.bankfull_width(F.col("DRNAREA"), F.col("l_extendedprice")), 6).alias("width"))


@query("supplier", "lineitem", sql="""WITH s AS (SELECT s_suppkey, s_acctbal + 2000 AS area FROM supplier), l AS (SELECT l_suppkey, sum(l_quantity) AS len, max(l_tax) * 100 - min(l_tax) * 100 AS relief, max(l_extendedprice) / 1000 AS longest FROM lineitem GROUP BY 1)
SELECT s_suppkey, 4 * pi() * area / (len * len) AS circularity, sqrt(area) / longest AS elongation, area / (longest * longest) AS form_factor, relief / longest AS relief_ratio, len / area AS drainage_density FROM s JOIN l ON s_suppkey = l_suppkey""")
def basin_shape(supplier: DataFrame, lineitem: DataFrame) -> DataFrame:
    s = supplier.select("s_suppkey", (F.col("s_acctbal") + 2000).alias("area"))
    l = lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum("l_quantity").alias("len"), (F.max("l_tax") * 100 - F.min("l_tax") * 100).alias("relief"), (F.max("l_extendedprice") / 1000).alias("longest"))
    return s.join(l, "s_suppkey").select("s_suppkey", *(c.alias(n) for n, c in classify.basin_shape(F.col("area"), F.col("len"), F.col("longest"), F.col("relief"), F.col("len")).items()))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, (l_quantity - 1) / 49.0 AS unit, 10 + (l_quantity - 1) / 49.0 * 90 AS scaled FROM lineitem")
def rescale(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", filters.rescale(F.col("l_quantity"), 1, 50).alias("unit"), filters.rescale(F.col("l_quantity"), 1, 50, 10, 100).alias("scaled"))


# --- projects ---------------------------------------------------------------------------------------------------------


@query("orders", sql="""SELECT sum(o_totalprice) AS total_length, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS perennial_length, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O') / sum(o_totalprice) AS intermittent_share, count(*) AS n_reaches,
sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') / (count(*) * 0.25) AS density FROM orders""")
def context_metrics(orders: DataFrame) -> DataFrame:
    p = F.col("o_totalprice")
    of = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, p))
    return orders.agg(F.sum(p).alias("total_length"), of("F").alias("perennial_length"), (of("O") / F.sum(p)).alias("intermittent_share"), F.count(F.lit(1)).alias("n_reaches"), (of("F") / (F.count(F.lit(1)) * 0.25)).alias("density"))


@query("customer", "orders", "nation", sql="""WITH o AS (SELECT n_name AS owner, sum(o_totalprice) AS area FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) SELECT owner, area, round(100 * area / (SELECT sum(area) FROM o), 2) AS pct FROM o""")
def ownership_shares(customer: DataFrame, orders: DataFrame, nation: DataFrame) -> DataFrame:
    """Area per owner and its share; sums per customer meet the owners, not the rows."""
    per = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("area"))
    owned = per.join(customer.select("c_custkey", "c_nationkey"), "c_custkey").groupBy("c_nationkey").agg(F.sum("area").alias("area"))
    named = owned.join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("owner")), "c_nationkey")
    return aggregates.share_of_everything(named, ["owner"], "area").select("owner", "area", F.round(100 * F.col("share"), 2).alias("pct"))


@query("lineitem", sql="""WITH p AS (SELECT l_suppkey AS level_path, sum(l_quantity) AS length, sum(l_extendedprice) AS area, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT l_suppkey AS level_path, sum(l_extendedprice) AS area FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
a AS (SELECT l_suppkey AS level_path, sum(l_extendedprice) AS area FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), f AS (SELECT l_suppkey AS level_path, sum(l_extendedprice) AS area FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT p.level_path, p.length, p.n, round(100 * r.area / p.area, 1) AS active_pct, round(100 * a.area / p.area, 1) AS inactive_pct, round(100 * f.area / p.area, 1) AS floodplain_pct FROM p LEFT JOIN r USING (level_path) LEFT JOIN a USING (level_path) LEFT JOIN f USING (level_path)""")
def level_path_summary(lineitem: DataFrame) -> DataFrame:
    """Shares of each level path's area: the four aggregated joins of the view as one conditional aggregation."""
    a = F.col("l_extendedprice")
    pct = lambda c: F.round(100 * F.sum(F.when(c, a)) / F.sum(a), 1)
    return lineitem.groupBy(F.col("l_suppkey").alias("level_path")).agg(F.sum("l_quantity").alias("length"), F.count(F.lit(1)).alias("n"), pct(F.col("l_returnflag") == "R").alias("active_pct"), pct(F.col("l_returnflag") == "A").alias("inactive_pct"), pct(F.col("l_linestatus") == "F").alias("floodplain_pct"))


@query("orders", "customer", "nation", "region", "lineitem", sql="""SELECT o_orderkey, c_name, n_name, r_name, s.length, s.area, s.area / nullif(s.length, 0) AS width, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN (SELECT l_orderkey, sum(l_quantity) AS length, sum(l_extendedprice) AS area FROM lineitem GROUP BY 1) s ON o_orderkey = l_orderkey""")
def flat_metric_view(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame, lineitem: DataFrame) -> DataFrame:
    s = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("length"), F.sum("l_extendedprice").alias("area"))
    places = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "c_name", "n_name", "r_name")
    return orders.join(places, F.col("o_custkey") == F.col("c_custkey")).join(s, "o_orderkey").select("o_orderkey", "c_name", "n_name", "r_name", "length", "area", ratio(F.col("area"), F.col("length")).alias("width"), "o_orderdate")


@query("lineitem", sql="""WITH r AS (SELECT l_suppkey AS allotment, l_linenumber AS pasture, sum(l_quantity) AS length, sum(l_extendedprice) * 0.000247105 AS acres, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') * 0.000621371 AS perennial_miles, avg(l_discount) AS slope, max(l_tax) AS high FROM lineitem GROUP BY 1, 2)
SELECT * FROM r""")
def allotment_summary(lineitem: DataFrame) -> DataFrame:
    """Generated aggregates (method, field, conversion, filter) per allotment and pasture."""
    spec = [("length", "sum", "l_quantity", 1.0, None), ("acres", "sum", "l_extendedprice", 0.000247105, None), ("perennial_miles", "sum", "l_quantity", 0.000621371, "l_returnflag = 'R'"), ("slope", "avg", "l_discount", 1.0, None), ("high", "max", "l_tax", 1.0, None)]
    rows = lineitem.withColumnsRenamed({"l_suppkey": "allotment", "l_linenumber": "pasture"})
    return aggregates.generated(rows, ["allotment", "pasture"], spec)


@query("lineitem", "supplier", sql="""WITH r AS (SELECT l_suppkey AS dgo, count(*) AS n, min(l_quantity) AS width, sum(l_extendedprice) AS area, sum(l_quantity) AS len FROM lineitem WHERE l_linenumber = 7 AND l_returnflag = 'R' AND l_quantity > 40 GROUP BY 1)
SELECT s_suppkey AS dgo, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 100.0 WHEN n = 1 THEN coalesce(area / nullif(len, 0), 10.0) ELSE width END AS width FROM supplier LEFT JOIN r ON s_suppkey = dgo""")
def reach_width_choice(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """A reach without a segment gets a fixed width, one with one its area by its length, one with several the smallest."""
    rows = lineitem.filter("l_linenumber = 7 and l_returnflag = 'R' and l_quantity > 40").groupBy(F.col("l_suppkey").alias("dgo")).agg(F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("width"), F.sum("l_extendedprice").alias("area"), F.sum("l_quantity").alias("len"))
    joined = supplier.select(F.col("s_suppkey").alias("dgo")).join(rows, "dgo", "left")
    width = F.when(F.col("n").isNull(), 100.0).when(F.col("n") == 1, F.coalesce(ratio(F.col("area"), F.col("len")), F.lit(10.0))).otherwise(F.col("width"))
    return joined.select("dgo", F.coalesce("n", F.lit(0)).alias("n"), width.alias("width"))


@query("events", sql="""WITH d AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS dams, count(*) FILTER (WHERE event_type = 'click') AS signs, max(value) AS capacity FROM events GROUP BY 1)
SELECT user_id, dams, signs, dams / nullif(capacity / 10, 0) AS occupancy, CASE WHEN dams = 0 AND signs = 0 THEN 'none' WHEN dams = 0 THEN 'sign' WHEN dams > capacity / 10 THEN 'over capacity' ELSE 'active' END AS activity FROM d""")
def beaver_activity(events: DataFrame) -> DataFrame:
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    d = events.groupBy("user_id").agg(n("purchase").alias("dams"), n("click").alias("signs"), F.max("value").alias("capacity"))
    most = F.col("capacity") / 10
    activity = F.when((F.col("dams") == 0) & (F.col("signs") == 0), "none").when(F.col("dams") == 0, "sign").when(F.col("dams") > most, "over capacity").otherwise("active")
    return d.select("user_id", "dams", "signs", ratio(F.col("dams").cast("double"), most).alias("occupancy"), activity.alias("activity"))


@query("lineitem", sql="""SELECT l_suppkey AS huc, 100.0 * count(*) FILTER (WHERE l_discount > 0.05) / count(*) AS steep_pct, 100.0 * count(*) FILTER (WHERE l_returnflag = 'A') / count(*) AS forest_pct, avg(l_extendedprice) AS precipitation, max(l_quantity) AS max_drainage FROM lineitem GROUP BY 1""")
def watershed_parameters(lineitem: DataFrame) -> DataFrame:
    pct = lambda c: 100.0 * F.count_if(c) / F.count(F.lit(1))
    return lineitem.groupBy(F.col("l_suppkey").alias("huc")).agg(pct(F.col("l_discount") > 0.05).alias("steep_pct"), pct(F.col("l_returnflag") == "A").alias("forest_pct"), F.avg("l_extendedprice").alias("precipitation"), F.max("l_quantity").alias("max_drainage"))


@query("events", sql="""SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'n' || (i + 1) AS structure, value * (i + 1) AS size FROM events, LATERAL (SELECT unnest(range(0, event_id % 3)) AS i)""")
def nested_export(events: DataFrame) -> DataFrame:
    """Nested records as flat rows of a bridge table."""
    parsed = events.withColumn("p", F.from_json("props", "k long")).filter("event_id % 3 > 0")
    items = F.transform(F.sequence(F.lit(1).cast("long"), F.col("event_id") % 3), lambda i: F.struct(F.concat(F.lit("n"), i.cast("string")).alias("structure"), (F.col("value") * i).alias("size")))
    return parsed.select("event_id", "user_id", "p.k", F.explode(items).alias("s")).select("event_id", "user_id", "k", "s.structure", "s.size")
