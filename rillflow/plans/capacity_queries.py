"""Dam capacity, riparian condition and grazing through the fuzzy systems, from the reach's inputs to its class and window.

The SQL knows a system as tables of memberships, conditions and outcomes, and integrates the joined shape between all its
corners.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, fuzzy
from ..operators import aggregates, windows
from .registry import query


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else repr(float(v)) for v in r) + ")" for r in rows)


def _quad(shape: tuple) -> tuple:
    return shape if len(shape) == 4 else (shape[0], shape[1], shape[1], shape[2])


_HEIGHT = "CASE WHEN {x} >= b AND {x} <= c THEN 1.0 WHEN {x} > a AND {x} < b THEN ({x} - a) / (b - a) WHEN {x} > c AND {x} < d THEN (d - {x}) / (d - c) ELSE 0.0 END"


def system_sql(name: str, system: fuzzy.System, rows: str, key: str) -> str:
    """Common table expressions that end with ``{name}`` (key, result) for ``rows`` (key, one column per input, none of them
    null)."""
    members = [(i, t, *_quad(s)) for i, terms in system.inputs.items() for t, s in terms.items()]
    conditions = [(str(k), out, i, t.lstrip("!"), t[0] == "!") for k, (rule, out) in enumerate(system.rules) for i, terms in rule for t in terms.split("|")]
    outs = [(t, *_quad(s)) for t, s in system.output.items()]
    inputs = " UNION ALL ".join(f"SELECT {key} AS id, '{i}' AS input, greatest({float(lo)!r}, least({float(hi)!r}, {i})) AS x FROM {rows}" for i, (lo, hi) in system.ranges.items())
    n = name
    return f"""{n}_members(input, term, a, b, c, d) AS MATERIALIZED (VALUES {_values(members)}), {n}_rules(rule, outcome, input, term, negated) AS MATERIALIZED (VALUES {_values(conditions)}), {n}_outs(term, a, b, c, d) AS MATERIALIZED (VALUES {_values(outs)}),
{n}_mu AS MATERIALIZED (SELECT id, input, term, {_HEIGHT.format(x="x")} AS m FROM ({inputs}) i JOIN {n}_members USING (input)),
{n}_terms AS (SELECT id, rule, outcome, input, max(CASE WHEN negated THEN 1 - m ELSE m END) AS m FROM {n}_mu JOIN {n}_rules USING (input, term) GROUP BY ALL),
{n}_fired AS (SELECT id, outcome, max(m) AS level FROM (SELECT id, rule, outcome, min(m) AS m FROM {n}_terms GROUP BY ALL) GROUP BY ALL),
{n}_levels AS MATERIALIZED (SELECT id, term, coalesce(level, 0) AS level, a, b, c, d FROM (SELECT DISTINCT id FROM {n}_mu) ids CROSS JOIN {n}_outs o LEFT JOIN {n}_fired f USING (id) WHERE f.outcome = o.term OR f.outcome IS NULL),
{n}_points AS MATERIALIZED (SELECT DISTINCT id, x FROM (SELECT l.id, unnest([o.a, o.b, o.c, o.d, o.a + l.level * (o.b - o.a), o.d - l.level * (o.d - o.c)]) AS x FROM (SELECT DISTINCT id, level FROM {n}_levels) l, {n}_outs o
UNION ALL SELECT ids.id, (p.d * (q.b - q.a) + q.a * (p.d - p.c)) / (q.b - q.a + p.d - p.c) FROM (SELECT DISTINCT id FROM {n}_levels) ids, {n}_outs p, {n}_outs q WHERE p.term <> q.term AND p.d > p.c AND q.b > q.a)),
{n}_pieces AS (SELECT * FROM (SELECT id, x AS l, lead(x) OVER (PARTITION BY id ORDER BY x) AS r FROM {n}_points) WHERE r > l),
{n}_heights AS (SELECT p.id, p.l, p.r, max(least(level, {_HEIGHT.format(x="(l + (r - l) / 4)")})) AS h0, max(least(level, {_HEIGHT.format(x="(r - (r - l) / 4)")})) AS h1 FROM {n}_pieces p JOIN {n}_levels USING (id) GROUP BY ALL),
{n} AS MATERIALIZED (SELECT id, sum((r - l) * (h0 + h1) / 2 * (l + r) / 2 + (h1 - h0) * (r - l) * (r - l) / 6) / nullif(sum((r - l) * (h0 + h1) / 2), 0) AS result FROM {n}_heights GROUP BY id)"""


# --- the chain of dam capacity ------------------------------------------------------------------------------------------

_REACH = f"""suited AS MATERIALIZED (SELECT l_suppkey % 7 AS ws, l_returnflag AS flag, round(sum((p_size % 5) * l_quantity) / sum(l_quantity), 2) AS near FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
whole AS MATERIALIZED (SELECT l_suppkey % 7 AS ws, round(sum((p_size * 3 % 5) * l_quantity) / sum(l_quantity), 2) AS wide FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
veg_in AS MATERIALIZED (SELECT DISTINCT near || '/' || wide AS k, near AS streamside, wide AS riparian FROM suited JOIN whole USING (ws)), {system_sql("veg", fuzzy.VEGETATION, "veg_in", "k")},
grown AS MATERIALIZED (SELECT id AS k, CASE WHEN round(result, 6) = 0.033333 THEN 0.0 WHEN round(result) >= 31 THEN 40.0 ELSE round(result, 2) END AS vegetation FROM veg),
reach AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_suppkey AS path, datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS distance, l_quantity AS length, l_linenumber * 400.0 AS flood_power, round(l_tax * 2500, 1) AS base_power, round(l_discount * 2.5, 4) AS slope,
(l_partkey * 7 % 100) * 1.0 AS land_use, CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE (l_partkey % 40) * 10.0 END AS road, CASE WHEN l_suppkey % 9 = 0 THEN 15.0 ELSE 500.0 END AS canal, vegetation FROM lineitem JOIN suited ON suited.ws = l_suppkey % 7 AND suited.flag = l_returnflag JOIN whole USING (ws) JOIN grown ON k = near || '/' || wide),
com_in AS MATERIALIZED (SELECT DISTINCT vegetation || '/' || flood_power || '/' || base_power || '/' || slope AS k, vegetation, flood_power, base_power, slope FROM reach), {system_sql("com", fuzzy.COMBINED, "com_in", "k")},
held AS MATERIALIZED (SELECT r.*, round(CASE WHEN round(least(result, vegetation), 6) = 0.033333 THEN 0.0 ELSE least(result, vegetation) END, 9) AS raw FROM reach r JOIN com ON id = vegetation || '/' || flood_power || '/' || base_power || '/' || slope),
counted AS (SELECT *, round(raw, 2) AS capacity, round(CASE WHEN raw * length / 1000 > 0 AND raw * length / 1000 < 1 THEN 1.0 ELSE raw * length / 1000 END, 2) AS dams FROM held),
risky AS (SELECT *, CASE WHEN canal <= 20 THEN 'Considerable Risk' WHEN road IS NULL THEN 'Negligible Risk' WHEN road <= 30 OR land_use >= 66 THEN CASE WHEN capacity >= 5 THEN 'Considerable Risk' ELSE 'Some Risk' END
WHEN road <= 100 THEN CASE WHEN capacity >= 5 THEN 'Some Risk' ELSE 'Minor Risk' END WHEN road <= 300 OR land_use >= 33 THEN 'Minor Risk' ELSE 'Negligible Risk' END AS risk,
CASE WHEN vegetation <= 0 THEN 'Naturally Vegetation Limited' WHEN slope > 0.23 THEN 'Slope Limited' WHEN base_power >= 190 OR flood_power >= 2400 THEN 'Stream Power Limited' WHEN capacity <= 0 THEN CASE WHEN land_use > 30 THEN 'Anthropogenically Limited' ELSE 'Other' END ELSE 'Dam Building Possible' END AS limitation FROM counted),
chain AS (SELECT *, CASE WHEN risk IN ('Negligible Risk', 'Minor Risk') AND (capacity > 10 OR capacity >= 5 AND capacity < 10) THEN CASE WHEN 100 - land_use > 90 THEN 'Conservation/Appropriate for Translocation' ELSE 'Encourage Beaver Expansion/Colonization' END
WHEN risk IN ('Negligible Risk', 'Minor Risk') THEN CASE WHEN 100 - land_use > 90 THEN 'Natural or Anthropogenic Limitations' ELSE 'Land Management Change' END WHEN capacity > 5 THEN 'Conflict Management' WHEN land_use >= 50 THEN 'Natural or Anthropogenic Limitations' ELSE 'Beaver Mimicry' END AS opportunity FROM risky)"""


def reaches(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """From suitability over vegetation and combined capacity to dams, risk, limitation and opportunity of each reach."""
    rows = lineitem.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey").withColumn("ws", F.col("l_suppkey") % 7)
    suited = lambda by, value, name: rows.groupBy(*by).agg(F.round(aggregates.weighted_mean(value.cast("double"), F.col("l_quantity")), 2).alias(name))
    near, wide = suited(["ws", "l_returnflag"], F.col("p_size") % 5, "streamside"), suited(["ws"], F.col("p_size") * 3 % 5, "riparian")
    vegetation = near.join(wide, "ws").withColumn("vegetation", fuzzy.vegetation_capacity(F.col("riparian"), F.col("streamside"))).select("ws", "l_returnflag", "vegetation")
    k = F.col("l_partkey")
    reach = lineitem.withColumn("ws", F.col("l_suppkey") % 7).join(vegetation, ["ws", "l_returnflag"]).select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("path"), F.datediff("l_shipdate", F.lit("1992-01-01")).alias("distance"), F.col("l_quantity").alias("length"), "vegetation",
        (F.col("l_linenumber") * 400.0).alias("flood_power"), F.round(F.col("l_tax") * 2500, 1).alias("base_power"), F.round(F.col("l_discount") * 2.5, 4).alias("slope"),
        (k * 7 % 100).cast("double").alias("land_use"), F.when(k % 11 != 0, (k % 40) * 10.0).alias("road"), F.when(F.col("l_suppkey") % 9 == 0, 15.0).otherwise(500.0).alias("canal"),
    )
    none = F.lit(None).cast("double")
    raw = fuzzy.unrounded_capacity(F.col("vegetation"), F.col("flood_power"), F.col("base_power"), F.col("slope"), none, F.lit(46006), none)
    held = reach.withColumn("raw", F.round(raw, 9)).withColumn("capacity", F.round("raw", 2)).withColumn("dams", fuzzy.dam_count(F.col("raw"), F.col("length")))
    c = {x: F.col(x) for x in held.columns}
    risk = classify.dam_risk(c["capacity"], c["land_use"], c["canal"], none, c["road"], none)
    limitation = classify.dam_limitation(c["vegetation"], c["vegetation"], c["capacity"], c["slope"], c["land_use"], c["base_power"], c["flood_power"], none, none)
    held = held.withColumn("risk", risk).withColumn("limitation", limitation)
    return held.withColumn("opportunity", classify.dam_opportunity(F.col("risk"), F.lit(46006), c["capacity"], c["vegetation"], 100 - c["land_use"], c["land_use"], F.lit("Classic")))


@query("lineitem", "part", sql=f"WITH {_REACH} SELECT l_orderkey, l_linenumber, vegetation, capacity, dams, risk, limitation, opportunity FROM chain")
def capacity_chain(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return reaches(lineitem, part).select("l_orderkey", "l_linenumber", "vegetation", "capacity", "dams", "risk", "limitation", "opportunity")


@query("lineitem", "part", sql=f"""WITH {_REACH}, d AS MATERIALIZED (SELECT path, distance, sum(length) AS length, sum(dams) AS dams, sum(CASE WHEN limitation = 'Dam Building Possible' THEN length ELSE 0 END) AS possible, sum(CASE WHEN risk = 'Considerable Risk' THEN length ELSE 0 END) AS risk FROM chain GROUP BY 1, 2)
SELECT a.path, a.distance, round(sum(d.dams) * 1000 / sum(d.length), 6) AS density, round(sum(d.possible) / sum(d.length), 9) AS possible, round(sum(d.risk) / sum(d.length), 9) AS risk FROM d a JOIN d ON d.path = a.path AND d.distance BETWEEN a.distance - 60 AND a.distance + 60 GROUP BY 1, 2""")
def capacity_chain_windows(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """The chain's end: dams a kilometre, and the shares of length that allow dams or are at risk, in a window along the stream."""
    rows = reaches(lineitem, part)
    of = lambda condition: F.when(condition, F.col("length")).otherwise(0.0)
    d = windows.per_distance(rows, "path", "distance", {"length": F.col("length"), "dams": F.col("dams"), "possible": of(F.col("limitation") == "Dam Building Possible"), "risk": of(F.col("risk") == classify.CONSIDERABLE)})
    w = windows.moving_window(d, "path", "distance", 120.0, sums=["length", "dams", "possible", "risk"])
    share = lambda c: F.round(aggregates.ratio(F.col(f"mw_{c}"), F.col("mw_length")), 9).alias(c)
    return w.select("path", "distance", F.round(windows.per_length(F.col("mw_dams"), F.col("mw_length"), per_km=True), 6).alias("density"), share("possible"), share("risk"))


# --- riparian condition and grazing -------------------------------------------------------------------------------------

_CONDITION = f"""r AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_linenumber * 0.18 AS ratio, l_tax * 1200 AS land_use, l_discount * 10 AS access FROM lineitem),
con_in AS MATERIALIZED (SELECT DISTINCT ratio || '/' || land_use || '/' || access AS k, CASE WHEN ratio >= 1 THEN 2 - ratio ELSE ratio END AS departure, land_use, access FROM r), {system_sql("con", fuzzy.CONDITION, "con_in", "k")}"""


@query("lineitem", sql=f"WITH {_CONDITION} SELECT l_orderkey, l_linenumber, round((result - 0.033) / (0.9766 - 0.033), 2) AS condition FROM r JOIN con ON id = ratio || '/' || land_use || '/' || access")
def riparian_condition(lineitem: DataFrame) -> DataFrame:
    ratio, land_use, access = F.col("l_linenumber") * 0.18, F.col("l_tax") * 1200, F.col("l_discount") * 10
    return lineitem.select("l_orderkey", "l_linenumber", fuzzy.riparian_condition(ratio, land_use, access).alias("condition"))


_GRAZING = f"""r AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_linenumber * 220.0 AS water, l_tax * 250 AS slope, l_discount * 40 AS vegetation FROM lineitem),
gra_in AS MATERIALIZED (SELECT DISTINCT water || '/' || slope || '/' || vegetation AS k, water, slope, vegetation FROM r), {system_sql("gra", fuzzy.GRAZING, "gra_in", "k")}"""


@query("lineitem", sql=f"WITH {_GRAZING} SELECT l_orderkey, l_linenumber, round(CASE WHEN round(result, 6) = 0.000167 THEN 0.0 ELSE result END, 6) AS likelihood FROM r JOIN gra ON id = water || '/' || slope || '/' || vegetation")
def grazing_likelihood(lineitem: DataFrame) -> DataFrame:
    found = fuzzy.grazing_likelihood(F.col("l_linenumber") * 220.0, F.col("l_tax") * 250, F.col("l_discount") * 40)
    return lineitem.select("l_orderkey", "l_linenumber", F.round(found, 6).alias("likelihood"))
