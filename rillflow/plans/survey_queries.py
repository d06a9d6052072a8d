"""Queries of field-survey metrics.  Visits are suppliers; what was measured there comes from ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, rules, survey
from ..operators.rules import Rule
from .registry import query

_V = "l_suppkey AS visit"


def measured(lineitem: DataFrame) -> DataFrame:
    q = F.col("l_quantity")
    return lineitem.select(
        F.col("l_suppkey").alias("visit"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("unit"), F.col("l_returnflag").alias("tier"), F.col("l_linestatus").alias("status"), "l_shipdate",
        F.nullif(q, F.lit(50.0)).alias("width"), F.nullif(F.col("l_discount") + 0.0, F.lit(0.0)).alias("depth"), F.nullif(F.col("l_tax") + 0.0, F.lit(0.0)).alias("velocity"), F.col("l_extendedprice").alias("area"), q.alias("length"),
    )


_M = f"SELECT {_V}, l_orderkey * 8 + l_linenumber AS unit, l_returnflag AS tier, l_linestatus AS status, l_shipdate, nullif(l_quantity, 50) AS width, nullif(l_discount + 0.0, 0) AS depth, nullif(l_tax + 0.0, 0) AS velocity, l_extendedprice AS area, l_quantity AS length FROM lineitem"


@query("lineitem", sql=f"""WITH m AS (SELECT visit, tier, unit, area, CASE tier WHEN 'R' THEN 1 WHEN 'A' THEN 2 END AS rank FROM ({_M}))
SELECT visit, min_by(CASE WHEN rank IS NOT NULL THEN area END, (rank, unit, area)) FILTER (WHERE rank IS NOT NULL) AS area FROM m GROUP BY visit""")
def preferred_constraint(lineitem: DataFrame) -> DataFrame:
    """The first record of the preferred kind, else of the other."""
    return survey.preferred_first(measured(lineitem).groupBy("visit", "tier", "unit").agg(F.min("area").alias("area")), ["visit"], "tier", "unit", "area", ["R", "A"])


@query("lineitem", sql=f"SELECT visit, coalesce(avg(CASE WHEN tier = 'X' THEN width END), avg(width)) AS width FROM ({_M}) GROUP BY visit")
def fallback_average(lineitem: DataFrame) -> DataFrame:
    m = measured(lineitem)
    return m.groupBy("visit").agg(F.coalesce(F.avg(F.when(F.col("tier") == "X", F.col("width"))), F.avg("width")).alias("width"))


@query("lineitem", sql=f"""WITH m AS (SELECT visit, unit, sum(area) AS mass, min(length) AS portion, sum(width) AS volume FROM ({_M}) GROUP BY 1, 2)
SELECT visit, sum(mass) / min_by(portion, unit) / sum(volume) AS density FROM m GROUP BY visit""")
def drift_biomass_density(lineitem: DataFrame) -> DataFrame:
    m = measured(lineitem).groupBy("visit", "unit").agg(F.sum("area").alias("mass"), F.min("length").alias("portion"), F.sum("width").alias("volume"))
    return survey.drift_density(m, ["visit"], "unit", "mass", "portion", "volume")


@query("lineitem", sql=f"SELECT visit, sum(coalesce(width, 0) * coalesce(depth, 0) * coalesce(velocity, 0)) AS discharge FROM ({_M}) GROUP BY visit")
def site_discharge(lineitem: DataFrame) -> DataFrame:
    return survey.summed_product(measured(lineitem), ["visit"], ["width", "depth", "velocity"], "discharge")


@query("lineitem", sql=f"SELECT visit, sum(coalesce(width, 0) * coalesce(depth, 0)) AS volume, sum(coalesce(depth, 0)) AS area FROM ({_M}) GROUP BY visit")
def undercut_volume(lineitem: DataFrame) -> DataFrame:
    m = measured(lineitem)
    return survey.summed_product(m, ["visit"], ["width", "depth"], "volume").join(survey.summed_product(m, ["visit"], ["depth"], "area"), "visit")


@query("lineitem", sql=f"SELECT visit, avg(velocity) AS solar FROM ({_M}) WHERE month(l_shipdate) BETWEEN 7 AND 9 GROUP BY visit")
def summer_average(lineitem: DataFrame) -> DataFrame:
    return measured(lineitem).filter(F.month("l_shipdate").between(7, 9)).groupBy("visit").agg(F.avg("velocity").alias("solar"))


@query("lineitem", sql=f"""WITH g AS (SELECT visit, unnest([length, length - 5, length / 2]) AS fine, unnest([CASE WHEN depth IS NULL THEN -99 ELSE depth * 100 END, 50.0, velocity * 100]) AS lost FROM ({_M}))
SELECT visit, 100 * avg(CASE WHEN fine + lost <= 50 AND fine <> -99 AND lost <> -99 AND lost <> 50 THEN fine / (50 - lost) END) AS fines_pct FROM g GROUP BY visit""")
def pool_tail_fines(lineitem: DataFrame) -> DataFrame:
    m = measured(lineitem)
    wide = m.select("visit", F.col("length").alias("f1"), (F.col("length") - 5).alias("f2"), (F.col("length") / 2).alias("f3"), F.coalesce(F.col("depth") * 100, F.lit(-99.0)).alias("n1"), F.lit(50.0).alias("n2"), (F.col("velocity") * 100).alias("n3"))
    return survey.pool_tail_fines(wide, ["visit"], [("f1", "n1"), ("f2", "n2"), ("f3", "n3")])


@query("lineitem", sql=f"""WITH b AS (SELECT visit, unnest([depth * CASE tier WHEN 'R' THEN 1.0 WHEN 'A' THEN 0.5 END, velocity * CASE status WHEN 'O' THEN 1.0 ELSE 0.5 END]) AS v FROM ({_M})) SELECT visit, avg(v) AS coniferous FROM b GROUP BY visit""")
def coniferous_cover(lineitem: DataFrame) -> DataFrame:
    """Both banks' cover, weighed by how coniferous its type is."""
    left = F.col("depth") * F.when(F.col("tier") == "R", 1.0).when(F.col("tier") == "A", 0.5)
    right = F.col("velocity") * F.when(F.col("status") == "O", 1.0).otherwise(0.5)
    return survey.both_banks(measured(lineitem), ["visit"], [left, right], "coniferous")


@query("lineitem", sql=f"WITH b AS (SELECT visit, unnest([depth, velocity]) AS v FROM ({_M})) SELECT visit, 100 - avg(v) * 100 AS no_cover FROM b GROUP BY visit")
def no_cover(lineitem: DataFrame) -> DataFrame:
    c = survey.both_banks(measured(lineitem), ["visit"], [F.col("depth"), F.col("velocity")], "cover")
    return c.select("visit", (100 - F.col("cover") * 100).alias("no_cover"))


@query("lineitem", sql=f"SELECT visit, sum(pi() * (depth / 2) ^ 2 * length) AS bankfull_volume, coalesce(sum(pi() * (depth / 2) ^ 2 * length) FILTER (WHERE tier = 'R'), 0.0) AS wetted_volume FROM ({_M}) GROUP BY visit")
def wood_volume(lineitem: DataFrame) -> DataFrame:
    return survey.wood_volume(measured(lineitem), ["visit"], "depth", "length", F.col("tier") == "R")


@query("lineitem", sql=f"""WITH p AS (SELECT visit, unit % 50 AS jam, length * 0.02035 + coalesce(depth * 100, 0) * 0.40012 + 2 * 10.54683 AS pieces, coalesce(width, 0) * 0.15101 AS jam_volume, velocity * 100 AS share FROM ({_M})),
j AS (SELECT jam, max(jam_volume) AS v FROM p WHERE jam % 3 > 0 GROUP BY jam)
SELECT visit, sum(pieces) AS piece_volume, coalesce(sum(coalesce(v, 0) * share / 100), 0.0) AS jam_volume FROM p LEFT JOIN j USING (jam) GROUP BY visit""")
def wood_volume_by_class(lineitem: DataFrame) -> DataFrame:
    """Pieces counted by class, and each unit's share of its jam."""
    m = measured(lineitem).withColumn("jam", F.col("unit") % 50).withColumn("share", F.col("velocity") * 100)
    counts = F.create_map(F.lit("SmallSmall"), F.col("length"), F.lit("MediumLarge"), F.col("depth") * 100, F.lit("ExtraLargeExtraLarge"), F.lit(2.0))
    pieces = m.groupBy("visit").agg(F.sum(survey.class_volume(counts, survey.WOOD_VOLUME)).alias("piece_volume"))
    jams = m.filter("jam % 3 > 0").groupBy("jam").agg(F.max("width").alias("n")).select("jam", survey.class_volume(F.create_map(F.lit("MediumMedium"), F.col("n")), survey.JAM_VOLUME).alias("volume"))
    shares = survey.jam_share(m.select("visit", "jam", "share"), jams, "jam", "share").groupBy("visit").agg(F.sum("volume").alias("jam_volume"))
    return pieces.join(shares, "visit", "left").select("visit", "piece_volume", F.coalesce("jam_volume", F.lit(0.0)).alias("jam_volume"))


@query("lineitem", sql=f"SELECT visit, tier, sum(depth * area) / sum(area) AS depth, sum(velocity * area) / sum(area) AS velocity FROM ({_M}) GROUP BY 1, 2")
def cover_by_tier(lineitem: DataFrame) -> DataFrame:
    return survey.tier_means(measured(lineitem), ["visit"], "tier", "area", ["depth", "velocity"])


@query("lineitem", sql=f"""WITH t AS (SELECT visit, tier, sum(area) AS area, sum(length) AS volume, count(*) AS n, max(depth) AS max_depth, avg(depth) AS mean_depth FROM (SELECT * FROM ({_M})) GROUP BY 1, 2)
SELECT *, 1000.0 / n AS spacing, 100.0 * n / 1000 AS frequency, 100 * area / sum(area) OVER (PARTITION BY visit) AS area_pct FROM t""")
def channel_unit_rollup(lineitem: DataFrame) -> DataFrame:
    return survey.tier_rollup(measured(lineitem).withColumn("site", F.lit(1000.0)), ["visit"], "tier", "area", "length", "depth", "site")


@query("lineitem", sql=f"""WITH s AS (SELECT visit, datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS x, avg(length) AS bed, bool_or(tier = 'R') AS wet FROM ({_M}) GROUP BY 1, 2),
e AS (SELECT visit, (min_by(bed, x) + max_by(bed, x)) / 2 AS level, max(x) - min(x) AS length, coalesce(max(x) FILTER (WHERE wet) - min(x) FILTER (WHERE wet), 0) AS wetted FROM s GROUP BY visit),
d AS (SELECT visit, max(level - bed) FILTER (WHERE level > bed) AS max_depth, avg(level - bed) FILTER (WHERE level > bed) AS mean_depth FROM s JOIN e USING (visit) GROUP BY visit)
SELECT visit, CAST(length AS BIGINT) AS length, wetted * 1.0 AS wetted_width, (length - wetted) * 1.0 AS dry_width, level, max_depth, mean_depth, wetted / max_depth AS width_to_max_depth, wetted / mean_depth AS width_to_mean_depth FROM e JOIN d USING (visit)""")
def cross_section_metrics(lineitem: DataFrame) -> DataFrame:
    m = measured(lineitem).withColumn("at", F.datediff("l_shipdate", F.lit("1992-01-01")).cast("long"))
    stations = m.groupBy("visit", "at").agg(F.avg("length").alias("bed"), F.max(F.col("tier") == "R").alias("wet"))
    return survey.cross_sections(stations, ["visit"], "at", "bed", F.col("wet"))


@query("lineitem", sql=f"""SELECT visit, count(*) FILTER (WHERE tier = 'N') AS n_main, count(*) FILTER (WHERE tier <> 'N') AS n_side, coalesce(sum(length) FILTER (WHERE tier = 'N'), 0.0) AS main_length, coalesce(sum(length) FILTER (WHERE tier <> 'N'), 0.0) AS side_length,
sum(length) / sum(length * 0.8) AS sinuosity FROM ({_M}) GROUP BY visit""")
def centerline_summary(lineitem: DataFrame) -> DataFrame:
    rows = measured(lineitem).withColumn("kind", F.when(F.col("tier") == "N", "Main").otherwise("Side")).withColumn("straight", F.col("length") * 0.8)
    return survey.centerline_summary(rows, ["visit"], "kind", "length", "straight")


@query("lineitem", sql=f"SELECT visit, 100 * coalesce(sum(length * width) FILTER (WHERE tier = 'A'), 0) / sum(area) AS side_channel_pct FROM ({_M}) GROUP BY visit")
def side_channel_area(lineitem: DataFrame) -> DataFrame:
    return survey.side_channel_pct(measured(lineitem), ["visit"], F.col("tier") == "A", "length", "width", "area")


@query("lineitem", sql=f"SELECT visit, sum(length) / (1000.0 * 100 / 2) AS length_pct, 100 * sum(depth) / (500 + sum(depth)) AS area_pct FROM ({_M}) GROUP BY visit")
def undercut_pct(lineitem: DataFrame) -> DataFrame:
    return survey.undercut(measured(lineitem).withColumn("site", F.lit(1000.0)).withColumn("wet", F.lit(500.0)), ["visit"], "length", "depth", "site", "wet")


@query("lineitem", sql=f"SELECT visit, CAST(coalesce(sum(length) FILTER (WHERE tier = 'R' AND depth <= 0.05), 0) AS DOUBLE) AS chinook, CAST(coalesce(sum(length) FILTER (WHERE tier IN ('A', 'N') AND depth <= 0.05), 0) AS DOUBLE) AS others FROM ({_M}) GROUP BY visit")
def fish_counts(lineitem: DataFrame) -> DataFrame:
    """Young fish by species: sums over the size classes that count as young."""
    young = F.col("depth") <= 0.05
    return aggregates.filtered_sums(measured(lineitem), ["visit"], {"chinook": ("length", (F.col("tier") == "R") & young), "others": ("length", F.col("tier").isin("A", "N") & young)})


@query("lineitem", sql=f"""WITH b AS (SELECT visit, sum(area) AS total, stddev_samp(area) AS sd, avg(area) AS mean FROM ({_M}) GROUP BY visit) SELECT visit, total, sd, mean, sd / nullif(mean, 0) AS cv FROM b""")
def thalweg_variation(lineitem: DataFrame) -> DataFrame:
    m = measured(lineitem).groupBy("visit").agg(F.sum("area").alias("total"), F.stddev_samp("area").alias("sd"), F.avg("area").alias("mean"))
    return m.withColumn("cv", aggregates.ratio(F.col("sd"), F.col("mean")))


_RULES = [
    Rule("one main line", "lines", "exactly", where="l_linenumber = 1", value=1),
    Rule("three lines", "lines", "at_least", value=3, status="Warning"),
    Rule("few lines", "lines", "at_most", value=6),
    Rule("dates known", "lines", "required", column="late", status="Warning"),
    Rule("numbers unique", "lines", "unique", column="l_suppkey"),
    Rule("flags", "lines", "one_of", column="l_returnflag", value=("A", "N")),
    Rule("sizes", "lines", "between", column="l_quantity", value=(2, 48)),
    Rule("tax", "lines", "between", column="l_tax", where="l_linestatus = 'F'", value=(0.0, 0.07)),
    Rule("status", "visits", "pattern", column="o_orderstatus", value="^[FO]$"),
    Rule("lines as visits", "lines", "as_many_as", value="visits"),
    Rule("prices", "lines", "no_more_than", column="l_extendedprice", value="visits", other_column="o_totalprice"),
    Rule("lines if a visit", "lines", "has_rows_if", value="visits", status="Warning"),
]


@query("lineitem", "orders", sql="""WITH l AS (SELECT l_orderkey AS visit, count(*) AS n, count(*) FILTER (WHERE l_linenumber = 1) AS one, count(*) FILTER (WHERE l_quantity = 7) AS nulls, count(*) - count(DISTINCT l_suppkey) AS same, count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS flags,
count(*) FILTER (WHERE NOT l_quantity BETWEEN 2 AND 48) AS sizes, count(*) FILTER (WHERE l_linestatus = 'F' AND NOT l_tax BETWEEN 0 AND 0.07) AS tax, sum(l_extendedprice) AS price FROM lineitem WHERE l_orderkey % 5 <> 0 GROUP BY 1),
o AS (SELECT o_orderkey AS visit, count(*) AS m, count(*) FILTER (WHERE NOT regexp_matches(o_orderstatus, '^[FO]$')) AS status, sum(o_totalprice) AS total FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1),
v AS (SELECT visit, coalesce(n, 0) AS n, coalesce(one, 0) AS one, coalesce(nulls, 0) AS nulls, coalesce(same, 0) AS same, coalesce(flags, 0) AS flags, coalesce(sizes, 0) AS sizes, coalesce(tax, 0) AS tax, coalesce(price, 0) AS price, coalesce(m, 0) AS m, coalesce(status, 0) AS bad, coalesce(total, 0) AS total FROM l FULL JOIN o USING (visit)),
r AS (SELECT visit, unnest([('one main line', one = 1, 'Error', one), ('three lines', n >= 3, 'Warning', n), ('few lines', n <= 6, 'Error', n), ('dates known', nulls = 0, 'Warning', nulls), ('numbers unique', same = 0, 'Error', same), ('flags', flags = 0, 'Error', flags), ('sizes', sizes = 0, 'Error', sizes), ('tax', tax = 0, 'Error', tax),
('status', bad = 0, 'Error', bad), ('lines as visits', n = m, 'Error', n - m), ('prices', price <= total, 'Error', price - total), ('lines if a visit', m = 0 OR n > 0, 'Warning', n - m)]) AS x FROM v)
SELECT visit, x[1] AS rule, CASE WHEN x[2] THEN 'Pass' ELSE x[3] END AS status, round(x[4]::DOUBLE, 2) AS observed FROM r""")
def survey_rules(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Twelve rules, in eleven forms, of two tables that each lack some visits."""
    lines = lineitem.filter("l_orderkey % 5 <> 0").withColumn("visit", F.col("l_orderkey")).withColumn("late", F.when(F.col("l_quantity") != 7, F.col("l_shipdate")))
    visits = orders.filter("o_orderkey % 7 <> 0").withColumn("visit", F.col("o_orderkey"))
    return rules.evaluate({"lines": lines, "visits": visits}, _RULES, "visit").withColumn("observed", F.round("observed", 2))


@query("embeddings", sql="""WITH cells AS MATERIALIZED (SELECT vec_id AS row, i - 1 AS col, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, range(1, 65) t(i)),
l AS (SELECT vec_id AS visit, vec_id + 0.5 AS y0, sqrt(37.75 ^ 2 + 100) AS a, sqrt(20.5 ^ 2 + 49) AS b FROM embeddings WHERE vec_id % 20 = 0),
p AS (SELECT visit, y0, a, b, i * 1.7 AS m FROM l, range(0, 36) t(i) WHERE i <= floor((a + b) / 1.7)),
xy AS (SELECT visit, a + b AS length, CASE WHEN m <= a THEN 2.5 + m / a * 37.75 ELSE 40.25 + (m - a) / b * 20.5 END AS x, CASE WHEN m <= a THEN y0 + m / a * 10 ELSE y0 + 10 - (m - a) / b * 7 END AS y FROM p),
s AS (SELECT visit, any_value(length) AS length, min(value) AS min, max(value) AS max, CASE WHEN count(*) = count(value) THEN avg(value) END AS mean, CASE WHEN count(*) = count(value) THEN stddev_pop(value) END AS stdev, count(*) - count(*) FILTER (WHERE value = 0) AS count FROM xy LEFT JOIN cells ON row = floor(y) AND col = floor(x) GROUP BY visit)
SELECT visit, min, max, round(mean, 9) AS mean, round(stdev, 9) AS stdev, count, round(length, 6) AS length, round((u.value - d.value) * 10 / length, 9) AS gradient, round(length / sqrt(58.25 ^ 2 + 9), 6) AS sinuosity, round(stdev / nullif(mean, 0), 6) AS cv, round(length / 50, 6) AS to_centerline
FROM s LEFT JOIN cells d ON d.row = visit AND d.col = 2 LEFT JOIN cells u ON u.row = visit + 3 AND u.col = 60""")
def thalweg_metrics(embeddings: DataFrame) -> DataFrame:
    """Depths sampled along a bent line through the raster, and the fall of the water surface from end to end."""
    from .aggregate_queries import cells_of

    y = F.col("vec_id") + 0.5
    point = lambda x, v: F.struct(F.lit(x).cast("double").alias("x"), v.cast("double").alias("y"))
    lines = embeddings.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("visit"), F.array(point(2.5, y), point(40.25, y + 10), point(60.75, y + 3)).alias("line"), F.lit(50.0).alias("centre"))
    cells = cells_of(embeddings)
    t = survey.thalweg(lines, ["visit"], "line", cells, cells.withColumn("value", F.col("value") * 10), 1.0, 1.7, "centre")
    r = lambda c, k: F.round(c, k).alias(c)
    return t.select("visit", "min", "max", r("mean", 9), r("stdev", 9), "count", r("length", 6), r("gradient", 9), r("sinuosity", 6), r("cv", 6), r("to_centerline", 6))
