"""Queries of the metric-catalogue engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import catalogue, windows
from .domain_queries import FOOT, FOOT_2
from .registry import query

#: Ten metrics and one that is switched off.
CATALOGUE = [
    {"metric_id": 1, "code": "strmleng", "calculation": "sum", "field": "l_quantity", "window": "sum"},
    {"metric_id": 2, "code": "planform", "calculation": "longest", "field": "l_tax", "by": "l_quantity", "window": "copy"},
    {"metric_id": 3, "code": "riparian", "calculation": "sum", "field": "l_extendedprice", "window": "proportion"},
    {"metric_id": 4, "code": "lui", "calculation": "weighted_mean", "field": "l_discount", "by": "l_extendedprice", "window": "area_weighted"},
    {"metric_id": 5, "code": "dams", "calculation": "count", "field": "l_orderkey", "window": "sum_div_length_km"},
    {"metric_id": 6, "code": "confinement", "calculation": "per", "field": "l_tax", "by": "length", "window": "length_weighted"},
    {"metric_id": 7, "code": "roads", "calculation": "sum", "field": "l_discount", "window": "sum_div_length"},
    {"metric_id": 8, "code": "valley", "calculation": "sum", "field": "l_extendedprice", "window": "acres_per_mile"},
    {"metric_id": 9, "code": "highest", "calculation": "max", "field": "l_tax"},
    {"metric_id": 10, "code": "floodplain", "calculation": "sum", "field": "l_extendedprice", "window": "hectares_per_km"},
    {"metric_id": 11, "code": "unused", "calculation": "mean", "field": "l_tax", "window": "sum", "is_active": False},
]

_SEGMENTS = f"""d AS (SELECT l_suppkey AS path, datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS distance, sum(l_quantity) * {FOOT!r} AS length, sum(l_extendedprice) * {FOOT_2!r} AS area, sum(l_quantity) AS strmleng,
min_by(l_tax, (-l_quantity, l_tax)) AS planform, sum(l_extendedprice) AS riparian, sum(l_discount * l_extendedprice) / sum(l_extendedprice) AS lui, count(*) * 1.0 AS dams, sum(l_tax) / (sum(l_quantity) * {FOOT!r}) AS confinement, sum(l_discount) AS roads,
max(l_tax) AS highest FROM lineitem GROUP BY 1, 2)"""


def _segments(lineitem: DataFrame) -> tuple[DataFrame, list[catalogue.Metric]]:
    metrics = catalogue.read(CATALOGUE)
    rows = lineitem.withColumn("area", F.col("l_extendedprice") * FOOT_2).withColumn("length", F.col("l_quantity") * FOOT).withColumn("path", F.col("l_suppkey")).withColumn("distance", F.datediff("l_shipdate", F.lit("1992-01-01")))
    return catalogue.segments(rows, metrics, "path", "distance", "length", "area"), metrics


@query("lineitem", sql=f"""WITH {_SEGMENTS}, w AS (SELECT a.path, a.distance, any_value(a.planform) AS planform, sum(d.length) AS n, sum(d.area) AS area, sum(d.strmleng) AS strmleng, sum(d.riparian) AS riparian, sum(d.lui * d.area) AS lui, sum(d.dams) AS dams,
sum(d.confinement * d.length) AS confinement, sum(d.roads) AS roads FROM d a JOIN d ON d.path = a.path AND d.distance BETWEEN a.distance - 60 AND a.distance + 60 GROUP BY 1, 2)
SELECT path, distance, strmleng, planform, riparian / area AS riparian, lui / area AS lui, dams * 1000 / n AS dams, confinement / n AS confinement, roads / n AS roads, (riparian * 0.000247105) / (n / 1609.34) AS valley, (riparian / 10000.0) / (n / 1000.0) AS floodplain FROM w""")
def catalogue_engine(lineitem: DataFrame) -> DataFrame:
    rows, metrics = _segments(lineitem)
    return catalogue.windows_of(rows, metrics, "path", "distance", 120.0)


#: Widths by the size of the stream (here the supplier's number modulo 5), twice the spacing at least.
_OWN = "least AS (SELECT path, min(distance) AS a FROM d GROUP BY path), gap AS (SELECT d.path, min(distance) - any_value(a) AS spacing FROM d JOIN least USING (path) WHERE distance > a GROUP BY d.path), o AS (SELECT d.*, greatest([200, 400, 1200, 2000, 8000][path % 5 + 1], coalesce(2 * spacing, 0)) * 1.0 AS width FROM d LEFT JOIN gap USING (path))"


@query("lineitem", sql=f"""WITH {_SEGMENTS}, {_OWN}, w AS (SELECT a.path, a.distance, any_value(a.planform) AS planform, sum(d.length) AS n, sum(d.area) AS area, sum(d.strmleng) AS strmleng, sum(d.riparian) AS riparian, sum(d.lui * d.area) AS lui, sum(d.dams) AS dams,
sum(d.confinement * d.length) AS confinement, sum(d.roads) AS roads FROM o a JOIN d ON d.path = a.path AND d.distance BETWEEN trunc(a.distance - a.width / 2) AND trunc(a.distance + a.width / 2) GROUP BY 1, 2)
SELECT path, distance, strmleng, planform, riparian / area AS riparian, lui / area AS lui, dams * 1000 / n AS dams, confinement / n AS confinement, roads / n AS roads, (riparian * 0.000247105) / (n / 1609.34) AS valley, (riparian / 10000.0) / (n / 1000.0) AS floodplain FROM w""")
def catalogue_engine_own_width(lineitem: DataFrame) -> DataFrame:
    """The catalogue in windows of each point's own width: by stream size, enlarged to twice the spacing of its stream."""
    width = windows.window_width((F.col("path") % 5).cast("int"), F.col("spacing"))

    def whole(records: DataFrame) -> DataFrame:
        rows, metrics = _segments(records)
        along = Window.partitionBy("path").orderBy("distance").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        spacing = F.nth_value("distance", 2, True).over(along) - F.min("distance").over(along)
        return catalogue.windows_of(rows.withColumn("spacing", spacing).withColumn("width", width), metrics, "path", "distance", F.col("width"), whole=True)

    def cut(records: DataFrame) -> DataFrame:
        rows, metrics = _segments(records)
        wide = rows.join(windows.spacing(rows, "path", "distance"), "path").withColumn("width", width)
        return catalogue.windows_of(wide, metrics, "path", "distance", F.col("width"), 512.0)

    needed = ("l_suppkey", "l_shipdate", "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return windows.by_size(lineitem.filter("l_suppkey is not null").select(*needed), "l_suppkey", whole, cut)


@query("lineitem", sql="""WITH d AS (SELECT l_suppkey AS path, datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS x, min(l_tax) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1, 2)
SELECT a.path, a.x AS distance, min(d.low) AS mw_low, max(d.high) AS mw_high, count(*) * 1.0 AS mw_one FROM d a JOIN d ON d.path = a.path AND d.x BETWEEN a.x - 5 * (a.x % 40) AND a.x + 3 * (a.x % 70) GROUP BY 1, 2""")
def own_window_extremes(lineitem: DataFrame) -> DataFrame:
    """Minimum, maximum and count in windows that every point has its own of, uneven to both sides."""
    low, high = F.col("distance") - 5 * (F.col("distance") % 40), F.col("distance") + 3 * (F.col("distance") % 70)

    def rows(records: DataFrame) -> DataFrame:
        x = F.datediff("l_shipdate", F.lit("1992-01-01"))
        return records.groupBy(F.col("l_suppkey").alias("path"), x.alias("distance")).agg(F.min("l_tax").alias("low"), F.max("l_extendedprice").alias("high")).withColumn("one", F.lit(1.0))

    def whole(records: DataFrame) -> DataFrame:
        return windows.whole_windows(rows(records), "path", "distance", low, high, ["one"], ["low"], ["high"]).select("path", "distance", "mw_low", "mw_high", "mw_one")

    def cut(records: DataFrame) -> DataFrame:
        d = rows(records)
        return windows.own_windows(d, d, "path", "distance", low, high, 512.0, ["one"], ["low"], ["high"]).select("path", "distance", "mw_low", "mw_high", "mw_one")

    return windows.by_size(lineitem.select("l_suppkey", "l_shipdate", "l_tax", "l_extendedprice"), "l_suppkey", whole, cut)


@query("lineitem", sql=f"""WITH {_SEGMENTS} SELECT path, distance, unnest([1, 5, 9]) AS metric_id, unnest([strmleng, dams, highest]) AS value FROM d""")
def catalogue_values_long(lineitem: DataFrame) -> DataFrame:
    rows, metrics = _segments(lineitem)
    long = catalogue.long_form(rows, [m for m in metrics if m.metric_id in (1, 5, 9)], ["path", "distance"])
    return long.select("path", "distance", "metric_id", F.col("metric_value").cast("double").alias("value"))
