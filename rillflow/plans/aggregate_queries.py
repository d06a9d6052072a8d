"""Queries of aggregations, bins, windows, formulas, grids, networks and geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import curves, geometry
from ..functions.formulas import formula
from ..operators import aggregates as agg
from ..operators import filters, grid, joins, network
from ..operators import windows as win
from .registry import query

LP = "lineitem JOIN part ON l_partkey = p_partkey"


def _lp(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))


@query("lineitem", sql="SELECT l_suppkey, round(sum(l_discount * l_extendedprice) / sum(l_extendedprice), 8) AS mean_known, round(sum(l_tax * CASE WHEN l_quantity > 10 THEN l_extendedprice END) / sum(l_extendedprice), 8) AS mean_all FROM lineitem GROUP BY l_suppkey")
def weighted_mean_area(lineitem: DataFrame) -> DataFrame:
    some = F.when(F.col("l_quantity") > 10, F.col("l_tax"))
    return lineitem.groupBy("l_suppkey").agg(F.round(agg.weighted_mean(F.col("l_discount"), F.col("l_extendedprice")), 8).alias("mean_known"), F.round(agg.weighted_mean(some, F.col("l_extendedprice"), null_weighs=True), 8).alias("mean_all"))


@query("lineitem", "part", sql=f"""
WITH s AS (SELECT l_suppkey, p_type, sum(l_extendedprice) AS v FROM {LP} GROUP BY ALL),
t AS (SELECT *, v / sum(v) OVER (PARTITION BY l_suppkey) AS share FROM s)
SELECT l_suppkey, coalesce(string_agg(p_type, ',' ORDER BY p_type) FILTER (WHERE share > 0.27), '') AS parts FROM t GROUP BY l_suppkey""")
def share_gt_threshold_list(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return agg.over_share(_lp(lineitem, part), ["l_suppkey"], "p_type", "l_extendedprice", 0.27)


@query("lineitem", "part", sql=f"""
WITH s AS (SELECT l_suppkey, p_brand, sum(l_quantity) AS w FROM {LP} GROUP BY ALL)
SELECT l_suppkey, p_brand, w AS l_quantity FROM s QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY w DESC, p_brand) = 1""")
def majority_by_weight(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return agg.majority(_lp(lineitem, part), ["l_suppkey"], "p_brand", "l_quantity")


@query("lineitem", sql="SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) / sum(l_quantity) > 0.5 AS headwater FROM lineitem GROUP BY l_suppkey")
def majority_flag(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_suppkey").agg(agg.majority_flag(F.col("l_returnflag") == "N", F.col("l_quantity")).alias("headwater"))


_CNR = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query("customer", "nation", "region", sql=f"SELECT r_name, n_name, c_mktsegment, CAST(grouping(r_name) * 4 + grouping(n_name) * 2 + grouping(c_mktsegment) AS BIGINT) AS level, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM {_CNR} GROUP BY ROLLUP (r_name, n_name, c_mktsegment)")
def group_rollup(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    j = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.rollup("r_name", "n_name", "c_mktsegment").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("orders", sql="SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def group_cube(orders: DataFrame) -> DataFrame:
    return orders.cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("lineitem", sql="SELECT l_returnflag = 'A' AS owned, round(coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0), 2) AS F, round(coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0), 2) AS O FROM lineitem GROUP BY 1")
def crosstab_pivot(lineitem: DataFrame) -> DataFrame:
    return agg.pivot_sum(lineitem.withColumn("owned", F.col("l_returnflag") == "A"), ["owned"], "l_linestatus", ["F", "O"], "l_quantity")


@query("orders", sql="SELECT o_custkey, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 1) AS f, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 1) AS o, count(*) FILTER (WHERE o_totalprice > 100000) AS large FROM orders GROUP BY o_custkey")
def filtered_aggregate_pivot(orders: DataFrame) -> DataFrame:
    total = lambda s: F.round(F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))), 1)
    return orders.groupBy("o_custkey").agg(total("F").alias("f"), total("O").alias("o"), F.count_if(F.col("o_totalprice") > 100000).alias("large"))


@query("events", sql="SELECT user_id, TRY_CAST(max(CAST(value AS VARCHAR)) FILTER (WHERE event_type = 'click') AS DOUBLE) IS NOT NULL AS has_click, CAST(max(json_extract_string(props, '$.k')) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchase_k FROM events GROUP BY user_id")
def eav_to_wide(events: DataFrame) -> DataFrame:
    long = events.select("user_id", "event_type", F.when(F.col("event_type") == "purchase", F.get_json_object("props", "$.k")).otherwise(F.col("value").cast("string")).alias("text"))
    wide = agg.eav_to_wide(long, ["user_id"], "event_type", "text", {"click": ("click", "double"), "purchase": ("purchase_k", "bigint")})
    return wide.select("user_id", F.col("click").isNotNull().alias("has_click"), "purchase_k")


def _case(edges: list[float], op: str, col: str, base: int = 0) -> str:
    return "CASE " + " ".join(f"WHEN {col} {op} {e} THEN {i + base}" for i, e in enumerate(edges)) + " END"


_EDGES = [0.01, 0.03, 0.05, 0.08]


@query("lineitem", sql=f"SELECT {_case(_EDGES, '<', 'l_discount')} AS bin, round(sum(l_quantity), 1) AS l_quantity, count(*) AS n FROM lineitem WHERE {_case(_EDGES, '<', 'l_discount')} IS NOT NULL GROUP BY 1")
def bins_upper_exclusive(lineitem: DataFrame) -> DataFrame:
    return agg.binned_sum(lineitem, [], filters.ladder(F.col("l_discount"), _EDGES, list(range(4)), "left"), "l_quantity").withColumn("l_quantity", F.round("l_quantity", 1))


@query("lineitem", sql=f"SELECT {_case(_EDGES, '<=', 'l_discount')} AS bin, round(sum(l_quantity), 1) AS l_quantity, count(*) AS n FROM lineitem WHERE {_case(_EDGES, '<=', 'l_discount')} IS NOT NULL GROUP BY 1")
def bins_upper_inclusive(lineitem: DataFrame) -> DataFrame:
    return agg.binned_sum(lineitem, [], filters.ladder(F.col("l_discount"), _EDGES, list(range(4))), "l_quantity").withColumn("l_quantity", F.round("l_quantity", 1))


@query("part", sql="SELECT p_brand, CASE WHEN p_size < 10 THEN 0 WHEN p_size < 20 THEN 1 WHEN p_size < 30 THEN 2 WHEN p_size < 40 THEN 3 WHEN p_size < 50 THEN 4 ELSE 5 END AS bin, round(sum(p_retailprice), 2) AS p_retailprice, count(*) AS n FROM part GROUP BY ALL")
def bins_half_open(part: DataFrame) -> DataFrame:
    return agg.binned_sum(part, ["p_brand"], filters.ladder(F.col("p_size"), [10, 20, 30, 40, 50], list(range(5)), "left", 5), "p_retailprice").withColumn("p_retailprice", F.round("p_retailprice", 2))


@query("lineitem", sql="""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 5)), 4) AS INTEGER) AS bin, round(sum(l_quantity), 1) AS l_quantity, count(*) AS n FROM lineitem, s GROUP BY 1""")
def equal_width_weighted_histogram(lineitem: DataFrame) -> DataFrame:
    return agg.equal_width_histogram(lineitem, "l_extendedprice", "l_quantity", 5).select("bin", F.round("l_quantity", 1).alias("l_quantity"), "n")


@query("lineitem", sql="SELECT l_suppkey, round(coalesce(sum(l_quantity) FILTER (WHERE l_discount <= 0.02), 0), 1) AS very_low, round(coalesce(sum(l_quantity) FILTER (WHERE l_discount > 0.02 AND l_discount <= 0.06), 0), 1) AS low, round(coalesce(sum(l_quantity) FILTER (WHERE l_discount > 0.06 AND l_discount <= 0.1), 0), 1) AS high FROM lineitem GROUP BY l_suppkey")
def cumulative_class_diff(lineitem: DataFrame) -> DataFrame:
    out = agg.cumulative_classes(lineitem, ["l_suppkey"], "l_discount", "l_quantity", {"very_low": 0.02, "low": 0.06, "high": 0.1})
    return out.select("l_suppkey", *(F.round(c, 1).alias(c) for c in ("very_low", "low", "high")))


@query("lineitem", sql="\nUNION ALL\n".join(f"SELECT '{n}' AS field, max({e}) AS max, min({e}) AS min, round(avg({e}), 6) AS avg, count({e}) AS n, count(*) - count({e}) AS n_null FROM lineitem" for n, e in (("quantity", "nullif(l_quantity, 1)"), ("tax", "nullif(l_tax, 0)"))))
def stats_profile_nulls(lineitem: DataFrame) -> DataFrame:
    rows = lineitem.select(F.nullif("l_quantity", F.lit(1.0)).alias("quantity"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return agg.profile(rows, ["quantity", "tax"]).withColumn("avg", F.round("avg", 6))


@query("events", sql="SELECT user_id, round(stddev_samp(value), 6) AS sd, round(stddev_pop(value), 6) AS sd_pop, round(stddev_pop(value) / nullif(avg(value), 0), 6) AS cv FROM events GROUP BY user_id")
def stddev_samp_cv(events: DataFrame) -> DataFrame:
    v = F.col("value")
    return events.groupBy("user_id").agg(F.round(F.stddev_samp(v), 6).alias("sd"), F.round(F.stddev_pop(v), 6).alias("sd_pop"), F.round(agg.ratio(F.stddev_pop(v), F.avg(v)), 6).alias("cv"))


@query("lineitem", sql="""
WITH r AS (SELECT l_suppkey, l_quantity AS v, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) - 1 AS i, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem)
SELECT l_suppkey, max(v) FILTER (WHERE i = floor(n * 16 / 100)) AS d16, max(v) FILTER (WHERE i = floor(n * 50 / 100)) AS d50, max(v) FILTER (WHERE i = floor(n * 84 / 100)) AS d84 FROM r GROUP BY l_suppkey""")
def percentile_rank_index(lineitem: DataFrame) -> DataFrame:
    return agg.percentile_by_rank(lineitem, ["l_suppkey"], "l_quantity", [16, 50, 84])


@query("lineitem", sql="WITH s AS (SELECT l_suppkey, l_linenumber, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) SELECT l_suppkey, l_linenumber, q AS l_quantity, round(100 * sum(q) OVER (PARTITION BY l_suppkey ORDER BY l_linenumber) / sum(q) OVER (PARTITION BY l_suppkey), 6) AS cumulative_pct FROM s")
def cumulative_percent(lineitem: DataFrame) -> DataFrame:
    return agg.cumulative_percent(lineitem, ["l_suppkey"], "l_linenumber", "l_quantity").withColumn("cumulative_pct", F.round("cumulative_pct", 6))


@query("lineitem", sql="WITH c AS (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL) SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_quantity) = 1")
def mode_with_tiebreak(lineitem: DataFrame) -> DataFrame:
    return agg.mode(lineitem, ["l_suppkey"], "l_quantity")


@query("lineitem", sql="SELECT l_suppkey, round(avg(DISTINCT l_quantity), 8) AS mean_distinct, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_suppkey")
def distinct_mean(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_suppkey").agg(F.round(F.sum_distinct("l_quantity") / F.count_distinct("l_quantity"), 8).alias("mean_distinct"), F.count_distinct("l_partkey").alias("parts"))


@query("lineitem", sql="SELECT count(DISTINCT l_suppkey) + max(CASE WHEN l_suppkey IS NULL THEN 1 ELSE 0 END) AS level_paths FROM lineitem")
def distinct_count(lineitem: DataFrame) -> DataFrame:
    return lineitem.agg((F.count_distinct("l_suppkey") + F.max(F.when(F.col("l_suppkey").isNull(), 1).otherwise(0))).alias("level_paths"))


@query("lineitem", "part", sql=f"""
WITH r AS (SELECT p_brand, p_retailprice AS x, l_extendedprice AS y FROM {LP} WHERE p_retailprice <> 0),
f AS (SELECT p_brand, sum(x * y) / sum(x * x) AS b, sum(y * y) AS yy, sum(x * y) AS xy, sum(x * x) AS xx, sum(y) AS sy, count(*) AS n,
  regr_slope(log10(y), log10(x)) AS ls, regr_intercept(log10(y), log10(x)) AS li, regr_r2(log10(y), log10(x)) AS lr FROM r GROUP BY p_brand),
g AS (SELECT *, 1 - (yy - 2 * b * xy + b * b * xx) / (yy - sy * sy / n) AS r2 FROM f)
SELECT p_brand, CASE WHEN lr > r2 THEN 'power' ELSE 'origin' END AS kind, round(CASE WHEN lr > r2 THEN ls ELSE b END, 5) AS slope, round(CASE WHEN lr > r2 THEN lr ELSE r2 END, 5) AS r2 FROM g""")
def regression_origin_vs_log(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return agg.regression_choice(_lp(lineitem, part), ["p_brand"], "p_retailprice", "l_extendedprice").select("p_brand", "kind", F.round("slope", 5).alias("slope"), F.round("r2", 5).alias("r2"))


# --- moving windows -------------------------------------------------------------------------------------------------

_DAY = "date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE))"
_DAILY = f"""WITH d AS (SELECT l_suppkey, {_DAY} AS day, sum(l_quantity) AS len, sum(l_extendedprice) AS area, sum(l_discount * l_extendedprice) AS share_area,
  max(l_tax) AS high, min(l_tax) AS low, sum(CASE WHEN l_linenumber <> 1 THEN l_quantity END) AS known, sum(CASE WHEN l_linenumber <> 1 THEN l_quantity * l_tax END) AS known_sum FROM lineitem GROUP BY ALL)"""


def daily(lineitem: DataFrame) -> DataFrame:
    """Suppliers as streams, days as distance, quantity as length, price as area, discount as a proportion."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01"))
    rows = lineitem.withColumn("day", day)
    known = F.col("l_linenumber") != 1
    return win.per_distance(
        rows, "l_suppkey", "day",
        {"len": F.col("l_quantity"), "area": F.col("l_extendedprice"), "share_area": F.col("l_discount") * F.col("l_extendedprice"), "known": F.when(known, F.col("l_quantity")), "known_sum": F.when(known, F.col("l_quantity") * F.col("l_tax"))},
        {"low": F.col("l_tax")}, {"high": F.col("l_tax")},
    )


def _mw_sql(select: str, width: int = 60) -> str:
    return f"{_DAILY} SELECT l_suppkey, day, {select} FROM d WINDOW w AS (PARTITION BY l_suppkey ORDER BY day RANGE BETWEEN {width // 2} PRECEDING AND {width // 2} FOLLOWING)"


def _moving(lineitem: DataFrame, sums: list[str], mins: list[str] = (), maxs: list[str] = (), width: int = 60) -> DataFrame:
    return win.moving_window(daily(lineitem), "l_suppkey", "day", width, sums, mins, maxs)


def _out(df: DataFrame, **cols) -> DataFrame:
    return df.select("l_suppkey", "day", *(c.alias(n) for n, c in cols.items()))


@query("lineitem", sql=_mw_sql("round(sum(len) OVER w, 2) AS total"))
def mw_sum(lineitem: DataFrame) -> DataFrame:
    return _out(_moving(lineitem, ["len"]), total=F.round("mw_len", 2))


@query("lineitem", sql=_mw_sql("round(sum(area) OVER w * 1000 / nullif(sum(len) OVER w, 0), 2) AS per_km"))
def mw_sum_div_length(lineitem: DataFrame) -> DataFrame:
    return _out(_moving(lineitem, ["area", "len"]), per_km=F.round(win.per_length(F.col("mw_area"), F.col("mw_len"), per_km=True), 2))


@query("lineitem", sql=_mw_sql("round(least(sum(known) OVER w / nullif(sum(len) OVER w, 0), 0.8), 8) AS capped"))
def mw_sum_div_capped(lineitem: DataFrame) -> DataFrame:
    return _out(_moving(lineitem, ["known", "len"]), capped=F.round(win.per_length(F.col("mw_known"), F.col("mw_len"), most=0.8), 8))


@query("lineitem", sql=_mw_sql("round(sum(share_area) OVER w / nullif(sum(area) OVER w, 0), 8) AS proportion"))
def mw_proportion(lineitem: DataFrame) -> DataFrame:
    return _out(_moving(lineitem, ["share_area", "area"]), proportion=F.round(agg.ratio(F.col("mw_share_area"), F.col("mw_area")), 8))


@query("lineitem", sql=_mw_sql("round((max(high) OVER w - min(low) OVER w) / nullif(sum(len) OVER w, 0), 8) AS gradient"))
def mw_gradient(lineitem: DataFrame) -> DataFrame:
    m = _moving(lineitem, ["len"], ["low"], ["high"])
    return _out(m, gradient=F.round(win.gradient(F.col("mw_high"), F.col("mw_low"), F.col("mw_len")), 8))


@query("lineitem", sql=_mw_sql("round(sum(len) OVER w / nullif(sum(area) OVER w, 0), 8) AS ratio", 120))
def mw_ratio(lineitem: DataFrame) -> DataFrame:
    return _out(_moving(lineitem, ["len", "area"], width=120), ratio=F.round(agg.ratio(F.col("mw_len"), F.col("mw_area")), 8))


@query("lineitem", sql=_mw_sql("round((max(high) OVER w - min(low) OVER w) / nullif(sum(len) OVER w, 0) * max(high) OVER w * 0.0283168 * 9810.0, 4) AS power"))
def mw_power(lineitem: DataFrame) -> DataFrame:
    m = _moving(lineitem, ["len"], ["low"], ["high"])
    return _out(m, power=F.round(win.stream_power(win.gradient(F.col("mw_high"), F.col("mw_low"), F.col("mw_len")), F.col("mw_high")), 4))


@query("lineitem", sql=_mw_sql("round(sum(known_sum) OVER w / nullif(sum(known) OVER w, 0), 8) AS known_mean"))
def mw_sentinel(lineitem: DataFrame) -> DataFrame:
    return _out(_moving(lineitem, ["known_sum", "known"]), known_mean=F.round(agg.ratio(F.col("mw_known_sum"), F.col("mw_known")), 8))


@query("lineitem", sql=f"""{_DAILY}, a AS (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 20.0 WHEN l_suppkey % 3 = 1 THEN 40.0 ELSE 90.0 END AS width FROM d)
SELECT a.l_suppkey, a.day, count(*) AS members, round(sum(b.len), 2) AS len FROM a JOIN d b ON a.l_suppkey = b.l_suppkey AND b.day BETWEEN a.day - a.width / 2 AND a.day + a.width / 2 GROUP BY ALL""")
def range_join_window(lineitem: DataFrame) -> DataFrame:
    d = daily(lineitem).select("l_suppkey", "day", "len")
    size = F.pmod(F.col("l_suppkey"), F.lit(3))
    width = F.when(size == 0, 20.0).when(size == 1, 40.0).otherwise(90.0)
    bridge = win.window_members(d.select("l_suppkey", "day"), d, "l_suppkey", "day", width, 90.0)
    return bridge.groupBy("l_suppkey", F.col("anchor_day").alias("day")).agg(F.count(F.lit(1)).alias("members"), F.round(F.sum("len"), 2).alias("len"))


# --- formulas and curves --------------------------------------------------------------------------------------------


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, l_partkey, round(0.177 * pow(l_quantity, 0.397) * pow(l_extendedprice / 1000, 0.453), 6) AS width FROM lineitem")
def formula_power_law(lineitem: DataFrame) -> DataFrame:
    w = formula("0.177 * (a ^ 0.397) * (p ^ 0.453)", {"a": F.col("l_quantity"), "p": F.col("l_extendedprice") / 1000})
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(w, 6).alias("width"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_quantity < 5 OR l_quantity > 40 THEN 0.0 WHEN l_quantity <= 20 THEN 1 - (l_quantity - 5) * 0.4 / 15 ELSE 0.6 - (l_quantity - 20) * 0.6 / 20 END, 8) AS y FROM lineitem")
def piecewise_linear(lineitem: DataFrame) -> DataFrame:
    y = curves.curve("linear", F.col("l_quantity"), [(5, 1.0), (20, 0.6), (40, 0.0)])
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(y, 8).alias("y"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, l_partkey, round(exp(-0.1 * l_quantity) + 1 / (1 + l_discount), 8) AS y FROM lineitem")
def transform_function_exp(lineitem: DataFrame) -> DataFrame:
    y = formula("exp(-0.1 * a) + 1 / (1 + d)", {"a": F.col("l_quantity"), "d": F.col("l_discount")})
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(y, 8).alias("y"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, l_partkey, round(greatest(0.65 * l_discount * 10 + 0.35 * l_tax * 10, 0.995 * l_quantity / 50), 8) AS evidence FROM lineitem")
def evidence_greatest(lineitem: DataFrame) -> DataFrame:
    e = curves.evidence(F.col("l_discount") * 10, F.col("l_tax") * 10, F.col("l_quantity") / 50)
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(e, 8).alias("evidence"))


# --- cells ----------------------------------------------------------------------------------------------------------

_CELLS = "(SELECT vec_id AS row, i - 1 AS col, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, range(1, 65) t(i))"


def cells_of(embeddings: DataFrame) -> DataFrame:
    """Vectors as the rows of a raster."""
    return embeddings.select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "value")).withColumn("value", F.col("value").cast("double"))


@query("embeddings", sql=f"SELECT CAST(row // 50 AS BIGINT) AS zone, CASE WHEN value < 0 THEN 0 WHEN value < 0.1 THEN 1 ELSE 2 END AS value, count(*) AS n_cells, count(*) * 25.0 AS area FROM {_CELLS} GROUP BY ALL")
def zonal_counts(embeddings: DataFrame) -> DataFrame:
    c = cells_of(embeddings).select(F.floor(F.col("row") / 50).alias("zone"), filters.ladder(F.col("value"), [0.0, 0.1], [0, 1], "left", 2).alias("value"))
    return grid.zonal_counts(c, ["zone"], cell_area=25.0)


@query("embeddings", sql=f"SELECT CAST(row // 50 AS BIGINT) AS zone, round(avg(value), 7) AS mean, round(min(value), 7) AS min, round(max(value), 7) AS max, count(value) AS count FROM {_CELLS} WHERE value > -0.5 GROUP BY 1")
def zonal_statistics(embeddings: DataFrame) -> DataFrame:
    c = cells_of(embeddings).select(F.floor(F.col("row") / 50).alias("zone"), F.when(F.col("value") > -0.5, F.col("value")).alias("value"))
    return grid.zonal(c, ["zone"]).select("zone", *(F.round(x, 7).alias(x) for x in ("mean", "min", "max")), "count")


@query("embeddings", "part", sql=f"WITH k AS (SELECT p_size AS code, max(p_retailprice) AS new_value FROM part GROUP BY 1) SELECT row, col, new_value AS value FROM (SELECT row, col, CAST(floor(abs(value) * 100) AS INTEGER) AS code FROM {_CELLS}) c LEFT JOIN k USING (code)")
def reclass_join(embeddings: DataFrame, part: DataFrame) -> DataFrame:
    lookup = part.groupBy(F.col("p_size").alias("value")).agg(F.max("p_retailprice").alias("new_value"))
    return grid.reclass(cells_of(embeddings).withColumn("value", F.floor(F.abs("value") * 100).cast("int")), lookup)


@query("embeddings", sql="\nUNION ALL\n".join(f"SELECT CAST(row // 50 AS BIGINT) AS zone, CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (WHERE value >= {t}) AS n_cells, round(100.0 * count(*) FILTER (WHERE value >= {t}) / count(*), 6) AS pct FROM {_CELLS} GROUP BY 1" for t in (0.0, 0.1, 0.2)))
def threshold_area_pct(embeddings: DataFrame) -> DataFrame:
    c = cells_of(embeddings).withColumn("zone", F.floor(F.col("row") / 50))
    return grid.threshold_stats(c, ["zone"], [0.0, 0.1, 0.2], 25.0).select("zone", "threshold", "n_cells", F.round("pct", 6).alias("pct"))


# --- networks and geometry ------------------------------------------------------------------------------------------


@query("part", sql="""
WITH RECURSIVE e AS (SELECT CAST(p_partkey AS BIGINT) AS k, CAST(p_partkey // 2 AS BIGINT) AS nxt FROM part WHERE p_partkey > 1),
f AS (SELECT k AS up, nxt AS down FROM e UNION ALL SELECT f.up, e.nxt FROM f JOIN e ON f.down = e.k)
SELECT down AS k, count(*) AS n_up, CAST(sum(up) AS BIGINT) AS sum_up FROM f GROUP BY down""")
def recursive_closure(part: DataFrame) -> DataFrame:
    edges = part.filter("p_partkey > 1").select(F.col("p_partkey").cast("long").alias("k"), F.floor(F.col("p_partkey") / 2).alias("nxt"))
    return network.closure(edges, "k", "nxt").groupBy(F.col("down").alias("k")).agg(F.count(F.lit(1)).alias("n_up"), F.sum("up").alias("sum_up"))


_LATLON = "SELECT c_custkey, (c_custkey * 37 % 1800) / 10.0 - 90 AS lat, (c_custkey * 53 % 3600) / 10.0 - 180 AS lon FROM customer"


def _latlon(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", (F.col("c_custkey") * 37 % 1800 / 10.0 - 90).alias("lat"), (F.col("c_custkey") * 53 % 3600 / 10.0 - 180).alias("lon"))


@query("customer", sql=f"SELECT c_custkey, round(2 * 6371000.0 * asin(sqrt(pow(sin(radians(45 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(45)) * pow(sin(radians(-110 - lon) / 2), 2))), 2) AS metres, CAST(floor((lon + 180) / 6) + 1 + 32600 AS INTEGER) AS epsg FROM ({_LATLON})")
def haversine_distance(customer: DataFrame) -> DataFrame:
    d = geometry.haversine(F.col("lat"), F.col("lon"), F.lit(45.0), F.lit(-110.0))
    return _latlon(customer).select("c_custkey", F.round(d, 2).alias("metres"), geometry.utm_epsg(F.col("lon")).alias("epsg"))


_BOXES = "SELECT s_suppkey, (s_suppkey * 71 % 3500) / 10.0 - 180 AS xmin, (s_suppkey * 29 % 1700) / 10.0 - 90 AS ymin FROM supplier"


@query("customer", "supplier", sql=f"SELECT s_suppkey, c_custkey FROM ({_LATLON}) p JOIN ({_BOXES}) b ON lon BETWEEN xmin AND xmin + 12 AND lat BETWEEN ymin AND ymin + 9")
def grid_cell_spatial_join(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    points = _latlon(customer).select("c_custkey", F.col("lon").alias("x"), F.col("lat").alias("y"))
    boxes = supplier.select("s_suppkey", (F.col("s_suppkey") * 71 % 3500 / 10.0 - 180).alias("xmin"), (F.col("s_suppkey") * 29 % 1700 / 10.0 - 90).alias("ymin"))
    boxes = boxes.withColumn("xmax", F.col("xmin") + 12).withColumn("ymax", F.col("ymin") + 9)
    return joins.points_in_boxes(points, boxes, 10.0).select("s_suppkey", "c_custkey")


@query("customer", sql=f"SELECT c_custkey, lat BETWEEN 30 AND 50 AND lon BETWEEN -120 AND -100 AS inside FROM ({_LATLON})")
def point_in_box(customer: DataFrame) -> DataFrame:
    return _latlon(customer).select("c_custkey", (F.col("lat").between(30, 50) & F.col("lon").between(-120, -100)).alias("inside"))


@query("customer", sql=f"SELECT c_custkey, lat >= 30 AND lat < 50 AND lon < -120 + (lat - 30) * 20 / 20 AND NOT lon < -110 + (lat - 50) * -20 / -20 AS inside FROM ({_LATLON})")
def point_in_polygon(customer: DataFrame) -> DataFrame:
    """Left and lower edges belong to the ring, right and upper ones don't."""
    ring = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((-130, 30), (-120, 30), (-100, 50), (-110, 50))))
    return _latlon(customer).select("c_custkey", geometry.in_ring(F.col("lon"), F.col("lat"), ring).alias("inside"))


# --- event windows: an extension for streams, here over a table ------------------------------------------------------


@query("events", sql="SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 3) AS value FROM events GROUP BY ALL")
def tumbling_event_window(events: DataFrame) -> DataFrame:
    return events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")
