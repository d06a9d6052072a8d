"""Queries of filters, rules, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import dam_risk
from ..operators import filters, joins, sets, windows
from ..operators.aggregates import share_of_everything, share_of_total
from .registry import query


@query("orders", sql="SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 100000")
def scan_filter_in(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderstatus").isin("F", "O") & (F.col("o_totalprice") > 100000)).select("o_orderkey", "o_orderstatus")


@query("part", sql="SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%'")
def filter_prefix_like(part: DataFrame) -> DataFrame:
    return part.filter(F.col("p_brand").startswith("Brand#1")).select("p_partkey", "p_brand")


@query("lineitem", sql="SELECT l_orderkey, l_quantity, nullif(l_discount, 0) AS discount FROM lineitem WHERE nullif(l_discount, 0) IS NOT NULL AND l_quantity IS NOT NULL")
def filter_notnull_conj(lineitem: DataFrame) -> DataFrame:
    rows = lineitem.withColumn("discount", F.nullif(F.col("l_discount"), F.lit(0.0)))
    return filters.complete_rows(rows, "l_orderkey", ["l_quantity", "discount"])


@query("orders", sql="SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 50000 AND 60000")
def filter_between(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_totalprice").between(50000, 60000)).select("o_orderkey")


@query("customer", sql="""
WITH codes AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code FROM customer),
p AS (SELECT DISTINCT code, substr(code, 1, n) AS prefix FROM codes, (VALUES (8), (6), (4), (2)) v(n)),
k AS (SELECT prefix, count(*) AS n_rows FROM p GROUP BY prefix HAVING count(*) >= 20)
SELECT code, max_by(prefix, length(prefix)) AS prefix, max_by(n_rows, length(prefix)) AS n_rows FROM p JOIN k USING (prefix) GROUP BY code""")
def filter_prefix_backoff(customer: DataFrame) -> DataFrame:
    codes = customer.select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"))
    return filters.longest_prefix_with(codes, "code", [8, 6, 4, 2], 20)


_RISK = """CASE WHEN l_tax <= 0.01 THEN 'Considerable Risk'
  WHEN p_size IS NULL OR l_quantity IS NULL THEN 'Negligible Risk'
  WHEN least(l_quantity * 10, p_size * 8) <= 30 OR p_size * 2 >= 66 THEN CASE WHEN l_discount * 100 >= 5 THEN 'Considerable Risk' ELSE 'Some Risk' END
  WHEN least(l_quantity * 10, p_size * 8) <= 100 THEN CASE WHEN l_discount * 100 >= 5 THEN 'Some Risk' ELSE 'Minor Risk' END
  WHEN least(l_quantity * 10, p_size * 8) <= 300 OR p_size * 2 >= 33 THEN 'Minor Risk'
  ELSE 'Negligible Risk' END"""


@query("lineitem", "part", sql=f"SELECT {_RISK} AS risk, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def rule_ladder_risk(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    j = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    risk = dam_risk(F.col("l_discount") * 100, F.col("p_size") * 2, F.when(F.col("l_tax") <= 0.01, 0), F.col("l_quantity") * 10, F.col("p_size") * 8.0, F.lit(None).cast("double"))
    return j.groupBy(risk.alias("risk")).agg(F.count(F.lit(1)).alias("n"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 40 THEN 'canal' WHEN l_discount > 0.05 THEN 'intermittent' WHEN l_tax > 0.04 THEN 'perennial' ELSE 'other' END AS kind FROM lineitem")
def rule_ladder_last_wins(lineitem: DataFrame) -> DataFrame:
    kind = filters.last_wins([(F.col("l_tax") > 0.04, "perennial"), (F.col("l_discount") > 0.05, "intermittent"), (F.col("l_quantity") > 40, "canal")], "other")
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", kind.alias("kind"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, l_partkey, least(greatest(l_quantity, 5.0), 45.0) AS clamped FROM lineitem")
def clamp_range(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", filters.clamp(F.col("l_quantity"), 5.0, 45.0).alias("clamped"))


@query("customer", sql="SELECT c_custkey, coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0.01) AS balance FROM customer")
def null_fill(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", F.coalesce(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")), F.lit(0.01)).alias("balance"))


@query("customer", "nation", sql="SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_inner_view(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


@query("customer", "nation", "region", sql="SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20 LEFT JOIN region ON n_regionkey = r_regionkey")
def join_left_star(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    n = nation.filter("n_nationkey < 20")
    return customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("c_custkey", "n_name", "r_name")


@query("orders", sql="SELECT o_orderpriority, round(sum(o_totalprice), 1) AS o_totalprice, round(sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders), 8) AS share FROM orders GROUP BY o_orderpriority")
def join_cross_total(orders: DataFrame) -> DataFrame:
    return share_of_everything(orders, ["o_orderpriority"], "o_totalprice").select("o_orderpriority", F.round("o_totalprice", 1).alias("o_totalprice"), F.round("share", 8).alias("share"))


@query("nation", "region", sql="SELECT n_nationkey, r.r_regionkey, coalesce(o.n_nationkey * 10, r.r_regionkey) AS value FROM (SELECT n_nationkey FROM nation) a CROSS JOIN region r LEFT JOIN (SELECT n_nationkey AS k, n_nationkey, n_regionkey FROM nation WHERE n_nationkey % 2 = 0) o ON o.k = a.n_nationkey AND o.n_regionkey = r.r_regionkey".replace("SELECT n_nationkey, r.", "SELECT a.n_nationkey, r."))
def join_cartesian_left_override(nation: DataFrame, region: DataFrame) -> DataFrame:
    every = nation.select("n_nationkey").crossJoin(F.broadcast(region.select("r_regionkey", F.col("r_regionkey").alias("value"))))
    override = nation.filter("n_nationkey % 2 = 0").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"), (F.col("n_nationkey") * 10).alias("by"))
    return joins.with_override(every, override, ["n_nationkey", "r_regionkey"], "value", "by")


@query("lineitem", sql="SELECT a.l_orderkey, a.l_linenumber, a.n, b.q FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) a JOIN (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY ALL) b USING (l_orderkey, l_linenumber)")
def join_composite_key(lineitem: DataFrame) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).join(lineitem.groupBy(*keys).agg(F.max("l_quantity").alias("q")), keys)


@query("customer", "orders", sql="SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def join_semi_exists(customer: DataFrame, orders: DataFrame) -> DataFrame:
    return customer.join(orders.filter("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("customer", "orders", sql="SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def join_anti_missing(customer: DataFrame, orders: DataFrame) -> DataFrame:
    done = orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.not_processed(customer.select("c_custkey"), done, ["c_custkey"])


@query("events", sql="""
WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS second, event_type FROM events),
l AS (SELECT event_id, user_id, second FROM e WHERE event_type = 'purchase'), r AS (SELECT DISTINCT user_id, second AS near_second FROM e WHERE event_type = 'click'),
n AS (SELECT event_id, near_second, abs(second - near_second) AS distance FROM l JOIN r USING (user_id) WHERE abs(second - near_second) <= 86400
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY abs(second - near_second), near_second) = 1)
SELECT l.event_id, l.user_id, l.second, n.near_second, n.distance FROM l LEFT JOIN n USING (event_id)""")
def nearest_key_join(events: DataFrame) -> DataFrame:
    second = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    e = events.select("event_id", "user_id", second.alias("second"), "event_type")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "second")
    right = e.filter("event_type = 'click'").select("user_id", "second").distinct()
    return joins.nearest_key(left, right, ["user_id"], "second", "second", 86400)


_DAYS = "SELECT DISTINCT l_suppkey, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS day FROM lineitem"


@query("lineitem", sql=f"SELECT l_suppkey, day, lag(day) OVER w AS before, lead(day) OVER w AS behind FROM ({_DAYS}) WINDOW w AS (PARTITION BY l_suppkey ORDER BY day)")
def adjacency_window_lag_lead(lineitem: DataFrame) -> DataFrame:
    days = lineitem.select("l_suppkey", F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01")).alias("day")).distinct()
    return windows.neighbours(days.withColumn("at", F.col("day")), "l_suppkey", "at", "day", 365.0).select("l_suppkey", "day", "before", "behind")


@query("lineitem", "part", sql="""
SELECT l_suppkey, p_type, round(sum(l_extendedprice), 1) AS l_extendedprice, round(sum(l_extendedprice) / sum(sum(l_extendedprice)) OVER (PARTITION BY l_suppkey), 8) AS share
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_type""")
def share_of_total_by_class(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    j = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return share_of_total(j, ["l_suppkey"], ["p_type"], "l_extendedprice").select("l_suppkey", "p_type", F.round("l_extendedprice", 1).alias("l_extendedprice"), F.round("share", 8).alias("share"))


@query("supplier", "customer", sql="""
SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def union_by_name(supplier: DataFrame, customer: DataFrame) -> DataFrame:
    s = supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    c = customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return sets.union_all([s, c])


@query("supplier", "customer", sql="SELECT s_nationkey AS nationkey FROM supplier UNION SELECT c_nationkey FROM customer")
def distinct_union(supplier: DataFrame, customer: DataFrame) -> DataFrame:
    return sets.union_all([supplier.select(F.col("s_nationkey").alias("nationkey")), customer.select(F.col("c_nationkey").alias("nationkey"))]).distinct()


@query("orders", sql="""
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey
UNION ALL SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)), max(o_orderdate) FROM orders
WHERE o_orderstatus <> 'O' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') GROUP BY o_custkey""")
def upsert_latest(orders: DataFrame) -> DataFrame:
    rows = orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return sets.upsert(rows.filter("o_orderstatus <> 'O'").drop("o_orderstatus"), rows.filter("o_orderstatus = 'O'").drop("o_orderstatus"), ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_orderdate")


@query("part", "lineitem", sql="SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def overlay_difference_anti(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    return sets.difference(part.select("p_partkey", "p_name"), lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), ["p_partkey"])


@query("orders", sql="SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_match(orders: DataFrame) -> DataFrame:
    return sets.first_by(orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("part", sql="""
WITH p AS (SELECT substr(p_brand, 1, 7) AS code, p_brand AS k, p_size AS v FROM part UNION ALL SELECT substr(p_brand, 1, 7), substr(p_brand, 1, 7), 0 FROM part)
SELECT code, arg_max(v, (length(k), k, v)) AS value FROM p GROUP BY code""")
def last_wins_by_key_length(part: DataFrame) -> DataFrame:
    code = F.substring("p_brand", 1, 7)
    rows = part.select(code.alias("code"), F.col("p_brand").alias("k"), F.col("p_size").alias("v")).union(part.select(code, code, F.lit(0)))
    return rows.groupBy("code").agg(F.max_by("v", F.struct(F.length("k"), "k", "v")).alias("value"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 30")
def topk_area(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(30)


@query("lineitem", sql=f"""
WITH d AS ({_DAYS}), r AS (SELECT l_suppkey, day, row_number() OVER (PARTITION BY l_suppkey ORDER BY day) AS k FROM d)
SELECT l_suppkey, max(day) FILTER (WHERE k = 2) - min(day) FILTER (WHERE k = 1) AS spacing FROM r GROUP BY l_suppkey""")
def two_smallest_spacing(lineitem: DataFrame) -> DataFrame:
    from ..operators.windows import spacing

    days = lineitem.select("l_suppkey", F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01")).alias("day"))
    return spacing(days, "l_suppkey", "day")


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_key_check(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("lineitem", sql="""
SELECT 'quantity' AS rule, count(*) FILTER (WHERE NOT (l_quantity BETWEEN 1 AND 45)) AS n FROM lineitem
UNION ALL SELECT 'discount', count(*) FILTER (WHERE NOT (l_discount <= 0.07)) FROM lineitem
UNION ALL SELECT 'flag', count(*) FILTER (WHERE NOT (l_returnflag IN ('A', 'R'))) FROM lineitem""")
def constraint_violations(lineitem: DataFrame) -> DataFrame:
    from .quality import violations

    return violations(lineitem, {"quantity": F.col("l_quantity").between(1, 45), "discount": F.col("l_discount") <= 0.07, "flag": F.col("l_returnflag").isin("A", "R")})


@query("customer", sql="SELECT c_custkey, substr(c_name, 1, 8) AS prefix8, substr(c_name, 1, 4) AS prefix4, lower(replace(c_mktsegment, ' ', '_')) AS slug FROM customer")
def string_prefix_codes(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", F.substring("c_name", 1, 8).alias("prefix8"), F.substring("c_name", 1, 4).alias("prefix4"), F.lower(F.regexp_replace("c_mktsegment", " ", "_")).alias("slug"))


@query("part", sql="SELECT p_partkey, regexp_extract(p_brand, '#([0-9])([0-9])', 1) AS major, regexp_extract(p_brand, '#([0-9])([0-9])', 2) AS minor FROM part")
def regexp_extract_parts(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", F.regexp_extract("p_brand", "#([0-9])([0-9])", 1).alias("major"), F.regexp_extract("p_brand", "#([0-9])([0-9])", 2).alias("minor"))


@query("part", sql="SELECT p_type, min(p_brand || ' ' || p_name) AS name_min, count(*) > 1 AS multi FROM part GROUP BY p_type")
def concat_min_name(part: DataFrame) -> DataFrame:
    return part.groupBy("p_type").agg(F.min(F.concat_ws(" ", "p_brand", "p_name")).alias("name_min"), (F.count(F.lit(1)) > 1).alias("multi"))


@query("orders", sql="SELECT o_orderkey, nullif(trim(replace(o_orderstatus, 'P', ' ')), '') AS status FROM orders")
def empty_to_null(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", filters.empty_to_null(F.regexp_replace("o_orderstatus", "P", " ")).alias("status"))


@query("events", sql="SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k, count(*) AS n FROM events GROUP BY event_type")
def json_field_sum(events: DataFrame) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return events.groupBy("event_type").agg(F.sum(k).alias("k"), F.count(F.lit(1)).alias("n"))


@query("embeddings", sql="SELECT vec_id, round(list_sum(list_transform(list_filter(embedding, lambda x: x > 0), lambda x: CAST(x AS DOUBLE))) / list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))), 6) AS share FROM embeddings")
def array_share(embeddings: DataFrame) -> DataFrame:
    e = F.transform("embedding", lambda x: x.cast("double"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return embeddings.select("vec_id", F.round(total(F.filter(e, lambda x: x > 0)) / total(F.transform(e, lambda x: F.abs(x))), 6).alias("share"))


@query("events", sql="SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, month(ts) IN (7, 8, 9) AS summer, count(*) AS n, round(sum(value), 3) AS value FROM events GROUP BY ALL")
def date_parts_window(events: DataFrame) -> DataFrame:
    return events.groupBy(F.date_trunc("hour", "ts").alias("hour"), F.month("ts").isin(7, 8, 9).alias("summer")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("value"))


@query("orders", sql="SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(strftime(o_orderdate, '%j') AS INTEGER) AS julian FROM orders")
def parse_date_tokens(orders: DataFrame) -> DataFrame:
    # the token is written as scene names have it, A<year><day of year>, and read back
    token = F.concat(F.lit("A"), F.date_format("o_orderdate", "yyyyDDD"))
    day = F.to_date(F.regexp_extract(token, "A([0-9]{7})", 1), "yyyyDDD")
    return orders.select("o_orderkey", day.alias("day"), F.dayofyear(day).alias("julian"))
