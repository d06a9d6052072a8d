"""Queries through sources and sinks: what is written below the shared folder is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from ..session import scratch_dir
from ..sources import tables
from ..streaming import landing
from .registry import query


@query("nation", "supplier", sql="SELECT s_suppkey, n_name, CASE WHEN n_name = 'NATION_3' THEN -1 ELSE n_regionkey END AS n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def csv_lookup(nation: DataFrame, supplier: DataFrame) -> DataFrame:
    path = scratch_dir(nation.sparkSession)
    tables.write_lookup(nation, path)
    lookup = tables.read_lookup(nation.sparkSession, path, "n_nationkey int, n_name string, n_regionkey int")
    lookup = tables.updated(lookup, "n_name", "NATION_3", "n_regionkey", -1)
    return supplier.join(F.broadcast(lookup), F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "n_name", "n_regionkey")


@query("events", sql="SELECT user_id AS site, min(value) AS min_value, max(value) AS max_value, count(*) FILTER (WHERE event_id % 7 <> 0) AS n FROM (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events) GROUP BY 1")
def tsv_readings(events: DataFrame) -> DataFrame:
    """Tab-separated readings, some of them no numbers: the extremes per site."""
    path = scratch_dir(events.sparkSession)
    rows = events.select(F.col("user_id").alias("site"), F.when(F.col("event_id") % 7 == 0, "Ice").otherwise(F.col("value").cast("string")).alias("reading"))
    tables.write_lookup(rows, path, "\t")
    return tables.extremes(tables.read_lookup(events.sparkSession, path, "site long, reading string", "\t"), "site", "reading")


@query("orders", sql="SELECT o_orderstatus AS status, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1")
def json_rollup(orders: DataFrame) -> DataFrame:
    path = scratch_dir(orders.sparkSession)
    rollup = orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    tables.write_rollup(rollup, path, ["status"])
    return tables.read_rollup(orders.sparkSession, path, "status string, metrics struct<n: long, total: double>")


@query("customer", sql="""SELECT c_custkey, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || CAST(c_custkey % 360 - 180 AS VARCHAR) || '.0,' || CAST(c_custkey % 180 - 90 AS VARCHAR) || '.0]},"properties":{"c_name":"' || c_name || '"}}' AS feature FROM customer""")
def geojson_features(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    at = F.array((k % 360 - 180).cast("double"), (k % 180 - 90).cast("double"))
    return customer.select("c_custkey", tables.geojson("Point", at, ["c_name"]).alias("feature"))


@query("customer", sql="SELECT c_custkey FROM customer WHERE c_custkey % 360 - 180 <= 40 AND c_custkey % 360 - 178 >= 10 AND c_custkey % 180 - 90 <= 20 AND c_custkey % 180 - 89 >= -30")
def layer_with_boxes(customer: DataFrame) -> DataFrame:
    """A layer written with a box per feature and read by a box."""
    x, y = (F.col("c_custkey") % 360 - 180).cast("double"), (F.col("c_custkey") % 180 - 90).cast("double")
    p = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    path = scratch_dir(customer.sparkSession)
    tables.write_layer(customer.select("c_custkey", F.array(p(x, y), p(x + 2, y + 1)).alias("line")), path, "line")
    return tables.read_layer(customer.sparkSession, path, (10.0, -30.0, 40.0, 20.0)).select("c_custkey")


@query("nation", sql="SELECT n_nationkey, n_name FROM nation")
def defined_table(nation: DataFrame) -> DataFrame:
    """A table defined by SQL over files that are there."""
    spark, path = nation.sparkSession, scratch_dir(nation.sparkSession)
    rows = nation.select("n_nationkey", "n_name")
    rows.write.parquet(path)
    name = f"rillflow_{path[-12:]}"
    spark.sql(tables.table_definition(rows, name, path, {"n_name": "the nation's name"}))
    found = spark.table(name).select("n_nationkey", "n_name")
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return found


@query("events", sql="SELECT user_id, arg_max(event_id, (event_id % 3, event_id)) AS event_id, arg_max(value, (event_id % 3, event_id)) AS value, max(event_id % 3) AS batch FROM events GROUP BY user_id")
def landing_merge(events: DataFrame) -> DataFrame:
    """A landing folder in three drops, merged by a stream after each: a later batch replaces what an earlier one brought, and
    within a batch the newest row of a user counts."""
    spark, base = events.sparkSession, scratch_dir(events.sparkSession)
    rows = events.select("user_id", "event_id", "value")
    for k in range(3):
        rows.filter(F.col("event_id") % 3 == k).coalesce(1).write.parquet(f"{base}/landing/drop={k}")
        landing.merge_landing(spark, f"{base}/landing/*", "user_id long, event_id long, value double", f"{base}/target", f"{base}/progress", ["user_id"], "event_id", stamp="batch", buckets=8).awaitTermination()
    return landing.read_target(spark, f"{base}/target").select("user_id", "event_id", "value", F.col("batch").cast("long").alias("batch"))


@query("orders", "lineitem", sql="SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def resume_unprocessed(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    done = lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.not_processed(orders, done, ["o_orderkey"]).select("o_orderkey", "o_custkey")
