"""Queries over downstream-pointing networks.  The parts make a tree: part n drains to part n // 2, with its size as length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, network, windows
from .registry import query

_TREE = "tree AS (SELECT p_partkey AS id, nullif(p_partkey // 2, 0) AS next_id, CAST(p_size AS DOUBLE) AS len FROM part)"
_HEADS = """heads AS (SELECT id FROM tree WHERE id NOT IN (SELECT next_id FROM tree WHERE next_id IS NOT NULL)),
walk AS (SELECT h.id AS head, h.id AS at FROM heads h UNION ALL SELECT w.head, t.next_id FROM walk w JOIN tree t ON w.at = t.id WHERE t.next_id IS NOT NULL)"""


def tree(part: DataFrame) -> DataFrame:
    n = F.floor(F.col("p_partkey") / 2).cast("long")
    return part.select(F.col("p_partkey").alias("id"), F.nullif(n, F.lit(0)).alias("next_id"), F.col("p_size").cast("double").alias("len"))


@query("part", sql=f"""WITH RECURSIVE {_TREE},
flow AS (SELECT id, next_id, len, id AS node FROM tree UNION ALL SELECT f.id, t.next_id, f.len, t.id FROM flow f JOIN tree t ON f.next_id = t.id)
SELECT node AS id, sum(len) AS upstream FROM flow GROUP BY node""")
def upstream_area(part: DataFrame) -> DataFrame:
    return network.upstream_sum(tree(part), "id", "next_id", "len")


@query("part", sql=f"""WITH RECURSIVE {_TREE},
flow AS (SELECT id AS start, id, next_id, len FROM tree UNION ALL SELECT f.start, t.id, t.next_id, t.len FROM flow f JOIN tree t ON f.next_id = t.id)
SELECT start AS id, sum(len) AS total FROM flow GROUP BY start""")
def length_to_mouth(part: DataFrame) -> DataFrame:
    return network.length_to_mouth(tree(part), "id", "next_id", "len")


@query("part", sql=f"""WITH RECURSIVE {_TREE}, {_HEADS},
total AS (SELECT w.head, sum(t.len) AS total FROM walk w JOIN tree t ON w.at = t.id GROUP BY w.head),
ranked AS (SELECT head, row_number() OVER (ORDER BY total DESC, head) AS level_path FROM total)
SELECT w.at AS id, min(r.level_path) AS level_path FROM walk w JOIN ranked r USING (head) GROUP BY w.at""")
def level_path_ids(part: DataFrame) -> DataFrame:
    return network.level_paths(tree(part), "id", "next_id", "len")


@query("part", sql="""WITH RECURSIVE edges AS (SELECT p_partkey AS a, p_partkey + 1 AS b FROM part WHERE p_partkey % 7 <> 0),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.seen = e.a)
SELECT node, min(seen) AS component FROM reach GROUP BY node""")
def connected_components(part: DataFrame) -> DataFrame:
    edges = part.filter(F.col("p_partkey") % 7 != 0).select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("b"))
    return network.components(edges)


_POINTERS = "p AS (SELECT p_partkey AS node, CASE WHEN p_size % 10 = 0 THEN NULL ELSE (p_partkey * 7 + p_size) % (SELECT max(p_partkey) FROM part) + 1 END AS next FROM part)"


@query("part", sql=f"""WITH RECURSIVE {_POINTERS},
walk AS (SELECT node, node AS at FROM p UNION SELECT w.node, p.next FROM walk w JOIN p ON w.at = p.node WHERE p.next IS NOT NULL)
SELECT w.node, max(CASE WHEN p.next IS NULL THEN w.at END) AS ends_at, bool_and(p.next IS NOT NULL) AS cycle FROM walk w JOIN p ON w.at = p.node GROUP BY w.node""")
def pointer_trace(part: DataFrame) -> DataFrame:
    """Where following the pointers leads, and which nodes only run into a cycle."""
    largest = part.agg(F.max("p_partkey").alias("largest"))
    to = F.when(F.col("p_size") % 10 != 0, (F.col("p_partkey") * 7 + F.col("p_size")) % F.col("largest") + 1)
    nodes = part.crossJoin(F.broadcast(largest)).select(F.col("p_partkey").alias("node"), to.alias("next"))
    return network.pointer_ends(nodes).select("node", F.when(~F.col("cycle"), F.col("end")).alias("ends_at"), "cycle")


@query("lineitem", sql="SELECT l_quantity AS x, l_discount + 0.0 AS y, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def junction_points(lineitem: DataFrame) -> DataFrame:
    return network.junctions(lineitem.select(F.col("l_quantity").alias("x"), (F.col("l_discount") + 0.0).alias("y")))


@query("part", sql="""SELECT p_brand, count(*) AS n_reaches, sum(p_size) * 1.0 AS total_length, avg(p_size) AS mean_length, min(p_size) AS shortest, max(p_size) AS longest,
sum(p_size) / (sum(p_retailprice) / 1000.0) AS drainage_density FROM part GROUP BY p_brand""")
def network_statistics(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n_reaches"), F.sum(size).cast("double").alias("total_length"), F.avg(size).alias("mean_length"), F.min(size).alias("shortest"), F.max(size).alias("longest"),
        aggregates.ratio(F.sum(size).cast("double"), F.sum("p_retailprice") / 1000.0).alias("drainage_density"),
    )


@query("part", sql=f"""WITH {_TREE}, up AS (SELECT next_id AS id, count(*) AS n_up, max(len) AS longest_up FROM tree WHERE next_id IS NOT NULL GROUP BY next_id)
SELECT t.id, CASE WHEN n_up IS NULL THEN 'headwater' WHEN t.next_id IS NULL THEN 'mouth' WHEN n_up > 1 THEN 'confluence' ELSE 'middle' END AS kind, longest_up FROM tree t LEFT JOIN up USING (id)""")
def node_kinds(part: DataFrame) -> DataFrame:
    t = tree(part)
    up = t.filter("next_id is not null").groupBy(F.col("next_id").alias("id")).agg(F.count(F.lit(1)).alias("n_up"), F.max("len").alias("longest_up"))
    kind = F.when(F.col("n_up").isNull(), "headwater").when(F.col("next_id").isNull(), "mouth").when(F.col("n_up") > 1, "confluence").otherwise("middle")
    return t.join(up, "id", "left").select("id", kind.alias("kind"), "longest_up")


@query("part", sql=f"""WITH {_TREE} SELECT t.id, t.len, n.id AS next_reach, n.len AS next_len FROM tree t LEFT JOIN tree n ON n.id = t.next_id""")
def next_reach(part: DataFrame) -> DataFrame:
    t = tree(part)
    return t.join(t.select(F.col("id").alias("next_reach"), F.col("len").alias("next_len")), F.col("next_id") == F.col("next_reach"), "left").select("id", "len", "next_reach", "next_len")


@query("part", sql=f"""WITH {_TREE}, divergent AS (SELECT id, CASE WHEN id % 3 = 0 THEN 2 ELSE id % 2 END AS divergence, id // 2 AS dn_level, id // 4 AS level FROM tree)
SELECT t.id, CASE d.divergence WHEN 2 THEN d.dn_level ELSE d.level END AS level_path FROM tree t JOIN divergent d USING (id)""")
def key_conditional_join(part: DataFrame) -> DataFrame:
    """The value-added attributes of a reach: minor divergences take the level path downstream of them."""
    i = F.col("id")
    half = lambda n: F.floor(i / n).cast("long")
    vaa = tree(part).select(i.alias("v_id"), F.when(i % 3 == 0, 2).otherwise(i % 2).alias("divergence"), half(2).alias("dn_level"), half(4).alias("level"))
    return tree(part).join(vaa, i == F.col("v_id")).select("id", F.when(F.col("divergence") == 2, F.col("dn_level")).otherwise(F.col("level")).alias("level_path"))


@query("part", sql="""WITH r AS (SELECT p_partkey, p_size % 5 AS stream_size, CAST(p_size AS DOUBLE) * 60 AS step FROM part)
SELECT p_partkey, greatest(CASE stream_size WHEN 0 THEN 200 WHEN 1 THEN 400 WHEN 2 THEN 1200 WHEN 3 THEN 2000 ELSE 8000 END, 2 * step) * 1.0 AS width FROM r""")
def window_width_by_size(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", windows.window_width(F.col("p_size") % 5, F.col("p_size").cast("double") * 60).alias("width"))
