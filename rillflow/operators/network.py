"""Downstream-pointing networks: closures, upstream sums, level paths, components, junctions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Tasks among which the nodes of one label are dealt.
SLICES = 16


def closure(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(up, down, steps): every node with everything downstream of it, itself not included.

    Paths are doubled in each round: paths of up to 2^k steps are joined to each other, until no pair is added.  The
    result has one row per pair, so it is for lists of what lies downstream; sums along a network take ``upstream_sum``,
    which holds one row per node.
    """
    known = written(edges.filter(F.col(target).isNotNull() & (F.col(source) != F.col(target))).select(F.col(source).alias("up"), F.col(target).alias("down")).distinct().withColumn("steps", F.lit(1)))
    n = known.count()
    while True:
        more = known.join(known.select(F.col("up").alias("down"), F.col("down").alias("_d"), F.col("steps").alias("_s")), "down").select("up", F.col("_d").alias("down"), (F.col("steps") + F.col("_s")).alias("steps"))
        known = written(known.unionByName(more).filter("up <> down").groupBy("up", "down").agg(F.min("steps").alias("steps")))
        now = known.count()
        if now == n:
            return known
        n = now


def _doubled(nodes: DataFrame, own: Column, above: Column, both: Column) -> DataFrame:
    """(node, acc) for (node, next, value): ``acc`` gathers the values of a node and of all that drain to it.

    Before round k a node's ``acc`` covers what lies less than 2^k steps above it and its pointer leads 2^k steps down; the
    round sends ``acc`` along the pointer (combined by ``above``, joined to the node's own by ``both``) and doubles the
    pointer.  A tree n deep takes log2(n) rounds of one row per node.
    """
    state = written(nodes.select("node", "next", own.alias("acc")))
    moving = state.filter("next is not null").count()
    while moving:
        sent = state.filter("next is not null").groupBy(F.col("next").alias("node")).agg(above.alias("more"))
        to = state.select(F.col("node").alias("next"), F.col("next").alias("_next"))
        state = written(state.join(sent, "node", "left").join(to, "next", "left").select("node", F.col("_next").alias("next"), both.alias("acc")))
        left = state.filter("next is not null").count()
        if left == moving:
            raise ValueError("the network has a cycle")
        moving = left
    return state.select("node", "acc")


def upstream_sum(nodes: DataFrame, key: str, next_key: str, value: str) -> DataFrame:
    """(key, upstream): the value of a node and of all nodes that drain to it.  A null value counts as 0; a cycle is an
    error."""
    rows = nodes.select(F.col(key).alias("node"), F.col(next_key).alias("next"), F.coalesce(F.col(value), F.lit(0)).alias("value"))
    out = _doubled(rows, F.col("value"), F.sum("acc"), F.col("acc") + F.coalesce("more", F.lit(0)))
    return out.select(F.col("node").alias(key), F.col("acc").alias("upstream"))


def length_to_mouth(nodes: DataFrame, key: str, next_key: str, value: str) -> DataFrame:
    """(key, total): the value of a node and of all nodes downstream of it, by doubled pointers."""
    state = written(nodes.select(F.col(key).alias("node"), F.col(next_key).alias("next"), F.coalesce(F.col(value), F.lit(0)).alias("acc")))
    moving = state.filter("next is not null").count()
    while moving:
        to = state.select(F.col("node").alias("next"), F.col("next").alias("_next"), F.col("acc").alias("_acc"))
        state = written(state.join(to, "next", "left").select("node", F.col("_next").alias("next"), (F.col("acc") + F.coalesce("_acc", F.lit(0))).alias("acc")))
        left = state.filter("next is not null").count()
        if left == moving:
            raise ValueError("the network has a cycle")
        moving = left
    return state.select(F.col("node").alias(key), F.col("acc").alias("total"))


def pointer_ends(nodes: DataFrame) -> DataFrame:
    """(node, end, cycle) for (node, next): where following the pointers leads.

    A node without a next ends at itself.  Pointers are doubled, so round k ends the nodes up to 2^(k-1) steps from
    their end.  Of a path every node nearer to the end is there too, so once a round ends none, what still moves is on or
    leads to a cycle.
    """
    p = written(nodes.select("node", F.coalesce("next", "node").alias("at"), F.col("next").isNull().alias("done")))
    moving = p.filter("not done").count()
    while moving:
        to = p.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("done").alias("_done"))
        moved = p.filter("not done").join(to, "at").select("node", F.col("_at").alias("at"), F.col("_done").alias("done"))
        p = written(p.filter("done").unionByName(moved))
        left = p.filter("not done").count()
        if left == moving:
            break
        moving = left
    return p.select("node", F.col("at").alias("end"), (~F.col("done")).alias("cycle"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b): the smallest node that each node is linked with.

    Labels are passed along edges and then to the labels' own labels, so distances shrink with each round; rounds end
    when no label changes.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).filter("u <> v").distinct()
    both = written(both)
    label = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l")))
    while True:
        nearby = both.join(label.select(F.col("u").alias("v"), F.col("l").alias("lv")), "v").groupBy("u").agg(F.min("lv").alias("m"))
        best = label.join(nearby, "u").select("u", F.col("l").alias("old"), F.least("l", "m").alias("l"))
        # a label hooks onto the best label any of its members saw, then jumps
        # and so does the label that the node it names has by now, which halves the way that is left along a chain
        offers = best.select(F.col("old").alias("h"), "l").union(best.select(F.col("u").alias("h"), "l"))
        hook = offers.groupBy("h").agg(F.min("l").alias("hl")).filter("hl < h").join(best.select(F.col("l").alias("h")).distinct(), "h", "left_semi")
        # most nodes may carry one label: its row is there once per slice, and the nodes are dealt to the slices
        hook = hook.withColumn("hs", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
        jumped = best.withColumn("_s", F.pmod(F.xxhash64("u"), F.lit(SLICES)).cast("int")).join(hook, (F.col("l") == F.col("h")) & (F.col("_s") == F.col("hs")), "left").select("u", "old", F.least("l", F.coalesce("hl", "l")).alias("l"))
        now = written(jumped)
        label = now.select("u", "l")
        if now.filter("l <> old").isEmpty():
            return label.select(F.col("u").alias("node"), F.col("l").alias("component"))


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the row's number (from 1) in a total order, without a window over the whole table.

    Rows are range-partitioned and sorted; a row's number is its place in its partition and the rows of the partitions
    before, of which there are as many numbers as partitions.
    """
    rows = written(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    numbered = rows.withColumn("_part", part).join(F.broadcast(before), "_part")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(name))


def level_paths(reaches: DataFrame, key: str, next_key: str, length: str) -> DataFrame:
    """(key, level_path): paths are numbered by the length from their headwater to the mouth, longest first (of equal ones
    the smaller headwater); a reach belongs to the longest path through it."""
    heads = reaches.join(reaches.select(F.col(next_key).alias(key)).distinct(), key, "left_anti").select(key)
    order = ranked(length_to_mouth(reaches, key, next_key, length).join(heads, key, "left_semi"), [F.desc("total"), F.col(key)], "level_path")
    rows = reaches.select(F.col(key).alias("node"), F.col(next_key).alias("next")).join(order.select(F.col(key).alias("node"), "level_path"), "node", "left")
    out = _doubled(rows, F.col("level_path"), F.min("acc"), F.least("acc", "more"))
    return out.select(F.col("node").alias(key), F.col("acc").alias("level_path"))


def junctions(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Points at which more than one line ends."""
    return points.groupBy(x, y).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
