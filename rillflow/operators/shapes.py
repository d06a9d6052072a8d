"""Shapes out of points and parts: convex hulls, lines chained from their parts, and gaps between lines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship, written
from .network import components, length_to_mouth
from .sets import union_all

#: Parts to which the points of one key are dealt before hulls are merged.
SLICES = 64


def hull_of(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise from the leftmost (lowest) one; points along a side are none.  One point
    is its own hull, points on one line have their two ends."""
    p = np.unique(points, axis=0)  # in the order of x and y
    if len(p) < 3:
        return p

    def chain(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out

    return np.array(chain(p)[:-1] + chain(p[::-1])[:-1])


def convex_hulls(points: DataFrame, keys: list[str], x: str = "x", y: str = "y", slices: int = SLICES) -> DataFrame:
    """(keys, place, x, y): the corners of each key's convex hull in order.

    The hull of hulls is the hull of all points: each task makes hulls of what it holds before anything moves, a key's points
    are then dealt to slices whose hulls are made next, and only these meet.  Points with a null coordinate say nothing.
    """
    ship(points.sparkSession)
    rows = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def local(frames):
        for frame in frames:
            parts = [own.iloc[[0] * len(h)].assign(x=h[:, 0], y=h[:, 1]) for _, own in frame.groupby(keys, dropna=False, sort=False) for h in [hull_of(own[["x", "y"]].to_numpy())]]
            yield pd.concat(parts) if parts else frame

    def merge(own: pd.DataFrame) -> pd.DataFrame:
        h = hull_of(own[["x", "y"]].to_numpy())
        return own.iloc[[0] * len(h)].assign(x=h[:, 0], y=h[:, 1])

    def last(own: pd.DataFrame) -> pd.DataFrame:
        out = merge(own)
        return out.assign(place=np.arange(len(out), dtype=np.int32))

    # rows of unlike keys are sorted together, so that a batch holds few keys
    some = rows.sortWithinPartitions(*keys).mapInPandas(local, kind)
    dealt = some.withColumn("_slice", F.pmod(F.xxhash64("x", "y"), F.lit(slices)))
    sliced = dealt.groupBy(*keys, "_slice").applyInPandas(merge, f"{kind}, _slice long").drop("_slice")
    return sliced.groupBy(*keys).applyInPandas(last, f"{kind}, place int").select(*keys, "place", "x", "y")


# --- lines from parts -------------------------------------------------------------------------------------------------


def chained(parts: DataFrame, part: str = "part", start: str = "a", end: str = "b") -> DataFrame:
    """(part, line, place, turned): parts (number, node at either end) joined to lines at the nodes where exactly two ends meet.

    A line is named by its smallest part.  It begins at the end of it whose last part has the smaller number, a loop with
    its smallest part, as that part runs; ``turned`` says that a part runs against its line.  Each part has two copies, one
    per direction, linked where lines go on, and both copies of a line are ranked by doubled pointers, so a line of
    n parts takes log2(n) rounds and is never one task.  A part that begins and ends at one node is a line of its own.
    """
    rows = parts.select(F.col(part).cast("long").alias("part"), F.col(start).alias("a"), F.col(end).alias("b"))
    # way 2 p runs from a to b and way 2 p + 1 back
    ways = rows.select((F.col("part") * 2).alias("way"), F.col("a").alias("from"), F.col("b").alias("to")).unionByName(rows.select((F.col("part") * 2 + 1).alias("way"), F.col("b").alias("from"), F.col("a").alias("to")))
    ways = written(ways)
    through = ways.groupBy(F.col("from").alias("node")).agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select("node")
    goes = ways.join(through, F.col("to") == F.col("node")).select("way", "to")
    onward = ways.select(F.col("from").alias("_from"), F.col("way").alias("next"))
    # of the two ways that leave the node one is the way back
    linked = goes.join(onward, F.col("to") == F.col("_from")).filter(F.col("next").bitwiseXOR(F.lit(1).cast("long")) != F.col("way")).select("way", "next")
    linked = written(ways.select("way").join(linked, "way", "left"))
    pairs = linked.filter("next is not null").select(F.floor(F.col("way") / 2).alias("a"), F.floor(F.col("next") / 2).alias("b")).filter("a <> b").distinct()
    line = written(rows.select("part").join(components(pairs).select(F.col("node").alias("part"), "component"), "part", "left").select("part", F.coalesce("component", "part").alias("line")))
    # a loop has no end: it is cut before its smallest part, in either direction
    ends = linked.filter("next is null").select(F.floor(F.col("way") / 2).alias("part")).distinct().join(line, "part").select("line").distinct()
    loops = line.select("line").distinct().join(ends, "line", "left_anti").select((F.col("line") * 2).alias("_first"))
    cut = linked.join(loops, F.col("next") == F.col("_first"), "left").withColumn("next", F.when(F.col("_first").isNull(), F.col("next"))).drop("_first")
    back = loops.select((F.col("_first") + 1).alias("_last"))
    cut = written(cut.join(back, F.col("way") == F.col("_last"), "left").withColumn("next", F.when(F.col("_last").isNull(), F.col("next"))).drop("_last"))
    left = written(length_to_mouth(cut.withColumn("one", F.lit(1).cast("long")), "way", "next", "one").withColumn("part", F.floor(F.col("way") / 2)).join(line, "part"))
    # no way leads to the first one of either direction; the line takes the direction with the smaller one
    heads = left.join(cut.filter("next is not null").select(F.col("next").alias("way")), "way", "left_anti")
    starts = heads.groupBy("line").agg(F.min("way").alias("way"), F.max("total").alias("_n")).select("way", "line", "_n")
    of = _walked(cut, starts)
    return left.join(of, ["way", "line"]).select(F.col("part").alias(part), "line", (F.col("_n") - F.col("total")).alias("place"), (F.col("way") % 2 == 1).alias("turned"))


def _walked(cut: DataFrame, starts: DataFrame) -> DataFrame:
    """(way, line, _n) of all ways that follow the given ones: what lies 2^k ways on is known in round k."""
    known = written(starts)
    jump = cut.filter("next is not null")
    while not jump.isEmpty():
        known = written(known.unionByName(known.join(jump, "way").select(F.col("next").alias("way"), "line", "_n")).distinct())
        jump = written(jump.join(jump.select(F.col("way").alias("next"), F.col("next").alias("_n2")), "next").select("way", F.col("_n2").alias("next")))
    return known


# --- gaps between lines -----------------------------------------------------------------------------------------------

#: Free ends that a cell of the finest grid has at most, about, and the halvings of a limit that are tried for it.
CELL_ENDS, HALVINGS = 64, 24


def bridges(parts: DataFrame, key: str, limit: str, part: str = "part") -> DataFrame:
    """(key, from_part, from_end, to_part, to_end, gap): what closes the gaps between lines of one key.

    ``parts`` has a number of its own for each part, its ends ``ax, ay`` and ``bx, by`` and its key's ``limit``.  A free end is one
    that meets no other end.  Of all free ends of two lines the nearest two are bridged, then the nearest two of what is left, as
    long as they are nearer than the limit; both ends of one line are never bridged, and of equal gaps that of the smaller parts
    comes first.  ``from_end`` and ``to_end`` are 0 for an end ``a`` and 1 for an end ``b``.  Null coordinates and limits close nothing.

    A pair that is the nearest of either line is bridged whatever happens elsewhere, so each round bridges all such pairs at
    once, and as many lines are left fewer.  The grid begins with cells so small that they hold few ends, and doubles when no gap
    of a cell's size is left: then the free ends of unlike lines are a cell apart, so cells stay as thin and no round compares all
    ends of a key.
    """
    k = F.col(key)
    rows = parts.select(k.alias("key"), F.col(part).cast("long").alias("part"), *(F.col(c).cast("double").alias(c) for c in ("ax", "ay", "bx", "by")), F.col(limit).cast("double").alias("limit"))
    rows = written(rows)
    node = lambda s: F.struct("key", F.col(f"{s}x").alias("x"), F.col(f"{s}y").alias("y"))
    line = chained(rows.select("part", node("a").alias("a"), node("b").alias("b"))).select("part", "line")
    ends = F.explode(F.array(*(F.struct((F.col("part") * 2 + i).alias("end"), F.col(f"{s}x").alias("x"), F.col(f"{s}y").alias("y")) for i, s in enumerate("ab"))))
    every = rows.select("key", "part", "limit", ends.alias("e")).select("key", "part", "limit", "e.end", "e.x", "e.y")
    alone = every.groupBy("key", "x", "y").agg(F.count(F.lit(1)).alias("n"), F.min("end").alias("end"), F.min("part").alias("part"), F.min("limit").alias("limit"))
    alone = alone.filter((F.col("n") == 1) & F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("limit") > 0))
    free = written(alone.join(line, "part").select("key", "line", "end", "x", "y", "limit"))

    cell = lambda c, halved: F.floor(F.col(c) / (F.col("limit") / F.pow(F.lit(2.0), halved))).cast("long")
    tried = free.withColumn("halved", F.explode(F.sequence(F.lit(0), F.lit(HALVINGS))))
    counts = tried.groupBy("halved", "key", cell("x", F.col("halved")).alias("cx"), cell("y", F.col("halved")).alias("cy")).count()
    most = dict(counts.groupBy("halved").agg(F.max("count").alias("n")).collect())  # a number per halving
    found = []
    for halved in range(min((h for h, n in most.items() if n <= CELL_ENDS), default=HALVINGS), -1, -1):
        while True:
            closed = written(_nearest_of_both(free, F.lit(halved), cell))
            if closed.isEmpty():
                break
            found.append(closed)
            used = closed.select(F.explode(F.array("lo", "hi")).alias("end"))
            names = closed.select(F.explode(F.array("lo_line", "hi_line")).alias("line"), F.least("lo_line", "hi_line").alias("_line"))
            free = written(free.join(used, "end", "left_anti").join(names, "line", "left").withColumn("line", F.coalesce("_line", "line")).drop("_line"))
    if not found:
        found = [written(_nearest_of_both(free.limit(0), F.lit(0), cell))]
    of = lambda c: (F.floor(F.col(c) / 2).alias(f"{'from' if c == 'lo' else 'to'}_part"), (F.col(c) % 2).cast("int").alias(f"{'from' if c == 'lo' else 'to'}_end"))
    return union_all(found).select(F.col("key").alias(key), *of("lo"), *of("hi"), "gap")


def _nearest_of_both(free: DataFrame, halved: Column, cell) -> DataFrame:
    """(key, gap, lo, hi, lo_line, hi_line): pairs of ends nearer than a cell's size that are the nearest of either line."""
    size = F.col("limit") / F.pow(F.lit(2.0), halved)
    stored = free.select("key", F.col("line").alias("_line"), F.col("end").alias("_end"), F.col("x").alias("_x"), F.col("y").alias("_y"), cell("x", halved).alias("cx"), cell("y", halved).alias("cy"))
    beside = [F.struct((cell("x", halved) + i).alias("cx"), (cell("y", halved) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    asked = free.withColumn("size", size).withColumn("c", F.explode(F.array(*beside))).select("key", "line", "end", "x", "y", "size", "c.cx", "c.cy")
    dx, dy = F.col("x") - F.col("_x"), F.col("y") - F.col("_y")
    near = asked.join(stored, ["key", "cx", "cy"]).filter("line <> _line").withColumn("gap", F.sqrt(dx * dx + dy * dy)).filter("gap < size")
    first = F.col("end") < F.col("_end")
    pair = F.struct("gap", F.least("end", "_end").alias("lo"), F.greatest("end", "_end").alias("hi"), F.when(first, F.col("line")).otherwise(F.col("_line")).alias("lo_line"), F.when(first, F.col("_line")).otherwise(F.col("line")).alias("hi_line"))
    best = near.groupBy("key", "line").agg(F.min(pair).alias("p"))
    return best.groupBy("key", "p").agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select("key", "p.*")


def closed_lines(parts: DataFrame, key: str, pairs: DataFrame, part: str = "part") -> DataFrame:
    """(key, part, line): parts, with gaps closed by the ``bridges`` given, by the line they belong to, named by its smallest part."""
    rows = written(parts.select(F.col(key).alias("key"), F.col(part).cast("long").alias("part"), *(F.col(c).cast("double").alias(c) for c in ("ax", "ay", "bx", "by"))))
    node = lambda s: F.struct("key", F.col(f"{s}x").alias("x"), F.col(f"{s}y").alias("y"))
    line = written(chained(rows.select("part", node("a").alias("a"), node("b").alias("b"))).select("part", "line"))
    of = lambda side: pairs.select(F.col("from_part"), F.col("to_part")).join(line, F.col(f"{side}_part") == F.col("part")).select("from_part", "to_part", F.col("line").alias(side))
    linked = of("from").join(of("to"), ["from_part", "to_part"]).select(F.col("from").alias("a"), F.col("to").alias("b"))
    joined = components(linked).select(F.col("node").alias("line"), "component")
    out = rows.select("key", "part").join(line, "part").join(joined, "line", "left")
    return out.select(F.col("key").alias(key), F.col("part").alias(part), F.coalesce("component", "line").alias("line"))
