"""Rings out of edges: outlines of raster regions and dissolved polygons.

Edges are rows (keys, x0, y0, x1, y1) with the inside on the left.  An edge that two polygons share stands there once in
either sense and goes in one aggregation over the undirected edge.  What is left is linked: an edge leads to the one that begins
where it ends, and where several do, to the one with the sharpest turn to the right or to the left, as regions that only touch
at a corner are to be one ring or two.  Rings are numbered by doubled pointers, their edges by the distance to the ring's
first edge along doubled pointers too, so a ring of n edges takes 2 log2(n) rounds and is never one task; whether a ring is
a hole is told by the sign of its area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .network import length_to_mouth

ENDS = ("x0", "y0", "x1", "y1")


def region_edges(labelled: DataFrame, region: str = "region") -> DataFrame:
    """(region, x0, y0, x1, y1) of the four sides of each cell (row, col, region), rows upwards."""
    r, c = F.col("row").cast("double"), F.col("col").cast("double")
    corners = [(c, r), (c + 1, r), (c + 1, r + 1), (c, r + 1)]
    sides = F.array(*(F.struct(a.alias("x0"), b.alias("y0"), d.alias("x1"), e.alias("y1")) for (a, b), (d, e) in zip(corners, corners[1:] + corners[:1], strict=True)))
    return labelled.select(region, F.explode(sides).alias("e")).select(region, *(F.col(f"e.{x}") for x in ENDS))


def dissolved(edges: DataFrame, keys: list[str]) -> DataFrame:
    """The edges that remain of polygons with the same keys, once what they share in opposite senses has gone.  Shared
    borders must have their corners in common, and the polygons must not overlap."""
    forward = (F.col("x0") < F.col("x1")) | ((F.col("x0") == F.col("x1")) & (F.col("y0") < F.col("y1")))
    one = lambda a, b: F.when(forward, F.col(a)).otherwise(F.col(b))
    way = [one("x0", "x1").alias("ax"), one("y0", "y1").alias("ay"), one("x1", "x0").alias("bx"), one("y1", "y0").alias("by")]
    left = edges.filter("x0 <> x1 or y0 <> y1").groupBy(*keys, *way).agg(F.sum(F.when(forward, 1).otherwise(-1)).alias("n")).filter("n <> 0")
    ahead = F.col("n") > 0
    end = lambda a, b, name: F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(name)
    return left.select(*keys, end("ax", "bx", "x0"), end("ay", "by", "y0"), end("bx", "ax", "x1"), end("by", "ay", "y1"))


def _turn(touching_apart: bool) -> Column:
    """How soon a next edge is met when turning from the way back, clockwise or counter-clockwise: the smaller the sharper."""
    came, goes = F.atan2(F.col("y0") - F.col("y1"), F.col("x0") - F.col("x1")), F.atan2(F.col("n_y1") - F.col("y1"), F.col("n_x1") - F.col("x1"))
    turn = F.pmod(came - goes if touching_apart else goes - came, F.lit(2 * 3.141592653589793))
    return F.when(turn < 1e-12, 7.0).otherwise(F.round(turn, 9))


def linked(edges: DataFrame, keys: list[str], touching_apart: bool = True) -> DataFrame:
    """Adds (edge, ring, place): a number, the number of the ring's first edge, and the place in the ring from 0 on.

    With ``touching_apart`` parts that touch at a corner get rings of their own (regions of four neighbours), else one ring
    runs through both (eight neighbours).  Edges that lead nowhere are an error.
    """
    rows = written(edges.withColumn("edge", F.monotonically_increasing_id()))
    after = rows.select(*(F.col(k).alias(f"n_{k}") for k in keys), F.col("x0").alias("n_x0"), F.col("y0").alias("n_y0"), F.col("x1").alias("n_x1"), F.col("y1").alias("n_y1"), F.col("edge").alias("n_edge"))
    meets = (F.col("x1") == F.col("n_x0")) & (F.col("y1") == F.col("n_y0"))
    for k in keys:
        meets = meets & F.col(k).eqNullSafe(F.col(f"n_{k}"))
    succ = written(rows.join(after, meets).groupBy("edge").agg(F.min_by("n_edge", F.struct(_turn(touching_apart), F.col("n_edge"))).alias("next")))
    if succ.agg(F.count_distinct("next")).first()[0] != rows.count():
        raise ValueError("edges that don't close to rings")
    state, moved = written(succ.select("edge", "next", F.least("edge", "next").alias("ring"))), True
    while moved:
        to = state.select(F.col("edge").alias("next"), F.col("next").alias("_next"), F.col("ring").alias("_ring"))
        now = written(state.join(to, "next").select("edge", F.col("_next").alias("next"), F.least("ring", "_ring").alias("ring"), (F.col("_ring") < F.col("ring")).alias("moved")))
        moved = not now.filter("moved").isEmpty()
        state = now.drop("moved")
    # back along the ring to its first edge, which leads nowhere
    numbered = succ.join(state.select("edge", "ring"), "edge")
    back = numbered.select(F.col("next").alias("edge"), F.when(F.col("next") != F.col("ring"), F.col("edge")).alias("next"), F.lit(1).cast("long").alias("one"))
    places = length_to_mouth(back, "edge", "next", "one").join(state.select("edge", "ring"), "edge").select("edge", "ring", (F.col("total") - 1).alias("place"))
    return rows.join(places, "edge")


def measured(rings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ring, n_edges, area, hole): areas are positive, holes told by their sense."""
    signed = F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")) / 2
    return rings.groupBy(*keys, "ring").agg(F.count(F.lit(1)).alias("n_edges"), F.abs(signed).alias("area"), (signed < 0).alias("hole"))


def corners(rings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ring, place, x, y) of the points at which a ring turns, in its order."""
    before = rings.select("ring", (F.col("place") + 1).alias("place"), (F.col("x1") - F.col("x0")).alias("bx"), (F.col("y1") - F.col("y0")).alias("by"))
    last = rings.groupBy("ring").agg(F.max_by(F.struct((F.col("x1") - F.col("x0")).alias("bx"), (F.col("y1") - F.col("y0")).alias("by")), "place").alias("e")).select("ring", F.lit(0).cast("long").alias("place"), "e.bx", "e.by")
    met = rings.join(before.unionByName(last), ["ring", "place"])
    return met.filter(F.col("bx") * (F.col("y1") - F.col("y0")) != F.col("by") * (F.col("x1") - F.col("x0"))).select(*keys, "ring", "place", F.col("x0").alias("x"), F.col("y0").alias("y"))
