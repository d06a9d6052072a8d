"""Polygons by their edges: coverage of cells, areas and lengths of overlap, with holes, without a polygon object.

A polygon is any number of rows (keys, x0, y0, x1, y1), one per edge, with the inside on the left of each edge; ``ring_edges``
makes them from rings of either sense.  ``cell_pieces`` cuts the edges at a grid and adds, along the top of every cell, where
the polygon goes on above.  The pieces of a cell then say all about the polygon in that cell: the part of a vertical line that
is inside is the sum, over the pieces it crosses, each with its sign, of the height of the crossing above the bottom of the
cell.  Areas are sums over pieces, areas of overlap sums over pairs of pieces that meet in a cell, and a cell that lies wholly
inside is the one piece along its top.  So what is moved are perimeters and spans, what is computed are aggregations, and no
task needs a whole polygon.

Edges with a null end say nothing.  Rows whose edges don't close to rings give areas without a meaning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .joins import meet

PIECE = ("u0", "v0", "u1", "v1")
#: Rows of either side that a part of a cell has at most, about: each meets all of the other side.
CELL_ROWS = 4096


def ring_edges(df: DataFrame, keys: list[str], ring: str = "ring", hole: Column | bool = False) -> DataFrame:
    """(keys, x0, y0, x1, y1) of rings (arrays of points), in the sense that has the inside on the left: outer rings
    counter-clockwise, holes clockwise.  The last point need not repeat the first; rings of under three points have none."""
    n = F.size(ring)
    ends = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, (i + 1) % n).alias("b")))
    rows = df.filter(n > 2).select(*keys, ends.alias("_e"), (hole if isinstance(hole, Column) else F.lit(hole)).alias("_hole"))
    area = F.aggregate("_e", F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    rows = rows.select(*keys, F.explode("_e").alias("_e"), ((area > 0) == F.col("_hole")).alias("_turn"))
    pick = lambda p, q, c: F.when(F.col("_turn"), F.col(f"_e.{q}.{c}")).otherwise(F.col(f"_e.{p}.{c}"))
    return rows.select(*keys, pick("a", "b", "x").alias("x0"), pick("a", "b", "y").alias("y0"), pick("b", "a", "x").alias("x1"), pick("b", "a", "y").alias("y1"))


def _stripes(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Cuts segments at whole numbers of the coordinate ``a``; adds the number of the stripe each part is in."""
    a0, a1, b0, b1 = (F.col(c) for c in (f"{a}0", f"{a}1", f"{b}0", f"{b}1"))
    first = F.floor(F.least(a0, a1))
    cut = rows.withColumn(name, F.explode(F.sequence(first, F.greatest(first, F.ceil(F.greatest(a0, a1)) - 1))))
    within = lambda c: F.least(F.greatest(c, F.col(name).cast("double")), F.col(name) + 1.0)
    slope = F.coalesce((b1 - b0) / F.nullif(a1 - a0, F.lit(0.0)), F.lit(0.0))
    # an end that is not cut off stays as it is, to the last bit
    at = lambda c, d: F.when(within(c) == c, d).otherwise(b0 + (within(c) - a0) * slope)
    return cut.withColumns({f"{a}0": within(a0), f"{b}0": at(a0, b0), f"{a}1": within(a1), f"{b}1": at(a1, b1)})


def _scaled(edges: DataFrame, keys: list[str], cell: float) -> DataFrame:
    rows = edges.select(*keys, *((F.col(c) / cell).alias(c) for c in ("x0", "y0", "x1", "y1")))
    return rows.dropna(subset=["x0", "y0", "x1", "y1"])


def cell_pieces(edges: DataFrame, keys: list[str], cell: float) -> DataFrame:
    """(keys, row, col, s, u0, v0, u1, v1) of each cell that a polygon has a part of, in units of cells: a piece from u0 to u1
    (u0 < u1) at heights v0 and v1 above the bottom of the cell, s = 1 with the inside below and -1 with the inside above."""
    rows = _stripes(_scaled(edges, keys, cell), "y", "x", "row")
    # where edges come through the line along a row's top, seen from just below it; from each odd one to the next is inside
    top = F.col("row") + 1.0
    high = F.greatest("y0", "y1")
    crossing = rows.filter((high == top) & (F.col("y0") != F.col("y1"))).select(*keys, "row", F.when(F.col("y0") == high, F.col("x0")).otherwise(F.col("x1")).alias("_x"))
    w = Window.partitionBy(*keys, "row").orderBy("_x")
    spans = crossing.select(*keys, "row", F.col("_x").alias("x1"), F.lead("_x").over(w).alias("x0"), F.row_number().over(w).alias("_k")).filter("_k % 2 = 1 and x0 > x1")
    spans = spans.select(*keys, "row", "x0", top.alias("y0"), "x1", top.alias("y1"))
    both = rows.filter("x0 <> x1").select(*keys, "row", "x0", "y0", "x1", "y1").unionByName(spans)
    cut = _stripes(both, "x", "y", "col").filter("x0 <> x1")
    left = F.col("x1") < F.col("x0")
    v = lambda c: F.col(c) - F.col("row")
    pieces = cut.select(
        *keys, F.col("row"), F.col("col"), F.when(left, 1).otherwise(-1).alias("s"),
        F.least("x0", "x1").alias("u0"), F.when(left, v("y1")).otherwise(v("y0")).alias("v0"), F.greatest("x0", "x1").alias("u1"), F.when(left, v("y0")).otherwise(v("y1")).alias("v1"),
    )
    return pieces.filter("v0 <> 0 or v1 <> 0")


def _own_area() -> Column:
    return F.col("s") * (F.col("u1") - F.col("u0")) * (F.col("v0") + F.col("v1")) / 2


def coverage(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, col, fraction): the part of each cell that lies inside."""
    return pieces.groupBy(*keys, "row", "col").agg(F.sum(_own_area()).alias("fraction")).filter("fraction > 1e-12")


def areas(pieces: DataFrame, keys: list[str], cell: float) -> DataFrame:
    return pieces.groupBy(*keys).agg((F.sum(_own_area()) * (cell * cell)).alias("area"))


def _named(pieces: DataFrame, side: str) -> DataFrame:
    return pieces.select(*(F.col(c) if c in ("row", "col") else F.col(c).alias(f"{side}_{c}") for c in pieces.columns))


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of rows of the same cell.  There are far more of them than rows, so neither the few partitions that the rows need nor
    the rows of a cell are a task's share."""
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return meet(written(left), written(right), CELL_ROWS, ["row", "col"], n)


def overlaps(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], cell: float) -> DataFrame:
    """(left_<keys>, right_<keys>, area) of polygons (pieces of the same grid) that share an area."""
    met = _met(_named(left, "left"), _named(right, "right")).filter("left_u0 < right_u1 and right_u0 < left_u1")
    p, q = F.greatest("left_u0", "right_u0"), F.least("left_u1", "right_u1")
    met = met.withColumns({"_p": p, "_q": q})

    def at(side: str, x: str) -> Column:
        u0, v0, u1, v1 = (F.col(f"{side}_{c}") for c in PIECE)
        return v0 + (F.col(x) - u0) * (v1 - v0) / (u1 - u0)

    met = met.withColumns({"_lp": at("left", "_p"), "_lq": at("left", "_q"), "_rp": at("right", "_p"), "_rq": at("right", "_q")})
    dp, dq = F.col("_lp") - F.col("_rp"), F.col("_lq") - F.col("_rq")
    plain = (F.least("_lp", "_rp") + F.least("_lq", "_rq")) / 2
    t = dp / F.nullif(dp - dq, F.lit(0.0))
    low = F.col("_lp") + t * (F.col("_lq") - F.col("_lp"))  # where the two cross
    crossed = (t * (F.least("_lp", "_rp") + low) + (1 - t) * (low + F.least("_lq", "_rq"))) / 2
    lower = F.when((dp > 0) & (dq < 0) | (dp < 0) & (dq > 0), crossed).otherwise(plain)
    area = F.col("left_s") * F.col("right_s") * (F.col("_q") - F.col("_p")) * lower
    by = [*(f"left_{k}" for k in left_keys), *(f"right_{k}" for k in right_keys)]
    return met.groupBy(*by).agg((F.sum(area) * (cell * cell)).alias("area")).filter(F.col("area") > 1e-9 * cell * cell)


def differences(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], cell: float) -> DataFrame:
    """(left keys, area, common, rest): what of a polygon lies in the polygons of the other layer, which must not overlap each
    other, and what doesn't."""
    common = overlaps(left, right, left_keys, right_keys, cell).groupBy(*(F.col(f"left_{k}").alias(k) for k in left_keys)).agg(F.sum("area").alias("common"))
    out = areas(left, left_keys, cell).join(common, left_keys, "left").withColumn("common", F.coalesce("common", F.lit(0.0)))
    return out.withColumn("rest", F.greatest(F.col("area") - F.col("common"), F.lit(0.0)))


def largest_overlap(found: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """(by, names, area): of the overlaps of a feature the largest one; of equal ones the first by name."""
    best = F.max_by(F.struct(*names, "area"), F.struct(F.round("area", 9), *(-F.col(n) for n in names)))
    return found.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.*")


def lengths_inside(segments: DataFrame, pieces: DataFrame, line_keys: list[str], keys: list[str], cell: float) -> DataFrame:
    """(line keys, keys, length): how much of a line, given as rows (line keys, x0, y0, x1, y1), lies inside each polygon.

    What runs along an edge counts if the polygon lies above or to the right of it.  Keys of lines and of polygons must have
    different names.
    """
    rows = _stripes(_stripes(_scaled(segments, line_keys, cell), "y", "x", "row"), "x", "y", "col")
    met = _met(rows.withColumn("_row", F.col("row")), pieces)
    x0, dx = F.col("x0"), F.col("x1") - F.col("x0")
    u0, v0, u1, v1 = (F.col(c) for c in PIECE)
    upright = dx == 0
    step = F.nullif(dx, F.lit(0.0))
    from_t = F.when(upright, 0.0).otherwise(F.greatest(F.lit(0.0), F.least((u0 - x0) / step, (u1 - x0) / step)))
    to_t = F.when(upright, F.when((x0 >= u0) & (x0 < u1), 1.0).otherwise(0.0)).otherwise(F.least(F.lit(1.0), F.greatest((u0 - x0) / step, (u1 - x0) / step)))
    met = met.withColumns({"_a": from_t, "_b": to_t}).filter("_b > _a")
    below = lambda t: v0 + (x0 + F.col(t) * dx - u0) * (v1 - v0) / (u1 - u0) - (F.col("y0") + F.col(t) * (F.col("y1") - F.col("y0")) - F.col("_row"))
    met = met.withColumns({"_fa": below("_a"), "_fb": below("_b")})
    part = F.when((F.col("_fa") > 0) & (F.col("_fb") > 0), 1.0).when((F.col("_fa") <= 0) & (F.col("_fb") <= 0), 0.0).otherwise(F.greatest("_fa", "_fb") / F.abs(F.col("_fa") - F.col("_fb")))
    size = F.sqrt(dx * dx + F.pow(F.col("y1") - F.col("y0"), 2)) * cell
    total = F.sum(F.col("s") * (F.col("_b") - F.col("_a")) * part * size)
    return met.groupBy(*line_keys, *keys).agg(total.alias("length")).filter(F.col("length") > 1e-9 * cell)
