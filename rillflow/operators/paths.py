"""Least-cost distances over a raster of costs, growth from a channel, and the paths that lead back.

A step from a cell to one of its eight neighbours costs the mean of both cells times the length of the step.  Cells come in
tiles of ``TILE`` x ``TILE``.  In a round every tile whose border a neighbour has lowered is relaxed inside one task until
nothing in it changes, and the tiles that changed show their borders to the eight around them; so rounds grow with the
tiles that a path crosses and not with its cells, and a tile is all a task holds.  Ends of paths are found by doubled pointers.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship, written

TILE = 128
#: Row and column steps to the neighbours, in the order in which ties are settled.
STEPS = ((-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1))
_STATE = "tr long, tc long, cost binary, total binary, changed boolean"
_SHOWN = "tr long, tc long, i int, j int, cost binary, total binary"


def _grid(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, "<f8")
    return a.reshape(math.isqrt(len(a)), -1)


def _border(a: np.ndarray, i: int, j: int) -> np.ndarray:
    """The part of a tile that its neighbour at (i, j) touches."""
    pick = lambda k: {-1: slice(0, 1), 0: slice(None), 1: slice(len(a) - 1, None)}[k]
    return a[pick(i), pick(j)]


def _framed(own: np.ndarray, shown: pd.DataFrame, what: str) -> np.ndarray:
    """A tile with the cells around it; those that nobody shows are out of reach."""
    out = np.pad(own, 1, constant_values=np.inf)
    place = lambda k: {-1: slice(len(own) + 1, None), 0: slice(1, len(own) + 1), 1: slice(0, 1)}[k]
    for i, j, data in zip(shown["i"], shown["j"], shown[what], strict=True):
        part = out[place(i), place(j)]  # the neighbour showed the side that lies at (i, j) of it
        part[:] = np.frombuffer(data, "<f8").reshape(part.shape)
    return out


def _reached(total: np.ndarray, cost: np.ndarray, k: int) -> np.ndarray:
    """What the inner cells' totals are by way of the neighbour of step k."""
    i, j = STEPS[k]
    n = len(total) - 2
    there = (slice(1 + i, n + 1 + i), slice(1 + j, n + 1 + j))
    return total[there] + (cost[there] + cost[1:-1, 1:-1]) / 2 * math.hypot(i, j)


def _relaxed(total: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """The inner totals once no neighbour lowers one any more."""
    while True:
        best = total[1:-1, 1:-1]
        for k in range(len(STEPS)):
            best = np.minimum(best, _reached(total, cost, k))
        if (best == total[1:-1, 1:-1]).all():
            return best
        total[1:-1, 1:-1] = best


def _show(frames):
    for frame in frames:
        out = []
        for tr, tc, c, t in zip(frame["tr"], frame["tc"], frame["cost"], frame["total"], strict=True):
            cost, total = _grid(c), _grid(t)
            out += [(tr + i, tc + j, i, j, _border(cost, i, j).tobytes(), _border(total, i, j).tobytes()) for i, j in STEPS if np.isfinite(_border(total, i, j)).any()]
        yield pd.DataFrame(out, columns=["tr", "tc", "i", "j", "cost", "total"])


def _tiles(cells: DataFrame, starts: DataFrame, cost: str, tile: int) -> DataFrame:
    """The state before the first round: costs, and a total of 0 for starts."""
    at = lambda c: F.floor(F.col(c) / tile)
    inside = ((F.col("row") - at("row") * tile) * tile + F.col("col") - at("col") * tile).cast("int")
    s = starts.select("row", "col").distinct().withColumn("_start", F.lit(True))
    rows = cells.filter(f"`{cost}` is not null").join(s, ["row", "col"], "left").select(at("row").alias("tr"), at("col").alias("tc"), inside.alias("at"), F.col(cost).cast("double").alias("cost"), F.coalesce("_start", F.lit(False)).alias("start"))

    def pack(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        cost, total = np.full(tile * tile, np.inf), np.full(tile * tile, np.inf)
        if (own["cost"] <= 0).any():
            raise ValueError("costs must be over 0")
        cost[own["at"]] = own["cost"]
        total[own["at"][own["start"]]] = 0.0
        nothing = pd.DataFrame({"i": [], "j": [], "cost": [], "total": []})
        total = _relaxed(_framed(total.reshape(tile, tile), nothing, "total"), _framed(cost.reshape(tile, tile), nothing, "cost"))
        return pd.DataFrame([(*key, cost.tobytes(), total.tobytes(), bool(own["start"].any()))], columns=["tr", "tc", "cost", "total", "changed"])

    return rows.groupBy("tr", "tc").applyInPandas(pack, _STATE)


def least_costs(cells: DataFrame, starts: DataFrame, cost: str = "cost", tile: int = TILE) -> DataFrame:
    """(row, col, total, from_row, from_col): the least cost of a path from any start, and the cell before on such a path.

    Cells without a cost are not entered; cells that no path reaches have nulls.  Of equally good cells before, the first in
    the order of ``STEPS`` counts; a start has none.
    """
    spark = cells.sparkSession
    ship(spark)
    state = written(_tiles(cells, starts, cost, tile))

    def relax(key: tuple, own: pd.DataFrame, shown: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return own
        if not len(shown):
            return own.assign(changed=False)
        before = _grid(own["total"].iloc[0])
        total = _relaxed(_framed(before, shown, "total"), _framed(_grid(own["cost"].iloc[0]), shown, "cost"))
        return own.assign(total=[total.tobytes()], changed=bool((total < before).any()))

    by = ("tr", "tc")
    while not state.where("changed").isEmpty():
        shown = state.where("changed").mapInPandas(_show, _SHOWN)
        state = written(state.groupBy(*by).cogroup(shown.groupBy(*by)).applyInPandas(relax, _STATE))

    def unpack(key: tuple, own: pd.DataFrame, shown: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({c: [] for c in ("row", "col", "total", "from_row", "from_col")})
        cost, total = _framed(_grid(own["cost"].iloc[0]), shown, "cost"), _framed(_grid(own["total"].iloc[0]), shown, "total")
        by_way = np.stack([_reached(total, cost, k) for k in range(len(STEPS))])
        step = np.array(STEPS)[by_way.argmin(axis=0)]
        r, c = np.nonzero(np.isfinite(cost[1:-1, 1:-1]))
        t = total[1:-1, 1:-1][r, c]
        row, col = r + key[0] * tile, c + key[1] * tile
        led = np.isfinite(t) & (t > 0)
        back = lambda at, k: pd.array(np.where(led, at + step[r, c, k], 0), "Int64")
        out = pd.DataFrame({"row": row, "col": col, "total": pd.array(np.where(np.isfinite(t), t, 0), "Float64"), "from_row": back(row, 0), "from_col": back(col, 1)})
        out.loc[~np.isfinite(t), "total"] = pd.NA
        out.loc[~led, ["from_row", "from_col"]] = pd.NA
        return out

    shown = state.mapInPandas(_show, _SHOWN)
    return state.groupBy(*by).cogroup(shown.groupBy(*by)).applyInPandas(unpack, "row long, col long, total double, from_row long, from_col long")


def _key(row: str, col: str):
    return F.col(row).cast("long") * (1 << 31) + F.col(col).cast("long")


def allocation(costs: DataFrame) -> DataFrame:
    """(row, col, total, start_row, start_col) of ``least_costs``: the start each cell's path comes from."""
    from .network import pointer_ends

    nodes = costs.filter("total is not null").select(_key("row", "col").alias("node"), _key("from_row", "from_col").alias("next"), "row", "col", "total")
    ends = pointer_ends(nodes.select("node", "next"))
    return nodes.join(ends, "node").select("row", "col", "total", F.floor(F.col("end") / (1 << 31)).alias("start_row"), F.pmod(F.col("end"), F.lit(1 << 31)).alias("start_col"))


def paths_to(costs: DataFrame, targets: DataFrame) -> DataFrame:
    """(row, col) of all cells on the paths of ``least_costs`` that end in the targets (row, col).

    The pointers are doubled, and what 2^k steps back from a known cell lies is known too, so a path of n cells takes
    log2(n) rounds.
    """
    pointers = written(costs.filter("total is not null").select(_key("row", "col").alias("node"), _key("from_row", "from_col").alias("next")))
    known = written(targets.select(_key("row", "col").alias("node")).distinct().join(pointers.select("node"), "node", "left_semi"))
    jump = pointers.filter("next is not null")
    while not jump.isEmpty():
        known = written(known.union(known.join(jump, "node").select("next")).distinct())
        jump = written(jump.join(jump.select(F.col("node").alias("next"), F.col("next").alias("_n")), "next").select("node", F.col("_n").alias("next")))
    return known.select(F.floor(F.col("node") / (1 << 31)).alias("row"), F.pmod(F.col("node"), F.lit(1 << 31)).alias("col"))


def grown(cells: DataFrame, channel: DataFrame, inside: str, most: float | None = None) -> DataFrame:
    """(row, col, distance): what is grown from a channel through cells for which the condition holds, along steps of length
    1 or the diagonal, up to a distance."""
    rows = cells.join(channel.select("row", "col").distinct().withColumn("_c", F.lit(True)), ["row", "col"], "left").filter(F.col("_c") | F.expr(inside)).select("row", "col", F.lit(1.0).alias("cost"))
    out = least_costs(rows, channel).filter("total is not null").select("row", "col", F.col("total").alias("distance"))
    return out.filter(F.col("distance") <= most) if most is not None else out
