"""Nearest source cells of a raster: exact distances and the seed of every cell, without a limit of reach.

Squared distance is separable.  Along a row, the nearest source of each column is found first; down a column, the nearest
source is then the least of (y - r)^2 + g(r) over the rows r that have sources, parabolas of one shape, so their choice never
goes back up as y goes down.  That makes both passes local:

* Rows are cut in blocks of ``WIDE`` columns.  A row of sources sends each block its own source columns and the nearest ones
  before and behind the block, so no task holds a row.
* Columns are cut in strips of ``TALL`` rows.  Strips are put together in pairs, pairs of pairs and so on.  In a round each of
  two neighbours sends each strip of the other those of its rows that can be nearest there: the choice at the strip's first
  and last row bounds them.  What the two keep for the next round are the rows that can be nearest above or below both.  Each
  round a strip gets one piece, and the pieces of a side divide its rows, so the number of rows sent does not grow with
  the number of strips, and a raster of n strips takes log2(n) rounds.

A cell then asks the rows its strip has been sent.  Of equally near sources the one with the smallest row counts, then the one
with the smallest column.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship, written

#: Columns of a block and rows of a strip.
WIDE, TALL = 64, 512
_ENTRIES = "cb long, grp long, n int, cols binary, rows binary, seeds binary"


def choices(starts: np.ndarray, r: np.ndarray, g: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """The place in ``r`` of the first least (y - r)^2 + g for each column (its places are starts[c] to starts[c + 1] - 1, in
    the order of r, at least one) and each y, in order.

    The middle y is solved first and bounds the places of the others, and so on by halves, for all columns at once.
    """
    columns, n = len(starts) - 1, len(ys)
    span = 1 << max(1, n.bit_length())
    at = np.empty((columns, span + 1), np.int64)
    at[:, : n + 1], at[:, n + 1 :] = starts[:-1, None], starts[1:, None] - 1
    step = span // 2
    while step:
        p = np.arange(step, span, 2 * step)
        p = p[p <= n]
        if len(p):
            low, high = at[:, p - step].ravel(), at[:, p + step].ravel()
            high = np.where(np.tile(p + step > n, columns), np.repeat(starts[1:] - 1, len(p)), high)
            counts = high - low + 1
            begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
            places = np.arange(counts.sum()) + np.repeat(low - begin, counts)
            value = (np.repeat(np.tile(ys[p - 1], columns), counts) - r[places]) ** 2 + g[places]
            hits = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, begin), counts))
            segment = np.searchsorted(begin, hits, "right") - 1
            first = np.concatenate([[True], segment[1:] != segment[:-1]])
            at[:, p] = places[hits[first]].reshape(columns, len(p))
        step //= 2
    return at[:, 1 : n + 1]


def _packed(cb: int, grp: int, c: np.ndarray, r: np.ndarray, s: np.ndarray) -> tuple:
    return (cb, grp, len(c), c.astype("<i8").tobytes(), r.astype("<i8").tobytes(), s.astype("<i8").tobytes())


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column, row, seed column) of all entries, in the order of column and row."""
    c, r, s = (np.concatenate([np.frombuffer(b, "<i8") for b in rows[x]]) for x in ("cols", "rows", "seeds"))
    order = np.lexsort((r, c))
    return c[order], r[order], s[order]


def _columns(c: np.ndarray) -> np.ndarray:
    """Where each column's entries begin, and the end."""
    return np.concatenate([np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])), [len(c)]])


def _between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All places from low to high, for each pair."""
    counts = high - low + 1
    return np.arange(counts.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)


def _row_pass(sources: DataFrame, blocks: DataFrame, top: int) -> DataFrame:
    """The entries (column, row, nearest source column) of each block and strip, from sources (row, col)."""
    own = sources.groupBy("row", F.floor(F.col("col") / WIDE).alias("cb")).agg(F.collect_set("col").alias("own"), F.min("col").alias("first"), F.max("col").alias("last"))
    wanted = sources.select("row").distinct().crossJoin(F.broadcast(blocks.agg(F.collect_set("cb").alias("cbs")))).select("row", F.explode("cbs").alias("cb"), F.lit(True).alias("asked"))
    along = Window.partitionBy("row").orderBy("cb")
    before = F.last("last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.first("first", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing))
    met = wanted.join(own, ["row", "cb"], "full").withColumns({"before": before, "behind": behind}).where("asked")
    far = np.int64(1) << 40

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cb, grp = (int(k) for k in key)
        columns = np.arange(cb * WIDE, (cb + 1) * WIDE)
        left, right = np.full((len(rows), WIDE), -far), np.full((len(rows), WIDE), far)
        for i, cols in enumerate(rows["own"]):
            if cols is not None and len(cols):
                at = np.asarray(cols, np.int64) - cb * WIDE
                left[i, at] = right[i, at] = columns[at]
        left = np.maximum(np.maximum.accumulate(left, axis=1), rows["before"].fillna(-far).to_numpy(np.int64)[:, None])
        right = np.minimum(np.minimum.accumulate(right[:, ::-1], axis=1)[:, ::-1], rows["behind"].fillna(far).to_numpy(np.int64)[:, None])
        nearest = np.where(columns - left <= right - columns, left, right)
        r = rows["row"].to_numpy(np.int64)
        return pd.DataFrame([_packed(cb, grp, np.tile(columns, len(r)), np.repeat(r, WIDE), nearest.ravel())], columns=["cb", "grp", "n", "cols", "rows", "seeds"])

    strips = met.select("cb", F.floor((F.col("row") - top) / TALL).alias("grp"), "row", "own", "before", "behind")
    return strips.groupBy("cb", "grp").applyInPandas(pack, _ENTRIES)


def _exchange(groups: DataFrame, level: int, top: int, bottom: int) -> DataFrame:
    """From the groups of a level, the groups of the next (strip null) and the pieces for the strips of the other group."""
    last = (bottom - top) // TALL

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cb, parent = (int(k) for k in key)
        out, kept = [], []
        for grp in rows["grp"].unique():
            c, r, s = _unpacked(rows[rows["grp"] == grp])
            starts, g = _columns(c), (c - s) ** 2
            other = int(grp) ^ 1
            strips = np.arange(other << level, min(((other + 1) << level) - 1, last) + 1)
            if len(strips):
                ends = choices(starts, r, g, np.stack([strips * TALL, strips * TALL + TALL - 1], axis=1).ravel() + top)
                for k, strip in enumerate(strips):
                    at = _between(ends[:, 2 * k], ends[:, 2 * k + 1])
                    out.append((int(strip), *_packed(cb, int(strip), c[at], r[at], s[at])))
            low, high = top + ((parent << (level + 1)) * TALL), top + (((parent + 1) << (level + 1)) * TALL) - 1
            ends = choices(starts, r, g, np.array([min(top, low), low, high, max(bottom, high)]))
            stay = np.zeros(len(r), bool)
            stay[_between(ends[:, 0], ends[:, 1])] = stay[_between(ends[:, 2], ends[:, 3])] = True
            kept.append((c[stay], r[stay], s[stay]))
        c, r, s = (np.concatenate(x) for x in zip(*kept, strict=True))
        out.append((None, *_packed(cb, parent, c, r, s)))
        frame = pd.DataFrame(out, columns=["strip", "cb", "grp", "n", "cols", "rows", "seeds"])
        return frame.astype({"strip": "Int64"})

    return groups.groupBy("cb", F.shiftright("grp", 1).alias("parent")).applyInPandas(meet, f"strip long, {_ENTRIES}")


def nearest_sources(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """(row, col, distance, seed_row, seed_col) of every cell, distances in cells.  Without any source all are null."""
    spark = cells.sparkSession
    ship(spark)
    cells, sources = cells.select(F.col("row").cast("long"), F.col("col").cast("long")), sources.select(F.col("row").cast("long"), F.col("col").cast("long"))
    extent = cells.union(sources).agg(F.min("row"), F.max("row")).first()
    none = F.lit(None).cast("long")
    if extent[0] is None or sources.isEmpty():
        return cells.select("row", "col", F.lit(None).cast("double").alias("distance"), none.alias("seed_row"), none.alias("seed_col"))
    top, bottom = extent
    placed = cells.select("row", "col", F.floor(F.col("col") / WIDE).alias("cb"), F.floor((F.col("row") - top) / TALL).alias("grp"))
    groups = written(_row_pass(sources, placed.select("cb").distinct(), top))
    pieces, level = groups, 0
    while (bottom - top) // TALL >> level:
        met = written(_exchange(groups, level, top, bottom))
        pieces = pieces.unionByName(met.where("strip is not null").drop("strip"))
        groups, level = met.where("strip is null").drop("strip"), level + 1

    def solve(key: tuple, asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame({x: [] for x in ("row", "col", "distance", "seed_row", "seed_col")})
        cb, grp = (int(k) for k in key)
        c, r, s = _unpacked(rows)
        ys = np.arange(TALL) + top + grp * TALL
        at = choices(_columns(c), r, (c - s) ** 2, ys)
        y, x = asked["row"].to_numpy(), asked["col"].to_numpy()
        own = at[x - cb * WIDE, y - ys[0]]
        return pd.DataFrame({"row": y, "col": x, "distance": np.sqrt(((y - r[own]) ** 2 + (x - s[own]) ** 2).astype(float)), "seed_row": r[own], "seed_col": s[own]})

    by = ("cb", "grp")
    return placed.groupBy(*by).cogroup(pieces.groupBy(*by)).applyInPandas(solve, "row long, col long, distance double, seed_row long, seed_col long")


def proximity(cells: DataFrame, sources: DataFrame, cell_size: float) -> DataFrame:
    """(row, col, value): the distance of each cell to its nearest source."""
    return nearest_sources(cells, sources).select("row", "col", (F.col("distance") * cell_size).alias("value"))


def seed_zones(cells: DataFrame, seeds: DataFrame, names: list[str]) -> DataFrame:
    """(row, col, distance, *names): each cell with the columns of its nearest seed (row, col, *names), one seed per cell."""
    s = seeds.select(F.col("row").cast("long").alias("seed_row"), F.col("col").cast("long").alias("seed_col"), *names)
    return nearest_sources(cells, seeds).join(s, ["seed_row", "seed_col"], "left").select("row", "col", "distance", *names)
