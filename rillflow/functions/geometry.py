"""Geometry on arrays of points, as native column expressions, and WKB in Arrow batches.

A line or ring is ``array<struct<x: double, y: double>>``; a ring need not repeat its first point.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import ship

POINTS = "array<struct<x:double,y:double>>"
EARTH_RADIUS_M = 6371000.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _segments(line: Column) -> Column:
    """Pairs of neighbouring points."""
    n = F.size(line)
    return F.when(n > 1, F.zip_with(F.slice(line, 1, F.greatest(n - 1, F.lit(0))), F.slice(line, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).otherwise(F.array().cast("array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>"))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2))


def length(line: Column) -> Column:
    return F.aggregate(_segments(line), F.lit(0.0), lambda s, p: s + distance(p["a"], p["b"]))


def straight_length(line: Column) -> Column:
    return F.when(F.size(line) > 1, distance(F.element_at(line, 1), F.element_at(line, -1)))


def sinuosity(line: Column) -> Column:
    return length(line) / F.nullif(straight_length(line), F.lit(0.0))


def azimuth(line: Column) -> Column:
    """Degrees clockwise from north, first to last point."""
    a, b = F.element_at(line, 1), F.element_at(line, -1)
    return F.pmod(F.degrees(F.atan2(b["x"] - a["x"], b["y"] - a["y"])) + 360.0, F.lit(360.0))


def _closed(ring: Column) -> Column:
    return F.concat(ring, F.slice(ring, 1, 1))


def area(ring: Column) -> Column:
    """Shoelace formula."""
    return F.abs(F.aggregate(_segments(_closed(ring)), F.lit(0.0), lambda s, p: s + (p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]))) / 2


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting; a point on a right or upper edge is outside."""

    def crosses(p: Column) -> Column:
        a, b = p["a"], p["b"]
        at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        return F.coalesce(((a["y"] > y) != (b["y"] > y)) & (x < at), F.lit(False))

    return F.size(F.filter(_segments(_closed(ring)), crosses)) % 2 == 1


def box(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def rounded(points: Column, digits: int) -> Column:
    return F.transform(points, lambda p: F.struct(F.round(p["x"], digits).alias("x"), F.round(p["y"], digits).alias("y")))


def without_small_holes(rings: Column, least_area: float) -> Column:
    """Outer ring and the holes of such an area at least."""
    return F.filter(rings, lambda r, i: (i == 0) | (area(r) >= least_area))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(a))


def utm_epsg(longitude: Column, north: bool = True) -> Column:
    return (F.floor((longitude + 180) / 6) + 1 + (32600 if north else 32700)).cast("int")


def point_at(line: Column, at: Column) -> Column:
    """The point at a distance along the line; its ends beyond them."""

    def step(s: Column, p: Column) -> Column:
        d = distance(p["a"], p["b"])
        t = (at - s["run"]) / F.nullif(d, F.lit(0.0))
        here = s["x"].isNull() & (at <= s["run"] + d) & (d > 0)
        return F.struct((s["run"] + d).alias("run"), F.when(here, p["a"]["x"] + t * (p["b"]["x"] - p["a"]["x"])).otherwise(s["x"]).alias("x"), F.when(here, p["a"]["y"] + t * (p["b"]["y"] - p["a"]["y"])).otherwise(s["y"]).alias("y"))

    none = F.lit(None).cast("double")
    found = F.aggregate(_segments(line), F.struct(F.lit(0.0).alias("run"), none.alias("x"), none.alias("y")), step)
    last = F.element_at(line, -1)
    return F.struct(F.coalesce(found["x"], last["x"]).alias("x"), F.coalesce(found["y"], last["y"]).alias("y"))


def points_along(line: Column, step: float) -> Column:
    """Points every ``step`` from the start, for explode: array<struct<at, p>>."""
    return F.transform(F.sequence(F.lit(0), F.floor(length(line) / step).cast("int")), lambda i: F.struct((i * step).alias("at"), point_at(line, i * F.lit(float(step))).alias("p")))


def pieces(total: Column, interval: float, minimum: float) -> Column:
    """(from, to) of the pieces of a line cut at an interval; a rest shorter than the minimum joins the last piece."""
    n = F.greatest(F.lit(1), F.floor(total / interval) + F.when(total - F.floor(total / interval) * interval >= minimum, 1).otherwise(0)).cast("int")
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(((i - 1) * F.lit(float(interval))).alias("from"), F.when(i == n, total).otherwise(i * F.lit(float(interval))).alias("to")))


# --- WKB --------------------------------------------------------------------------------------------------------------


def encode_wkb(kind: str, points: list[tuple[float, float]]) -> bytes:
    """A point, line or polygon of one ring, little-endian."""
    body = b"".join(struct.pack("<dd", *p) for p in points)
    if kind == "point":
        return struct.pack("<BI", 1, 1) + body
    if kind == "line":
        return struct.pack("<BII", 1, 2, len(points)) + body
    closed = points if points[0] == points[-1] else [*points, points[0]]
    return struct.pack("<BIII", 1, 3, 1, len(closed)) + b"".join(struct.pack("<dd", *p) for p in closed)


def decode_wkb(data: bytes | None) -> list[np.ndarray] | None:
    """The parts (lines, rings or points) of a geometry as arrays of x, y; more dimensions are dropped."""
    if data is None:
        return None

    def one(at: int) -> tuple[list[np.ndarray], int]:
        e = "<" if data[at] == 1 else ">"
        (kind,) = struct.unpack_from(e + "I", data, at + 1)
        at += 5
        if kind & 0x20000000:
            at += 4
        dims = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
        kind &= 0x0FFFFFFF
        dims += {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000]
        kind %= 1000

        def run(at: int, n: int) -> tuple[np.ndarray, int]:
            return np.frombuffer(data, e + "f8", n * dims, at).reshape(n, dims)[:, :2].astype(float), at + 8 * n * dims

        if kind == 1:
            p, at = run(at, 1)
            return [p], at
        (n,) = struct.unpack_from(e + "I", data, at)
        at += 4
        if kind == 2:
            p, at = run(at, n)
            return [p], at
        parts = []
        for _ in range(n):
            if kind == 3:
                (m,) = struct.unpack_from(e + "I", data, at)
                p, at = run(at + 4, m)
                parts.append(p)
            else:
                more, at = one(at)
                parts += more
        return parts, at

    return one(0)[0]


def wkb_points(column: Column) -> Column:
    """Parts of a geometry: array<array<struct<x,y>>>, built from flat arrays of a batch's coordinates."""
    ship(SparkSession.active())

    @F.pandas_udf("array<array<double>>")
    def of(data: pd.Series) -> pd.Series:
        return pd.Series([None if d is None else [part.ravel() for part in decode_wkb(d)] for d in data])

    # pairs of numbers become points on the side of the engine
    return F.transform(of(column), lambda flat: F.transform(F.sequence(F.lit(1), (F.size(flat) / 2).cast("int")), lambda i: F.struct(F.element_at(flat, 2 * i - 1).alias("x"), F.element_at(flat, 2 * i).alias("y"))))


def as_wkb(rings: Column) -> Column:
    """A polygon of rings (the first is the outer one) as WKB; rings are closed."""
    ship(SparkSession.active())

    @F.pandas_udf("binary")
    def of(flat: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else _polygon([np.asarray(r, float) for r in p]) for p in flat])

    return of(F.transform(rings, lambda r: F.flatten(F.transform(r, lambda p: F.array(p["x"], p["y"])))))


def _polygon(rings: list[np.ndarray]) -> bytes:
    out = [struct.pack("<BII", 1, 3, len(rings))]
    for r in rings:
        closed = r if len(r) and (r[:2] == r[-2:]).all() else np.concatenate([r, r[:2]])
        out += [struct.pack("<I", len(closed) // 2), closed.astype("<f8").tobytes()]
    return b"".join(out)


def net_area(rings: Column) -> Column:
    """The outer ring's area without that of the holes."""
    return F.aggregate(F.transform(rings, area), F.lit(0.0), lambda s, a: s - a) + 2 * area(F.element_at(rings, 1))


# --- cuts of lines ------------------------------------------------------------------------------------------------------


def between(line: Column, start: Column, end: Column) -> Column:
    """The part of a line from one distance along it to another: the point at the start, the line's own points after it, and
    the point at the end.  Distances beyond the line's ends are its ends; null if nothing is left."""
    # each point with its distance along the line, worked out once
    run = F.aggregate(
        F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))),
        F.array(F.struct(F.element_at(line, 1)["x"].alias("x"), F.element_at(line, 1)["y"].alias("y"), F.lit(0.0).alias("m"))),
        lambda s, p: F.concat(s, F.array(F.struct(p["x"].alias("x"), p["y"].alias("y"), (F.element_at(s, -1)["m"] + distance(F.element_at(s, -1), p)).alias("m")))),
    )

    def cut(v: Column) -> Column:
        points, a, b = v["run"], v["a"], v["b"]

        def at(m: Column) -> Column:
            p, q = F.element_at(F.filter(points, lambda p: p["m"] <= m), -1), F.get(F.filter(points, lambda p: p["m"] > m), F.lit(0))
            t = F.coalesce((m - p["m"]) / (q["m"] - p["m"]), F.lit(0.0))
            return F.struct((p["x"] + t * F.coalesce(q["x"] - p["x"], F.lit(0.0))).alias("x"), (p["y"] + t * F.coalesce(q["y"] - p["y"], F.lit(0.0))).alias("y"))

        inner = F.transform(F.filter(points, lambda p: (p["m"] > a) & (p["m"] < b)), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
        return F.when(a < b, F.concat(F.array(at(a)), inner, F.array(at(b))))

    ends = lambda r: F.struct(r.alias("run"), F.greatest(start.cast("double"), F.lit(0.0)).alias("a"), F.least(end.cast("double"), F.element_at(r, -1)["m"]).alias("b"))
    return _let(_let(run, ends), cut)


def _let(value: Column, of) -> Column:
    """``of`` a value that is worked out once, however often ``of`` names it."""
    return F.element_at(F.transform(F.array(value), of), 1)


def inside_box(line: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The parts of a line's segments that lie in a box: array<struct<a, b>> in the order of the line; touching it in a point
    only gives none."""

    def part(s: Column) -> Column:
        dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]

        def axis(at: Column, d: Column, low: Column, high: Column) -> tuple[Column, Column]:
            step = F.nullif(d, F.lit(0.0))
            here = F.when(at.between(low, high), F.lit(1.0)).otherwise(F.lit(-1.0))
            return F.coalesce(F.least((low - at) / step, (high - at) / step), F.lit(0.0)), F.coalesce(F.greatest((low - at) / step, (high - at) / step), here)

        (x_in, x_out), (y_in, y_out) = axis(s["a"]["x"], dx, xmin, xmax), axis(s["a"]["y"], dy, ymin, ymax)
        t0, t1 = F.greatest(x_in, y_in, F.lit(0.0)), F.least(x_out, y_out, F.lit(1.0))
        at = lambda t: F.struct((s["a"]["x"] + t * dx).alias("x"), (s["a"]["y"] + t * dy).alias("y"))
        return F.struct(at(t0).alias("a"), at(t1).alias("b"), ((t0 < t1) & ((dx != 0) | (dy != 0))).alias("in"))

    kept = F.filter(F.transform(_segments(line), part), lambda s: s["in"])
    return F.transform(kept, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))
