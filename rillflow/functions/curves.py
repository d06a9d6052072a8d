"""Transform curves through knots, evidence and zones."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .formulas import formula

#: The kinds of curve.
KINDS = ("linear", "nearest", "nearest-up", "zero", "slinear", "quadratic", "cubic", "previous", "next", "function")


def curve(kind: str, value: Column, knots: list[tuple[float, float]] | None = None, equation: str | None = None, outside: float = 0.0) -> Column:
    """The curve's value; outside the knots ``outside``, and null for null."""
    if kind == "function":
        return formula(equation, {"a": value, "x": value})
    if kind not in KINDS:
        raise ValueError(f"no such kind of curve: {kind}")
    knots = sorted(knots)
    if kind in ("quadratic", "cubic"):
        return F.when(value.isNotNull(), _spline(knots, 2 if kind == "quadratic" else 3, outside)(value.cast("double")))
    out = F
    for (x0, y0), (x1, y1) in zip(knots, knots[1:], strict=False):
        if kind in ("linear", "slinear"):
            piece = F.lit(float(y0)) + (value - x0) * ((y1 - y0) / (x1 - x0))
        elif kind in ("previous", "zero"):
            piece = F.when(value == x1, float(y1)).otherwise(float(y0))
        elif kind == "next":
            piece = F.when(value == x0, float(y0)).otherwise(float(y1))
        else:
            middle = (x0 + x1) / 2
            low = value <= middle if kind == "nearest" else value < middle
            piece = F.when(low, float(y0)).otherwise(float(y1))
        out = out.when((value >= x0) & (value <= x1), piece)
    return out.when(value.isNotNull(), float(outside)).otherwise(None)


def _spline(knots: list[tuple[float, float]], degree: int, outside: float):
    """Interpolating spline with not-a-knot ends, as piecewise polynomials in a pandas UDF."""
    x, y = (np.array(v, float) for v in zip(*knots, strict=True))
    n = len(x)
    degree = min(degree, n - 1)
    # truncated power basis with the inner knots that not-a-knot ends leave
    inner = x[degree // 2 + 1 : n - (degree + 1) // 2] if degree > 1 else x[1:-1]
    if degree == 2:
        inner = (x[1:-2] + x[2:-1]) / 2
    basis = lambda v: np.column_stack([v**k for k in range(degree + 1)] + [np.maximum(v - t, 0) ** degree for t in inner])
    weights = np.linalg.lstsq(basis(x), y, rcond=None)[0]

    @F.pandas_udf("double")
    def of(v: pd.Series) -> pd.Series:
        out = basis(v.to_numpy(float)) @ weights
        return pd.Series(np.where((v >= x[0]) & (v <= x[-1]), out, outside)).where(v.notna().to_numpy())

    return of


def evidence(hand: Column, slope: Column, channel: Column) -> Column:
    """Valley-bottom evidence of a cell."""
    return F.greatest(0.65 * hand + 0.35 * slope, 0.995 * channel)


def zone(value: Column, upper_bounds: list[float | None]) -> Column:
    """Number of the first zone whose upper bound is above the value; an open last zone has the bound None."""
    out = F
    for i, top in enumerate(upper_bounds):
        out = out.when(F.lit(True) if top is None else value < top, i)
    return F.when(value.isNotNull(), out.otherwise(None))
