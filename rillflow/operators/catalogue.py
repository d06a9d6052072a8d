"""Metrics as rows of a catalogue: a row names a calculation over a segment's records and one over a window of segments.

``segments`` evaluates all active rows in one aggregation per segment, ``windows_of`` all their window calculations in one
moving window, so a catalogue of a hundred metrics is one plan.  The catalogue is read on the driver: it has as many rows as
there are metrics.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows
from .aggregates import ratio


@dataclass(frozen=True)
class Metric:
    metric_id: int
    code: str
    calculation: str
    field: str
    window: str | None = None
    #: a second field (the weight, the divisor) of calculations that take one
    by: str | None = None
    is_active: bool = True


#: Calculations of a segment: (value, second value) to an aggregate.
CALCULATIONS: dict[str, Callable[[Column, Column | None], Column]] = {
    "sum": lambda v, _: F.sum(v),
    "count": lambda v, _: F.count(v).cast("double"),
    "min": lambda v, _: F.min(v),
    "max": lambda v, _: F.max(v),
    "mean": lambda v, _: F.avg(v),
    "weighted_mean": lambda v, w: ratio(F.sum(v * w), F.sum(F.when(v.isNotNull(), w))),
    "per": lambda v, d: ratio(F.sum(v), F.sum(d)),
    "longest": lambda v, w: F.min_by(v, F.struct(-w, v)),
}

Sum = Callable[[Column], Column]

#: Calculations of a window from sums over its segments.  ``s`` asks for the sum of an expression of segment columns.
WINDOWS: dict[str, Callable[[Column, Sum], Column]] = {
    "sum": lambda v, s: s(v),
    "sum_div_length": lambda v, s: ratio(s(v), s(F.col("length"))),
    "sum_div_length_km": lambda v, s: ratio(s(v) * 1000.0, s(F.col("length"))),
    "proportion": lambda v, s: ratio(s(v), s(F.col("area"))),
    "area_weighted": lambda v, s: ratio(s(v * F.col("area")), s(F.when(v.isNotNull(), F.col("area")))),
    "length_weighted": lambda v, s: ratio(s(v * F.col("length")), s(F.when(v.isNotNull(), F.col("length")))),
    "acres_per_mile": lambda v, s: windows.acres_per_mile(s(v), s(F.col("length"))),
    "hectares_per_km": lambda v, s: windows.hectares_per_km(s(v), s(F.col("length"))),
}


def read(rows: Iterable[dict] | DataFrame) -> list[Metric]:
    """The active metrics of a catalogue, in the order of their ids; unknown calculations are an error."""
    rows = [r.asDict() for r in rows.collect()] if isinstance(rows, DataFrame) else list(rows)
    fields = Metric.__dataclass_fields__
    found = sorted((Metric(**{k: v for k, v in r.items() if k in fields and v is not None}) for r in rows), key=lambda m: m.metric_id)
    for m in found:
        if m.calculation not in CALCULATIONS or m.window and m.window != "copy" and m.window not in WINDOWS:
            raise ValueError(f"metric {m.code}: no calculation {m.calculation!r} or {m.window!r}")
    return [m for m in found if m.is_active]


def segments(records: DataFrame, metrics: list[Metric], path: str, distance: str, length: str, area: str) -> DataFrame:
    """(path, distance, length, area, one column per metric)."""
    own = [CALCULATIONS[m.calculation](F.col(m.field), F.col(m.by) if m.by else None).alias(m.code) for m in metrics]
    return records.groupBy(path, distance).agg(F.sum(length).alias("length"), F.sum(area).alias("area"), *own)


def windows_of(segments: DataFrame, metrics: list[Metric], path: str, distance: str, width: float | Column, stretch: float | None = None, whole: bool = False) -> DataFrame:
    """(path, distance, one column per metric with a window calculation), for every segment's place.

    A width that is a column is each segment's own; its windows end at whole numbers, cut towards zero, and streams are cut every
    ``stretch``, or not at all if all of a stream is in one partition (``whole``)."""
    wanted = [m for m in metrics if m.window]
    inputs: dict[str, tuple[str, Column]] = {}

    def total(c: Column) -> Column:
        name, _ = inputs.setdefault(str(c), (f"_s{len(inputs)}", c))
        return F.col(f"mw_{name}")

    out = [(F.col(m.code) if m.window == "copy" else WINDOWS[m.window](F.col(m.code), total)).alias(m.code) for m in wanted]
    rows = segments.select("*", *(c.alias(name) for name, c in inputs.values()))
    names = [name for name, _ in inputs.values()]
    if isinstance(width, Column):
        low, high = ((F.col(distance) + sign * width / 2).cast("long") for sign in (-1, 1))
        if whole:
            return windows.whole_windows(rows, path, distance, low, high, sums=names, keep=[m.code for m in wanted if m.window == "copy"]).select(path, distance, *out)
        return windows.own_windows(rows, rows, path, distance, low, high, stretch, sums=names).select(path, distance, *out)
    return windows.moving_window(rows, path, distance, width, sums=names).select(path, distance, *out)


def long_form(wide: DataFrame, metrics: list[Metric], keys: list[str]) -> DataFrame:
    """(keys, metric_id, metric_value): one row per metric with a value, as text."""
    have = [m for m in metrics if m.code in wide.columns]
    pairs = F.explode(F.array(*(F.struct(F.lit(m.metric_id).alias("metric_id"), F.col(m.code).cast("string").alias("metric_value")) for m in have)))
    return wide.select(*keys, pairs.alias("m")).select(*keys, "m.metric_id", "m.metric_value").filter("metric_value is not null")
