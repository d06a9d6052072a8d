"""Moving windows along streams, and other ordered operators.

A window is not computed in one task per stream: streams are as uneven as rivers are.  Rows are first summed up per
(stream, distance), then dealt to stretches of a stream, with copies of the rows near a border for the neighbour, so
that a range frame within a stretch sees all it needs and a long stream is shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship, written
from .aggregates import ratio

#: Window lengths in metres by stream size.
WINDOW_BY_SIZE = {0: 200, 1: 400, 2: 1200, 3: 2000, 4: 8000}
#: A stretch is so many windows long.
STRETCH = 16
#: A stream of up to so many records may be one task's work; longer ones are cut in stretches.
WHOLE = 1 << 18


def per_distance(df: DataFrame, path: str, distance: str, sums: dict[str, Column], mins: dict[str, Column] | None = None, maxs: dict[str, Column] | None = None) -> DataFrame:
    """One row per stream and distance."""
    return df.groupBy(path, distance).agg(*(F.sum(c).alias(n) for n, c in sums.items()), *(F.min(c).alias(n) for n, c in (mins or {}).items()), *(F.max(c).alias(n) for n, c in (maxs or {}).items()))


def moving_window(rows: DataFrame, path: str, distance: str, width: float, sums: list[str] = (), mins: list[str] = (), maxs: list[str] = ()) -> DataFrame:
    """Adds ``mw_<column>``: the sum, minimum or maximum over rows of the same stream within half the width.

    Both ends belong to the window.  ``rows`` has one row per stream and distance.
    """
    half, length = width / 2, max(width, 1e-9) * STRETCH
    cell = F.floor(F.col(distance) / length)
    near = F.array(cell, F.floor((F.col(distance) - half) / length), F.floor((F.col(distance) + half) / length))
    dealt = rows.withColumn("_home", cell).withColumn("_stretch", F.explode(F.array_distinct(near)))
    # as SQL text, because the frame's ends may be fractions
    frame = f"over (partition by `{path}`, _stretch order by cast(`{distance}` as double) range between {half}D preceding and {half}D following)"
    added = [F.expr(f"{f}(`{c}`) {frame}").alias(f"mw_{c}") for f, columns in (("sum", sums), ("min", mins), ("max", maxs)) for c in columns]
    return dealt.select(*rows.columns, "_home", "_stretch", *added).filter("_home = _stretch").drop("_home", "_stretch")


def window_members(anchors: DataFrame, rows: DataFrame, path: str, distance: str, width: Column, widest: float, truncate: bool = True) -> DataFrame:
    """The bridge (anchor columns, row columns): rows within half of the anchor's own window width.

    An equi-join on (stream, cell) with cells as long as the widest window, then the exact range.  Columns of
    ``anchors`` other than the stream are prefixed with ``anchor_``.  ``truncate`` cuts window ends to integers
    towards zero, as one of the two definitions of a window does.
    """
    end = (lambda c: c.cast("long").cast("double")) if truncate else (lambda c: c)
    a = anchors.select(path, *(F.col(c).alias(f"anchor_{c}") for c in anchors.columns if c != path), width.alias("_width"))
    at = F.col(f"anchor_{distance}")
    a = a.withColumn("_from", end(at - F.col("_width") / 2)).withColumn("_to", end(at + F.col("_width") / 2))
    a = a.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") / widest), F.floor(F.col("_to") / widest))))
    r = rows.withColumn("_cell", F.floor(F.col(distance) / widest))
    return a.join(r, [path, "_cell"]).filter(F.col(distance).between(F.col("_from"), F.col("_to"))).drop("_cell", "_from", "_to", "_width")


def _same_path(path: str, other: str) -> Column:
    return F.col(path).eqNullSafe(F.col(other))


def _timeline(asked: DataFrame, rows: DataFrame, path: str, distance: str, values: list[str], stretch: float) -> DataFrame:
    """(path, _low, _high, and per value what lies before each end): sums and counts of the values at distances below ``_low``
    and up to ``_high``, each as a part within the end's stretch of the stream and a part of the stretches before.

    The ends stand in one timeline with the rows, so a running sum answers both, and no window is joined with its rows.
    """
    value = [F.col(v).cast("double").alias(v) for v in values]
    none = [F.lit(None).cast("double").alias(v) for v in values]
    no = F.lit(None).cast("double")
    ends = F.explode(F.array(F.struct(F.col("_low").alias("x"), F.lit(0).alias("kind")), F.struct(F.col("_high").alias("x"), F.lit(2).alias("kind"))))
    events = rows.select(F.col(path).alias("_p"), F.col(distance).cast("double").alias("_x"), F.lit(1).alias("_kind"), no.alias("_low"), no.alias("_high"), *value)
    events = events.unionByName(asked.select(F.col(path).alias("_p"), "_low", "_high", ends.alias("e")).select("_p", F.col("e.x").alias("_x"), F.col("e.kind").alias("_kind"), "_low", "_high", *none))
    events = events.filter("_x is not null").withColumn("_s", F.floor(F.col("_x") / stretch))
    w = Window.partitionBy("_p", "_s").orderBy("_x", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    per = events.groupBy("_p", "_s").agg(*(F.coalesce(F.sum(v), F.lit(0.0)).alias(f"_t_{v}") for v in values), *(F.count(v).alias(f"_k_{v}") for v in values))
    before = Window.partitionBy("_p").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("_p").alias("_q"), F.col("_s").alias("_qs"), *(F.coalesce(F.sum(f"{t}{v}").over(before), F.lit(0)).alias(f"_b{t}{v}") for v in values for t in ("_t_", "_k_")))
    here = events.withColumns({f"_t_{v}": F.coalesce(F.sum(v).over(w), F.lit(0.0)) for v in values} | {f"_k_{v}": F.count(v).over(w) for v in values}).filter("_kind <> 1").drop(*values)
    met = here.join(per, _same_path("_p", "_q") & (F.col("_s") == F.col("_qs"))).drop("_q", "_qs")
    at = lambda kind, c: F.max(F.when(F.col("_kind") == kind, F.col(c)))
    return met.groupBy("_p", "_low", "_high").agg(*(at(kind, f"{b}{t}{v}").alias(f"{b}{t}{kind}_{v}") for v in values for t in ("_t_", "_k_") for b in ("", "_b") for kind in (0, 2)))


def own_windows(anchors: DataFrame, rows: DataFrame, path: str, distance: str, low: Column, high: Column, stretch: float, sums: list[str] = (), mins: list[str] = (), maxs: list[str] = ()) -> DataFrame:
    """The anchors with ``mw_<column>``: the sum, minimum or maximum over the rows of the same stream from ``low`` to ``high``,
    both ends included, which each anchor has its own of.

    Sums are differences of running sums, minima and maxima come from tables of the extremes of 2^k rows, of which two cover
    any window; so what a window costs does not grow with its width.  A window without values gives null, and so does
    one with an end that is null.  A sum is as exact as the running sums of its stream's stretches are.  A column is in one of the
    three lists only.
    """
    keyed = anchors.withColumns({"_low": low.cast("double"), "_high": high.cast("double")})
    asked = keyed.filter("_low <= _high").select(path, "_low", "_high").distinct()
    extremes = [*mins, *maxs]
    numbered = rows.withColumn("_row", F.lit(1.0))
    values = [*sums, *(["_row"] if extremes else [])]
    found = _timeline(asked, numbered, path, distance, values, stretch)
    total = lambda t, v: (F.col(f"{t}2_{v}") - F.col(f"{t}0_{v}")) + (F.col(f"_b{t}2_{v}") - F.col(f"_b{t}0_{v}"))
    out = found.select("_p", "_low", "_high", *(F.when(total("_k_", v) > 0, total("_t_", v)).alias(f"mw_{v}") for v in sums), *([(F.col("_k_0__row") + F.col("_b_k_0__row")).alias("_from"), total("_k_", "_row").alias("_n")] if extremes else []))
    if extremes:
        out = _extremes(out, rows, path, distance, list(mins), list(maxs), stretch)
    names = [f"mw_{c}" for c in (*sums, *extremes)]
    found = out.select("_p", F.col("_low").alias("_l"), F.col("_high").alias("_h"), *names)
    return keyed.join(found, _same_path(path, "_p") & (F.col("_low") == F.col("_l")) & (F.col("_high") == F.col("_h")), "left").select(*anchors.columns, *names)


def _extremes(asked: DataFrame, rows: DataFrame, path: str, distance: str, mins: list[str], maxs: list[str], stretch: float) -> DataFrame:
    """Adds the extremes of the ``_n`` rows after the first ``_from`` ones of the stream."""
    both = [(f"_min_{c}", F.min, F.least, c) for c in mins] + [(f"_max_{c}", F.max, F.greatest, c) for c in maxs]
    cut = rows.filter(F.col(distance).isNotNull()).select(F.col(path).alias("_r"), F.col(distance).cast("double").alias("_x"), *(F.col(c).alias(n) for n, _, _, c in both)).withColumn("_s", F.floor(F.col("_x") / stretch))
    per = cut.groupBy("_r", "_s").agg(F.count(F.lit(1)).alias("_k"))
    per = per.select(F.col("_r").alias("_q"), F.col("_s").alias("_qs"), F.coalesce(F.sum("_k").over(Window.partitionBy("_r").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    names = [n for n, *_ in both]
    placed = cut.withColumn("_i", F.row_number().over(Window.partitionBy("_r", "_s").orderBy("_x")) - 1).join(per, _same_path("_r", "_q") & (F.col("_s") == F.col("_qs")))
    table = written(placed.select("_r", F.lit(0).alias("_level"), (F.col("_i") + F.col("_before")).alias("_i"), *names))
    size = lambda level: F.pow(F.lit(2.0), level).cast("long")
    near = F.floor(F.log2("_n")).cast("int")  # the logarithm is rounded
    asked = written(asked.withColumn("_lv", F.when(F.col("_n") > 0, F.when(size(near + 1) <= F.col("_n"), near + 1).when(size(near) > F.col("_n"), near - 1).otherwise(near))))
    highest = asked.agg(F.max("_lv")).first()[0] or 0
    tables, last = table, table
    for k in range(highest):
        # row i of the next level covers 2^k rows from i on and 2^k from i + 2^k on
        shifted = last.withColumn("_i", F.col("_i") - (1 << k)).filter("_i >= 0")
        merged = last.unionByName(shifted).groupBy("_r", "_i").agg(*(how(n).alias(n) for n, how, _, _ in both))
        last = written(merged.select("_r", F.lit(k + 1).alias("_level"), "_i", *names))
        tables = tables.unionByName(last)
    starts = F.explode(F.array_distinct(F.array(F.col("_from"), F.col("_from") + F.col("_n").cast("long") - size(F.col("_lv")))))
    looked = asked.filter("_lv is not null").withColumn("_at", starts)
    met = looked.join(tables, _same_path("_p", "_r") & (F.col("_lv") == F.col("_level")) & (F.col("_at") == F.col("_i")))
    best = met.groupBy("_p", "_low", "_high").agg(*(how(n).alias(f"mw_{c}") for n, how, _, c in both))
    best = best.select(F.col("_p").alias("_bp"), F.col("_low").alias("_bl"), F.col("_high").alias("_bh"), *(f"mw_{c}" for *_, c in both))
    return asked.join(best, _same_path("_p", "_bp") & (F.col("_low") == F.col("_bl")) & (F.col("_high") == F.col("_bh")), "left")


def by_size(records: DataFrame, path: str, whole: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``whole`` of the records of streams that have up to ``WHOLE``, dealt by stream, and ``cut`` of those of the others.

    Whole streams are shuffled once, as the records they come from, and are where their windows are; stretches hand on what
    others need of them, and are for streams that no task should have alone.  Of the latter there are few, so they are broadcast.
    """
    long = written(records.groupBy(F.col(path).alias("_long")).count().filter(F.col("count") > WHOLE).select("_long"))
    if long.isEmpty():
        return whole(records.repartition(path))
    on = _same_path(path, "_long")
    return whole(records.join(F.broadcast(long), on, "left_anti").repartition(path)).unionByName(cut(records.join(F.broadcast(long), on, "left_semi")))


def whole_windows(rows: DataFrame, path: str, distance: str, low: Column, high: Column, sums: list[str] = (), mins: list[str] = (), maxs: list[str] = (), keep: list[str] = ()) -> DataFrame:
    """(path, distance, ``keep``, mw columns): ``own_windows`` of the rows themselves, where all rows of a stream are in one partition
    already (``by_size``), so nothing is shuffled.  Values are taken as double."""
    spark = rows.sparkSession
    ship(spark)
    values = [*sums, *mins, *maxs]
    names = [f"mw_{c}" for c in values]
    x = F.col(distance).cast("double")
    kept = [path, distance, *keep]
    given = rows.select(*kept, x.alias("_x"), low.cast("double").alias("_low"), high.cast("double").alias("_high"), *(F.col(c).cast("double").alias(f"_v_{c}") for c in values))
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), *(f"`{n}` double" for n in names)])
    return given.sortWithinPartitions(path, distance).mapInArrow(partial(_whole, path=path, keep=kept, sums=list(sums), mins=list(mins), maxs=list(maxs)), schema)


def _whole(batches: Iterator, path: str, keep: list[str], sums: list[str], mins: list[str], maxs: list[str]) -> Iterator:
    """Batches sorted by stream and distance, with the windows' values; a stream is held until it is complete."""
    import pyarrow as pa

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        stream = batch.column(path)
        codes = stream.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(codes[1:] != codes[:-1]) + 1
        if held and stream[0] != last:
            yield _measured(pa.Table.from_batches(held), path, keep, sums, mins, maxs)
            held = []
        if len(starts):
            yield _measured(pa.Table.from_batches([*held, batch.slice(0, starts[-1])]), path, keep, sums, mins, maxs)
            held = []
        held.append(batch.slice(starts[-1]) if len(starts) else batch)
        last = stream[batch.num_rows - 1]
    if held:
        yield _measured(pa.Table.from_batches(held), path, keep, sums, mins, maxs)


def _measured(table, path: str, keep: list[str], sums: list[str], mins: list[str], maxs: list[str]):
    """Complete streams with the values of their windows: differences of each stream's running sums, and two look-ups in a
    table of the extremes of 2^k rows."""
    import pyarrow as pa

    table = table.combine_chunks()
    double = lambda c: table.column(c).to_numpy(zero_copy_only=False).astype(float)  # null is NaN
    null = lambda c: table.column(c).is_null().to_numpy(zero_copy_only=False)
    codes = table.column(path).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    stream = np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])]) if len(codes) else codes
    x, low, high = double("_x"), double("_low"), double("_high")

    def key(at: np.ndarray, of: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), complex)  # ordered by stream, then place
        out.real, out.imag = of, at
        return out

    member = np.flatnonzero(~np.isnan(x))
    places = key(x[member], stream[member])
    asking = low <= high  # not if either is null
    first, end = np.zeros(len(x), int), np.zeros(len(x), int)
    first[asking] = np.searchsorted(places, key(low[asking], stream[asking]), "left")
    end[asking] = np.searchsorted(places, key(high[asking], stream[asking]), "right")
    some = np.flatnonzero(end > first)
    a, b = first[some], end[some]
    begins = np.searchsorted(stream[member], np.arange(stream[-1] + 1), "left")

    values = [*sums, *mins, *maxs]
    known = np.stack([~null(f"_v_{c}")[member] for c in values], 1)
    counts = np.concatenate([np.zeros((1, len(values)), int), np.cumsum(known, 0)])
    found = (counts[b] - counts[a]) > 0
    out = {}
    if sums:
        given = np.stack([np.where(known[:, k], double(f"_v_{c}")[member], 0.0) for k, c in enumerate(sums)], 1)
        running = np.empty_like(given)
        for i, j in zip(begins, [*begins[1:], len(member)], strict=True):
            np.cumsum(given[i:j], 0, out=running[i:j])
        before = np.where((a > begins[stream[some]])[:, None], running[np.maximum(a - 1, 0)], 0.0)
        total = running[b - 1] - before
        out |= {c: total[:, k] for k, c in enumerate(sums)}
    level = np.frexp((b - a).astype(float))[1] - 1
    for columns, nothing, how in ((mins, np.nan, np.fmin), (maxs, -np.inf, np.maximum)):  # NaN is the largest value
        for c in columns:
            last, best = np.where(known[:, values.index(c)], double(f"_v_{c}")[member], nothing), np.empty(len(some))
            for k in range(level.max(initial=-1) + 1):
                last = how(last[: -(1 << k - 1)], last[1 << k - 1 :]) if k else last
                at = level == k
                best[at] = how(last[a[at]], last[b[at] - (1 << k)])
            out[c] = best
    columns = [table.column(c) for c in keep]
    for k, c in enumerate(values):
        v, none = np.zeros(len(x)), np.ones(len(x), bool)
        v[some], none[some] = out[c], ~found[:, k]
        columns.append(pa.array(v, pa.float64(), mask=none))
    batch = pa.table(columns, names=[*keep, *(f"mw_{c}" for c in values)]).combine_chunks()
    return batch.to_batches()[0]


def spacing(rows: DataFrame, path: str, distance: str) -> DataFrame:
    """(stream, spacing): the difference of a stream's two smallest distances; null with fewer than two.

    Two aggregations with partial results instead of a list of a stream's distances.
    """
    least = rows.groupBy(path).agg(F.min(distance).alias("_least"))
    second = rows.join(least, path).filter(F.col(distance) > F.col("_least")).groupBy(path).agg(F.min(distance).alias("_second"))
    return least.join(second, path, "left").select(path, (F.col("_second") - F.col("_least")).alias("spacing"))


def window_width(stream_size: Column, step: Column) -> Column:
    """Width by stream size, twice the spacing at least."""
    sizes = F.create_map(*(F.lit(x) for kv in WINDOW_BY_SIZE.items() for x in kv))
    return F.greatest(F.element_at(sizes, stream_size).cast("double"), F.coalesce(2 * step, F.lit(0.0)).cast("double"))


def neighbours(rows: DataFrame, path: str, distance: str, key: str, stretch: float) -> DataFrame:
    """(path, distance, key, before, behind): the neighbours in the order of distance on the same stream.

    A stream is cut into stretches, so that a long one is shared by many tasks; the first and last rows of a stretch meet
    those of the nearest stretches with rows, of which there is one row each.
    """
    cut = rows.select(path, distance, key).withColumn("_s", F.floor(F.col(distance) / stretch))
    order = F.struct(distance, key)
    ends = cut.groupBy(path, "_s").agg(F.min_by(key, order).alias("_first"), F.max_by(key, order).alias("_last"))
    along = Window.partitionBy(path).orderBy("_s")
    ends = ends.select(path, "_s", F.lag("_last").over(along).alias("_before"), F.lead("_first").over(along).alias("_behind"))
    w = Window.partitionBy(path, "_s").orderBy(distance, key)
    inner = cut.withColumn("_lag", F.lag(key).over(w)).withColumn("_lead", F.lead(key).over(w))
    return inner.join(ends, [path, "_s"]).select(path, distance, key, F.coalesce("_lag", "_before").alias("before"), F.coalesce("_lead", "_behind").alias("behind"))


# window metrics, over columns that moving_window has added


def per_length(total: Column, length: Column, per_km: bool = False, most: float | None = None) -> Column:
    out = ratio(total * (1000.0 if per_km else 1.0), length)
    return F.least(out, F.lit(most)) if most is not None else out


def gradient(high: Column, low: Column, length: Column) -> Column:
    return ratio(high - low, length)


def stream_power(slope: Column, flow: Column) -> Column:
    """Of a window: cubic feet a second to cubic metres, times the weight of water."""
    return slope * flow * 0.0283168 * 9810.0


def reach_power(slope: Column, flow: Column) -> Column:
    """Of a reach, rounded; the constants differ from those of a window."""
    return F.round(1000 * 9.80665 * slope * flow * 0.028316846592, 2)


def acres_per_mile(area: Column, length: Column) -> Column:
    """Square metres and metres to acres a mile."""
    return ratio(area * 0.000247105, length / 1609.34)


def hectares_per_km(area: Column, length: Column) -> Column:
    return ratio(area / 10000.0, length / 1000.0)
