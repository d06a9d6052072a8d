"""Fuzzy inference: memberships and rules are column expressions, the centroid an Arrow-batched function.

AND is the minimum, OR the maximum, NOT one minus, terms are clipped at their strength and joined by the maximum.  The
joined shape is piecewise linear, so its centroid is integrated exactly between its corners.  A row that fires no rule,
or has a null input, gets null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import ship

Shape = tuple[float, ...]


def membership(x: Column, shape: Shape) -> Column:
    """A triangle (a, b, c) or trapezoid (a, b, c, d); vertical sides are closed."""
    a, b, c, d = shape if len(shape) == 4 else (shape[0], shape[1], shape[1], shape[2])
    out = F.when(x.isNull(), None).when((x >= b) & (x <= c), 1.0)
    if b > a:
        out = out.when((x > a) & (x < b), (x - a) / (b - a))
    if d > c:
        out = out.when((x > c) & (x < d), (d - x) / (d - c))
    return out.otherwise(0.0)


@dataclass(frozen=True)
class System:
    inputs: dict[str, dict[str, Shape]]
    output: dict[str, Shape]
    #: (conditions, term): all conditions hold; one is (input, terms), any of the terms, and "!term" is its negation.
    rules: tuple[tuple[tuple[tuple[str, str], ...], str], ...]
    ranges: dict[str, tuple[float, float]]

    def strengths(self, columns: dict[str, Column]) -> dict[str, Column]:
        x = {n: F.least(F.greatest(columns[n].cast("double"), F.lit(lo)), F.lit(hi)) for n, (lo, hi) in self.ranges.items()}
        known = F.lit(True)
        for n in x:
            known = known & columns[n].isNotNull()

        def one(name: str, terms: str) -> Column:
            parts = [1 - membership(x[name], self.inputs[name][t[1:]]) if t[0] == "!" else membership(x[name], self.inputs[name][t]) for t in terms.split("|")]
            return parts[0] if len(parts) == 1 else F.greatest(*parts)

        out = {}
        for term in self.output:
            fired = []
            for conditions, to in self.rules:
                if to == term:
                    parts = [one(*c) for c in conditions]
                    fired.append(parts[0] if len(parts) == 1 else F.least(*parts))
            out[term] = F.when(known, fired[0] if len(fired) == 1 else F.greatest(*fired)) if fired else F.lit(0.0)
        return out

    def evaluate(self, **columns: Column) -> Column:
        of = centroid_of(self.output)
        return of(F.array(*self.strengths(columns).values()))


def _corners(shape: Shape) -> tuple[float, float, float, float]:
    return tuple(shape) if len(shape) == 4 else (shape[0], shape[1], shape[1], shape[2])


def centroids(shapes: list[Shape], levels: np.ndarray) -> np.ndarray:
    """Centroid of the union of clipped shapes for each row of levels; nan where nothing fires."""
    quads = np.array([_corners(s) for s in shapes], float)
    a, b, c, d = quads.T
    fixed = list(quads.ravel())
    for i in range(len(quads)):  # where unclipped sides cross
        for j in range(len(quads)):
            if i != j and d[i] > c[i] and b[j] > a[j]:
                s, t = 1 / (d[i] - c[i]), 1 / (b[j] - a[j])
                fixed.append((d[i] * s + a[j] * t) / (s + t))
    n = len(levels)
    at = levels[:, None, :]  # every side meets every level
    up = (a + 0 * a)[None, :, None] + at * (b - a)[None, :, None]
    down = d[None, :, None] - at * (d - c)[None, :, None]
    x = np.concatenate([np.broadcast_to(np.array(fixed), (n, len(fixed))), up.reshape(n, -1), down.reshape(n, -1)], axis=1)
    x = np.clip(np.sort(x, axis=1), a.min(), d.max())

    def height(v: np.ndarray) -> np.ndarray:
        best = np.zeros_like(v)
        for k in range(len(quads)):
            rise = np.where(v >= b[k], 1.0, (v - a[k]) / (b[k] - a[k]) if b[k] > a[k] else 0.0)
            fall = np.where(v <= c[k], 1.0, (d[k] - v) / (d[k] - c[k]) if d[k] > c[k] else 0.0)
            best = np.maximum(best, np.minimum(np.clip(np.minimum(rise, fall), 0, 1), levels[:, k : k + 1]))
        return best

    left, right = x[:, :-1], x[:, 1:]
    width = right - left
    # the shape is linear inside a piece, but may jump at its ends: two heights inside say all
    h0, h1 = height(left + width / 4), height(right - width / 4)
    area = width * (h0 + h1) / 2
    moment = area * (left + right) / 2 + (h1 - h0) * width * width / 6
    total = area.sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total > 0, moment.sum(axis=1) / total, np.nan)


def centroid_of(output: dict[str, Shape]):
    shapes = list(output.values())
    ship(SparkSession.active())

    @F.pandas_udf("double")
    def of(levels: pd.Series) -> pd.Series:
        rows = np.array([np.array([np.nan if v is None else v for v in r], float) for r in levels]).reshape(len(levels), len(shapes))
        known = ~np.isnan(rows).any(axis=1)
        out = np.full(len(rows), np.nan)
        for s in range(0, len(rows), 4096):
            k = np.flatnonzero(known[s : s + 4096]) + s
            if len(k):
                out[k] = centroids(shapes, rows[k])
        return pd.Series(out).astype(object).where(~np.isnan(out), None)

    return of


def _rules(names: str, text: str) -> tuple:
    """Rules from lines: a cell per input (* for any) and the outcome."""
    keys = names.split()
    rows = [line.split() for line in text.strip().splitlines()]
    return tuple((tuple((k, c) for k, c in zip(keys, row, strict=False) if c != "*"), row[-1]) for row in rows)


# Memberships and outcomes of the four systems.
_SUITABILITY = {"unsuitable": (0, 0, 0.1, 1), "barely": (0.1, 1, 2), "moderately": (1, 2, 3), "suitable": (2, 3, 4), "preferred": (3, 4, 4)}
_DENSITY = {"none": (0, 0, 0.1), "rare": (0, 0.1, 0.5, 1.5), "occasional": (0.5, 1.5, 4, 8), "frequent": (4, 8, 12, 25), "pervasive": (12, 25, 45, 45)}

VEGETATION = System(
    inputs={"riparian": _SUITABILITY, "streamside": _SUITABILITY},
    output=_DENSITY,
    rules=_rules("riparian streamside", """
        unsuitable unsuitable none
        barely unsuitable rare
        moderately unsuitable rare
        suitable unsuitable occasional
        preferred unsuitable occasional
        unsuitable barely rare
        barely barely rare
        moderately barely occasional
        suitable barely occasional
        preferred barely occasional
        unsuitable moderately rare
        barely moderately occasional
        moderately moderately occasional
        suitable moderately frequent
        preferred moderately frequent
        unsuitable suitable occasional
        barely suitable occasional
        moderately suitable frequent
        suitable suitable frequent
        preferred suitable pervasive
        unsuitable preferred occasional
        barely preferred frequent
        moderately preferred pervasive
        suitable preferred pervasive
        preferred preferred pervasive"""),
    ranges={"riparian": (0, 4), "streamside": (0, 4)},
)

COMBINED = System(
    inputs={
        "vegetation": _DENSITY,
        "flood_power": {"persists": (0, 0, 1000, 1200), "breach": (1000, 1200, 1600), "oblowout": (1200, 1600, 2400), "blowout": (1600, 2400, 10000, 10000)},
        "base_power": {"can": (0, 0, 150, 175), "probably": (150, 175, 180, 190), "cannot": (180, 190, 10000, 10000)},
        "slope": {"flat": (0, 0, 0.0002, 0.005), "can": (0.0002, 0.005, 0.12, 0.15), "probably": (0.12, 0.15, 0.17, 0.23), "cannot": (0.17, 0.23, 1, 1)},
    },
    output=_DENSITY,
    rules=_rules("vegetation flood_power base_power slope", """
        none * * * none
        * * cannot * none
        * * * cannot none
        rare persists can !cannot rare
        rare persists probably !cannot rare
        rare breach can !cannot rare
        rare breach probably !cannot rare
        rare oblowout can !cannot rare
        rare oblowout probably !cannot rare
        rare blowout can !cannot none
        rare blowout probably !cannot none
        occasional persists can !cannot occasional
        occasional persists probably !cannot occasional
        occasional breach can !cannot occasional
        occasional breach probably !cannot occasional
        occasional oblowout can !cannot occasional
        occasional oblowout probably !cannot rare
        occasional blowout can !cannot rare
        occasional blowout probably !cannot rare
        frequent persists can flat occasional
        frequent persists can can frequent
        frequent persists can probably occasional
        frequent persists probably flat occasional
        frequent persists probably can frequent
        frequent persists probably probably occasional
        frequent breach can flat occasional
        frequent breach can can frequent
        frequent breach can probably occasional
        frequent breach probably flat occasional
        frequent breach probably can frequent
        frequent breach probably probably occasional
        frequent oblowout can flat occasional
        frequent oblowout can can frequent
        frequent oblowout can probably occasional
        frequent oblowout probably flat rare
        frequent oblowout probably can occasional
        frequent oblowout probably probably rare
        frequent blowout can flat rare
        frequent blowout can can rare
        frequent blowout can probably rare
        frequent blowout probably flat rare
        frequent blowout probably can rare
        frequent blowout probably probably none
        pervasive persists can flat frequent
        pervasive persists can can pervasive
        pervasive persists can probably occasional
        pervasive persists probably flat frequent
        pervasive persists probably can pervasive
        pervasive persists probably probably frequent
        pervasive breach can flat occasional
        pervasive breach can can frequent
        pervasive breach can probably occasional
        pervasive breach probably flat occasional
        pervasive breach probably can frequent
        pervasive breach probably probably occasional
        pervasive oblowout can flat occasional
        pervasive oblowout can can frequent
        pervasive oblowout can probably occasional
        pervasive oblowout probably flat occasional
        pervasive oblowout probably can occasional
        pervasive oblowout probably probably rare
        pervasive blowout can flat rare
        pervasive blowout can can occasional
        pervasive blowout can probably rare
        pervasive blowout probably flat rare
        pervasive blowout probably can rare
        pervasive blowout probably probably rare"""),
    ranges={"vegetation": (0, 45), "flood_power": (0, 10000), "base_power": (0, 10000), "slope": (0, 1)},
)

CONDITION = System(
    inputs={
        "departure": {"large": (0, 0, 0.3, 0.5), "significant": (0.3, 0.5, 0.85), "minor": (0.5, 0.85, 0.95), "negligible": (0.85, 0.95, 1, 1)},
        "land_use": {"low": (0, 0, 41.6, 58.3), "moderate": (41.6, 58.3, 83, 98.3), "high": (83, 98.3, 100, 100)},
        "access": {"low": (0, 0, 0.5, 0.7), "moderate": (0.5, 0.7, 0.9, 0.95), "high": (0.9, 0.95, 1, 1)},
    },
    output={"very_poor": (0, 0, 0.1), "poor": (0, 0.1, 0.3, 0.5), "moderate": (0.3, 0.5, 0.6, 0.8), "good": (0.6, 0.8, 0.95, 1), "intact": (0.95, 1, 1)},
    rules=_rules("departure land_use access", """
        large low low poor
        large low moderate poor
        large low high moderate
        large moderate low poor
        * moderate moderate moderate
        large moderate high poor
        large high low very_poor
        significant|minor|negligible high low poor
        * high moderate poor
        * high high moderate
        significant low low moderate
        significant low moderate moderate
        significant low high good
        significant moderate low poor
        significant moderate high moderate
        minor low low moderate
        minor low moderate good
        minor low high intact
        minor moderate low moderate
        minor moderate high moderate
        negligible low low moderate
        negligible low moderate good
        negligible low high intact
        negligible moderate low moderate
        negligible moderate high good"""),
    ranges={"departure": (0, 1), "land_use": (0, 100), "access": (0, 1)},
)

GRAZING = System(
    inputs={
        "water": {"close": (0, 0, 100, 500), "moderately_far": (100, 500, 800, 2000), "too_far": (800, 2000, 50000, 50000)},
        "slope": {"flat": (0, 0, 2, 3), "gentle": (2, 3, 11, 17), "too_steep": (11, 17, 100, 100)},
        "vegetation": {"unsuitable": (0, 0, 0.5, 1), "barely": (0.5, 1, 1.5, 2), "moderately": (1.5, 2, 2.5, 3), "suitable": (2.5, 3, 3.5, 4), "preferred": (3.5, 4, 4)},
    },
    output={"none": (0, 0, 0.0005), "low": (0, 0.0005, 0.4, 0.5), "moderate": (0.4, 0.5, 0.9, 0.95), "high": (0.9, 0.95, 1, 1)},
    # barely suitable vegetation on a gentle slope close to water stands twice in the published table, as low and as moderate
    rules=_rules("vegetation slope water", """
        unsuitable * * none
        barely gentle close moderate
        barely flat close low
        moderately flat close low
        suitable flat close moderate
        preferred flat close high
        barely gentle close low
        moderately gentle close low
        suitable gentle close low
        preferred gentle close moderate
        barely too_steep close low
        moderately too_steep close low
        suitable too_steep close low
        preferred too_steep close low
        barely flat moderately_far low
        moderately flat moderately_far low
        suitable flat moderately_far low
        preferred flat moderately_far moderate
        barely gentle moderately_far none
        moderately gentle moderately_far low
        suitable gentle moderately_far low
        preferred gentle moderately_far low
        barely too_steep moderately_far none
        moderately too_steep moderately_far none
        suitable too_steep moderately_far low
        preferred too_steep moderately_far low
        barely flat too_far none
        moderately flat too_far none
        suitable flat too_far low
        preferred flat too_far moderate
        barely gentle too_far none
        moderately gentle too_far none
        suitable gentle too_far none
        preferred gentle too_far low
        barely too_steep too_far none
        moderately too_steep too_far none
        suitable too_steep too_far none
        preferred too_steep too_far low"""),
    ranges={"water": (0, 50000), "slope": (0, 100), "vegetation": (0, 4)},
)


def _centroid(output: dict[str, Shape], term: str) -> float:
    levels = np.array([[1.0 if t == term else 0.0 for t in output]])
    return float(centroids(list(output.values()), levels)[0])


def _is_none(r: Column, output: dict[str, Shape]) -> Column:
    """Whether a result is that of ``none`` alone at full strength, to six digits."""
    return F.round(r, 6) == round(_centroid(output, "none"), 6)


def vegetation_capacity(riparian: Column, streamside: Column) -> Column:
    """Dams a kilometre that vegetation allows: 0 for a result that is all ``none``, 40 for one as high as ``pervasive``."""
    r = VEGETATION.evaluate(riparian=riparian, streamside=streamside)
    r = F.when(_is_none(r, _DENSITY), 0.0).otherwise(r)
    return F.round(F.when(F.round(r) >= round(_centroid(_DENSITY, "pervasive")), 40.0).otherwise(r), 2)


def unrounded_capacity(vegetation: Column, flood_power: Column, base_power: Column, slope: Column, drainage: Column, reach_code: Column, max_drainage: Column) -> Column:
    """Dams a kilometre, at most what vegetation allows; above the drainage limit only canals (33600) hold any."""
    r = F.least(COMBINED.evaluate(vegetation=vegetation, flood_power=flood_power, base_power=base_power, slope=slope), vegetation)
    r = F.when(_is_none(r, _DENSITY), 0.0).otherwise(r)
    open_to_dams = max_drainage.isNull() | (drainage < max_drainage) | (reach_code == 33600)
    return F.when(open_to_dams, r).otherwise(0.0)


def combined_capacity(*inputs: Column) -> Column:
    """``unrounded_capacity`` to two digits."""
    return F.round(unrounded_capacity(*inputs), 2)


def dam_count(unrounded: Column, length_m: Column) -> Column:
    """Dams of a reach from its capacity before rounding; a fraction of a dam is one."""
    n = unrounded * length_m / 1000.0
    return F.round(F.when((n > 0) & (n < 1), 1.0).otherwise(n), 2)


def riparian_condition(departure: Column, land_use: Column, access: Column) -> Column:
    """0 to 1; a departure over 1 counts as far below it."""
    folded = F.when(departure >= 1, 2 - departure).otherwise(departure)
    r = CONDITION.evaluate(departure=folded, land_use=land_use, access=access)
    return F.round((r - 0.033) / (0.9766 - 0.033), 2)


def grazing_likelihood(water: Column, slope: Column, vegetation: Column) -> Column:
    r = GRAZING.evaluate(water=water, slope=slope, vegetation=vegetation)
    return F.when(_is_none(r, GRAZING.output), 0.0).otherwise(r)
