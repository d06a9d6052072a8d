"""Rule tables: risk, limitation, opportunity, dam setting, departure, conversion, reach type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.filters import last_wins

CONSIDERABLE, SOME, MINOR, NEGLIGIBLE = "Considerable Risk", "Some Risk", "Minor Risk", "Negligible Risk"


def dam_risk(capacity: Column, land_use: Column, canal: Column, road_crossing: Column, road: Column, rail: Column) -> Column:
    """Distances in metres; unknown ones are skipped, and without any, or without land use, risk is negligible."""
    near = F.least(road_crossing, road, rail)  # skips nulls
    dense = F.coalesce(capacity >= 5, F.lit(False))
    return (
        F.when(canal <= 20, CONSIDERABLE)
        .when(near.isNull() | land_use.isNull(), NEGLIGIBLE)
        .when((near <= 30) | (land_use >= 66), F.when(dense, CONSIDERABLE).otherwise(SOME))
        .when(near <= 100, F.when(dense, SOME).otherwise(MINOR))
        .when((near <= 300) | (land_use >= 33), MINOR)
        .otherwise(NEGLIGIBLE)
    )


def dam_limitation(historic_veg: Column, veg: Column, capacity: Column, slope: Column, land_use: Column, base_power: Column, flood_power: Column, drainage: Column, max_drainage: Column) -> Column:
    small_enough = max_drainage.isNull() | F.coalesce(drainage < max_drainage, F.lit(False))
    return (
        F.when(historic_veg <= 0, F.when(veg > 0, "Potential Reservoir or Land Use Change").otherwise("Naturally Vegetation Limited"))
        .when(drainage > max_drainage, "Stream Size Limited")
        .when(slope > 0.23, "Slope Limited")
        .when(F.coalesce(base_power >= 190, F.lit(False)) | F.coalesce(flood_power >= 2400, F.lit(False)), "Stream Power Limited")
        .when(capacity <= 0, F.when(small_enough & (land_use > 30), "Anthropogenically Limited").otherwise("Other"))
        .otherwise("Dam Building Possible")
    )


def dam_opportunity(risk: Column, reach_code: Column, capacity: Column, veg: Column, low_use: Column, high_use: Column, setting: Column) -> Column:
    """A capacity of exactly 10 is in neither of the upper classes, as published."""
    limited = F.lit("Natural or Anthropogenic Limitations")
    known = capacity.isNotNull() & reach_code.isNotNull() & low_use.isNotNull() & high_use.isNotNull()
    safe = risk.isin(NEGLIGIBLE, MINOR)
    channel = setting.isin("Classic", "Steep")
    large = (capacity > 10) | ((capacity >= 5) & (capacity < 10))
    pristine = low_use > 90
    perennial = (
        F.when(channel & safe & large, F.when(pristine, "Conservation/Appropriate for Translocation").otherwise("Encourage Beaver Expansion/Colonization"))
        .when(channel & safe, F.when(pristine, limited).otherwise("Land Management Change"))
        .when(channel & (capacity > 5), "Conflict Management")
        .when(channel, F.when(high_use >= 50, limited).otherwise("Beaver Mimicry"))
        .when((setting == "Floodplain") & safe & (veg >= 5) & ~(high_use > 25), "Potential Floodplain/Side Channel Opportunities")
        .otherwise(limited)
    )
    return F.when(~known, limited).when(reach_code.isin(46006, 55800), perennial).when((reach_code == 46003) & channel & safe, "Beaver Mimicry").otherwise(limited)


def riparian_departure(existing: Column, historic: Column) -> tuple[Column, Column]:
    """(ratio, class 1..6): 1 negligible, 2 minor, 3 significant, 4 large, 5 increase, 6 nothing to compare.

    A ratio of exactly 1 is an increase, as published.
    """
    ratio = F.when(F.coalesce(historic, F.lit(0.0)) != 0, existing / F.nullif(historic, F.lit(0.0)))
    cls = F.when(ratio.isNull(), 6).when(ratio >= 1, 5).when(ratio >= 0.9, 1).when(ratio >= 0.66, 2).when(ratio >= 0.33, 3).otherwise(4)
    return ratio, cls


def dominant(shares: list[Column], tie: int = 12) -> tuple[Column, Column]:
    """(number of the largest share counted from 1, its value); a later share equal to the largest so far makes a tie,
    and so do shares of zero before any other, as published."""
    items = F.array(*(F.struct(F.lit(i + 1).alias("i"), F.coalesce(s, F.lit(0.0)).cast("double").alias("v")) for i, s in enumerate(shares)))
    start = F.struct(F.lit(tie).alias("i"), F.lit(0.0).alias("v"))
    best = F.aggregate(items, start, lambda a, x: F.when(x["v"] > a["v"], x).when(x["v"] == a["v"], F.struct(F.lit(tie).alias("i"), a["v"].alias("v"))).otherwise(a))
    return best["i"], best["v"]


def conversion_level(share: Column) -> Column:
    """0 to 4 by the share of the dominant conversion."""
    return F.when(share.isNull() | (share <= 0), 0).when(share < 0.1, 1).when(share < 0.25, 2).when(share < 0.5, 3).otherwise(4)


def reach_type(perennial: Column, intermittent: Column, canal: Column) -> Column:
    """Later kinds override earlier ones."""
    return last_wins([(perennial, "Perennial"), (intermittent, "Intermittent"), (canal, "Canal")], "Other")


def owner_class(owner: Column, of: str = "BLM") -> Column:
    return F.when(owner == of, of).otherwise(f"Non-{of}")


def basin_shape(area: Column, perimeter: Column, length: Column, relief: Column, streams: Column) -> dict[str, Column]:
    """Shape of a catchment: circularity, elongation, form factor, relief ratio and drainage density."""
    of = lambda a, b: a / F.nullif(b, F.lit(0.0))
    return {
        "circularity": of(4 * F.pi() * area, perimeter * perimeter),
        "elongation": of(F.sqrt(area), length),
        "form_factor": of(area, length * length),
        "relief_ratio": of(relief, length),
        "drainage_density": of(streams, area),
    }
