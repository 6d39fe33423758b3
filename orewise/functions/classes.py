"""Decision lists: materials, object forms and alerts as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from .columns import brightness, ratio


# The thresholds, class names and reasons in the decision lists below.


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def commodity(r: Column, g: Column, b: Column, nir: Column, s: Settings = DEFAULT) -> Column:
    """Material of a pile's median colour, scaled to its scene's bright end."""
    bright, red = brightness(r, g, b), ratio(r, b)
    return (
        F.when(_true(ratio(nir, r) > s.max_ndvi), "unknown")
        .when((bright < 0.22) & (red < 0.20), "coal")
        .when((red > 0.30) & (bright >= 0.60), "wood_chips")
        .when((red > 0.18) & (bright < 0.60), "iron_ore")
        .when((bright > 1.20) & (red < 0.15), "limestone")
        .when((bright >= 0.60) & (red <= 0.18), "sand_gravel")
        .when(red > 0.10, "scrap_metal")
        .otherwise("unknown")
    )


def object_class(area: Column, ndvi: Column, wall: Column, flat: Column, hmax: Column, hmean: Column, s: Settings = DEFAULT) -> Column:
    """Small things, plants, buildings (walls, flat tops, full boxes) and what is left: piles."""
    box = F.when(hmax > 0, hmean / F.when(hmax > 0, hmax)) > s.max_fill
    return (
        F.when(area < s.min_area, "too_small")
        .when(_true(ndvi > s.max_ndvi), "vegetation")
        .when(_true(wall > s.max_wall) | _true((flat > s.max_flat_top) & (hmax > 2.5)) | _true(box), "structure")
        .otherwise("stockpile")
    )


def structure_class(area: Column, hmax: Column, elongation: Column) -> Column:
    return (
        F.when((area <= 600) & (hmax >= 25) & (elongation < 3), "chimney_stack")
        .when((elongation >= 5) & (area < 8000), "pipe_conveyor")
        .otherwise("roof")
    )


def is_structure(area: Column, ndvi: Column, hmax: Column, hmean: Column, wall: Column, min_area: float = 15.0, s: Settings = DEFAULT) -> Column:
    """Large enough, no plant, and not of a pile's form."""
    fill = F.coalesce(F.when(hmax > 0, hmean / F.when(hmax > 0, hmax)), F.lit(0.0))
    return (area >= min_area) & ~_true(ndvi > s.max_ndvi) & ~((fill < s.max_fill) & (wall < s.max_wall))


def port_class(ndvi: Column, half_width: Column, wall: Column, flat: Column, hmax: Column, max_ndvi: float, min_half_width: float, max_wall: float, max_flat: float) -> Column:
    return (
        F.when(_true(ndvi > max_ndvi), "vegetation")
        .when(half_width < min_half_width, "linear")
        .when(_true(wall > max_wall) | _true((flat > max_flat) & (hmax > 2.5)), "building")
        .otherwise("pile")
    )


def port_material(rough: Column, bright: Column, scrap_rough: float, dark: float, light: float) -> Column:
    """Rough heaps are scrap unless dark; dark and light ones are told by brightness."""
    return (
        F.when((rough >= scrap_rough) & ~_true(bright < dark), "scrap_metal")
        .when(_true(bright < dark), "dark_bulk")
        .when(_true(bright >= light), "light_bulk")
        .otherwise("bulk")
    )


def scrap_or_bulk(rough: Column, patchy: Column, s: Settings = DEFAULT) -> Column:
    return F.when(_true((rough >= s.scrap_roughness) & (patchy >= s.scrap_patchiness)), "scrap_metal").otherwise("bulk")


def colour_class(bright: Column, red: Column) -> Column:
    return F.when(bright >= 140, "limestone").when(red >= -0.05, "iron_ore").when(bright.isNotNull(), "coal")


def band_order(ndvi_p99: Column) -> Column:
    return F.when(ndvi_p99 > 0.4, "ok").otherwise("check")


def anomalous(dt: Column, z: Column, s: Settings = DEFAULT) -> Column:
    return _true((dt > s.anomaly_dt) & (z > s.anomaly_sigma))


def swir_hot(nhi: Column, nhi_median: Column, b12: Column, b12_median: Column, s: Settings = DEFAULT) -> Column:
    """A pixel hotter in the SWIR than its own normal."""
    return _true((nhi > 0) & (nhi - nhi_median > s.nhi_anomaly) & (b12 > s.b12_ratio * b12_median) & (b12 > 0.02))


def alert(swir: Column, night_hits: Column, n_night: Column, p_night: Column, persistent: Column, significant: Column, n_hits: Column, n: Column, s: Settings = DEFAULT) -> tuple[Column, Column]:
    """Level and reason. Day-time warmth alone never passes 'watch' unless it is most passes."""
    at_night = ((night_hits >= 2) & (p_night < s.noise_p)) | ((night_hits >= 1) & (swir >= 1))
    most, day = _true(persistent) & _true(significant), _true(significant)
    passes = F.concat(night_hits.cast("string"), F.lit("/"), n_night.cast("string"))
    level = (
        F.when(swir >= 2, "critical").when(at_night | most, "warning").when((swir == 1) | (night_hits >= 1) | day, "watch").otherwise("none")
    )
    reason = (
        F.when(swir >= 2, F.concat(F.lit("SWIR combustion signal on "), swir.cast("string"), F.lit(" dates")))
        .when(at_night, F.concat(F.lit("warm at night in "), passes, F.lit(" passes")))
        .when(most, "warm in most passes (day); check at night")
        .when(swir == 1, "single SWIR date")
        .when(night_hits >= 1, F.concat(F.lit("warm in "), passes, F.lit(" night passes (within chance)")))
        .when(day, F.concat(F.lit("warm by day in "), n_hits.cast("string"), F.lit("/"), n.cast("string"), F.lit(" passes")))
    )
    return level, reason


