"""A synthetic yard: cones, buildings, bands and thermal scenes, as column expressions over a range of pixels."""

from __future__ import annotations

from math import cos, radians, sin

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import kelvin, radiance
from ..operators.grid import Lattice, sheet

#: x, y, radius along and across, height, angle, flat top (share of the height), material colour.
PILES = [
    (80, 90, 40, 40, 12, 0, 1.0, (0.12, 0.12, 0.12, 0.14)), (200, 100, 55, 35, 14, 20, 1.0, (0.15, 0.14, 0.13, 0.16)),
    (330, 110, 40, 30, 10, 45, 0.9, (0.20, 0.28, 0.45, 0.50)), (450, 100, 35, 35, 9, 0, 1.0, (0.60, 0.66, 0.70, 0.72)),
    (100, 250, 45, 25, 8, 70, 1.0, (0.13, 0.12, 0.12, 0.13)), (240, 260, 50, 40, 13, 10, 0.8, (0.18, 0.26, 0.42, 0.47)),
    (380, 270, 42, 30, 11, 30, 1.0, (0.35, 0.55, 0.80, 0.85)), (500, 260, 30, 30, 7, 0, 1.0, (0.65, 0.68, 0.70, 0.71)),
]
BUILDINGS = [(60, 350, 60, 30, 9.0), (200, 360, 80, 35, 12.0), (420, 370, 70, 40, 8.0)]


def noise(seed: int, *keys: Column) -> Column:
    """About normal, zero mean, unit deviation: twelve hashed uniforms less six."""
    u = lambda k: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), *keys), F.lit(1_000_003)) + 0.5) / 1_000_003
    return sum((u(k) for k in range(12)), F.lit(0.0)) - 6


def cone(x: Column, y: Column, cx: float, cy: float, rx: float, ry: float, h: float, angle: float = 0.0, flat: float = 1.0) -> Column:
    """Height of a rotated elliptical cone, cut at a share of its height."""
    c, s = cos(radians(angle)), sin(radians(angle))
    u, v = ((x - cx) * c + (y - cy) * s) / rx, (-(x - cx) * s + (y - cy) * c) / ry
    return F.least(F.greatest(h * (1 - F.sqrt(u * u + v * v)), F.lit(0.0)), F.lit(h * flat))


def site(spark: SparkSession, grid: Lattice = sheet(450, 600), seed: int = 42) -> DataFrame:  # noqa: B008
    """row, col, dtm, dsm, label, blue, green, red, nir of the yard; a sloping pad with small noise."""
    px = spark.range(grid.cols * grid.rows).select((F.col("id") / grid.cols).cast("int").alias("row"), (F.col("id") % grid.cols).cast("int").alias("col"))
    x, y = (F.col("col") + 0.5) * grid.step, (F.col("row") + 0.5) * grid.step
    dtm = 180 + 0.01 * x + 0.004 * y
    heights = [cone(x, y, *p[:7]) for p in PILES]
    pile = F.greatest(*heights)
    label = F.lit(0)
    for k, h in enumerate(heights, 1):
        label = F.when(h > 0.05, k).otherwise(label)
    house = F.lit(0.0)
    for cx, cy, w, d, h in BUILDINGS:
        house = F.when((F.abs(x - cx) <= w / 2) & (F.abs(y - cy) <= d / 2), h).otherwise(house)
    top = F.greatest(pile, house)
    out = px.withColumns({"dtm": dtm, "dsm": dtm + top + 0.02 * noise(seed, F.col("row"), F.col("col")), "label": label})
    ground = (0.30, 0.32, 0.34, 0.36)
    for b, band in enumerate(("blue", "green", "red", "nir")):
        value = F.lit(ground[b])
        for k, p in enumerate(PILES, 1):
            value = F.when(F.col("label") == k, p[7][b]).otherwise(value)
        out = out.withColumn(band, value + 0.01 * noise(seed + b + 1, F.col("row"), F.col("col")))
    return out


def thermal_scenes(px: DataFrame, scenes: int = 8, block: int = 30, hot: int = 1, hot_c: float = 60.0, share: float = 0.02, seed: int = 7) -> DataFrame:
    """scene_id, date, night, row, col, lst on blocks of the yard: pile `hot` has a warm share, mixed by radiance."""
    cell = [F.floor(F.col(c) / block).cast("int").alias(c) for c in ("row", "col")]
    cover = px.groupBy(*cell).agg(F.avg((F.col("label") == hot).cast("double")).alias("cover"))
    s = cover.select("*", F.explode(F.sequence(F.lit(0), F.lit(scenes - 1))).alias("scene_id"))
    base = 15 + 3 * F.sin(F.col("scene_id")) + 0.3 * noise(seed, F.col("scene_id"), F.col("row"), F.col("col"))
    part = F.col("cover") * share
    mixed = part * radiance(F.lit(hot_c + 273.15)) + (1 - part) * radiance(base + 273.15)
    return s.select("scene_id", F.date_add(F.lit("2025-03-01").cast("date"), F.col("scene_id") * 16).alias("date"), (F.col("scene_id") % 2 == 1).alias("night"), "row", "col", (kelvin(mixed) - 273.15).alias("lst"))
