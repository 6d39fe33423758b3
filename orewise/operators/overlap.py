"""Overlapping tiles: every tile's values are standardised on their own, then blended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def starts(size: int, tile: int, overlap: int) -> list[int]:
    """First pixels of the tiles along an axis; the last one ends with it."""
    out = list(range(0, max(size - tile, 0) + 1, max(tile - overlap, 1))) or [0]
    if out[-1] + tile < size:
        out.append(max(size - tile, 0))
    return out


def blended_tiles(px: DataFrame, value: str, height: int, width: int, tile: int, overlap: int) -> DataFrame:
    """row, col, blend: a pixel's standardised values over its tiles (four at most, at corners), by feather weight."""
    rows, cols = (F.array(*map(F.lit, starts(n, tile, overlap))) for n in (height, width))
    within = lambda c: (lambda s: (F.col(c) >= s) & (F.col(c) < s + tile))
    dealt = px.where(F.col(value).isNotNull()).select("row", "col", value, F.explode(F.filter(rows, within("row"))).alias("r"))
    dealt = dealt.select("*", F.explode(F.filter(cols, within("col"))).alias("c"))
    scale = dealt.groupBy("r", "c").agg(F.median(value).alias("med"), (F.percentile(value, 0.75) - F.percentile(value, 0.25)).alias("iqr"))
    ramp = lambda at, s: F.least(F.least(F.col(at) - F.col(s) + 1, F.col(s) + tile - F.col(at)) / max(overlap, 1), F.lit(1.0))
    d = dealt.join(F.broadcast(scale), ["r", "c"]) if len(starts(height, tile, overlap)) * len(starts(width, tile, overlap)) < 10_000 else dealt.join(scale, ["r", "c"])
    d = d.withColumns({"d": (F.col(value) - F.col("med")) / F.greatest("iqr", F.lit(1e-6)), "w": ramp("row", "r") * ramp("col", "c")})
    return d.groupBy("row", "col").agg((F.sum(F.col("d") * F.col("w")) / F.greatest(F.sum("w"), F.lit(1e-9))).alias("blend"))
