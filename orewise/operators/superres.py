"""Finer bands from coarse ones: splines, detail learned from a sharper reference of the same site, or filters trained before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from . import patches, tiles
from .distance import distance_inside
from .modelling import fitted, matched
from .resample import block_mean, cubic


def detail(px: DataFrame, band: str, grid: tuple[int, int], factor: int) -> DataFrame:
    """Value, gradients, high-pass and Laplacian of a band."""
    sigma = max(factor / 2, 0.5)

    def kernel(a):
        a = tiles.filled(a)
        gy, gx = tiles.gradient(a, 1.0)
        y, x = tiles.gradient(gy, 1.0)[0], tiles.gradient(gx, 1.0)[1]
        return a, gx, gy, a - tiles.gauss(a, sigma), x + y

    names = [f"{band}_{k}" for k in ("v", "gx", "gy", "high", "lap")]
    return tiles.by_tile(px, kernel, [band], {n: "double" for n in names}, grid, tiles.gauss_radius(sigma) + 2)


def bicubic(coarse: DataFrame, bands: list[str], factor: int, grid: tuple[int, int]) -> DataFrame:
    """Cubic splines of coarse bands on factor times as many pixels."""
    out = None
    for b in bands:
        d = cubic(coarse, b, factor, grid)
        out = d if out is None else out.join(d, ["row", "col"])
    return out


def sharpened(coarse: DataFrame, reference: DataFrame, bands: list[str], factor: int, grid: tuple[int, int], rounds: int = 10) -> DataFrame:
    """coarse(row, col, bands) and a sharper reference of the site -> fine bands.

    What splines lose is learned on the reference against its own block means, then applied to
    the coarse scene once that has the reference's radiometry.
    """
    fine = (grid[0] * factor, grid[1] * factor)
    blurred = written(block_mean(reference, bands, factor))
    out = None
    for b in bands:
        learn = detail(cubic(blurred, b, factor, grid), b, fine, factor).join(reference.select("row", "col", F.col(b).alias("target")), ["row", "col"])
        names = [f"{b}_{k}" for k in ("v", "gx", "gy", "high", "lap")]
        model = fitted(written(learn), names, "target", rounds)
        both = coarse.select("row", "col", b).join(blurred.select("row", "col", F.col(b).alias("ref")), ["row", "col"], "left")
        fit = matched(both, b, "ref")
        mapped = coarse.select("row", "col", b).crossJoin(F.broadcast(fit)).select("row", "col", (F.col("gain") * F.col(b) + F.col("offset")).alias(b))  # one row
        d = model.transform(detail(cubic(mapped, b, factor, grid), b, fine, factor)).select("row", "col", F.col("pred").alias(b))
        out = d if out is None else out.join(d, ["row", "col"])
    return out


#: What each method falls back to, in order.
ORDER = {"patches": ["patches", "reference", "bicubic"], "reference": ["reference", "bicubic"], "bicubic": ["bicubic"]}


def resolved(coarse: DataFrame, bands: list[str], factor: int, grid: tuple[int, int], method: str, reference: DataFrame | None = None, filters: DataFrame | None = None, rounds: int = 10) -> DataFrame:
    """Fine row, col, bands and the mode taken: the first of the method's order that has what it needs.

    patches needs filters (patches.trained) of all bands at this factor, reference a sharper
    scene of the site with a known pixel of each band. An unknown method is bicubic.
    """
    for mode in ORDER.get(method, ["bicubic"]):
        if mode == "patches" and patches.held(filters, bands, factor):
            out = patches.patched(coarse, filters, bands, factor, grid)
        elif mode == "reference" and reference is not None and not (set(bands) - set(reference.columns)) and all(reference.agg(*[F.count(b) for b in bands]).first()):
            out = sharpened(coarse, reference, bands, factor, grid, rounds)
        elif mode == "bicubic":
            out = bicubic(coarse, bands, factor, grid)
        else:
            continue
        return out.withColumn("mode", F.lit(mode))


def polygon_features(labels: DataFrame, res: float, grid: tuple[int, int]) -> DataFrame:
    """Edge distance, the same relative to the object's deepest pixel, and log area of labelled pixels."""
    from pyspark.sql.window import Window

    own = labels.where("label > 0").select("row", "col", "label")
    d = distance_inside(own.select("row", "col"), grid).join(own, ["row", "col"])
    w = Window.partitionBy("label")
    edge = F.col("distance") * res
    return d.select("row", "col", "label", edge.alias("edge_m"), (edge / F.greatest(F.max(edge).over(w), F.lit(res))).alias("depth"), F.ln(F.greatest(F.count("*").over(w) * res * res, F.lit(1.0))).alias("log_area"))
