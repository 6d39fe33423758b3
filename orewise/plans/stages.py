"""The thermal stage, the sensor study and recent scenes, as compositions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..operators import focal, modelling, neighbours, resample, thermal, validation, zonal
from ..sources.tables import written


def thermal_stage(scenes: DataFrame, labels: DataFrame, block: int, res: float, grid: tuple[int, int], swir: DataFrame | None = None, s: Settings = DEFAULT) -> DataFrame:
    """scenes(scene_id, date, night, native_m, row, col, lst) on blocks of the labels' pixels -> objects with persistence and alerts.

    An object's share of each thermal pixel is its blurred footprint's; its background are the
    pixels of the ring around it that no object covers.
    """
    own = labels.where("label > 0").select("row", "col", "label")
    native = scenes.agg(F.max("native_m")).first()[0] or block * res
    cell = [F.floor(F.col(c) / block).cast("int").alias(c) for c in ("row", "col")]
    cover = written(focal.coverage(own, native, res, grid, block, by=("label",)).where("cover > 0"))
    covered = cover.groupBy("row", "col").agg(F.max("cover").alias("most")).where("most >= 0.05").select("row", "col")
    coarse = own.select(*cell, "label").distinct()
    inner, outer = max(int(s.ring_inner_m / res / block), 0), max(int(s.ring_outer_m / res / block), 2)
    frame = scenes.select("row", "col").distinct()
    ring = neighbours.ring(coarse, frame, inner, outer).select("label", "row", "col").join(covered, ["row", "col"], "left_anti")
    obs = scenes.join(cover, ["row", "col"]).select("scene_id", "label", "row", "col", "lst", "cover")
    background = scenes.join(ring, ["row", "col"]).select("scene_id", "label", "lst")
    rows = thermal.contrasts(obs, background, s).join(scenes.select("scene_id", "date", "night", "native_m").distinct(), "scene_id")
    summary = thermal.summary(thermal.flagged(rows, s), s)
    if swir is None:
        return thermal.alerts(summary.withColumn("swir", F.lit(0)), s)
    hits = written(thermal.swir_hits(swir, s))
    pooled = thermal.pooled(hits, neighbours.neighbours(own, max(round(s.pool_m / res), 1)))
    counted = pooled.select("label", "swir_dates", F.size("swir_dates").alias("swir"))
    out = summary.join(counted, "label", "left").withColumn("swir", F.coalesce("swir", F.lit(0)))
    return thermal.alerts(out, s)


def sensor_study(px: DataFrame, features: list[str], pixel_area: float, folds: int = 5, methods: tuple[str, ...] = ("gbt", "rf"), rounds: int = 10) -> DataFrame:
    """px(label, fold, h, features) -> label, method, correction, actual, predicted: out-of-fold volumes and their corrections, long."""
    out = None
    for m in methods:
        pred = modelling.out_of_fold(px, features, "h", folds, m, rounds)
        piles = written(zonal.zonal(pred, actual=F.sum(F.greatest("h", F.lit(0.0))) * pixel_area, pred=F.sum(F.greatest("pred", F.lit(0.0))) * pixel_area, fold=F.percentile_approx("fold", 0.5)))
        for name, correct in (("none", None), ("ratio", validation.ratio_corrected), ("power", validation.power_corrected), ("quadratic", validation.quadratic_corrected)):
            d = piles.withColumn("corrected", F.col("pred")) if correct is None else correct(piles)
            d = d.select("label", F.lit(m).alias("method"), F.lit(name).alias("correction"), "actual", F.col("corrected").alias("predicted"))
            out = d if out is None else out.unionByName(d)
    return out


def study_metrics(study: DataFrame) -> DataFrame:
    return validation.metrics(study, "actual", "predicted", by=["method", "correction"])


def recent_scene(px: DataFrame, scene: DataFrame, model, features, bands: list[str], uav: DataFrame, pixel_area: float, factor: float = 1.0, least: float | None = None) -> DataFrame:
    """A validated model on a newer scene: radiometry matched over the free ground, then volumes by the model's change.

    px(row, col, label, bands) is the reference, scene(row, col, bands) the newer one, features a
    function from rows of bands to model rows, uav(label, uav) the surveyed volumes.
    """
    both = px.join(scene.select("row", "col", *[F.col(b).alias(f"new_{b}") for b in bands]), ["row", "col"], "left")
    both = both.withColumn("use", (F.col("label") == 0) & F.col(f"new_{bands[0]}").isNotNull())
    fit = written(modelling.normalised(both, bands))
    by_band = {r.band: r for r in fit.collect()}  # a row per band
    now = both.select("row", "col", "label", *[(by_band[b].gain * F.col(f"new_{b}") + by_band[b].offset).alias(b) for b in bands])
    volume = lambda d, k: zonal.zonal(model.transform(features(d)), **{k: F.sum(F.greatest("pred", F.lit(0.0))) * pixel_area})
    cover = zonal.zonal(both, cover_ref=zonal.share(F.col(bands[0]).isNotNull()), cover_now=zonal.share(F.col(f"new_{bands[0]}").isNotNull()))
    piles = volume(px, "v_ref").join(volume(now, "v_now"), "label", "left").join(cover, "label").join(uav, "label", "left")
    return validation.recent(piles, factor, least)


def site_to_grid(px: DataFrame, values: list[str], k: int) -> DataFrame:
    """A site's bands on coarser pixels, as a coarser sensor saw them."""
    return resample.block_mean(px, values, k)
