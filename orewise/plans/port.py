"""Port monitoring: search zones, a footprint classifier, area to volume, and the erase test."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..operators import focal, modelling, neighbours, validation
from ..sources.tables import new_path, numbered, written

BANDS = ["blue", "green", "red", "nir"]
FEATURES = [*BANDS, "bright", "ndvi", "ndwi", "redness", "texture"]


def features(px: DataFrame) -> DataFrame:
    """px(row, col, bands, ...) with brightness, indices and 3 x 3 texture."""
    c = F.col
    px = px.withColumns({
        "bright": (c("red") + c("green") + c("blue")) / 3, "ndvi": ratio(c("nir"), c("red")), "ndwi": ratio(c("green"), c("nir")), "redness": ratio(c("red"), c("blue")),
    })
    texture = focal.focal(px, focal.offsets("square", 1), "bright", texture=F.stddev_pop)
    return px.join(texture, ["row", "col"])


def zones(px: DataFrame, labels: DataFrame, radius: int) -> DataFrame:
    """Each pixel's nearest pile within radius: its search zone."""
    return neighbours.nearest_label(px, labels, radius).select("row", "col", F.col("label").alias("zone"))


def areas(scored: DataFrame, pixel_area: float) -> DataFrame:
    """Expected area of each zone: sums of probabilities."""
    return scored.groupBy("zone").agg((F.sum("p") * pixel_area).alias("area"))


@dataclass
class PortModel:
    """Fitted once: the classifier, the piles' zones, and the power law from area to volume."""

    score: Callable[[DataFrame], DataFrame]
    zone: DataFrame
    piles: DataFrame
    pixel_area: float
    accuracy: DataFrame

    def volumes(self, px: DataFrame) -> DataFrame:
        """zone, area and volume of every pile in a scene of bands on the model's pixels."""
        scene = areas(self.score(features(px).join(self.zone, ["row", "col"])), self.pixel_area)
        known = self.piles.select(F.col("label").alias("zone"), F.col("ref_area").alias("pred"), F.col("volume").alias("actual"), F.lit(0).alias("fold"))
        new = scene.select("zone", F.col("area").alias("pred"), F.lit(None).cast("double").alias("actual"), F.lit(1).alias("fold"))
        out = validation.power_corrected(known.unionByName(new)).where("fold = 1")
        return out.select("zone", F.col("pred").alias("area"), F.col("corrected").alias("volume"))


def fit(px: DataFrame, labels: DataFrame, piles: DataFrame, radius: int, pixel_area: float, rounds: int = 10, groups: int | None = None) -> PortModel:
    """px(row, col, bands, occupied), labels(row, col, label), piles(label, volume) -> the model.

    Each pile's area comes from a classifier that has not seen its zone; these areas and the
    surveyed volumes give the leave-one-out accuracy. Every pile is left out by itself, one fit a pile
    that has a volume and a zone, whatever their number. A caller may choose fewer fits: with groups=k,
    piles are dealt to k groups that are held out whole. Each fit's areas are appended to one table, so
    the plan doesn't grow with the fits.
    """
    zone = written(zones(px, labels, radius))
    train = written(features(px).join(zone, ["row", "col"]).withColumn("y", (F.col("occupied") > 0.5).cast("double")))
    seen = piles.where("volume is not null").join(train.select(F.col("zone").alias("label")).distinct(), "label", "left_semi")
    n = F.col("n") - 1
    dealt = written(numbered(seen, "label", "n").select(F.col("label").alias("zone"), (n if groups is None else F.pmod(n, F.lit(groups))).alias("held")))
    parts = written(train.join(dealt, "zone", "left"))
    path = new_path(px.sparkSession)
    fits = dealt.agg(F.max("held")).first()[0]
    for k in range(0 if fits is None else fits + 1):
        score = modelling.footprint_probability(parts.where(F.coalesce(F.col("held") != k, F.lit(True))), FEATURES, "y", rounds)
        areas(score(parts.where(F.col("held") == k)), pixel_area).write.mode("append").parquet(path)
    held = px.sparkSession.read.schema("zone int, area double").parquet(path) if fits is not None else px.sparkSession.createDataFrame([], "zone int, area double")
    loo = written(piles.join(held, piles.label == held.zone).select("label", F.col("volume").alias("actual"), F.col("area").alias("pred")))
    accuracy = validation.metrics(validation.leave_one_out(loo, "label"), "actual", "corrected")
    score = modelling.footprint_probability(train, FEATURES, "y", rounds)
    ref = areas(score(train), pixel_area).withColumnRenamed("area", "ref_area")
    return PortModel(score, zone, written(piles.join(ref, piles.label == ref.zone).select("label", "volume", "ref_area")), pixel_area, accuracy)


def erased(px: DataFrame, labels: DataFrame, label: int) -> DataFrame:
    """The scene with a pile's pixels at the median of the ground around it."""
    own = labels.where(F.col("label") == label).select("row", "col")
    free = labels.where("label > 0").select("row", "col")
    around = focal.dilated(own, focal.offsets("cross", 3)).join(free, ["row", "col"], "left_anti").join(px, ["row", "col"])
    ground = around.agg(*[F.median(b).alias(f"g_{b}") for b in BANDS])
    marked = px.join(own.withColumn("gone", F.lit(True)), ["row", "col"], "left").crossJoin(F.broadcast(ground))  # one row
    return marked.withColumns({b: F.when(F.col("gone"), F.col(f"g_{b}")).otherwise(F.col(b)) for b in BANDS}).drop("gone", *[f"g_{b}" for b in BANDS])


def erase_test(model: PortModel, px: DataFrame, labels: DataFrame, least: float = 0.2) -> DataFrame:
    """Erases the largest pile and sees whether its volume follows: label, before, after, response, passed."""
    (label,) = model.piles.agg(F.max_by("label", "volume")).first()
    one = lambda d, name: model.volumes(d).where(F.col("zone") == label).select("zone", F.col("volume").alias(name))
    both = one(px, "before").join(one(erased(px, labels, label), "after"), "zone")
    response = F.when(F.col("before") > 0, 1 - F.col("after") / F.col("before")).otherwise(0.0)
    return both.select(F.col("zone").alias("label"), "before", "after", response.alias("response"), (response >= least).alias("passed"))


def series(volumes: DataFrame) -> DataFrame:
    """volumes(date, label, material_class, volume) -> totals by date, scrap and bulk apart."""
    scrap = F.coalesce(F.sum(F.when(F.col("material_class") == "scrap_metal", F.col("volume"))), F.lit(0.0))
    return volumes.groupBy("date").agg(F.sum("volume").alias("total"), scrap.alias("scrap"), (F.sum("volume") - scrap).alias("bulk"))
