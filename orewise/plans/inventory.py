"""Stages built from the operators: detection, inventory, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions import classes
from ..operators import focal, zonal
from ..operators.components import labelled
from ..operators.distance import distance_inside
from ..operators.grid import Lattice
from ..operators.modelling import nearest_centroid
from ..sources.tables import numbered, written


def densities(df: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    return df.sparkSession.createDataFrame(list(s.density.items()), "commodity string, rho double")


def with_tonnage(piles: DataFrame, volume: str, s: Settings = DEFAULT) -> DataFrame:
    """Adds tonnage_t; a material without a density counts as unknown."""
    out = piles.join(F.broadcast(densities(piles, s)), "commodity", "left")  # a row per material
    return out.withColumn("tonnage_t", F.col(volume) * F.coalesce("rho", F.lit(s.density["unknown"]))).drop("rho")


def totals(piles: DataFrame) -> DataFrame:
    """piles(commodity, volume, sigma) -> by material and overall (null material): counts, sums, both sums of sigmas."""
    return with_tonnage(piles, "volume").rollup("commodity").agg(
        F.count("*").alias("n"), F.sum("volume").alias("volume_m3"), F.sum("tonnage_t").alias("tonnage_t"),
        F.sqrt(F.sum(F.col("sigma") ** 2)).alias("sigma_rss"), F.sum("sigma").alias("sigma_linear"),
    )


def detect_piles(px: DataFrame, grid: Lattice, s: Settings = DEFAULT) -> DataFrame:
    """px(row, col, h, dsm, ndvi) -> objects with forms and class, numbered in raster order."""
    candidate = px.where((F.col("h") > s.min_height) & (F.col("h") < s.max_height)).select("row", "col")
    objects = written(labelled(focal.opened(candidate, focal.offsets("square", 1)), grid.cols))
    sloped = focal.slope_degrees(px, "dsm", grid.step)
    forms = zonal.forms(sloped.join(objects, ["row", "col"]), grid.cell_area, s)
    c = F.col
    return forms.withColumn("class", classes.object_class(c("area"), c("ndvi"), c("wall"), c("flat_top"), c("hmax"), c("hmean"), s))


def detect_structures(px: DataFrame, grid: Lattice, least: float = 2.5, min_area: float = 15.0, s: Settings = DEFAULT) -> DataFrame:
    """px(row, col, h, ndvi) -> structures with class; no opening, so that thin pipes stay."""
    objects = written(labelled(px.where(F.col("h") > least).select("row", "col"), grid.cols))
    joined = written(focal.slope_degrees(px, "h", grid.step).join(objects, ["row", "col"]))
    forms = zonal.forms(joined, grid.cell_area, s).join(zonal.elongation(joined), "label")
    c = F.col
    kept = forms.where(classes.is_structure(c("area"), c("ndvi"), c("hmax"), c("hmean"), c("wall"), min_area, s))
    kept = kept.withColumn("class", classes.structure_class(c("area"), c("hmax"), c("elongation")))
    kept = written(kept)
    return kept.join(numbered(kept, "label", "number"), "label").drop("label").withColumnRenamed("number", "label")


def detect_port(px: DataFrame, ground: float, grid: Lattice, deck_m: float = 1.0, rules: dict | None = None) -> DataFrame:
    """px(row, col, dsm, ndvi, bright) above a flat level -> port objects with class and material."""
    rules = {"min_area": 30.0, "max_ndvi": 0.3, "min_half_width": 3.0, "max_wall": 0.2, "max_flat": 0.5, "scrap_rough": 0.6, "dark": 0.25, "light": 0.6} | (rules or {})
    h = px.withColumn("h", F.col("dsm") - ground)
    mask = written(focal.opened(h.where(F.col("h") > deck_m).select("row", "col"), focal.offsets("square", 1), times=2))
    objects = written(labelled(mask, grid.cols))
    shape = (grid.rows, grid.cols)
    deep = distance_inside(mask, shape).select("row", "col", (F.col("distance") * grid.step).alias("deep"))
    smooth = focal.box(h, "h", max(round(5 / grid.step), 3), shape).select("row", "col", F.col("mean").alias("smooth"))
    all_px = focal.slope_degrees(h, "dsm", grid.step).join(objects, ["row", "col"]).join(deep, ["row", "col"]).join(smooth, ["row", "col"])
    all_px = written(all_px)
    more = zonal.zonal(all_px, half_width=F.max("deep"), rough=F.sqrt(F.avg((F.col("h") - F.col("smooth")) ** 2)), bright=F.avg("bright"))
    forms = zonal.forms(all_px, grid.cell_area).join(more, "label").where(F.col("area") >= rules["min_area"])
    c = F.col
    kind = classes.port_class(c("ndvi"), c("half_width"), c("wall"), c("flat_top"), c("hmax"), rules["max_ndvi"], rules["min_half_width"], rules["max_wall"], rules["max_flat"])
    material = classes.port_material(c("rough"), c("bright"), rules["scrap_rough"], rules["dark"], rules["light"])
    return forms.withColumn("class", kind).withColumn("material", F.when(c("class") == "pile", material))


def inventory(px: DataFrame, grid: Lattice, named: DataFrame | None = None, s: Settings = DEFAULT) -> DataFrame:
    """px(row, col, label, dsm, dtm, bands) -> piles: coverage, volume, material (named, learned or by rule), tonnage.

    named(label, commodity) are the operator's own; their colours teach the others' if there are any.
    """
    bands = ["blue", "green", "red", "nir"]
    px = px.withColumn("h", F.col("dsm") - F.col("dtm"))
    px = zonal.scene_scaled(px, bands)
    seen = zonal.zonal(px, coverage=zonal.share(F.col("h").isNotNull()), p99=F.percentile("h", 0.99))
    occupied = F.col("h") > s.min_height
    colours = zonal.zonal(px, **{b: F.median(F.when(occupied, F.col(b))) for b in bands})
    piles = zonal.volumes(px, grid.cell_area, s).join(seen, "label").join(colours, "label")
    rule = F.coalesce(classes.commodity(F.col("red"), F.col("green"), F.col("blue"), F.col("nir"), s), F.lit("unknown"))
    if named is not None:
        named = named.select("label", F.col("commodity").alias("given"))
        learned = nearest_centroid(piles, piles.join(named, "label").withColumnRenamed("given", "commodity"), bands)
        piles = learned.withColumnRenamed("commodity", "learned").join(named, "label", "left")
    else:
        piles = piles.withColumns({"given": F.lit(None).cast("string"), "learned": F.lit(None).cast("string")})
    piles = piles.withColumns({
        "commodity": F.coalesce("given", "learned", rule),
        "source": F.when(F.col("given").isNotNull(), "client").when(F.col("learned").isNotNull(), "learned").otherwise("rule"),
    })
    ok = F.col("coverage") >= s.min_coverage
    piles = piles.withColumns({c: F.when(ok, F.col(c)) for c in ("volume_m3", "mean_height_m", "max_height_m", "sigma_m3", "p99")})
    return with_tonnage(piles, "volume_m3", s).drop("given", "learned")
