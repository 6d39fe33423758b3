"""Heat: contrasts by scene, persistence, trend, combustion, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import DEFAULT, Settings
from ..functions import classes
from ..functions.columns import binomial_tail, detectable_celsius, hotspot_celsius, ratio
from .zonal import robust

MONTH = 30.44


def contrasts(obs: DataFrame, background: DataFrame, s: Settings = DEFAULT, rings: DataFrame | None = None) -> DataFrame:
    """obs(scene_id, label, row, col, lst, cover) and background(scene_id, label, lst) -> a contrast per scene and object.

    The object's pixel is the one that it covers most, the hotter one of equals; the ring's
    centre and spread are median and 1.4826 MAD, and rings of under three pixels give nothing.
    Where objects share their background, rings(scene_id, label, ring) names each one's and
    background is (scene_id, ring, lst): centre and spread are then made once a ring, and no
    pixel is copied for each object.
    """
    keys = ["scene_id", "label"]
    ring = robust(background, keys if rings is None else ["scene_id", "ring"], "lst").where("n >= 3")
    ring = (ring if rings is None else rings.join(ring, ["scene_id", "ring"])).select(*keys, F.col("med").alias("t_background"), F.col("mad").alias("sigma"), F.col("n").alias("n_background"))
    score = F.struct((F.col("cover") + 1e-3 * F.col("lst")).alias("score"), (-F.col("row")).alias("r"), (-F.col("col")).alias("c"))
    best = obs.where("lst is not null and cover > 0").groupBy(keys).agg(F.max_by(F.struct("lst", "cover"), score).alias("b"))
    out = best.join(ring, keys).select(*keys, F.col("b.lst").alias("t_object"), F.col("b.cover").alias("cover"), "t_background", "sigma", "n_background")
    dt = F.col("t_object") - F.col("t_background")
    z = F.when(F.col("sigma") > 0, dt / F.when(F.col("sigma") > 0, F.col("sigma")))
    return out.withColumns({"dt": dt, "z": z, "dt_surface": F.when(F.col("cover") > 0.05, dt / F.col("cover"))})


def flagged(rows: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Adds anomalous and, where it is, hotspot_c: rows(dt, z, t_object, t_background, native_m)."""
    hot = hotspot_celsius(F.col("t_object"), F.col("t_background"), s.hotspot_side_m**2, F.col("native_m"), s.wavelength_um)
    rows = rows.withColumn("anomalous", classes.anomalous(F.col("dt"), F.col("z"), s))
    return rows.withColumn("hotspot_c", F.when(F.col("anomalous"), hot))


def trend(date: str = "date", value: str = "dt") -> Column:
    """Slope per month of value; null below four scenes or on one date. Days are counted from 2024, which keeps the sums small."""
    months = F.datediff(F.col(date), F.lit("2024-01-01").cast("date")) / MONTH
    return F.when((F.count(value) >= 4) & (F.max(date) > F.min(date)), F.regr_slope(F.col(value), months))


def summary(rows: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """rows(label, date, night, dt, z, anomalous, ...) -> one row per object: persistence, chance, trend, alerts' inputs."""
    out = rows.groupBy("label").agg(
        F.count("*").alias("n_scenes"), F.avg("dt").alias("mean_dt"), F.max("dt").alias("max_dt"), F.max("z").alias("max_z"),
        F.avg(F.col("anomalous").cast("double")).alias("persistence"), F.count_if("anomalous").alias("n_anomalous"),
        F.count_if("night").alias("n_night"), F.count_if(F.col("anomalous") & F.col("night")).alias("n_night_anomalous"),
        F.avg(F.when(~F.col("night"), F.col("anomalous").cast("double"))).alias("day_persistence"),
        trend().alias("trend"), F.median("hotspot_c").alias("hotspot_median"), F.median("dt_surface").alias("dt_surface_median"),
        F.median("t_background").alias("t_background"), F.median("sigma").alias("sigma"), F.min("native_m").alias("native_m"), F.avg("cover").alias("mean_cover"),
    )
    return out.withColumns({
        "p_value": binomial_tail(F.col("n_scenes"), F.col("n_anomalous"), s.noise_rate),
        "p_night": F.when(F.col("n_night") > 0, binomial_tail(F.col("n_night"), F.col("n_night_anomalous"), s.noise_rate)).otherwise(1.0),
        "persistent": (F.col("persistence") >= s.persistence) & (F.col("n_anomalous") >= 2),
        "detectable": detectable_celsius(F.col("t_background"), F.col("sigma"), F.col("native_m"), s),
    }).withColumn("significant", F.col("p_value") < s.noise_p)


def swir_hits(px: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """px(scene_id, date, row, col, label, b11, b12) -> label, date, hot_px, max_nhi: one hit per object and date, the first scene's.

    A pixel is hot against its own median over the scenes; the greatest index is that of the
    whole object, hot or not.
    """
    own = Window.partitionBy("row", "col")
    nhi = ratio(F.col("b12"), F.col("b11"))
    px = px.withColumn("nhi", nhi).withColumns({"nhi_median": F.median("nhi").over(own), "b12_median": F.median("b12").over(own)})
    px = px.withColumn("hot", classes.swir_hot(F.col("nhi"), F.col("nhi_median"), F.col("b12"), F.col("b12_median"), s))
    hits = px.where("label > 0").groupBy("label", "scene_id", "date").agg(F.count_if("hot").alias("hot_px"), F.max("nhi").alias("max_nhi")).where("hot_px > 0")
    first = Window.partitionBy("label", "date").orderBy("scene_id")
    return hits.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "scene_id")


def hot_frequency(px: DataFrame) -> DataFrame:
    """Share of the scenes in which each pixel is hot: px(row, col, hot)."""
    return px.groupBy("row", "col").agg(F.avg(F.col("hot").cast("double")).alias("frequency"))


def pooled(dates: DataFrame, near: DataFrame) -> DataFrame:
    """dates(label, date) of hits, near(label, other) -> label, swir_dates: own and neighbours' dates, sorted."""
    lent = dates.join(near, "label").select(F.col("other").alias("label"), "date")
    return dates.select("label", "date").unionByName(lent).groupBy("label").agg(F.array_sort(F.collect_set("date")).alias("swir_dates"))


def alerts(objects: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Adds alert and reason to summary() rows with swir, the number of (pooled) combustion dates."""
    c = F.col
    level, reason = classes.alert(c("swir"), c("n_night_anomalous"), c("n_night"), c("p_night"), c("persistent"), c("significant"), c("n_anomalous"), c("n_scenes"), s)
    return objects.withColumns({"alert": level, "reason": reason})


def composite(scenes: DataFrame) -> DataFrame:
    """Median of the day scenes by pixel."""
    return scenes.where("not night").groupBy("row", "col").agg(F.median("lst").alias("lst"))


def hottest(objects: DataFrame, value: str, share: float = 0.9) -> DataFrame:
    """Adds hottest: at or above that quantile of the known values."""
    q = objects.agg(F.percentile(value, share).alias("q"))
    return objects.crossJoin(F.broadcast(q)).withColumn("hottest", F.coalesce(F.col(value) >= F.col("q"), F.lit(False))).drop("q")
