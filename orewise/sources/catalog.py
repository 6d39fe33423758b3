"""A site's tables by name, read lazily: only what a plan uses is scanned."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import bit_field, bits_clear, clear_class, known, landsat_celsius
from .tables import ingested


@dataclass
class Site:
    """Paths of a site's tables; optional ones may be missing."""

    spark: SparkSession
    paths: dict[str, str] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame | None:
        """The table with NaN as null, or None where the site has none."""
        return ingested(self.spark.read.parquet(self.paths[name])) if name in self.paths else None

    def first(self, *names: str) -> DataFrame:
        """The first of these that the site has."""
        for n in names:
            if n in self.paths:
                return self.read(n)
        raise KeyError(f"the site has none of {names}")

    def optical(self, name: str, bands: dict[str, str]) -> DataFrame:
        """Bands by their own names."""
        return self.read(name).select("row", "col", *[F.col(v).alias(k) for k, v in bands.items()])


def sentinel(scene: DataFrame) -> DataFrame:
    """Masked, scaled reflectances."""
    return scene.where(clear_class(F.col("scl"))).withColumns({b: F.col(b) / 10000 for b in scene.columns if b.startswith("b")})


def landsat(*collections: DataFrame, most: int = 24) -> DataFrame:
    """Surface temperatures of several collections, clear pixels, the first scenes by date."""
    out = collections[0]
    for c in collections[1:]:
        out = out.unionByName(c)
    ids = out.select("scene_id", "date").distinct().orderBy("date", "scene_id").limit(most)
    clear = out.where(bits_clear(F.col("qa"))).join(F.broadcast(ids.select("scene_id")), "scene_id")  # at most `most` rows
    return clear.withColumn("lst", known(landsat_celsius(F.col("st")))).drop("st", "qa")


def station_passes(pixels: DataFrame, most: int = 30, least_clear: float = 0.0) -> DataFrame:
    """pixels(scene_id, ts, row, col, kelvin, qc, cloud) -> scene_id, date, night, clear, row, col, lst in degrees C.

    The two lowest bits of qc grade a pixel: 0 and 1 are used; a cloud flag other than 0, or any null
    among these, isn't clear. Scenes of the day (7 to 17 h) and of the night (from 19 h, to 4 h) are taken
    apart, half of `most` each by time, so that neither crowds out the other; night is by local
    time, an hour ahead. A scene whose share of clear pixels isn't above least_clear is left out.
    """
    good = F.coalesce((bit_field(F.col("qc"), 0, 2) <= 1) & (F.col("cloud") == 0) & F.col("kelvin").isNotNull(), F.lit(False))
    px = pixels.withColumn("good", good)
    scenes = px.groupBy("scene_id").agg(F.min("ts").alias("ts"), F.avg(F.col("good").cast("double")).alias("clear")).where(F.col("clear") > least_clear)
    hour = F.hour("ts")
    part = F.when(hour.between(7, 17), "day").when((hour >= 19) | (hour <= 4), "night")
    first = Window.partitionBy("part").orderBy("ts", "scene_id")
    taken = scenes.withColumn("part", part).where("part is not null").withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most // 2)
    local = (hour + 1) % 24
    taken = taken.select("scene_id", F.to_date("ts").alias("date"), ((local < 6) | (local >= 20)).alias("night"), "clear")
    return px.where("good").join(F.broadcast(taken), "scene_id").select("scene_id", "date", "night", "clear", "row", "col", (F.col("kelvin") - 273.15).alias("lst"))  # taken: at most `most` rows


def best_scene(scenes: DataFrame, date: str, days: int, clouds: float = 20.0) -> DataFrame:
    """The nearest clear scene to a date: scenes(scene_id, date, cloud)."""
    apart = F.abs(F.datediff("date", F.lit(date)))
    return scenes.where((F.col("cloud") < clouds) & (apart <= days)).withColumn("apart", apart).orderBy("apart", "cloud", "scene_id").limit(1)


def mosaic(surveys: dict[str, DataFrame], value: str) -> DataFrame:
    """Surveys in order over each other: row, col, value and the survey's name, the last on top."""
    out = None
    for n, (name, d) in enumerate(surveys.items()):
        d = d.where(F.col(value).isNotNull()).select("row", "col", F.struct(F.lit(n).alias("n"), F.col(value).alias("v"), F.lit(name).alias("survey")).alias("s"))
        out = d if out is None else out.unionByName(d)
    return out.groupBy("row", "col").agg(F.max("s").alias("s")).select("row", "col", F.col("s.v").alias(value), "s.survey")


def newest_per_date(scenes: DataFrame) -> DataFrame:
    """One scene a date: the clearest, the first of equals."""
    w = Window.partitionBy("date").orderBy(F.desc("clear"), "scene_id")
    return scenes.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
