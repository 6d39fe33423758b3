"""Reductions by object: statistics, forms, volumes, plane fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import DEFAULT, Settings
from ..sources.tables import numbered


def zonal(px: DataFrame, **aggs: Column) -> DataFrame:
    """Aggregates by label over labelled pixels."""
    return px.where("label > 0").groupBy("label").agg(*[c.alias(k) for k, c in aggs.items()])


def for_every(labels: DataFrame, stats: DataFrame) -> DataFrame:
    """A row for every label, nulls where it has no pixel."""
    return labels.select("label").distinct().join(stats, "label", "left")


def share(c: Column) -> Column:
    """Share of true among the known."""
    return F.avg(c.cast("double"))


def forms(px: DataFrame, pixel_area: float, s: Settings = DEFAULT) -> DataFrame:
    """px(label, h, slope, ndvi) -> area, heights, wall and flat-top shares, fill ratio, mean NDVI by object."""
    top = F.max("h").over(Window.partitionBy("label"))
    px = px.where("label > 0").withColumn("top", F.col("h") >= 0.7 * top)
    return zonal(
        px,
        area=F.count("*") * F.lit(pixel_area), hmax=F.max("h"), hmean=F.avg("h"), wall=share(F.col("slope") > s.wall_slope),
        flat_top=share(F.when(F.col("top"), F.col("slope") < s.flat_slope)), ndvi=F.avg("ndvi"),
        fill=F.when(F.max("h") > 0, F.avg("h") / F.max("h")),
    )


def volumes(px: DataFrame, pixel_area: float, s: Settings = DEFAULT) -> DataFrame:
    """px(label, h) -> area, volume, mean and top height, volume's sigma; missing heights count as zero."""
    h = F.greatest(F.coalesce(F.col("h"), F.lit(0.0)), F.lit(0.0))
    area, volume = F.count("*") * F.lit(pixel_area), F.sum(h) * F.lit(pixel_area)
    return zonal(px, area_m2=area, volume_m3=volume, mean_height_m=volume / area, max_height_m=F.max(h), sigma_m3=area * F.lit(s.sigma_z))


def coverage(px: DataFrame, value: str = "h") -> DataFrame:
    return zonal(px, coverage=share(F.col(value).isNotNull()))


def gated(value: Column, coverage: Column, s: Settings = DEFAULT) -> Column:
    """The value where enough of the object was seen."""
    return F.when(coverage >= s.min_coverage, value)


def solve3(a: list[list[Column]], b: list[Column]) -> list[Column]:
    """A symmetric 3 x 3 system by Cramer's rule; null where it is singular."""

    def det(m: list[list[Column]]) -> Column:
        return (
            m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
            - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
            + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
        )

    whole = det(a)
    part = lambda k: det([[b[i] if j == k else a[i][j] for j in range(3)] for i in range(3)])
    return [F.when(F.abs(whole) > 1e-9, part(k) / F.when(F.abs(whole) > 1e-9, whole)) for k in range(3)]


def planes(points: DataFrame) -> DataFrame:
    """points(label, x, y, z) -> label, n, z = a (x - xm) + b (y - ym) + c: least squares by moments."""
    mean = points.groupBy("label").agg(F.avg("x").alias("xm"), F.avg("y").alias("ym"))
    p = points.join(mean, "label").withColumns({"u": F.col("x") - F.col("xm"), "v": F.col("y") - F.col("ym")})
    m = p.groupBy("label").agg(
        F.first("xm").alias("xm"), F.first("ym").alias("ym"), F.count("z").alias("n"), F.sum("u").alias("su"), F.sum("v").alias("sv"), F.sum("z").alias("sz"),
        *[F.sum(F.col(i) * F.col(j)).alias(i + j) for i, j in ("uu", "uv", "vv", "uz", "vz")],
    )
    c = F.col
    abc = solve3([[c("uu"), c("uv"), c("su")], [c("uv"), c("vv"), c("sv")], [c("su"), c("sv"), c("n").cast("double")]], [c("uz"), c("vz"), c("sz")])
    return m.select("label", "xm", "ym", "n", *[x.alias(k) for x, k in zip(abc, "abc")])


def toe_planes(ring: DataFrame, least: int = 6) -> DataFrame:
    """Planes through ring(label, x, y, z), fitted again without points beyond two sigmas; labels with few points have none."""
    ring = ring.where("z is not null")
    residual = lambda: F.col("z") - (F.col("a") * (F.col("x") - F.col("xm")) + F.col("b") * (F.col("y") - F.col("ym")) + F.col("c"))
    first = planes(ring).where(F.col("n") >= least)
    r = ring.join(first, "label").withColumn("r", residual())
    near = F.abs("r") <= 2 * F.greatest(F.stddev_pop("r").over(Window.partitionBy("label")), F.lit(1e-6))
    again = planes(r.where(F.lit(True)).withColumn("near", near).where("near").select("label", "x", "y", "z")).where(F.col("n") >= least)
    better = again.select("label", *[F.col(k).alias(f"{k}2") for k in ("xm", "ym", "n", "a", "b", "c")])
    pick = lambda k: F.coalesce(f"{k}2", k).alias(k)
    return first.join(better, "label", "left").select("label", *map(pick, ("xm", "ym", "n", "a", "b", "c")))


def toe_volumes(px: DataFrame, fits: DataFrame, pixel_area: float) -> DataFrame:
    """px(label, x, y, dsm) above the planes: volume and top by label."""
    base = F.col("a") * (F.col("x") - F.col("xm")) + F.col("b") * (F.col("y") - F.col("ym")) + F.col("c")
    h = F.greatest(F.coalesce(F.col("dsm") - base, F.lit(0.0)), F.lit(0.0))
    return zonal(px.join(fits, "label"), volume_m3=F.sum(h) * F.lit(pixel_area), max_height_m=F.max(h))


def elongation(px: DataFrame) -> DataFrame:
    """Axis ratio of each object's pixels, from the covariance's eigenvalues; 1 below three pixels."""
    a, b, c = F.var_samp("row"), F.var_samp("col"), F.covar_samp("row", "col")
    root = F.sqrt((a - b) ** 2 + 4 * c**2)
    low = F.greatest((a + b - root) / 2, F.lit(1e-6))
    return zonal(px, n_px=F.count("*"), elongation=F.when(F.count("*") >= 3, F.sqrt((a + b + root) / 2 / low)).otherwise(1.0))


def robust(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Median and 1.4826 MAD by group; null below three values."""
    known = df.where(F.col(value).isNotNull())
    mid = known.groupBy(by).agg(F.median(value).alias("med"), F.count("*").alias("n"))
    mad = known.join(mid, by).groupBy(by).agg((1.4826 * F.median(F.abs(F.col(value) - F.col("med")))).alias("mad"))
    enough = F.col("n") >= 3
    return mid.join(mad, by).select(*by, "n", F.when(enough, F.col("med")).alias("med"), F.when(enough, F.col("mad")).alias("mad"))


def renumbered(objects: DataFrame, keep: Column) -> DataFrame:
    """Kept labels numbered 1.. in their order: label, new."""
    return numbered(objects.where(keep), "label", "new")


def stretched(px: DataFrame, value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """The value between two percentiles as 0 to 255."""
    ends = px.agg(F.percentile(value, low).alias("lo"), F.percentile(value, high).alias("hi"))
    scaled = (F.col(value) - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-9))
    return px.crossJoin(F.broadcast(ends)).withColumn("byte", F.floor(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)) * 255).cast("int")).drop("lo", "hi")


def scene_scaled(px: DataFrame, bands: list[str]) -> DataFrame:
    """Bands over the scene's 98th percentile of mean visible brightness, cut at 1.5."""
    visible = [F.col(b) for b in bands if b in ("red", "green", "blue")]
    known = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in visible), F.lit(0))
    mean = sum((F.coalesce(v, F.lit(0.0)) for v in visible), F.lit(0.0)) / F.when(known > 0, known)
    p = px.agg(F.percentile(mean, 0.98).alias("p")).select(F.when(F.col("p") > 0, F.col("p")).otherwise(1.0).alias("p"))
    return px.crossJoin(F.broadcast(p)).withColumns({b: F.least(F.greatest(F.col(b) / F.col("p"), F.lit(0.0)), F.lit(1.5)) for b in bands}).drop("p")
