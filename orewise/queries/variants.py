"""The second product's rules, which differ from the first's, and small compositions."""

from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..operators import focal, modelling, validation, zonal
from ..plans import inventory as plans
from . import query
from .inputs import r4

N = "3.1415926e-8"
R = ("(round({} + " + N + ", 4) + 0.0)").format


@query(
    "g01_polygon_stats", f"SELECT label, {R('sum(greatest(h, 0) * 1.0)')} AS volume_m3, count(*) FILTER (h > 0.5) AS occupied_px, {R('max(h)')} AS hmax FROM lpx WHERE label > 0 GROUP BY label", "lpx",
)
def polygon_stats(i):
    """Plain volume, occupied area and top of each polygon."""
    return zonal.zonal(i.lpx, volume_m3=r4(F.sum(F.greatest("h", F.lit(0.0)))), occupied_px=F.count_if(F.col("h") > 0.5), hmax=r4(F.max("h")))


@query(
    "g02_form_class",
    "SELECT label, n, CASE WHEN n <= 25 THEN 'small' WHEN top / nullif(mean, 0) < 1.5 THEN 'building' ELSE 'pile' END AS form FROM (SELECT label, count(*) AS n, max(h) AS top, avg(h) AS mean FROM lpx WHERE label > 0 AND h > 10 GROUP BY label)", "lpx",
)
def form_class(i):
    """Forms by count and fullness alone, without opening or vegetation."""
    z = zonal.zonal(i.lpx.where("h > 10"), n=F.count("*"), top=F.max("h"), mean=F.avg("h"))
    full = F.col("top") / F.nullif(F.col("mean"), F.lit(0.0))
    return z.select("label", "n", F.when(F.col("n") <= 25, "small").when(full < 1.5, "building").otherwise("pile").alias("form"))


@query(
    "g10_plain_alert",
    """SELECT label, CASE WHEN hot >= 0.5 AND n >= 20 THEN 'critical' WHEN hot >= 0.3 THEN 'warning' WHEN hot > 0.1 THEN 'watch' ELSE 'none' END AS alert FROM (SELECT label, avg((lst > 60)::INT) AS hot, count(*) AS n FROM obs GROUP BY label)""", "obs",
)
def plain_alert(i):
    """Alerts by persistence alone."""
    o = i.obs.groupBy("label").agg(F.avg((F.col("lst") > 60).cast("double")).alias("hot"), F.count("*").alias("n"))
    level = F.when((F.col("hot") >= 0.5) & (F.col("n") >= 20), "critical").when(F.col("hot") >= 0.3, "warning").when(F.col("hot") > 0.1, "watch").otherwise("none")
    return o.select("label", level.alias("alert"))


@query("g13_profile", f"SELECT row, {R('avg(dsm)')} AS dsm, {R('avg(dtm)')} AS dtm FROM px WHERE col BETWEEN 40 AND 42 GROUP BY row", "px")
def profile(i):
    """Heights along a line."""
    return i.px.where("col between 40 and 42").groupBy("row").agg(r4(F.avg("dsm")).alias("dsm"), r4(F.avg("dtm")).alias("dtm"))


@query("g13_tonnes_by_density", f"SELECT pile_id, d.commodity, {R('volume * rho')} AS tonnage_t FROM stock, density d", "stock density")
def tonnes_by_density(i):
    """Every material's tonnage of each pile: a row for each of the nine densities."""
    from ..config import DENSITY

    every = F.array(*[F.struct(F.lit(k).alias("commodity"), F.lit(v).alias("rho")) for k, v in DENSITY.items()])
    each = i.stock.select("pile_id", "volume", F.explode(every).alias("d"))
    return each.select("pile_id", "d.commodity", r4(F.col("volume") * F.col("d.rho")).alias("tonnage_t"))


@query(
    "g14_background",
    """, own AS (SELECT row, col FROM lpx WHERE label > 0 AND h > 15), near AS (SELECT DISTINCT o.row + a AS row, o.col + b AS col FROM own o, (SELECT unnest([-1, 0, 1]) AS a), (SELECT unnest([-1, 0, 1]) AS b) WHERE a * a + b * b <= 1)
  SELECT row, col FROM px WHERE NOT (green - nir) / (green + nir + 1e-6) > 0.1 AND NOT (nir - red) / (nir + red + 1e-6) > 0.4 AND (row, col) NOT IN (SELECT row, col FROM near)""", "lpx",
)
def background(i):
    """Ground that is no pile with its buffer, no water and no vegetation."""
    near = focal.dilated(i.lpx.where("label > 0 and h > 15").select("row", "col"), focal.offsets("disc", 1))
    g, n, r = F.col("green"), F.col("nir"), F.col("red")
    return i.px.where(~(ratio(g, n) > 0.1) & ~(ratio(n, r) > 0.4)).select("row", "col").join(near, ["row", "col"], "left_anti")


@query(
    "a16_pixel_metrics", f"SELECT count(*) AS n, {R('sqrt(avg((nir - red) ^ 2))')} AS rmse, {R('avg(abs(nir - red))')} AS mae, {R('avg(nir - red)')} AS bias, {R('1 - sum((nir - red) ^ 2) / (var_pop(red) * count(*))')} AS r2 FROM px", "px",
)
def pixel_metrics(i):
    """Errors over pixels."""
    return modelling.pixel_metrics(i.px, "nir", "red").select("n", *[r4(c).alias(c) for c in ("rmse", "mae", "bias", "r2")])


@query("a20_material_kpi", f"SELECT coalesce(commodity, 'none') AS material, count(*) AS n, {R('sum(volume)')} AS volume_m3, {R('avg(volume)')} AS mean_m3 FROM stock GROUP BY 1", "stock")
def material_kpi(i):
    """Counts and sums by material."""
    return i.stock.groupBy(F.coalesce("commodity", F.lit("none")).alias("material")).agg(F.count("*").alias("n"), r4(F.sum("volume")).alias("volume_m3"), r4(F.avg("volume")).alias("mean_m3"))


@query("a34_coverage_mean", f"SELECT {R('avg((cover > 0.8)::INT)')} AS seen, {R('avg(cover)')} AS cover FROM (SELECT label, avg((green > 0.33)::INT) AS cover FROM lpx WHERE label > 0 GROUP BY label)", "lpx")
def coverage_mean(i):
    """Share of piles that are well seen."""
    z = zonal.zonal(i.lpx, cover=zonal.share(F.col("green") > 0.33))
    return z.agg(r4(zonal.share(F.col("cover") > 0.8)).alias("seen"), r4(F.avg("cover")).alias("cover"))


@query(
    "a35_fit_quality", f"SELECT {R('avg(r2)')} AS r2 FROM (SELECT regr_r2(blue, nir) AS r2 FROM px UNION ALL SELECT regr_r2(green, nir) FROM px UNION ALL SELECT regr_r2(red, nir) FROM px)", "px",
)
def fit_quality(i):
    """Mean R2 of the bands' fits."""
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("y"), F.col("nir").alias("x")) for b in ("blue", "green", "red")])
    return i.px.select(F.explode(bands).alias("e")).select("e.*").groupBy("band").agg(F.regr_r2("y", "x").alias("r2")).agg(r4(F.avg("r2")).alias("r2"))


@query(
    "c10_ground_check",
    f"SELECT count(*) AS n, {R('100 * sum(abs(b - a)) / sum(abs(a))')} AS wape_pct FROM (SELECT label, sum(greatest(dsm - dtm, 0)) AS a, sum(greatest(dsm - g, 0)) AS b FROM lpx JOIN (SELECT row // 8 AS br, col // 8 AS bc, min(dtm) AS g FROM px GROUP BY 1, 2) ON br = row // 8 AND bc = col // 8 WHERE label > 0 GROUP BY label)", "lpx",
)
def ground_check(i):
    """Volumes over block minima against those over the known ground."""
    k = [F.floor(F.col(c) / 8).alias(f"b{c}") for c in ("row", "col")]
    g = i.px.groupBy(*k).agg(F.min("dtm").alias("g"))
    z = zonal.zonal(i.lpx.select("*", *k).join(g, ["brow", "bcol"]), a=F.sum(F.greatest(F.col("dsm") - F.col("dtm"), F.lit(0.0))), b=F.sum(F.greatest(F.col("dsm") - F.col("g"), F.lit(0.0))))
    return validation.metrics(z, "a", "b").select("n", r4("wape_pct").alias("wape_pct"))


@query(
    "c11_sentences", "SELECT commodity, printf('%s: %d piles, %d m3', commodity, count(*), floor(sum(volume))::BIGINT) AS line FROM stock GROUP BY commodity", "stock",
)
def sentences(i):
    """Text lines from aggregates."""
    s = i.stock.groupBy("commodity").agg(F.count("*").alias("n"), F.floor(F.sum("volume")).alias("v"))
    return s.select("commodity", F.format_string("%s: %d piles, %d m3", "commodity", "n", "v").alias("line"))


@query(
    "c17_upper_half",
    f"SELECT label, {R('median(red)')} AS red, {R('median(blue)')} AS blue, count(*) AS n FROM (SELECT *, median(h) OVER (PARTITION BY label) AS m FROM lpx WHERE label > 0) WHERE h >= m GROUP BY label HAVING count(*) >= 20", "lpx",
)
def upper_half(i):
    """Median colours over the upper half of each pile."""
    from pyspark.sql.window import Window

    m = F.median("h").over(Window.partitionBy("label"))
    top = i.lpx.where("label > 0").withColumn("m", m).where("h >= m")
    return zonal.zonal(top, red=r4(F.median("red")), blue=r4(F.median("blue")), n=F.count("*")).where("n >= 20")


@query(
    "a28_object_folds", "SELECT label, (median(row)::INT // 16 * 7 + median(col)::INT // 16 * 13) % 5 AS fold FROM lpx WHERE label > 0 GROUP BY label", "lpx",
)
def object_folds(i):
    """Each object's fold by its median place."""
    at = lambda c: F.floor(F.rint(F.median(c)).cast("int") / 16)
    return zonal.zonal(i.lpx, fold=((at("row") * 7 + at("col") * 13) % 5).cast("int"))


@query("c15_port_detection")
def port_detection(i):
    """Port objects over a flat level: opening, components, half-widths, roughness, classes, materials."""
    from ..operators.grid import sheet

    px = i.px.select("row", "col", "dsm", F.lit(0.0).alias("ndvi"), ((F.col("red") + F.col("green") + F.col("blue")) / 3).alias("bright"))
    out = plans.detect_port(px, 15.0, sheet(96, 96), 4.0)
    return out.select("label", "class", "material", *[r4(c).alias(c) for c in ("area", "half_width", "rough", "bright")])
