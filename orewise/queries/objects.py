"""Reductions by object, windows, rankings and set operations."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import DENSITY
from ..functions import classes
from ..operators import focal, zonal
from ..operators.grid import sheet
from ..plans import inventory as plans
from ..sources.tables import numbered
from . import query
from .inputs import r4

N = "3.1415926e-8"
R = ("(round({} + " + N + ", 4) + 0.0)").format
G = sheet(96, 96)


@query("a01_zonal", f"SELECT label, {R('sum(h)')} AS total, {R('avg(h)')} AS mean, {R('max(h)')} AS top, count(*) AS n FROM lpx WHERE label > 0 GROUP BY label", "lpx")
def zonal_stats(i):
    """Sum, mean, maximum and count by label."""
    return zonal.zonal(i.lpx, total=r4(F.sum("h")), mean=r4(F.avg("h")), top=r4(F.max("h")), n=F.count("*"))


GRAD = """, g AS (SELECT p.row, p.col, p.label, p.h, (p.nir - p.red) / (p.nir + p.red + 1e-6) AS ndvi, degrees(atan(sqrt(coalesce(
    CASE WHEN b.dsm IS NOT NULL AND a.dsm IS NOT NULL THEN (a.dsm - b.dsm) / 2 WHEN a.dsm IS NOT NULL THEN a.dsm - p.dsm WHEN b.dsm IS NOT NULL THEN p.dsm - b.dsm END, 0) ^ 2 + coalesce(
    CASE WHEN u.dsm IS NOT NULL AND d.dsm IS NOT NULL THEN (d.dsm - u.dsm) / 2 WHEN d.dsm IS NOT NULL THEN d.dsm - p.dsm WHEN u.dsm IS NOT NULL THEN p.dsm - u.dsm END, 0) ^ 2))) AS slope
  FROM lpx p LEFT JOIN px b ON b.row = p.row AND b.col = p.col - 1 LEFT JOIN px a ON a.row = p.row AND a.col = p.col + 1
    LEFT JOIN px u ON u.col = p.col AND u.row = p.row - 1 LEFT JOIN px d ON d.col = p.col AND d.row = p.row + 1),
forms AS (SELECT label, count(*)::DOUBLE AS area, max(h) AS hmax, avg(h) AS hmean, avg((slope > 65)::INT) AS wall, avg(CASE WHEN h >= 0.7 * m THEN (slope < 5)::INT END) AS flat_top, avg(ndvi) AS ndvi
  FROM (SELECT *, max(h) OVER (PARTITION BY label) AS m FROM g WHERE label > 0) GROUP BY label)"""


def _forms(i):
    px = focal.slope_degrees(i.lpx, "dsm", 1.0).withColumn("ndvi", (F.col("nir") - F.col("red")) / (F.col("nir") + F.col("red") + 1e-6))
    return zonal.forms(px, 1.0)


@query(
    "a02_forms",
    GRAD + f""" SELECT label, area, {R('hmax')} AS hmax, {R('hmean')} AS hmean, {R('wall')} AS wall, {R('flat_top')} AS flat_top, {R('ndvi')} AS ndvi, {R('hmean / hmax')} AS fill,
  CASE WHEN area < 25 THEN 'too_small' WHEN ndvi > 0.3 THEN 'vegetation' WHEN wall > 0.12 OR (flat_top > 0.55 AND hmax > 2.5) OR hmean / hmax > 0.75 THEN 'structure' ELSE 'stockpile' END AS class,
  area >= 15 AND NOT ndvi > 0.3 AND NOT (hmean / hmax < 0.75 AND wall < 0.12) AS is_structure FROM forms""", "lpx",
)
def forms(i):
    """Form statistics, object classes and structures."""
    c = F.col
    f = _forms(i)
    kind = classes.object_class(c("area"), c("ndvi"), c("wall"), c("flat_top"), c("hmax"), c("hmean"))
    structure = classes.is_structure(c("area"), c("ndvi"), c("hmax"), c("hmean"), c("wall"))
    return f.select("label", "area", *[r4(k).alias(k) for k in ("hmax", "hmean", "wall", "flat_top", "ndvi", "fill")], kind.alias("class"), structure.alias("is_structure"))


@query(
    "a03_volumes",
    f"SELECT label, count(*)::DOUBLE AS area_m2, {R('sum(greatest(coalesce(h, 0), 0))')} AS volume_m3, {R('sum(greatest(h, 0)) / count(*)')} AS mean_height_m, {R('max(h)')} AS max_height_m, {R('count(*) * 0.05')} AS sigma_m3 FROM lpx WHERE label > 0 GROUP BY label", "lpx",
)
def volumes(i):
    """Volumes and their bands."""
    return zonal.volumes(i.lpx, 1.0).select("label", "area_m2", *[r4(c).alias(c) for c in ("volume_m3", "mean_height_m", "max_height_m", "sigma_m3")])


@query(
    "a00_pile_volume",
    f"""SELECT label, commodity, {R('v')} AS volume_m3, {R('cover')} AS coverage, {R('p99')} AS p99, {R('v * coalesce(rho, 1)')} AS tonnage_t FROM (
    SELECT label, sum(greatest(h, 0)) AS v, avg((h IS NOT NULL)::INT) AS cover, quantile_cont(h, 0.99) AS p99, ['coal', 'coke', 'iron_ore', 'limestone', 'mystery'][label % 5 + 1] AS commodity FROM lpx WHERE label > 0 GROUP BY label)
  LEFT JOIN density USING (commodity) WHERE cover >= 0.8""", "lpx density",
)
def pile_volume(i):
    """Volume, coverage, 99th percentile and tonnage of well-seen piles."""
    names = F.array(*map(F.lit, ["coal", "coke", "iron_ore", "limestone", "mystery"]))
    piles = zonal.zonal(i.lpx, v=F.sum(F.greatest("h", F.lit(0.0))), cover=zonal.share(F.col("h").isNotNull()), p99=F.percentile("h", 0.99))
    piles = piles.where("cover >= 0.8").withColumn("commodity", F.element_at(names, F.col("label") % 5 + 1))
    t = plans.with_tonnage(piles, "v")
    return t.select("label", "commodity", r4("v").alias("volume_m3"), r4("cover").alias("coverage"), r4("p99").alias("p99"), r4("tonnage_t").alias("tonnage_t"))


@query(
    "a05_coverage_gate",
    f"SELECT label, {R('cover')} AS coverage, CASE WHEN cover >= 0.8 THEN {R('v')} END AS volume_m3 FROM (SELECT label, avg((green > 0.3)::INT) AS cover, sum(h) AS v FROM lpx WHERE label > 0 GROUP BY label)", "lpx",
)
def coverage_gate(i):
    """Measures only where enough was seen."""
    seen = i.lpx.withColumn("seen", F.when(F.col("green") > 0.3, F.col("h")))
    z = zonal.zonal(seen, cover=zonal.share(F.col("seen").isNotNull()), v=F.sum("h"))
    return z.select("label", r4("cover").alias("coverage"), zonal.gated(r4("v"), F.col("cover")).alias("volume_m3"))


@query(
    "a06_percentiles",
    f"SELECT label, {R('quantile_cont(h, 0.99)')} AS p99, {R('quantile_cont(h, 0.95)')} AS p95, {R('median(CASE WHEN h > 0.5 THEN red END)')} AS red, {R('median(CASE WHEN h > 0.5 THEN blue END)')} AS blue, median(row)::INT AS row, median(col)::INT AS col FROM lpx WHERE label > 0 GROUP BY label", "lpx",
)
def percentiles(i):
    """High percentiles, median colours over occupied pixels, median places."""
    colour = lambda b: r4(F.median(F.when(F.col("h") > 0.5, F.col(b))))
    place = lambda c: F.rint(F.median(c)).cast("int")
    return zonal.zonal(i.lpx, p99=r4(F.percentile("h", 0.99)), p95=r4(F.percentile("h", 0.95)), red=colour("red"), blue=colour("blue"), row=place("row"), col=place("col"))


@query("a08_ground_level", f"SELECT label % 4 AS block, {R('quantile_cont(CASE WHEN green < 0.6 THEN dsm END, 0.05)')} AS ground FROM lpx GROUP BY 1", "lpx")
def ground_level(i):
    """A low percentile of each block's land."""
    land = F.when(F.col("green") < 0.6, F.col("dsm"))
    return i.lpx.groupBy((F.col("label") % 4).alias("block")).agg(r4(F.percentile(land, 0.05)).alias("ground"))


@query(
    "a09_robust",
    f"""SELECT label, n, CASE WHEN n >= 3 THEN {R('med')} END AS med, CASE WHEN n >= 3 THEN {R('1.4826 * mad')} END AS mad FROM (
    SELECT label, any_value(n) AS n, any_value(med) AS med, median(abs(h - med)) AS mad FROM (SELECT label, h, median(h) OVER (PARTITION BY label) AS med, count(*) OVER (PARTITION BY label) AS n FROM lpx WHERE label > 0) GROUP BY label)""", "lpx",
)
def robust(i):
    """Median and scaled MAD."""
    return zonal.robust(i.lpx.where("label > 0"), ["label"], "h").select("label", "n", r4("med").alias("med"), r4("mad").alias("mad"))


@query("a04_toe_volume")
def toe_volume(i):
    """Volumes above planes through the pixels around each pile."""
    own = i.lpx.where("label > 0")
    around = focal.spread(own.select("row", "col", "label"), focal.offsets("cross", 2)).select("row", "col", "label").distinct()
    ring = around.join(own.select("row", "col", "label"), ["row", "col", "label"], "left_anti").join(i.px.select("row", "col", "dsm"), ["row", "col"])
    x, y = G.centre(F.col("row"), F.col("col"))
    fits = zonal.toe_planes(ring.select("label", x.alias("x"), y.alias("y"), F.col("dsm").alias("z")))
    out = zonal.toe_volumes(own.withColumns({"x": x, "y": y}), fits, 1.0)
    return out.select("label", r4("volume_m3").alias("volume_m3"), r4("max_height_m").alias("max_height_m"))


@query(
    "a25_elongation",
    f"""SELECT label, n_px, CASE WHEN n_px >= 3 THEN {R('sqrt((a + b + sqrt((a - b) ^ 2 + 4 * c ^ 2)) / 2 / greatest((a + b - sqrt((a - b) ^ 2 + 4 * c ^ 2)) / 2, 1e-6))')} ELSE 1.0 END AS elongation
  FROM (SELECT label, count(*) AS n_px, var_samp(row) AS a, var_samp(col) AS b, covar_samp(row, col) AS c FROM lpx WHERE label > 0 AND h > 15 GROUP BY label)""", "lpx",
)
def elongation(i):
    """Axis ratio of the high pixels."""
    return zonal.elongation(i.lpx.where("h > 15")).select("label", "n_px", r4("elongation").alias("elongation"))


@query(
    "a33_outline_audit",
    GRAD + f""" SELECT label, {R('100 * flat_top')} AS flat_pct, {R('100 * wall')} AS steep_pct, {R('hmax')} AS hmax, med AS median_slope FROM forms
  JOIN (SELECT label, {R('median(slope)')} AS med FROM g GROUP BY label) USING (label)""", "lpx",
)
def outline_audit(i):
    """Flat tops, steep edges, median slopes."""
    px = focal.slope_degrees(i.lpx, "dsm", 1.0).withColumn("ndvi", F.lit(0.0))
    slopes = px.groupBy("label").agg(r4(F.median("slope")).alias("median_slope"))
    return zonal.forms(px, 1.0).join(slopes, "label").select("label", r4(100 * F.col("flat_top")).alias("flat_pct"), r4(100 * F.col("wall")).alias("steep_pct"), r4("hmax").alias("hmax"), "median_slope")


@query("a27_roughness")
def roughness(i):
    """Root mean square of heights against their 5 m box mean, and the scrap rule."""
    smooth = focal.box(i.lpx, "h", 5, (96, 96))
    z = zonal.zonal(i.lpx.join(smooth, ["row", "col"]), rough=F.sqrt(F.avg((F.col("h") - F.col("mean")) ** 2)), patchy=F.stddev_pop((F.col("red") + F.col("green") + F.col("blue")) / 3))
    return z.select("label", r4("rough").alias("rough"), r4("patchy").alias("patchy"), classes.scrap_or_bulk(F.col("rough"), F.col("patchy")).alias("material"))


@query(
    "p17_port_piles",
    f"""SELECT label, {R('b')} AS bright, CASE WHEN r >= 7.4 AND NOT b < 0.4 THEN 'scrap_metal' WHEN b < 0.4 THEN 'dark_bulk' WHEN b >= 0.42 THEN 'light_bulk' ELSE 'bulk' END AS material
  FROM (SELECT label, avg((red + green + blue) / 3) AS b, stddev_pop(h) AS r FROM lpx WHERE label > 0 GROUP BY label)""", "lpx",
)
def port_piles(i):
    """Port materials by roughness and brightness."""
    z = zonal.zonal(i.lpx, b=F.avg((F.col("red") + F.col("green") + F.col("blue")) / 3), r=F.stddev_pop("h"))
    return z.select("label", r4("b").alias("bright"), classes.port_material(F.col("r"), F.col("b"), 7.4, 0.4, 0.42).alias("material"))


RHO = "JOIN density USING (commodity)"


@query("p21_tonnage", f"SELECT pile_id, commodity, {R('volume * coalesce(rho, 1.0)')} AS tonnage_t FROM stock LEFT {RHO}", "stock density")
def tonnage(i):
    """Tonnes by density, unknown materials at one."""
    return plans.with_tonnage(i.stock, "volume").select("pile_id", "commodity", r4("tonnage_t").alias("tonnage_t"))


@query(
    "a19_totals",
    f"SELECT commodity, count(*) AS n, {R('sum(volume)')} AS volume_m3, {R('sum(volume * coalesce(rho, 1.0))')} AS tonnage_t, {R('sqrt(sum((volume * 0.05) ^ 2))')} AS sigma_rss, {R('sum(volume * 0.05)')} AS sigma_linear FROM stock LEFT {RHO} GROUP BY ROLLUP (commodity)", "stock density",
)
def totals(i):
    """Totals by material and overall, with both sums of sigmas."""
    return plans.totals(i.stock.withColumn("sigma", F.col("volume") * 0.05)).select("commodity", "n", *[r4(c).alias(c) for c in ("volume_m3", "tonnage_t", "sigma_rss", "sigma_linear")])


@query(
    "a23_by_date",
    f"SELECT date::VARCHAR AS date, {R('sum(pred)')} AS total, {R('coalesce(sum(pred) FILTER (fold = 0), 0)')} AS scrap, {R('sum(pred) - coalesce(sum(pred) FILTER (fold = 0), 0)')} AS bulk FROM piles GROUP BY 1", "piles",
)
def by_date(i):
    """Totals by date, scrap and bulk apart."""
    scrap = F.coalesce(F.sum(F.when(F.col("fold") == 0, F.col("pred"))), F.lit(0.0))
    return i.piles.groupBy(F.col("date").cast("string").alias("date")).agg(r4(F.sum("pred")).alias("total"), r4(scrap).alias("scrap"), r4(F.sum("pred") - scrap).alias("bulk"))


@query(
    "a36_block_boxes", f"SELECT label % 4 AS block, min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1, median(label)::INT AS majority, {R('avg(red)')} AS seen FROM lpx WHERE label > 0 GROUP BY 1", "lpx",
)
def block_boxes(i):
    """Bounding boxes and median labels of blocks."""
    b = i.lpx.where("label > 0").groupBy((F.col("label") % 4).alias("block"))
    return b.agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"), F.rint(F.median("label")).cast("int").alias("majority"), r4(F.avg("red")).alias("seen"))


@query(
    "a18_probability_area",
    f"SELECT label, {R('sum(green) * 2.25')} AS area_m2, {R('count(*) FILTER (red > 0.4 AND blue > 0.4) / nullif(count(*) FILTER (red > 0.4 OR blue > 0.4), 0)')} AS iou FROM lpx GROUP BY label", "lpx",
)
def probability_area(i):
    """Expected areas, and the overlap of two masks."""
    from ..operators.validation import iou

    return i.lpx.groupBy("label").agg(r4(F.sum("green") * 2.25).alias("area_m2"), r4(iou(F.col("red") > 0.4, F.col("blue") > 0.4)).alias("iou"))


@query("w01_renumber", "SELECT label, (dense_rank() OVER (ORDER BY label))::INT AS new FROM (SELECT label, avg(h) AS m FROM lpx WHERE label > 0 GROUP BY label) WHERE m > 15", "lpx")
def renumber(i):
    """Kept labels renumbered."""
    return zonal.renumbered(zonal.zonal(i.lpx, m=F.avg("h")), F.col("m") > 15)


@query(
    "w02_cumulative", "SELECT label, CASE WHEN keep THEN sum(keep::INT) OVER (ORDER BY label)::BIGINT ELSE 0 END AS new FROM (SELECT label, avg(h) > 15 AS keep FROM lpx WHERE label > 0 GROUP BY label)", "lpx",
)
def cumulative(i):
    """Kept objects numbered by a running sum."""
    o = zonal.zonal(i.lpx, keep=F.avg("h") > 15)
    order = numbered(o.where("keep"), "label", "place")
    return o.join(order, "label", "left").select("label", F.coalesce(F.col("place").cast("long"), F.lit(0)).alias("new"))


@query(
    "w04_hottest_pixel", "SELECT label, row, col FROM (SELECT label, row, col, row_number() OVER (PARTITION BY label ORDER BY dsm DESC, row, col) AS n FROM lpx WHERE label > 0) WHERE n = 1", "lpx",
)
def hottest_pixel(i):
    """First highest pixel of each object in raster order."""
    best = F.max_by(F.struct("row", "col"), F.struct("dsm", (-F.col("row")).alias("r"), (-F.col("col")).alias("c")))
    return i.lpx.where("label > 0").groupBy("label").agg(best.alias("b")).select("label", "b.row", "b.col")


@query(
    "w09_part_letters", "SELECT pile_id, commodity, substr('abcdefgh', n::INT, 1) AS letter FROM (SELECT *, row_number() OVER (PARTITION BY commodity ORDER BY volume DESC, pile_id) AS n FROM stock) WHERE n <= 8", "stock",
)
def part_letters(i):
    """Letters a to h for the largest parts of a name."""
    n = F.row_number().over(Window.partitionBy("commodity").orderBy(F.desc("volume"), "pile_id"))
    return i.stock.withColumn("n", n).where("n <= 8").select("pile_id", "commodity", F.substring(F.lit("abcdefgh"), F.col("n"), F.lit(1)).alias("letter"))


@query("t05_top8", "SELECT pile_id, volume FROM stock ORDER BY volume DESC, pile_id LIMIT 8", "stock")
def top8(i):
    """The eight largest piles."""
    return i.stock.orderBy(F.desc("volume"), "pile_id").limit(8).select("pile_id", "volume")


@query(
    "t04_best_chain",
    f"SELECT fold, {R('wape')} AS wape FROM (SELECT fold, 100 * sum(abs(pred - actual)) / sum(abs(actual)) AS wape, count(*) AS n FROM piles GROUP BY fold) WHERE n > 10 ORDER BY wape LIMIT 1", "piles",
)
def best_chain(i):
    """Among those that pass the gate, the least error."""
    from ..operators.validation import metrics

    m = metrics(i.piles, by=["fold"]).where("n > 10")
    return m.agg(F.min_by(F.struct("fold", "wape_pct"), "wape_pct").alias("b")).select("b.fold", r4("b.wape_pct").alias("wape"))


@query(
    "u03_set_operations",
    """SELECT row, col, 'union' AS kind FROM (SELECT row, col FROM px WHERE red > 0.6 UNION SELECT row, col FROM px WHERE blue > 0.6)
  UNION ALL SELECT row, col, 'both' FROM (SELECT row, col FROM px WHERE red > 0.6 INTERSECT SELECT row, col FROM px WHERE blue > 0.6)
  UNION ALL SELECT row, col, 'only' FROM (SELECT row, col FROM px WHERE red > 0.6 EXCEPT SELECT row, col FROM px WHERE blue > 0.6)""", "px",
)
def set_operations(i):
    """Union, intersection and difference of pixel sets."""
    a, b = (i.px.where(F.col(c) > 0.6).select("row", "col") for c in ("red", "blue"))
    parts = {"union": a.union(b).distinct(), "both": a.intersect(b), "only": a.subtract(b)}
    out = None
    for k, d in parts.items():
        d = d.withColumn("kind", F.lit(k))
        out = d if out is None else out.unionByName(d)
    return out


@query("n15_components")
def components(i):
    """Connected objects of the high pixels, numbered in raster order."""
    from ..operators.components import labelled

    return labelled(i.px.where("dsm > 27").select("row", "col"), 96, tile=32)


@query("c16_detect_piles")
def detect(i):
    """Detection from the surface: opening, components, forms, classes."""
    out = plans.detect_piles(i.lpx.withColumn("ndvi", F.lit(0.0)).select("row", "col", "h", "dsm", "ndvi"), G)
    return out.select("label", "class", *[r4(c).alias(c) for c in ("area", "hmax", "hmean", "wall", "fill")])


@query("c16_detect_structures")
def structures(i):
    """Roofs, stacks and pipes by form."""
    out = plans.detect_structures(i.lpx.withColumn("ndvi", F.lit(0.0)).select("row", "col", "h", "ndvi"), G)
    return out.select("label", "class", *[r4(c).alias(c) for c in ("area", "hmax", "elongation")])


@query("c01_inventory")
def inventory(i):
    """The whole inventory of the derived site."""
    out = plans.inventory(i.lpx.select("row", "col", "label", "dsm", "dtm", "blue", "green", "red", "nir"), G)
    return out.select("label", "commodity", "source", *[r4(c).alias(c) for c in ("area_m2", "volume_m3", "coverage", "p99", "tonnage_t")])


assert DENSITY
