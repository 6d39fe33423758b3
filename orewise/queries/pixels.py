"""Map algebra, predicates, physics and focal operators."""

from pyspark.sql import functions as F

from ..functions import classes, columns, geo
from ..operators.distance import distance_inside
from ..operators import focal, resample, tiles, zonal
from ..operators.grid import sheet
from . import query
from .inputs import SIDE, r4

GRID = (SIDE, SIDE)
R = "(round({} + 3.1415926e-8, 4) + 0.0)".format


@query("p01_height", f"SELECT row, col, {R('dsm - dtm')} AS h, label > 0 AND dsm - dtm > 0.5 AS occupied, dsm - dtm > 0.5 AND dsm - dtm < 40 AS candidate FROM lpx", "lpx")
def height(i):
    """Height above ground, occupied and candidate pixels."""
    h = F.col("h")
    return i.lpx.select("row", "col", r4("h").alias("h"), ((F.col("label") > 0) & (h > 0.5)).alias("occupied"), ((h > 0.5) & (h < 40)).alias("candidate"))


@query(
    "p02_indices",
    f"""SELECT row, col, {R('(nir - red) / (nir + red + 1e-6)')} AS ndvi, {R('(green - nir) / (green + nir + 1e-6)')} AS ndwi,
  {R('(red - blue) / (red + blue + 1e-6)')} AS redness, {R('(red + green + blue) / 3')} AS brightness FROM px""", "px",
)
def indices(i):
    """Vegetation, water and redness indices, brightness."""
    r, g, b, n = map(F.col, ("red", "green", "blue", "nir"))
    out = {"ndvi": columns.ratio(n, r), "ndwi": columns.ratio(g, n), "redness": columns.ratio(r, b), "brightness": columns.brightness(r, g, b)}
    return i.px.select("row", "col", *[r4(c).alias(k) for k, c in out.items()])


@query(
    "p05_nodata",
    "SELECT row, col, CASE WHEN NOT (blue = 0 AND green = 0) THEN blue END AS blue, CASE WHEN NOT (blue = 0 AND green = 0) THEN green END AS green FROM px", "px",
)
def nodata(i):
    """All-zero pixels are no data."""
    b, g = F.col("blue"), F.col("green")
    return i.px.select("row", "col", columns.nodata_if_zero(b, b, g).alias("blue"), columns.nodata_if_zero(g, b, g).alias("green"))


@query(
    "p06_masks",
    """SELECT event_id, (event_id & 62) = 0 AS qa_clear, (event_id % 12) NOT IN (3, 8, 9, 10, 11) AS scl_clear,
  round((event_id % 60000) * 0.00341802 + 149.0 - 273.15 + 3.1415926e-8, 4) AS lst FROM events""",
)
def masks(i):
    """Quality bits, scene classes and surface temperature scaling."""
    e = F.col("event_id")
    return i.table("events").select("event_id", columns.bits_clear(e).alias("qa_clear"), columns.clear_class(e % 12).alias("scl_clear"), r4(columns.landsat_celsius(e % 60000)).alias("lst"))


@query(
    "p10_exclusion", "SELECT row, col, label > 0 OR dsm > 30 OR (green - nir) / (green + nir + 1e-6) > 0.1 AS excluded FROM lpx", "lpx",
)
def exclusion(i):
    """Piles, structures and water."""
    return i.lpx.select("row", "col", ((F.col("label") > 0) | (F.col("dsm") > 30) | (columns.ratio(F.col("green"), F.col("nir")) > 0.1)).alias("excluded"))


@query(
    "p13_scene_scaled",
    f"""SELECT row, col, {', '.join(f"{R(f'least(greatest({b} / p, 0), 1.5)')} AS {b}" for b in ("blue", "green", "red", "nir"))}
  FROM px, (SELECT quantile_cont((red + green + blue) / 3, 0.98) AS p FROM px)""", "px",
)
def scene_scaled(i):
    """Bands relative to the scene's bright end."""
    out = zonal.scene_scaled(i.px, ["blue", "green", "red", "nir"])
    return out.select("row", "col", *[r4(b).alias(b) for b in ("blue", "green", "red", "nir")])


COMMODITY = """CASE WHEN (nir - red) / (nir + red + 1e-6) > 0.3 THEN 'unknown'
  WHEN (red + green + blue) / 3 < 0.22 AND (red - blue) / (red + blue + 1e-6) < 0.2 THEN 'coal'
  WHEN (red - blue) / (red + blue + 1e-6) > 0.3 AND (red + green + blue) / 3 >= 0.6 THEN 'wood_chips'
  WHEN (red - blue) / (red + blue + 1e-6) > 0.18 AND (red + green + blue) / 3 < 0.6 THEN 'iron_ore'
  WHEN (red + green + blue) / 3 > 1.2 AND (red - blue) / (red + blue + 1e-6) < 0.15 THEN 'limestone'
  WHEN (red + green + blue) / 3 >= 0.6 AND (red - blue) / (red + blue + 1e-6) <= 0.18 THEN 'sand_gravel'
  WHEN (red - blue) / (red + blue + 1e-6) > 0.1 THEN 'scrap_metal' ELSE 'unknown' END"""


@query("p14_commodity", f"SELECT row, col, {COMMODITY} AS commodity FROM px", "px")
def commodity(i):
    """Material by colour."""
    return i.px.select("row", "col", classes.commodity(*map(F.col, ("red", "green", "blue", "nir"))).alias("commodity"))


@query(
    "p19_colour_class",
    "SELECT row, col, CASE WHEN red * 255 >= 140 THEN 'limestone' WHEN red - blue >= -0.05 THEN 'iron_ore' ELSE 'coal' END AS colour FROM px", "px",
)
def colour_class(i):
    """Lime, ore or coal by brightness and redness."""
    return i.px.select("row", "col", classes.colour_class(F.col("red") * 255, F.col("red") - F.col("blue")).alias("colour"))


@query(
    "p23_stretch",
    "SELECT row, col, floor(least(greatest((dsm - lo) / greatest(hi - lo, 1e-9), 0), 1) * 255)::INT AS byte FROM px, (SELECT quantile_cont(dsm, 0.02) AS lo, quantile_cont(dsm, 0.98) AS hi FROM px)", "px",
)
def stretch(i):
    """Percentile stretch to bytes."""
    return zonal.stretched(i.px, "dsm").select("row", "col", "byte")


@query(
    "p24_band_order", f"SELECT {R('p')} AS p99, CASE WHEN p > 0.4 THEN 'ok' ELSE 'check' END AS verdict FROM (SELECT quantile_cont((nir - red) / (nir + red + 1e-6), 0.99) AS p FROM px)", "px",
)
def band_order(i):
    """Is the band order plausible: vegetation must show."""
    p = i.px.agg(F.percentile(columns.ratio(F.col("nir"), F.col("red")), 0.99).alias("p"))
    return p.select(r4("p").alias("p99"), classes.band_order(F.col("p")).alias("verdict"))


@query("p27_quantised", "SELECT row, col, least(greatest(round_even((dsm - 10) / 0.25, 0), 1), 65535)::INT AS code, round_even(dsm / 4, 0) AS evened FROM px", "px")
def quantised(i):
    """Heights as 16-bit codes, half-even rounding."""
    return i.px.select("row", "col", columns.quantised(F.col("dsm"), 10, 0.25).alias("code"), columns.half_even(F.col("dsm") / 4, 0).alias("evened"))


F1 = """radiance AS (SELECT event_id, value / 5 AS t, 1.191042e8 / (10.9 ^ 5 * (exp(1.4387752e4 / 10.9 / (value / 5 + 273.15)) - 1)) AS l,
  1.191042e8 / (10.9 ^ 5 * (exp(1.4387752e4 / 10.9 / (20 + 273.15)) - 1)) AS bg FROM events)"""


@query(
    "f01_planck",
    f"""WITH {F1} SELECT event_id, round(l + 3.1415926e-8, 4) AS radiance, round(1.4387752e4 / 10.9 / ln(1.191042e8 / 10.9 ^ 5 / l + 1) - 273.15 + 3.1415926e-8, 4) AS back,
  CASE WHEN (l - 0.9975 * bg) / 0.0025 > 0 THEN round(1.4387752e4 / 10.9 / ln(1.191042e8 / 10.9 ^ 5 / ((l - 0.9975 * bg) / 0.0025) + 1) - 273.15 + 3.1415926e-8, 3) END AS hotspot FROM radiance""",
)
def planck(i):
    """Radiance and back, and the hot-spot that would explain it."""
    t = F.col("value") / 5
    rad = columns.radiance(t + 273.15)
    return i.table("events").select("event_id", r4(rad).alias("radiance"), r4(columns.kelvin(rad) - 273.15).alias("back"), r4(columns.hotspot_celsius(t, F.lit(20.0), 25.0, 100.0), 3).alias("hotspot"))


@query(
    "f12_binomial",
    """SELECT n, k, round(sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.025) + (n - j) * ln(0.975))) + 3.1415926e-8, 6) AS p
  FROM (SELECT DISTINCT p_size AS n, p_size % 7 AS k FROM part), generate_series(0, 50) g(j) WHERE j >= k AND j <= n GROUP BY n, k""",
)
def binomial(i):
    """Chance of so many hits from noise alone."""
    d = i.table("part").where("p_size % 7 <= p_size").select(F.col("p_size").alias("n"), (F.col("p_size") % 7).alias("k")).distinct()
    return d.select("n", "k", r4(columns.binomial_tail(F.col("n"), F.col("k"), 0.025), 6).alias("p"))


@query(
    "n01_gradient",
    f"""SELECT row, col, {R("CASE WHEN b IS NOT NULL AND a IS NOT NULL THEN (a - b) / 2 WHEN a IS NOT NULL THEN a - dsm WHEN b IS NOT NULL THEN dsm - b END")} AS gx,
  {R("CASE WHEN u IS NOT NULL AND d IS NOT NULL THEN (d - u) / 2 WHEN d IS NOT NULL THEN d - dsm WHEN u IS NOT NULL THEN dsm - u END")} AS gy
  FROM (SELECT p.row, p.col, p.dsm, b.dsm AS b, a.dsm AS a, u.dsm AS u, d.dsm AS d FROM px p LEFT JOIN px b ON b.row = p.row AND b.col = p.col - 1
    LEFT JOIN px a ON a.row = p.row AND a.col = p.col + 1 LEFT JOIN px u ON u.col = p.col AND u.row = p.row - 1 LEFT JOIN px d ON d.col = p.col AND d.row = p.row + 1)""", "px",
)
def gradient(i):
    """Central differences, one-sided at borders."""
    return focal.gradients(i.px, "dsm", 1.0).select("row", "col", r4("gx").alias("gx"), r4("gy").alias("gy"))


@query(
    "p30_slope_shade",
    f"""SELECT row, col, {R('degrees(atan(sqrt(gx * gx + gy * gy)))')} AS slope,
  round(least(greatest(sin(radians(45)) * cos(atan(sqrt(gx * gx + gy * gy))) + cos(radians(45)) * sin(atan(sqrt(gx * gx + gy * gy))) * cos(radians(315) - atan2(-gx, gy)), 0), 1) + 3.1415926e-8, 4) AS shade
  FROM (SELECT p.row, p.col, (a.dsm - b.dsm) / 2 AS gx, (d.dsm - u.dsm) / 2 AS gy FROM px p JOIN px b ON b.row = p.row AND b.col = p.col - 1
    JOIN px a ON a.row = p.row AND a.col = p.col + 1 JOIN px u ON u.col = p.col AND u.row = p.row - 1 JOIN px d ON d.col = p.col AND d.row = p.row + 1)""", "px",
)
def slope_shade(i):
    """Slope and hillshade where all four neighbours are known."""
    four = focal.stencil(i.px, "dsm", {(0, 1): 0.5, (0, -1): -0.5}, "gx")
    four = focal.stencil(four, "dsm", {(1, 0): 0.5, (-1, 0): -0.5}, "gy").where("gx is not null and gy is not null")
    gx, gy = F.col("gx"), F.col("gy")
    return four.select("row", "col", r4(F.degrees(F.atan(F.hypot(gx, gy)))).alias("slope"), r4(columns.hillshade(gx, gy)).alias("shade"))


NEAR = "JOIN px q ON q.row BETWEEN p.row - {0} AND p.row + {0} AND q.col BETWEEN p.col - {0} AND p.col + {0}".format


@query(
    "n02_box", f"SELECT p.row, p.col, {R('avg(q.dsm)')} AS mean, {R('stddev_pop(q.dsm)')} AS std, {R('median(q.dsm)')} AS med, count(*) AS n FROM px p {NEAR(2)} GROUP BY p.row, p.col", "px",
)
def box(i):
    """Mean, spread and median of the known pixels of a 5 x 5 window."""
    out = focal.focal(i.px, focal.offsets("square", 2), "dsm", mean=F.avg, std=F.stddev_pop, med=F.median, n=F.count)
    return out.select("row", "col", *[r4(c).alias(c) for c in ("mean", "std", "med")], "n")


@query(
    "n06_opening",
    """, mask AS (SELECT row, col FROM px WHERE dsm > 22),
  er AS (SELECT p.row, p.col FROM (SELECT m.row + a AS row, m.col + b AS col FROM mask m, (SELECT unnest([-1, 0, 1]) AS a), (SELECT unnest([-1, 0, 1]) AS b)) p GROUP BY 1, 2 HAVING count(*) = 9)
  SELECT DISTINCT e.row + a AS row, e.col + b AS col FROM er e, (SELECT unnest([-1, 0, 1]) AS a), (SELECT unnest([-1, 0, 1]) AS b)""", "px",
)
def opening(i):
    """Binary opening by 3 x 3."""
    return focal.opened(i.px.where("dsm > 22").select("row", "col"), focal.offsets("square", 1))


@query(
    "n07_dilation",
    """, mask AS (SELECT row, col FROM px WHERE dsm > 40)
  SELECT DISTINCT m.row + a AS row, m.col + b AS col FROM mask m, (SELECT unnest([-2, -1, 0, 1, 2]) AS a), (SELECT unnest([-2, -1, 0, 1, 2]) AS b) WHERE abs(a) + abs(b) <= 2""", "px",
)
def dilation(i):
    """Two dilations by a cross."""
    return focal.dilated(i.px.where("dsm > 40").select("row", "col"), focal.offsets("cross", 2))


@query(
    "n12_laplacian",
    f"""SELECT p.row, p.col, CASE WHEN count(*) = 5 THEN {R('sum(CASE WHEN q.row = p.row AND q.col = p.col THEN -4 ELSE 1 END * q.dsm)')} END AS laplacian
  FROM px p JOIN px q ON abs(q.row - p.row) + abs(q.col - p.col) <= 1 GROUP BY p.row, p.col""", "px",
)
def laplacian(i):
    """Second differences where all neighbours are known."""
    return focal.stencil(i.px, "dsm", focal.LAPLACIAN, "x").select("row", "col", r4("x").alias("laplacian"))


@query("n18_circle", f"SELECT p.row, p.col, {R('avg(q.red)')} AS mean, {R('stddev_pop(q.red)')} AS std FROM px p JOIN px q ON (q.row - p.row) ^ 2 + (q.col - p.col) ^ 2 <= 9 GROUP BY p.row, p.col", "px")
def circle(i):
    """Focal mean and spread within a circle."""
    out = focal.focal(i.px, focal.offsets("disc", 3), "red", mean=F.avg, std=F.stddev_pop)
    return out.select("row", "col", r4("mean").alias("mean"), r4("std").alias("std"))


def _full(i):
    return i.px.select("row", "col", "dsm", "red", "green", "blue", "nir")


@query("n02_tile_box")
def tile_box(i):
    """Separable box mean and local deviation on tiles, mirrored at the border."""
    return focal.box(_full(i), "dsm", 5, GRID).select("row", "col", r4("mean").alias("mean"), r4("std").alias("std"))


@query("n04_gaussian")
def gaussian(i):
    """Gaussian blur, cut at four sigmas."""
    return focal.gaussian(_full(i), "dsm", 1.5, GRID).select("row", "col", r4("smooth").alias("smooth"))


@query("n05_relief")
def relief(i):
    return focal.relief(_full(i), "dsm", 8.0, 1.0, GRID).select("row", "col", r4("relief").alias("relief"))


@query("n08_thin_structures")
def thin(i):
    """Heights without what is narrower than a disc."""
    return focal.without_thin(i.lpx, "h", 2.0, 1.0, GRID).select("row", "col", r4("height").alias("height"))


@query("n09_distance")
def distance(i):
    """Distance to the edge of the occupied area."""
    return distance_inside(i.lpx.where("label > 0").select("row", "col"), GRID).select("row", "col", r4("distance").alias("distance"))


@query("n10_derived_ground")
def ground(i):
    """Bare ground from the surface alone."""
    return focal.derived_ground(i.px, GRID, 1.0, 16.0, 4.0).select("row", "col", r4("ground").alias("ground"))


@query("n11_coverage")
def covered(i):
    """Share of coarse pixels' footprints that the piles cover."""
    return focal.coverage(i.lpx.where("label > 0").select("row", "col"), 9.42, 1.0, GRID, 8).select("row", "col", r4("cover").alias("cover"))


@query("n13_median")
def median(i):
    return focal.median5(_full(i), "dsm", GRID).select("row", "col", r4("median").alias("median"))


@query("n17_blended_tiles")
def blended(i):
    """Overlapping tiles, each standardised by its median and quartiles, blended with feathered weights."""
    from ..operators.overlap import blended_tiles

    return blended_tiles(i.px, "dsm", SIDE, SIDE, tile=32, overlap=8).select("row", "col", r4("blend").alias("blend"))


@query("m01_features")
def features(i):
    """Model features from four bands."""
    out = focal.features(_full(i), GRID, 5.0)
    return out.select("row", "col", *[r4(c).alias(c) for c in out.columns[2:]])


@query("r01_block_mean", f"SELECT row // 8 AS row, col // 8 AS col, {R('avg(dsm)')} AS dsm, {R('avg(red)')} AS red FROM px GROUP BY 1, 2", "px")
def block_mean(i):
    """Means of 8 x 8 blocks."""
    return resample.block_mean(i.px, ["dsm", "red"], 8).select("row", "col", r4("dsm").alias("dsm"), r4("red").alias("red"))


FINE, COARSE = sheet(96, 96), sheet(64, 64, 1.5)


@query(
    "r02_bilinear",
    f"""SELECT row, col, CASE WHEN sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END) >= 0.5 THEN {R('sum(coalesce(v, m) * w)')} END AS dsm FROM (
    SELECT t.row, t.col, p.dsm AS v, m, (1 - abs(floor(y) + i - y)) * (1 - abs(floor(x) + j - x)) AS w
    FROM (SELECT r AS row, c AS col, (r + 0.5) * 1.5 - 0.5 AS y, (c + 0.5) * 1.5 - 0.5 AS x FROM range(64) a(r), range(64) b(c)) t, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j),
      (SELECT avg(dsm) AS m FROM px) LEFT JOIN px p ON p.row = least(greatest(floor(y) + i, 0), 95) AND p.col = least(greatest(floor(x) + j, 0), 95)) GROUP BY row, col""", "px",
)
def bilinear(i):
    """1 m pixels at the centres of 1.5 m ones."""
    return resample.to_grid(i.px, "dsm", FINE, COARSE).select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), r4("dsm").alias("dsm"))


@query("r02_cubic")
def cubic(i):
    """Cubic spline to three times as many pixels."""
    return resample.cubic(i.px, "dsm", 3, GRID).select("row", "col", r4("dsm").alias("dsm"))


@query("r07_crs", """SELECT c_custkey, round(radians(c_custkey % 360 - 180) * 6378137 + 3.1415926e-8, 3) AS mx, round(ln(tan(radians(c_custkey % 120 - 60) / 2 + atan(1))) * 6378137 + 3.1415926e-8, 3) AS my FROM customer""")
def mercator(i):
    """Degrees to web Mercator."""
    x, y = geo.to_mercator(F.col("c_custkey") % 360 - 180, F.col("c_custkey") % 120 - 60)
    return i.table("customer").select("c_custkey", r4(x, 3).alias("mx"), r4(y, 3).alias("my"))


@query("r07_utm")
def utm(i):
    """Degrees to UTM and back."""
    lon, lat = 6 + (F.col("c_custkey") % 60) / 10, 45 + (F.col("c_custkey") % 70) / 10
    x, y = geo.to_utm(lon, lat)
    back = geo.from_utm(F.col("x"), F.col("y"))
    d = i.table("customer").select("c_custkey", lon.alias("lon"), lat.alias("lat"), x.alias("x"), y.alias("y"))
    return d.select("c_custkey", r4("x", 3).alias("x"), r4("y", 3).alias("y"), (F.abs(back[0] - F.col("lon")) < 1e-8).alias("lon_ok"), (F.abs(back[1] - F.col("lat")) < 1e-8).alias("lat_ok"))


@query("r09_decimated", "SELECT row, col, dsm FROM px WHERE row % 4 = 0 AND col % 4 = 0", "px")
def decimated(i):
    return resample.decimated(i.px, 4).select("row", "col", "dsm")


assert tiles.TILE >= SIDE
