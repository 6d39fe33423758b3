"""Corrections, error measures, robust lines, folds and trees."""

from pyspark.sql import functions as F

from ..operators import modelling, validation
from ..operators.grid import sheet
from . import query
from .inputs import r4

N = "3.1415926e-8"
R = ("(round({} + " + N + ", 4) + 0.0)").format


@query(
    "a14_ratio_correction",
    f"""SELECT pile_id, {R('pred * (ta - fa) / (tp - fp)')} AS corrected FROM (SELECT *, sum(actual) OVER (PARTITION BY fold) AS fa, sum(pred) OVER (PARTITION BY fold) AS fp, sum(actual) OVER () AS ta, sum(pred) OVER () AS tp FROM piles)""", "piles",
)
def ratio(i):
    """Each pile scaled by the other folds' ratio of sums."""
    return validation.ratio_corrected(i.piles).select("pile_id", r4("corrected").alias("corrected"))


@query(
    "m15_power_correction",
    f"""SELECT pile_id, {R('e')} AS exponent, round(k * exp(c) * pred ^ e + {N}, 2) AS corrected FROM piles JOIN (
  SELECT f AS fold, e, c, sum(actual) / sum(exp(c) * pred ^ e) AS k FROM piles p JOIN (
    SELECT f, least(greatest(b, 0.5), 2.5) AS e, my - b * mx AS c FROM (SELECT f, regr_slope(ln(actual), ln(pred)) AS b, avg(ln(actual)) AS my, avg(ln(pred)) AS mx FROM (SELECT DISTINCT fold AS f FROM piles) JOIN piles ON fold <> f GROUP BY f)) q ON p.fold <> q.f GROUP BY f, e, c) USING (fold)""", "piles",
)
def power(i):
    """Power law in logs on the other folds, sums matched."""
    out = validation.power_corrected(i.piles)
    return out.select("pile_id", r4("exponent").alias("exponent"), r4("corrected", 2).alias("corrected"))


@query(
    "m15_quadratic_correction",
    f"""SELECT pile_id, round(CASE WHEN a <= 0 OR a + 2 * b * top * 1.5 <= 0 THEN pred * sy / sx ELSE sy / (a * sx + b * x2) * (a * pred + b * pred * pred) END + {N}, 2) AS corrected FROM piles JOIN (
  SELECT f AS fold, top, sx, sy, x2, (xy * x4 - x2y * x3) / (x2 * x4 - x3 * x3) AS a, (x2 * x2y - x3 * xy) / (x2 * x4 - x3 * x3) AS b FROM (
    SELECT f, max(pred) AS top, sum(pred) AS sx, sum(actual) AS sy, sum(pred ^ 2) AS x2, sum(pred ^ 3) AS x3, sum(pred ^ 4) AS x4, sum(pred * actual) AS xy, sum(pred ^ 2 * actual) AS x2y
    FROM (SELECT DISTINCT fold AS f FROM piles) JOIN piles ON fold <> f GROUP BY f)) USING (fold)""", "piles",
)
def quadratic(i):
    """Curve through the origin on the other folds, sums matched."""
    return validation.quadratic_corrected(i.piles).select("pile_id", r4("corrected", 2).alias("corrected"))


@query(
    "j12_leave_one_out",
    f"""SELECT pile_id, round((s - actual / pred) / (n - 1) + {N}, 6) AS ratio FROM piles, (SELECT sum(actual / pred) AS s, count(actual / pred) AS n FROM piles)""", "piles",
)
def leave_one_out(i):
    """Mean ratio of all other piles: the sum less one's own."""
    return validation.mean_of_others(i.piles, F.col("actual") / F.col("pred")).select("pile_id", r4("others", 6).alias("ratio"))


@query(
    "a15_metrics",
    f"""SELECT fold, count(*) AS n, {R('sqrt(avg((pred - actual) ^ 2))')} AS rmse, {R('avg(abs(pred - actual))')} AS mae, {R('avg(pred - actual)')} AS bias, {R('100 * sum(pred - actual) / sum(actual)')} AS bias_pct,
  {R('100 * sum(abs(pred - actual)) / sum(abs(actual))')} AS wape_pct, {R('1 - sum((pred - actual) ^ 2) / (var_pop(actual) * count(*))')} AS r2 FROM piles GROUP BY fold""", "piles",
)
def metrics(i):
    """Errors of predicted volumes by fold."""
    m = validation.metrics(i.piles, by=["fold"])
    return m.select("fold", "n", *[r4(c).alias(c) for c in ("rmse", "mae", "bias", "bias_pct", "wape_pct", "r2")])


@query(
    "m16_recent",
    f"""SELECT pile_id, {R('CASE WHEN v_ref > 1 THEN v_now / v_ref END')} AS change, {R('CASE WHEN uav IS NOT NULL AND v_ref > 1 THEN uav * v_now / v_ref ELSE 1.1 * v_now END')} AS estimate FROM (
  SELECT pile_id, CASE WHEN pile_id % 5 <> 0 THEN volume END AS uav, (pile_id % 9) * 1.0 AS v_ref, (pile_id % 7) * 2.0 AS v_now FROM stock)""", "stock",
)
def recent(i):
    """Surveyed volumes moved by the model's change."""
    k = F.col("pile_id")
    p = i.stock.select(k, F.when(k % 5 != 0, F.col("volume")).alias("uav"), (k % 9).cast("double").alias("v_ref"), (k % 7 * 2.0).alias("v_now"))
    return validation.recent(p, 1.1).select("pile_id", r4("change").alias("change"), r4("estimate").alias("estimate"))


@query(
    "m12_match", f"SELECT {R('regr_slope(green, blue)')} AS gain, {R('regr_intercept(green, blue)')} AS \"offset\", regr_count(green, blue)::BIGINT AS n FROM px", "px",
)
def match(i):
    """Gain and offset between two scenes."""
    return modelling.matched(i.px, "blue", "green").select(r4("gain").alias("gain"), r4("offset").alias("offset"), "n")


@query(
    "m06_affine",
    f"""SELECT {R('regr_slope(green, blue)')} AS a, {R('regr_intercept(green, blue)')} AS b, count(*) AS n FROM (SELECT *, stddev_pop(r) OVER () AS s FROM (
  SELECT green, blue, green - a * blue - b AS r FROM px, (SELECT regr_slope(green, blue) AS a, regr_intercept(green, blue) AS b FROM px))) WHERE abs(r) < 2.5 * s""", "px",
)
def affine(i):
    """Robust line, trimmed once."""
    return modelling.line(i.px, "blue", "green").select(r4("a").alias("a"), r4("b").alias("b"), "n")


@query(
    "m13_normalised",
    f""", wide AS (SELECT blue, green, red, 1.1 * blue + 0.01 * (row % 3) AS nb, 0.9 * green + 0.02 * (col % 2) AS ng, red * 1.05 AS nr FROM lpx WHERE label = 0),
  long AS (SELECT 'blue' AS band, nb AS x, blue AS y FROM wide UNION ALL SELECT 'green', ng, green FROM wide),
  f AS (SELECT band, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM long GROUP BY band),
  r AS (SELECT band, x, y, y - a * x - b AS r, stddev_pop(y - a * x - b) OVER (PARTITION BY band) AS s FROM long JOIN f USING (band))
  SELECT band, {R('regr_slope(y, x)')} AS gain, {R('regr_intercept(y, x)')} AS "offset", count(*) AS n, {R('regr_r2(y, x)')} AS r2 FROM r WHERE abs(r) < 2 * s GROUP BY band""", "lpx",
)
def normalised(i):
    """A new scene's bands brought to the reference's over the background."""
    px = i.lpx.select("blue", "green", (1.1 * F.col("blue") + 0.01 * (F.col("row") % 3)).alias("new_blue"), (0.9 * F.col("green") + 0.02 * (F.col("col") % 2)).alias("new_green"), (F.col("label") == 0).alias("use"))
    return modelling.normalised(px, ["blue", "green"]).select("band", r4("gain").alias("gain"), r4("offset").alias("offset"), "n", r4("r2").alias("r2"))


@query(
    "m21_nearest_centroid",
    """, c AS (SELECT label AS commodity, avg(blue) AS b, avg(green) AS g, avg(red) AS r, avg(nir) AS n FROM colours WHERE vec_id % 3 = 0 GROUP BY label)
  SELECT vec_id, commodity FROM (SELECT vec_id, c.commodity, row_number() OVER (PARTITION BY vec_id ORDER BY (blue - b) ^ 2 + (green - g) ^ 2 + (red - r) ^ 2 + (nir - n) ^ 2, c.commodity) AS k FROM colours, c WHERE vec_id % 3 <> 0) WHERE k = 1""", "colours",
)
def nearest_centroid(i):
    """Materials by the nearest mean colour of the labelled third."""
    c = i.colours
    learn = c.where("vec_id % 3 = 0").withColumnRenamed("label", "commodity")
    return modelling.nearest_centroid(c.where("vec_id % 3 <> 0"), learn, ["blue", "green", "red", "nir"]).select("vec_id", "commodity")


@query("a30_centroids", f"SELECT label, {R('avg(blue)')} AS blue, {R('avg(green)')} AS green, {R('avg(red)')} AS red, {R('avg(nir)')} AS nir FROM colours GROUP BY label", "colours")
def centroids(i):
    """Mean colour of each material."""
    return i.colours.groupBy("label").agg(*[r4(F.avg(b)).alias(b) for b in ("blue", "green", "red", "nir")])


@query("m02_spatial_folds")
def folds(i):
    """Ground blocks dealt to folds by a seeded permutation."""
    return modelling.spatial_folds(i.px.select("row", "col"), sheet(96, 96, 10.0))


@query("m03_balanced_sample")
def sample(i):
    """As many high as low pixels, by hash."""
    return modelling.balanced(i.lpx, F.col("h") > 10, 200, ["row", "col"]).select("row", "col", r4("h").alias("h"))


def _modelled(i):
    return modelling.spatial_folds(i.lpx.where("h is not null"), sheet(96, 96, 10.0))


@query("m04_out_of_fold")
def out_of_fold(i):
    """Heights from bands by boosted trees, every fold predicted by the others."""
    out = modelling.out_of_fold(_modelled(i), ["blue", "green", "red", "nir"], "h", 5, rounds=5)
    return validation.metrics(out, "h", "pred", by=["fold"]).select("fold", "n", r4("rmse", 3).alias("rmse"))


@query("m04_random_forest")
def random_forest(i):
    out = modelling.out_of_fold(_modelled(i), ["blue", "green", "red", "nir"], "h", 5, kind="rf", rounds=10)
    return validation.metrics(out, "h", "pred", by=["fold"]).select("fold", "n", r4("rmse", 3).alias("rmse"))


@query("m20_downscaled")
def downscaled(i):
    """Fine temperatures from bands, coarse means kept."""
    coarse = i.px.groupBy(F.floor(F.col("row") / 4).cast("int").alias("row"), F.floor(F.col("col") / 4).cast("int").alias("col")).agg(F.avg("dsm").alias("lst"))
    return modelling.downscaled(coarse, i.px, ["blue", "green", "red"], 4).select("row", "col", r4("lst").alias("lst"))
