"""Thermal screening on scene tables, and its arithmetic variants."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import modelling, thermal
from ..sources import catalog
from . import query
from .inputs import r4

N = "3.1415926e-8"
R = ("(round({} + " + N + ", 4) + 0.0)").format


def _rows(i):
    """A contrast per object and day: its warmest cover against the other tenth of objects that day."""
    o = i.obs
    obs = o.select(F.col("date").alias("scene_id"), "label", F.col("event_id").alias("row"), F.lit(0).alias("col"), "lst", "cover")
    background = o.select(F.col("date").alias("scene_id"), (F.col("label") % 10).alias("ring"), "lst")
    rings = o.select(F.col("date").alias("scene_id"), "label").distinct().withColumn("ring", (F.col("label") + 1) % 10)
    night = o.groupBy(F.col("date").alias("scene_id"), "label").agg(F.max("night").alias("night"))
    rows = thermal.contrasts(obs, background, rings=rings)
    rows = rows.join(night, ["scene_id", "label"]).withColumn("native_m", F.lit(100.0)).withColumn("date", F.col("scene_id"))
    return thermal.flagged(rows)


ROWS = """, day AS (SELECT DISTINCT date, label FROM obs),
bg AS (SELECT d.date, d.label, o.lst FROM day d JOIN obs o ON o.date = d.date AND o.label % 10 = (d.label + 1) % 10),
mid AS (SELECT date, label, median(lst) AS t_background, count(*) AS n_background FROM bg GROUP BY 1, 2),
mad AS (SELECT b.date, b.label, 1.4826 * median(abs(b.lst - t_background)) AS sigma FROM bg b JOIN mid USING (date, label) GROUP BY 1, 2),
best AS (SELECT date, label, lst AS t_object, cover FROM (SELECT *, row_number() OVER (PARTITION BY date, label ORDER BY cover + 1e-3 * lst DESC, event_id) AS n FROM obs WHERE cover > 0) WHERE n = 1),
night AS (SELECT date, label, bool_or(night) AS night FROM obs GROUP BY 1, 2),
raw AS (SELECT *, t_object - t_background AS dt, CASE WHEN sigma > 0 THEN (t_object - t_background) / sigma END AS z, CASE WHEN cover > 0.05 THEN (t_object - t_background) / cover END AS dt_surface
  FROM best JOIN mid USING (date, label) JOIN mad USING (date, label) JOIN night USING (date, label) WHERE n_background >= 3),
rows AS (SELECT *, coalesce(dt > 1 AND z > 2, false) AS anomalous FROM raw)"""


@query("a09_contrasts", ROWS + f" SELECT date::VARCHAR AS date, label, {R('dt')} AS dt, {R('z')} AS z, {R('dt_surface')} AS dt_surface, n_background, anomalous FROM rows", "obs")
def contrasts(i):
    """Per scene: the best-covered pixel against a robust background."""
    return _rows(i).select(F.col("date").cast("string").alias("date"), "label", r4("dt").alias("dt"), r4("z").alias("z"), r4("dt_surface").alias("dt_surface"), "n_background", "anomalous")


SUMMARY = """, s AS (SELECT label, count(*) AS n, avg(dt) AS mean_dt, max(dt) AS max_dt, max(z) AS max_z, avg(anomalous::INT) AS persistence, count(*) FILTER (anomalous) AS hits,
  count(*) FILTER (night) AS n_night, count(*) FILTER (anomalous AND night) AS night_hits, avg(anomalous::INT) FILTER (NOT night) AS day_persistence, median(dt_surface) AS surface,
  CASE WHEN count(dt) >= 4 AND max(date) > min(date) THEN regr_slope(dt, datediff('day', DATE '2024-01-01', date) / 30.44) END AS trend FROM rows GROUP BY label),
tail AS (SELECT label, sum(CASE WHEN j >= hits AND j <= n THEN exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.025) + (n - j) * ln(0.975)) ELSE 0 END) AS p,
  CASE WHEN any_value(n_night) > 0 THEN sum(CASE WHEN j >= night_hits AND j <= n_night THEN exp(lgamma(n_night + 1) - lgamma(j + 1) - lgamma(n_night - j + 1) + j * ln(0.025) + (n_night - j) * ln(0.975)) ELSE 0 END) ELSE 1 END AS p_night
  FROM s, generate_series(0, 40) g(j) WHERE j <= n GROUP BY label)"""


@query(
    "a10_summary",
    ROWS + SUMMARY + f""" SELECT label, n AS n_scenes, {R('mean_dt')} AS mean_dt, {R('max_dt')} AS max_dt, {R('max_z')} AS max_z, {R('persistence')} AS persistence, hits AS n_anomalous, n_night, night_hits AS n_night_anomalous,
  {R('day_persistence')} AS day_persistence, {R('surface')} AS dt_surface_median, {R('trend')} AS trend, round(p + {N}, 6) AS p_value, persistence >= 0.5 AND hits >= 2 AS persistent, p < 0.01 AS significant FROM s JOIN tail USING (label)""", "obs",
)
def summary(i):
    """Persistence, trend and chance of each object."""
    s = thermal.summary(_rows(i))
    digits = ("mean_dt", "max_dt", "max_z", "persistence", "day_persistence", "dt_surface_median", "trend")
    return s.select("label", "n_scenes", "n_anomalous", "n_night", "n_night_anomalous", *[r4(c).alias(c) for c in digits], r4("p_value", 6).alias("p_value"), "persistent", "significant")


@query(
    "p20_alerts",
    ROWS + SUMMARY + """ SELECT label, CASE WHEN swir >= 2 THEN 'critical' WHEN (night_hits >= 2 AND p_night < 0.01) OR (night_hits >= 1 AND swir >= 1) OR (persistence >= 0.5 AND hits >= 2 AND p < 0.01) THEN 'warning'
    WHEN swir = 1 OR night_hits >= 1 OR p < 0.01 THEN 'watch' ELSE 'none' END AS alert FROM (SELECT *, CASE WHEN label % 11 = 0 THEN 2 WHEN label % 7 = 0 THEN 1 ELSE 0 END AS swir FROM s JOIN tail USING (label))""", "obs",
)
def alerts(i):
    """Alert ladder over persistence, night and combustion."""
    swir = F.when(F.col("label") % 11 == 0, 2).when(F.col("label") % 7 == 0, 1).otherwise(0)
    return thermal.alerts(thermal.summary(_rows(i)).withColumn("swir", swir)).select("label", "alert")


@query("a21_alert_counts", ROWS + SUMMARY + " SELECT CASE WHEN p < 0.01 THEN 'watch' ELSE 'none' END AS level, count(*) AS n, count(*) FILTER (n_night > 0) AS with_night FROM s JOIN tail USING (label) GROUP BY 1", "obs")
def alert_counts(i):
    """Conditional counts by level."""
    s = thermal.summary(_rows(i))
    level = F.when(F.col("significant"), "watch").otherwise("none")
    return s.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.count_if(F.col("n_night") > 0).alias("with_night"))


@query(
    "a11_trend",
    f"SELECT label, CASE WHEN count(*) >= 4 AND max(date) > min(date) THEN {R('''regr_slope(lst, datediff('day', DATE '2024-01-01', date) / 30.44)''')} END AS trend FROM obs GROUP BY label", "obs",
)
def trend(i):
    """Slope per month."""
    return i.obs.groupBy("label").agg(r4(thermal.trend("date", "lst"), 4).alias("trend"))


@query("a12_composite", f"SELECT label % 8 AS row, event_id % 8 AS col, {R('median(lst)')} AS lst FROM obs WHERE NOT night GROUP BY 1, 2", "obs")
def composite(i):
    """Median of the day scenes."""
    px = i.obs.select((F.col("label") % 8).alias("row"), (F.col("event_id") % 8).alias("col"), "night", "lst")
    return thermal.composite(px).select("row", "col", r4("lst").alias("lst"))


SWIR = """, nh AS (SELECT *, (b12 - b11) / (b12 + b11 + 1e-6) AS nhi FROM swir), med AS (SELECT *, median(nhi) OVER (PARTITION BY row, col) AS nm, median(b12) OVER (PARTITION BY row, col) AS bm FROM nh),
hot AS (SELECT *, coalesce(nhi > 0 AND nhi - nm > 0.1 AND b12 > 1.3 * bm AND b12 > 0.02, false) AS hot FROM med),
hits AS (SELECT label, date, hot_px, max_nhi FROM (SELECT label, scene_id, date, count(*) FILTER (hot) AS hot_px, max(nhi) AS max_nhi, row_number() OVER (PARTITION BY label, date ORDER BY scene_id) AS n
  FROM hot GROUP BY label, scene_id, date HAVING count(*) FILTER (hot) > 0) WHERE n = 1)"""


@query("a13_swir_hits", SWIR + f" SELECT label, date::VARCHAR AS date, hot_px, {R('max_nhi')} AS max_nhi FROM hits", "swir")
def swir_hits(i):
    """Combustion hits by object and date, the first scene's."""
    return thermal.swir_hits(i.swir).select("label", F.col("date").cast("string").alias("date"), "hot_px", r4("max_nhi").alias("max_nhi"))


@query("a31_pooled_dates", SWIR + " SELECT label, array_to_string(list_sort(list(DISTINCT date::VARCHAR)), ',') AS dates FROM (SELECT label, date FROM hits UNION ALL SELECT label % 16 + 1, date FROM hits) GROUP BY label", "swir")
def pooled(i):
    """Dates shared with the next object, counted once."""
    hits = thermal.swir_hits(i.swir).select("label", F.col("date").cast("string").alias("date"))
    near = hits.select("label").distinct().withColumn("other", (F.col("label") % 16 + 1).cast("int"))
    return thermal.pooled(hits, near).select("label", F.array_join("swir_dates", ",").alias("dates"))


@query("a32_hot_frequency", SWIR + f" SELECT row, col, {R('avg(hot::INT)')} AS frequency FROM hot GROUP BY row, col", "swir")
def hot_frequency(i):
    """How often each pixel is hot."""
    own = Window.partitionBy("row", "col")
    nhi = (F.col("b12") - F.col("b11")) / (F.col("b12") + F.col("b11") + 1e-6)
    px = i.swir.withColumn("nhi", nhi).withColumns({"nm": F.median("nhi").over(own), "bm": F.median("b12").over(own)})
    from ..functions.classes import swir_hot

    px = px.withColumn("hot", swir_hot(F.col("nhi"), F.col("nm"), F.col("b12"), F.col("bm")))
    return thermal.hot_frequency(px).select("row", "col", r4("frequency").alias("frequency"))


@query("a24_hottest", f"SELECT label, {R('m')} AS lst, m >= quantile_cont(m, 0.9) OVER () AS hottest FROM (SELECT label, max(lst) AS m FROM obs WHERE NOT night GROUP BY label)", "obs")
def hottest(i):
    """The hottest tenth."""
    o = i.obs.where("not night").groupBy("label").agg(F.max("lst").alias("lst"))
    return thermal.hottest(o, "lst").select("label", r4("lst").alias("lst"), "hottest")


@query(
    "s12_day_and_night",
    "SELECT event_id, night FROM (SELECT *, row_number() OVER (PARTITION BY night ORDER BY ts, event_id) AS n FROM (SELECT event_id, ts, (hour(ts) + 1) % 24 < 6 OR (hour(ts) + 1) % 24 >= 20 AS night FROM events WHERE hour(ts) BETWEEN 7 AND 17 OR hour(ts) >= 19 OR hour(ts) <= 4)) WHERE n <= 12",
)
def day_and_night(i):
    """First scenes by day and by night, half each."""
    h = F.hour("ts")
    local = (h + 1) % 24
    e = i.table("events").where(h.between(7, 17) | (h >= 19) | (h <= 4)).withColumn("night", (local < 6) | (local >= 20))
    n = F.row_number().over(Window.partitionBy("night").orderBy("ts", "event_id"))
    return e.withColumn("n", n).where("n <= 12").select("event_id", "night")


@query(
    "s12_station_passes",
    f"""WITH px AS (SELECT date_trunc('hour', ts) AS scene_ts, ts, (user_id % 64)::INT AS row, (event_id % 64)::INT AS col, value + 273.15 AS kelvin, (event_id * 7) % 65536 AS qc, ((event_id // 3) % 5 = 0)::INT AS cloud FROM events),
g AS (SELECT *, coalesce(qc % 4 <= 1 AND cloud = 0 AND kelvin IS NOT NULL, false) AS good FROM px),
s AS (SELECT scene_ts, min(ts) AS ts, avg(good::INT) AS clear FROM g GROUP BY scene_ts HAVING avg(good::INT) > 0.3),
k AS (SELECT *, row_number() OVER (PARTITION BY hour(ts) BETWEEN 7 AND 17 ORDER BY ts, scene_ts) AS n FROM s WHERE hour(ts) BETWEEN 7 AND 17 OR hour(ts) >= 19 OR hour(ts) <= 4)
SELECT strftime(k.scene_ts, '%Y-%m-%d %H') AS scene, ((hour(k.ts) + 1) % 24 < 6 OR (hour(k.ts) + 1) % 24 >= 20) AS night, row, col, {R('k.clear')} AS clear, {R('kelvin - 273.15')} AS lst
FROM g JOIN k USING (scene_ts) WHERE good AND n <= 40""",
)
def station_passes(i):
    """Night and day passes in degrees C, graded by two bits of a quality word: an hour of events is a scene."""
    e = i.table("events")
    px = e.select(
        F.date_trunc("hour", "ts").alias("scene_id"), "ts", (F.col("user_id") % 64).cast("int").alias("row"), (F.col("event_id") % 64).cast("int").alias("col"),
        (F.col("value") + 273.15).alias("kelvin"), (F.col("event_id") * 7 % 65536).alias("qc"), (F.floor(F.col("event_id") / 3) % 5 == 0).cast("int").alias("cloud"),
    )
    out = catalog.station_passes(px, 80, 0.3)
    return out.select(F.date_format("scene_id", "yyyy-MM-dd HH").alias("scene"), "night", "row", "col", r4("clear").alias("clear"), r4("lst").alias("lst"))


@query("s14_clear_scenes", f"SELECT date::VARCHAR AS date, {R('avg((lst > 30)::INT)')} AS clear FROM obs GROUP BY date HAVING avg((lst > 30)::INT) > 0.6 ORDER BY date LIMIT 20", "obs")
def clear_scenes(i):
    """The first scenes that are mostly clear."""
    s = i.obs.groupBy("date").agg(F.avg((F.col("lst") > 30).cast("double")).alias("clear")).where("clear > 0.6")
    return s.orderBy("date").limit(20).select(F.col("date").cast("string").alias("date"), r4("clear").alias("clear"))


@query("s15_one_per_date", "SELECT date::VARCHAR AS date, event_id FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY lst DESC, event_id) AS n FROM obs WHERE lst >= 98) WHERE n = 1", "obs")
def one_per_date(i):
    """The clearest scene of each date, the first of equals."""
    n = F.row_number().over(Window.partitionBy("date").orderBy(F.desc("lst"), "event_id"))
    return i.obs.where("lst >= 98").withColumn("n", n).where("n = 1").select(F.col("date").cast("string").alias("date"), "event_id")


@query("u01_union", "SELECT event_id, date::VARCHAR AS date, 'night' AS part FROM obs WHERE night UNION ALL SELECT event_id, date::VARCHAR, 'day' FROM obs WHERE NOT night", "obs")
def union(i):
    """Scene lists put together."""
    part = lambda c, k: i.obs.where(c).select("event_id", F.col("date").cast("string").alias("date"), F.lit(k).alias("part"))
    return part("night", "night").unionByName(part("not night", "day"))


@query("g03_hashed_folds", "SELECT row, col, abs((floor(col * 10 / 150) * 7 + floor(row * 10 / 150) * 13) % 5)::INT AS fold FROM px", "px")
def hashed_folds(i):
    """Folds of ground blocks by arithmetic."""
    return i.px.select("row", "col", modelling.hashed_fold(F.col("col") * 10.0, F.col("row") * 10.0).alias("fold"))


@query(
    "g07_max_contrast",
    f"""SELECT label, date::VARCHAR AS date, {R('(mx - m) / greatest(s, 0.1)')} AS z FROM (SELECT label, date, max(lst) AS mx FROM obs GROUP BY 1, 2) JOIN (SELECT date, median(lst) AS m, stddev_samp(lst) AS s FROM obs GROUP BY date) USING (date)""", "obs",
)
def max_contrast(i):
    """The plainer contrast: maximum against the scene's median and deviation."""
    top = i.obs.groupBy("label", "date").agg(F.max("lst").alias("mx"))
    scene = i.obs.groupBy("date").agg(F.median("lst").alias("m"), F.stddev_samp("lst").alias("s"))
    z = (F.col("mx") - F.col("m")) / F.greatest("s", F.lit(0.1))
    return top.join(scene, "date").select("label", F.col("date").cast("string").alias("date"), r4(z).alias("z"))


@query("g08_plain_swir", "SELECT label, count(*) FILTER ((b12 - b11) / (b12 + b11 + 1e-6) > 0) AS hits, list_sort(list(lst))[count(*) // 2 + 1] AS upper_median FROM (SELECT *, b11 AS lst FROM swir) GROUP BY label", "swir")
def plain_swir(i):
    """Sign test of the index, and the upper median of even counts."""
    nhi = (F.col("b12") - F.col("b11")) / (F.col("b12") + F.col("b11") + 1e-6)
    ordered = F.array_sort(F.collect_list("b11"))
    return i.swir.groupBy("label").agg(F.count_if(nhi > 0).alias("hits"), F.element_at(ordered, F.floor(F.count("*") / 2).cast("int") + 1).alias("upper_median"))
