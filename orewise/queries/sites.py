"""Places, scans, jobs and exports of a site, on the shared tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import modelling, resample, vector
from ..operators.grid import Lattice, around, sheet
from ..operators.validation import iou
from ..sources import catalog, jobs
from ..sources.tables import numbered, shared_dir, written
from . import query
from .inputs import r4

N = "3.1415926e-8"
R = ("(round({} + " + N + ", 4) + 0.0)").format
POINTS = "(SELECT c_custkey * 1.25 AS x, c_acctbal / 10 AS y FROM customer)"


def _points(i):
    return i.table("customer").select((F.col("c_custkey") * 1.25).alias("x"), (F.col("c_acctbal") / 10).alias("y"))


def _described(i, g: Lattice):
    rows = [(*map(float, g.extent), g.rows, g.cols, float(g.cell_area))]
    return i.spark.createDataFrame(rows, "west double, south double, east double, north double, n_rows int, n_cols int, cell_area double")


def _lattice_sql(margin: int, step: int) -> str:
    return f"""SELECT *, ((north - south) / {step})::INT AS n_rows, ((east - west) / {step})::INT AS n_cols, {step * step}::DOUBLE AS cell_area FROM (
  SELECT 30 * floor((min(x) - {margin}) / 30)::DOUBLE AS west, 30 * floor((min(y) - {margin}) / 30)::DOUBLE AS south, 30 * ceil((max(x) + {margin}) / 30)::DOUBLE AS east, 30 * ceil((max(y) + {margin}) / 30)::DOUBLE AS north FROM {POINTS})"""


@query("s03_extent", _lattice_sql(0, 10))
def extent(i):
    """The nested lattice around a site's points."""
    return _described(i, around(_points(i), 10.0))


@query("r08_port_extent", _lattice_sql(45, 3))
def port_extent(i):
    """The same with a margin, in finer cells."""
    return _described(i, around(_points(i), 3.0, 45.0))


@query("r04_cells", "SELECT c_custkey, floor((c_acctbal / 10 + 100) / 7.5)::INT AS from_south, floor(c_custkey * 1.25 / 7.5)::INT AS col FROM customer")
def cells(i):
    """The cell of each point, its row counted from the south."""
    g = Lattice(sheet(1, 1).extent._replace(south=-100.0, north=2000.0, east=300000.0), 7.5)
    row, col = g.cell(F.col("c_custkey") * 1.25, F.lit(2000.0) - (F.col("c_acctbal") / 10 + 100))
    return i.table("customer").select("c_custkey", row.alias("from_south"), col.alias("col"))


@query("j18_window_offset", "SELECT row - 24 AS row, col - 16 AS col, (row - 24) // 8 AS trow, (col - 16) // 8 AS tcol, dsm FROM px WHERE row BETWEEN 24 AND 71 AND col BETWEEN 16 AND 79", "px")
def window_offset(i):
    """Pixels of a window in its own numbers, with the coarse pixel that each lies in."""
    whole = sheet(96, 96)
    down, right = whole.part((24, 16), (72, 80)).place_in(whole)
    row, col = F.col("row") - down, F.col("col") - right
    coarse = [F.floor(c / 8).cast("long") for c in (row, col)]
    return i.px.where("row between 24 and 71 and col between 16 and 79").select(row.alias("row"), col.alias("col"), coarse[0].alias("trow"), coarse[1].alias("tcol"), "dsm")


@query("s05_block_ids", "SELECT row, col, CASE WHEN row < 40 AND col BETWEEN 10 AND 59 THEN 3 WHEN row BETWEEN 30 AND 79 AND col < 50 THEN 2 ELSE 1 END AS block FROM px WHERE row >= 20 OR (row < 40 AND col BETWEEN 10 AND 59)", "px")
def block_ids(i):
    """The survey block of each pixel: footprints in order, later ones on top."""
    box = '{{"type":"Polygon","coordinates":[[[{0},{1}],[{2},{1}],[{2},{3}],[{0},{3}],[{0},{1}]]]}}'.format
    shapes = [(1, box(0, 0, 96, 76)), (2, box(0, 16, 50, 66)), (3, box(10, 56, 60, 96))]
    blocks = vector.rasterized(vector.edges(vector.polygons(i.spark.createDataFrame(shapes, "feature_id int, geom_json string"))), sheet(96, 96))
    return i.px.select("row", "col").join(blocks, ["row", "col"]).select("row", "col", F.col("label").alias("block"))


@query("s20_parts", "SELECT p_partkey AS feature_id, part, 4.0 AS area FROM part, (SELECT unnest([0, 1]) AS part) WHERE part = 0 OR p_partkey % 3 = 0")
def parts(i):
    """Features from GeoJSON, MultiPolygons taken apart, with each part's area."""
    ring = lambda d: F.format_string("[[[%d,0],[%d,0],[%d,2],[%d,2],[%d,0]]]", *[(F.col("p_partkey") + k) for k in (d, d + 2, d + 2, d, d)])
    one = F.concat(F.lit('{"type":"Polygon","coordinates":'), ring(0), F.lit("}"))
    two = F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), ring(0), F.lit(","), ring(9), F.lit("]}"))
    polys = vector.polygons(i.table("part").select(F.col("p_partkey").alias("feature_id"), F.when(F.col("p_partkey") % 3 == 0, two).otherwise(one).alias("geom_json")))
    p = F.transform(F.sequence(F.lit(1), F.size(F.col("rings")[0]) - 1), lambda k: F.struct(F.element_at(F.col("rings")[0], k).alias("p"), F.element_at(F.col("rings")[0], k + 1).alias("q")))
    area = F.abs(F.aggregate(p, F.lit(0.0), lambda a, e: a + e.p[0] * e.q[1] - e.q[0] * e.p[1])) / 2
    return polys.select("feature_id", "part", area.alias("area"))


@query("s08_first_source", "SELECT row, col, red AS blue FROM px", "px")
def first_source(i):
    """A site without its best imagery: the next source, its bands by their own names."""
    path = f"{shared_dir(i.spark)}/orewise/sites/spot-{uuid.uuid4().hex}"
    i.px.write.mode("overwrite").parquet(path)
    site = catalog.Site(i.spark, {"spot": path})
    assert site.read("pleiades") is None
    return site.optical("spot", {"blue": "red"}) if site.first("pleiades", "spot").columns else None


@query("s09_nearest_scene", "SELECT o_orderkey AS scene_id, abs(datediff('day', o_orderdate::DATE, DATE '1995-06-17')) AS apart FROM orders WHERE o_orderkey % 37 < 20 AND abs(datediff('day', o_orderdate::DATE, DATE '1995-06-17')) <= 400 ORDER BY apart, o_orderkey % 37, o_orderkey LIMIT 1")
def nearest_scene(i):
    """The clear scene nearest to a date."""
    scenes = i.table("orders").select(F.col("o_orderkey").alias("scene_id"), F.to_date("o_orderdate").alias("date"), (F.col("o_orderkey") % 37).alias("cloud"))
    return catalog.best_scene(scenes, "1995-06-17", 400).select("scene_id", F.col("apart").cast("long").alias("apart"))


@query("s10_reflectances", f"SELECT event_id, {R('value * 10 / 10000')} AS b11 FROM events WHERE event_id % 12 NOT IN (3, 8, 9, 10, 11)")
def reflectances(i):
    """Masked, scaled bands of a scene."""
    e = i.table("events").select("event_id", (F.col("event_id") % 12).alias("scl"), (F.col("value") * 10).alias("b11"))
    return catalog.sentinel(e).select("event_id", r4("b11").alias("b11"))


@query(
    "s11_surface_temperatures",
    f"""WITH scenes AS (SELECT event_id, dayofyear(ts) * 2 + event_id % 2 AS scene_id, ts::DATE AS date, 40000 + user_id % 5000 AS st, event_id % 7 AS qa FROM events),
few AS (SELECT DISTINCT date, scene_id FROM scenes ORDER BY date, scene_id LIMIT 24)
SELECT event_id, scene_id, {R('st * 0.00341802 + 149.0 - 273.15')} AS lst FROM scenes JOIN few USING (date, scene_id) WHERE qa & 62 = 0""",
)
def surface_temperatures(i):
    """Two collections, clear pixels of the first scenes by date."""
    e = i.table("events").select("event_id", (F.dayofyear("ts") * 2 + F.col("event_id") % 2).alias("scene_id"), F.to_date("ts").alias("date"), (40000 + F.col("user_id") % 5000).alias("st"), (F.col("event_id") % 7).alias("qa"))
    out = catalog.landsat(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"))
    return out.select("event_id", "scene_id", r4("lst").alias("lst"))


@query("s17_port_imagery", f"SELECT row // 2 AS row, col // 2 AS col, {R('avg(red)')} AS red FROM px WHERE least(blue, green, red, nir) > 0.02 GROUP BY 1, 2", "px")
def port_imagery(i):
    """Imagery without its zero pixels, in blocks of two."""
    seen = i.px.where(F.least("blue", "green", "red", "nir") > 0.02)
    return resample.block_mean(seen, ["red"], 2).select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), r4("red").alias("red"))


@query("r03_dispatch", f"SELECT row // 3 AS row, col // 3 AS col, {R('avg(dsm)')} AS dsm FROM px GROUP BY 1, 2", "px")
def dispatch(i):
    """To a lattice of three times the step: block means."""
    fine = sheet(96, 96)
    out = resample.to_grid(resample.to_grid(i.px, "dsm", fine, fine), "dsm", fine, fine.stepped(3.0))
    return out.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), r4("dsm").alias("dsm"))


@query("s19_window", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN DATE '1995-01-01' ELSE o_orderdate::DATE - 120 END AS first, CASE WHEN o_orderkey % 5 = 0 THEN DATE '1999-01-01' ELSE o_orderdate::DATE + 120 END AS last FROM orders")
def window(i):
    """The thermal window: as asked for, else about the survey."""
    k, day = F.col("o_orderkey"), lambda d: F.lit(d).cast("date")
    first, last = jobs.window(F.to_date("o_orderdate"), F.when(k % 3 == 0, day("1995-01-01")), F.when(k % 5 == 0, day("1999-01-01")))
    return i.table("orders").select("o_orderkey", first.alias("first"), last.alias("last"))


@query("a17_iou", f"SELECT label, {R('(count(*) FILTER (red > 0.5 AND blue > 0.4))::DOUBLE / nullif(count(*) FILTER (red > 0.5 OR blue > 0.4), 0)')} AS iou FROM lpx GROUP BY label", "lpx")
def overlap(i):
    """Overlap of two masks by object; none without a pixel in either."""
    return i.lpx.groupBy("label").agg(r4(iou(F.col("red") > 0.5, F.col("blue") > 0.4)).alias("iou"))


@query("t03_largest", "SELECT commodity, max_by(pile_id, (volume, -pile_id)) AS pile_id, max(volume) AS volume FROM stock GROUP BY commodity", "stock")
def largest(i):
    """The largest pile of each material."""
    return i.stock.groupBy("commodity").agg(F.max_by("pile_id", F.struct("volume", -F.col("pile_id"))).alias("pile_id"), F.max("volume").alias("volume"))


@query("f09_flat", """SELECT c_custkey, '{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}' AS owner, '[' || c_nationkey || ',' || c_custkey % 7 || ']' AS codes FROM customer""")
def flat(i):
    """Nested columns as JSON text."""
    rows = i.table("customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("owner"), F.array(F.col("c_nationkey").cast("long"), (F.col("c_custkey") % 7).cast("long")).alias("codes"))
    return jobs.flat(rows)


@query("f11_settings", "SELECT c_custkey, 'asset' || c_nationkey AS asset, lower(trim(CASE c_custkey % 4 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'yes' WHEN 2 THEN '0' ELSE '' END)) IN ('1', 'true', 'yes', 'on') AS flag FROM customer")
def settings(i):
    """A flag and a list of date=asset, both text."""
    k = F.col("c_custkey")
    flag = F.when(k % 4 == 0, " TRUE").when(k % 4 == 1, "yes").when(k % 4 == 2, "0").otherwise("")
    listed = F.concat(F.lit("2024-05-01=other,2024-06-01=asset"), F.col("c_nationkey").cast("string"))
    return i.table("customer").select("c_custkey", F.str_to_map(listed, F.lit(","), F.lit("="))["2024-06-01"].alias("asset"), F.lower(F.trim(flag)).isin("1", "true", "yes", "on").alias("flag"))


@query("f15_escaped", "SELECT p_partkey, base64(encode(p_name)) AS encoded, replace(replace(replace('<b>' || p_name || ' & ' || p_brand, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM part")
def escaped(i):
    """Text in base64 and for HTML."""
    text = F.concat(F.lit("<b>"), "p_name", F.lit(" & "), "p_brand")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return i.table("part").select("p_partkey", F.replace(F.base64(F.encode("p_name", "utf-8")), F.lit("\r\n"), F.lit("")).alias("encoded"), text.alias("escaped"))


@query("k02_csv", f"SELECT pile_id, commodity, {R('volume')} AS volume FROM stock", "stock")
def csv(i):
    """A table written as CSV and read back."""
    path = f"{shared_dir(i.spark)}/orewise/sites/csv-{uuid.uuid4().hex}"
    jobs.write_csv(i.stock.select("pile_id", "commodity", r4("volume").alias("volume")), path)
    return i.spark.read.option("header", True).schema("pile_id long, commodity string, volume double").csv(path)


@query("k08_run_tables", "SELECT commodity, count(*) AS n, sum(volume) AS volume FROM stock WHERE pile_id % 2 = 0 GROUP BY commodity", "stock")
def run_tables(i):
    """Runs appended to a table by day; one day is read."""

    path = f"{shared_dir(i.spark)}/orewise/sites/runs-{uuid.uuid4().hex}"
    day = F.when(F.col("pile_id") % 2 == 0, "2025-05-01 10:00:00").otherwise("2025-05-02 10:00:00").cast("timestamp")
    jobs.write_run(i.stock.select(day.alias("run_ts"), "pile_id", "commodity", "volume"), path)
    return i.spark.read.parquet(path).where("run_day = '2025-05-01'").groupBy("commodity").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query("k06_saved", f"SELECT label, {R('avg(h)')} AS h FROM lpx GROUP BY label", "lpx")
def saved(i):
    """A stage's table, saved and read back."""
    return written(i.lpx.groupBy("label").agg(r4(F.avg("h")).alias("h")))


@query("w01_numbered", "SELECT p_partkey, row_number() OVER (ORDER BY p_partkey)::INT AS place FROM (SELECT DISTINCT p_partkey FROM part)")
def places(i):
    """All keys numbered in their order, by ranges."""
    return numbered(i.table("part"), "p_partkey", "place")


@query("g12_forest_downscaled")
def forest(i):
    """Fine temperatures by a forest of 60 trees, coarse means kept."""
    coarse = i.px.groupBy(F.floor(F.col("row") / 4).cast("int").alias("row"), F.floor(F.col("col") / 4).cast("int").alias("col")).agg(F.avg("dsm").alias("lst"))
    return modelling.downscaled(coarse, i.px, ["blue", "green", "red"], 4, kind="rf", rounds=60).select("row", "col", r4("lst").alias("lst"))


def _app(i):
    """Pixels of the app: bands, height, fold and class."""
    return modelling.spatial_folds(i.lpx.where("h is not null"), sheet(96, 96, 10.0)).withColumn("class", (F.col("label") > 0).cast("int"))


@query("g05_sample", "SELECT class, row, col FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY md5('42:' || row || ':' || col), row, col) AS n FROM (SELECT *, (label > 0)::INT AS class FROM lpx WHERE h IS NOT NULL)) WHERE n <= 1500", "lpx")
def app_sample(i):
    """1,500 pixels of each class: those of least hash, merged from all tasks' least."""
    px = i.lpx.where("h is not null").withColumn("class", (F.col("label") > 0).cast("int"))
    return modelling.least_hashes(px, "class", 1_500, ["row", "col"]).select("class", "row", "col")


@query("g05_mosaic")
def app_mosaic(i):
    """Heights of every pixel by the model that didn't see its fold."""
    px = written(_app(i))
    drawn = modelling.least_hashes(px, "class", 1_500, ["row", "col"])
    return modelling.mosaic_out_of_fold(px, drawn, ["blue", "green", "red", "nir"], "h", 5, rounds=5).select("row", "col", "fold", r4("pred").alias("pred"))


@query("g05_stratified", "SELECT label % 3 AS class, least(count(*), 1500) AS n FROM lpx GROUP BY 1", "lpx")
def stratified(i):
    """At most 1,500 pixels a class, by hash."""
    drawn = modelling.stratified(i.lpx.withColumn("class", F.col("label") % 3), "class", 1_500, ["row", "col"])
    return drawn.groupBy("class").agg(F.count("*").alias("n"))
