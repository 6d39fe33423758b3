"""Joins: lookups, polygons, neighbours, nearest, rings, as-of, overlap."""

from pyspark.sql import functions as F

from ..operators import focal, neighbours, vector
from ..operators.grid import sheet
from ..operators.outlines import outlines as outlines_of
from . import query
from .inputs import r4

N = "3.1415926e-8"
R = ("(round({} + " + N + ", 4) + 0.0)").format
G = sheet(96, 96)


@query(
    "j02_lookup",
    """SELECT p.pile_id, commodity, block, coalesce(t.n, 0) AS n_sales, coalesce(CASE WHEN t.n > 30 THEN 'busy' END, 'none') AS alert
  FROM stock p LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1) t ON t.l_partkey = p.pile_id""", "stock",
)
def lookup(i):
    """Objects with a default where the other table has none."""
    t = i.table("lineitem").where("l_quantity > 10").groupBy("l_partkey").agg(F.count("*").alias("n"))
    out = i.stock.join(t, F.col("pile_id") == F.col("l_partkey"), "left")
    return out.select("pile_id", "commodity", "block", F.coalesce("n", F.lit(0)).alias("n_sales"), F.when(F.col("n") > 30, "busy").otherwise("none").alias("alert"))


@query(
    "j04_temporal_median",
    f"SELECT label, date::VARCHAR AS date, event_id, {R('lst - m')} AS excess FROM (SELECT *, median(lst) OVER (PARTITION BY label) AS m FROM obs)", "obs",
)
def temporal_median(i):
    """Each value against its object's own median."""
    from pyspark.sql.window import Window

    m = F.median("lst").over(Window.partitionBy("label"))
    return i.obs.withColumn("m", m).select("label", F.col("date").cast("string").alias("date"), "event_id", r4(F.col("lst") - F.col("m")).alias("excess"))


RINGS = {
    1: [[10.2, 10.3], [40.7, 12.1], [44.4, 38.9], [20.6, 45.2], [10.2, 10.3]],
    2: [[30.1, 30.4], [80.3, 30.2], [80.8, 60.9], [30.5, 60.1], [30.1, 30.4]],
    3: [[60.3, 5.2], [90.4, 5.7], [75.1, 25.6], [60.3, 5.2]],
}


@query(
    "j05_point_in_polygon",
    """, ring AS (SELECT * FROM (VALUES """
    + ", ".join(f"({k}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for k, r in RINGS.items() for a, b in zip(r, r[1:]))
    + """) v(id, xa, ya, xb, yb)),
  cell AS (SELECT r::INT AS row, c::INT AS col, c + 0.5 AS x, 96 - (r + 0.5) AS y FROM range(96) a(r), range(96) b(c)),
  hit AS (SELECT row, col, id FROM cell, ring WHERE (ya > y) <> (yb > y) AND x < xa + (y - ya) / (yb - ya) * (xb - xa) GROUP BY row, col, id HAVING count(*) % 2 = 1)
  SELECT row, col, max(id)::INT AS label FROM hit GROUP BY row, col""",
    "px",
)
def polygons(i):
    """Pixels whose centres polygons hold; the later polygon wins."""
    import json

    rows = [(k, json.dumps({"type": "Polygon", "coordinates": [r]})) for k, r in RINGS.items()]
    features = i.spark.createDataFrame(rows, "feature_id int, geom_json string")
    return vector.rasterized(vector.edges(vector.polygons(features)), G)


@query(
    "j06_majority_overlap",
    "SELECT label, count(*) AS n_px FROM lpx WHERE label > 0 GROUP BY label HAVING avg((red > 0.5)::INT) <= 0.5", "lpx",
)
def majority(i):
    """Objects that aren't already covered for the most part."""
    own = i.lpx.where("label > 0")
    out = neighbours.majority_overlap(own.select("row", "col", "label"), own.where("red > 0.5").select("row", "col"))
    return out.groupBy("label").agg(F.count("*").alias("n_px"))


@query(
    "j07_neighbours",
    "SELECT DISTINCT a.label, b.label AS other FROM lpx a JOIN lpx b ON a.label > 0 AND b.label > 0 AND a.label <> b.label AND abs(a.row - b.row) + abs(a.col - b.col) <= 3", "lpx",
)
def near(i):
    """Objects within three steps of each other."""
    return neighbours.neighbours(i.lpx, 3)


@query(
    "j08_nearest",
    """SELECT row, col, min(label) AS label, d2 FROM (SELECT p.row, p.col, q.label, (p.row - q.row) ^ 2 + (p.col - q.col) ^ 2 AS d2, min((p.row - q.row) ^ 2 + (p.col - q.col) ^ 2) OVER (PARTITION BY p.row, p.col) AS m
  FROM px p JOIN lpx q ON q.label > 0 AND q.row BETWEEN p.row - 4 AND p.row + 4 AND q.col BETWEEN p.col - 4 AND p.col + 4 AND (p.row - q.row) ^ 2 + (p.col - q.col) ^ 2 <= 16) WHERE d2 = m GROUP BY row, col, d2""", "lpx",
)
def nearest(i):
    """Each pixel's nearest object within four pixels."""
    return neighbours.nearest_label(i.px, i.lpx, 4).select("row", "col", "label", F.col("d2").cast("double").alias("d2"))


@query(
    "j09_ring",
    f"""SELECT label, count(*) AS n_px, {R('avg(dsm)')} AS dsm FROM (SELECT o.label, p.row, p.col, any_value(p.dsm) AS dsm, min((p.row - o.row) ^ 2 + (p.col - o.col) ^ 2) AS d2
  FROM lpx o JOIN px p ON o.label > 0 AND p.row BETWEEN o.row - 6 AND o.row + 6 AND p.col BETWEEN o.col - 6 AND o.col + 6 GROUP BY o.label, p.row, p.col) WHERE d2 > 4 AND d2 <= 36 GROUP BY label""", "lpx",
)
def ring(i):
    """Background around each object, from over 2 to 6 pixels away."""
    out = neighbours.ring(i.lpx, i.px.select("row", "col", "dsm"), 2, 6)
    return out.groupBy("label").agg(F.count("*").alias("n_px"), r4(F.avg("dsm")).alias("dsm"))


@query(
    "j10_as_of",
    """SELECT o_orderkey, scene_id, apart FROM (SELECT o_orderkey, s.o2 AS scene_id, abs(datediff('day', d, d2)) AS apart,
    row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(datediff('day', d, d2)), cloud, s.o2) AS n
  FROM (SELECT o_orderkey, o_custkey % 50 AS k, o_orderdate::DATE AS d FROM orders WHERE o_orderkey % 2 = 0) a
  JOIN (SELECT o_orderkey AS o2, o_custkey % 50 AS k, o_orderdate::DATE AS d2, o_orderkey % 17 AS cloud FROM orders WHERE o_orderkey % 2 = 1) s USING (k) WHERE abs(datediff('day', d, d2)) <= 20) WHERE n = 1""",
)
def as_of(i):
    """The nearest scene (odd orders) in time within 20 days of each survey (even orders), the clearer one of equals."""
    o = i.table("orders")
    k, d = (F.col("o_custkey") % 50).alias("k"), F.to_date("o_orderdate")
    left = o.where("o_orderkey % 2 = 0").select("o_orderkey", k, d.alias("d"))
    right = o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("scene_id"), k, d.alias("d2"), (F.col("o_orderkey") % 17).alias("cloud"))
    out = neighbours.as_of(left, right, "k", "d", "d2", 20, [F.col("cloud"), F.col("scene_id")])
    return out.select("o_orderkey", "scene_id", F.col("apart").cast("long").alias("apart"))


@query(
    "j13_new_outlines",
    """SELECT label, n_px, printf('N%03d', row_number() OVER (ORDER BY n_px DESC, label)) AS name FROM (SELECT label, count(*) AS n_px FROM lpx WHERE label > 0 GROUP BY label HAVING avg((red > 0.6)::INT) <= 0.3)""", "lpx",
)
def new_outlines(i):
    """Outlines that little of the old ones covers, named by size."""
    own = i.lpx.where("label > 0")
    return neighbours.new_outlines(own.select("row", "col", "label"), own.where("red > 0.6").select("row", "col")).select("label", "n_px", "name")


@query(
    "j14_semi_anti",
    """SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS kept FROM customer WHERE c_mktsegment NOT IN (SELECT DISTINCT c_mktsegment FROM customer WHERE c_custkey < 2)""",
)
def semi_anti(i):
    """Names removed and names accepted by list."""
    c = i.table("customer")
    gone = c.where("c_custkey < 2").select("c_mktsegment").distinct()
    left = c.join(F.broadcast(gone), "c_mktsegment", "left_anti")  # one row
    has = i.table("orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return left.join(has.withColumn("kept", F.lit(True)), "c_custkey", "left").select("c_custkey", F.coalesce("kept", F.lit(False)).alias("kept"))


@query(
    "j15_precedence",
    """SELECT p_partkey, coalesce(CASE WHEN p_size > 40 THEN 'visual' END, z.zone, CASE WHEN p_partkey % 4 = 1 THEN 'lime_works' END, 'none') AS zone
  FROM part LEFT JOIN (SELECT * FROM (VALUES ('Brand#11', 'ore_yard'), ('Brand#22', 'coal_yard')) v(b, zone)) z ON z.b = p_brand""",
)
def precedence(i):
    """Zones by override, membership and default."""
    zones = i.spark.createDataFrame([("Brand#11", "ore_yard"), ("Brand#22", "coal_yard")], "p_brand string, z string")
    p = i.table("part").join(F.broadcast(zones), "p_brand", "left")  # two rows
    return p.select("p_partkey", F.coalesce(F.when(F.col("p_size") > 40, "visual"), F.col("z"), F.when(F.col("p_partkey") % 4 == 1, "lime_works"), F.lit("none")).alias("zone"))


@query("r06_outlines")
def outlines(i):
    """Borders of the labelled objects as rings."""
    return outlines_of(i.lpx.select("row", "col", "label"), G)


@query(
    "c17_zone_buffer",
    """SELECT DISTINCT m.row + a AS row, m.col + b AS col, m.zone FROM (SELECT row, col, 1 + label % 3 AS zone FROM lpx WHERE label > 0 AND red > 0.55) m, (SELECT unnest([-2, -1, 0, 1, 2]) AS a), (SELECT unnest([-2, -1, 0, 1, 2]) AS b) WHERE a * a + b * b <= 4""", "lpx",
)
def zone_buffer(i):
    """Zones: members buffered by a disc and joined."""
    m = i.lpx.where("label > 0 and red > 0.55").select("row", "col", (1 + F.col("label") % 3).alias("zone"))
    return focal.spread(m, focal.offsets("disc", 2)).select("row", "col", "zone").distinct()
