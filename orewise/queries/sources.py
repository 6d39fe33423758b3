"""Scans, payloads, exports and the synthetic yard."""

from pyspark.sql import functions as F

from ..operators import zonal
from ..operators.modelling import balanced  # noqa: F401
from ..plans import inventory as plans
from ..sources import jobs, synthetic
from . import query
from .inputs import r4

N = "3.1415926e-8"
R = ("(round({} + " + N + ", 4) + 0.0)").format


@query("s04_mosaic", "SELECT row, col, max_by(v, p) AS dsm FROM (SELECT (l_orderkey % 96)::INT AS row, (l_partkey % 96)::INT AS col, l_quantity AS v, (l_suppkey * 100000000 + l_orderkey * 10 + l_linenumber) * 100 + l_quantity::BIGINT AS p FROM lineitem) GROUP BY row, col")
def mosaic(i):
    """Surveys laid over each other, the last on top."""
    p = (F.col("l_suppkey") * 100000000 + F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100 + F.col("l_quantity").cast("long")
    li = i.table("lineitem")
    return li.groupBy((F.col("l_orderkey") % 96).cast("int").alias("row"), (F.col("l_partkey") % 96).cast("int").alias("col")).agg(F.max_by("l_quantity", p).alias("dsm"))


@query("s06_footprints", "SELECT p_partkey AS feature_id, p_size AS area_m2, p_brand AS kind FROM part WHERE p_size >= 30 AND p_retailprice < 1500")
def footprints(i):
    """Filter, columns and names of a feature scan."""
    return i.table("part").where((F.col("p_size") >= 30) & (F.col("p_retailprice") < 1500)).select(F.col("p_partkey").alias("feature_id"), F.col("p_size").alias("area_m2"), F.col("p_brand").alias("kind"))


@query("f08_json", "SELECT event_id, (props->>'$.k')::BIGINT AS k, coalesce((props->>'$.missing')::BIGINT, -1) AS other FROM events")
def json_fields(i):
    """Fields of JSON text, with a default."""
    p = F.from_json("props", "k long, missing long")
    return i.table("events").select("event_id", p.k.alias("k"), F.coalesce(p.missing, F.lit(-1)).alias("other"))


@query("f06_dates", "SELECT event_id, datediff('day', DATE '2000-01-01', ts::DATE) AS days, hour(ts) AS hour, strftime(ts, '%Y-%m-%d') AS iso, ((hour(ts) + 1) % 24 < 6 OR (hour(ts) + 1) % 24 >= 20) AS night FROM events")
def dates(i):
    """Day numbers, hours and ISO dates."""
    h = (F.hour("ts") + 1) % 24
    return i.table("events").select("event_id", F.datediff("ts", F.lit("2000-01-01")).cast("long").alias("days"), F.hour("ts").cast("long").alias("hour"), F.date_format("ts", "yyyy-MM-dd").alias("iso"), ((h < 6) | (h >= 20)).alias("night"))


@query("f10_names", "SELECT c_custkey, printf('P%03d', c_custkey % 1000) AS id, lpad((c_custkey % 100)::VARCHAR, 4, '0') || '_' || replace(lower(c_mktsegment), ' ', '_') AS name FROM customer")
def names(i):
    """Ids and names from numbers and text."""
    k = F.col("c_custkey")
    return i.table("customer").select("c_custkey", F.format_string("P%03d", k % 1000).alias("id"), F.concat(F.lpad((k % 100).cast("string"), 4, "0"), F.lit("_"), F.replace(F.lower("c_mktsegment"), F.lit(" "), F.lit("_"))).alias("name"))


@query("s25_payloads")
def payloads(i):
    """Jobs from encoded messages, bad ones with their error."""
    body = F.when(F.col("c_custkey") % 4 == 0, F.lit("not json")).when(F.col("c_custkey") % 4 == 1, F.lit("{}")).otherwise(F.to_json(F.struct(F.col("c_name").alias("project_uuid"))))
    m = i.table("customer").select(F.col("c_custkey").alias("id"), F.base64(F.encode(body, "utf-8")).alias("data"))
    return jobs.payloads(m).select("id", "project_uuid", "error")


@query("k03_geojson")
def geojson(i):
    """Features as JSON text."""
    ring = F.format_string('{"type":"Polygon","coordinates":[[[%d,0],[%d,1],[%d,1],[%d,0]]]}', *[F.col("p_size")] * 4)
    rows = i.table("part").select(ring.alias("geom"), "p_name", "p_retailprice")
    return jobs.feature_collection(rows, "geom", ["p_name", "p_retailprice"])


@query("k04_report")
def report(i):
    """Totals and materials as one JSON document."""
    t = plans.totals(i.stock.withColumn("sigma", F.col("volume") * 0.05))
    rows = F.array_sort(F.collect_list(F.struct(F.coalesce("commodity", F.lit("total")).alias("commodity"), "n", r4("volume_m3").alias("volume_m3"), r4("tonnage_t").alias("tonnage_t"))))
    return t.agg(F.to_json(rows).alias("report"))


@query("s22_synthetic_volumes")
def synthetic_volumes(i):
    """Volumes of the synthetic yard's piles."""
    px = synthetic.site(i.spark).withColumn("h", F.col("dsm") - F.col("dtm"))
    return zonal.volumes(px, 1.0).select("label", r4("area_m2").alias("area_m2"), r4("volume_m3").alias("volume_m3"))


@query("c01_synthetic_inventory")
def synthetic_inventory(i):
    """The inventory of the synthetic yard."""
    from ..operators.grid import sheet

    out = plans.inventory(synthetic.site(i.spark), sheet(450, 600))
    return out.select("label", "commodity", r4("volume_m3").alias("volume_m3"), r4("tonnage_t").alias("tonnage_t"))
