"""Deterministic stand-ins for rasters, scenes and piles, made alike in Spark and in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rounded

SIDE = 96
BLOCK = 8


class Inputs:
    """Tables of a scale-factor folder, and what is derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def px(self) -> DataFrame:
        """Pixels of a 96 x 96 grid: surfaces and four bands; unpopulated ones are no data."""
        li = self.table("lineitem")
        mean = lambda c, k: rounded(F.avg(c) * k, 5)
        return li.groupBy((F.col("l_orderkey") % SIDE).cast("int").alias("row"), (F.col("l_partkey") % SIDE).cast("int").alias("col")).agg(
            mean("l_quantity", 1).alias("dsm"), F.min("l_quantity").alias("dtm"), mean("l_tax", 10).alias("blue"), mean("l_discount", 8).alias("green"),
            mean("l_extendedprice", 1e-5).alias("red"), mean("l_quantity", 0.02).alias("nir"),
        )

    @cached_property
    def lpx(self) -> DataFrame:
        """px with heights and labels of 8 x 8 objects, a third of them background."""
        br, bc = F.floor(F.col("row") / BLOCK), F.floor(F.col("col") / BLOCK)
        label = F.when((br + bc) % 3 != 0, 1 + br * 12 + bc).otherwise(0).cast("int")
        return self.px.withColumns({"label": label, "h": F.col("dsm") - F.col("dtm")})

    @cached_property
    def obs(self) -> DataFrame:
        """Thermal observations: an object's pixel in a scene a day."""
        e = self.table("events")
        hour = F.hour("ts")
        return e.select(
            "event_id", F.col("user_id").alias("label"), F.to_date("ts").alias("date"), ((hour < 6) | (hour >= 20)).alias("night"), F.col("value").alias("lst"),
            ((F.col("event_id") % 10) / 10).alias("cover"),
        )

    @cached_property
    def swir(self) -> DataFrame:
        """SWIR pixels: a pixel per event type and user, a scene a day."""
        e = self.table("events")
        b11 = F.col("value") / 500
        return e.select(
            (F.dayofmonth(F.to_date("ts")) * 2 + F.col("event_id") % 2).cast("int").alias("scene_id"), F.to_date("ts").alias("date"), (F.col("user_id") % 16).cast("int").alias("row"),
            (F.length("event_type") % 4).cast("int").alias("col"), (1 + F.col("user_id") % 16).cast("int").alias("label"), b11.alias("b11"), (b11 * (0.6 + (F.col("event_id") % 7) * 0.2)).alias("b12"),
        )

    @cached_property
    def piles(self) -> DataFrame:
        """Objects with an actual and a predicted volume, in five folds."""
        li = self.table("lineitem").groupBy("l_orderkey").agg(rounded(F.sum("l_extendedprice"), 2).alias("pred"))
        o = self.table("orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"))
        return o.select(F.col("o_orderkey").alias("pile_id"), (F.col("o_custkey") % 5).cast("int").alias("fold"), F.col("o_totalprice").alias("actual"), "pred", F.to_date("o_orderdate").alias("date"))

    @cached_property
    def stock(self) -> DataFrame:
        """Piles with a material and a volume."""
        kinds = F.array(*map(F.lit, KINDS))
        return self.table("part").select(
            F.col("p_partkey").alias("pile_id"), F.element_at(kinds, (F.col("p_size") % 10 + 1).cast("int")).alias("commodity"), F.col("p_retailprice").alias("volume"),
            (F.col("p_partkey") % 4).cast("int").alias("block"),
        )

    @cached_property
    def colours(self) -> DataFrame:
        e = F.col("embedding")
        return self.table("embeddings").select("vec_id", "label", *[e[k].cast("double").alias(b) for k, b in enumerate(("blue", "green", "red", "nir"))])


KINDS = ["coal", "coke", "iron_ore", "limestone", "sand_gravel", "wood_chips", "scrap_metal", "slag", "unknown", "mystery"]
_HALF = "CASE WHEN (row // 8 + col // 8) % 3 <> 0 THEN 1 + (row // 8) * 12 + col // 8 ELSE 0 END"
CTES = {
    "px": """px AS (SELECT (l_orderkey % 96)::INT AS row, (l_partkey % 96)::INT AS col, round(avg(l_quantity) + 3.1415926e-8, 5) AS dsm, min(l_quantity) AS dtm,
  round(avg(l_tax) * 10 + 3.1415926e-8, 5) AS blue, round(avg(l_discount) * 8 + 3.1415926e-8, 5) AS green, round(avg(l_extendedprice) * 1e-5 + 3.1415926e-8, 5) AS red,
  round(avg(l_quantity) * 0.02 + 3.1415926e-8, 5) AS nir FROM lineitem GROUP BY 1, 2)""",
    "lpx": f"lpx AS (SELECT *, ({_HALF})::INT AS label, dsm - dtm AS h FROM px)",
    "obs": """obs AS (SELECT event_id, user_id AS label, ts::DATE AS date, hour(ts) < 6 OR hour(ts) >= 20 AS night, value AS lst, (event_id % 10) / 10 AS cover FROM events)""",
    "swir": """swir AS (SELECT (day(ts) * 2 + event_id % 2)::INT AS scene_id, ts::DATE AS date, (user_id % 16)::INT AS row, (length(event_type) % 4)::INT AS col,
  (1 + user_id % 16)::INT AS label, value / 500 AS b11, value / 500 * (0.6 + (event_id % 7) * 0.2) AS b12 FROM events)""",
    "piles": """piles AS (SELECT o_orderkey AS pile_id, (o_custkey % 5)::INT AS fold, o_totalprice AS actual, pred, o_orderdate::DATE AS date FROM orders
  JOIN (SELECT l_orderkey, round(sum(l_extendedprice) + 3.1415926e-8, 2) AS pred FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)""",
    "stock": f"stock AS (SELECT p_partkey AS pile_id, ({KINDS})[p_size % 10 + 1] AS commodity, p_retailprice AS volume, (p_partkey % 4)::INT AS block FROM part)",
    "density": "density AS (SELECT * FROM (VALUES ('coal', 0.85), ('coke', 0.5), ('iron_ore', 2.4), ('limestone', 1.55), ('sand_gravel', 1.65), ('wood_chips', 0.3), ('scrap_metal', 0.9), ('slag', 1.8), ('unknown', 1.0)) v(commodity, rho))",
    "colours": "colours AS (SELECT vec_id, label, embedding[1]::DOUBLE AS blue, embedding[2]::DOUBLE AS green, embedding[3]::DOUBLE AS red, embedding[4]::DOUBLE AS nir FROM embeddings)",
}
NEEDS = {"lpx": ["px"]}


def with_ctes(names: list[str], sql: str) -> str:
    wanted: list[str] = []
    for n in names:
        wanted += [x for x in [*NEEDS.get(n, []), n] if x not in wanted]
    return ("WITH " + ",\n".join(CTES[n] for n in wanted) + "\n" if wanted else "") + sql


def r4(c: Column | str, digits: int = 4) -> Column:
    return rounded(F.col(c) if isinstance(c, str) else c, digits)
