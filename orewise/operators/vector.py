"""Polygons and rasters: which pixels a ring holds, and rings around labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import Lattice

#: Rings of up to this many vertices are expected in a row; longer ones still work, edge by edge.
GEOMETRY = "type string, coordinates string, geometries array<string>"


def polygons(features: DataFrame) -> DataFrame:
    """features(feature_id, geom_json) -> feature_id, part, rings array<array<array<double>>>: one row a polygon.

    Polygons, MultiPolygons and GeometryCollections of them (nested once) are taken apart;
    any other type raises when it is read.
    """
    shape = lambda c: F.from_json(c, "type string, coordinates string, geometries array<string>")
    flat = features.select("feature_id", shape("geom_json").alias("g"), "geom_json")
    inner = F.when(F.col("g.type") == "GeometryCollection", F.col("g.geometries")).otherwise(F.array("geom_json"))
    each = flat.select("feature_id", F.posexplode(inner).alias("n", "j")).select("feature_id", "n", shape("j").alias("g"))
    poly = F.array(F.from_json("g.coordinates", "array<array<array<double>>>"))
    multi = F.from_json("g.coordinates", "array<array<array<array<double>>>>")
    parts = F.when(F.col("g.type") == "Polygon", poly).when(F.col("g.type") == "MultiPolygon", multi)
    parts = parts.otherwise(F.raise_error(F.concat(F.lit("unsupported geometry type "), F.coalesce(F.col("g.type"), F.lit("none")))))
    return each.select("feature_id", "n", F.posexplode(parts).alias("part", "rings")).select(
        "feature_id", (F.col("n") * 100000 + F.col("part")).cast("int").alias("part"), "rings"
    )


def edges(polys: DataFrame) -> DataFrame:
    """feature_id and the edges (xa, ya, xb, yb) of all its rings."""
    ring = polys.select("feature_id", F.explode("rings").alias("r"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("r") - 1), lambda k: F.struct(F.element_at("r", k).alias("p"), F.element_at("r", k + 1).alias("q")))
    e = ring.where(F.size("r") > 1).select("feature_id", F.explode(pairs).alias("e"))
    return e.select("feature_id", *[F.col(f"e.{k}")[i].alias(n) for k, i, n in (("p", 0, "xa"), ("p", 1, "ya"), ("q", 0, "xb"), ("q", 1, "yb"))])


def rasterized(segments: DataFrame, grid: Lattice) -> DataFrame:
    """edges() of features -> row, col, label: the greatest feature_id whose polygon holds the pixel's centre.

    Each edge meets the rows that it spans; between the crossings of a row, in pairs, lie the
    pixels inside. Only rows and pixels that polygons touch are made.
    """
    c = F.col
    line = lambda y: (grid.extent.north - y) / grid.step - 0.5
    top, low = line(F.greatest("ya", "yb")), line(F.least("ya", "yb"))
    first, last = F.greatest(F.ceil(top), F.lit(0)), F.least(F.ceil(low) - 1, F.lit(grid.rows - 1))
    crossed = segments.where(c("ya") != c("yb")).withColumns({"first": first, "last": last}).where("first <= last")
    rows = crossed.withColumn("row", F.explode(F.sequence("first", "last"))).withColumn("y", grid.extent.north - (c("row") + 0.5) * grid.step)
    x = c("xa") + (c("y") - c("ya")) / (c("yb") - c("ya")) * (c("xb") - c("xa"))
    at = rows.select("feature_id", c("row").cast("int").alias("row"), x.alias("x"))
    sorted_x = at.groupBy("feature_id", "row").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    spans = sorted_x.select("feature_id", "row", F.explode(F.sequence(F.lit(1), F.greatest(F.size("xs") - 1, F.lit(1)), F.lit(2))).alias("k"), "xs").where(F.size("xs") > 1)
    a = F.greatest(F.ceil((F.element_at("xs", c("k").cast("int")) - grid.extent.west) / grid.step - 0.5), F.lit(0))
    b = F.least(F.ceil((F.element_at("xs", c("k").cast("int") + 1) - grid.extent.west) / grid.step - 0.5) - 1, F.lit(grid.cols - 1))
    px = spans.select("feature_id", "row", a.alias("a"), b.alias("b")).where("a <= b")
    px = px.select("feature_id", "row", F.explode(F.sequence("a", "b")).alias("col"))
    return px.groupBy("row", F.col("col").cast("int").alias("col")).agg(F.max("feature_id").cast("int").alias("label"))


def area_of(ring: list) -> float:
    """Signed area of a closed ring."""
    p = np.array(ring)
    return float(np.sum(p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]) / 2)
